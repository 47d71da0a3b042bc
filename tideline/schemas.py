"""Record layouts of the warehouse."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _I = T.StringType(), T.LongType(), T.IntegerType()
_MAP = T.MapType(_S, _S)

def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, _S) for n in names]

def _struct(*parts) -> T.StructType:
    fields: list[T.StructField] = []
    for p in parts:
        fields += p if isinstance(p, list) else [p]
    return T.StructType(fields)

def _field(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind)

# Change of one row of a business table.
CHANGE = _struct(
    _field("before", _MAP), _field("after", _MAP), _field("source", _MAP), _strings("op"), _field("ts_ms", _L)
)
# The older layout of the same information; ``ts`` is in seconds.
LEGACY_CHANGE = _struct(
    _strings("database", "table", "type"), _field("ts", _L), _field("data", _MAP), _field("old", _MAP)
)

COMMON = _struct(_strings("ar", "uid", "os", "ch", "is_new", "md", "mid", "vc", "ba", "sid"))
PAGE = _struct(
    _strings("page_id", "item", "item_type"), _field("during_time", _L), _strings("last_page_id", "refer_id")
)
DISPLAY = _struct(_field("pos_seq", _I), _strings("item", "item_type"), _field("pos_id", _I))
APP_LOG = _struct(
    _field("common", COMMON),
    _field("page", PAGE),
    _field("displays", T.ArrayType(DISPLAY)),
    _field("actions", T.ArrayType(_MAP)),
    _field("start", _MAP),
    _field("err", _MAP),
    _field("ts", _L),
)
DIM_CONFIG = _struct(_strings("source_table", "sink_table", "sink_columns", "sink_family", "sink_row_key", "op"))
FACT_CONFIG = _struct(_strings("source_table", "source_type", "sink_table", "sink_columns", "op"))

CART_ADD = _struct(_strings("id", "user_id", "sku_id", "sku_num"), _field("ts_ms", _L))
USER_INFO = _struct(
    _field("id", _I), _strings("login_name", "name", "gender"), _field("user_level", _I), _field("birthday", _I),
    _strings("create_time"),
)
# Metric tables share the window bounds.
_BOUNDS = _strings("stt", "edt", "cur_date")
TRAFFIC_METRICS = _struct(
    _BOUNDS, _strings("vc", "ch", "ar", "is_new"), *[_field(n, _L) for n in ("uv_ct", "sv_ct", "pv_ct", "dur_sum")]
)
HOME_DETAIL_METRICS = _struct(_BOUNDS, _field("home_uv_ct", _L), _field("good_detail_uv_ct", _L))
LOGIN_METRICS = _struct(_BOUNDS, _field("back_ct", _L), _field("uu_ct", _L))
CART_METRICS = _struct(_BOUNDS, _field("cart_add_uu_ct", _L))
_MONEY = T.DecimalType(26, 2)
PROVINCE_METRICS = _struct(
    _BOUNDS, _strings("province_id", "province_name"), _field("order_amount", _MONEY), _field("order_count", _L)
)
