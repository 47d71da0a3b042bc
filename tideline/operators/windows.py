"""Tumbling-window metrics.  Sums and counts combine before the shuffle, so a hot key or a global window is one small row per task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tideline.functions.text import explode_words
from tideline.functions.times import from_millis, window_bounds
from tideline.operators import keyed

LONG = "bigint"


def tumble(
    df: DataFrame, ts: str, width: str, keys: Sequence[str], aggs: Sequence[Column], tz: str = "UTC"
) -> DataFrame:
    """``stt, edt, cur_date``, the keys and the aggregates of each tumbling window.

    Works on streams as well; ``ts`` then needs a watermark.
    """
    grouped = df.groupBy(F.window(ts, width), *keys).agg(*aggs)
    return grouped.select(*window_bounds(tz=tz), *[c for c in grouped.columns if c != "window"])


def tumble_processing_time(
    df: DataFrame, width: str, keys: Sequence[str], aggs: Sequence[Column], tz: str = "UTC"
) -> DataFrame:
    """As :func:`tumble`, by the time a row is processed."""
    return tumble(df.withColumn("_now", F.current_timestamp()), "_now", width, keys, aggs, tz)


def total(name: str, out: str | None = None) -> Column:
    return F.sum(name).alias(out or name)


def traffic_window(
    pages: DataFrame, width: str = "10 seconds", dims: Sequence[str] = ("vc", "ch", "ar", "is_new"),
    visitor: str = "mid", ts: str = "ts", order: Sequence[str] = ("ts", "seq"), tz: str = "UTC",
) -> DataFrame:
    """pv, uv, sv and duration by version, channel, area and visitor kind.

    Page views and durations are plain sums; unique visitors are counted from
    one row per visitor and day.  Both parts are reduced on the map side and
    only their partial sums meet.
    """
    dims = list(dims)
    win = F.window(ts, width)
    zero = F.lit(0).cast(LONG)
    session_start = F.col("last_page_id").isNull() | (F.col("last_page_id") == "")
    views = pages.groupBy(win.alias("window"), *dims).agg(
        zero.alias("uv_ct"),
        F.sum(session_start.cast(LONG)).alias("sv_ct"),
        F.count("*").alias("pv_ct"),
        F.sum("during_time").alias("dur_sum"),
    )
    firsts = keyed.first_of_day(
        pages.select(visitor, *dims, *dict.fromkeys([ts, *order])), [visitor], ts, list(order), tz
    )
    visitors = firsts.groupBy(win.alias("window"), *dims).agg(
        F.count("*").alias("uv_ct"), zero.alias("sv_ct"), zero.alias("pv_ct"), zero.alias("dur_sum")
    )
    merged = (
        views.unionByName(visitors)
        .groupBy("window", *dims)
        .agg(*[total(c) for c in ("uv_ct", "sv_ct", "pv_ct", "dur_sum")])
    )
    return merged.select(*window_bounds(tz=tz), *dims, "uv_ct", "sv_ct", "pv_ct", "dur_sum")


def home_detail_window(
    pages: DataFrame, width: str = "10 seconds", home: str = "home", detail: str = "good_detail",
    visitor: str = "mid", ts: str = "ts", order: Sequence[str] = ("ts", "seq"), tz: str = "UTC",
) -> DataFrame:
    """Daily unique visitors of the home page and of the product page."""
    seen = pages.where(F.col("page_id").isin(home, detail)).select(
        visitor, "page_id", *dict.fromkeys([ts, *order])
    )
    firsts = keyed.first_of_day(seen, [visitor, "page_id"], ts, list(order), tz)
    return tumble(
        firsts, ts, width, [],
        [
            F.sum((F.col("page_id") == home).cast(LONG)).alias("home_uv_ct"),
            F.sum((F.col("page_id") == detail).cast(LONG)).alias("good_detail_uv_ct"),
        ],
        tz,
    )


def login_rows(pages: DataFrame, user: str = "uid") -> DataFrame:
    """Rows that open a session for a known user."""
    arrived = (F.col("last_page_id") == "login") | F.col("last_page_id").isNull() | (F.col("last_page_id") == "")
    return pages.where(F.col(user).isNotNull() & (F.col(user) != "") & arrived)


def login_window(
    pages: DataFrame, width: str = "10 seconds", gap_days: int = 8, user: str = "uid", ts: str = "ts",
    order: Sequence[str] = ("ts", "seq"), tz: str = "UTC",
) -> DataFrame:
    """Active and returning users."""
    rows = login_rows(pages, user).select(user, *dict.fromkeys([ts, *order]))
    marked = keyed.returning_users(rows, [user], ts, list(order), gap_days, tz)
    return tumble(marked, ts, width, [], [total("back_ct"), total("uu_ct")], tz)


def cart_users_window(
    adds: DataFrame, width: str = "1 second", user: str = "user_id", ts: str = "ts",
    order: Sequence[str] = ("ts", "seq"), tz: str = "UTC",
) -> DataFrame:
    """Users that put something into the cart for the first time on a day."""
    rows = adds.select(user, *dict.fromkeys([ts, *order]))
    firsts = keyed.first_of_day(rows, [user], ts, list(order), tz)
    return tumble(firsts, ts, width, [], [F.count("*").alias("cart_add_uu_ct")], tz)


def search_rows(pages: DataFrame) -> DataFrame:
    return pages.where(
        (F.col("last_page_id") == "search") & (F.col("item_type") == "keyword") & F.col("item").isNotNull()
    )


def keyword_window(
    searches: DataFrame, text: str, ts: str = "ts", width: str = "10 seconds", keys: Sequence[str] = (),
    tz: str = "UTC",
) -> DataFrame:
    """Occurrences of each search word."""
    split = explode_words(searches.select(ts, *keys, text), text)
    return tumble(split, ts, width, [*keys, "keyword"], [F.count("*").alias("keyword_count")], tz)


def _live(measure: str) -> Column:
    """The measure of a surviving version, zero for a replaced one."""
    return F.when(F.col("superseded"), F.lit(0)).otherwise(F.col(measure))


def province_order_window(
    marked: DataFrame, width: str = "10 seconds", province: str = "province_id",
    amount: str = "split_total_amount", order_id: str = "order_id", legacy_count: bool = False, tz: str = "UTC",
) -> DataFrame:
    """Order amount and number of orders by province, net of replaced detail rows.

    ``marked`` carries ``superseded`` from :func:`keyed.mark_superseded`, which
    needs the detail rows alone and belongs before any join.  Orders are counted over the surviving versions; ``legacy_count`` counts the
    orders of replaced versions too, as a set that never forgets would.
    """
    rows = marked.withColumn("_ts", from_millis(F.col("ts_ms")))
    counted = F.col(order_id) if legacy_count else F.when(~F.col("superseded"), F.col(order_id))
    net = F.sum(_live(amount))
    return tumble(
        rows, "_ts", width, [province],
        [net.alias("order_amount"), F.count_distinct(counted).alias("order_count")], tz,
    )


def sku_order_window(
    details: DataFrame, width: str = "10 seconds", sku: str = "sku_id",
    measures: dict[str, str] | None = None, keys: Sequence[str] = ("id",),
    order: Sequence[str] = ("ts_ms", "seq"), ttl_ms: int | None = None, tz: str = "UTC",
) -> DataFrame:
    """Four order amounts by product, net of replaced detail rows."""
    measures = measures or {
        "split_original_amount": "original_amount",
        "split_activity_amount": "activity_reduce_amount",
        "split_coupon_amount": "coupon_reduce_amount",
        "split_total_amount": "order_amount",
    }
    rows = keyed.mark_superseded(
        details.select(*dict.fromkeys([*keys, *order, "ts_ms", sku, *measures])),
        list(keys), list(order), "ts_ms", ttl_ms,
    ).withColumn("_ts", from_millis(F.col("ts_ms")))
    # A negated copy would fall into the window of the row it cancels, so the
    # row counts as zero there and no copy is made.
    aggs = [F.sum(_live(m)).alias(out) for m, out in measures.items()]
    return tumble(rows, "_ts", width, [sku], aggs, tz)


def last_in_window(
    df: DataFrame, key: str, ts: str, width: str, order: Sequence[str], tz: str = "UTC"
) -> DataFrame:
    """Last row of each key in each window."""
    rest = [c for c in df.columns if c != key]
    last = df.groupBy(F.window(ts, width), key).agg(
        F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")
    )
    return last.select(*window_bounds(tz=tz), key, "_r.*")
