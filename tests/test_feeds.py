"""Change feeds, logs, readers and writers on small records."""

import json

import pytest
from pyspark.sql import functions as F, types as T

from tideline.operators import applog, cdc, facts, people
from tideline.schemas import CART_ADD, USER_INFO
from tideline.sinks import writers
from tideline.sources import readers


def messages(spark, *records):
    rows = [(r if isinstance(r, str) or r is None else json.dumps(r, ensure_ascii=False),) for r in records]
    return spark.createDataFrame(rows, "value string")


def change(table, op, before=None, after=None, ts=1, db="shop"):
    return {"before": before, "after": after, "source": {"db": db, "table": table}, "op": op, "ts_ms": ts}


def test_decode_drops_null_and_bad_records(spark):
    df = cdc.decode_changes(messages(spark, change("t", "c", after={"id": 1}), None, "{bad", '{"other": 1}'))
    rows = df.collect()
    assert len(rows) == 1 and rows[0].after == {"id": "1"} and rows[0].ts_ms == 1


def test_strict_decode_fails(spark):
    with pytest.raises(Exception):
        cdc.decode_changes(messages(spark, "{bad"), strict=True).collect()


def test_legacy_records(spark):
    df = cdc.decode_legacy_changes(messages(
        spark,
        {"database": "shop", "table": "t", "type": "update", "ts": 5, "data": {"id": "1", "a": "2"}, "old": {"a": "1"}},
        {"database": "shop", "table": "t", "type": "insert", "ts": 6, "data": {"id": "2"}, "old": None},
        {"database": "shop", "table": "t", "type": "delete", "ts": 7, "data": {"id": "3"}},
        {"database": "shop", "table": "t", "type": "bootstrap-start", "ts": 8, "data": {}},
        {"database": "else", "table": "t", "type": "insert", "ts": 9, "data": {"id": "4"}},
    ), database="shop")
    rows = {r.ts_ms: r for r in cdc.drop_bootstrap(df).collect()}
    assert set(rows) == {5000, 6000, 7000}
    assert rows[5000].before == {"id": "1", "a": "1"} and rows[5000].after == {"id": "1", "a": "2"}
    assert (rows[6000].op, rows[6000].before) == ("c", None)
    assert (rows[7000].op, rows[7000].before, rows[7000].after) == ("d", {"id": "3"}, None)


def test_keep_changes(spark):
    df = cdc.decode_changes(messages(
        spark,
        change("a", "c", after={"id": 1}), change("a", "c", after={}), change("a", "d", before={"id": 2}),
        change("a", "d", after={"id": 3}), change("a", "x", after={"id": 4}), change("a", "u", after={"id": 5}, db="o"),
    ))
    kept = cdc.keep_changes(df, "shop")
    assert sorted((r.op, r.i["id"]) for r in kept.select("op", cdc.row_image().alias("i")).collect()) == [
        ("c", "1"), ("d", "2")
    ]


def test_routing_follows_the_configuration(spark):
    changes = cdc.decode_changes(messages(
        spark, change("brand", "c", after={"id": 1, "tm_name": "A", "logo": "x"}), change("brand", "d", before={"id": 1}),
        change("other", "c", after={"id": 9}),
    ))
    rows = [("brand", "dim_brand", "id, tm_name", "info", "id", "c", 1), ("other", "dim_other", "id", "info", "id", "c", 1),
            ("other", "dim_other", "id", "info", "id", "d", 2)]
    config = cdc.current_config(
        spark.createDataFrame(rows, "source_table string, sink_table string, sink_columns string, sink_family string, "
                                    "sink_row_key string, op string, v int"),
        ["source_table"], ["v"],
    )
    got = {r.op: r for r in cdc.route_dimensions(changes, config).collect()}
    assert set(got) == {"c", "d"}
    assert got["c"].data == {"id": "1", "tm_name": "A", "op": "c"} and got["c"].row_key == "1"
    assert got["d"].row_key == "1"


def test_cells_written_before_a_delete_do_not_come_back(spark):
    data = [("k", "u", {"a": "1", "b": "2"}, 1), ("k", "d", {}, 2), ("k", "u", {"a": "3", "b": ""}, 3),
            ("m", "u", {"a": "1", "b": "2"}, 1), ("m", "u", {"a": "", "b": "5"}, 2), ("n", "u", {"a": "1"}, 1), ("n", "d", {}, 2)]
    df = spark.createDataFrame(data, "row_key string, op string, data map<string,string>, seq int")
    cells = cdc.merge_cells(df, ["row_key"])
    assert sorted(map(tuple, cells.collect())) == [("k", "a", "3"), ("m", "a", "1"), ("m", "b", "5")]
    maps = {r.row_key: r.data for r in cdc.cells_to_maps(cells, ["row_key"]).collect()}
    assert maps == {"k": {"a": "3"}, "m": {"a": "1", "b": "5"}}
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    typed = cdc.maps_to_columns(cdc.cells_to_maps(cells, ["row_key"]), schema)
    assert sorted(map(tuple, typed.collect()), key=str) == [(1, 5), (3, None)]


def test_cart_adds(spark):
    def cart(op, new, old=None):
        return change("cart_info", op, None if old is None else {"sku_num": old}, {"id": op + new, "user_id": "1", "sku_id": "2", "sku_num": new})

    df = cdc.decode_changes(messages(
        spark, cart("c", "3"), cart("r", "4"), cart("u", "7", "5"), cart("u", "1", "5"), cart("u", "9"), cart("d", "1", "1")
    ))
    out = facts.cart_adds(cdc.of_table(df, "cart_info"))
    assert [f.name for f in out.schema] == CART_ADD.names
    assert {r.id: r.sku_num for r in out.collect()} == {"c3": "3", "r4": None, "u7": "2"}


def test_user_and_body_records(spark):
    feed = cdc.decode_changes(messages(
        spark,
        change("user_info", "c", after={"id": 7, "login_name": "x", "birthday": 12970, "user_level": 2}, ts=1000),
        change("user_info", "u", after={"id": 7, "login_name": "later", "birthday": 12970}, ts=2000),
        change("user_info_sup_msg", "c", after={"uid": 7, "height": 171, "unit_height": "cm", "weight": 62}, ts=61_000),
        change("user_info_sup_msg", "c", after={"uid": 7, "height": 172, "unit_height": "cm", "weight": 62}, ts=61_001),
        change("comment_info", "c", after={"id": 3, "comment_txt": "t", "order_id": 5}, ts=3),
        change("order_info", "d", before={"id": 5, "consignee": "n"}, ts=4),
    ))
    users = people.user_records(feed, F.lit("2025-05-15").cast("date"))
    out = people.profiles(users, people.body_records(feed)).collect()
    assert [(r.uid, r.login_name, r.height, r.age_group) for r in out] == [(7, "x", 171, "18-24")]
    comments, orders = people.comment_records(feed), people.order_records(feed, ["id", "consignee"])
    orders = orders.withColumn("id", F.col("id").cast("bigint"))
    pair = facts.comments_with_orders(comments, orders).first()
    assert (pair.commentTxt, pair.info_consignee, pair.info_op, pair.ds) == ("t", "n", "d", "19700101")


def test_log_split_rules(spark):
    log = applog.clean(applog.parse_log(messages(
        spark,
        {"common": {"mid": "m"}, "page": {"page_id": "p"}, "ts": 1, "err": {"c": 1}, "displays": [], "actions": None},
        {"common": {"mid": "m"}, "start": {"e": 1}, "err": {"c": 2}, "ts": 2},
        {"common": {"mid": "m"}, "page": {"page_id": "q"}, "ts": 3, "displays": [{"item": "a"}, {"item": "b"}], "actions": [{"x": "1"}]},
        "broken {",
    )))
    kinds = {k: v.collect() for k, v in applog.split_log(log).items()}
    assert {k: len(v) for k, v in kinds.items()} == {"page": 2, "err": 2, "start": 1, "display": 2, "action": 1}
    assert kinds["page"][0].asDict().keys() == {"common", "page", "ts"}
    assert "ts" not in kinds["action"][0].asDict() and kinds["display"][0].ts == 3


def test_dirty_records_are_kept(spark):
    parsed = applog.parse_log(messages(spark, '{"ts": 1}', "broken {", "[]", None))
    assert sorted(r.value for r in applog.dirty(parsed).collect()) == ["[]", "broken {"]


def test_json_table_skips_bad_messages(spark):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("m", T.MapType(T.StringType(), T.StringType()))])
    df = readers.json_table(messages(spark, '{"a": 1, "m": {"k": "v"}}', "{", '{"a": "x"}', None), schema, "tideline_t")
    assert [tuple(r) for r in df.collect()] == [(1, {"k": "v"})]
    assert spark.sql("SELECT m['k'] AS k FROM tideline_t").first().k == "v"


def test_messages(spark):
    df = spark.createDataFrame([(1, None, "x")], "orderId int, userName string, curDate string")
    assert writers.snake_messages(df).first().value == '{"order_id":1,"cur_date":"x"}'
    keyed = writers.to_messages(df, key=["orderId"], hidden=["curDate"]).first()
    assert (keyed.key, keyed.value) == ('{"orderId":1}', '{"orderId":1}')


def test_word_file_and_messages_as_text(spark, tmp_path):
    (tmp_path / "words.txt").write_text("hat\n\n the \nhat\n", encoding="utf-8")
    words = readers.read_words(spark, str(tmp_path / "words.txt"))
    assert sorted(r.word for r in words.collect()) == ["hat", "the"]
    writers.write_messages(writers.to_messages(words), "text", {"path": str(tmp_path / "out")})
    assert spark.read.text(str(tmp_path / "out")).count() == 2


def test_dimension_is_all_text(spark, sf):
    df = readers.read_dimension(spark, f"{sf}/nation.parquet", ["n_nationkey", "n_name"])
    assert {f.dataType.typeName() for f in df.schema} == {"string"}
    assert readers.first_rows(df, 3, "n_nationkey").count() == 3


def test_topic_options():
    options = readers.topic_options("host:1", "a", "latest", {"kafka.group.id": "g"})
    assert options["startingOffsets"] == "latest" and options["kafka.group.id"] == "g"
    assert options["failOnDataLoss"] == "true"


def test_snapshot_rows_come_before_changes_of_their_time(spark):
    rows = "sink_table string, id string, v string, op string, ts_ms long"
    snapshot = spark.createDataFrame([("t", "1", "s1", "r", 10), ("t", "2", "s2", "r", 10)], rows)
    changes = spark.createDataFrame([("t", "1", "old", "u", 5), ("t", "2", "new", "u", 10)], rows)
    feed = readers.initial_then_changes(snapshot, changes)
    assert {r.id: r.v for r in cdc.current_rows(feed, ["id"], ["seq"]).collect()} == {"1": "s1", "2": "new"}


def test_rows_go_to_the_target_they_name(spark, tmp_path):
    path = str(tmp_path / "sinks")
    first = spark.createDataFrame([("a", 1), ("b", 2)], "sink_table string, v int")
    writers.write_partitioned(first, path)
    for _ in range(2):  # a batch that runs again replaces its own rows
        writers.write_partitioned(spark.createDataFrame([("b", 3)], "sink_table string, v int"), path, batch_id=1)
    got = sorted((r.sink_table, r.v) for r in spark.read.parquet(path).collect())
    assert got == [("a", 1), ("b", 2), ("b", 3)]


def test_table_configuration(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS tideline_test")
    config = "sink_table string, sink_columns string, op string"
    place = str(tmp_path / "dims")
    done = writers.apply_table_config(spark.createDataFrame([("d1", "id,name", "c"), ("d2", "id", "r")], config), "tideline_test", place)
    assert done == ["create d1", "create d2"]
    assert spark.table("tideline_test.d1").columns == ["id", "name"]
    spark.sql("INSERT INTO tideline_test.d1 VALUES ('1', 'x')")
    writers.apply_table_config(spark.createDataFrame([("d1", "id,name,level", "u"), ("d2", "", "d")], config), "tideline_test", place)
    assert spark.table("tideline_test.d1").columns == ["id", "name", "level"]
    assert not spark.catalog.tableExists("tideline_test.d2")
    assert spark.table("tideline_test.d1").count() == 0
    ordered = spark.createDataFrame(
        [("d1", "id", "c", 2), ("d1", "", "d", 1), ("d3", "id", "c", 1), ("d3", "", "d", 2)], config + ", v int"
    )
    done = writers.apply_table_config(ordered, "tideline_test", place, ["v"])
    assert done == ["drop d1", "create d1", "drop d3"] and spark.table("tideline_test.d1").columns == ["id"]
    spark.sql("DROP DATABASE tideline_test CASCADE")


def test_sql_word_function(spark):
    from tideline.functions.text import register_word_function

    register_word_function(spark, "word_split_test")
    rows = spark.sql("SELECT keyword FROM (SELECT 'Red  shoe-X' AS t), LATERAL word_split_test(t)").collect()
    assert [r.keyword for r in rows] == ["red", "shoe", "x"]


def test_user_schema_names():
    assert USER_INFO.names[0] == "id"


def test_landed_changes_are_read_by_table(spark, tmp_path):
    path = str(tmp_path / "landed")
    feed = cdc.decode_changes(messages(spark, change("a", "c", after={"id": 1}), change("b", "c", after={"id": 2})))
    writers.land_changes(feed, path, 0)
    writers.land_changes(feed, path, 0)
    one = spark.read.parquet(path).where("source_table = 'a'")
    assert [r.after["id"] for r in one.collect()] == ["1"]
    assert "PartitionFilters: [isnotnull(source_table" in one._jdf.queryExecution().executedPlan().toString()


def test_shuffle_size_follows_the_input(spark, sf):
    from tideline.session import size_shuffle

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffle(spark, sf) == spark.sparkContext.defaultParallelism
        assert size_shuffle(spark, sf, target_mb=1, expansion=100) > 50
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
