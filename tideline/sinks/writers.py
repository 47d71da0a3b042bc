"""Writers.  The batch writers are idempotent: writing a batch again replaces what it wrote before."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, functions as F, types as T
from pyspark.sql.streaming.query import StreamingQuery

from tideline.functions.times import local
from tideline.operators.cdc import DELETE


# ---- messages -------------------------------------------------------------

def to_messages(df: DataFrame, key: Sequence[str] | None = None, hidden: Sequence[str] = ()) -> DataFrame:
    """Rows as JSON messages, with a JSON ``key`` column for an upsert topic.

    ``hidden`` columns stay out of the message; null fields are left out.
    """
    body = F.to_json(F.struct(*[c for c in df.columns if c not in hidden])).alias("value")
    if key:
        return df.select(F.to_json(F.struct(*key)).alias("key"), body)
    return df.select(body)


def snake_messages(df: DataFrame, hidden: Sequence[str] = ()) -> DataFrame:
    """As :func:`to_messages` with snake-case field names, the form of the metric sinks."""
    from tideline.sources.readers import snake_columns

    return to_messages(snake_columns(df.drop(*hidden)))


def write_messages(messages: DataFrame, kind: str, target: Mapping[str, str]) -> None:
    """Send a batch of messages: ``kafka`` with its options, or ``text`` with a ``path``."""
    if kind == "kafka":
        safe = {"kafka.acks": "all", "kafka.enable.idempotence": "true"}
        messages.write.format("kafka").options(**{**safe, **target}).save()
    else:
        messages.select("value").write.format(kind).mode("overwrite").save(target["path"])


# ---- batch tables ---------------------------------------------------------

class BatchTable:
    """A Parquet table written by micro-batch: one folder per batch id.

    A batch that runs again after a failure replaces its own folder, and
    readers inside batch ``n`` see only batches before ``n``, so a repeated
    batch finds the same history.
    """

    def __init__(self, spark: SparkSession, path: str, compression: str | None = None):
        self.spark = spark
        self.path = path
        self.compression = compression

    def write(self, df: DataFrame, batch_id: int, partition_by: Sequence[str] = (), part: int | None = None) -> None:
        """Write a batch, or its ``part``, the column of that name for readers; this replaces what it wrote before."""
        writer: DataFrameWriter = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.path}/batch={batch_id}" + ("" if part is None else f"/part={part}"), compression=self.compression)

    def exists(self) -> bool:
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        return hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)

    def read(self, schema: T.StructType, before: int | None = None) -> DataFrame:
        """All rows with their ``batch``; no rows when nothing was written yet."""
        full = T.StructType([f for f in schema.fields if f.name != "batch"] + [T.StructField("batch", T.LongType())])
        if not self.exists():
            return self.spark.createDataFrame([], full)
        df = self.spark.read.schema(full).parquet(self.path)
        return df if before is None else df.where(F.col("batch") < before)

    def compact_into(self, other: "BatchTable", rows: DataFrame) -> None:
        """Start a new table whose batch 0 is the already merged ``rows`` of this one."""
        other.write(rows, 0)


class WindowTable(BatchTable):
    """A keyed table by window: a batch writes what lies around its windows anew, and nothing else.

    ``window`` is a text column, ``keys`` tell the rows of a window apart.
    Windows with equal first ``prefix`` characters (a month, for bounds of the
    usual form) share a part of the table, the unit that is rewritten.  Readers
    take each part from the last batch that wrote it.  A batch that runs again,
    or rows that arrive again, leave the same table.
    """

    PART = "part"

    def __init__(self, spark: SparkSession, path: str, window: str, keys: Sequence[str], prefix: int = 7):
        super().__init__(spark, path)
        self.window, self.keys, self.prefix = window, list(keys), prefix

    def _stored(self, schema: T.StructType, before: int | None = None) -> DataFrame:
        return self.read(T.StructType([*schema.fields, T.StructField(self.PART, T.StringType())]), before)

    def current(self, schema: T.StructType, before: int | None = None) -> DataFrame:
        """The rows as they are, or as they were before a batch."""
        return self._newest(self._stored(schema, before)).select(*schema.names)

    def _newest(self, rows: DataFrame) -> DataFrame:
        # Both are partition columns: no file is read for them.
        last = rows.groupBy(self.PART).agg(F.max("batch").alias("_last"))
        return rows.join(last, self.PART).where(F.col("batch") == F.col("_last"))

    def touched(self, df: DataFrame, batch_id: int, schema: T.StructType | None = None) -> DataFrame:
        """What the parts that ``df`` has rows for held before the batch."""
        schema = schema or df.schema
        parts = df.select(F.substring(self.window, 1, self.prefix).alias(self.PART)).distinct()
        return self._newest(self._stored(schema, batch_id)).join(parts, self.PART, "left_semi").select(*schema.names)

    def upsert(self, df: DataFrame, batch_id: int) -> None:
        """Replace the rows with the keys of ``df``, keep the others."""
        kept = self.touched(df, batch_id).join(df, [self.window, *self.keys], "left_anti")
        rows = kept.select(*df.columns).unionByName(df).withColumn(self.PART, F.substring(self.window, 1, self.prefix))
        # A few files for each part; AQE cuts a large one.
        self.write(rows.hint("rebalance", self.PART), batch_id, [self.PART])

    def written(self, schema: T.StructType, batch_id: int) -> DataFrame:
        """The parts that a batch wrote."""
        return self._stored(schema).where(F.col("batch") == batch_id).select(*schema.names)


def newest_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ("batch",), op: str | None = None) -> DataFrame:
    """Upsert view of a batch table: the last row per key, deleted keys left out."""
    from tideline.operators.keyed import latest_per_key

    latest = latest_per_key(df, list(keys), list(order))
    return latest if op is None else latest.where(F.col(op) != DELETE)


def write_partitioned(df: DataFrame, path: str, by: str = "sink_table", batch_id: int = 0) -> None:
    """Route rows to the folder of the target named in each row, within the folder of the batch.

    Earlier batches stay, and a batch that runs again replaces its own rows.
    Rows of one target stay spread over their tasks, so a busy target has many
    files instead of one slow writer.
    """
    BatchTable(df.sparkSession, path).write(df, batch_id, [by])


def land_changes(changes: DataFrame, path: str, batch_id: int, tz: str = "UTC") -> None:
    """Store change records by source table and day.

    A table name inside a map cannot be pushed to a scan; as a partition column
    ``source_table`` lets a job read the changes of its tables alone.
    """
    rows = changes.withColumns({
        "source_table": F.col("source")["table"],
        "day": F.to_date(local(F.timestamp_millis("ts_ms"), tz)),
    })
    BatchTable(changes.sparkSession, path).write(rows, batch_id, ["source_table", "day"])


def write_kinds(kinds: Mapping[str, DataFrame], path: str, batch_id: int) -> None:
    """Write several outputs of one input, each to its own folder."""
    for name, df in kinds.items():
        BatchTable(df.sparkSession, f"{path}/{name}").write(df, batch_id)


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str], mode: str = "append", retries: int = 3) -> None:
    """Load a batch into a database table, trying again on failure (at least once)."""
    for attempt in range(retries + 1):
        try:
            df.write.jdbc(url, table, mode=mode, properties=dict(properties))
            return
        except Exception:
            if attempt == retries:
                raise


# ---- catalog --------------------------------------------------------------

def apply_table_config(
    config: DataFrame, database: str, location: str | None = None, order: Sequence[str] = ()
) -> list[str]:
    """Create, drop or recreate sink tables for changed configuration rows.

    New and snapshot rows create the table, deletes drop it, updates do both.
    The rows of a sink table count in ``order``: its last one decides whether
    the table exists and its columns, and an earlier delete or update empties
    it.  Every column is a string.  Each created table has a folder of its own
    under ``location``, so it does not find the files of one it replaces.
    Statements run on the driver, one sink table at a time.
    """
    spark = config.sparkSession
    when = F.struct(*[F.col(c) for c in order]) if order else F.lit(0)
    last = config.groupBy("sink_table").agg(
        F.max_by(F.struct("sink_columns", "op"), when).alias("last"),
        F.bool_or(F.col("op").isin("d", "u")).alias("anew"),
    )
    done = []
    for row in last.orderBy("sink_table").toLocalIterator():
        name = f"`{database}`.`{row.sink_table}`"
        if row.anew:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            done.append(f"drop {row.sink_table}")
        if row.last.op in ("r", "c", "u"):
            columns = ", ".join(f"`{c.strip()}` STRING" for c in row.last.sink_columns.split(","))
            where = f" LOCATION '{location}/{row.sink_table}-{uuid.uuid4().hex}'" if location else ""
            spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{where}")
            done.append(f"create {row.sink_table}")
    return done


# ---- debugging ------------------------------------------------------------

def print_rows(df: DataFrame, rows: int = 20) -> StreamingQuery | None:
    """Show a batch, or start a console query on a stream."""
    if df.isStreaming:
        return df.writeStream.format("console").option("truncate", "false").option("numRows", rows).start()
    df.show(rows, truncate=False)
    return None
