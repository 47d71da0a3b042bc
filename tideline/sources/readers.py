"""Readers.  Endpoints, topics and credentials always come from the caller."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tideline.operators.cdc import parse_once


# ---- topics ---------------------------------------------------------------

def topic_options(servers: str, topics: str, start: str = "earliest", extra: Mapping[str, str] | None = None) -> dict[str, str]:
    """Options of a topic read.

    ``start`` is ``earliest``, ``latest`` or a JSON map of offsets.  Committed
    positions are kept by the checkpoint, which wins over ``start`` on restart.
    Lost offsets fail the job unless ``extra`` says otherwise.
    """
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topics,
        "startingOffsets": start,
        "failOnDataLoss": "true",
        **(extra or {}),
    }


def read_topic(spark: SparkSession, options: Mapping[str, str], streaming: bool = True) -> DataFrame:
    """Message text of a topic.  Needs the Kafka connector on the class path."""
    reader = spark.readStream if streaming else spark.read
    return message_text(reader.format("kafka").options(**options).load())


def message_text(df: DataFrame, value: str = "value") -> DataFrame:
    """Payload as text under ``value``; null payloads are dropped."""
    return df.select(F.col(value).cast("string").alias("value")).where(F.col("value").isNotNull())


def read_files(
    spark: SparkSession, folder: str, schema: T.StructType | str, pattern: str | None = None, kind: str = "parquet",
    streaming: bool = True, max_files: int | None = None, options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A folder of files, as a table or as a stream of the files that arrive in it."""
    reader = (spark.readStream if streaming else spark.read).format(kind)
    if kind != "text":
        reader = reader.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if streaming and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.options(**(options or {})).load(folder)


# ---- declared tables ------------------------------------------------------

def json_table(messages: DataFrame, schema: T.StructType, name: str | None = None, value: str = "value") -> DataFrame:
    """Messages as a table with declared columns; unreadable messages are skipped.

    With ``name`` the table is also registered as a temporary view.
    """
    # PERMISSIVE parsing keeps a bad message as text, which marks it.
    marked = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    table = parse_once(messages.select(value), value, marked, options).where(F.col("_bad").isNull()).drop("_bad")
    if name:
        table.createOrReplaceTempView(name)
    return table


def initial_then_changes(snapshot: DataFrame, changes: DataFrame, taken: Column | None = None) -> DataFrame:
    """Snapshot records and changes of a table as one feed with the column ``seq`` to order it by.

    A snapshot row counts as of the time it was ``taken`` (its own ``ts_ms`` by
    default), before a change of the same instant, so an older change never
    overwrites it.  Works on batches, and on streams where both sides are.
    """
    at = F.col("ts_ms") if taken is None else taken
    first = snapshot.withColumn("seq", F.struct(at.alias("at"), F.lit(0).alias("part")))
    later = changes.withColumn("seq", F.struct(F.col("ts_ms").alias("at"), F.lit(1).alias("part")))
    return first.unionByName(later)


# ---- bounded tables -------------------------------------------------------

def read_jdbc(
    spark: SparkSession, url: str, table: str, properties: Mapping[str, str] | None = None,
    partition_column: str | None = None, lower: str | None = None, upper: str | None = None, partitions: int = 8,
    camel_to_snake: bool = False,
) -> DataFrame:
    """A database table or ``(query) alias``.  Give a partition column to read it in parallel."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**(properties or {}))
    if partition_column:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=lower, upperBound=upper, numPartitions=partitions
        )
    df = reader.load()
    return snake_columns(df) if camel_to_snake else df


def snake_columns(df: DataFrame) -> DataFrame:
    """Column names in snake case."""
    def snake(name: str) -> str:
        return "".join(f"_{c.lower()}" if c.isupper() and i else c.lower() for i, c in enumerate(name))

    return df.toDF(*[snake(c) for c in df.columns])


def read_dimension(spark: SparkSession, path: str, columns: Sequence[str], kind: str = "parquet") -> DataFrame:
    """Columns of a stored dimension, every one a string as in a wide-column store."""
    df = spark.read.format(kind).load(path)
    return df.select(*[F.col(c).cast("string").alias(c) for c in columns])


def first_rows(df: DataFrame, limit: int, row_key: str | None = None) -> DataFrame:
    """First ``limit`` rows in row-key order, or any rows without a key."""
    return df.orderBy(row_key).limit(limit) if row_key else df.limit(limit)


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """Word list from a text file, one word per line; blank lines and repeats are dropped."""
    lines = spark.read.text(path).select(F.trim("value").alias("word"))
    return lines.where("word <> ''").distinct()
