"""Shared helpers: bounded Arrow batches, tables kept in the shared folder, result columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tideline.session import new_folder

#: Bytes and rows of one Arrow batch on its way to a Python worker.  One longer text makes a batch of its own.
BATCH_BYTES = 4 << 20
BATCH_ROWS = 4096


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Bound what a Python worker holds at once, whatever the length of the texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again.

    Cuts the lineage; a lost executor does not take the rows with it, and
    values such as row numbers cannot change between two uses.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def replace(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add result columns; input columns of the same name (in any case) give way."""
    taken = {c.lower() for c in columns}
    return df.select(
        *[df[f"`{c}`"] for c in df.columns if c.lower() not in taken],
        *[column.alias(name) for name, column in columns.items()],
    )


def free_name(df: DataFrame, wish: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def without(schema: T.StructType, names: list[str]) -> T.StructType:
    taken = {n.lower() for n in names}
    return T.StructType([f for f in schema.fields if f.name.lower() not in taken])


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learnt: crc32 of the id as text is divisible by 5 (a null id counts as '')."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0
