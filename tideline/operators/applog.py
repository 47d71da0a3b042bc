"""Application log: parsing, splitting into its five record kinds, and device records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tideline.functions.text import first_token
from tideline.operators.cdc import parse_once
from tideline.schemas import APP_LOG

KINDS = ("page", "err", "start", "display", "action")


def parse_log(df: DataFrame, value: str = "value") -> DataFrame:
    """Log text to its columns; ``dirty`` keeps the text of a record that cannot be read."""
    parsed = parse_once(df.withColumn("_text", F.col(value).cast("string")), value, APP_LOG)
    # A readable record has at least one of its parts, an unreadable one none.
    readable = F.coalesce(*[F.when(F.col(f.name).isNotNull(), True) for f in APP_LOG.fields], F.lit(False))
    return parsed.withColumn("dirty", F.when(~readable, F.col("_text"))).drop("_text")


def clean(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("dirty").isNull()).drop("dirty")


def dirty(parsed: DataFrame) -> DataFrame:
    """Unreadable records, for the dirty output."""
    rest = [c for c in parsed.columns if c not in [f.name for f in APP_LOG.fields] + ["dirty"]]
    return parsed.where(F.col("dirty").isNotNull()).select(*rest, F.col("dirty").alias("value"))


def _is_start() -> Column:
    return F.col("start").isNotNull()


def split_log(log: DataFrame, keep: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """The five record kinds of a log, ``keep`` columns carried along.

    A record with an error always gives an error row.  A start record gives a
    start row; any other gives a page row and one row per display and action.
    Display rows carry the time, action rows do not.
    """
    pages = log.where(~_is_start())
    # A missing array and an empty one both give no row.
    displays = pages.withColumn("display", F.explode("displays"))
    actions = pages.withColumn("action", F.explode("actions"))
    return {
        "page": pages.select(*keep, "common", "page", "ts"),
        "err": log.where(F.col("err").isNotNull()),
        "start": log.where(_is_start()).drop("err"),
        "display": displays.select(*keep, "common", "page", "display", "ts"),
        "action": actions.select(*keep, "common", "page", "action"),
    }


def _search_item() -> Column:
    return F.when(F.col("page.item_type") == "keyword", F.col("page.item"))


def search_log(log: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``uid, ts, os, keyword`` of a page log; the system without its version."""
    return log.where(F.col("common").isNotNull()).select(
        *keep,
        F.col("common.uid").alias("uid"),
        "ts",
        first_token(F.col("common.os")).alias("os"),
        _search_item().alias("keyword"),
    )


def with_user_and_keyword(search: DataFrame) -> DataFrame:
    return search.where(F.col("uid").isNotNull() & (F.col("keyword") != ""))


def device_log(log: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Device record of a page log: user (``-1`` when unknown), device fields and search item."""
    return log.where(F.col("common").isNotNull()).select(
        *keep,
        F.coalesce("common.uid", F.lit("-1")).alias("uid"),
        "ts",
        first_token(F.col("common.os")).alias("os"),
        *[F.col(f"common.{c}").alias(c) for c in ("ar", "ch", "md", "vc", "ba")],
        _search_item().alias("search_item"),
    )
