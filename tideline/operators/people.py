"""User records and the age-label job: profile, order, search and topic brought together and scored."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tideline.functions import labels
from tideline.operators.cdc import of_table, row_image
from tideline.operators.joins import interval_join
from tideline.operators.keyed import first_per_key

MINUTE = 60_000
DAY = 86_400_000


def comment_records(changes: DataFrame, table: str = "comment_info") -> DataFrame:
    """Comments with the origin of their change; deletes carry no comment."""
    after = F.col("after")
    return of_table(changes, table).where(after.isNotNull()).select(
        "ts_ms",
        F.col("source")["db"].alias("db"),
        F.col("source")["table"].alias("table"),
        F.col("source")["server_id"].alias("server_id"),
        "op",
        after["appraise"].alias("appraise"),
        after["comment_txt"].alias("commentTxt"),
        after["nick_name"].alias("nick_name"),
        *[after[c].try_cast("bigint").alias(c) for c in ("create_time", "user_id", "sku_id", "id", "spu_id", "order_id")],
    )


def order_records(changes: DataFrame, columns: list[str], table: str = "order_info") -> DataFrame:
    """Order rows, old image when there is no new one, with ``op`` and ``tm_ms``."""
    image = row_image()
    return of_table(changes, table).select(
        "op", F.col("ts_ms").alias("tm_ms"), *[image[c].alias(c) for c in columns]
    )


def user_records(changes: DataFrame, as_of: Column, table: str = "user_info") -> DataFrame:
    """Users with their calendar labels; only the first record of each user counts."""
    after = F.col("after")
    rows = of_table(changes, table).where(after.isNotNull()).select(
        after["id"].try_cast("bigint").alias("uid"),
        *[after[c].alias(c) for c in ("login_name", "name", "gender", "create_time")],
        after["user_level"].try_cast("int").alias("user_level"),
        after["birthday"].try_cast("int").alias("birthday"),
        "ts_ms",
    )
    return labels.user_labels(first_per_key(rows, ["uid"], ["ts_ms"]), "birthday", as_of)


def body_records(changes: DataFrame, table: str = "user_info_sup_msg") -> DataFrame:
    after = F.col("after")
    return of_table(changes, table).where(after.isNotNull()).select(
        after["uid"].try_cast("bigint").alias("uid"),
        after["height"].try_cast("int").alias("height"),
        after["unit_height"].alias("unit_height"),
        after["weight"].try_cast("int").alias("weight"),
        after["unit_weight"].alias("unit_weight"),
        F.col("ts_ms").alias("body_ms"),
    )


def profiles(
    users: DataFrame, bodies: DataFrame, within_ms: int = MINUTE, hot: Sequence = ()
) -> DataFrame:
    """Users with the body measures recorded within a minute of them."""
    return interval_join(
        users, bodies, ["uid"], "ts_ms", "body_ms", -within_ms, within_ms, ["login_name"], hot
    ).drop("body_ms")


def profiled_orders(
    people: DataFrame, orders: DataFrame, within_ms: int = MINUTE // 2, hot: Sequence = ()
) -> DataFrame:
    """Profiles and the orders within half a minute of them.

    ``orders`` has ``uid, order_ms, create_ms, original_total_amount`` and the
    category and brand names.
    """
    return interval_join(
        orders, people, ["uid"], "order_ms", "ts_ms", -within_ms, within_ms, ["create_ms", "order_id"], hot
    )


def searched_orders(
    orders: DataFrame, searches: DataFrame, within_ms: int = 60 * MINUTE, hot: Sequence = (),
) -> DataFrame:
    """Order records and the searches ``(uid, search_ms, os, keyword)`` of the user within an hour."""
    return interval_join(
        orders, searches, ["uid"], "order_ms", "search_ms", -within_ms, within_ms, ["order_id", "ts_ms"],
        hot,
    )


def with_topic(
    orders: DataFrame, topics: DataFrame, within_ms: int = 3 * DAY, hot: Sequence = (),
) -> DataFrame:
    """Add the topic of the search word from dictionary changes ``(keyword, topic_ms, keyword_type)``."""
    return interval_join(
        orders, topics.where(F.col("keyword_type").isNotNull()), ["keyword"], "order_ms", "topic_ms",
        -within_ms, within_ms, ["order_id", "search_ms"], hot,
    )


def scored(orders: DataFrame, group: str | None = labels.AGE_GROUPS[0]) -> DataFrame:
    """Bands, partial scores and total of the records of one age group (all with ``group=None``)."""
    banded = labels.order_bands(orders, "create_ms", "original_total_amount")
    chosen = banded if group is None else banded.where(F.col("age_group") == group)
    return labels.total_score(labels.age_scores(chosen))


def age_label_job(
    people: DataFrame, orders: DataFrame, searches: DataFrame, topics: DataFrame,
    group: str | None = labels.AGE_GROUPS[0], profile_ms: int = MINUTE // 2, search_ms: int = 60 * MINUTE,
    topic_ms: int = 3 * DAY, hot: Sequence = (),
) -> DataFrame:
    """The whole chain from profiles to scored label records.

    The age group is known from the start, so other groups are filtered before
    the joins instead of after them.
    """
    wanted = people if group is None else people.where(F.col("age_group") == group)
    found = profiled_orders(wanted, orders, profile_ms, hot)
    found = searched_orders(found, searches, search_ms, hot)
    return scored(with_topic(found, topics, topic_ms), group)
