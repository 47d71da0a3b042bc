"""Fact tables of the trade and interaction domains."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tideline.functions.text import md5_key
from tideline.functions.times import compact_date_text, date_text, datetime_text, from_millis
from tideline.operators.joins import interval_join, lookup, salted_join, salted_joins

AMOUNT = "decimal(16,2)"


def line_amount(quantity: str | Column, price: str | Column) -> Column:
    """Quantity times price in exact decimals; unreadable text gives null."""
    q, p = (F.col(x) if isinstance(x, str) else x for x in (quantity, price))
    return q.try_cast(AMOUNT) * p.try_cast(AMOUNT)


def cart_adds(changes: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Additions to the cart with their quantity, from changes of the cart table.

    New and snapshot rows count, and updates that raise the number.  The
    quantity is the new number for a new row and otherwise the difference,
    which is null for a snapshot row because it has no old number.
    """
    now = F.col("after")["sku_num"].try_cast("int")
    was = F.col("before")["sku_num"].try_cast("int")
    op = F.col("op")
    added = op.isin("c", "r") | ((op == "u") & (now > was))
    return changes.where(added).select(
        *keep,
        *[F.col("after")[c].alias(c) for c in ("id", "user_id", "sku_id")],
        F.when(op == "c", F.col("after")["sku_num"]).otherwise((now - was).cast("string")).alias("sku_num"),
        "ts_ms",
    )


def order_details(
    details: DataFrame, orders: DataFrame, activities: DataFrame, coupons: DataFrame,
    hot: Sequence = (),
) -> DataFrame:
    """Order lines with their order, and activity and coupon where there is one.

    ``details`` has ``id, order_id, sku_id, create_ms``; ``orders`` has ``order_id,
    user_id, province_id``; ``activities`` and ``coupons`` are keyed by ``id``
    of the line.  ``hot`` names order ids to salt.
    """
    joined = salted_join(details, orders, ["order_id"], "inner", ["id", "create_ms"], hot)
    joined = salted_joins(joined, [(activities, "left"), (coupons, "left")], ["id"])
    return joined.withColumn("date_id", date_text(from_millis(F.col("create_ms"))))


def cancelled_details(
    details: DataFrame, orders: DataFrame, status: str | None = None, hot: Sequence = (),
) -> DataFrame:
    """Lines of changed orders with the time of the change.

    ``orders`` has ``order_id, order_status, operate_ms``.  Every order change
    counts unless ``status`` names the one that means cancelled.
    """
    events = orders if status is None else orders.where(F.col("order_status") == status)
    when = from_millis(F.col("operate_ms"))
    events = events.select(
        "order_id", date_text(when).alias("order_cancel_date_id"), datetime_text(when).alias("cancel_time")
    )
    return salted_join(details, events, ["order_id"], "inner", ["id", "sku_id"], hot)


def paid_details(
    payments: DataFrame, details: DataFrame, dictionary: DataFrame, before_ms: int = 30 * 60_000,
    after_ms: int = 5_000, hot: Sequence = (),
) -> DataFrame:
    """Order lines from 30 minutes before to 5 seconds after the payment of their order.

    ``payments`` has ``order_id, payment_type_code, pay_ms``; ``details`` has
    ``order_id, sku_id, detail_ms``; ``dictionary`` has ``dic_code, dic_name``.
    Payments of an unknown type are dropped.
    """
    paid = interval_join(
        details, payments, ["order_id"], "detail_ms", "pay_ms", -after_ms, before_ms, ["detail_ms", "sku_id"],
        hot,
    )
    return lookup(paid, dictionary, "payment_type_code", "dic_code", {"dic_name": "payment_type_name"}, "inner")


def refunds(
    requests: DataFrame, orders: DataFrame, dictionary: DataFrame, hot: Sequence = ()
) -> DataFrame:
    """Refund requests with the names of their type and reason.

    The dictionary is looked up twice under two names.
    """
    joined = salted_join(requests, orders, ["order_id"], "inner", ["id", "sku_id"], hot)
    joined = lookup(joined, dictionary, "refund_type", "dic_code", {"dic_name": "refund_type_name"}, "inner")
    return lookup(
        joined, dictionary, "refund_reason_type", "dic_code", {"dic_name": "refund_reason_type_name"}, "inner"
    )


def paid_refunds(
    payments: DataFrame, requests: DataFrame, orders: DataFrame, dictionary: DataFrame,
    hot: Sequence = (),
) -> DataFrame:
    """Refund payments matched to their request by order and product, then to the order."""
    joined = payments.join(requests, ["order_id", "sku_id"])
    joined = salted_join(joined, orders, ["order_id"], "inner", ["id", "callback_ms"], hot)
    joined = lookup(joined, dictionary, "payment_type_code", "dic_code", {"dic_name": "payment_type_name"}, "inner")
    when = from_millis(F.col("callback_ms"))
    return joined.withColumn("date_id", date_text(when)).withColumn("callback_time", datetime_text(when))


def named_comments(comments: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Comments with the name of their rating; an unknown rating keeps the comment."""
    return lookup(comments, dictionary, "appraise", "dic_code", {"dic_name": "appraise_name"}, "left")


def rated_comments(comments: DataFrame, hashed_dictionary: DataFrame, default: str = "N/A") -> DataFrame:
    """As :func:`named_comments`, for a dictionary stored under md5 row keys, with a default name."""
    keyed = comments.withColumn("_row_key", md5_key(F.col("appraise")))
    return lookup(keyed, hashed_dictionary, "_row_key", "row_key", {"dic_name": "dic_name"}, "left", default).drop(
        "_row_key"
    )


def comments_with_orders(
    comments: DataFrame, orders: DataFrame, within_ms: int = 60_000, hot: Sequence = ()
) -> DataFrame:
    """Comments and the order changes up to a minute around them, order fields prefixed ``info_``.

    ``comments`` has ``order_id, ts_ms``; ``orders`` has ``id, tm_ms``.
    """
    info = orders.select(F.col("id").alias("order_id"), *[F.col(c).alias(f"info_{c}") for c in orders.columns])
    pairs = interval_join(
        comments, info, ["order_id"], "ts_ms", "info_tm_ms", -within_ms, within_ms, ["id"], hot
    )
    return pairs.withColumn("ds", compact_date_text(from_millis(F.col("ts_ms"))))
