"""Interval join of two streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tideline.streaming.runner import bounded_delay


def _seconds(ms: int) -> Column:
    return F.expr(f"INTERVAL '{ms / 1000:.3f}' SECOND")


def interval_join_stream(
    left: DataFrame,
    right: DataFrame,
    on: str,
    left_ts: str,
    right_ts: str,
    lower_ms: int,
    upper_ms: int,
    delay: str | None = "3 seconds",
    hot: Sequence = (),
    salts: int = 16,
    spread: Sequence[str] = (),
    how: str = "inner",
    right_delay: str = "3 seconds",
) -> DataFrame:
    """Pairs with equal ``on`` and ``lower_ms <= right - left <= upper_ms``, both ends included.

    The two watermarks bound the state; without ``delay`` the left side already
    has one, as the result of a join has.  With ``how="left"`` a left row
    without a partner comes out once the watermark has passed its interval; a
    partner that is late by more than its delay is dropped.  AQE does not split the
    partitions of a stream, so known ``hot`` keys are given; their left rows are spread over ``salts`` by
    ``spread`` and their right rows are repeated.
    """
    early = left if delay is None else bounded_delay(left, left_ts, delay)
    late = bounded_delay(right, right_ts, delay or right_delay)

    def is_hot(key: str) -> Column:
        return F.col(key).isin(*hot) if hot else F.lit(False)

    salt = F.when(is_hot(on), F.pmod(F.xxhash64(*(spread or [left_ts])), F.lit(salts))).otherwise(0)
    early = early.withColumn("_salt", salt.cast("int"))
    last = F.when(is_hot("_on"), salts - 1).otherwise(0)
    late = late.withColumnRenamed(on, "_on").withColumn("_copy", F.explode(F.sequence(F.lit(0), last)))
    near = (
        (F.col(on) == F.col("_on"))
        & (F.col("_salt") == F.col("_copy"))
        & (F.col(right_ts) >= F.col(left_ts) + _seconds(lower_ms))
        & (F.col(right_ts) <= F.col(left_ts) + _seconds(upper_ms))
    )
    return early.join(late, near, how).drop("_on", "_salt", "_copy")
