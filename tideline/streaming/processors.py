"""Keyed state with ``transformWithState``.

Rows of a key reach a processor in any order within a micro-batch and in many
chunks.  The processors here keep one candidate row per calendar day while
they read, so their memory grows with the days in a batch and not with its
rows.
"""

from __future__ import annotations

import datetime
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Processors travel with the job, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_STATE = T.StructType([T.StructField("day", T.DateType())])


def _first_of_days(rows: Iterator[pd.DataFrame], order: list[str]) -> pd.DataFrame:
    """Earliest row of each ``visit_date`` over all chunks."""
    best: pd.DataFrame | None = None
    for chunk in rows:
        pool = chunk if best is None else pd.concat([best, chunk])
        best = pool.sort_values(order, kind="stable").drop_duplicates("visit_date")
    return best.sort_values("visit_date") if best is not None else pd.DataFrame()


class _DayState(StatefulProcessor):
    def __init__(self, order: list[str], ttl_ms: int | None = None):
        self.order = order
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = (
            handle.getValueState("last_day", _STATE, self.ttl_ms)
            if self.ttl_ms
            else handle.getValueState("last_day", _STATE)
        )

    def _known(self):
        return self.last.get()[0] if self.last.exists() else None

    def close(self) -> None:
        pass


class DailyUnique(_DayState):
    """Emit the first row of a key on each day that differs from the last one seen."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        firsts = _first_of_days(rows, self.order)
        if firsts.empty:
            return
        known = self._known()
        fresh = firsts if known is None else firsts[firsts["visit_date"] != known]
        self.last.update((firsts["visit_date"].iloc[-1],))
        if not fresh.empty:
            yield fresh


class ReturningUser(_DayState):
    """Emit the first row of a user on each new day, with ``back_ct`` after a gap of days."""

    def __init__(self, order: list[str], gap_days: int = 8):
        super().__init__(order)
        self.gap_days = gap_days

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        firsts = _first_of_days(rows, self.order)
        if firsts.empty:
            return
        known = self._known()
        fresh = firsts if known is None else firsts[firsts["visit_date"] != known]
        self.last.update((firsts["visit_date"].iloc[-1],))
        if fresh.empty:
            return
        days = pd.to_datetime(fresh["visit_date"])
        before = days.shift(1)
        if known is not None:
            before.iloc[0] = pd.Timestamp(known)
        gap = (days - before).dt.days
        yield fresh.assign(uu_ct=1, back_ct=(gap >= self.gap_days).astype("int64"))


class FirstRow(StatefulProcessor):
    """Emit the first row of a key that was never seen before; the state is one flag."""

    def __init__(self, order: list[str], ttl_ms: int | None = None):
        self.order = order
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        args = (self.ttl_ms,) if self.ttl_ms else ()
        self.seen = handle.getValueState("seen", T.StructType([T.StructField("yes", T.BooleanType())]), *args)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if self.seen.exists():
            return
        best: pd.DataFrame | None = None
        for chunk in rows:
            pool = chunk if best is None else pd.concat([best, chunk])
            best = pool.sort_values(self.order, kind="stable").head(1)
        if best is not None and not best.empty:
            self.seen.update((True,))
            yield best

    def close(self) -> None:
        pass


def _thin(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the first row per key of every Arrow batch: a combiner ahead of the shuffle.

    A key with a large share of the rows then sends a few rows per task.
    """
    def firsts(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in chunks:
            yield chunk.sort_values(order, kind="stable").drop_duplicates(keys)

    return df.mapInPandas(firsts, df.schema)


def first_row_stream(df: DataFrame, keys: list[str], order: list[str], ttl_ms: int | None = None) -> DataFrame:
    """Earliest row of each key among the first rows that arrive of it, by one flag of state per key."""
    return _thin(df, keys, order).groupBy(*keys).transformWithStateInPandas(
        FirstRow(order, ttl_ms), df.schema, "Append", "ProcessingTime" if ttl_ms else "None"
    )


def daily_unique_stream(df: DataFrame, key: str, order: list[str], ttl_ms: int | None = None) -> DataFrame:
    """``df`` carries ``visit_date``.  A ``ttl_ms`` forgets a key that long after its last row, by processing time."""
    return _thin(df, [key, "visit_date"], order).groupBy(key).transformWithStateInPandas(
        DailyUnique(order, ttl_ms), df.schema, "Append", "ProcessingTime" if ttl_ms else "None"
    )


def returning_user_stream(df: DataFrame, key: str, order: list[str], gap_days: int = 8) -> DataFrame:
    schema = T.StructType(df.schema.fields + [
        T.StructField("uu_ct", T.LongType()), T.StructField("back_ct", T.LongType())
    ])
    return _thin(df, [key, "visit_date"], order).groupBy(key).transformWithStateInPandas(
        ReturningUser(order, gap_days), schema, "Append", "None"
    )


def first_rows(df: DataFrame, keys: list, order: list[str]) -> DataFrame:
    """Earliest row of each key so far, as native aggregate state, combined ahead of the shuffle.

    For update mode: each batch gives the keys it has rows of, and over several
    batches the earliest row of a key is the result.  With a watermark on a
    time window among the ``keys`` the state of a window ends with it.
    """
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return first.select(*[c for c in df.columns if c in keys], *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*df.columns)


class VisitorRepair(StatefulProcessor):
    """Correct a claimed new-visitor flag by the first day of the visitor, which is the whole state.

    The rows of a visitor not seen before wait for the first of them within
    the batch; those of a known one pass through chunk by chunk.
    """

    def __init__(self, order: list[str], flag: str):
        self.order, self.flag = order, flag

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first_day", _STATE)

    def _repaired(self, chunk: pd.DataFrame, first_day) -> pd.DataFrame:
        wrong = (chunk[self.flag] == "1") & (chunk["visit_date"] != first_day)
        return chunk.assign(**{self.flag: chunk[self.flag].mask(wrong, "0")})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if not self.first.exists():
            waiting = [chunk for chunk in rows if len(chunk)]
            if not waiting:
                return
            best = pd.concat([c.sort_values(self.order, kind="stable").head(1) for c in waiting])
            row = best.sort_values(self.order, kind="stable").iloc[0]
            day = row["visit_date"]
            self.first.update((day if row[self.flag] == "1" else day - datetime.timedelta(days=1),))
            rows = waiting
        first_day = self.first.get()[0]
        for chunk in rows:
            if len(chunk):
                yield self._repaired(chunk, first_day)

    def close(self) -> None:
        pass


class RunningProfile(StatefulProcessor):
    """Running row count and distinct values of a key, with one map entry for each value of a set.

    The rows of a key within a batch are sorted in memory; the batch size
    bounds them.
    """

    def __init__(self, order: list[str], sets: list[str], count: str):
        self.order, self.sets, self.count = order, sets, count

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", T.StructType([T.StructField("n", T.LongType())]))
        self.known = {
            s: handle.getMapState(
                f"values_{s}", T.StructType([T.StructField("v", T.StringType())]), T.StructType([T.StructField("yes", T.BooleanType())]))
            for s in self.sets
        }

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        chunks = [chunk for chunk in rows if len(chunk)]
        if not chunks:
            return
        batch = pd.concat(chunks).sort_values(self.order, kind="stable")
        n = self.total.get()[0] if self.total.exists() else 0
        out = {self.count: range(n + 1, n + 1 + len(batch))}
        self.total.update((n + len(batch),))
        for s in self.sets:
            values = {k[0] for k in self.known[s].keys()}
            text, texts = ",".join(sorted(values)), []
            for v in batch[s].tolist():
                if v is not None and v not in values:
                    values.add(v)
                    self.known[s].updateValue((v,), (True,))
                    text = ",".join(sorted(values))
                texts.append(text)
            out[s] = texts
        yield batch.assign(**out)

    def close(self) -> None:
        pass


def visitor_repair_stream(df: DataFrame, key: str, order: list[str], flag: str) -> DataFrame:
    """As :func:`tideline.operators.keyed.repair_new_visitors`; ``df`` carries ``visit_date``."""
    return df.groupBy(key).transformWithStateInPandas(VisitorRepair(order, flag), df.schema, "Append", "None")


def running_profile_stream(df: DataFrame, key: str, order: list[str], sets: list[str], count: str = "pv") -> DataFrame:
    """As :func:`tideline.operators.keyed.running_profile`, in comma lists."""
    schema = T.StructType([*df.schema.fields, T.StructField(count, T.LongType())])
    return df.groupBy(key).transformWithStateInPandas(RunningProfile(order, sets, count), schema, "Append", "None")
