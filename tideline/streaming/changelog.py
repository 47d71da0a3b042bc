"""Changelogs: incremental joins, and retraction within a time limit, with keyed state.

A changelog is a table of rows with ``row_kind``: ``+`` adds the row, ``-``
takes one like it back.  Folding it gives the rows that a batch join of all
input would.

Payloads travel through the state as JSON text, made and read by Spark, so the
processors move text and do not depend on the columns.  The state of a key is
touched only by batches that have rows of it.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Callable, Iterator, Mapping, Sequence
from itertools import islice
from operator import itemgetter

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Processors travel with the job, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a key that are sorted at once.
CHUNK = 10_000
_RANK = {"header": 0, "line": 2}
_CHANGE = Row("row_kind", "payload")

_TEXT = T.StructType([T.StructField("v", T.StringType())])
_VERSION = T.StructType([T.StructField("v", T.StringType()), T.StructField("version", T.LongType())])
_ID = T.StructType([T.StructField("id", T.StringType())])


#: With it, timestamps come back from JSON as they went in; null fields are left out and come back null.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def _payload(df: DataFrame, columns: Sequence[str]) -> Column:
    return F.to_json(F.struct(*[F.col(c) for c in columns]), _JSON)


def fold(changes: DataFrame, kind: str = "row_kind") -> DataFrame:
    """The rows a changelog leaves, each as often as it was added more than taken back."""
    columns = [c for c in changes.columns if c != kind]
    net = changes.groupBy(*columns).agg(F.sum(F.when(F.col(kind) == "+", 1).otherwise(-1)).alias("_n")).where("_n > 0")
    return net.select(*columns, F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_k")).drop("_k")


class HeaderJoin(StatefulProcessor):
    """The delta rule for ``lines JOIN header LEFT JOIN extra ...`` within one header key.

    State: the header, the lines by id, and each extra by id of its line.  A
    new line is joined to what is there; a new header or extra takes back the
    rows it changes and adds them anew.
    """

    def __init__(self, extras: Mapping[str, Mapping[str, Callable] | None]):
        self.extras = dict(extras)
        self.change = Row("row_kind", "line", "header", *self.extras)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.header = handle.getValueState("header", _VERSION)
        self.lines = handle.getMapState("lines", _ID, _TEXT)
        self.sides = {name: handle.getMapState(f"extra_{name}", _ID, _VERSION) for name in self.extras}

    def _entry(self, name: str, line: str) -> tuple[str | None, int | None]:
        side = self.sides[name]
        return side.getValue((line,)) if side.containsKey((line,)) else (None, None)

    def _extra(self, name: str, line: str) -> str | None:
        return self._entry(name, line)[0]

    def _row(self, kind: str, line: str, payload: str, header: str, changed: Mapping[str, str | None] | None = None) -> Row:
        known = changed or {}
        return self.change(kind, payload, header, *[known[n] if n in known else self._extra(n, line) for n in self.extras])

    def _lines(self, line: str) -> list[str]:
        # JSON text has no raw line feed, so equal ids share one entry.
        return self.lines.getValue((line,))[0].split("\n") if self.lines.containsKey((line,)) else []

    def _apply(self, side: str, line: str | None, version: int, payload: str) -> Iterator[Row]:
        header, newest = self.header.get() if self.header.exists() else (None, None)
        if side == "header":
            if newest is not None and version < newest:
                return
            self.header.update((payload, version))
            if header == payload:
                return
            for key, value in self.lines.iterator():
                for one in value[0].split("\n"):
                    if header is not None:
                        yield self._row("-", key[0], one, header)
                    yield self._row("+", key[0], one, payload)
        elif side == "line":
            before = self.lines.getValue((line,))[0] + "\n" if self.lines.containsKey((line,)) else ""
            self.lines.updateValue((line,), (before + payload,))
            if header is not None:
                yield self._row("+", line, payload, header)
        else:
            before, newest = self._entry(side, line)
            combine = self.extras[side]
            if not combine and newest is not None and version < newest:
                return
            after = self._merged(before, payload, combine)
            if header is not None and after != before:
                for one in self._lines(line):
                    yield self._row("-", line, one, header)
                    yield self._row("+", line, one, header, {side: after})
            self.sides[side].updateValue((line,), (after, version))

    @staticmethod
    def _merged(before: str | None, after: str, combine: Mapping[str, Callable] | None) -> str:
        """The newer payload, or the two combined field by field."""
        if before is None or not combine:
            return after
        old, new = json.loads(before), json.loads(after)
        for name, function in combine.items():
            both = [x[name] for x in (old, new) if x.get(name) is not None]
            if both:
                new[name] = function(both)
        return json.dumps(new, ensure_ascii=False, separators=(",", ":"))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        rows = iter(rows)
        while chunk := list(islice(rows, CHUNK)):
            # Headers and extras first: fewer rows to take back.
            chunk.sort(key=lambda r: (_RANK.get(r.side, 1), r.version))
            for r in chunk:
                yield from self._apply(r.side, r.id, r.version, r.payload)

    def close(self) -> None:
        pass


def join_changes(
    lines: DataFrame, header: DataFrame, extras: Mapping[str, DataFrame], on: str, line_id: str,
    combine: Mapping[str, Mapping[str, Callable]] | None = None, version: str | None = None, hot: Sequence = (), salts: int = 16,
) -> DataFrame:
    """The changelog of ``lines JOIN header ON on LEFT JOIN extra ON line_id ...`` over streams.

    Extras carry ``on`` too, so that one shuffle serves all joins.  The highest
    ``version`` of a header wins, whenever it arrives, and of an extra unless
    ``combine`` names functions for its columns.  Header columns and extra columns must have
    other names than those of the lines.  Lines of ``hot`` keys are spread over
    ``salts`` by their id, and the header of such a key is repeated.  Rows
    without a key never join and are left out.
    """
    names = list(extras)

    def is_hot(key: str) -> Column:
        return F.col(key).isin(*hot) if hot else F.lit(False)

    def tagged(df: DataFrame, side: str, with_id: bool) -> DataFrame:
        columns = [c for c in df.columns if side == "line" or c not in (on, line_id)]
        key = F.col(on).cast("string")
        kept = df.where(F.col(on).isNotNull() & F.col(line_id).isNotNull()) if with_id else df.where(F.col(on).isNotNull())
        salt = F.when(is_hot(on), F.pmod(F.xxhash64(line_id), F.lit(salts)).cast("int")).otherwise(0) if with_id else F.explode(
            F.sequence(F.lit(0), F.when(is_hot(on), salts - 1).otherwise(0)))
        return kept.select(
            key.alias("key"), salt.alias("salt"), F.lit(side).alias("side"),
            (F.col(line_id).cast("string") if with_id else F.lit(None).cast("string")).alias("id"),
            (F.col(version).cast("long") if version and version in df.columns else F.lit(0).cast("long")).alias("version"),
            _payload(df, columns).alias("payload"),
        )

    both = tagged(lines, "line", True).unionByName(tagged(header, "header", False))
    for name, df in extras.items():
        both = both.unionByName(tagged(df, name, True))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("row_kind", "line", "header", *names)])
    changes = both.groupBy("key", "salt").transformWithState(
        HeaderJoin({n: (combine or {}).get(n) for n in names}), schema, "Append", "None")

    def fields(df: DataFrame, drop: Sequence[str]) -> T.StructType:
        return T.StructType([f for f in df.schema.fields if f.name not in drop])

    parsed = changes.select(
        "row_kind", F.from_json("line", lines.schema, _JSON).alias("line"), F.from_json("header", fields(header, [on]), _JSON).alias("header"),
        *[F.from_json(n, fields(df, [on, line_id]), _JSON).alias(n) for n, df in extras.items()],
    )
    dropped = {version} if version else set()
    extra_columns = [
        F.col(f"{n}.{f.name}") for n, df in extras.items() for f in fields(df, [on, line_id]).fields if f.name not in dropped]
    return parsed.select(
        "row_kind", "line.*", *[f"header.{f.name}" for f in fields(header, [on]).fields if f.name not in dropped], *extra_columns)


class Retraction(StatefulProcessor):
    """Every version, and the version before it taken back if it is not older than a limit.

    State: the last version.  With a limit, an event-time timer forgets it
    once the watermark has passed all versions that could replace it.  The
    rows of a key within a batch are sorted in memory; the batch size bounds
    them.
    """

    def __init__(self, order: Sequence[str], ts_ms: str, ttl_ms: int | None):
        self.order, self.ts_ms, self.ttl_ms = list(order), ts_ms, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", T.StructType([
            T.StructField("ts_ms", T.LongType()), T.StructField("payload", T.StringType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        versions = sorted(rows, key=itemgetter(*self.order))
        if not versions:
            return
        last = self.last.get() if self.last.exists() else None
        for r in versions:
            if last is not None and (self.ttl_ms is None or r[self.ts_ms] - last[0] <= self.ttl_ms):
                yield _CHANGE("-", last[1])
            yield _CHANGE("+", r.payload)
            last = (r[self.ts_ms], r.payload)
        if self.ttl_ms is not None:
            # Not before the watermark: such a timer fires with the next batch.  Earlier timers find a younger version.
            self.handle.registerTimer(max(last[0] + self.ttl_ms + 1, timerValues.getCurrentWatermarkInMs() + 1))
        self.last.update(tuple(last))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.last.exists() and self.last.get()[0] + self.ttl_ms < expiredTimerInfo.getExpiryTimeInMs():
            self.last.clear()
        return iter([])

    def close(self) -> None:
        pass


def retraction_stream(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], measures: Sequence[str], ts_ms: str, ttl_ms: int | None = None,
    delay: str = "0 seconds",
) -> DataFrame:
    """As :func:`tideline.operators.keyed.retract`, over a stream; ``ts_ms`` comes first in ``order``.

    With ``ttl_ms`` the event time is ``ts_ms``, late by ``delay`` at most.
    """
    if order[0] != ts_ms:
        raise ValueError("the time column comes first in the order")
    rows = df.select(*dict.fromkeys([*keys, *order]), _payload(df, df.columns).alias("payload"))
    if ttl_ms is not None:
        rows = rows.withColumn("_et", F.timestamp_millis(ts_ms)).withWatermark("_et", delay)
    changes = rows.groupBy(*keys).transformWithState(
        Retraction(order, ts_ms, ttl_ms), "row_kind string, payload string", "Append", "None" if ttl_ms is None else "EventTime")
    rows = changes.select("row_kind", F.from_json("payload", df.schema, _JSON).alias("r")).select("r.*", "row_kind")
    return rows.withColumns({m: F.when(F.col("row_kind") == "-", -F.col(m)).otherwise(F.col(m)) for m in measures})
