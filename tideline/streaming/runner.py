"""Start a streaming job: source, transformation, sink, checkpoint and trigger in one place."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tideline.functions.times import from_millis

BatchWriter = Callable[[DataFrame, int], None]


@dataclass
class Job:
    """``name`` identifies the job across restarts together with ``checkpoint``.

    ``interval`` is the trigger interval; ``None`` processes what is there and
    stops.  ``each_batch`` must tolerate being called twice for one batch id;
    with ``persist`` the batch is kept while it runs, for writers that read it
    more than once.

    ``partitions`` is the number of state partitions.  A checkpoint keeps the
    number it started with and AQE does not resize state, so choose it for the
    volume to come, e.g. with :func:`tideline.session.partitions_for`.
    """

    name: str
    checkpoint: str
    transform: Callable[[DataFrame], DataFrame] = lambda df: df
    each_batch: BatchWriter | None = None
    sink_format: str | None = None
    sink_options: dict[str, str] = field(default_factory=dict)
    output_mode: str = "append"
    interval: str | None = "5 seconds"
    once: bool = False
    persist: bool = False
    partitions: int | None = None

    def _write(self, batch: DataFrame, batch_id: int) -> None:
        if not self.persist:
            self.each_batch(batch, batch_id)
            return
        batch.persist()
        try:
            self.each_batch(batch, batch_id)
        finally:
            batch.unpersist()

    def start(self, source: DataFrame) -> StreamingQuery:
        out = self.transform(source)
        writer = (
            out.writeStream.queryName(self.name)
            .outputMode(self.output_mode)
            .option("checkpointLocation", self.checkpoint)
        )
        if self.once:
            writer = writer.trigger(once=True)
        elif self.interval is None:
            writer = writer.trigger(availableNow=True)
        else:
            writer = writer.trigger(processingTime=self.interval)
        if self.each_batch is not None:
            writer = writer.foreachBatch(self._write)
        else:
            writer = writer.format(self.sink_format or "console").options(**self.sink_options)
        conf, name = source.sparkSession.conf, "spark.sql.shuffle.partitions"
        before = conf.get(name)
        try:
            # A query keeps the settings of the moment it starts.
            conf.set(name, str(self.partitions or before))
            return writer.start()
        finally:
            conf.set(name, before)

    def run(self, source: DataFrame, timeout: int | None = None) -> StreamingQuery:
        """Start and wait for a job that ends by itself, as long as it takes unless there is a ``timeout``."""
        query = self.start(source)
        if timeout is None:
            query.awaitTermination()
        elif not query.awaitTermination(timeout):
            query.stop()
            raise TimeoutError(f"{self.name} did not finish within {timeout} s")
        return query


def monotonous(df: DataFrame, ts: str) -> DataFrame:
    """Event time that does not go back: anything older than the newest batch is late."""
    return df.withWatermark(ts, "0 seconds")


def bounded_delay(df: DataFrame, ts: str, delay: str = "3 seconds") -> DataFrame:
    """Event time that may be out of order by ``delay``."""
    return df.withWatermark(ts, delay)


def event_time(df: DataFrame, ms: str | Column, out: str = "et") -> DataFrame:
    """Event-time column from epoch milliseconds; a missing time counts as the epoch."""
    value = F.col(ms) if isinstance(ms, str) else ms
    return df.withColumn(out, from_millis(F.coalesce(value, F.lit(0))))


def late_rows(query: StreamingQuery) -> int:
    """Rows the stateful operators dropped because they were older than the watermark."""
    return sum(
        int(op.get("numRowsDroppedByWatermark", 0))
        for progress in query.recentProgress
        for op in progress.get("stateOperators", [])
    )
