"""Incremental and time-based behaviour: resume, heartbeats, rate windows."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

HEARTBEAT_SECONDS = 1.5
WINDOW_MICROS = 60_000_000


def throttled(beats: DataFrame, key: str = "run_id", ts: str = "ts", tie: str = "event_id", seconds: float = HEARTBEAT_SECONDS) -> DataFrame:
    """The heartbeats that are sent: each run's first, then the next at least `seconds` after the last one sent.

    Whether one is sent depends on those sent before, which no window function tells: runs are streamed in time order,
    a partition at a time (equal times by `tie`), and only the last time sent is kept.
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in beats.schema)
    step = pd.Timedelta(seconds=seconds)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, last = object(), None
        for pdf in batches:
            keep = []
            for k, t in zip(pdf[key], pdf[ts], strict=True):
                send = k != now or t - last >= step
                if send:
                    now, last = k, t
                keep.append(send)
            yield pdf[keep]

    return beats.repartition(key).sortWithinPartitions(key, ts, tie).mapInPandas(run, fields)


def throttled_stream(beats: DataFrame, key: str = "run_id", ts: str = "ts", tie: str = "event_id", seconds: float = HEARTBEAT_SECONDS, late: str = "10 seconds") -> DataFrame:
    """throttled() of a stream: the state of a run is when its last heartbeat was sent, and those that wait for the watermark.

    Heartbeats may come out of order by `late` at most, later ones are left out. They wait until the watermark has passed them and are taken in time order then
    (equal times by `tie`), so the same ones are sent as of a batch. Runs are groups, so each goes by itself; a restart goes on from the checkpoint.
    A run's state is its rows of the last micro-batch and of `late`, as a compressed Arrow table: bound the micro-batch (maxFilesPerTrigger) where much
    is read at once. Heartbeats without a time are left out.
    """
    output = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in beats.schema)
    schema = pa.schema([(f.name, pa.timestamp("us") if isinstance(f.dataType, T.TimestampType) else to_arrow_type(f.dataType)) for f in beats.schema])
    step = round(seconds * 1_000_000)

    def run(_: tuple, frames: Iterator[pd.DataFrame], kept: GroupState) -> Iterator[pd.DataFrame]:
        last, held = kept.get if kept.exists else (None, None)
        rows = [pa.ipc.open_stream(held).read_all()] if held else []
        if not kept.hasTimedOut:
            rows += [pa.Table.from_pandas(f, schema, preserve_index=False) for f in frames]
        rows = pa.concat_tables([schema.empty_table(), *rows])
        rows = rows.filter(rows[ts].is_valid()).sort_by([(ts, "ascending"), (tie, "ascending")])
        times = rows[ts].cast(pa.int64()).to_numpy()
        mark = kept.getCurrentWatermarkMs()
        passed = int(np.searchsorted(times, (mark + 1) * 1000))  # a watermark counts whole milliseconds
        sent, at = [], 0 if last is None else int(np.searchsorted(times, last + step))
        while at < passed:
            sent.append(at)
            last = int(times[at])
            at = max(at + 1, int(np.searchsorted(times, last + step)))
        out, waiting = pa.BufferOutputStream(), rows.slice(passed)
        with pa.ipc.new_stream(out, schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
            writer.write_table(waiting)
        kept.update((last, out.getvalue().to_pybytes() if waiting.num_rows else None))
        if waiting.num_rows:
            kept.setTimeoutTimestamp(max(int(times[passed]) // 1000 - 1, mark + 1))
        yield rows.take(pa.array(sent, pa.int64())).to_pandas()

    watched = beats.withWatermark(ts, late).groupBy(key)
    return watched.applyInPandasWithState(run, output, "last long, held binary", "append", GroupStateTimeout.EventTimeTimeout)


class Throttle:
    """A reporter that sends running heartbeats at least `seconds` apart; the first, and any that ends a run, are always sent."""

    def __init__(self, report: Callable[[dict], None], seconds: float = HEARTBEAT_SECONDS, clock: Callable[[], float] = time.monotonic) -> None:
        self.report, self.seconds, self.clock, self.last = report, seconds, clock, None

    def __call__(self, beat: dict) -> None:
        now = self.clock()
        if beat.get("status") == "running" and self.last is not None and now - self.last < self.seconds:
            return
        self.last = now
        self.report(beat)


def calls_in_window(calls: DataFrame, provider: str = "provider", ts: str = "ts") -> DataFrame:
    """calls with in_window: the calls of the provider in the 60 seconds up to each; one of exactly 60 seconds ago is out.

    Calls are counted by provider and minute first, so that a provider's calls are ordered a minute at a time, and each
    minute also sees the one before it.
    """
    rows = calls.withColumn("__us", F.unix_micros(F.col(ts).cast("timestamp"))).withColumn("__m", F.floor(F.col("__us") / WINDOW_MICROS))
    both = rows.withColumn("__at", F.explode(F.array(F.col("__m"), F.col("__m") + 1)))
    near = Window.partitionBy(provider, "__at").orderBy("__us").rangeBetween(-(WINDOW_MICROS - 1), Window.currentRow)
    return both.withColumn("in_window", F.count("*").over(near)).where("__at = __m").drop("__us", "__m", "__at")


def incremental(spark_stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Runs sink over all new rows of a stream, once each, and stops: the streaming face of resume."""
    return spark_stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def new_cells(stream: DataFrame, keys: list[str], ts: str, late: str = "10 minutes") -> DataFrame:
    """Rows of a stream whose keys weren't seen within the watermark: at-least-once inputs, each cell once."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)
