"""Heartbeats of a stream against the batch form, over restarts; remote texts as a format."""

import random
import sys
import types

import pytest
from pyspark.sql import functions as F

from inkgrid.sources import remote
from inkgrid.streaming import progress

SCHEMA = "event_id long, run_id long, ts timestamp"


def beats(spark, rows):
    return spark.createDataFrame(rows, "event_id long, run_id long, s double").select("event_id", "run_id", F.timestamp_seconds("s").alias("ts"))


def test_a_stream_of_heartbeats_is_throttled_as_a_batch(spark, tmp_path):
    """Three files of heartbeats, out of order within the watermark, each read by a query that starts anew from the checkpoint."""
    draw = random.Random(2)
    rows = [(i, i % 3, 1000 + i * 0.4 + draw.random()) for i in range(150)]
    draw.shuffle(rows[:1])
    source, target, at = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    last = [(1000 + r, r, 5000.0) for r in range(3)]  # moves the watermark past all others
    for part in (rows[:50], rows[50:100], rows[100:] + last, [(2000, 0, 9000.0)]):
        beats(spark, draw.sample(part, len(part))).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        progress.throttled_stream(stream).writeStream.format("parquet").option("path", target).option("checkpointLocation", at).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    want = {r.event_id for r in progress.throttled(beats(spark, rows + last)).collect()}
    got = [r.event_id for r in spark.read.parquet(target).collect()]
    assert len(got) == len({*got}) and {*got} == want and 40 < len(want) < 150


def test_what_waits_in_a_stream_keeps_every_kind_of_column(spark, tmp_path):
    """Heartbeats that wait for the watermark are kept as an Arrow table: bytes, decimals and missing values too, in few bytes each."""
    source, target, at = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    more = [F.col("event_id").cast("string").cast("binary").alias("b"), F.col("event_id").cast("decimal(20,3)").alias("d"), F.when(F.col("event_id") % 2 == 0, F.col("event_id")).alias("n")]
    rows = beats(spark, [(i, 0, 1000.0 + i) for i in range(3000)]).select("*", *more)
    rows.coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    progress.throttled_stream(stream, late="10 seconds").writeStream.format("parquet").option("path", target).option("checkpointLocation", at).trigger(availableNow=True).start().awaitTermination()
    got = [tuple(r) for r in spark.read.parquet(target).orderBy("event_id").collect()]
    want = [tuple(r) for r in progress.throttled(rows).orderBy("event_id").where("event_id < 2989").collect()]
    assert got == want and len(want) > 1000


@pytest.fixture
def store(monkeypatch):
    """A module that tasks can import: they run where the driver does in tests."""
    module = types.ModuleType("store_of_texts")
    module.get = lambda paper: {0: (200, {"markdown": "text 0"}), 1: (404, None), 2: (200, {"markdown": ""}), 3: (400, None)}.get(paper, (200, {"markdown": f"text {paper}"}))
    monkeypatch.setitem(sys.modules, "store_of_texts", module)
    return module


def test_reader_asks_for_what_is_wanted(store):
    reader = remote.RemoteReader({"get": "store_of_texts:get", "ids": "[5, 0, 1, 2, 3, 9, 9]", "partitions": "4", "concurrency": "2"})
    parts = reader.partitions()
    assert len(parts) == 4 and [i for p in parts for i in p.ids] == [0, 1, 2, 3, 5, 9]
    rows = [r for p in parts for r in reader.read(p)]
    assert rows == [(0, "text 0", None), (1, None, None), (2, None, None), (3, None, "RuntimeError | status 400 after 1 tries"), (5, "text 5", None), (9, "text 9", None)]
    place = ("paper_id",)
    for filters, ids in (([remote.In(place, (9, 1, 7))], [1, 9]), ([remote.EqualTo(place, 5)], [5]), ([remote.EqualTo(place, 4)], []), ([remote.GreaterThan(place, 2), remote.LessThanOrEqual(place, 5)], [3, 5]), ([remote.GreaterThanOrEqual(place, 2), remote.LessThan(place, 5)], [2, 3])):
        reader = remote.RemoteReader({"get": "store_of_texts:get", "ids": "[5, 0, 1, 2, 3, 9]"})
        assert list(reader.pushFilters(filters)) == [] and list(reader.ids) == ids
    reader = remote.RemoteReader({"get": "store_of_texts:get", "low": "10", "high": "1000000010"})
    other = remote.EqualTo(("markdown",), "x")
    assert list(reader.pushFilters([other, remote.GreaterThanOrEqual(place, 1000000000)])) == [other] and len(reader.ids) == 10 and len(reader.partitions()) == 8
    assert remote.RemoteReader({"get": "store_of_texts:get", "ids": "[]"}).partitions()[0].ids == []
    with pytest.raises(ValueError, match="no function"):
        remote.RemoteReader({"get": "store_of_texts:nothing", "ids": "[]"})


def test_passing_failures_are_tried_again(store, monkeypatch):
    answers = iter([(503, None), (200, {"markdown": "late"})])
    monkeypatch.setattr(remote.complete, "BACKOFF", 0.01)
    store.get = lambda paper: next(answers)
    reader = remote.RemoteReader({"get": "store_of_texts:get", "ids": "[4]"})
    assert list(reader.read(reader.partitions()[0])) == [(4, "late", None)]


def test_remote_texts_are_a_format(spark):
    """The function is one of the library, so that tasks know it: a store of none."""
    read = remote.registered(spark).read.format("remote_texts").option("get", "inkgrid.sources.remote:nowhere").option("low", 0).option("high", 40).option("partitions", 3)
    rows = read.load()
    assert rows.count() == 40 and rows.where("markdown is not null or error is not null").count() == 0
    few = read.load().where("paper_id in (3, 5, 77) and paper_id > 3")
    assert [r.paper_id for r in few.collect()] == [5]
    assert rows.rdd.getNumPartitions() == 3 and few.rdd.getNumPartitions() == 1
