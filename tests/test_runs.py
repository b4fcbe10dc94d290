"""The state's log, snapshots and commits; runs by many chunks, by batches, interrupted; what settings say of calls."""

import json
import threading
import time

import pytest
from pyspark.sql import functions as F

from inkgrid.operators import complete, state
from inkgrid.plans import catalog, engine
from inkgrid.sources import documents as S

SCHEMA = "run_id long, paper_id long, version_id long, payload_json string, batch_group_id string"


@pytest.fixture
def table(spark, tmp_path):
    return state.StateTable(spark, str(tmp_path / "answers"))


def inputs(spark, n):
    papers = spark.range(n).select(F.col("id").alias("paper_id"), F.lit("t").alias("title"), F.lit("abstract").alias("abstract"), F.lit("").alias("split"), ((F.col("id") * 7) % n).alias("p_order"))
    return papers, catalog.questions(spark), papers.select("paper_id", F.concat(F.lit("text of paper "), F.col("paper_id")).alias("markdown"))


def runs_of(spark, config, n=1):
    return spark.createDataFrame([(10 + i, f"run {i}", json.dumps(config), i) for i in range(n)], "run_id long, name string, config string, r_order int")


def rows(spark, *given):
    return spark.createDataFrame([(*r[:3], r[3] if len(r) > 3 else None, "g") for r in given], SCHEMA)


def as_set(view):
    return {tuple(r) for r in view.drop("updated_at", "seq").collect()}


def test_snapshots_tell_the_same_state(spark, table):
    table.save(rows(spark, (1, 1, 1, "a"), (1, 2, 1, "b"), (2, 1, 1, "c")), runs=[1, 2])
    table.mark_failed(rows(spark, (1, 1, 1)), "bad")
    table.reset([2])
    before, names = as_set(table.view()), table.appends(table.snapshot())
    old = table.view()
    assert len(names) == 3 and len(table.appends(None, [7])) == 2  # the two whose runs aren't told
    table.compact()
    assert as_set(table.view()) == before == as_set(old) and table.appends(table.snapshot()) == []
    table.save(rows(spark, (2, 1, 1, "again")), runs=[2])
    assert {r[0] for r in as_set(table.view())} == {1, 2} and as_set(table.view([1])) == before
    table.compact()
    table.vacuum(3600)
    assert len(table.files.names("commits")) == 4
    table.vacuum(0)
    assert table.files.names("commits") == table.files.names("log") == [] and len(table.files.names("snapshots")) == 2
    assert {r[3] for r in as_set(table.view([2]))} == {"done"} and table.view().count() == 3
    assert table.compact() == table.snapshot() and table.save(rows(spark, (3, 1, 1, "x"))) == 5
    assert as_set(state.StateTable(spark, table.path).view()) == as_set(table.view())


def test_what_was_written_without_a_commit_doesnt_count(spark, table):
    table.save(rows(spark, (1, 1, 1, "a")))
    put, table.files.put = table.files.put, lambda *_: (_ for _ in ()).throw(OSError("lost"))
    with pytest.raises(OSError):
        table.save(rows(spark, (1, 1, 1, "b")))
    table.files.put = put
    assert table.view().first().payload_json == "a" and len(table.files.names("log")) == 2
    table.save(rows(spark, (1, 1, 1, "c")))
    assert table.view().first().payload_json == "c"


def test_appends_during_compaction_stay_beside_it(spark, table):
    """Another writer appends after the compaction has listed what it covers, with a number that the snapshot's is not below."""
    table.save(rows(spark, (1, 1, 1, "a"), (1, 2, 1, "b")))
    other, latest = state.StateTable(spark, table.path), state.latest

    def late(*args):
        other.save(rows(spark, (1, 2, 1, "late")))
        return latest(*args)

    state.latest = late
    try:
        table.compact()
    finally:
        state.latest = latest
    assert len(table.appends(table.snapshot())) == 1
    assert {r.paper_id: r.payload_json for r in table.view().collect()} == {1: "a", 2: "late"}


def test_two_writers_of_a_number_have_one_winner(spark, table):
    other = state.StateTable(spark, table.path)
    table._next = other._next = lambda: 5
    table.save(rows(spark, (1, 1, 1, "mine")))
    other.save(rows(spark, (1, 1, 1, "theirs")))
    want = max((table.writer, "mine"), (other.writer, "theirs"))[1]
    assert table.view().first().payload_json == want
    table.compact()
    assert table.view().first().payload_json == want


def read_bytes(spark):
    sc = spark.sparkContext
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
    return sum(stages.apply(i).inputBytes() for i in range(stages.size()))


def test_fifty_chunks_read_alike(spark, table):
    """Bytes that a chunk reads, by its place among fifty: what was kept before doesn't count."""
    papers, asked, texts = inputs(spark, 100)
    cell = [F.lit(10).alias("run_id"), "paper_id", F.lit(14).alias("version_id"), F.lit("g").alias("batch_group_id")]
    table.save(papers.where("paper_id < 40").select(*cell, F.lit("{}").alias("payload_json")), runs=[10])
    source, each = engine._Papers(table, papers, texts), []
    for chunk in source.chunks(10, 2):
        before = read_bytes(spark)
        states = table.last(chunk.log)
        new = chunk.papers.join(chunk.texts, "paper_id").join(states.select("paper_id"), "paper_id", "left_anti")
        saved = table.appended(table.save(new.select(*cell, F.col("markdown").alias("payload_json")), runs=[10]))
        now = table.last(chunk.log.unionByName(saved))
        assert now.count() == 2
        table.mark_posted(state.unposted(now), runs=[10], whole=True)
        each.append(read_bytes(spark) - before)
    source.close()
    assert len(each) == 50 and each[0] > 0 and sum(each[-10:]) < 1.3 * sum(each[5:15])
    assert table.view().where("status = 'posted'").count() == 100 and table.files.names("dealt") == []
    assert len(table.appends(table.snapshot())) == 101
    table.compact_if_long()
    assert table.appends(table.snapshot()) == [] and table.view([10]).count() == 100


def test_rows_of_others_count_while_a_run_goes(spark, table):
    papers, asked, texts = inputs(spark, 4)
    other, seen = state.StateTable(spark, table.path), []

    def report(beat):
        if beat["message"] == "chunk 1/2":  # paper of the second chunk
            last = papers.orderBy("p_order").collect()[3]["paper_id"]
            other.save(rows(spark, *((10, last, v, '{"extraction_status":"ok"}') for v in (14, 15, 16))), runs=[10])

    def reason(d):
        seen.append(d.count())
        return complete.dummy(d)

    (out,) = engine.run_all(table, runs_of(spark, {"chunk_papers": 2}), papers, asked, texts, engine.annotation(asked, reason), hooks=engine.Hooks(report=report))
    assert out.done == 9 and seen == [2, 1] and table.view().count() == 12


def test_a_running_chunk_is_interrupted_and_goes_on_later(spark, table):
    papers, asked, texts = inputs(spark, 4)
    stop, began = threading.Event(), []

    def slow(row):
        time.sleep(60)
        return {"text": "late"}

    def reason(d):
        began.append(time.time())
        stop.set()
        return complete.complete(d, slow)

    hooks = engine.Hooks(cancelled=stop.is_set, watch_seconds=0.2)
    (out,) = engine.run_all(table, runs_of(spark, {}), papers, asked, texts, engine.annotation(asked, reason), hooks=hooks)
    assert out.status == "canceled" and time.time() - began[0] < 40 and table.view().count() == 0
    (out,) = engine.run_all(table, runs_of(spark, {}), papers, asked, texts, engine.annotation(asked))
    assert (out.status, out.done) == ("succeeded", 12)


class Provider:
    """Batches that are done when `ready` holds their number."""

    def __init__(self, spark, ready=(), broken=()):
        self.spark, self.ready, self.broken, self.sent, self.polls = spark, set(ready), set(broken), [], []

    def submit(self, lines):
        self.sent.append([json.loads(r.value) for r in lines.collect()])
        return str(len(self.sent) - 1)

    def poll(self, batch):
        self.polls.append(batch)
        return "failed" if int(batch) in self.broken else "done" if int(batch) in self.ready else "running"

    def collect(self, batch):
        out = []
        for line in self.sent[int(batch)]:
            said = json.dumps(line)
            keys = [k for k in ("quality", "kind", "size") if f"- {k} (" in said]
            text = json.dumps({"results": [{"key": k, "value": None, "cited_text": "", "comment": "", "confidence": None} for k in keys]}) if keys else "thoughts"
            out.append((line["custom_id"], text, 7, 2, None))
        return self.spark.createDataFrame(out[:-1] if len(out) > 5 else out, "cid string, text string, input_tokens long, output_tokens long, error string")


def test_batches_park_their_chunk_and_come_back(spark, table, tmp_path):
    papers, asked, texts = inputs(spark, 4)
    provider, jobs = Provider(spark), {}
    batches = engine.Batches(jobs, {"openai": lambda: provider}, "openai", "m")
    config = {"chunk_papers": 2, "batch_p1": True, "batch_p2": True, "format_model": "small", "format_temperature": 0.0, "model_params": {"max_tokens": 99}}

    def go():
        beats = []
        (out,) = engine.run_all(table, runs_of(spark, config), papers, asked, texts, engine.annotation(asked), hooks=engine.Hooks(report=beats.append), batches=batches, checkpoints=str(tmp_path / "p1"))
        return out, [b["message"] for b in beats]

    out, said = go()
    assert (out.status, out.parked, out.done) == ("parked", 2, 0) and said == ["starting", "chunk 1/2 parked", "chunk 2/2 parked", "2 chunks wait for a batch"]
    assert jobs == {"10:p1:0": "0", "10:p1:1": "1"} and provider.polls == ["0", "1"] and provider.sent[0][0]["body"]["max_tokens"] == 99
    provider.ready = {1}  # the second chunk's reasoning is there: its formatting is submitted; the first one is asked for once more
    out, _ = go()
    assert out.parked == 2 and jobs["10:p2:1"] == "2" and len(provider.sent) == 3 and provider.sent[2][0]["body"]["model"] == "small"
    assert provider.sent[2][0]["body"]["response_format"]["type"] == "json_schema"
    provider.ready = {0, 1, 2}
    out, said = go()
    assert out.done == 6 and out.parked == 1 and said[1:3] == ["chunk 1/2 parked", "chunk 2/2"] and set(jobs) == {"10:p1:0", "10:p2:0"}
    provider.ready |= {3}
    out, said = go()
    assert out.status == "succeeded" and not jobs and len(provider.sent) == 4 and table.unposted().count() == 12
    tokens = sum(json.loads(r.payload_json)["tokens_total"] for r in table.view().collect())
    assert tokens == 4 * 9


def test_a_batch_that_failed_is_forgotten(spark, table, tmp_path):
    papers, asked, texts = inputs(spark, 2)
    provider, jobs = Provider(spark, broken={0}), {}
    batches = engine.Batches(jobs, {"openai": lambda: provider}, "openai", "m")
    with pytest.raises(RuntimeError, match="batch 0 failed"):
        engine.run_all(table, runs_of(spark, {"batch_p1": True}), papers, asked, texts, engine.annotation(asked), batches=batches, checkpoints=str(tmp_path / "p1"))
    assert not jobs and table.view().count() == 0
    with pytest.raises(ValueError, match="batches="):
        engine.run_all(table, runs_of(spark, {"batch_p1": True}), papers, asked, texts, engine.annotation(asked))


def test_cids_that_a_batch_lacks_are_tried_again(spark, table, tmp_path):
    papers, asked, texts = inputs(spark, 6)
    provider, jobs = Provider(spark, ready=range(9)), {}
    batches = engine.Batches(jobs, {"openai": lambda: provider}, "openai", "m")
    go = lambda: engine.run_all(table, runs_of(spark, {"batch_p1": True}), papers, asked, texts, engine.annotation(asked), batches=batches, checkpoints=str(tmp_path / "p1"))[0]
    assert (go().failed, table.view().where("error like '%pass 1 gave no text%'").count()) == (3, 3)
    assert go().done == 3 and [len(s) for s in provider.sent] == [6, 1] and table.view().where("status = 'done'").count() == 18


def test_the_cache_is_warmed_once(spark, table, tmp_path):
    papers, asked, texts = inputs(spark, 2)
    provider, jobs, warmed = Provider(spark), {}, []
    batches = engine.Batches(jobs, {"anthropic": lambda: provider}, "anthropic", "m", warm=warmed.append)
    config = {"batch_p1": True, "cache": True, "cache_ttl": "5m", "system_prompt": "be brief", "temperature": 0.5}
    for _ in range(2):
        engine.run_all(table, runs_of(spark, config), papers, asked, texts, engine.annotation(asked), batches=batches, checkpoints=str(tmp_path / "p1"))
    (one,) = warmed
    assert one["max_tokens"] == 0 and one["messages"][-1]["content"] == "warmup" and one["system"] == "be brief" and one["temperature"] == 0.5
    assert one["messages"][0] == provider.sent[0][0]["params"]["messages"][0] and len(provider.sent) == 1


def test_every_setting_reaches_a_run(spark, table):
    """No key of the defaults is left unread."""
    papers, asked, texts = inputs(spark, 3)
    read = set()

    class Config(dict):
        def __getitem__(self, key):
            read.add(key)
            return super().__getitem__(key)

    overlaid = S.overlaid
    S.overlaid = lambda *a: Config(overlaid(*a))
    config = {"temperature": 0.2, "reasoning_effort": "low", "model_params": {"seed": 1}, "format_model": "f", "format_model_provider": "p", "format_temperature": 0.1, "format_model_params": {"x": 2}, "request_timeout": 9, "drop_params": True, "concurrency": 2, "rpm": 6000}
    try:
        def call(row):
            want = {1: {"temperature": 0.2, "reasoning_effort": "low", "seed": 1}, 2: {"provider": "p", "model": "f", "temperature": 0.1, "x": 2}}
            number = 2 if "model" in row["options"] else 1
            got = {k: v for k, v in row["options"].items() if k != "response_schema"}
            assert got == want[number] | {"timeout": 9, "drop_params": True}, got
            assert number == 1 or row["options"]["response_schema"]["required"] == ["results"]
            return {"text": "thoughts" if number == 1 else '{"results":[{"key":"quality","value":true},{"key":"kind","value":null},{"key":"size","value":"s"}]}'}

        (out,) = engine.run_all(table, runs_of(spark, config), papers, asked, texts, engine.annotation(asked, call=call))
    finally:
        S.overlaid = overlaid
    assert (out.done, out.errors, out.failed) == (9, 0, 0) and read >= set(S.RUN_DEFAULTS)


def test_a_dry_run_tells_every_line(spark, table):
    papers, asked, texts = inputs(spark, 5)
    out = engine.run_all(table, runs_of(spark, {"chunk_papers": 2}, 2), papers, asked, texts, engine.annotation(asked), hooks=engine.Hooks(dry_run=True))
    assert [o.lines.count() for o in out] == [15, 15] and table.view().where("status = 'posted'").count() == 0
    assert out[1].lines.where("line like 'run=11 paper=% q=% value=null'").count() == 15


def test_few_chunks_are_written_where_their_rows_are(spark, tmp_path):
    """Of few chunks each has a folder, written by all tasks that hold rows of it, without another exchange."""
    dealt = engine.Dealt(spark, str(tmp_path / "dealt"), 3)
    rows = spark.range(0, 3000, 1, 4).select(F.col("id").alias("paper_id"), (F.col("id") % 3).alias("chunk"))
    dealt.put("texts", rows)
    for c in range(3):
        got = dealt.of("texts", c)
        assert sorted(r.paper_id for r in got.collect()) == list(range(c, 3000, 3)) and len(got.inputFiles()) == 4
    assert dealt.of("texts", 7).count() == 0


def shuffled_by_stage(spark):
    """Bytes that each stage that Spark still knows of dealt out."""
    sc = spark.sparkContext
    listed = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
    stages = [listed.apply(i) for i in range(listed.size())]
    return {s.stageId(): s.shuffleWriteBytes() for s in stages}


def shuffle_files(spark):
    """Bytes of the shuffle files that stand on disk now."""
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    files = [found.apply(i) for i in range(found.size())]
    return {f.getName(): f.length() for f in files if f.getName().startswith("shuffle_")}


def test_texts_are_dealt_out_once_a_run_and_go(spark, table):
    """Texts that don't compress: each run deals them out once, formatting again once more, and none of it is left."""
    n, size = 60, 10_000
    papers, asked, _ = inputs(spark, n)
    text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(size // 64)), lambda i: F.sha2(F.concat_ws("-", "paper_id", i), 256)), "")
    texts = spark.createDataFrame(papers.select("paper_id", text.alias("markdown")).toArrow())
    task = engine.annotation(asked)
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    known, stood, sent, freed = shuffled_by_stage(spark), shuffle_files(spark), spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get(setting)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        engine.run_all(table, runs_of(spark, {"chunk_papers": 0, "batching": {"size": 2}}, 2), papers, asked, texts, task)
        engine.reformat(table, texts, task(S.RUN_DEFAULTS))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", sent)
    assert 2.5 * n * size < sum(b for stage, b in shuffled_by_stage(spark).items() if stage not in known) < 3.5 * n * size
    for _ in range(50):
        left = sum(length for name, length in shuffle_files(spark).items() if name not in stood)
        if left < 0.5 * n * size:
            break
        time.sleep(0.2)
    assert left < 0.5 * n * size and spark.conf.get(setting) == freed and table.view().count() == n * 2 * 3
