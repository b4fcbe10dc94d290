import json

import pytest
from pyspark.sql import functions as F

from inkgrid.functions import columns as C
from inkgrid.functions import replies
from inkgrid.operators import complete, grid, prompts, sinks, state
from inkgrid.plans import catalog, engine
from inkgrid.sources import documents, remote
from inkgrid.streaming import progress


@pytest.fixture
def table(spark, tmp_path):
    return state.StateTable(spark, str(tmp_path / "answers"))


def inputs(spark, n=4):
    papers = spark.range(n).select(F.col("id").alias("paper_id"), F.lit("t").alias("title"), F.lit("abstract").alias("abstract"), F.lit("").alias("split"), F.col("id").alias("p_order"))
    texts = spark.range(n - 1).select(F.col("id").alias("paper_id"), F.concat(F.lit("text of paper "), F.col("id")).alias("markdown"))
    return catalog.runs(spark), papers, catalog.questions(spark), texts


def test_second_run_asks_nothing(spark, table):
    plan, asked = inputs(spark), []

    def counted(rows):
        asked.append(rows.count())
        return complete.dummy(rows)

    view = engine.resume(table, *plan, batching={"size": 2}, reason=counted)
    assert view.count() == 2 * 4 * 3 and asked == [2 * 3 * 2]
    assert view.where("payload_json like '%no_ocr%'").count() == 2 * 3
    table.mark_posted(view)
    engine.resume(table, *plan, batching={"size": 2}, reason=counted)
    assert asked[1] == 0 and table.view().where("status = 'posted'").count() == 24
    table.reset([10])
    engine.resume(table, *plan, batching={"size": 2}, reason=counted)
    assert asked[2] == 3 * 2 and table.view().count() == 24


def test_answers_are_mapped_and_verified(spark):
    said = {"quality": '"yes"', "kind": '"rct"', "size": "1.0"}
    line = lambda k: json.dumps({"key": k, "cited_text": "text of paper 1 is quoted here, or not", "comment": "c"})[:-1] + f', "value": {said[k]}}}'
    reply = "[" + ",".join(map(line, said)) + "]"
    rows = engine.run(*inputs(spark), format_=lambda d: d.withColumn("completion", F.struct(F.lit(reply).alias("text"), F.struct(*(F.lit(1).cast("long").alias(k) for k in ("input_tokens", "output_tokens", "cached_tokens", "total_tokens"))).alias("usage"), F.lit("0.5").alias("cost"), F.lit(2).cast("long").alias("latency_ms"), F.lit(None).cast("string").alias("error"))))
    got = {r.version_id: json.loads(r.payload_json) for r in rows.where("run_id = 10 and paper_id = 1").collect()}
    assert got[14]["value_boolean"] is True and got[15]["value_categorical"] == "rct" and got[16]["value_text"] == "1.0"
    assert [got[v]["tokens_total"] for v in (14, 15, 16)] == [15, 0, 0] and [got[v]["fmt_tokens_total"] for v in (14, 15, 16)] == [3, 0, 0] and got[14]["fmt_cost"] == "0.5" and "fmt_cost" not in got[15]
    assert got[14]["citations"][0]["verified"] is False and got[14]["cited_text_verified"] is False


def test_state_transitions(spark, table):
    row = lambda v, p: spark.createDataFrame([(1, 1, v, p, "g")], "run_id long, paper_id long, version_id long, payload_json string, batch_group_id string")
    table.upsert_pending(row(1, None))
    table.save_pass1(row(1, "{}"))
    table.upsert_pending(row(1, None))
    assert table.view().first().status == "pass1_done"
    table.mark_failed(row(1, None), "bad")
    assert (table.view().first().status, table.view().first().payload_json) == ("failed", "{}")
    table.mark_failed(row(2, None), "nobody")
    assert table.view().count() == 1
    table.save(row(1, '{"a":1}'))
    assert table.view().first().error is None and table.unposted().count() == 1
    table.mark_posted(row(1, None))
    assert table.unposted().count() == 0 and table.postable().count() == 1
    table.replace_payload(row(1, '{"b":1}'))
    assert table.unposted().first().payload_json == '{"b":1}'
    table.mark_skipped(row(1, None), "why")
    assert table.view().first().payload_json is None
    table.reset([])
    assert table.view().count() == 1
    table.reset([1])
    assert table.view().count() == 0
    table.save(row(1, "{}"))
    assert table.view().count() == 1


def task_of(plan, **how):
    return engine.annotation(plan[2], **how)(documents.RUN_DEFAULTS)


def answering(value, cost="0.5"):
    """A format model that gives every key one value."""

    def model(rows):
        one = lambda k: F.concat(F.lit('{"key":"'), k, F.lit(f'","value":{value}}}'))
        return complete.dummy(rows).withColumn("completion", F.col("completion").withField("text", F.array_join(F.transform("keys", one), "\n")).withField("cost", F.lit(cost)))

    return model


def test_reformat_replaces_answers_and_keeps_the_rest(spark, table):
    plan = inputs(spark)
    engine.resume(table, *plan)
    before = {(r.run_id, r.paper_id, r.version_id): json.loads(r.payload_json) for r in table.view().collect()}
    assert engine.reformat(table, plan[3], task_of(plan, format_=answering('"rct"'))) == (2 * 3 * 3, 2 * 3)
    for r in table.view().where("paper_id < 3").collect():
        now, was = json.loads(r.payload_json), before[r.run_id, r.paper_id, r.version_id]
        new, old = json.loads(now["raw_response"]), json.loads(was["raw_response"])
        assert new["parse_result"]["value"]["said"] == "rct" and new.get("pass1_text") == old.get("pass1_text") and new["batch_group_id"] == old["batch_group_id"]
        assert now["tokens_total"] == was["tokens_total"] and (("pass2_text" in new) == (r.version_id == 14))
    first = lambda d: answering("1")(d.withColumn("all_keys", F.col("keys")).withColumn("keys", F.slice("keys", 1, 1))).withColumn("keys", F.col("all_keys"))
    assert engine.reformat(table, plan[3], task_of(plan, format_=first))[0] == 0


def saying_keys(key):
    """A format model by a callable: each key's own name as its value; what key() gives of a call is counted."""

    def model(rows):
        def one(row):
            key(row["cid"])
            return {"text": "\n".join(json.dumps({"key": k, "value": f"of {k}"}) for k in row["keys"])}

        return complete.complete(rows, one, columns=("cid", "messages", "keys"))

    return model


def test_reformat_asks_once_for_a_group(spark, table):
    plan, asked = inputs(spark), spark.sparkContext.accumulator(0)
    engine.resume(table, *plan, batching={"size": 2})
    task = engine.annotation(plan[2], format_=saying_keys(lambda cid: asked.add(1)))(documents.RUN_DEFAULTS | {"batching": {"size": 2}})
    assert engine.reformat(table, plan[3], task) == (2 * 3 * 3, 2 * 3) and asked.value == 2 * 3 * 2


def test_reformat_of_runs_that_were_grouped_otherwise(spark, table):
    """Groups of two runs of a paper begin with the same question and go on with others: each keeps its own questions."""
    runs, *plan = inputs(spark)
    engine.resume(table, runs.where("run_id = 10"), *plan, batching=[["quality", "size"]])
    engine.resume(table, runs.where("run_id = 11"), *plan, batching="all")
    assert engine.reformat(table, plan[2], task_of((runs, *plan), format_=saying_keys(lambda cid: None))) == (2 * 3 * 3, 2 * 3)
    said = {14: "of quality", 15: "of kind", 16: "of size"}
    rows = table.view().where("paper_id < 3").collect()
    assert len(rows) == 18 and all(json.loads(json.loads(r.payload_json)["raw_response"])["parse_result"]["value"]["said"] == said[r.version_id] for r in rows)


def test_reformat_of_nothing(spark, table):
    plan = inputs(spark)
    assert engine.reformat(table, plan[3], task_of(plan)) == (0, 0)


def runs_of(spark, config, n=2):
    return spark.createDataFrame([(10 + i, f"run {i}", json.dumps(config), i) for i in range(n)], "run_id long, name string, config string, r_order int")


def test_chunks_are_kept_posted_and_told(spark, table, tmp_path):
    _, papers, asked, texts = inputs(spark, 5)
    beats, sent = [], []
    hooks = engine.Hooks(report=beats.append, send=lambda run, bodies: (200, {}))
    config = {"batching": {"size": 2}, "chunk_papers": 2}
    out = engine.run_all(table, runs_of(spark, config), papers, asked, texts, engine.annotation(asked), hooks=hooks, checkpoints=str(tmp_path / "p1"))
    assert [(o.run_id, o.status, o.total, o.done, o.errors) for o in out] == [(10, "succeeded", 15, 15, 3), (11, "succeeded", 15, 15, 3)]
    assert [b["message"] for b in beats[:5]] == ["run 1/2 (run 0): starting", "run 1/2 (run 0): chunk 1/3", "run 1/2 (run 0): chunk 2/3", "run 1/2 (run 0): chunk 3/3", "run 1/2 (run 0): done, moving to next run"]
    assert [b["status"] for b in beats].count("succeeded") == 1 and beats[-1]["status"] == "succeeded" and all(None not in b.values() for b in beats)
    assert table.view().where("status = 'posted'").count() == 30 and not sent


def test_cancelled_before_a_chunk(spark, table):
    _, papers, asked, texts = inputs(spark)
    asked_for, beats = [], []
    hooks = engine.Hooks(report=beats.append, cancelled=lambda: asked_for.append(1) or len(asked_for) > 1)
    (out,) = engine.run_all(table, runs_of(spark, {"chunk_papers": 2}), papers, asked, texts, engine.annotation(asked), hooks=hooks)
    assert out.status == "canceled" and out.done == 6 and beats[-1]["status"] == "canceled" and table.view().count() == 6


def test_fail_fast_ends_after_the_chunk(spark, table):
    _, papers, asked, texts = inputs(spark)
    spoiled = lambda rows: complete.dummy(rows).withColumn("completion", F.col("completion").withField("text", F.lit("nothing")))
    for fail_fast, runs_done in ((True, 1), (False, 2)):
        t = state.StateTable(spark, f"{table.path}-{fail_fast}")
        out = engine.run_all(t, runs_of(spark, {"chunk_papers": 2, "fail_fast": fail_fast}), papers, asked, texts, engine.annotation(asked, format_=spoiled))
        assert len(out) == runs_done and out[0].status == ("failed" if fail_fast else "succeeded") and out[0].done == (6 if fail_fast else 12)
    details = {json.loads(r.payload_json)["extraction_detail"] for r in t.view().collect()}
    assert "no_ocr" in details and any(d.startswith("Pass-2 extraction failed for 3 key(s): 'quality': key 'quality' not found") for d in details)


def test_failed_calls_are_tried_again_and_reporters_may_fail(spark, table):
    _, papers, asked, texts = inputs(spark)
    broken = lambda rows: complete.dummy(rows).withColumn("completion", F.col("completion").withField("error", F.lit("status 500")))

    def report(beat):
        raise RuntimeError("no server")

    (out,) = engine.run_all(table, runs_of(spark, {}, 1), papers, asked, texts, engine.annotation(asked, reason=broken), hooks=engine.Hooks(report=report))
    assert (out.failed, out.errors) == (9, 12) and table.view().where("status = 'failed' and error = 'status 500'").count() == 9 and table.unposted().count() == 3
    engine.run_all(table, runs_of(spark, {}, 1), papers, asked, texts, engine.annotation(asked))
    assert table.view().where("status = 'done'").count() == 12


def test_posting_that_fails_leaves_rows_unposted(spark, table):
    _, papers, asked, texts = inputs(spark)
    engine.run_all(table, runs_of(spark, {}, 1), papers, asked, texts, engine.annotation(asked))
    engine.repost_all(table, asked, engine.Hooks(send=lambda run, bodies: (200, {"errors": ["refused"]}) if '"paper":1,' in bodies[0] else (404, {})))
    assert {r.paper_id for r in table.view().where("status = 'posted'").collect()} == {1}
    lines = [r.line for r in engine.repost_all(table, asked, engine.Hooks(dry_run=True), paper_ids=[2]).collect()]
    assert len(lines) == 3 and lines[0].startswith("run=10 paper=2 q=") and table.view().where("status = 'posted'").count() == 3


def test_checkpoint_keeps_what_was_paid_for(spark, tmp_path):
    _, papers, asked, texts = inputs(spark)
    seen = []

    def reason(rows):
        seen.append(rows.count())
        return complete.dummy(rows)

    keep, task = engine.Checkpoint(str(tmp_path / "p1"), 10), engine.annotation(asked, reason=reason)(documents.RUN_DEFAULTS)
    for _ in range(2):
        rows = engine.perform(runs_of(spark, {}, 1), papers, texts, task, checkpoint=keep)
        assert rows.where("status = 'done'").count() == 12
    assert seen[0] == 3 and seen[2] == 0


def test_passes_apart_ask_once(spark, table):
    plan = inputs(spark)
    seen = []

    def reason(rows):
        seen.append(rows.count())
        return complete.dummy(rows)

    task = task_of(plan, reason=reason)
    for _ in range(2):
        assert engine.run_pass1(table, plan[0], plan[1], plan[3], task) == 0
    assert seen == [6, 0] and table.pass1().count() == 18
    engine.run_pass2(table, plan[3], task)
    assert table.pass1().count() == 0 and table.unposted().count() == 18


def test_probe_stops_all_calls(spark):
    rows = spark.createDataFrame([("b", "x"), ("a", "y")], "cid string, messages string")
    made = spark.sparkContext.accumulator(0)

    def bad(row):
        made.add(1)
        raise RuntimeError("no")

    assert {r.completion.error for r in complete.probed(rows, bad).collect()} == {"RuntimeError | no"} and made.value == 1
    assert {r.cid: r.completion.text for r in complete.probed(rows, lambda row: {"text": row["cid"]}, concurrency=2, tasks=2).collect()} == {"a": "a", "b": "b"}


def test_job_state_and_batches(spark, tmp_path):
    kept, polls = state.JobState(spark, str(tmp_path / "jobs")), iter(["running", "done"])

    class Provider:
        def submit(self, lines):
            return "b1"

        def poll(self, batch):
            return next(polls)

        def collect(self, batch):
            return spark.createDataFrame([(batch,)], "cid string")

    provider = complete.provider_of("Fake", {"fake": Provider})
    with pytest.raises(ValueError):
        complete.provider_of("other", {"fake": Provider})
    with pytest.raises(complete.BatchPending):
        complete.batched(kept, "10:p1:0", provider, None)
    assert dict(state.JobState(spark, str(tmp_path / "jobs"))) == {"10:p1:0": "b1"}
    assert complete.batched(kept, "10:p1:0", provider, None).first().cid == "b1" and len(kept) == 0
    assert complete.worth_warming(cache=True, cache_first="questions", n_requests=2, provider="anthropic", submitted=False)
    assert not complete.warmed(lambda: 1 / 0)


def test_fetched_texts(spark, tmp_path):
    def get(paper):
        return {0: (200, {"markdown": "text"}), 1: (404, None), 2: (200, {"markdown": ""})}.get(paper, (400, None))

    texts = state.SourceTexts(spark, str(tmp_path / "texts"))
    papers = spark.range(4).select(F.col("id").alias("paper_id"))
    texts.save(remote.fetched(papers, get))
    assert {r.paper_id: r.markdown for r in texts.view().collect()} == {0: "text", 1: None, 2: None, 3: None} and texts.count() == 4
    assert remote.with_fetched(papers, texts.view(), get).count() == 3


def test_settings_reach_a_run(spark, tmp_path, monkeypatch):
    path = tmp_path / "s.toml"
    path.write_text('[run_defaults]\nchunk_papers = 3\n[providers.openai]\napi_key_env = "A_KEY"\n')
    monkeypatch.setenv(documents.SETTINGS_VARIABLE, str(path))
    monkeypatch.setenv("A_KEY", "k")
    got = documents.Settings.load()
    assert got.run_defaults == {"chunk_papers": 3} and got.api_key("openai") == "k" and got.api_key("other") is None
    assert grid.parse_ids("1, 2,") == [1, 2] and grid.parse_ids(None) is None
    rows = spark.range(3).select(F.col("id").alias("run_id"))
    assert grid.selected(rows, "run_id", [1]).count() == 1 and grid.selected(rows, "run_id", None).count() == 3
    with pytest.raises(Exception, match="unknown question type"):
        spark.range(1).select(C.map_value(F.lit("date"), F.lit(False), replies.value_column(F.lit("1")), F.array(F.lit("a"))).alias("m")).collect()


def test_two_writers_of_one_number(spark, table):
    row = lambda p: spark.createDataFrame([(1, 1, 1, p, "g")], "run_id long, paper_id long, version_id long, payload_json string, batch_group_id string")
    other = state.StateTable(spark, table.path)
    log, table.log, other.log = table.log, lambda: spark.createDataFrame([], table.schema), lambda: spark.createDataFrame([], table.schema)
    table.save(row('{"a":1}'))
    other.save(row('{"b":1}'))
    table.log = log
    assert len({table.view().first().payload_json for _ in range(3)}) == 1 and table.view().count() == 1
    table.save(row('{"c":1}').union(row('{"d":1}')).coalesce(1))
    assert table.view().first().payload_json == '{"d":1}'


def test_run_log(tmp_path):
    log = sinks.run_log(str(tmp_path / "run.log"), "inkgrid.test")
    sinks.run_log(str(tmp_path / "run.log"), "inkgrid.test").info("hello")
    assert len(log.handlers) == 1 and (tmp_path / "run.log").read_text().strip().endswith("inkgrid.test: hello")


def test_completer_keeps_errors_as_rows(spark):
    def call(row):
        if row["cid"] == "b":
            raise RuntimeError("no")
        return {"text": row["cid"]}

    got = {r.cid: r.completion for r in complete.complete(spark.createDataFrame([("a", "x"), ("b", "y")], "cid string, messages string"), call).collect()}
    assert got["a"].text == "a" and got["b"].error == "RuntimeError | no"


def test_documents_are_read_with_their_order(spark, tmp_path):
    doc = {"review_id": 1, "setup_id": 2, "api_base": "http://x/", "papers": [{"paper_id": 5, "title": "b"}, {"paper_id": 4, "title": "a"}], "questions": [], "runs": [{"run_id": 1, "name": "r", "config": {"rpm": None}}], "other": 1}
    path = tmp_path / "p.json"
    path.write_text(json.dumps(doc, indent=1))
    got = documents.pipeline(spark, str(path))
    assert [(r.paper_id, r.p_order) for r in got["papers"].orderBy("p_order").collect()] == [(5, 0), (4, 1)]
    assert json.loads(got["runs"].first().config) == {"rpm": None}


def test_cache_marks_and_requests(spark):
    m = prompts.pass1_messages(F.lit("source"), F.lit("asked"), F.lit("text"))
    row = spark.range(1).select(prompts.cached(m, F.lit("anthropic"), F.lit(True), F.lit("1h")).alias("m"), prompts.cached(m, F.lit("gemini"), F.lit(True), F.lit("1h")).alias("short"), prompts.request_body(F.lit("1-2-0"), m, F.lit("model"), "anthropic").alias("body")).first()
    assert [[b.cache_ttl for b in x.blocks] for x in row.m] == [[None], ["1h"], [None]] and all(b.cache_ttl is None for x in row.short for b in x.blocks)
    body = json.loads(row.body)
    assert body["custom_id"] == "1-2-0" and [x["role"] for x in body["params"]["messages"]] == ["user", "user"] and body["params"]["system"] == prompts.SYSTEM


def test_batch_results(spark, tmp_path):
    ok = {"custom_id": "a", "response": {"status_code": 200, "body": {"choices": [{"message": {"content": "hi"}}], "usage": {"prompt_tokens": 3}}}}
    (tmp_path / "out.jsonl").write_text(json.dumps(ok) + "\n\nnot json\n")
    (tmp_path / "err.jsonl").write_text(json.dumps({"custom_id": "b", "error": {"message": "bad"}}) + "\n")
    got = {r.cid: (r.text, r.error) for r in documents.batch_results(spark, str(tmp_path / "out.jsonl"), str(tmp_path / "err.jsonl")).collect()}
    assert got == {"a": ("hi", None), "b": (None, "bad")}


def test_throttle_counts_from_the_last_sent(spark):
    beats = spark.createDataFrame([(1, t) for t in (0.0, 1.0, 1.5, 2.9, 3.0)] + [(2, 0.5)], "run_id int, s double").select("run_id", "s", F.timestamp_seconds("s").alias("ts"), F.lit(1).alias("event_id"))
    assert sorted((r.run_id, r.s) for r in progress.throttled(beats).collect()) == [(1, 0.0), (1, 1.5), (1, 3.0), (2, 0.5)]


def test_stream_runs_each_row_once(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "in"))
    seen = []
    for _ in range(2):
        q = progress.incremental(spark.readStream.schema("id long").parquet(str(tmp_path / "in")), lambda df, _: seen.extend(r.id for r in df.collect()), str(tmp_path / "cp"))
        q.awaitTermination()
    assert sorted(seen) == list(range(5))
