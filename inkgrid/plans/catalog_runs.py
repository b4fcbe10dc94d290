"""Queries of whole runs: chunks, passes apart, formatting again, posting, arbitration, comparison, the read side.

State is written to a new folder that all executors share, and the query is over what stands in it afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import complete, disputes, grid, payload, prompts, reports, sinks, state, views
from ..sources import documents as S
from . import arbitration, bench, catalog, engine
from .registry import query

_RUNS = "(values (cast(10 as bigint)), (11)) r(run_id)"
_CONFIG = '{"batching": {"size": 2}, "chunk_papers": 0}'


def _runs(spark: SparkSession, config: str = _CONFIG) -> DataFrame:
    return spark.createDataFrame([(10, "one", config, 0), (11, "two", config, 1)], "run_id long, name string, config string, r_order int")


def _table(spark: SparkSession) -> state.StateTable:
    return state.StateTable(spark, S.scratch(spark, "answers"))


def _run(spark: SparkSession, sf_dir: str, hooks: engine.Hooks | None = None) -> tuple[state.StateTable, list[engine.Outcome]]:
    """Two runs of three questions over all documents, with the deterministic model."""
    table = _table(spark)
    asked = catalog.questions(spark)
    out = engine.run_all(table, _runs(spark), S.papers_of(spark, sf_dir), asked, S.source_text_of(spark, sf_dir), engine.annotation(asked), hooks=hooks)
    return table, out


def accepting(run: int, bodies: list[str]) -> tuple[int, dict]:
    """An endpoint that takes all but texts of papers with a 7 at the end, of which it refuses an item, and fails for those with a 9."""
    last = bodies[0].split('"paper":')[1].split(",")[0][-1]
    return (400, {}) if last == "9" else (200, {"errors": ["no"] if last == "7" else []})


@query(f"select r.run_id, case when d.doc_id % 10 = 9 then 'done' else 'posted' end as status, cast(count(*) as bigint) as n, cast(sum(case when q.pos = 0 and d.text <> '' then 15 else 0 end) as bigint) as tokens from {_RUNS}, documents d, {catalog._Q} group by all")
def run_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs by chunks, kept and posted; what the endpoint fails to take stays done."""
    table, _ = _run(spark, sf_dir, engine.Hooks(send=accepting))
    tokens = F.coalesce(payload.body()["tokens_total"], F.lit(0).cast("bigint"))
    return table.view().groupBy("run_id", "status").agg(F.count("*").alias("n"), F.sum(tokens).alias("tokens"))


@query("select run_id, 'succeeded' as status, cast(n * 3 as bigint) as total, cast(n * 3 as bigint) as done, cast((n - have) * 3 as bigint) as errors from (select count(*) as n, count(*) filter (text <> '') as have from documents), (values (cast(10 as bigint)), (11)) r(run_id)")
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, out = _run(spark, sf_dir)
    return spark.createDataFrame([(o.run_id, o.status, o.total, o.done, o.errors) for o in out], "run_id long, status string, total long, done long, errors long")


@query("""with n as (select count(*) * 3 as n, count(*) filter (text is null or text = '') * 3 as e from documents)
select cast(i as int) as i, run_id, status, message, cast(n as bigint) as cells_total, cast(case when done then n else 0 end as bigint) as cells_done, cast(case when done then e else 0 end as bigint) as cells_error from n, (values (0, 10, 'running', 'run 1/2 (one): starting', false), (1, 10, 'running', 'run 1/2 (one): chunk 1/1', true), (2, 10, 'running', 'run 1/2 (one): done, moving to next run', true),
(3, 11, 'running', 'run 2/2 (two): starting', false), (4, 11, 'running', 'run 2/2 (two): chunk 1/1', true), (5, 11, 'succeeded', 'run 2/2 (two): succeeded', true)) b(i, run_id, status, message, done)""")
def run_heartbeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is reported of a run: only the last one says how it ended."""
    beats: list[dict] = []
    _run(spark, sf_dir, engine.Hooks(report=beats.append))
    rows = [(i, b["run_id"], b["status"], b["message"], b["cells_total"], b["cells_done"], b["cells_error"]) for i, b in enumerate(beats)]
    return spark.createDataFrame(rows, "i int, run_id int, status string, message string, cells_total long, cells_done long, cells_error long")


def _chunked(spark: SparkSession, sf_dir: str, table: state.StateTable, hooks: engine.Hooks | None = None, config: str = "", n_runs: int = 2, **how) -> list[engine.Outcome]:
    """As _run(), by three chunks."""
    papers, asked = S.papers_of(spark, sf_dir), catalog.questions(spark)
    settings = f'{{"batching": {{"size": 2}}, "chunk_papers": {papers.count() // 3 + 1}{config}}}'
    runs = _runs(spark, settings).where(F.col("r_order") < n_runs)
    return engine.run_all(table, runs, papers, asked, S.source_text_of(spark, sf_dir), engine.annotation(asked), hooks=hooks, **how)


#: Of each row of the state: which of three chunks of papers its own is in.
_THIRDS = f"(select r.run_id, d.doc_id, d.text, q.pos, least(2, (row_number() over (partition by r.run_id, q.version_id order by d.doc_id) - 1) // (n // 3 + 1)) as chunk from {_RUNS}, documents d, {catalog._Q}, (select count(*) as n from documents))"


@query(f"select run_id, cast(chunk as bigint) as chunk, case when doc_id % 10 = 9 then 'done' else 'posted' end as status, cast(count(*) as bigint) as n, cast(sum(case when pos = 0 and text <> '' then 15 else 0 end) as bigint) as tokens from {_THIRDS} group by all")
def run_three_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three chunks a run, each an append and, but for what the endpoint failed to take, an append of what was posted."""
    table = _table(spark)
    _chunked(spark, sf_dir, table, engine.Hooks(send=accepting))
    tokens = F.coalesce(payload.body()["tokens_total"], F.lit(0).cast("bigint"))
    first = table.log().where("status = 'done'").groupBy(*table.keys).agg(F.min("seq").alias("seq"))
    of = first.select("run_id", "seq").distinct().withColumn("chunk", F.row_number().over(Window.partitionBy("run_id").orderBy("seq")).cast("bigint") - 1)
    rows = table.view().drop("seq").join(first, table.keys).join(of, ["run_id", "seq"])
    return rows.groupBy("run_id", "chunk", "status").agg(F.count("*").alias("n"), F.sum(tokens).alias("tokens"))


@query(f"select i.step, r.run_id, i.status, cast(i.chunks * 3 as bigint) as chunk_cells from (values (cast(0 as int), 10, 'canceled', 1), (1, 10, 'succeeded', 2), (1, 11, 'succeeded', 3)) i(step, run_id, status, chunks), {_RUNS} where i.run_id = r.run_id")
def run_canceled_and_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that is canceled after its first chunk, and the call that goes on where it stopped: cells that each call kept, in chunks of papers, times three questions."""
    table, beats = _table(spark), []
    out = [(0, o) for o in _chunked(spark, sf_dir, table, engine.Hooks(report=beats.append, cancelled=lambda: len(beats) > 1))]
    out += [(1, o) for o in _chunked(spark, sf_dir, table)]
    size = S.papers_of(spark, sf_dir).count() // 3 + 1
    return spark.createDataFrame([(step, o.run_id, o.status, 3 * -(-(o.done // 3) // size)) for step, o in out], "step int, run_id long, status string, chunk_cells long")


class FiledBatches:
    """A provider of batches whose requests are files: the first time it's asked a batch is running, then it's done, with the deterministic model's replies."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.asked = spark, {}

    def submit(self, lines: DataFrame) -> str:
        return complete.submitted_lines(lines, S.scratch(self.spark, "batch"))

    def poll(self, batch: str) -> str:
        self.asked[batch] = self.asked.get(batch, 0) + 1
        return "running" if self.asked[batch] == 1 else "done"

    def collect(self, batch: str) -> DataFrame:
        line = "custom_id string, body struct<messages:array<struct<role:string,content:string>>>"
        said = F.array_join(F.transform("r.body.messages", lambda m: m["content"]), "\n")
        keys = F.regexp_extract_all(said, F.lit(r"(?m)^- (\w+) \("), F.lit(1))
        rows = self.spark.read.text(batch).select(F.from_json("value", line).alias("r")).select(F.col("r.custom_id").alias("cid"), keys.alias("keys"))
        text = F.when(F.size("keys") > 0, complete.dummy_reply(F.col("keys"))).otherwise("Dummy reasoning.")
        return rows.select("cid", text.alias("text"), F.lit(10).cast("bigint").alias("input_tokens"), F.lit(5).cast("bigint").alias("output_tokens"), F.lit(None).cast("string").alias("error"))


@query(f"""with c as (select chunk, run_id, count(*) as n, count(*) filter (text <> '') as have from {_THIRDS} group by all)
select i.step, c.run_id, case when i.step < 2 then 'parked' else 'succeeded' end as status, cast(case when i.step < 2 then 3 else 0 end as bigint) as parked, cast(sum(case when i.step < 2 then 0 else c.n end) as bigint) as done, cast(sum(case when i.step < 2 then 0 else c.have end) as bigint) as answered from c, range(3) i(step) where run_id = 10 group by all""")
def run_by_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both passes by batches, a batch a chunk and pass, over three calls: submitted; pass 1 collected and pass 2 submitted; pass 2 collected."""
    table, provider, path = _table(spark), FiledBatches(spark), S.scratch(spark, "jobs")
    jobs, out = state.JobState(spark, path), []
    batches = engine.Batches(jobs, {"openai": lambda: provider}, "openai", "model")
    for step in range(3):
        done = _chunked(spark, sf_dir, table, config=', "batch_p1": true, "batch_p2": true', n_runs=1, batches=batches, checkpoints=f"{path}-pass1")
        answered = {r["run_id"]: r["n"] for r in table.view().where("batch_group_id is not null").groupBy("run_id").agg(F.count("*").alias("n")).collect()}
        out += [(step, o.run_id, o.status, o.parked, o.done, answered.get(o.run_id, 0)) for o in done]
    return spark.createDataFrame(out, "step long, run_id long, status string, parked long, done long, answered long")


_KEY = "case q.version_id when 14 then 'quality' when 15 then 'kind' else 'size' end"


@query(f"select run, cast(count(*) as bigint) as n, md5(string_agg(line, chr(10) order by line)) as digest from (select r.run_id as run, 'run=' || r.run_id || ' paper=' || d.doc_id || ' q=' || {_KEY} || ' value=null' as line from {_RUNS}, documents d, {catalog._Q}) group by all")
def dry_run_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of a dry run of several chunks."""
    out = _chunked(spark, sf_dir, _table(spark), engine.Hooks(dry_run=True))
    rows = out[0].lines.unionByName(out[1].lines)
    return rows.groupBy("run").agg(F.count("*").alias("n"), F.md5(F.array_join(F.array_sort(F.collect_list("line")), "\n")).alias("digest"))


@query(f"select cast(i.step as int) as step, r.run_id, cast(count(*) * 3 as bigint) as n, cast(case i.step when 0 then 3 when 1 then 0 else 1 end as bigint) as appends from {_RUNS}, documents d, (values (0), (1), (2)) i(step) group by all")
def state_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells a run in the state, and appends that a run reads: before a snapshot, after it, after one more append and the removal of what the snapshot replaces."""
    table, out = _table(spark), []

    def look(step: int) -> None:
        counts = table.view().groupBy("run_id").agg(F.count("*").alias("n")).collect()
        out.extend((step, r["run_id"], r["n"], len(table.appends(table.snapshot(), [r["run_id"]]))) for r in counts)

    _chunked(spark, sf_dir, table)
    look(0)
    table.compact()
    look(1)
    for run in (10, 11):
        table.save(table.view([run]).where("paper_id = 1"), F.col("status"), runs=[run])
    table.vacuum(0)
    look(2)
    return spark.createDataFrame(out, "step int, run_id long, n long, appends long")


_ALL = f"{_RUNS}, documents d, {catalog._Q}"


@query(f"select r.run_id, d.doc_id as paper_id, cast(q.version_id as bigint) as version_id, r.run_id || '-' || d.doc_id || '-' || q.group_idx as batch_group_id, case when q.pos = 0 then 'Dummy reasoning.' else '' end as reasoning from {_ALL} where d.text <> ''")
def pass1_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first pass alone: a row a question, the reasoning in the first of each group, nothing for papers without a text."""
    table, task = _table(spark), engine.annotation(catalog.questions(spark))(S.overlaid(_CONFIG))
    engine.run_pass1(table, _runs(spark), S.papers_of(spark, sf_dir), S.source_text_of(spark, sf_dir), task)
    return table.pass1().select("run_id", "paper_id", "version_id", "batch_group_id", C.pass1_text(F.get_json_object("payload_json", "$.raw_response")).alias("reasoning"))


@query(f"select r.run_id, d.doc_id as paper_id, cast(q.version_id as bigint) as version_id, 'done' as status, cast(case when q.pos = 0 then 15 else 0 end as bigint) as tokens, cast(case when q.pos = 0 then 15 else 0 end as bigint) as fmt_tokens from {_ALL} where d.text <> ''")
def passes_apart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first pass, then the second one over what the first kept."""
    table, task = _table(spark), engine.annotation(catalog.questions(spark))(S.overlaid(_CONFIG))
    texts = S.source_text_of(spark, sf_dir)
    engine.run_pass1(table, _runs(spark), S.papers_of(spark, sf_dir), texts, task)
    engine.run_pass2(table, texts, task)
    return table.view().withColumn("p", payload.body()).select("run_id", "paper_id", "version_id", "status", F.col("p.tokens_total").alias("tokens"), F.col("p.fmt_tokens_total").alias("fmt_tokens"))


def _yes(rows: DataFrame) -> DataFrame:
    """A format model that answers every key with yes."""
    one = lambda k: F.concat(F.lit('{"key":"'), k, F.lit('","value":"yes","comment":"again","cited_text":""}'))
    dummy = engine.format_dummy(rows)
    return dummy.withColumn("completion", F.col("completion").withField("text", F.array_join(F.transform("keys", one), "\n")))


@query(f"select r.run_id, d.doc_id as paper_id, cast(q.version_id as bigint) as version_id, case when d.text <> '' then 'yes' end as said, case when d.text <> '' then 'again' else '' end as comment, cast(case when q.pos = 0 and d.text <> '' then 15 else 0 end as bigint) as tokens, case when q.pos = 0 and d.text <> '' then 'Dummy reasoning.' else '' end as reasoning from {_ALL}")
def reformat_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored reasoning formatted by another model: values change; tokens, reasoning and rows without reasoning stay."""
    table, _ = _run(spark, sf_dir)
    task = engine.annotation(catalog.questions(spark), format_=_yes)(S.overlaid(_CONFIG))
    engine.reformat(table, S.source_text_of(spark, sf_dir), task)
    raw = F.col("p.raw_response")
    rows = table.view().withColumn("p", payload.body())
    return rows.select("run_id", "paper_id", "version_id", F.get_json_object(raw, "$.parse_result.value.said").alias("said"), F.col("p.comment").alias("comment"), F.col("p.tokens_total").alias("tokens"), C.pass1_text(raw).alias("reasoning"))


@query(f"{catalog._LATEST}, p as (select run_id, paper_id, version_id from last where status in ('done', 'posted') and has_payload and version_id in (14, 15, 16)) select run_id as run, paper_id as paper, cast(count(*) as int) as n_items, cast(case when paper_id % 10 = 7 then 1 else 0 end as int) as n_rejected, case when paper_id % 10 = 9 then 'RuntimeError | status 400 after 1 tries' end as error from p group by all")
def post_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored answers posted again, a call a run and paper: items that are refused are told, calls that fail too."""
    items = engine.wire(state.postable(catalog._states(spark, sf_dir)), catalog.questions(spark))
    return sinks.post(sinks.as_json(items), accepting).select("run", "paper", "n_items", "n_rejected", "error")


@query(f"{catalog._LATEST} select run_id as run, paper_id as paper, 'paper=' || paper_id || ' q=' || case version_id when 14 then 'quality' when 15 then 'kind' else 'size' end || ' value=null' as line from last where status in ('done', 'posted') and has_payload and version_id in (14, 15, 16)")
def dry_run_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.dry_run(engine.wire(state.postable(catalog._states(spark, sf_dir)), catalog.questions(spark)))


@query(f"{catalog._LATEST} select run_id as run, paper_id as paper, version_id as question_version, case version_id when 14 then 'quality' when 15 then 'kind' else 'size' end as question_key, 'ok' as status, '' as detail, '' as raw_response, k as tokens_total, k * 2 as tokens_input, cast(0 as bigint) as tokens_output, k as tokens_cached, cast(0 as bigint) as latency_ms, 'USD' as cost_currency from last where status in ('done', 'posted') and has_payload and version_id in (14, 15, 16)")
def wire_items_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wire items of stored answers whose bodies lack most fields."""
    items = engine.wire(state.postable(catalog._states(spark, sf_dir)), catalog.questions(spark))
    return items.select("run", "paper", "question_version", "question_key", "status", "detail", "raw_response", "tokens_total", "tokens_input", "tokens_output", "tokens_cached", "latency_ms", "cost_currency")


# -- arbitration

_ARBITERS = '{"batching": "all", "chunk_papers": 0, "text_source": "%s"}'


def _arbiters(spark: SparkSession, text_source: str) -> DataFrame:
    return spark.createDataFrame([(21, "arbiter", _ARBITERS % text_source, 0)], "run_id long, name string, config string, r_order int")


@query(f"select cast(21 as bigint) as arbiter_run_id, l.doc_id * 2 as dispute_item_id, l.doc_id as paper_id, cast(14 as bigint) as version_id, 'done' as status, case when d.text <> '' then 'ok' else 'error' end as resolution_status, case when d.text <> '' then '{C.UNDECIDED}' else 'no_ocr' end as resolution_detail, cast(case when d.text <> '' then 15 else 0 end as bigint) as tokens from labels l join documents d using (doc_id)")
def arbitrate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Disputes settled from plan to state; those of an unknown question are left out."""
    table = state.resolutions(spark, S.scratch(spark, "resolutions"))
    arbitration.run(table, _arbiters(spark, "full_text"), catalog._disputes(spark, sf_dir), catalog.questions(spark), S.source_text_of(spark, sf_dir))
    rows = table.view().withColumn("p", payload.body())
    return rows.select("arbiter_run_id", "dispute_item_id", "paper_id", "version_id", "status", F.col("p.resolution_status").alias("resolution_status"), F.col("p.resolution_detail").alias("resolution_detail"), F.col("p.tokens_total").alias("tokens"))


_ASKED = "- key=''quality'': Is the text good?"


def _block(text: str) -> str:
    def one(name: str, c: str) -> str:
        return f"'Candidate {name}: ' || l.{c} || case when l.{c} = 1 and d.text <> '' then chr(10) || '  Evidence: ' || d.text else '' end"

    asked = f"'Questions:' || chr(10) || '{_ASKED}' || chr(10) || '  {prompts.INCLUSION}' || chr(10) || '  Candidates:' || chr(10) || {one('A', 'quality')} || chr(10) || {one('B', 'toxic')}"
    head = "'[system]' || chr(10) || '" + prompts.ARBITER.replace("'", "''") + "' || chr(10) || chr(10) || '[user]' || chr(10) || "
    return f"select l.doc_id as paper_id, md5({head}{text} || chr(10) || chr(10) || '[user]' || chr(10) || {asked}) as digest from labels l join documents d using (doc_id)"


def _arbiter_prompts(spark: SparkSession, sf_dir: str, text_source: str) -> DataFrame:
    rows, config = catalog._disputes(spark, sf_dir), S.overlaid(_ARBITERS % text_source, None, S.ARBITER_DEFAULTS)
    task = arbitration.arbitration(rows, catalog.questions(spark))(config)
    have, _ = grid.with_source(disputes.papers(rows), S.source_text_of(spark, sf_dir), text_source)
    asked = engine.calls(_arbiters(spark, text_source), have, task)
    return prompts.preview(asked.select("paper_id", "cid", "messages")).join(asked.select("cid", "paper_id"), "cid").select("paper_id", F.md5("prompt").alias("digest"))


@query(_block("'Document:' || chr(10) || d.text") + " where d.text <> ''")
def arbiter_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _arbiter_prompts(spark, sf_dir, "full_text")


@query(_block("'" + prompts.NO_TEXT + "'"))
def arbiter_prompts_candidates_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _arbiter_prompts(spark, sf_dir, "candidates_only")


@query("select cast(21 as bigint) as run, l.doc_id as paper, l.doc_id * 2 as dispute_item, 'quality' as question_key, 'ok' as status, 'yes' as comment, 'true' as value from labels l")
def arbitrate_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arbitration by its passes without texts, formatted again with another model, as items to post."""
    table = state.resolutions(spark, S.scratch(spark, "resolutions"))
    rows, asked, config = catalog._disputes(spark, sf_dir), catalog.questions(spark), S.overlaid(_ARBITERS % "candidates_only", None, S.ARBITER_DEFAULTS)
    task, texts = arbitration.arbitration(rows, asked)(config), S.source_text_of(spark, sf_dir)
    arbitration.run_pass1(table, _arbiters(spark, "candidates_only"), rows, texts, task)
    arbitration.run_pass2(table, texts, task)
    arbitration.reformat(table, texts, arbitration.arbitration(rows, asked, format_=lambda d: _yes(d).withColumn("completion", F.col("completion").withField("text", F.replace(F.col("completion.text"), F.lit("again"), F.lit("yes")))))(config))
    return engine.wire(table.postable(), asked, "resolution").select("run", "paper", "dispute_item", "question_key", "status", "comment", "value")


@query("select case when doc_id % 10 = 9 then 'done' else 'posted' end as status, 'ok' as resolution_status, cast(count(*) as bigint) as n from labels group by all")
def resolutions_posted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolutions posted as they are kept, a call a paper; what the endpoint fails to take stays done."""
    table = state.resolutions(spark, S.scratch(spark, "resolutions"))
    arbitration.run(table, _arbiters(spark, "candidates_only"), catalog._disputes(spark, sf_dir), catalog.questions(spark), S.source_text_of(spark, sf_dir), hooks=engine.Hooks(send=accepting))
    return table.view().groupBy("status", payload.body()["resolution_status"].alias("resolution_status")).agg(F.count("*").alias("n"))


_FORMAT = "'[user]' || chr(10) || 'Write the answers below as JSON, an object with a list \"results\" of key, value, cited_text, comment, confidence.' || chr(10) || 'Keys:' || chr(10) || %s || chr(10) || chr(10) || 'Answers:' || chr(10) || 'Dummy reasoning.'"


@query(f"select r.run_id, d.doc_id as paper_id, cast(g.group_idx as int) as group_idx, md5({_FORMAT % 'g.specs'}) as digest from {_RUNS}, documents d, (values (0, '- quality (boolean)' || chr(10) || '- kind (categorical)'), (1, '- size (integer)')) g(group_idx, specs) where d.text <> ''")
def pass2_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What pass 2 would be asked, after the deterministic model's reasoning."""
    task = engine.annotation(catalog.questions(spark), format_=lambda rows: rows)(S.overlaid(_CONFIG))
    have, _ = grid.with_source(S.papers_of(spark, sf_dir), S.source_text_of(spark, sf_dir))
    asked = engine.pass2(engine.pass1(engine.calls(_runs(spark), have, task)), task)
    shown = prompts.preview(asked, 2).join(asked.select("cid", "run_id", "paper_id", "group_idx"), "cid")
    return shown.select("run_id", "paper_id", F.col("group_idx").cast("int").alias("group_idx"), F.md5("prompt").alias("digest"))


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of answers as one of resolutions: the item is event_id % 400."""
    log = catalog.answer_log(spark, sf_dir).withColumn("dispute_item_id", F.col("seq") % 400).withColumnRenamed("run_id", "arbiter_run_id")
    return state.latest(log, ("arbiter_run_id", "dispute_item_id"))


_ITEMS = f"with {catalog._LOG}, last as (select * from (select *, seq % 400 as item, row_number() over (partition by run_id, seq % 400 order by seq desc) as rn from log) where rn = 1)"


@query(f"{_ITEMS} select run_id as arbiter_run_id, item as dispute_item_id, status, status in ('done', 'posted') as skipped, status = 'done' and has_payload as unposted, status in ('done', 'posted') and has_payload as postable, status = 'pass1_done' and has_payload as reasoned from last")
def resolution_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["arbiter_run_id", "dispute_item_id"]
    rows = _resolved(spark, sf_dir)
    out = rows.select(*keys, "status", F.col("status").isin(*grid.COMPLETE).alias("skipped"))
    for name, scan in (("unposted", state.unposted), ("postable", state.postable), ("reasoned", state.pass1)):
        out = out.join(scan(rows).select(*keys, F.lit(True).alias(name)), keys, "left").withColumn(name, F.coalesce(name, F.lit(False)))
    return out


@query(f"{_ITEMS}, cell as (select * from (select *, row_number() over (partition by run_id, paper_id, version_id order by item desc) as r2 from last) where r2 = 1) select run_id, paper_id, version_id, status from cell")
def resolution_of_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolutions looked up by paper and question version."""
    return state.by_paper_version(_resolved(spark, sf_dir)).select("run_id", "paper_id", "version_id", "status")


@query(f"{_ITEMS} select run_id as arbiter_run_id, cast(sum(k) as bigint) as tokens_total, count(*) as n_answers from last where has_payload group by run_id")
def resolution_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.cost_summary(_resolved(spark, sf_dir), "arbiter_run_id").select("arbiter_run_id", "tokens_total", "n_answers")


@query("select doc_id as paper_id, cast(2 as bigint) as n, (doc_id * 2) || ',' || (doc_id * 2 + 1) as items from labels")
def disputes_by_paper(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = disputes.by_paper(catalog._disputes(spark, sf_dir))
    return rows.select("paper_id", F.size("items").cast("bigint").alias("n"), F.array_join(F.transform("items", lambda i: i["dispute_item_id"].cast("string")), ",").alias("items"))


@query("with q as (select doc_id as paper_id, n_name as key, cast(n_regionkey as int) as g from documents, nation where n_nationkey % 4 = doc_id % 4), o as (select paper_id, key, row_number() over (partition by paper_id order by key desc) - 1 as i from q) select paper_id, key, cast(i // 2 as int) as group_idx, cast(i % 2 as int) as pos from o")
def groups_of_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each paper's own questions in groups of two, in the order of its disputes."""
    nation = S.table(spark, sf_dir, "nation").select(F.col("n_name").alias("key"), F.col("n_nationkey").alias("version_id"))
    docs = S.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("paper_id"))
    rows = docs.join(nation, F.col("version_id") % 4 == F.col("paper_id") % 4).withColumn("d_order", F.row_number().over(catalog.by("paper_id", F.col("key").desc())))
    rows = rows.select("paper_id", F.col("key").alias("question_key"), "version_id", "d_order", F.col("d_order").cast("bigint").alias("dispute_item_id"), F.array().cast("array<string>").alias("candidates"))
    return disputes.groups_of_papers(rows, nation, {"size": 2}).select("paper_id", "key", "group_idx", F.col("pos").cast("int").alias("pos"))


# -- comparison of format models


@query("with n as (select count(*) filter (text <> '') * 6 as n from documents) select m as format_model, n, cast(0 as bigint) as n_errors, case when m = 'dummy' then 100.0 else 0.0 end as value_match_pct, 100.0 as cites_match_pct, false as flagged from n, (values ('dummy'), ('yes')) x(m)")
def bench_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored reasoning formatted by two models, kept, and reported beside the stored answers."""
    table, _ = _run(spark, sf_dir)
    task = engine.annotation(catalog.questions(spark))(S.overlaid(_CONFIG))
    kept = bench.results(spark, S.scratch(spark, "bench"))
    bench.keep(kept, bench.compare(table.postable(), S.source_text_of(spark, sf_dir), task, {"dummy": engine.format_dummy, "yes": _yes}))
    return bench.report(bench.kept(kept)).select("format_model", "n", "n_errors", F.col("value_match_pct").cast("double"), F.col("cites_match_pct").cast("double"), "flagged")


# -- the read side


def _named(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    runs = S.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("run_id"), F.col("n_name").alias("name"))
    papers = S.papers_of(spark, sf_dir).where("paper_id % 2 = 0").select("paper_id", "title")
    return catalog._states(spark, sf_dir), runs, papers, catalog.questions(spark)


@query(f"{catalog._LATEST} select l.run_id, l.paper_id, l.version_id, coalesce(n.n_name, cast(l.run_id as varchar)) as run_name, coalesce('Paper ' || d.doc_id, cast(l.paper_id as varchar)) as paper_title, case l.version_id when 14 then 'quality' when 15 then 'kind' else 'size' end as question_key, case when has_payload then k end as tokens from last l left join nation n on n.n_nationkey = l.run_id left join documents d on d.doc_id = l.paper_id and d.doc_id % 2 = 0 where status = 'done'")
def answers_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list of answers of one status with the names of their run, paper and question."""
    rows = views.answers_list(*_named(spark, sf_dir), status="done")
    return rows.select("run_id", "paper_id", "version_id", "run_name", "paper_title", "question_key", F.col("payload.tokens_total").alias("tokens"))


@query(f"{catalog._LATEST} select l.run_id, l.paper_id, l.version_id, l.status, cast(length(d.text) as int) as n_text from last l left join documents d on d.doc_id = l.paper_id")
def answers_with_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.with_text(catalog._states(spark, sf_dir), S.source_text_of(spark, sf_dir))
    return rows.select("run_id", "paper_id", "version_id", "status", F.length("markdown").alias("n_text"))


@query(f"{catalog._LATEST}, top as (select run_id, paper_id, version_id, status from last order by run_id, paper_id, version_id limit 1) select * from top")
def answer_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One answer by its key."""
    states = catalog._states(spark, sf_dir)
    first = state.filtered(states).select("run_id", "paper_id", "version_id").first()
    return views.answer_detail(states, S.source_text_of(spark, sf_dir), *first).select("run_id", "paper_id", "version_id", "status")


@query("select doc_id as paper_id, 'Paper ' || doc_id as title, md5(text) as digest, text is not null as has_text from documents where doc_id = (select max(doc_id) from documents) union all select -5, '', null, false")
def source_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One paper's text by its id, and that of a paper that isn't known."""
    papers, texts = S.papers_of(spark, sf_dir), S.source_text_of(spark, sf_dir)
    most = papers.agg(F.max("paper_id")).first()[0]
    rows = views.source_detail(papers, texts, most).unionByName(views.source_detail(papers, texts, -5))
    return rows.select("paper_id", "title", F.md5("markdown").alias("digest"), "has_text")


@query(f"{catalog._LATEST} select 'answers ' || status as what, count(*) as n from last group by status union all select 'answers', count(*) from last union all select 'texts', count(*) from documents")
def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.stats(catalog._states(spark, sf_dir), S.source_text_of(spark, sf_dir))


@query("select 'paper' as what, doc_id as id, 'Paper ' || doc_id as name, source as more from documents union all select 'question', 14, 'quality', 'boolean' union all select 'question', 15, 'kind', 'categorical' union all select 'question', 16, 'size', 'integer'")
def pipeline_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = {"runs": _runs(spark).select("*", F.lit("m").alias("model_name"), F.lit("p").alias("model_provider")), "papers": S.papers_of(spark, sf_dir), "questions": catalog.questions(spark)}
    got = views.pipeline_summary(parts)
    papers = got["papers"].select(F.lit("paper").alias("what"), F.col("paper_id").alias("id"), F.col("title").alias("name"), F.col("split").alias("more"))
    return papers.unionByName(got["questions"].select(F.lit("question").alias("what"), F.col("version_id").alias("id"), F.col("key").alias("name"), F.col("question_type").alias("more")))
