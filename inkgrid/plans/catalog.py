"""Queries of the grid, states and reports, each with its SQL counterpart where SQL can express it.

The driver's tables stand for the domain: documents are papers with their texts, labels are two raters' boolean answers,
benchmark holds quotes to verify, and events are a log of answers (event_id the sequence, user_id the run, event_type the
status, value the cost, props.k the tokens).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import replies
from ..operators import complete, disputes, grid, payload, prompts, reports, state
from ..sources import documents as S
from ..streaming import progress
from . import engine
from .registry import ORACLES, QUERIES, query

__all__ = ["ORACLES", "QUERIES"]

def by(key: str, *order) -> Window:
    return Window.partitionBy(key).orderBy(*order)


QUESTIONS = [
    (1, "quality", 1, 14, "Is the text good?", "", "boolean", False, True, []),
    (2, "kind", 1, 15, "Which kind is it?", "One of the list.", "categorical", False, False, [("rct", "Trial"), ("obs", "Observation")]),
    (3, "size", 1, 16, "How large was it?", "", "integer", False, False, []),
]


def runs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(10, "per text"), (11, "per abstract")], "run_id long, name string")


def questions(spark: SparkSession) -> DataFrame:
    fields = "question_id long, key string, version int, version_id long, label string, help_text string, question_type string, allow_multiple boolean, is_ic boolean, options array<struct<value:string,label:string>>, q_order int"
    return spark.createDataFrame([(*q, i) for i, q in enumerate(QUESTIONS)], fields)


def answer_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = S.table(spark, sf_dir, "events")
    status = F.when(F.col("event_type") == "view", "pending").when(F.col("event_type") == "click", "pass1_done").when(F.col("event_type") == "signup", "done").when(F.col("event_type") == "purchase", "posted").otherwise("failed")
    k = F.get_json_object("props", "$.k").try_cast("long")
    body = F.to_json(F.struct(k.alias("tokens_total"), (k * 2).alias("tokens_input"), k.alias("tokens_cached"), F.format_string("%.2f", "value").alias("cost")))
    return e.select(F.col("user_id").alias("run_id"), (F.col("event_id") % 100).alias("paper_id"), (F.col("event_id") % 3 + 14).alias("version_id"), status.alias("status"), F.when(F.col("event_type") != "view", body).alias("payload_json"), F.when(F.col("event_id") % 4 != 0, F.concat(F.lit("g"), (F.col("event_id") % 50).cast("string"))).alias("batch_group_id"), F.col("event_id").alias("seq"), "ts")


_LOG = """log as (select user_id as run_id, event_id % 100 as paper_id, event_id % 3 + 14 as version_id, event_id as seq, ts, value, cast(json_extract_string(props, '$.k') as bigint) as k,
 case event_type when 'view' then 'pending' when 'click' then 'pass1_done' when 'signup' then 'done' when 'purchase' then 'posted' else 'failed' end as status,
 event_type <> 'view' as has_payload, case when event_id % 4 <> 0 then 'g' || (event_id % 50) end as gid from events)"""
_LATEST = f"with {_LOG}, last as (select * from (select *, row_number() over (partition by run_id, paper_id, version_id order by seq desc) as rn from log) where rn = 1)"
_STATE_KEYS = ("run_id", "paper_id", "version_id")


def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.latest(answer_log(spark, sf_dir), _STATE_KEYS)


_Q = "(values (0, 0, 14), (0, 1, 15), (1, 0, 16)) q(group_idx, pos, version_id)"


@query(f"select run_id, doc_id as paper_id, group_idx, pos, cast(version_id as bigint) as version_id, run_id || '-' || doc_id || '-' || group_idx as cid from (values (cast(10 as bigint)), (11)) r(run_id), documents, {_Q}")
def cell_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = grid.groups_frame(questions(spark), {"size": 2})
    return grid.cells(runs(spark), S.papers_of(spark, sf_dir), groups).select("run_id", "paper_id", "group_idx", "pos", "version_id", "cid")


@query("select key, cast((rn - 1) // 2 as int) as group_idx, cast((rn - 1) % 2 as int) as pos from (select n_name as key, row_number() over (order by n_nationkey) as rn from nation)")
def batch_groups_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.table(spark, sf_dir, "nation").select(F.col("n_name").alias("key"), F.col("n_nationkey").alias("q_order"))
    return grid.groups_frame(rows, {"size": 2}).select("key", "group_idx", "pos")


@query("with named as (select * from (values ('size', 0, 0), ('quality', 0, 1)) t(key, group_idx, pos)) select key, group_idx, pos from named union all select key, cast(1 + row_number() over (order by q) - 1 as int), 0 from (values ('quality', 0), ('kind', 1), ('size', 2)) a(key, q) where key not in (select key from named)")
def batch_groups_explicit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.groups_frame(questions(spark), [["size", "quality"]]).select("key", "group_idx", "pos")


@query("select doc_id as paper_id, cast((row_number() over (order by doc_id) - 1) // 10 as bigint) as chunk from documents")
def paper_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.chunks(S.papers_of(spark, sf_dir).select("paper_id", "p_order"), 10).select("paper_id", "chunk")


def _rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of run 10: both questions of group 0 where quality is 1, its first alone elsewhere."""
    both = F.array(F.lit(14), F.lit(15))
    rows = S.table(spark, sf_dir, "labels").select(F.lit(10).cast("long").alias("run_id"), F.col("doc_id").alias("paper_id"), F.explode(F.when(F.col("quality") == 1, both).otherwise(F.slice(both, 1, 1))).alias("version_id"))
    return rows.select("run_id", "paper_id", F.col("version_id").cast("long").alias("version_id"), F.lit("done").alias("status"))


_RATED = "rated as (select 10 as run_id, doc_id as paper_id, v as version_id from labels, (values (14), (15)) t(v) where v = 14 or quality = 1)"


@query(f"with {_RATED} select r.run_id, d.doc_id as paper_id, cast(q.version_id as bigint) as version_id from (values (cast(10 as bigint)), (11)) r(run_id), documents d, {_Q} where not exists (select 1 from rated x where x.run_id = r.run_id and x.paper_id = d.doc_id and x.version_id = q.version_id)")
def resume_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = grid.groups_frame(questions(spark), "per_question")
    return grid.pending(grid.cells(runs(spark), S.papers_of(spark, sf_dir), groups), groups, _rated(spark, sf_dir)).select(*_STATE_KEYS)


@query(f"with {_RATED}, g as (select r.run_id, d.doc_id as paper_id, q.group_idx, q.version_id, x.paper_id is not null as complete from (values (cast(10 as bigint)), (11)) r(run_id) cross join documents d cross join {_Q} left join rated x on x.run_id = r.run_id and x.paper_id = d.doc_id and x.version_id = q.version_id) select run_id, paper_id, group_idx from g group by all having not bool_and(complete)")
def group_skip_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = grid.groups_frame(questions(spark), {"size": 2})
    open_ = grid.pending(grid.cells(runs(spark), S.papers_of(spark, sf_dir), groups), groups, _rated(spark, sf_dir))
    return open_.select("run_id", "paper_id", "group_idx").distinct()


@query("select doc_id as paper_id, case when lang = 'en' and text <> '' then length(text) end as n_source, case when lang = 'en' and text <> '' then 'found' else 'no_ocr' end as outcome from documents")
def source_resolve_no_ocr(spark: SparkSession, sf_dir: str) -> DataFrame:
    english = S.table(spark, sf_dir, "documents").where("lang = 'en'").select(F.col("doc_id").alias("paper_id"), F.col("text").alias("markdown"))
    have, none = grid.with_source(S.papers_of(spark, sf_dir), english)
    found = have.select("paper_id", F.length("source").cast("long").alias("n_source"), F.lit("found").alias("outcome"))
    return found.unionByName(none.select("paper_id", F.lit(None).cast("long").alias("n_source"), F.lit("no_ocr").alias("outcome")))


@query(f"""with g(group_idx, asked) as (values (0, '- key=''quality'': Is the text good?' || chr(10) || '- key=''kind'': Which kind is it?' || chr(10) || '  Help: One of the list.' || chr(10) || '  Options:' || chr(10) || '  - ''rct'' — Trial' || chr(10) || '  - ''obs'' — Observation'), (1, '- key=''size'': How large was it?')),
m as (select doc_id as paper_id, group_idx, '[system]' || chr(10) || '{prompts.SYSTEM}' || chr(10) || chr(10) || '[user]' || chr(10) || 'Questions:' || chr(10) || asked || case when text = '' then '' else chr(10) || chr(10) || '[user]' || chr(10) || 'Document:' || chr(10) || text end as p from documents, g)
select paper_id, cast(group_idx as int) as group_idx, md5(p) as digest, cast(length(p) as int) as n from m""")
def prompt_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = prompts.questions_text(grid.groups_frame(questions(spark), {"size": 2}))
    rows = S.source_text_of(spark, sf_dir).crossJoin(grid.small(asked))
    flat = prompts.flat(prompts.pass1_messages(F.col("markdown"), F.col("questions"), F.lit("questions")))
    return rows.withColumn("p", flat).select("paper_id", "group_idx", F.md5("p").alias("digest"), F.length("p").alias("n"))


def _disputes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's two labels as a dispute of the question quality, and one of an unknown question."""
    docs = S.table(spark, sf_dir, "documents").select("doc_id", "source", F.col("text").alias("start"))
    rows = S.table(spark, sf_dir, "labels").join(docs, "doc_id")
    rater = lambda name, value: F.struct(F.lit(name).alias("rater_key"), F.col(value).cast("string").alias("value"), F.lit("").alias("comment"), F.when(F.col(value) == 1, F.col("start")).otherwise("").alias("cited_text"))
    two = F.array(F.struct(F.lit(0).alias("n"), F.lit("quality").alias("question_key"), F.lit(14).alias("version_id")), F.struct(F.lit(1).alias("n"), F.lit("unknown").alias("question_key"), F.lit(99).alias("version_id")))
    rows = rows.withColumn("q", F.explode(two))
    return rows.select((F.col("doc_id") * 2 + F.col("q.n")).alias("dispute_item_id"), F.col("doc_id").alias("paper_id"), F.concat("source", F.lit(" "), F.col("q.question_key")).alias("paper_title"), F.col("start").alias("abstract"), F.col("q.question_key").alias("question_key"), F.col("q.version_id").cast("long").alias("version_id"), F.array(rater("anna", "quality"), rater("ben", "toxic")).alias("candidates"), (F.col("doc_id") * 2 + F.col("q.n")).alias("d_order"))


@query("select l.doc_id as paper_id, d.source || ' quality' as title, d.text as abstract, l.doc_id * 2 as p_order from labels l join documents d using (doc_id)")
def dispute_papers_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disputes.papers(_disputes(spark, sf_dir))


def _candidates_sql(a: str, b: str) -> str:
    one = lambda name, c: f"'Candidate {name}: ' || l.{c} || case when l.{c} = 1 and d.text <> '' then chr(10) || '  Evidence: ' || d.text else '' end"
    return f"select l.doc_id as paper_id, l.doc_id * 2 as dispute_item_id, {one(a, 'quality')} || chr(10) || {one(b, 'toxic')} as candidates from labels l join documents d using (doc_id)"


def _listed(spark: SparkSession, sf_dir: str, anonymous: bool) -> DataFrame:
    rows = _disputes(spark, sf_dir)
    asked = disputes.questions_of_papers(rows, questions(spark)).select("paper_id", "version_id")
    have, _ = disputes.with_items(asked, rows)
    return have.select("paper_id", "dispute_item_id", prompts.candidate_lines(F.col("candidates"), F.lit(anonymous)).alias("candidates"))


@query(_candidates_sql("anna", "ben"))
def dispute_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listed(spark, sf_dir, False)


@query(_candidates_sql("A", "B"))
def anonymize_raters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listed(spark, sf_dir, True)


@query("""select doc_id as paper_id, '{"results":[{"key":"quality","value":null,"cited_text":"","comment":"dummy","confidence":null},{"key":"' || lang || '","value":null,"cited_text":"","comment":"dummy","confidence":null}]}' as reply, cast(15 as bigint) as total_tokens from documents""")
def dummy_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = F.concat(F.lit("- key='quality': a\n- key='"), F.col("lang"), F.lit("': b"))
    rows = S.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("paper_id"), complete.asked_keys(asked).alias("keys"))
    return complete.dummy(rows, "keys").select("paper_id", F.col("completion.text").alias("reply"), F.col("completion.usage.total_tokens").alias("total_tokens"))


def _replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reply of each label row: an object, a list, a fenced block or JSON lines; toxic is missing where it's 0."""
    one = lambda k: F.concat(F.lit(f'{{"key":"{k}","value":'), F.col(k).cast("string"), F.lit(',"cited_text":"n/a","comment":"c"}'))
    items = F.when(F.col("toxic") == 1, F.array(one("quality"), one("toxic"))).otherwise(F.array(one("quality")))
    listed, kind = F.concat(F.lit("["), F.array_join(items, ","), F.lit("]")), F.col("doc_id") % 4
    text = F.when(kind == 0, F.concat(F.lit('{"results":'), listed, F.lit("}"))).when(kind == 1, listed).when(kind == 2, F.concat(F.lit("```json\n"), listed, F.lit("\n```"))).otherwise(F.array_join(items, "\n"))
    return S.table(spark, sf_dir, "labels").select("doc_id", text.alias("reply"))


@query("select doc_id as paper_id, key, case when key = 'quality' then cast(quality as varchar) when toxic = 1 then '1' end as value_json, case when key = 'toxic' and toxic = 0 then 'key ''toxic'' not found in pass-2 output' end as parse_error from labels, (values ('quality'), ('toxic')) k(key)")
def parse_results_fill_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = replies.with_results(_replies(spark, sf_dir), F.col("reply"), F.array(F.lit("quality"), F.lit("toxic")))
    return rows.select(F.col("doc_id").alias("paper_id"), F.explode("results").alias("r")).select("paper_id", "r.key", "r.value_json", "r.parse_error")


@query("select event_id, case event_id % 3 when 0 then 'true' when 1 then json_extract_string(props, '$.k') end as found from events")
def parse_value_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = S.table(spark, sf_dir, "events")
    line = F.concat(F.lit('{"key": "a", "value": '), F.when(F.col("event_id") % 3 == 0, F.lit("true")).when(F.col("event_id") % 3 == 1, F.get_json_object("props", "$.k")).otherwise(F.lit('"text"')), F.lit(", broken"))
    return e.select("event_id", C.primitive_value(line).alias("found"))


@query(f"select doc_id as paper_id, cast(version_id as bigint) as version_id, cast(case when pos = 0 then 15 else 0 end as bigint) as tokens_total, cast(case when pos = 0 then 15 else 0 end as bigint) as fmt_tokens_total, cast(case when pos = 0 then 2 else 0 end as bigint) as latency_ms from documents, {_Q}")
def first_in_group_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = grid.groups_frame(questions(spark), {"size": 2}).select("group_idx", "pos", "version_id")
    rows = complete.dummy(S.papers_of(spark, sf_dir).select("paper_id").crossJoin(grid.small(groups))).withColumn("p1", F.col("completion"))
    return payload.attributed(rows).select("paper_id", "version_id", "tokens_total", "fmt_tokens_total", "latency_ms")


@query(f"{_LATEST} select run_id as run, paper_id as paper, version_id as question_version, printf('%.6f', cast(printf('%.2f', value) as double)) as cost from last where status in ('done', 'posted') and version_id in (14, 15, 16)")
def payload_wire_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return engine.wire(state.postable(_states(spark, sf_dir)), questions(spark)).select("run", "paper", "question_version", "cost")


@query("""select doc_id, '{"run_id":10,"status":"running","cells_total":3,"cells_done":' || quality || ',"cells_error":0,"message":"m"' || case when toxic = 1 then ',"phase":"pass1"' else '' end || '}' as beat from labels""")
def heartbeat_json_omit_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    beat = reports.heartbeat(F.lit(10), F.lit("running"), F.lit(3), F.col("quality"), F.lit(0), F.lit("m"), chunk_index=F.lit(None).cast("int"), phase=F.when(F.col("toxic") == 1, "pass1"))
    return S.table(spark, sf_dir, "labels").select("doc_id", beat.alias("beat"))


_BEATS = "b as (select user_id % 5 as run_id, ts, event_id from events), beat as (select run_id, ts, min(event_id) as event_id from b group by run_id, ts)"


_SENT = f"with recursive {_BEATS}, sent as (select run_id, min(ts) as ts from beat group by run_id union all select s.run_id, (select min(a.ts) from beat a where a.run_id = s.run_id and a.ts >= s.ts + interval 3600 second) from sent s where s.ts is not null) select a.run_id, a.ts, a.event_id from sent s join beat a on a.run_id = s.run_id and a.ts = s.ts"


@query(_SENT)
def heartbeat_throttle(spark: SparkSession, sf_dir: str) -> DataFrame:
    beats = S.table(spark, sf_dir, "events").select((F.col("user_id") % 5).alias("run_id"), "ts", "event_id")
    return progress.throttled(beats, seconds=3600.0)


@query(_SENT)
def heartbeat_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of a stream, whose last time sent of each run is its state; what it has sent when its input ends."""
    path = S.scratch(spark, "heartbeats")
    source = spark.readStream.schema(S.table(spark, sf_dir, "events").schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    beats = source.select((F.col("user_id") % 5).alias("run_id"), F.col("ts").cast("timestamp").alias("ts"), "event_id")
    sent = progress.throttled_stream(beats, seconds=3600.0, late="0 seconds")
    sent.writeStream.format("parquet").option("path", f"{path}/sent").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    kind = S.table(spark, sf_dir, "events").schema["ts"].dataType
    return spark.read.schema(sent.schema).parquet(f"{path}/sent").withColumn("ts", F.col("ts").cast(kind))


@query(f"{_LATEST} select run_id, paper_id, version_id, status, seq from last")
def answers_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _states(spark, sf_dir).select("run_id", "paper_id", "version_id", "status", "seq")


@query(f"{_LATEST} select status, count(*) as n from last group by status")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.status_counts(_states(spark, sf_dir))


_COSTS = "sum(k) as tokens_total, sum(k * 2) as tokens_input, sum(k) as tokens_cached, round(sum(cast(printf('%.2f', value) as double)), 2) as cost, count(*) as n_answers"


@query(f"{_LATEST} select cast(run_id as bigint) as run_id, cast(tokens_total as bigint) as tokens_total, cast(tokens_input as bigint) as tokens_input, cost, n_answers from (select run_id, {_COSTS} from last where has_payload group by run_id)")
def cost_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.cost_summary(_states(spark, sf_dir)).select("run_id", "tokens_total", "tokens_input", F.round("cost", 2).alias("cost"), "n_answers")


@query(f"{_LATEST} select cast(run_id as varchar) as run, cast(tokens_input as bigint) as tokens_input, round(case when tokens_input > 0 then tokens_cached * 100.0 / tokens_input else 0 end, 6) as cache_percent, n_answers from (select run_id, {_COSTS} from last where has_payload group by rollup (run_id))")
def cost_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reports.with_total(reports.cost_summary(_states(spark, sf_dir)))
    return rows.select(F.col("run_id").cast("string").alias("run"), "tokens_input", F.round("cache_percent", 6).alias("cache_percent"), "n_answers")


@query(f"{_LATEST} select run_id, paper_id, version_id from last where status = 'done' and has_payload")
def unposted_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.unposted(_states(spark, sf_dir)).select(*_STATE_KEYS)


@query(f"{_LATEST} select run_id, paper_id, version_id from last where status in ('done', 'posted') and has_payload")
def postable_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.postable(_states(spark, sf_dir)).select(*_STATE_KEYS)


@query(f"{_LATEST} select run_id, group_key, string_agg(cast(paper_id as varchar) || ':' || version_id, ',' order by version_id, paper_id) as members from (select *, coalesce(gid, 'solo_' || version_id) as group_key from last) group by run_id, group_key")
def group_by_batch_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = state.regrouped(_states(spark, sf_dir)).groupBy("run_id", "group_key").agg(F.array_sort(F.collect_list(F.struct("version_id", "paper_id"))).alias("m"))
    return rows.select("run_id", "group_key", F.array_join(F.transform("m", lambda x: F.concat_ws(":", x["paper_id"].cast("string"), x["version_id"].cast("string"))), ",").alias("members"))


@query("select doc_id, len(p) as n, coalesce(list_sum(list_transform(p, lambda x: length(x))), 0) >= 40 as enough from (select doc_id, list_filter(list_transform(regexp_split_to_array(text || ' ... ' || source || '…' || lang, '[.]{2,}|…'), lambda x: trim(x)), lambda x: x <> '') as p from documents)")
def ellipsis_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.col("text"), F.lit(" ... "), F.col("source"), F.lit("…"), F.col("lang"))
    return S.table(spark, sf_dir, "documents").select("doc_id", C.ellipsis_parts(text).alias("p")).select("doc_id", F.size("p").cast("long").alias("n"), C.long_enough(F.col("p")).alias("enough"))


@query("select doc_id, case when quality = 1 and toxic = 1 then 'all' when quality = 1 or toxic = 1 then 'any' else 'none' end as verified, cast(2 as bigint) as n from labels")
def citations_build_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = C.citations(F.array(F.lit("one quote"), F.lit(" "), F.lit("another")), F.array(F.col("quality") == 1, F.lit(True), F.col("toxic") == 1))
    return S.table(spark, sf_dir, "labels").withColumn("c", found).select("doc_id", C.verified_of(F.col("c")).alias("verified"), F.size("c").cast("long").alias("n"))


@query("select event_id, cast(count(*) over (partition by event_type order by ts range between interval '59.999999' second preceding and current row) as bigint) as in_window from events")
def rate_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = S.table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("provider"), "ts")
    return progress.calls_in_window(calls).select("event_id", "in_window")


def _bench_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as formatted answers of two models, of which every third is their reference."""
    e = S.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.get_json_object("props", "$.k").alias("k"), "value")
    keys = [F.col("user_id").alias("run_id"), F.col("event_id").alias("paper_id"), (F.col("event_id") % 3).alias("version_id")]
    reference = e.select(*keys, F.col("k").alias("value_json"), F.array("event_type").alias("cited"), (F.col("event_id") % 2 == 0).alias("verified"))
    test = e.select(*keys, F.explode(F.array(F.lit("m1"), F.lit("m2"))).alias("format_model"), "k", "event_type", "value", "event_id")
    m1, odd = F.col("format_model") == "m1", F.col("event_id") % 5 == 0
    test = test.select("run_id", "paper_id", "version_id", "format_model", F.when(m1 | ~odd, F.col("k")).otherwise("x").alias("value_json"), F.when(m1 & odd, F.array().cast("array<string>")).otherwise(F.array("event_type")).alias("cited"), (F.col("event_id") % 2 == 0).alias("verified"), F.when(F.col("event_id") % 50 == 0, "failed").alias("error"), F.col("value").alias("cost"), (F.col("event_id") % 4).alias("latency_ms"))
    return reports.compared(test, reference)


_BENCH_ROWS = """with t as (select event_id, event_id % 3 as version_id, m as format_model, m = 'm1' or event_id % 5 <> 0 as vm, m = 'm2' or event_id % 5 <> 0 as cm, event_id % 2 = 0 as ver, event_id % 50 = 0 as err, value as cost, event_id % 4 as lat from events, (values ('m1'), ('m2')) x(m))"""
_BENCH = f"""{_BENCH_ROWS}, s as (select format_model, version_id, count(*) as n, count(*) filter (err) as n_errors, avg(vm::int) * 100 as value_match_pct, avg(cm::int) * 100 as cites_match_pct, avg(ver::int) * 100 as verified_pct, avg(cm::int) as sim, sum(cost) as cost, avg(nullif(lat, 0)) as mean_latency_ms from t group by grouping sets ((format_model), (format_model, version_id)))"""


@query(f"{_BENCH} select format_model, n, n_errors, round(value_match_pct, 6) as value_match_pct, round(cites_match_pct, 6) as cites_match_pct, round(sim, 6) as mean_similarity, round(cost, 2) as cost, round(mean_latency_ms, 6) as mean_latency_ms, cites_match_pct < 99 as flagged from s where version_id is null")
def bench_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reports.bench_summary(_bench_rows(spark, sf_dir))
    return rows.select("format_model", "n", "n_errors", F.round("value_match_pct", 6).alias("value_match_pct"), F.round("cites_match_pct", 6).alias("cites_match_pct"), F.round("mean_similarity", 6).alias("mean_similarity"), F.round("cost", 2).alias("cost"), F.round("mean_latency_ms", 6).alias("mean_latency_ms"), "flagged")


@query(f"{_BENCH} select format_model, version_id, n, round(verified_pct, 6) as verified_pct from s")
def bench_by_question(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.bench_summary(_bench_rows(spark, sf_dir), "version_id").select("format_model", "version_id", "n", F.round("verified_pct", 6).alias("verified_pct"))


@query(f"{_BENCH_ROWS} select event_id as paper_id, format_model, cast(cm as double) as similarity from t")
def bench_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bench_rows(spark, sf_dir).select("paper_id", "format_model", "similarity")


@query("select doc_id, case when quality = 1 then 'true' when toxic = 1 then 'rct' else 'plain' end as in_list, case when quality = 1 then 'true' when toxic = 1 then 'rct' else 'a, b' end as in_detail from labels")
def display_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    yes, kind = F.when(F.col("quality") == 1, F.lit(True)), F.when(F.col("toxic") == 1, "rct").otherwise("")
    many, text = F.array(F.lit("a"), F.lit("b")), F.lit("plain")
    return S.table(spark, sf_dir, "labels").select("doc_id", C.shown_in_list(yes, kind, text, many).alias("in_list"), C.shown_in_detail(yes, kind, many, text).alias("in_detail"))


@query("select count(*) filter (event_type <> 'error') as n_ok, count(*) filter (event_type = 'error') as n_errors, cast(sum(case when event_type <> 'error' then cast(json_extract_string(props, '$.k') as bigint) else 0 end) as bigint) as input_tokens, 50.0 as cache_hit_pct from events")
def batch_usage_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").try_cast("long")
    rows = S.table(spark, sf_dir, "events").select(F.when(F.col("event_type") == "error", "errored").otherwise("succeeded").alias("type"), k.alias("input_tokens"), k.alias("cached_tokens"))
    return reports.usage_totals(rows).select("n_ok", "n_errors", "input_tokens", F.round("cache_hit_pct", 6).cast("double").alias("cache_hit_pct"))


@query("select page_id, replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;') as safe from pages")
def html_escape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.table(spark, sf_dir, "pages").select("page_id", C.html_safe(F.col("html")).alias("safe"))


@query("select o_orderkey, case when contains(n, '/') then split_part(n, '/', 1) end as provider, case when contains(n, '/') then substring(n, strpos(n, '/') + 1) else n end as model from (select o_orderkey, case when o_orderkey % 2 = 0 then o_orderpriority || '/' || o_orderstatus || '/x' else o_orderstatus end as n from orders)")
def model_name_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("o_orderkey") % 2 == 0, F.concat("o_orderpriority", F.lit("/"), F.col("o_orderstatus"), F.lit("/x"))).otherwise(F.col("o_orderstatus"))
    rows = S.table(spark, sf_dir, "orders").select("o_orderkey", name.alias("n"))
    provider, model = C.provider_and_model(F.col("n"))
    return rows.select("o_orderkey", provider.alias("provider"), model.alias("model"))


@query("select event_id, case when event_type in ('view', 'click') then 'running' when event_type = 'signup' then 'done' else 'failed' end as state from events")
def batch_status_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("event_type")
    raw = F.when(t == "view", "in_progress").when(t == "click", "validating").when(t == "signup", "completed").when(t == "error", "failed").otherwise("expired")
    return S.table(spark, sf_dir, "events").select("event_id", complete.batch_status(F.lit("openai"), raw).alias("state"))


@query(f"select r.run_id, cast(q.version_id as bigint) as version_id, 'done' as status, count(*) as n, cast(sum(case when q.pos = 0 and d.text <> '' then 15 else 0 end) as bigint) as tokens from (values (cast(10 as bigint)), (11)) r(run_id), documents d, {_Q} group by all")
def annotate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over all documents from plan to payload with the deterministic model: the flagship."""
    rows = engine.run(runs(spark), S.papers_of(spark, sf_dir), questions(spark), S.source_text_of(spark, sf_dir), batching={"size": 2})
    tokens = F.coalesce(F.get_json_object("payload_json", "$.tokens_total").try_cast("long"), F.lit(0))
    return rows.groupBy("run_id", "version_id", "status").agg(F.count("*").alias("n"), F.sum(tokens).alias("tokens"))
