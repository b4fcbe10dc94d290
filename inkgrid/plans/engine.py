"""The annotation engine: plan the grid, reason (pass 1), format (pass 2), parse, map, verify, keep, post.

One engine serves annotation and arbitration. They differ in the groups (of all papers, or of each paper), the block of a
question, the text and the kind of payload, all held by a Task. A model call is a function from a DataFrame with cid,
messages and keys to the same with `completion`.

Cells are planned by their keys alone; texts are joined last, and only to groups that are still to be asked.
"""

from __future__ import annotations

import json
import logging
import math
import threading
import uuid
from collections.abc import Callable, Iterator, Mapping, MutableMapping
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import evidence, replies
from ..operators import complete, grid, payload, prompts, sinks, state
from ..sources import documents as S
from ..streaming import progress

Model = Callable[[DataFrame], DataFrame]
LOG = logging.getLogger("inkgrid")


def reason_dummy(rows: DataFrame) -> DataFrame:
    return complete.dummy(rows)


def format_dummy(rows: DataFrame) -> DataFrame:
    return complete.dummy(rows, "keys")


@dataclass(frozen=True)
class Task:
    """What is asked, and how: groups (with paper_id where papers have their own), the run's settings, the two models."""

    groups: DataFrame
    config: Mapping = field(default_factory=lambda: S.RUN_DEFAULTS)
    kind: str = "answer"
    block: Column | None = None
    reason: Model = reason_dummy
    format_: Model = format_dummy
    system: str | None = None
    without: str | None = None
    #: Whether groups are asked that were stored, each with its own questions in q (see regrouped); else they're those of the plan.
    stored: bool = False

    @property
    def of_paper(self) -> list[str]:
        return ["paper_id"] if "paper_id" in self.groups.columns else []


def pass1_messages(task: Task, source: Column, questions: Column) -> Column:
    return prompts.pass1_messages(source, questions, F.lit(task.config["cache_first"]), task.config["system_prompt"] or task.system, task.without)


def calls(runs: DataFrame, papers: DataFrame, task: Task, *, states: DataFrame | None = None, complete_: tuple[str, ...] = grid.COMPLETE) -> DataFrame:
    """One row a group to ask: cid, run_id, paper_id, group_idx, source, keys, messages. papers have source; groups that are done are left out."""
    asked = prompts.questions_text(task.groups, task.block)
    thin = papers.select("paper_id")
    each = thin.join(asked, "paper_id") if task.of_paper else thin.crossJoin(grid.small(asked))
    each = each.crossJoin(grid.small(runs.select("run_id")))
    if states is not None:
        each = grid.pending(each, task.groups, states, complete_)
    each = each.withColumn("cid", grid.cid(F.col("run_id"), F.col("paper_id"), F.col("group_idx"))).join(papers.select("paper_id", "source"), "paper_id")
    return each.withColumn("messages", pass1_messages(task, F.col("source"), F.col("questions")))


def pass1(asked: DataFrame, reason: Model = reason_dummy) -> DataFrame:
    return reason(asked).withColumnRenamed("completion", "p1").withColumn("pass1_text", F.col("p1.text"))


def pass2(done: DataFrame, task: Task) -> DataFrame:
    spec = lambda key, kind: F.concat(F.lit("- "), key, F.lit(" ("), kind, F.lit(")"))
    if task.stored:
        asked = done.withColumn("specs", F.transform("q", lambda x: spec(x["key"], x["question_type"])))
    else:
        by = [*task.of_paper, "group_idx"]
        specs = task.groups.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("pos", spec(F.col("key"), F.col("question_type")).alias("t")))).alias("s"))
        asked = done.join(grid.small(specs.select(*by, F.col("s.t").alias("specs"))), by)
    asked = asked.withColumn("messages", prompts.pass2_messages(F.coalesce("pass1_text", F.lit("")), F.col("specs"))).drop("specs")
    return task.format_(asked)


def _lost(call: str, said: str) -> Column:
    """The error of a call: its own, or that it gave nothing."""
    return F.coalesce(F.col(f"{call}.error"), F.when(F.col(f"{call}.text").isNull(), F.lit(said)))


#: What an answer's mapping takes of its question.
ASKED = ("question_type", "allow_multiple", "valid")


def asked_columns() -> list[Column]:
    return [F.col("question_type"), F.col("allow_multiple"), F.transform("options", lambda o: o["value"]).alias("valid")]


def answers(formatted: DataFrame, task: Task, *, check: bool = True) -> DataFrame:
    """A row a cell from a row a group: parsed, verified, mapped, with the calls' costs on its first answer.

    Quotes are verified a group at a time, before its answers become rows, so a text is normalised once and goes no further.
    failed: a call's error (the cell is to be tried again); spoiled: a reply without one of the keys, which spoils its group.
    """
    rows = replies.with_results(formatted, "completion.text", "keys", "__r")
    rows = rows.withColumns({"failed": F.coalesce(_lost("p1", "pass 1 gave no text"), _lost("completion", "pass 2 gave no text")), "spoiled": replies.extraction_error(F.col("__r"))})
    if check:
        how = evidence.verify_columns(task.config["citation_max_error_rate"], task.config["citation_max_ellipsis_gap"])
        # A text goes to Python only where something is quoted from it.
        text = F.when(F.exists("__r", lambda r: F.size(r["cited"]) > 0), F.col("source"))
        rows = rows.withColumn("__v", how(F.transform("__r", lambda r: r["cited"]), F.transform("__r", lambda r: r["cited_kind"]), text))
    else:
        rows = rows.withColumn("__v", F.transform("__r", lambda r: F.lit(None).cast(evidence.CHECKED[6:-1])))
    own = ["q"] if task.stored else []
    kept = [c for c in rows.columns if c not in ("messages", "questions", "keys", "version_ids", "source", "__r", "__v", *own)]
    each = rows.select(*kept, F.posexplode(F.arrays_zip("__r", "__v", *own)).alias("pos", "__x")).withColumns({"result": F.col("__x.__r"), "checked": F.col("__x.__v")})
    more = [c for c in ("dispute_item_id",) if c in task.groups.columns]
    if task.stored:
        each = each.withColumn("was", F.col("__x.q")).withColumns({c: F.col(f"was.{c}") for c in ("version_id", "key", *ASKED, *more)}).drop("__x")
    else:
        by = [*task.of_paper, "group_idx"]
        each = each.drop("__x").join(grid.small(task.groups.select(*by, "pos", "version_id", "key", *asked_columns(), *more)), [*by, "pos"])
    each = payload.attributed(each)
    bad = F.coalesce("failed", "spoiled")
    answer = C.map_value(F.col("question_type"), F.col("allow_multiple"), F.col("result.value"), F.coalesce("valid", F.array().cast("array<string>")))
    each = each.withColumn("answer", F.when(bad.isNull(), answer).otherwise(C.mapped(F.lit("error"), bad)))
    each = each.withColumns({"comment": F.col("result.comment"), "confidence": F.col("result.confidence"), "cited": F.coalesce("result.cited", F.array().cast("array<string>"))})
    each = each.withColumn("verified", F.when(F.col("checked.note") != evidence.NO_CITATION, F.col("checked.ok")))
    each = each.withColumn("citations", C.citations(F.col("cited"), F.coalesce("checked.each", F.array().cast("array<boolean>"))))
    first = F.col("pos") == 0
    raw = F.struct(
        F.col("cid").alias("batch_group_id"), F.when(first, F.col("pass1_text")).alias("pass1_text"), F.when(first, F.col("completion.text")).alias("pass2_text"), F.when(first, F.col("p1.usage")).alias("p1_usage"),
        F.lit(task.config["text_source"]).alias("text_source"), F.col("result").alias("parse_result"), F.struct("checked.ok", "checked.note").alias("verify"),
    )
    return each.withColumn("raw_response", F.to_json(raw))


KEPT = ("run_id", "paper_id", "version_id", "status", "payload_json", "batch_group_id", "error")


def kept(done: DataFrame, kind: str = "answer") -> DataFrame:
    """Rows for the state: answers, and the errors of cells that have none. Failed calls are `failed`, to be tried again; spoiled replies are `done` errors."""
    bad = F.coalesce("failed", "spoiled")
    more = [c for c in ("dispute_item_id",) if c in done.columns]
    rows = done.withColumns({
        "status": F.when(F.col("failed").isNotNull(), "failed").otherwise("done"),
        "payload_json": F.when(bad.isNull(), payload.payload_json(kind)).otherwise(payload.error_json(bad, kind)),
        "batch_group_id": F.when(bad.isNull(), F.col("cid")), "error": F.col("failed"),
    })
    rows = rows.select(*KEPT, *more)
    return rows.where("dispute_item_id is not null") if more else rows


def _without_text(lost: DataFrame, kind: str) -> DataFrame:
    more = [c for c in ("dispute_item_id",) if c in lost.columns]
    none = F.lit(None).cast("string")
    return lost.select("run_id", "paper_id", "version_id", F.lit("done").alias("status"), payload.error_json(F.lit(payload.NO_TEXT), kind).alias("payload_json"), none.alias("batch_group_id"), none.alias("error"), *more)


def perform(runs: DataFrame, papers: DataFrame, source_text: DataFrame, task: Task, *, states: DataFrame | None = None, checkpoint: Checkpoint | None = None, chunk: int = 0, ask: bool = True, note_lost: bool = True) -> DataFrame:
    """Rows to keep of all groups that aren't complete. Papers without a text get error rows, unless they're complete (or note_lost says no)."""
    have, none = grid.with_source(papers, source_text, task.config["text_source"])
    asked = calls(runs, have, task, states=states)
    reasoned = checkpoint.through(asked, chunk, task.reason, ask) if checkpoint else pass1(asked, task.reason)
    done = kept(answers(pass2(reasoned, task), task), task.kind)
    if not note_lost:
        return done
    lost = grid.cells(runs, none, task.groups)
    if "dispute_item_id" in task.groups.columns:
        lost = lost.join(grid.small(task.groups.select("paper_id", "group_idx", "pos", "dispute_item_id")), ["paper_id", "group_idx", "pos"])
    if states is not None:
        lost = grid.pending(lost, task.groups, states)
    return done.unionByName(_without_text(lost, task.kind))


class Checkpoint:
    """Pass-1 texts of a run, a table a chunk, kept until the chunk's answers are: what a lost driver had paid for isn't asked again."""

    def __init__(self, path: str, run_id: int) -> None:
        self.path, self.run_id = path, run_id

    def at(self, chunk: int) -> str:
        return f"{self.path}/run={self.run_id}/chunk={chunk}"

    def read(self, like: DataFrame, chunk: int) -> DataFrame | None:
        try:
            return like.sparkSession.read.parquet(self.at(chunk))
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            return None

    def through(self, asked: DataFrame, chunk: int, reason: Model, ask: bool = True) -> DataFrame:
        """asked with p1 and pass1_text: those that the table has (by cid, as asked for now), and those that are asked for now, which it has
        afterwards. ask False: only those that it has."""
        known = self.read(asked, chunk)
        rest = asked if known is None else asked.join(known.select("cid"), "cid", "left_anti")
        if ask:
            pass1(rest, reason).where("pass1_text is not null and p1.error is null").select("cid", "p1", "pass1_text").write.mode("append").parquet(self.at(chunk))
        told = self.read(asked, chunk)
        kind = reason(asked.limit(0)).schema["completion"].dataType
        if told is None:
            return asked.withColumn("p1", F.lit(None).cast(kind)).withColumn("pass1_text", F.lit(None).cast("string"))
        return asked.join(told, "cid", "left")


# -- calls: what a run's settings say of them


def options(config: Mapping, number: int) -> dict:
    """What a call of pass 1 or 2 is asked with beside its messages; settings that are unset are left out, a pass's own params win."""
    if number == 1:
        said = {"temperature": config["temperature"], "reasoning_effort": config["reasoning_effort"], **config["model_params"]}
    else:
        said = {"provider": config["format_model_provider"], "model": config["format_model"], "temperature": config["format_temperature"]}
        said |= {"response_schema": replies.REPLY_SCHEMA if config["format_structured_output"] else None, **config["format_model_params"]}
    said |= {"timeout": config["request_timeout"], "drop_params": config["drop_params"] or None}
    return {k: v for k, v in said.items() if v is not None}


def marked(rows: DataFrame, config: Mapping, provider: str) -> DataFrame:
    """rows with messages marked for the provider's prompt cache, if the run says so."""
    return rows.withColumn("messages", prompts.cached(F.col("messages"), F.lit(provider), F.lit(bool(config["cache"])), F.lit(config["cache_ttl"])))


def online(call: Callable[[dict], dict], config: Mapping, number: int, provider: str = "", *, probe: bool = True, tasks: int = 1) -> Model:
    """The model of a pass by a callable of cid, messages and options. The run's concurrency and rpm hold for all `tasks` together; the first
    call is made alone if probe says so, and a failing one is the only one."""
    asked_with = options(config, number)
    how = {"rpm": config["rpm"], "concurrency": config["concurrency"], "tasks": tasks}

    def model(rows: DataFrame) -> DataFrame:
        rows = marked(rows, config, provider) if number == 1 else rows
        return (complete.probed if probe else complete.complete)(rows, lambda row: call(row | {"options": asked_with}), **how)

    return model


@dataclass
class Batches:
    """Asynchronous batches: a provider by name, the ids of those that were submitted, the model, and the call that warms a prompt cache.

    A chunk's batch is submitted once and asked for once a run; while it isn't done its chunk is parked and the others go on. Its id is
    forgotten once its results are kept, so a lost driver asks for them again instead of paying twice.
    """

    jobs: MutableMapping[str, str]
    providers: dict[str, Callable[[], complete.BatchProvider]]
    provider: str
    model: str
    warm: Callable[[dict], object] | None = None
    prices: DataFrame | None = None

    def key(self, run_id: int, number: int, chunk: int) -> str:
        return f"{run_id}:p{number}:{chunk}"

    def of(self, config: Mapping, number: int, key: str) -> Model:
        provider = (config["format_model_provider"] if number == 2 else None) or self.provider
        name = (config["format_model"] if number == 2 else None) or self.model
        params = {k: v for k, v in options(config, number).items() if k not in ("temperature", "timeout", "drop_params", "provider", "model", "response_schema")}
        schema = {"type": "json_schema", "json_schema": {"name": "results", "schema": replies.REPLY_SCHEMA}} if number == 2 and config["format_structured_output"] and provider != "anthropic" else None

        def body(messages: Column, cid: Column, **more) -> Column:
            return prompts.request_body(cid, messages, F.lit(name), provider, number=number, temperature=config["temperature" if number == 1 else "format_temperature"], params=params | more, response_format=schema)

        def warm(rows: DataFrame) -> None:
            first = rows.orderBy("cid").limit(1).select(body(prompts.warming(F.col("messages")), F.concat(F.col("cid"), F.lit("-prewarm")), max_tokens=0)).first()[0]
            complete.warmed(lambda: self.warm(json.loads(first)["params"]))

        def model(rows: DataFrame) -> DataFrame:
            few = rows.select("cid").limit(2).count()
            if not few:
                return complete.without(rows, "nothing to ask")
            asked = marked(rows, config, provider) if number == 1 else rows
            if number == 1 and self.warm and complete.worth_warming(cache=config["cache"], cache_first=config["cache_first"], n_requests=few, provider=provider, submitted=key in self.jobs):
                warm(asked)
            got = complete.batched(self.jobs, key, complete.provider_of(provider, self.providers), asked.select(body(F.col("messages"), F.col("cid")).alias("value")), keep=True)
            return complete.with_batch_results(rows, got, provider, name, self.prices)

        return model


# -- a run by chunks: plan, ask, keep, post, tell

#: Tables dealt by chunk have a folder for so many chunks; of fewer chunks each has its own.
CHUNKS_A_SLOT = 32


class Dealt:
    """Tables dealt by their column chunk and written once, so that a chunk reads its own rows, whatever else there is. They go with close().

    Few chunks are large ones: each task writes its rows of them, as they come. Of many, ranges of chunks are gathered first.
    """

    def __init__(self, spark: SparkSession, path: str, n_chunks: int) -> None:
        self.spark, self.path, self.files, self.schemas = spark, path, state.Files(spark, path), {}
        self.width = CHUNKS_A_SLOT if n_chunks > CHUNKS_A_SLOT else 1

    def put(self, name: str, rows: DataFrame) -> None:
        rows = rows.withColumn("slot", F.floor(F.col("chunk") / self.width))
        gathered = rows if self.width == 1 else rows.repartitionByRange("slot", "chunk").sortWithinPartitions("slot", "chunk")
        gathered.write.partitionBy("slot").parquet(f"{self.path}/{name}")
        self.schemas[name] = rows.drop("slot").schema

    def of(self, name: str, chunk: int) -> DataFrame:
        slot = f"slot={chunk // self.width}"
        if slot not in self.files.names(name):
            return self.spark.createDataFrame([], self.schemas[name]).drop("chunk")
        return self.spark.read.schema(self.schemas[name]).parquet(f"{self.path}/{name}/{slot}").where(F.col("chunk") == chunk).drop("chunk")

    def close(self) -> None:
        self.files.remove("")


@dataclass
class Hooks:
    """What a run calls outside: report (a heartbeat, as a dict), cancelled, send (a bulk endpoint) or dry_run, which posts nothing.

    cancelled is asked before each chunk, and while one runs every watch_seconds (0: not then); a chunk that is running is interrupted.
    """

    report: Callable[[dict], None] | None = None
    cancelled: Callable[[], bool] | None = None
    send: sinks.Send | None = None
    dry_run: bool = False
    saved: Callable[[DataFrame], None] | None = None
    watch_seconds: float = 0.0

    def tell(self, **beat: object) -> None:
        """A heartbeat, without what is None. A reporter that fails is no reason to stop."""
        if self.report:
            try:
                self.report({k: v for k, v in beat.items() if v is not None})
            except Exception as e:
                LOG.warning("heartbeat failed: %s", complete.error_text(e))


class Cancelled(Exception):
    """A chunk was interrupted: nothing of it is kept but what was appended before."""


@contextmanager
def interruptible(spark: SparkSession, hooks: Hooks) -> Iterator[None]:
    """Jobs inside are cancelled, and Cancelled is raised, once hooks.cancelled says so."""
    if not hooks.cancelled or hooks.watch_seconds <= 0:
        yield
        return
    sc, tag, over, hit = spark.sparkContext, f"inkgrid-{uuid.uuid4().hex}", threading.Event(), threading.Event()

    def watch() -> None:
        while not over.wait(hooks.watch_seconds):
            if hit.is_set() or hooks.cancelled():
                hit.set()
                sc.cancelJobsWithTag(tag)  # again and again: the next job of the chunk has the tag too

    watching = threading.Thread(target=watch, daemon=True)
    sc.addJobTag(tag)
    watching.start()
    try:
        yield
    except Exception as e:
        if hit.is_set():
            raise Cancelled from e
        raise
    finally:
        over.set()
        watching.join()
        sc.removeJobTag(tag)


@dataclass
class Outcome:
    """Of a run: its status (succeeded, failed, canceled, parked), cells in all, those with a row now, those with an error, groups without
    pass-1 text, chunks that wait for a batch, and what a dry run would post (run, line)."""

    run_id: int
    status: str
    total: int
    done: int = 0
    errors: int = 0
    failed: int = 0
    parked: int = 0
    lines: DataFrame | None = None


def counted(kind: str = "answer") -> dict[str, Column]:
    """Of rows that are kept: all, those whose payload says error, those to be tried again, and those of spoiled groups."""
    name = "extraction_status" if kind == "answer" else "resolution_status"
    status = F.get_json_object("payload_json", f"$.{name}")
    detail = F.get_json_object("payload_json", f"$.{name.replace('status', 'detail')}")
    return {
        "done": F.count(F.lit(1)), "errors": F.count_if(status == "error"), "failed": F.count_if(F.col("status") == "failed"),
        "spoiled": F.count_if((status == "error") & (F.col("status") == "done") & (detail != payload.NO_TEXT)),
    }


def counters(saved: DataFrame, kind: str = "answer") -> DataFrame:
    """done, errors, failed and spoiled of stored rows. A run observes the same while it writes them."""
    return saved.agg(*(c.alias(n) for n, c in counted(kind).items()))


def message(said: str, number: int, of: int, name: str) -> str:
    """What a heartbeat says; with several runs, which one it is of."""
    return said if of <= 1 else f"run {number}/{of} ({name}): {said}"


def post(table: state.StateTable, rows: DataFrame, hooks: Hooks, kind: str = "answer", runs: list[int] | None = None) -> DataFrame | None:
    """Posts stored rows with their question; those of calls that went through are posted from now on. A dry run returns its lines: run, line.

    What became of each call stands under the table's folder posts/, all of it.
    """
    items = payload.wire_items(rows, kind)
    if hooks.dry_run:
        return sinks.dry_run(items).select("run", F.concat(F.lit("run="), F.col("run").cast("string"), F.lit(" "), F.col("line")).alias("line"))
    if hooks.send is None:
        return None
    path = f"{table.path}/posts/{uuid.uuid4().hex}"
    sinks.post(sinks.as_json(items, kind), hooks.send).write.parquet(path)
    told = rows.sparkSession.read.schema(sinks.OUTCOME).parquet(path)
    if bad := told.where("error is not null or n_rejected > 0").count():
        LOG.error("%d posts failed or had items refused; each one's outcome is in %s", bad, path)
    run = "run_id" if kind == "answer" else "arbiter_run_id"
    fine = told.where("error is null").select(F.col("run").alias(run), F.col("paper").alias("paper_id"))
    table.mark_posted(rows.join(fine, [run, "paper_id"], "left_semi"), runs=runs, whole=True)
    return None


@dataclass
class Chunk:
    """One chunk of a run: its papers, their texts, and the rows of the log that its cells have."""

    number: int
    papers: DataFrame
    texts: DataFrame
    log: DataFrame


def run_chunk(table: state.StateTable, runs: DataFrame, chunk: Chunk, questions: DataFrame, task: Task, hooks: Hooks, *, run_id: int, checkpoint: Checkpoint | None = None, ask: bool = True) -> tuple[dict, DataFrame | None]:
    """Asked, kept, posted. Returns the counters of what was kept, and a dry run's lines. It reads the chunk's own rows alone."""
    before = table.last(chunk.log)
    states = before if task.kind == "answer" else state.by_paper_version(before)
    rows = perform(runs, chunk.papers, chunk.texts, task, states=states, checkpoint=checkpoint, chunk=chunk.number, ask=ask)
    if task.kind != "answer":
        rows = rows.withColumnRenamed("run_id", "arbiter_run_id")
    seq = table.save(rows, F.col("status"), runs=[run_id], observed=counted(task.kind))
    saved = table.appended(seq)
    if hooks.saved:
        hooks.saved(saved)
    got = table.told(seq)
    now = state.unposted(table.last(chunk.log.unionByName(saved)))
    return got, post(table, repost(now, questions)[0], hooks, task.kind, [run_id])


class _Papers:
    """The papers of runs with their texts, by chunks of a size: as they are for one chunk, dealt for more."""

    def __init__(self, table: state.StateTable, papers: DataFrame, texts: DataFrame) -> None:
        self.table, self.papers, self.texts, self.n = table, papers, texts, papers.count()
        self.by_size: dict[int, Dealt] = {}

    def n_chunks(self, size: int) -> int:
        return (math.ceil(self.n / size) if size > 0 else 1) if self.n else 0

    def dealt(self, size: int) -> Dealt:
        if size not in self.by_size:
            out = self.by_size[size] = Dealt(self.table.spark, f"{self.table.path}/dealt/{uuid.uuid4().hex}", self.n_chunks(size))
            out.put("papers", grid.chunks(self.papers, size))
            chunk_of = self.table.spark.read.schema(out.schemas["papers"]).parquet(f"{out.path}/papers").select("paper_id", "chunk")
            out.put("texts", self.texts.join(chunk_of, "paper_id"))
        return self.by_size[size]

    def chunks(self, run_id: int, size: int) -> Iterator[Chunk]:
        """The run's chunks with the rows of the log that stand there when the run begins and those that other writers append meanwhile."""
        table, n = self.table, self.n_chunks(size)
        table.compact_if_long()
        snapshot = table.snapshot()
        names, seen = table.appends(snapshot, [run_id]), table.appends(None)
        log = table.log([run_id], snapshot=snapshot, names=names)
        if n <= 1:
            if n:
                yield Chunk(0, self.papers, self.texts, log)
            return
        dealt = self.dealt(size)
        chunk_of = table.spark.read.schema(dealt.schemas["papers"]).parquet(f"{dealt.path}/papers").select("paper_id", "chunk")
        states = f"states-{uuid.uuid4().hex}"
        dealt.put(states, state.latest(log, table.keys, F.struct("seq", "writer", "row_no")).join(chunk_of, "paper_id"))
        for c in range(n):
            papers, rows = dealt.of("papers", c), dealt.of(states, c).select(*table.schema.names)
            if later := table.others_since(seen, [run_id]):
                rows = rows.unionByName(table._rows(later).where(F.col(table.keys[0]) == run_id).join(papers.select("paper_id"), "paper_id", "left_semi").select(*table.schema.names))
            yield Chunk(c, papers, dealt.of("texts", c), rows)

    def close(self) -> None:
        for dealt in self.by_size.values():
            dealt.close()


def run_all(
    table: state.StateTable, runs: DataFrame, papers: DataFrame, questions: DataFrame, source_text: DataFrame, make: Callable[[Mapping], Task], settings: Mapping | None = None, *,
    defaults: Mapping = S.RUN_DEFAULTS, hooks: Hooks | None = None, checkpoints: str | None = None, total: int | None = None, batches: Batches | None = None,
) -> list[Outcome]:
    """Runs in their order (r_order), each by chunks of papers (p_order): asked, kept and posted chunk by chunk.

    make turns a run's settings into its Task. Heartbeats: at the start, after every chunk, at the end; only the last run that
    is worked on says succeeded or failed. With fail_fast, a spoiled or failed group ends its run after the chunk, and all later runs.
    All that is kept stays: a later call goes on with what isn't complete, and with chunks that are parked because their batch isn't done.
    """
    hooks = hooks or Hooks()
    runs, questions = grid.local(runs), grid.local(questions)
    listed = runs.orderBy("r_order").collect()
    source = _Papers(table, papers, source_text)
    try:
        return _run_each(table, runs, listed, source, questions, make, settings, defaults, hooks, checkpoints, source.n * questions.count() if total is None else total, batches)
    finally:
        source.close()


def _with_batches(task: Task, batches: Batches | None, run_id: int, chunk: int, keep: Checkpoint | None) -> tuple[Task, list[str], bool]:
    """The task whose passes go by batches where the run says so, the batches' keys, and whether pass 1 is still asked."""
    config = task.config
    if not (config["batch_p1"] or config["batch_p2"]):
        return task, [], True
    if batches is None or keep is None:
        raise ValueError("batch_p1 and batch_p2 take batches= and checkpoints=")
    keys = {n: batches.key(run_id, n, chunk) for n in (1, 2) if config[f"batch_p{n}"]}
    models = {n: batches.of(config, n, k) for n, k in keys.items()}
    return replace(task, reason=models.get(1, task.reason), format_=models.get(2, task.format_)), list(keys.values()), keys.get(2) not in batches.jobs


def _run_each(table, runs, listed, source, questions, make, settings, defaults, hooks, checkpoints, cells, batches) -> list[Outcome]:
    out: list[Outcome] = []
    lines = f"dry-runs/{uuid.uuid4().hex}"
    for number, r in enumerate(listed, 1):
        config = S.overlaid(r["config"], settings, defaults)
        task, now = make(config), Outcome(r["run_id"], "succeeded", cells)
        out.append(now)
        size = int(config["chunk_papers"] or 0)
        chunks = source.n_chunks(size)
        one = runs.where(F.col("run_id") == r["run_id"])
        keep = Checkpoint(checkpoints, r["run_id"]) if checkpoints else None

        def beat(status: str, said: str, now: Outcome = now, r: object = r, number: int = number) -> None:
            hooks.tell(run_id=now.run_id, status=status, cells_total=now.total, cells_done=now.done, cells_error=now.errors, message=message(said, number, len(listed), r["name"]))

        def stopped(now: Outcome = now) -> list[Outcome]:
            now.status = "canceled"
            beat("canceled", "canceled")
            return out

        beat("running", "starting")
        for chunk in source.chunks(r["run_id"], size):
            if hooks.cancelled and hooks.cancelled():
                return stopped()
            mine, keys, ask = _with_batches(task, batches, r["run_id"], chunk.number, keep)
            try:
                with interruptible(table.spark, hooks):
                    got, told = run_chunk(table, one, chunk, questions, mine, hooks, run_id=r["run_id"], checkpoint=keep, ask=ask)
            except complete.BatchPending:
                now.parked += 1
                beat("running", f"chunk {chunk.number + 1}/{chunks} parked")
                continue
            except Cancelled:
                return stopped()
            for k in keys:
                batches.jobs.pop(k, None)
            now.done, now.errors, now.failed = now.done + got["done"], now.errors + got["errors"], now.failed + got["failed"]
            if told is not None:
                told.write.mode("append").parquet(f"{table.path}/{lines}/run_id={now.run_id}")
                now.lines = table.spark.read.schema(told.schema).parquet(f"{table.path}/{lines}/run_id={now.run_id}")
            beat("running", f"chunk {chunk.number + 1}/{chunks}")
            if config["fail_fast"] and (got["spoiled"] or got["failed"]):
                now.status = "failed"
                break
        if now.status == "failed":
            beat("failed", "failed")
            break
        last = number == len(listed)
        if now.parked:
            now.status = "parked"
            beat("running", f"{now.parked} chunks wait for a batch")
        else:
            beat("succeeded" if last else "running", "succeeded" if last else "done, moving to next run")
    return out


def annotation(questions: DataFrame, reason: Model = reason_dummy, format_: Model = format_dummy, call: Callable[[dict], dict] | None = None, **how) -> Callable[[Mapping], Task]:
    """The Task of annotation for a run's settings. With call, both passes are made by it as the settings say (see online, which takes `how`)."""

    def make(config: Mapping) -> Task:
        models = (reason, format_) if call is None else tuple(online(call, config, n, **how) for n in (1, 2))
        return Task(grid.groups_frame(questions, config["batching"]), config, reason=models[0], format_=models[1])

    return make


def run(runs: DataFrame, papers: DataFrame, questions: DataFrame, source_text: DataFrame, *, batching: str | dict | list = "all", states: DataFrame | None = None, reason: Model = reason_dummy, format_: Model = format_dummy, text_source: str = "full_text") -> DataFrame:
    """Rows to keep of all runs at once, as one plan without chunks."""
    config = S.RUN_DEFAULTS | {"batching": batching, "text_source": text_source}
    return perform(runs, papers, source_text, annotation(questions, reason, format_)(config), states=states)


def resume(table: state.StateTable, *plan, **how) -> DataFrame:
    """Runs what isn't complete and keeps it; returns the state."""
    table.save(run(*plan, states=table.view(), **how), F.col("status"))
    return table.view()


# -- the passes apart: the state is what they exchange


def run_pass1(table: state.StateTable, runs: DataFrame, papers: DataFrame, source_text: DataFrame, task: Task) -> int:
    """Reasons over groups that aren't complete or reasoned over, and keeps one row a question; returns the questions whose group got none.

    Papers without a text are left out. The reasoning stands in the first row of a group, its usage too.
    """
    states = table.view() if task.kind == "answer" else state.by_paper_version(table.view())
    have, _ = grid.with_source(papers, source_text, task.config["text_source"])
    asked = calls(runs, have, task, states=states, complete_=(*grid.COMPLETE, "pass1_done"))
    done = pass1(asked, task.reason)
    more = [c for c in ("dispute_item_id",) if c in task.groups.columns]
    by = [*task.of_paper, "group_idx"]
    each = done.drop("messages", "source").join(grid.small(task.groups.select(*by, "pos", "version_id", *more)), by)
    first = F.col("pos") == 0
    raw = F.to_json(F.struct(F.when(first, F.col("pass1_text")).alias("pass1_text"), F.when(first, F.col("p1")).alias("p1"), F.col("cid").alias("batch_group_id")))
    lost = _lost("p1", "pass 1 gave no text")
    body = F.when(lost.isNull(), F.to_json(F.struct(raw.alias("raw_response")))).otherwise(payload.error_json(lost, task.kind))
    rows = each.select("run_id", "paper_id", "version_id", *more, F.when(lost.isNull(), "pass1_done").otherwise("failed").alias("status"), body.alias("payload_json"), F.when(lost.isNull(), F.col("cid")).alias("batch_group_id"), lost.alias("error"))
    if task.kind != "answer":
        rows = rows.withColumnRenamed("run_id", "arbiter_run_id")
    return table.appended(table.save(rows, F.col("status"))).where("status = 'failed'").count()


def regrouped(rows: DataFrame, raw: Column) -> DataFrame:
    """Stored rows as groups: run_id, paper_id, group_idx, cid, keys and q, the questions in their order, with what is asked and what is stored; pass1_text, p1.

    Rows that share a batch_group_id are a group, whatever groups are asked for now; their questions keep the plan's order.
    """
    kind = reason_dummy(rows.limit(0)).schema["completion"].dataType
    rows = rows.withColumn("__raw", raw)
    text = F.nullif(C.pass1_text(F.col("__raw")), F.lit(""))
    usage = F.from_json(F.get_json_object("__raw", "$.p1"), kind)
    more = [c for c in ("dispute_item_id",) if c in rows.columns]
    part = F.struct("group_idx", "pos", "key", "version_id", *more, *ASKED, "payload_json", "batch_group_id", "error")
    rows = rows.withColumns({"__t": text, "__u": usage})
    have = F.when(F.col("__t").isNotNull(), F.struct("group_idx", "pos"))
    packed = rows.groupBy("run_id", "paper_id", "group_key").agg(F.array_sort(F.collect_list(part)).alias("q"), F.min_by("__t", have).alias("pass1_text"), F.min_by("__u", have).alias("p1"))
    return packed.withColumns({"cid": F.col("group_key"), "keys": F.col("q.key"), "group_idx": F.get("q", 0)["group_idx"]})


def run_pass2(table: state.StateTable, source_text: DataFrame, task: Task, *, run_ids: list[int] | None = None) -> int:
    """Formats what was reasoned over and keeps the answers; returns the sequence number of what was kept."""
    states = table.pass1() if run_ids is None else table.pass1().where(F.col(table.keys[0]).isin(run_ids))
    if task.kind != "answer":
        states = states.withColumnRenamed("arbiter_run_id", "run_id")
    rows = with_plan(state.regrouped(states), task)
    groups = regrouped(rows, F.get_json_object("payload_json", "$.raw_response"))
    own = replace(task, stored=True)
    done = kept(answers(pass2(with_text(groups, source_text, task), own), own), task.kind)
    if task.kind != "answer":
        done = done.withColumnRenamed("run_id", "arbiter_run_id")
    return table.save(done, F.col("status"))


def with_plan(rows: DataFrame, task: Task) -> DataFrame:
    """Stored rows with the place in the plan and the columns of their question; those of a question that isn't known are left out."""
    by = [*task.of_paper, "version_id"]
    return rows.join(grid.small(task.groups.select(*by, "group_idx", "pos", "key", *asked_columns())), by)


def with_text(groups: DataFrame, source_text: DataFrame, task: Task) -> DataFrame:
    if task.config["text_source"] == "candidates_only":
        return groups.withColumn("source", F.lit(""))
    return groups.join(source_text.select("paper_id", F.col("markdown").alias("source")), "paper_id", "left")


def reformat(table: state.StateTable, source_text: DataFrame, task: Task) -> tuple[int, int]:
    """Formats stored reasoning again and replaces the answers; returns how many rows were replaced and how many weren't.

    Reasoning's tokens, cost and latency stay, and so does the stored raw response but for what is new: the result, the
    check and, in a group's first row, the reply. A group without reasoning, or whose new reply lacks a key, stays as it is.

    The state is read and dealt out once, and each group is formatted once: its rows stay with it until they're written.
    """
    log = table.log()
    n_rows = with_plan(state.postable(table.thin(log)), task).count()
    stored = state.postable(table.by_paper(log))
    if task.kind != "answer":
        stored = stored.withColumnRenamed("arbiter_run_id", "run_id")
    groups = regrouped(with_plan(state.regrouped(stored), task), F.get_json_object("payload_json", "$.raw_response"))
    own = replace(task, stored=True)
    able = groups.where("pass1_text is not null").withColumn("p1", F.struct(F.col("pass1_text").alias("text"), *(F.col(f"p1.{n}").alias(n) for n in ("usage", "cost", "latency_ms")), F.lit(None).cast("string").alias("error")))
    done = answers(pass2(with_text(able, source_text, task), own), own)
    # The condition names pos so that it stays behind the answers: before them, replies would be read for it a second time, and groups dealt out again.
    done = done.where(F.when(F.col("pos") >= 0, F.col("failed").isNull() & F.col("spoiled").isNull()))
    new = F.to_json(F.struct(F.col("result").alias("parse_result"), F.struct("checked.ok", "checked.note").alias("verify"), F.when(F.col("pos") == 0, F.col("completion.text")).alias("pass2_text"), F.when(F.col("pos") == 0, F.col("completion.usage")).alias("p2_raw")))
    done = done.withColumn("__was", payload.body(F.col("was.payload_json"))).withColumn("raw_response", replies.json_over(F.col("__was.raw_response"), new))
    zero = F.lit(0).cast("long")
    done = done.withColumns({**{n: F.coalesce(f"__was.{n}", zero) for n in (*payload.TOKENS, "latency_ms")}, "cost": F.col("__was.cost")})
    more = [c for c in ("dispute_item_id",) if c in done.columns]
    bodies = done.select("run_id", "paper_id", "version_id", *more, payload.payload_json(task.kind).alias("payload_json"), "was.batch_group_id", "was.error")
    if task.kind != "answer":
        bodies = bodies.withColumnRenamed("run_id", "arbiter_run_id")
    replaced = table.told(table.replace_payload(bodies, whole=True, observed={"n": F.count(F.lit(1))}))["n"]
    return replaced, n_rows - replaced


# -- posting what is stored


def repost(rows: DataFrame, questions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored rows with their question, and those of a version that isn't known."""
    known = grid.small(questions.select("version_id", "key", "question_type", "allow_multiple").distinct())
    return rows.join(known, "version_id"), rows.join(known, "version_id", "left_anti")


def repost_all(table: state.StateTable, questions: DataFrame, hooks: Hooks, *, run_ids: list[int] | None = None, paper_ids: list[int] | None = None, kind: str = "answer") -> DataFrame | None:
    """Posts all that is done or posted once more. A dry run returns its lines: run, line."""
    rows = grid.selected(state.postable(table.view(run_ids)), "paper_id", paper_ids)
    return post(table, repost(rows, questions)[0], hooks, kind, run_ids)


def wire(rows: DataFrame, questions: DataFrame, kind: str = "answer") -> DataFrame:
    """Items to post, from stored rows: typed value, wire cost, reasoning."""
    return payload.wire_items(repost(rows, questions)[0], kind)


def throttled_report(report: Callable[[dict], None], **how) -> Callable[[dict], None]:
    """A reporter that leaves out heartbeats that come too soon after the last one sent."""
    return progress.Throttle(report, **how)
