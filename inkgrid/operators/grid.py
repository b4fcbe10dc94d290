"""The grid of runs, papers and question groups, and what of it is still to do.

Small sides (runs, questions) are planned on the driver; papers and states are DataFrames. A cell is
(run_id, paper_id, version_id), a group the questions asked in one call, and its cid "{run}-{paper}-{group}".
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COMPLETE = ("done", "posted")
#: Plans (runs, questions, groups of one document) are sent to all executors up to so many rows; a larger one is joined by an exchange.
SENT_ROWS, SENT_BYTES = 10_000, 8_000_000


def local(plan: DataFrame) -> DataFrame:
    """A plan (runs, questions, groups) with its rows in it, so that what is made of it is known to be small without running anything."""
    return plan.sparkSession.createDataFrame(plan.toArrow(), plan.schema)


def small(plan: DataFrame) -> DataFrame:
    """A plan's side of a join, marked for broadcast if it takes SENT_BYTES at most by what is known of it, or else has SENT_ROWS at most, counted."""
    known = int(str(plan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(plan) if known <= SENT_BYTES or len(plan.select(F.lit(1)).limit(SENT_ROWS + 1).collect()) <= SENT_ROWS else plan


def question_groups(keys: Sequence[str], batching: str | dict | list | None = "all") -> list[list[str]]:
    """Keys in groups: "all", "per_question", {"size": n}, or lists of keys, after which the others stand alone.

    No keys give no groups. An unknown key, a key in two groups and a size below 1 are errors.
    """
    if isinstance(batching, str) and batching[:1] in "[{":
        batching = json.loads(batching)
    keys = list(keys)
    if not keys:
        return []
    if batching in (None, "all"):
        return [keys]
    if batching == "per_question":
        return [[k] for k in keys]
    if isinstance(batching, dict):
        size = int(batching.get("size", 0))
        if size < 1:
            raise ValueError("batching size must be 1 at least")
        return [keys[i : i + size] for i in range(0, len(keys), size)]
    if isinstance(batching, list):
        named = [k for group in batching for k in group]
        if unknown := sorted({*named} - {*keys}):
            raise ValueError(f"unknown question keys: {unknown}")
        if len(named) != len({*named}):
            raise ValueError("a question key is in two groups")
        return [list(g) for g in batching if g] + [[k] for k in keys if k not in named]
    raise ValueError(f"unknown batching: {batching!r}")


def groups_frame(questions: DataFrame, batching: str | dict | list | None = "all") -> DataFrame:
    """group_idx, pos, and the columns of questions (ordered by q_order)."""
    questions = local(questions)
    rows = questions.orderBy("q_order").collect()
    of = {key: (g, p) for g, group in enumerate(question_groups([r["key"] for r in rows], batching)) for p, key in enumerate(group)}
    spark = questions.sparkSession
    if not of:
        return questions.where("false").selectExpr("0 as group_idx", "0 as pos", "*")
    places = spark.createDataFrame([(k, g, p) for k, (g, p) in of.items()], "key string, group_idx int, pos int")
    return local(small(places).join(questions, "key").select("group_idx", "pos", *questions.columns))


def chunks(papers: DataFrame, size: int, order: str = "p_order") -> DataFrame:
    """papers with chunk: runs of `size` in their order (0 or less: one chunk).

    Ranks are found without gathering papers in one task: rows are counted by range of the order first.
    """
    if size <= 0:
        return papers.withColumn("chunk", F.lit(0).cast("long"))
    return ranked(papers, order).withColumn("chunk", F.floor(F.col("rank") / size)).drop("rank")


def ranked(rows: DataFrame, order: str, width: int = 1 << 14) -> DataFrame:
    """rows with rank from 0 by an integer column without nulls: rank in the row's range plus the counts of those below."""
    rows = rows.withColumn("__range", F.floor(F.col(order) / width))
    below = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("__range").agg(F.count("*").alias("__n")).withColumn("__below", F.coalesce(F.sum("__n").over(below), F.lit(0))).drop("__n")
    inside = F.row_number().over(Window.partitionBy("__range").orderBy(order)) - 1
    return rows.join(counts, "__range").withColumn("rank", inside + F.col("__below")).drop("__range", "__below")


def cid(run: Column, paper: Column, group: Column) -> Column:
    return F.concat_ws("-", run.cast("string"), paper.cast("string"), group.cast("string"))


def cells(runs: DataFrame, papers: DataFrame, groups: DataFrame) -> DataFrame:
    """Every cell: run_id, paper_id, group_idx, pos, version_id, key, cid. Papers stay where they are; the other sides are plans."""
    if "paper_id" in groups.columns:
        grid = papers.select("paper_id").join(groups.select("paper_id", "group_idx", "pos", "version_id", "key"), "paper_id").crossJoin(small(runs.select("run_id")))
    else:
        grid = papers.select("paper_id").crossJoin(small(runs.select("run_id").crossJoin(groups.select("group_idx", "pos", "version_id", "key"))))
    return grid.withColumn("cid", cid(F.col("run_id"), F.col("paper_id"), F.col("group_idx")))


def selected(rows: DataFrame, column: str, ids: Sequence[int] | None) -> DataFrame:
    """Rows of the ids; no list means all."""
    return rows if ids is None else rows.where(F.col(column).isin([int(i) for i in ids]))


def parse_ids(text: str | None) -> list[int] | None:
    return None if text is None else [int(x) for x in text.split(",") if x.strip()]


def full_groups(groups: DataFrame, states: DataFrame, complete: Sequence[str] = COMPLETE) -> DataFrame:
    """run_id, paper_id and group_idx of groups whose cells are all complete: counts of complete states, no look at the grid.

    groups: group_idx and version_id, and paper_id where papers have groups of their own. states: one row a cell.
    """
    own = ["paper_id"] if "paper_id" in groups.columns else []
    sizes = groups.groupBy(*own, "group_idx").agg(F.count("*").alias("__size"))
    members = small(groups.select(*own, "group_idx", "version_id").join(small(sizes), [*own, "group_idx"]))
    done = states.where(F.col("status").isin(*complete)).select("run_id", "paper_id", "version_id").join(members, [*own, "version_id"])
    counted = done.groupBy("run_id", "paper_id", "group_idx").agg(F.count("*").alias("__n"), F.first("__size").alias("__size"))
    return counted.where("__n >= __size").select("run_id", "paper_id", "group_idx")


def pending(grid: DataFrame, groups: DataFrame, states: DataFrame, complete: Sequence[str] = COMPLETE) -> DataFrame:
    """Rows of a grid (run_id, paper_id, group_idx, ...) of groups of which some cell isn't complete."""
    return grid.join(full_groups(groups, states, complete), ["run_id", "paper_id", "group_idx"], "left_anti")


def with_source(papers: DataFrame, source_text: DataFrame, text_source: str = "full_text") -> tuple[DataFrame, DataFrame]:
    """Papers with their source text, and those without one. "abstract" takes the abstract, "candidates_only" no text at all."""
    if text_source == "candidates_only":
        return papers.withColumn("source", F.lit("")), papers.where("false")
    if text_source == "abstract":
        found = papers.withColumn("source", F.nullif(F.col("abstract"), F.lit("")))
    else:
        texts = source_text.select("paper_id", F.nullif(F.col("markdown"), F.lit("")).alias("source"))
        # Of papers without a text no text is taken along, only whether there is one.
        has = texts.select("paper_id", F.col("source").isNotNull().alias("__has"))
        lost = papers.join(has, "paper_id", "left").where(~F.coalesce("__has", F.lit(False))).drop("__has")
        return papers.join(texts, "paper_id", "left").where("source is not null"), lost
    return found.where("source is not null"), found.where("source is null").drop("source")
