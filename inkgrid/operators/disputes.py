"""Disputed answers: their papers, questions and candidates."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .grid import question_groups, small


def papers(disputes: DataFrame) -> DataFrame:
    """A row a paper, in order of first sight: the first title and abstract win."""
    first = F.min_by(F.struct("paper_title", "abstract"), "d_order")
    return disputes.groupBy("paper_id").agg(first.alias("f"), F.min("d_order").alias("p_order")).select("paper_id", F.col("f.paper_title").alias("title"), F.col("f.abstract").alias("abstract"), "p_order")


def questions_of_papers(disputes: DataFrame, questions: DataFrame) -> DataFrame:
    """Each paper's disputed questions, found by key; the first of a version wins, unknown keys are dropped."""
    rows = disputes.select("paper_id", "d_order", F.col("question_key").alias("key")).join(small(questions), "key")
    once = Window.partitionBy("paper_id", "version_id").orderBy("d_order")
    return rows.withColumn("__n", F.row_number().over(once)).where("__n = 1").drop("__n")


def item_of_cell(disputes: DataFrame) -> DataFrame:
    """dispute_item_id and candidates of (paper_id, version_id): the last of repeated ones."""
    last = F.max_by(F.struct("dispute_item_id", "candidates"), "d_order")
    return disputes.groupBy("paper_id", "version_id").agg(last.alias("l")).select("paper_id", "version_id", F.col("l.dispute_item_id").alias("dispute_item_id"), F.col("l.candidates").alias("candidates"))


def with_items(cells: DataFrame, disputes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cells with their dispute item and candidates, and the cells that have none."""
    items = item_of_cell(disputes)
    return cells.join(items, ["paper_id", "version_id"]), cells.join(items, ["paper_id", "version_id"], "left_anti")


def by_paper(disputes: DataFrame) -> DataFrame:
    """Each paper's disputed items in their order: paper_id, items."""
    rows = disputes.groupBy("paper_id").agg(F.array_sort(F.collect_list(F.struct("d_order", "dispute_item_id", "question_key", "version_id"))).alias("items"))
    return rows


def groups_of_papers(disputes: DataFrame, questions: DataFrame, batching: str | dict | list | None = "all") -> DataFrame:
    """The groups of each paper's own questions: paper_id, group_idx, pos, the question's columns, dispute_item_id and candidates.

    A paper's questions come in the order of its disputes and are batched as all questions are: "all", "per_question",
    {"size": n}, or lists of keys, after which its other questions stand alone.
    """
    asked = questions_of_papers(disputes, questions)
    at = F.row_number().over(Window.partitionBy("paper_id").orderBy("d_order")) - 1
    if isinstance(batching, str) and batching[:1] in "[{":
        batching = json.loads(batching)
    if batching in (None, "all"):
        rows = asked.withColumn("group_idx", F.lit(0)).withColumn("pos", at)
    elif batching == "per_question" or isinstance(batching, dict):
        size = 1 if batching == "per_question" else int(batching.get("size", 0))
        if size < 1:
            raise ValueError("batching size must be 1 at least")
        rows = asked.withColumn("__at", at).withColumn("group_idx", F.floor(F.col("__at") / size).cast("int")).withColumn("pos", F.col("__at") % size).drop("__at")
    else:
        planned = question_groups([r["key"] for r in questions.select("key").collect()], batching)
        places = questions.sparkSession.createDataFrame([(k, g, p) for g, group in enumerate(planned) for p, k in enumerate(group)], "key string, __g int, __p int")
        rows = asked.join(small(places), "key")
        named = len(batching) if isinstance(batching, list) else 0
        alone = Window.partitionBy("paper_id").orderBy(F.when(F.col("__g") < named, F.struct(F.col("__g"), F.lit(0).cast("long"))).otherwise(F.struct(F.lit(named), F.col("d_order").cast("long"))))
        rows = rows.withColumn("group_idx", F.dense_rank().over(alone) - 1)
        rows = rows.withColumn("pos", F.row_number().over(Window.partitionBy("paper_id", "group_idx").orderBy("__p")) - 1).drop("__g", "__p")
    items = item_of_cell(disputes)
    none = F.array().cast(items.schema["candidates"].dataType)
    return rows.drop("d_order").join(items, ["paper_id", "version_id"], "left").withColumn("candidates", F.coalesce("candidates", none))
