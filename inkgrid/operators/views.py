"""The read side: what a viewer of runs, answers and texts asks for, as DataFrames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from . import payload, reports, state
from .grid import small


def pipeline_summary(parts: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """A document's runs, papers and questions with the columns that a viewer shows."""
    return {
        "runs": parts["runs"].orderBy("r_order").select("run_id", "name", F.col("model_name").alias("model"), F.col("model_provider").alias("provider"), "config"),
        "papers": parts["papers"].orderBy("p_order").select("paper_id", "title", "split"),
        "questions": parts["questions"].orderBy("q_order").select("question_id", "key", "label", "question_type", "version_id"),
    }


def answers_list(states: DataFrame, runs: DataFrame, papers: DataFrame, questions: DataFrame, *, run_id: int | None = None, paper_id: int | None = None, status: str | None = None) -> DataFrame:
    """Answers by key with the names of their run, paper and question (an unknown one's id, an unknown question's nothing) and the value shown in a list."""
    rows = state.filtered(states, run_id=run_id, paper_id=paper_id)
    if status is not None:
        rows = rows.where(F.col("status") == status)
    rows = reports.named(reports.named(rows, runs, "run_id", "name", "run_name"), papers, "paper_id", "title", "paper_title")
    asked = questions.select("version_id", F.col("key").alias("question_key"), F.col("label").alias("question_label")).dropDuplicates(["version_id"])
    rows = rows.join(small(asked), "version_id", "left").withColumn("payload", payload.body())
    shown = C.shown_in_list(F.col("payload.value_boolean"), F.col("payload.value_categorical"), F.col("payload.value_text"), F.col("payload.value_categorical_multi"))
    return rows.withColumn("shown", shown).drop("payload_json").orderBy("run_id", "paper_id", "version_id")


def answer_detail(states: DataFrame, texts: DataFrame, run_id: int, paper_id: int, version_id: int) -> DataFrame:
    """The one answer with its body, its raw response and its paper's text; no row if there's none."""
    row = states.where((F.col("run_id") == run_id) & (F.col("paper_id") == paper_id) & (F.col("version_id") == version_id)).limit(1)
    return with_text(row, texts)


def with_text(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Answers in detail: the value as it is shown alone, the raw response, and the text of the paper."""
    rows = rows.withColumn("payload", payload.body()).withColumn("raw_response", F.col("payload.raw_response"))
    shown = C.shown_in_detail(F.col("payload.value_boolean"), F.col("payload.value_categorical"), F.col("payload.value_categorical_multi"), F.col("payload.value_text"))
    return rows.withColumn("shown", shown).join(texts.select("paper_id", "markdown"), "paper_id", "left")


def source_detail(papers: DataFrame, texts: DataFrame, paper_id: int) -> DataFrame:
    """paper_id, title, abstract, markdown and has_text; of a paper that isn't known, empty title and abstract."""
    wanted = texts.sparkSession.createDataFrame([(paper_id,)], "paper_id long")
    first = papers.where(F.col("paper_id") == paper_id).limit(1).select("paper_id", "title", "abstract")
    rows = wanted.join(first, "paper_id", "left").join(texts.where(F.col("paper_id") == paper_id).select("paper_id", "markdown"), "paper_id", "left")
    return rows.select("paper_id", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("abstract", F.lit("")).alias("abstract"), "markdown", F.col("markdown").isNotNull().alias("has_text"))


def stats(states: DataFrame, texts: DataFrame) -> DataFrame:
    """Counts by what is counted: answers by status, all answers, texts that were looked up."""
    by_status = reports.status_counts(states).select(F.concat(F.lit("answers "), F.col("status")).alias("what"), "n")
    return by_status.union(states.select(F.lit("answers").alias("what")).groupBy("what").count()).union(texts.select(F.lit("texts").alias("what")).groupBy("what").count())
