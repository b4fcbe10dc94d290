"""Format models compared: stored reasoning formatted by each of them, beside the stored answers as the reference."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import payload, reports, state
from . import engine

KEYS = ("run_id", "paper_id", "version_id")
ROW = "value_json string, cited array<string>, verified boolean, error string, cost double, latency_ms bigint, ref_value string, ref_cited array<string>, ref_verified boolean"


def results(spark: SparkSession, path: str) -> state.StateTable:
    """Where compared rows are kept: one of each format model and cell, the last one counts."""
    return state.StateTable(spark, path, ("format_model", *KEYS), texts=("format_model",))


def reference(rows: DataFrame) -> DataFrame:
    """Stored answers as the reference: value, quotes and check of each cell, and what formatting cost."""
    p = rows.withColumn("p", payload.body())
    said = F.get_json_object(F.col("p.raw_response"), "$.parse_result.value_json")
    quotes = F.when(F.coalesce("p.cited_text", F.lit("")) != "", F.split(F.col("p.cited_text"), "\n\n")).otherwise(F.array().cast("array<string>"))
    return p.select(*KEYS, said.alias("value_json"), quotes.alias("cited"), F.col("p.cited_text_verified").alias("verified"), F.coalesce(F.col("p.fmt_cost").try_cast("double"), F.lit(0.0)).alias("fmt_cost"))


def compare(stored: DataFrame, source_text: DataFrame, task: engine.Task, models: Mapping[str, engine.Model]) -> DataFrame:
    """A row a format model and cell: format_model, keys, and ROW. Groups without stored reasoning are left out."""
    groups = engine.regrouped(engine.with_plan(state.regrouped(stored), task), F.get_json_object("payload_json", "$.raw_response")).where("pass1_text is not null")
    own = replace(task, stored=True)
    blank = F.struct(F.col("pass1_text").alias("text"), *(F.col(f"p1.{n}").alias(n) for n in ("usage", "cost", "latency_ms")), F.lit(None).cast("string").alias("error"))
    asked = engine.with_text(groups, source_text, task).withColumn("p1", blank)
    out = None
    for name, model in models.items():
        done = engine.answers(engine.pass2(asked, replace(own, format_=model)), replace(own, format_=model))
        first = F.when(F.col("pos") == 0, F.col("completion.latency_ms")).otherwise(F.lit(0).cast("bigint"))
        bad = F.coalesce("failed", "spoiled")
        rows = done.select(
            F.lit(name).alias("format_model"), *KEYS, F.when(bad.isNull(), F.col("result.value_json")).alias("value_json"), F.when(bad.isNull(), F.col("cited")).alias("cited"), F.when(bad.isNull(), F.col("verified")).alias("verified"),
            bad.alias("error"), F.coalesce(F.col("fmt_cost").try_cast("double"), F.lit(0.0)).alias("cost"), first.alias("latency_ms"),
        )
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError("no format models to compare")
    ref = reference(stored).select(*KEYS, F.col("value_json").alias("ref_value"), F.col("cited").alias("ref_cited"), F.col("verified").alias("ref_verified"))
    return out.join(ref, list(KEYS))


def keep(table: state.StateTable, rows: DataFrame) -> None:
    body = F.to_json(F.struct(*(c.split()[0] for c in ROW.split(", "))))
    table.save(rows.select(*table.keys, body.alias("payload_json"), F.lit(None).cast("string").alias("batch_group_id"), "error"), "done")


def kept(table: state.StateTable, run_ids: list[int] | None = None, paper_ids: list[int] | None = None) -> DataFrame:
    """Compared rows by model and cell, of the runs and papers that are given, in their order."""
    rows = table.view()
    for column, ids in (("run_id", run_ids), ("paper_id", paper_ids)):
        rows = rows if ids is None else rows.where(F.col(column).isin(ids))
    return rows.select(*table.keys, F.from_json("payload_json", ROW).alias("r")).select(*table.keys, "r.*").orderBy(*table.keys)


def report(rows: DataFrame, *by: str) -> DataFrame:
    """The summary of kept rows by format model (and version), sorted by name."""
    tests = rows.drop("ref_value", "ref_cited", "ref_verified")
    ref = rows.select(*KEYS, F.col("ref_value").alias("value_json"), F.col("ref_cited").alias("cited"), F.col("ref_verified").alias("verified")).distinct()
    return reports.bench_summary(reports.compared(tests, ref), *by).orderBy("format_model", *by)


def shown(summary: DataFrame) -> DataFrame:
    """A summary's numbers as they are displayed."""
    return summary.select("format_model", "n", "n_errors", F.concat(C.fixed(F.col("value_match_pct"), 1), F.lit("%")).alias("value_match"), F.concat(C.fixed(F.col("cites_match_pct"), 1), F.lit("%")).alias("cites_match"), C.shown_cost(F.col("cost")).alias("cost"), C.shown_latency(F.col("mean_latency_ms")).alias("latency"), "flagged")
