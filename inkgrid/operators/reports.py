"""Status, cost and comparison reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import evidence, replies

COUNTED = ("tokens_total", "tokens_input", "tokens_output", "tokens_cached", "fmt_tokens_total", "fmt_tokens_input", "fmt_tokens_output", "fmt_tokens_cached")


def status_counts(states: DataFrame) -> DataFrame:
    return states.groupBy("status").agg(F.count("*").alias("n"))


def cost_summary(states: DataFrame, run: str = "run_id") -> DataFrame:
    """Tokens and cost of each run over all rows with a payload, whatever their status. Missing numbers are 0."""
    schema = ", ".join([*(f"{c} bigint" for c in COUNTED), "cost string", "fmt_cost string"])
    rows = states.where("payload_json is not null").select(run, F.from_json("payload_json", schema).alias("p"))
    money = lambda c: F.sum(F.coalesce(F.col(f"p.{c}").try_cast("double"), F.lit(0.0))).alias(c)
    return rows.groupBy(run).agg(*(F.sum(F.coalesce(F.col(f"p.{c}"), F.lit(0))).alias(c) for c in COUNTED), money("cost"), money("fmt_cost"), F.count("*").alias("n_answers"))


def with_total(summary: DataFrame, run: str = "run_id") -> DataFrame:
    """A cost summary with a row of all runs (null), and each row's share of cached input."""
    sums = [F.sum(c).alias(c) for c in summary.columns if c != run]
    return summary.rollup(run).agg(*sums).withColumn("cache_percent", C.percent(F.col("tokens_cached"), F.col("tokens_input")))


def named(rows: DataFrame, names: DataFrame, key: str, name: str, out: str) -> DataFrame:
    """rows with the name of their key, or the key as text."""
    return rows.join(names.select(key, F.col(name).alias("__name")), key, "left").withColumn(out, F.coalesce("__name", F.col(key).cast("string"))).drop("__name")


def compared(tests: DataFrame, reference: DataFrame) -> DataFrame:
    """Rows of format models beside the reference row of their cell: value_match (by canonical JSON), cites_match, similarity of the quotes (null where the reference has none)."""
    ref = reference.select("run_id", "paper_id", "version_id", F.col("value_json").alias("ref_value"), F.col("cited").alias("ref_cited"), F.col("verified").alias("ref_verified"))
    rows = tests.join(ref, ["run_id", "paper_id", "version_id"])
    rows = rows.withColumns({
        "value_match": replies.canonical_column("value_json").eqNullSafe(replies.canonical_column("ref_value")), "cites_match": C.n_quotes(F.col("cited")) == C.n_quotes(F.col("ref_cited")),
        "has_ref": C.n_quotes(F.col("ref_cited")) > 0, "test_text": C.simple_text(F.col("cited")), "ref_text": F.when(C.n_quotes(F.col("ref_cited")) > 0, C.simple_text(F.col("ref_cited"))),
    })
    return rows.withColumn("similarity", evidence.similarity("test_text", "ref_text"))


def bench_summary(rows: DataFrame, *by: str) -> DataFrame:
    """Per format model (and version): counts, matches in percent, cost, mean of the latencies that aren't 0, and a flag.

    Flagged: citation counts agree in less than 99 %, or the share verified is over 2 points from the reference's.
    """
    sets = [("format_model",), *(("format_model", b) for b in by)]
    keys = ["format_model", *by]
    share = lambda c: C.percent(F.sum(F.col(c).cast("int")), F.count("*"))
    aggs = [
        F.count("*").alias("n"), F.count_if(F.col("error").isNotNull()).alias("n_errors"), share("value_match").alias("value_match_pct"), share("cites_match").alias("cites_match_pct"),
        C.percent(F.count_if(F.col("has_ref") & F.col("verified")), F.count_if(F.col("has_ref"))).alias("verified_pct"), C.percent(F.count_if(F.col("has_ref") & F.col("ref_verified")), F.count_if(F.col("has_ref"))).alias("ref_verified_pct"),
        F.avg("similarity").alias("mean_similarity"), F.sum("cost").alias("cost"), F.avg(F.nullif(F.col("latency_ms"), F.lit(0))).alias("mean_latency_ms"),
    ]
    out = rows.groupingSets([[F.col(c) for c in s] for s in sets], *keys).agg(*aggs)
    return out.withColumn("flagged", (F.col("cites_match_pct") < 99) | (F.abs(F.col("verified_pct") - F.col("ref_verified_pct")) > 2))


def reference_stats(reference: DataFrame) -> DataFrame:
    """Of reference answers (cited, verified, fmt_cost): answers, those with quotes, of these the verified, in percent too, and formatting's cost."""
    quoted = C.n_quotes(F.col("cited")) > 0
    good = F.count_if(quoted & F.col("verified"))
    return reference.agg(F.count("*").alias("n"), F.count_if(quoted).alias("n_quoted"), good.alias("n_verified"), C.percent(good, F.count_if(quoted)).alias("verified_pct"), F.sum(F.coalesce("fmt_cost", F.lit(0.0))).alias("cost"))


def extent(rows: DataFrame) -> DataFrame:
    """How many runs, papers and versions rows are of."""
    return rows.agg(*(F.count_distinct(f"{c}_id").alias(f"n_{c}s") for c in ("run", "paper", "version")))


def usage_totals(results: DataFrame) -> DataFrame:
    """Of a batch: results by kind, tokens, cached share of input."""
    ok = F.col("type") == "succeeded"
    total = lambda c: F.sum(F.when(ok, F.col(c)).otherwise(0))
    return results.agg(
        F.count_if(ok).alias("n_ok"), F.count_if(~ok).alias("n_errors"), total("input_tokens").alias("input_tokens"), total("cached_tokens").alias("cached_tokens"),
        (total("cached_tokens") * 100.0 / F.greatest(total("input_tokens") + total("cached_tokens"), F.lit(1))).alias("cache_hit_pct"),
    )


def heartbeat(run: Column, status: Column, total: Column, done: Column, error: Column, message: Column, **optional: Column) -> Column:
    """One JSON object; optional keys that are null are left out."""
    return F.to_json(F.struct(run.alias("run_id"), status.alias("status"), total.alias("cells_total"), done.alias("cells_done"), error.alias("cells_error"), message.alias("message"), *(v.alias(k) for k, v in optional.items())))
