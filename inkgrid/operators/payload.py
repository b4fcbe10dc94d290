"""Stored bodies of answers and resolutions: attribution, projection, errors, items on the wire."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C

TOKENS = ("tokens_total", "tokens_input", "tokens_output", "tokens_cached")
FORMAT_TOKENS = tuple(f"fmt_{t}" for t in TOKENS)
CURRENCY = "USD"
NO_TEXT = "no_ocr"


def attributed(rows: DataFrame, pos: str = "pos") -> DataFrame:
    """Tokens, costs and latency of a group's calls on the first of its answers only. p1, completion: completions of the two passes."""
    first = F.col(pos) == 0
    zero = F.lit(0).cast("long")
    use = lambda call, k: F.coalesce(F.col(f"{call}.usage.{k}"), zero)
    out = {}
    for call, prefix in (("p1", ""), ("completion", "fmt_")):
        parts = [use(call, k) for k in ("input_tokens", "output_tokens", "cached_tokens")]
        for name, value in zip(TOKENS, (parts[0] + parts[1] + parts[2], *parts), strict=True):
            out[prefix + name] = F.when(first, value).otherwise(zero)
        out[f"{prefix}cost"] = F.when(first, F.col(f"{call}.cost"))
    out["latency_ms"] = F.when(first, F.coalesce(F.col("p1.latency_ms"), zero) + F.coalesce(F.col("completion.latency_ms"), zero)).otherwise(zero)
    return rows.withColumns(out)


def _values(source: str) -> list[Column]:
    return [F.col(f"{source}.{c}").alias(c) for c in ("value_text", "value_boolean", "value_categorical", "value_categorical_multi")]


def _keys(kind: str) -> list[Column]:
    paper, version = F.col("paper_id").alias("paper"), F.col("version_id").alias("question_version")
    if kind == "answer":
        return [F.col("run_id").alias("run"), paper, version]
    return [F.col("run_id").alias("arbiter_run"), paper, F.col("dispute_item_id").alias("dispute_item"), version]


def payload_json(kind: str = "answer", status: Column | None = None, detail: Column | None = None) -> Column:
    """The stored body of a row with answer.*, comment, cited, checks and the attributed columns. Resolutions have no citations.

    A status or detail that is given wins over the one that follows from the value.
    """
    name = "extraction" if kind == "answer" else "resolution"
    said = [F.coalesce(*(c for c in (given, F.col(f"answer.extraction_{part}")) if c is not None)).alias(f"{name}_{part}") for part, given in (("status", status), ("detail", detail))]
    fields = [*_keys(kind), *_values("answer"), *said, F.col("confidence"), F.col("comment"), C.joined_quotes(F.col("cited")).alias("cited_text"), F.col("verified").alias("cited_text_verified")]
    if kind == "answer":
        fields.append(F.col("citations"))
    fields += [F.col("raw_response"), F.col("latency_ms"), *(F.col(t) for t in (*TOKENS, "cost")), F.lit(CURRENCY).alias("cost_currency"), *(F.col(t) for t in (*FORMAT_TOKENS, "fmt_cost"))]
    return F.to_json(F.struct(*fields))


def error_json(detail: Column, kind: str = "answer") -> Column:
    """The stored body of a cell that has no answer."""
    name = "extraction" if kind == "answer" else "resolution"
    zero = F.lit(0).cast("long")
    numbers = [zero.alias(n) for n in ("latency_ms", *TOKENS, *FORMAT_TOKENS)]
    return F.to_json(F.struct(*_keys(kind), F.lit("error").alias(f"{name}_status"), detail.alias(f"{name}_detail"), F.lit("").alias("comment"), F.lit("").alias("cited_text"), F.lit("{}").alias("raw_response"), *numbers, F.lit(CURRENCY).alias("cost_currency")))


BODY = (
    "value_text string, value_boolean boolean, value_categorical string, value_categorical_multi array<string>, extraction_status string, extraction_detail string, "
    "resolution_status string, resolution_detail string, confidence int, comment string, cited_text string, cited_text_verified boolean, citations array<struct<text:string,verified:boolean>>, "
    "raw_response string, latency_ms bigint, tokens_total bigint, tokens_input bigint, tokens_output bigint, tokens_cached bigint, cost string, cost_currency string, "
    "fmt_tokens_total bigint, fmt_tokens_input bigint, fmt_tokens_output bigint, fmt_tokens_cached bigint, fmt_cost string"
)


def body(payload: Column | str = "payload_json") -> Column:
    return F.from_json(payload, BODY)


def value_on_wire(question_type: Column, many: Column, answer: Column) -> Column:
    """The typed value as a JSON token; null where there's none."""
    def some(c: Column) -> Column:
        listed = F.to_json(F.array(c))
        return F.when(c.isNotNull(), F.substr(listed, F.lit(2), F.length(listed) - 2))

    return (
        F.when(question_type == "boolean", answer["value_boolean"].cast("string"))
        .when((question_type == "categorical") & many, F.to_json(F.coalesce(answer["value_categorical_multi"], F.array().cast("array<string>"))))
        .when(question_type == "categorical", some(answer["value_categorical"])).otherwise(some(answer["value_text"]))
    )


def wire_items(rows: DataFrame, kind: str = "answer") -> DataFrame:
    """Items to post of stored rows with the columns of their question (key, question_type, allow_multiple)."""
    rows = rows.withColumn("p", body())
    name = "extraction" if kind == "answer" else "resolution"
    zero = F.lit(0).cast("long")
    head = [F.col("run_id").alias("run"), F.col("paper_id").alias("paper"), F.col("version_id").alias("question_version"), F.col("key").alias("question_key")]
    if kind != "answer":
        head = [F.col("arbiter_run_id").alias("run"), F.col("paper_id").alias("paper"), F.col("dispute_item_id").alias("dispute_item"), F.col("version_id").alias("question_version"), F.col("key").alias("question_key")]
    own = [F.col("p.cited_text_verified").alias("cited_text_verified"), F.coalesce("p.citations", F.array().cast(C.CITATION)).alias("citations")] if kind == "answer" else []
    cost = C.wire_cost(F.col("p.cost"))
    return rows.select(
        *head, value_on_wire(F.col("question_type"), F.col("allow_multiple"), F.col("p")).alias("value"),
        F.coalesce(F.nullif(F.col(f"p.{name}_status"), F.lit("")), F.lit("ok")).alias("status"), F.coalesce(f"p.{name}_detail", F.lit("")).alias("detail"), F.col("p.confidence").alias("confidence"),
        F.coalesce("p.comment", F.lit("")).alias("comment"), F.coalesce("p.cited_text", F.lit("")).alias("cited_text"), *own, C.pass1_text(F.col("p.raw_response")).alias("raw_response"),
        *(F.coalesce(f"p.{n}", zero).alias(n) for n in (*TOKENS, "latency_ms")), cost.alias("cost"), F.when(cost.isNotNull(), F.coalesce("p.cost_currency", F.lit(CURRENCY))).alias("cost_currency"),
    )
