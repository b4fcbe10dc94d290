"""Column expressions without a Python step: texts, JSON replies, typed values, citations, display."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .replies import PRIMITIVE, SPACE

#: Fixed values of the annotation format.
UNDECIDED = "LLM answered: non-determinable"
NO_QUOTE = ("", "not found", "n/a")
QUOTE_MARKS = "\"“”‘’`"
QUESTION_TYPES = ("boolean", "integer", "float", "text", "categorical")
TRUE_WORDS, FALSE_WORDS = ("true", "yes", "1"), ("false", "no", "0")
ELLIPSIS = r"[.]{2,}|…"
LEAST_ELLIPSIS_CHARS = 40


def stripped(text: Column) -> Column:
    """A text without white space at its ends, of whatever kind."""
    return F.regexp_replace(text, rf"^{SPACE}+|{SPACE}+$", "")


def ellipsis_parts(text: Column) -> Column:
    """The parts around ellipses, trimmed, empty ones left out."""
    return F.filter(F.transform(F.split(text, ELLIPSIS), lambda p: stripped(p)), lambda p: p != "")


def long_enough(parts: Column) -> Column:
    """Whether the parts together have LEAST_ELLIPSIS_CHARS characters."""
    return F.aggregate(parts, F.lit(0), lambda n, p: n + F.length(p)) >= LEAST_ELLIPSIS_CHARS


def joined_quotes(quotes: Column) -> Column:
    """A list of quotes as one text, a blank line between them; none: empty."""
    return F.coalesce(F.array_join(quotes, "\n\n"), F.lit(""))


def simple_text(quotes: Column) -> Column:
    """For comparisons: quotes joined by spaces, lower case, white space collapsed."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(F.array_join(quotes, " "), F.lit(""))), rf"{SPACE}+", " "))


def n_quotes(quotes: Column) -> Column:
    return F.coalesce(F.size(F.filter(quotes, lambda q: q != "")), F.lit(0))


def primitive_value(line: Column) -> Column:
    """The first true, false, null or number after "value": in a line; null if there's none."""
    found = F.regexp_extract(line, PRIMITIVE, 1)
    return F.when(found != "", found)


def pass1_text(raw: Column) -> Column:
    """pass1_text of a raw response; of a response that isn't JSON, all of it; of none, empty."""
    inside = F.coalesce(F.get_json_object(raw, "$.pass1_text"), F.lit(""))
    return F.when(raw.isNull(), "").when(F.try_parse_json(raw).isNull(), raw).otherwise(inside)


def provider_and_model(name: Column) -> tuple[Column, Column]:
    """"provider/model" at the first slash; without one the provider is null."""
    has = name.contains("/")
    return F.when(has, F.substring_index(name, "/", 1)), F.when(has, F.substr(name, F.instr(name, "/") + 1)).otherwise(name)


# -- typed values, from a value as replies.VALUE: kind, said (as Python writes it), items, truth.


def mapped(status: Column, detail: Column, **fields: Column) -> Column:
    kinds = {"value_text": "string", "value_boolean": "boolean", "value_categorical": "string", "value_categorical_multi": "array<string>"}
    return F.struct(*(fields.get(k, F.lit(None)).cast(t).alias(k) for k, t in kinds.items()), status.cast("string").alias("extraction_status"), detail.cast("string").alias("extraction_detail"))


def map_boolean(v: Column) -> Column:
    said = F.lower(v["said"])
    of_text = F.when(said.isin(*TRUE_WORDS), True).when(said.isin(*FALSE_WORDS), False)
    value = F.when(v["kind"] == "string", of_text).otherwise(v["truth"])
    bad = (v["kind"] == "string") & value.isNull()
    detail = F.when(v["kind"] == "null", UNDECIDED).when(bad, v["said"]).otherwise("")
    return mapped(F.when(bad, "invalid").otherwise("ok"), detail, value_boolean=value)


def map_categorical(v: Column, options: Column) -> Column:
    """The text of any value, of a list too, is looked for among the options."""
    valid = F.array_contains(options, v["said"])
    detail = F.when(v["said"].isNull(), UNDECIDED).when(valid, "").otherwise(v["said"])
    return mapped(F.when(v["said"].isNull() | valid, "ok").otherwise("invalid"), detail, value_categorical=F.when(valid, v["said"]))


def map_multi(v: Column, options: Column) -> Column:
    """A list keeps its valid elements, with repetitions; another value is a list of one; null is the empty list."""
    none = F.array().cast("array<string>")
    given = F.when(v["kind"] == "array", v["items"]).when(v["kind"] == "null", none).otherwise(F.array(v["said"]))
    valid = F.filter(given, lambda x: F.array_contains(options, x))
    bad = F.size(valid) < F.size(given)
    detail = F.when(v["kind"] == "null", UNDECIDED).when(bad, v["said"]).otherwise("")
    return mapped(F.when(bad, "invalid").otherwise("ok"), detail, value_categorical_multi=valid)


def map_text(v: Column) -> Column:
    return mapped(F.lit("ok"), F.lit(""), value_text=v["said"])


def map_value(question_type: Column, allow_multiple: Column, v: Column, options: Column) -> Column:
    """The typed columns of an answer; an unknown question type is an error."""
    unknown = F.raise_error(F.concat(F.lit("unknown question type: "), question_type))
    none = mapped(unknown.cast("string"), F.lit(""))
    return (
        F.when(question_type == "boolean", map_boolean(v))
        .when((question_type == "categorical") & allow_multiple, map_multi(v, options)).when(question_type == "categorical", map_categorical(v, options))
        .when(question_type.isin("text", "integer", "float"), map_text(v)).otherwise(none)
    )


# -- citations


CITATION = "array<struct<text:string,verified:boolean>>"


def citations(quotes: Column, checks: Column) -> Column:
    """One citation a quote that isn't blank, verified as the check at its place says (none: null)."""
    pairs = F.zip_with(quotes, checks, lambda q, v: F.struct(q.alias("text"), v.alias("verified")))
    return F.coalesce(F.filter(pairs, lambda c: stripped(c["text"]) != ""), F.array().cast(CITATION))


def verified_of(found: Column) -> Column:
    """all, any, none, or empty where there's nothing checked."""
    yes, no = F.exists(found, _is(True)), F.exists(found, _is(False))
    return F.when(F.size(found) == 0, "").when(F.forall(found, _is(True)), "all").when(yes, "any").when(no, "none").otherwise("")


def _is(x: bool):
    return lambda c: c["verified"].eqNullSafe(F.lit(x))


# -- display and wire


def shown_in_list(boolean: Column, categorical: Column, text: Column, multi: Column) -> Column:
    given = F.when(F.size(multi) > 0, F.array_join(multi, ", "))
    return F.coalesce(boolean.cast("string"), F.nullif(categorical, F.lit("")), F.nullif(text, F.lit("")), given)


def shown_in_detail(boolean: Column, categorical: Column, multi: Column, text: Column) -> Column:
    given = F.when(F.size(multi) > 0, F.array_join(multi, ", "))
    return F.coalesce(boolean.cast("string"), F.nullif(categorical, F.lit("")), given, F.nullif(text, F.lit("")))


def fixed(x: Column, digits: int) -> Column:
    """A double with so many digits after the point, rounded by its exact binary value, ties to even (printf's rule; format_string
    rounds the shortest decimal, ties up). The product with the power of ten is taken with its rounding error (Dekker 1971)."""
    x, scale = x.cast("double"), float(10**digits)
    high = x * 134217729.0 - (x * 134217729.0 - x)
    product = x * scale
    error = (high * scale - product) + (x - high) * scale
    below = F.floor(product)
    off = (product - below) - 0.5
    up = (off > 0) | ((off == 0) & ((error > 0) | ((error == 0) & (below % 2 != 0))))
    return F.format_string(f"%.{digits}f", (below + up.cast("int")) / scale)


def wire_cost(cost: Column) -> Column:
    return F.when(cost.isNotNull() & (cost != ""), fixed(cost, 6))


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


def html_safe(text: Column) -> Column:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def shown_percent(part: Column, whole: Column) -> Column:
    """One digit after the point; of nothing: n/a."""
    return F.when(whole == 0, "n/a").otherwise(F.concat(fixed(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), 1), F.lit("%")))


def shown_cost(total: Column) -> Column:
    """Dollars: six digits below a tenth of a cent, else four."""
    return F.concat(F.lit("$"), F.when((total == 0) | (total < 0.001), fixed(total, 6)).otherwise(fixed(total, 4)))


def shown_latency(ms: Column) -> Column:
    return (
        F.when(ms.isNull(), "n/a").when(ms >= 60_000, F.concat(fixed(ms / 60_000.0, 1), F.lit("m")))
        .when(ms >= 1_000, F.concat(fixed(ms / 1_000.0, 1), F.lit("s"))).otherwise(F.concat(fixed(ms, 0), F.lit("ms")))
    )


def shown_count(n: Column) -> Column:
    """With commas between thousands."""
    return F.format_number(n, 0)


def cache_tokens(provider: Column, usage: Column) -> Column:
    """struct<cached_read, cached_write> of a provider's usage JSON; missing numbers are 0."""
    own = F.lower(provider) == "anthropic"
    n = lambda path: F.coalesce(F.get_json_object(usage, path).try_cast("bigint"), F.lit(0).cast("bigint"))
    return F.struct(
        F.when(own, n("$.cache_read_input_tokens")).otherwise(n("$.prompt_tokens_details.cached_tokens")).alias("cached_read"),
        F.when(own, n("$.cache_creation_input_tokens")).otherwise(F.lit(0).cast("bigint")).alias("cached_write"),
    )


def shortened(text: Column, n: int) -> Column:
    return F.substring(text, 1, n)
