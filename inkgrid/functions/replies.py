"""Structured replies of a model: JSON objects, lists, fenced blocks, JSON lines, damaged lines.

results() reads everything, in a batch of Arrow at a time. plain_results are variant expressions for what is well-formed, without Python; a damaged
reply, values that are lists, objects or numbers with a point are left by them. They take longer, so runs read by results(). A reply that can't be
read at all has no results, so it spoils its group and nothing else.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: The marker of an answer without a quote, and the texts of errors.
NO_DIRECT_QUOTE = "[NO DIRECT QUOTE]"
MISSING = "key {key!r} not found in pass-2 output"
EXTRACTION_FAILED = "Pass-2 extraction failed for "
#: A JSON literal other than a text, a list or an object, after "value": (fixed value).
PRIMITIVE = r'"value"\s*:\s*(true|false|null|-?[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?)'
_PRIMITIVE = re.compile(PRIMITIVE)
#: An escape of half a surrogate pair; so many brackets are no depth that any writer fails at.
_HALF, SHALLOW = re.compile(r"[\ud800-\udfff]|\\u[dD][89a-fA-F]"), 200

#: A JSON value as the typed columns need it: its kind, its text as Python writes it, the texts of a list's elements, its truth.
VALUE = T.StructType([T.StructField("kind", T.StringType()), T.StructField("said", T.StringType()), T.StructField("items", T.ArrayType(T.StringType())), T.StructField("truth", T.BooleanType())])
RESULT = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("value_json", T.StringType()), T.StructField("value", VALUE), T.StructField("cited", T.ArrayType(T.StringType())), T.StructField("cited_kind", T.StringType()),
    T.StructField("comment", T.StringType()), T.StructField("confidence", T.IntegerType()), T.StructField("parse_error", T.StringType()),
])


def value_of(x: object) -> dict:
    kinds = {bool: "boolean", int: "number", float: "number", str: "string", list: "array", dict: "object"}
    shown = [repr(i) for i in x] if isinstance(x, list) else None
    said = None if x is None else str(x) if shown is None else f"[{', '.join(shown)}]"
    items = None if shown is None else [i if isinstance(i, str) else r for i, r in zip(x, shown, strict=True)]
    return {"kind": kinds.get(type(x), "null"), "said": said, "items": items, "truth": None if x is None else bool(x)}


@F.pandas_udf(VALUE)
def value_column(tokens: pd.Series) -> pd.DataFrame:
    """The VALUE of a JSON token; no token is null."""
    known: dict[str, dict] = {}
    rows = []
    for t in tokens:
        if t is None:
            rows.append(value_of(None))
            continue
        if t not in known:
            known[t] = value_of(json.loads(t))
        rows.append(known[t])
    return pd.DataFrame(rows, columns=["kind", "said", "items", "truth"])


def canonical(token: str | None) -> str | None:
    """A JSON token with sorted keys and one spelling; 1 and 1.0 differ, as they do in the text; what isn't JSON stays as it is."""
    try:
        return None if token is None else json.dumps(json.loads(token), sort_keys=True)
    except ValueError:
        return token


@F.pandas_udf(T.StringType())
def canonical_column(tokens: pd.Series) -> pd.Series:
    return tokens.map(canonical, na_action="ignore")


def unfenced(text: str) -> str:
    """The inside of a leading fenced block up to the last bare fence; a text without either stays as it is."""
    first, *rest = text.strip().splitlines() or [""]
    bare = [i for i, line in enumerate(rest) if line.strip() == "```"]
    return "\n".join(rest[: bare[-1]]) if first.startswith("```") and bare else text


def loaded(text: str) -> object:
    """A JSON text's value; ValueError where it isn't one, is nested too deeply, or holds half a surrogate pair, which no text can."""
    try:
        got = json.loads(text)
        # Halves come from escapes alone; what is read may be nested too deeply to be written.
        if _HALF.search(text) or text.count("[") + text.count("{") > SHALLOW:
            json.dumps(got, ensure_ascii=False).encode()
    except RecursionError:
        raise ValueError("nested too deeply") from None
    return got


def tolerant(line: str) -> object:
    """JSON with single quotes, trailing commas, Python's constants or missing ends; ValueError if it can't be read."""
    text = line.strip()
    out, closers, in_string, i = [], [], "", 0
    while i < len(text):
        c = text[i]
        if in_string:
            if c == "\\" and i + 1 < len(text):
                out.append(text[i : i + 2])
                i += 1
            elif c == in_string:
                out.append('"')
                in_string = ""
            else:
                out.append('\\"' if c == '"' else c)
        elif c in "\"'":
            in_string = c
            out.append('"')
        else:
            if c in "{[":
                closers.append("}" if c == "{" else "]")
            elif c in "}]":
                if closers:
                    closers.pop()
                while out and out[-1].strip() in ("", ","):
                    out.pop()
            out.append(c)
        i += 1
    text = "".join(out) + ('"' if in_string else "")
    text = re.sub(r"[,\s:]+$", "", text) + "".join(reversed(closers))
    text = re.sub(r"\bTrue\b", "true", re.sub(r"\bFalse\b", "false", re.sub(r"\bNone\b", "null", text)))
    return loaded(text)


def repaired(line: str) -> dict | None:
    """A damaged line's object, if it names a key and its value is the literal that stands in the line (null where none does)."""
    try:
        got = tolerant(line)
    except ValueError:
        return None
    literal = _PRIMITIVE.search(line)
    expected = None if literal is None else {"true": True, "false": False, "null": None}.get(literal[1], literal[1])
    if isinstance(expected, str):
        expected = int(expected) if expected.lstrip("-").isdigit() else float(expected)
    agrees = isinstance(got, dict) and bool(got.get("key")) and got.get("value") == expected
    return got if agrees else None


def cited_of(raw: object) -> tuple[list[str], str]:
    """Quotes, and whether they came as a text, a list, or the marker that says there is none."""
    if isinstance(raw, list):
        quotes = ["" if x is None else str(x) for x in raw]
        return ([], "none") if [q.strip() for q in quotes] == [NO_DIRECT_QUOTE] else (quotes, "list")
    if not raw:
        return [], "text"
    return ([], "none") if isinstance(raw, str) and raw.strip() == NO_DIRECT_QUOTE else ([str(raw)], "text")


def _lines(body: str) -> Iterable[object]:
    for line in body.splitlines():
        if line.strip().startswith("{"):
            try:
                yield loaded(line)
            except ValueError:
                yield repaired(line)


def _items(text: str) -> Iterable[object]:
    body = unfenced(text)
    try:
        whole = loaded(body)
    except ValueError:
        return _lines(body)
    found = whole.get("results") if isinstance(whole, dict) and "results" in whole else whole
    if isinstance(found, list):
        return found
    return [] if found is not whole else _lines(body)


def _whole_number(x: object) -> int | None:
    """A number without what follows its point, if it's one that 32 bits hold."""
    if not isinstance(x, (int, float)) or isinstance(x, bool) or x != x or abs(x) >= 2**31:
        return None
    return int(x)


def results(text: str | None, keys: Iterable[str]) -> list[dict]:
    """One result for each key asked for, in order; the last of several answers counts, a missing one is an error. A key that isn't a text is none."""
    got = {x["key"]: x for x in _items(text or "") if isinstance(x, dict) and isinstance(x.get("key"), str) and x["key"]}
    out = []
    for key in keys:
        x = got.get(key)
        value = (x or {}).get("value")
        cited, kind = cited_of((x or {}).get("cited_text"))
        out.append({
            "key": key, "value_json": None if x is None else json.dumps(value, ensure_ascii=False), "value": value_of(value), "cited": cited, "cited_kind": kind, "comment": str((x or {}).get("comment") or ""),
            "confidence": _whole_number((x or {}).get("confidence")), "parse_error": MISSING.format(key=key) if x is None else None,
        })
    return out


_RESULTS = T.ArrayType(RESULT)


@F.arrow_udf(_RESULTS)
def _results(text: pa.Array, keys: pa.Array) -> pa.Array:
    """A batch's replies; equal ones, asked for the same keys, are read once."""
    read: dict[tuple, list[dict]] = {}
    out = []
    for t, k in zip(text.to_pylist(), keys.to_pylist(), strict=True):
        at = t, tuple(k or ())
        if at not in read:
            read[at] = results(*at)
        out.append(read[at])
    return pa.array(out, to_arrow_type(_RESULTS))


def let(x: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once."""
    return F.get(F.transform(F.array(x), f), 0)


#: Python's white space, and its ends of lines but for the line feed.
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
_LINE_ENDS = r"[\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


def _kind(v: Column) -> Column:
    """STRING, BIGINT, ..., ARRAY, OBJECT of a variant; null of none."""
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def _field(v: Column, name: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, f"$.{name}", kind)


def _parsed(body: Column) -> Column:
    """The variant of a JSON text; null where it isn't one, or where anything follows it: inside brackets of either kind it's one value."""
    listed = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), body, F.lit("]"))), "$", "array<variant>")
    named = F.try_parse_json(F.concat(F.lit('{"w":'), body, F.lit("}")))
    return let(listed, lambda x: F.when((F.size(x) == 1) & named.isNotNull(), F.get(x, 0)))


def _body(text: Column) -> Column:
    """unfenced(), for texts whose only ends of lines are line feeds."""
    fenced = r"(?s)^```[^\n]*\n((?:.*\n)?)[ \t]*```[ \t]*(?:\n.*)?$"
    inside = let(F.regexp_replace(text, rf"^{SPACE}+|{SPACE}+$", ""), lambda bare: F.when(F.regexp_like(bare, F.lit(fenced)), F.regexp_extract(bare, fenced, 1)))
    return F.when(F.contains(text, F.lit("```")), F.coalesce(inside, text)).otherwise(text)


def _plain_items(body: Column) -> Column:
    """The items of a well-formed reply: a list, an object with a list of results, or an object a line; null: not one of these."""
    none = F.array().cast("array<variant>")
    lines = F.filter(F.split(body, "\n"), lambda x: F.regexp_like(x, F.lit(r"[^ \t]")))
    of_lines = let(lines, lambda all_: F.when(F.forall(all_, lambda x: F.regexp_like(x, F.lit(r"^[ \t]*\{"))), let(F.transform(all_, _parsed), lambda o: F.when(F.forall(o, lambda v: v.isNotNull()), o))))

    is_list, listed = F.regexp_like(body, F.lit(r"^[ \t\n]*\[")), lambda v, path: F.try_variant_get(v, path, "array<variant>")

    def of_whole(v: Column) -> Column:
        return (
            F.when(v.isNull(), F.when(F.regexp_like(body, F.lit(r"\}[ \t\n]*\n[ \t\n]*\{")), of_lines))
            .when(is_list, listed(v, "$")).when(_field(v, "results").isNotNull(), listed(v, "$.results")).otherwise(of_lines)
        )

    return F.when(F.regexp_like(body, F.lit(r"^[ \t\n]*$")), none).otherwise(let(_parsed(body), of_whole))


def _typed(v: Column) -> Column:
    """A variant with its kind and its text, each computed once."""
    return F.struct(v.alias("v"), _kind(v).alias("kind"), F.try_variant_get(v, "$", "string").alias("text"))


def _plain_value(x: Column) -> Column:
    """VALUE and the token of an item's value; null where they take Python."""

    def of(t: Column) -> Column:
        kind, text = t["kind"], t["text"]
        truth = F.when(kind == "STRING", text != "").when(kind == "BOOLEAN", text == "true").otherwise(text != "0")
        said = F.when(kind == "BOOLEAN", F.initcap(text)).otherwise(text)
        shown = F.when(kind == "STRING", "string").when(kind == "BOOLEAN", "boolean").otherwise("number")
        pack = lambda kind_, said_, truth_, token_: F.struct(F.struct(kind_.alias("kind"), said_.alias("said"), F.lit(None).cast("array<string>").alias("items"), truth_.alias("truth")).alias("value"), token_.alias("token"))
        none = F.lit(None).cast("string")
        return F.when(kind.isNull() | (kind == "VOID"), pack(F.lit("null"), none, F.lit(None).cast("boolean"), F.lit("null"))).when(kind.isin("STRING", "BOOLEAN", "BIGINT"), pack(shown, said, truth, F.to_json(t["v"])))

    return let(_typed(_field(x, "value")), of)


def _plain_cited(x: Column) -> Column:
    """An item's quotes and how they came; null where they take Python."""
    none = F.array().cast("array<string>")
    is_marker = lambda q: F.regexp_like(q, F.lit(rf"^{SPACE}*\Q{NO_DIRECT_QUOTE}\E{SPACE}*$"))
    pack = lambda quotes, how: F.struct(quotes.alias("cited"), F.lit(how).alias("kind"))

    def of_list(several: Column) -> Column:
        listed = F.transform(several, lambda q: F.coalesce(F.try_variant_get(q, "$", "string"), F.lit("")))
        return F.when(F.forall(several, lambda q: _kind(q).isin("STRING", "VOID")), F.when((F.size(several) == 1) & is_marker(F.get(listed, 0)), pack(none, "none")).otherwise(pack(listed, "list")))

    def of(t: Column) -> Column:
        kind, text = t["kind"], t["text"]
        return (
            F.when(kind.isNull() | (kind == "VOID") | ((kind == "BOOLEAN") & (text == "false")), pack(none, "text"))
            .when(kind == "STRING", F.when(text == "", pack(none, "text")).when(is_marker(text), pack(none, "none")).otherwise(pack(F.array(text), "text")))
            .when(kind == "ARRAY", let(F.try_variant_get(t["v"], "$", "array<variant>"), of_list))
        )

    return let(_typed(_field(x, "cited_text")), of)


def _plain_comment(x: Column) -> Column:
    """An item's comment; null where it takes Python."""
    return let(_typed(_field(x, "comment")), lambda t: F.when(t["kind"].isNull() | (t["kind"] == "VOID") | ((t["kind"] == "BOOLEAN") & (t["text"] == "false")), "").when(t["kind"] == "STRING", t["text"]))


def _plain_confidence(x: Column) -> Column:
    def of(t: Column) -> Column:
        number = F.when(t["kind"].isin("BIGINT", "DECIMAL", "DOUBLE"), F.try_variant_get(t["v"], "$", "double"))
        return F.when(F.abs(number) < 2**31, F.when(number < 0, F.ceil(number)).otherwise(F.floor(number)).cast("int"))

    return let(_typed(_field(x, "confidence")), of)


def _packed(**fields: Column) -> Column:
    return F.struct(*(fields[f.name].cast(f.dataType).alias(f.name) for f in RESULT))


def _plain_result(key: Column, x: Column) -> Column:
    """RESULT of a key and its item (null: none); null where it takes Python."""
    none, empty = F.lit(None).cast("string"), F.array().cast("array<string>")

    def of(p: Column) -> Column:
        found = _packed(key=key, value_json=p["v"]["token"], value=p["v"]["value"], cited=p["c"]["cited"], cited_kind=p["c"]["kind"], comment=p["said"], confidence=p["sure"], parse_error=none)
        return F.when(p["v"].isNotNull() & p["c"].isNotNull() & p["said"].isNotNull(), found)

    nothing = F.struct(F.lit("null").alias("kind"), none.alias("said"), F.lit(None).cast("array<string>").alias("items"), F.lit(None).cast("boolean").alias("truth"))
    missed = F.concat(F.lit("key '"), key, F.lit("' not found in pass-2 output"))
    lost = _packed(key=key, value_json=none, value=nothing, cited=empty, cited_kind=F.lit("text"), comment=F.lit(""), confidence=none, parse_error=missed)
    simple_name = F.regexp_like(key, F.lit(r"^[ -&(-\[\]-~\p{L}]*$"))
    parts = F.struct(_plain_value(x).alias("v"), _plain_cited(x).alias("c"), _plain_comment(x).alias("said"), _plain_confidence(x).alias("sure"))
    return F.when(x.isNull(), F.when(simple_name, lost)).otherwise(let(parts, of))


def plain_results(text: Column, keys: Column) -> Column:
    """results() of a well-formed reply as variant expressions, without Python; null where it takes Python."""
    is_odd = lambda t: F.regexp_like(t, F.lit(rf"{_LINE_ENDS}|\\u[dD][89a-fA-F]"))

    def of_named(named: Column) -> Column:
        mine = lambda k: F.try_element_at(F.filter(named, lambda x: x["key"] == k), F.lit(-1))["x"]
        found = F.transform(F.coalesce(keys, F.array().cast("array<string>")), lambda k: F.when(k != "", let(mine(k), lambda x: _plain_result(k, x))))
        return let(found, lambda r: F.when(F.forall(r, lambda one: one.isNotNull()), r))

    def of_items(items: Column) -> Column:
        named = F.transform(items, lambda x: F.struct(F.when(_kind(_field(x, "key")) == "STRING", _field(x, "key", "string")).alias("key"), x.alias("x")))
        return F.when(items.isNotNull(), let(named, of_named))

    return let(F.coalesce(text, F.lit("")), lambda t: F.when(~is_odd(t), let(_body(t), lambda body: let(_plain_items(body), of_items))))


def with_results(rows: DataFrame, text: Column | str, keys: Column | str, into: str = "results") -> DataFrame:
    """rows with an array of RESULT, one for each key, by results(), which takes about half the time of plain_results."""
    text, keys = (F.col(c) if isinstance(c, str) else c for c in (text, keys))
    return rows.withColumn(into, _results(text, keys))


@F.pandas_udf(T.StringType())
def json_over(old: pd.Series, new: pd.Series) -> pd.Series:
    """An object's JSON with the keys of another laid over it; an old text that isn't an object counts as empty."""

    def one(a: str | None, b: str) -> str:
        try:
            base = json.loads(a or "{}")
        except ValueError:
            base = {}
        return json.dumps((base if isinstance(base, dict) else {}) | json.loads(b), ensure_ascii=False)

    return pd.Series([one(a, b) for a, b in zip(old, new, strict=True)])


def failed_keys(results_: object) -> object:
    """Column of the keys without a result of an array of RESULT; empty: the group is good."""
    return F.filter(results_, lambda r: r["parse_error"].isNotNull())


def extraction_error(results_: object) -> object:
    """Column: what is said of a group with missing keys; null if none is. One missing key spoils its whole group."""
    bad = failed_keys(results_)
    said = F.array_join(F.transform(bad, lambda r: F.concat(F.lit("'"), r["key"], F.lit("': "), r["parse_error"])), ", ")
    return F.when(F.size(bad) > 0, F.concat(F.lit(EXTRACTION_FAILED), F.size(bad).cast("string"), F.lit(" key(s): "), said))


#: The schema that a reply is asked for: the five fields of a result, all required.
REPLY_SCHEMA = {
    "type": "object",
    "properties": {
        "results": {
            "type": "array",
            "items": {
                "type": "object", "required": ["key", "value", "cited_text", "comment", "confidence"], "additionalProperties": False,
                "properties": {
                    "key": {"type": "string"}, "value": {}, "cited_text": {"anyOf": [{"type": "string"}, {"type": "array", "items": {"type": "string"}}]},
                    "comment": {"type": "string"}, "confidence": {"type": ["integer", "null"]},
                },
            },
        }
    },
    "required": ["results"],
}
