"""Queries of values, replies and evidence, each with its SQL counterpart where SQL can express it.

Cases are dealt to the rows of events by event_id: tokens and replies by a table of cases, whose results SQL holds as
literals, and numbers from the row itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import evidence, replies
from ..operators import complete, grid, payload, prompts, quotes, reports, sinks
from ..sources import documents as S
from . import catalog
from .registry import query

#: Each: token; value, status and detail as boolean; as one of OPTIONS; as several of them; text. U: undecided.
U = C.UNDECIDED
OPTIONS = ("rct", "obs", "True")
CASES = [
    ("true", ("true", "ok", ""), ("True", "ok", ""), ("True", "ok", ""), "True"),
    ('"Yes"', ("true", "ok", ""), (None, "invalid", "Yes"), ("", "invalid", "Yes"), "Yes"),
    ("null", (None, "ok", U), (None, "ok", U), ("", "ok", U), None),
    ('"maybe"', (None, "invalid", "maybe"), (None, "invalid", "maybe"), ("", "invalid", "maybe"), "maybe"),
    ("0", ("false", "ok", ""), (None, "invalid", "0"), ("", "invalid", "0"), "0"),
    ("1e3", ("true", "ok", ""), (None, "invalid", "1000.0"), ("", "invalid", "1000.0"), "1000.0"),
    ('[true, "rct"]', ("true", "ok", ""), (None, "invalid", "[True, 'rct']"), ("True,rct", "ok", ""), "[True, 'rct']"),
    ('[1, "rct"]', ("true", "ok", ""), (None, "invalid", "[1, 'rct']"), ("rct", "invalid", "[1, 'rct']"), "[1, 'rct']"),
    ('["a\'b", "rct", "rct"]', ("true", "ok", ""), (None, "invalid", "[\"a'b\", 'rct', 'rct']"), ("rct,rct", "invalid", "[\"a'b\", 'rct', 'rct']"), "[\"a'b\", 'rct', 'rct']"),
    ("[]", ("false", "ok", ""), (None, "invalid", "[]"), ("", "ok", ""), "[]"),
    ('{"a": 1.0}', ("true", "ok", ""), (None, "invalid", "{'a': 1.0}"), ("", "invalid", "{'a': 1.0}"), "{'a': 1.0}"),
    ('"rct"', (None, "invalid", "rct"), ("rct", "ok", ""), ("rct", "ok", ""), "rct"),
    ('"NO"', ("false", "ok", ""), (None, "invalid", "NO"), ("", "invalid", "NO"), "NO"),
    ("1.50", ("true", "ok", ""), (None, "invalid", "1.5"), ("", "invalid", "1.5"), "1.5"),
]


def _sql(x: str | None) -> str:
    return "null" if x is None else "'" + x.replace("'", "''") + "'"


def _dealt(rows: list[tuple], names: str) -> str:
    """A SQL table of cases by number."""
    return "(values " + ", ".join(f"({i}, " + ", ".join(map(_sql, r)) + ")" for i, r in enumerate(rows)) + f") c(m, {names})"


def _case(spark: SparkSession, sf_dir: str, texts: list[str]) -> DataFrame:
    """events with the text of their case, in which K is a number of the row's own."""
    k = F.get_json_object("props", "$.k")
    chosen = F.get(F.array(*map(F.lit, texts)), (F.col("event_id") % len(texts)).cast("int"))
    return S.table(spark, sf_dir, "events").select("event_id", F.replace(chosen, F.lit("K"), k).alias("text"))


def _mapped(spark: SparkSession, sf_dir: str, how, value: str) -> DataFrame:
    rows = _case(spark, sf_dir, [c[0] for c in CASES]).withColumn("m", how(replies.value_column("text"))).select("event_id", "m.*")
    shown = F.array_join(value, ",") if value.endswith("multi") else F.col(value).cast("string")
    return rows.select("event_id", shown.alias("value"), F.col("extraction_status").alias("status"), F.col("extraction_detail").alias("detail"))


def _mapped_sql(which: int) -> str:
    rows = [c[which] for c in CASES] if which < 4 else [(c[4], "ok", "") for c in CASES]
    return f"select event_id, c.value, c.status, c.detail from events join {_dealt(rows, 'value, status, detail')} on event_id % {len(CASES)} = m"


@query(_mapped_sql(1))
def map_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mapped(spark, sf_dir, C.map_boolean, "value_boolean")


@query(_mapped_sql(2))
def map_categorical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mapped(spark, sf_dir, lambda v: C.map_categorical(v, F.array(*map(F.lit, OPTIONS))), "value_categorical")


@query(_mapped_sql(3))
def map_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mapped(spark, sf_dir, lambda v: C.map_multi(v, F.array(*map(F.lit, OPTIONS))), "value_categorical_multi")


@query(_mapped_sql(4))
def map_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mapped(spark, sf_dir, C.map_text, "value_text")


_K = "json_extract_string(props, '$.k')"
_MISSED = _sql(replies.MISSING.format(key="a"))


def _read(spark: SparkSession, sf_dir: str, texts: list[str]) -> DataFrame:
    rows = replies.with_results(_case(spark, sf_dir, texts), F.col("text"), F.array(F.lit("a")))
    return rows.withColumn("r", F.get("results", 0)).select("event_id", "r.*")


REPAIRS = [
    '{"key": "a", "value": K, "comment": "it', '{"key":"a","value":"yes", "comment": "it', "{'key': 'a', 'value': K", '{"key": "a", "comment": "no value',
    '{"key": "a", "value": [K', '{"key": "a", "value": true,}', '{"value": K, "comment": "x', 'thoughts\n{"key":"a","value":K}\n{"key":"a","value":"last"}',
]


@query(f"select event_id, case event_id % 8 when 0 then {_K} when 3 then 'null' when 5 then 'true' when 7 then '\"last\"' end as value_json, case when event_id % 8 in (1, 2, 4, 6) then {_MISSED} end as parse_error from events")
def repair_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged lines: read only where the value is the literal that stands in the line."""
    return _read(spark, sf_dir, REPAIRS).select("event_id", "value_json", "parse_error")


#: Replies that hold what no answer may: each with the token read for the key a, null where its group is spoiled, and its confidence.
ODD = [
    ('{"key":["a"],"value":K}', None, None), ('[{"key":{"x":1},"value":1},{"key":"a","value":2}]', "2", None), ('{"key":null,"value":1}', None, None), ('[7,null,"x",[],{"key":"a","value":true}]', "true", None),
    ('{"key":"a","value":1,"confidence":NaN}', "1", None), ('{"key":"a","value":1,"confidence":Infinity}', "1", None), ('{"key":"a","value":1,"confidence":3000000000}', "1", None), ('{"key":"a","value":1,"confidence":-2.9}', "1", "-2"),
    ("[" * 1200, None, None), ('{"key":"a","value":' + "[" * 1200 + "]" * 1200 + "}", "[" * 1200 + "]" * 1200, None), ('{"key":"a","value":"\\ud800"}', None, None), ('{"key":"a","value":"\\ud83d\\ude00"}', '"😀"', None), ('{"key":"a","value":1,"value":3}', "3", None),
]


@query(f"select event_id, case when event_id % {len(ODD)} <> 9 then c.value else repeat('[', 1200) || repeat(']', 1200) end as value_json, c.sure as confidence, c.value is null as spoiled from events join {_dealt([(v if i != 9 else 'long', c) for i, (_, v, c) in enumerate(ODD)], 'value, sure')} on event_id % {len(ODD)} = m")
def odd_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that are lists, constants that JSON lacks, nesting without end, halves of characters: a spoiled group at most, never a failed job."""
    return _read(spark, sf_dir, [r for r, _, _ in ODD]).select("event_id", "value_json", F.col("confidence").cast("string").alias("confidence"), F.col("parse_error").isNotNull().alias("spoiled"))


FENCED = ['```json\n[{"key":"a","value":K}]\n```', '```json\n[\n```\n{"key":"a","value":K}\n```', '```json\n{"key":"a","value":K}', '```json\n[{"key":"a","value":K}]\n``` done']


@query(f"select event_id, case when event_id % 4 <> 3 then {_K} end as value_json, case when event_id % 4 = 3 then {_MISSED} end as parse_error from events")
def code_fence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, FENCED).select("event_id", "value_json", "parse_error")


QUOTED = ["null", '""', '"[NO DIRECT QUOTE]"', '[" [NO DIRECT QUOTE]"]', '"not found"', '["one", "two"]', '["[NO DIRECT QUOTE]", "two"]', "[]", '"a quote"']
_QUOTED = [("text", ""), ("text", ""), ("none", ""), ("none", ""), ("text", "not found"), ("list", "one\n\ntwo"), ("list", "[NO DIRECT QUOTE]\n\ntwo"), ("list", ""), ("text", "a quote")]


@query(f"select event_id, kind, cited_text from events join {_dealt(_QUOTED, 'kind, cited_text')} on event_id % {len(QUOTED)} = m")
def cited_text_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a reply gives as its quotes: a text, a list, nothing, or the marker of no quote."""
    rows = _read(spark, sf_dir, [f'{{"results":[{{"key":"a","value":1,"cited_text":{q}}}]}}' for q in QUOTED])
    return rows.select("event_id", F.col("cited_kind").alias("kind"), C.joined_quotes(F.col("cited")).alias("cited_text"))


@query("select event_id, case event_id % 3 when 0 then cast(2 as bigint) when 1 then 1 else 0 end as n_failed, case event_id % 3 when 0 then 'Pass-2 extraction failed for 2 key(s): ''a'': key ''a'' not found in pass-2 output, ''b'': key ''b'' not found in pass-2 output' when 1 then 'Pass-2 extraction failed for 1 key(s): ''b'': key ''b'' not found in pass-2 output' end as detail from events")
def failed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing keys spoil their group, and say so."""
    one, two = '{"key":"a","value":K}', '{"key":"b","value":K}'
    rows = replies.with_results(_case(spark, sf_dir, ["nothing", one, f"{one}\n{two}"]), F.col("text"), F.array(F.lit("a"), F.lit("b")), "r")
    return rows.select("event_id", F.size(replies.failed_keys(F.col("r"))).cast("bigint").alias("n_failed"), replies.extraction_error(F.col("r")).alias("detail"))


@query("select event_id, case when event_id % 2 = 0 then ['b'] end as failed_keys, 'g' || event_id as cid from events where event_id % 2 = 0")
def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies that lack a key, put aside with it."""
    rows = _case(spark, sf_dir, ['{"key":"a","value":K}', '{"key":"a","value":K}\n{"key":"b","value":K}'])
    done = rows.select("event_id", F.concat(F.lit("g"), F.col("event_id").cast("string")).alias("cid"), F.array(F.lit("a"), F.lit("b")).alias("keys"), F.lit("thoughts").alias("pass1_text"), F.struct(F.col("text"), F.lit(None).cast("string").alias("error")).alias("completion"))
    return sinks.quarantine(done).select("cid", "failed_keys", F.substr("cid", F.lit(2)).cast("bigint").alias("event_id"))


# -- evidence


@query("select doc_id, md5(lower(trim(regexp_replace(nfc_normalize(text), '[\\s\\x{00A0}]+', ' ', 'g')))) as digest from documents")
def normalised_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.table(spark, sf_dir, "documents").select("doc_id", F.md5(evidence.normalised_column("text")).alias("digest"))


@query("""with t as (select a.n_nationkey as a, b.n_nationkey as b, lower(a.n_name || ' and ' || b.n_name) as text, lower(case when (a.n_nationkey + b.n_nationkey) % 2 = 0 then substring(b.n_name, 1, 2) || 'x' || substring(b.n_name, 3) else substring(c.n_name, 2) end) as p from nation a, nation b, nation c where c.n_nationkey = (a.n_nationkey * 7 + b.n_nationkey) % 25)
select a, b, exists (select 1 from range(1, 64) i(i), range(0, 64) l(l) where i <= length(text) and l <= length(text) - i + 1 and abs(l - length(p)) <= greatest(1, length(p) // 5) and levenshtein(substring(text, i, l), p) <= greatest(1, length(p) // 5)) as found from t""")
def fuzzy_find(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with a character too many, or without their first, in pairs of names."""
    n = S.table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    a, b, c = (n.select(F.col("n_nationkey").alias(k), F.col("n_name").alias(f"n_{k}")) for k in "abc")
    rows = a.crossJoin(b).join(c, F.col("c") == (F.col("a") * 7 + F.col("b")) % 25)
    inserted = F.concat(F.substring("n_b", 1, 2), F.lit("x"), F.substr("n_b", F.lit(3)))
    pattern = F.lower(F.when((F.col("a") + F.col("b")) % 2 == 0, inserted).otherwise(F.substr("n_c", F.lit(2))))
    return rows.select("a", "b", evidence.occurs_column(0.2)(pattern, F.lower(F.concat("n_a", F.lit(" and "), "n_b"))).alias("found"))


@query("select b.item_id, d.doc_id from benchmark b, documents d where contains(d.text, b.text)")
def citation_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of the benchmark in texts, as they are."""
    return quotes.occurrences(S.table(spark, sf_dir, "documents"), S.table(spark, sf_dir, "benchmark"), rate=None).select("item_id", "doc_id")


@query()
def citation_fuzzy_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of the benchmark, and its words but every thirtieth, in every text that holds it within a twentieth of edits, with its place."""
    items = S.table(spark, sf_dir, "benchmark")
    words = F.filter(F.split("text", " "), lambda w, i: i % 30 != 14)
    fewer = items.select((-F.col("item_id") - 1).alias("item_id"), F.array_join(words, " ").alias("text"))
    return quotes.occurrences(S.table(spark, sf_dir, "documents"), items.select("item_id", "text").union(fewer))


def _quoted(spark: SparkSession, sf_dir: str, make, kind: str = "list") -> DataFrame:
    """A row a document: quotes that make(text, other) forms of the text and a passage of the benchmark, checked in the whole text."""
    items = S.table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("other"))
    n = items.agg(F.max("item_id")).first()[0] + 1
    docs = S.table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), (F.col("doc_id") % n).alias("item_id")).join(grid.small(items), "item_id", "left")
    rows = docs.withColumn("quotes", make(F.col("text"), F.coalesce("other", F.lit(""))))
    checked = evidence.verify_columns()(F.array("quotes"), F.array(F.lit(kind)), F.col("text"))
    return rows.withColumn("v", F.get(checked, 0)).select("doc_id", "quotes", F.col("v.ok").alias("ok"), F.col("v.note").alias("note"), F.array_join(F.transform("v.each", lambda x: x.cast("string")), ",").alias("each"))


def _passage(t: Column, place: float, n: int) -> Column:
    """n characters of a text from a share of its length on."""
    return F.substr(t, (F.length(t) * place).cast("int") + 1, F.lit(n))


def _typo(t: Column) -> Column:
    return F.concat(F.substr(t, F.lit(1), F.lit(20)), F.lit("#"), F.substr(t, F.lit(22)))


def _digest(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "ok", "note", "each")


@query()
def citation_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A passage from anywhere in each text with one character replaced; in every third text, one of the benchmark instead, in every other third, one backwards."""

    def make(t: Column, other: Column) -> Column:
        own, m = _typo(_passage(t, 0.7, 80)), F.col("doc_id") % 3
        return F.array(F.when(m == 0, own).when(m == 1, other).otherwise(F.reverse(own)))

    return _digest(_quoted(spark, sf_dir, make, "text"))


#: Texts whose normalised form has a character for each of their own.
_ONE_TO_ONE = "[^\\x20-\\x7E\\nÀ-Þà-þ]|[ \\n]{2}|^[ \\n]|[ \\n]$"


@query(f"""with t as (select doc_id, replace(lower(text), chr(10), ' ') as told, substring(text, cast(floor(length(text) * 0.3) as bigint) + 1, 60) as q from documents where not regexp_matches(text, '{_ONE_TO_ONE}') and length(text) > 200),
u as (select doc_id, strpos(told, replace(lower(q), chr(10), ' ')) - 1 as start, length(q) as n from t where not regexp_matches(q, '^[ \\n]|[ \\n]$'))
select doc_id, start, start + n as "end", 0 as distance from u""")
def citation_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where in its text a passage stands whose case was changed: for texts where SQL can say so too."""
    t = F.col("text")
    rows = S.table(spark, sf_dir, "documents").withColumn("q", F.substr(t, F.floor(F.length(t) * 0.3).cast("int") + 1, F.lit(60)))
    rows = rows.where(~F.regexp_like(t, F.lit(_ONE_TO_ONE)) & (F.length(t) > 200) & ~F.regexp_like("q", F.lit(r"^[ \n]|[ \n]$")))
    place = F.get(quotes.place_columns()(F.array(F.upper("q")), t), 0)
    return rows.select("doc_id", place["start"].cast("bigint").alias("start"), place["end"].cast("bigint").alias("end"), place["distance"].alias("distance"))


@query()
def citation_ellipsis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two passages around an ellipsis: near each other and in order, in quotation marks, in the wrong order, or too far apart."""

    def make(t: Column, other: Column) -> Column:
        a, b, far, m = _passage(t, 0.4, 40), F.substr(t, (F.length(t) * 0.4).cast("int") + 121, F.lit(40)), _passage(t, 0.95, 40), F.col("doc_id") % 4
        mark = lambda x: F.concat(F.lit("“"), x, F.lit("”"))
        return F.array(F.when(m == 0, F.concat(a, F.lit(" ... "), b)).when(m == 1, F.concat(mark(a), F.lit(" … "), mark(b))).when(m == 2, F.concat(b, F.lit(" ... "), a)).otherwise(F.concat(a, F.lit(" ... "), far)))

    return _digest(_quoted(spark, sf_dir, make, "text"))


@query()
def citation_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several quotes: one as it stands, one with an error, one of the benchmark, one too short."""
    return _digest(_quoted(spark, sf_dir, lambda t, other: F.array(_passage(t, 0.1, 60), _typo(_passage(t, 0.8, 60)), other, F.lit("short"))))


# -- requests, usage, display


@query("select event_id, case when event_id % 2 = 0 then k else k * 2 end as cached_read, case when event_id % 2 = 0 then k * 3 else 0 end as cached_write from (select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events)")
def cache_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    usage = F.when(F.col("event_id") % 2 == 0, F.format_string('{"cache_read_input_tokens":%s,"cache_creation_input_tokens":%s}', k, (k.cast("bigint") * 3).cast("string"))).otherwise(F.format_string('{"prompt_tokens_details":{"cached_tokens":%s}}', (k.cast("bigint") * 2).cast("string")))
    rows = S.table(spark, sf_dir, "events").withColumn("c", C.cache_tokens(F.when(F.col("event_id") % 2 == 0, "Anthropic").otherwise("openai"), usage))
    return rows.select("event_id", "c.*")


@query("select event_id, case when event_type <> 'error' then cast(cast((k * 3 * 1.5 + k * 7.5 + k * 0.25) as decimal(20, 4)) / 1000000 as decimal(18, 8)) end as cost from (select *, cast(json_extract_string(props, '$.k') as bigint) as k from events)")
def batch_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Costs of batch items by a table of prices; a model without a price has none."""
    prices = spark.createDataFrame([("p", t, 1.5, 7.5, 0.25) for t in ("view", "click", "signup", "purchase")], "provider string, model string, input double, output double, cached double")
    k = F.get_json_object("props", "$.k").cast("bigint")
    rows = S.table(spark, sf_dir, "events").select("event_id", F.lit("p").alias("provider"), F.col("event_type").alias("model"), (k * 3).alias("input_tokens"), k.alias("output_tokens"), k.alias("cached_tokens"))
    return complete.batch_cost(rows, prices).select("event_id", F.col("cost").cast("decimal(18,8)").alias("cost"))


@query("select event_id, case when value = 0 or value < 0.001 then printf('$%.6f', value) else printf('$%.4f', value) end as cost, case when k = 0 then 'n/a' else printf('%.1f%%', cast(100.0 * (event_id % 7) / k as double)) end as share, case when event_id % 5 = 0 then 'n/a' when ms >= 60000 then printf('%.1fm', ms / 60000.0) when ms >= 1000 then printf('%.1fs', ms / 1000.0) else printf('%.0fms', cast(ms as double)) end as latency from (select event_id, value, cast(json_extract_string(props, '$.k') as bigint) as k, event_id * 64 % 100000 as ms from events)")
def display_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, ms = F.get_json_object("props", "$.k").cast("bigint"), F.when(F.col("event_id") % 5 != 0, F.col("event_id") * 64 % 100_000)
    return S.table(spark, sf_dir, "events").select("event_id", C.shown_cost(F.col("value")).alias("cost"), C.shown_percent(F.col("event_id") % 7, k).alias("share"), C.shown_latency(ms).alias("latency"))


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as chat messages, one block a message."""
    turns = S.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    block = F.array(F.struct(F.col("text"), F.lit(None).cast("string").alias("cache_ttl")))
    return turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", block.alias("blocks")))).alias("m")).select("conv_id", F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["blocks"].alias("blocks"))).alias("m"))


@query("with t as (select conv_id, turn, role, coalesce(text, '') as text, row_number() over (partition by conv_id, role = 'system' order by turn) as n from conversations) select conv_id, max(case when role = 'system' and n = 1 then text end) as system, coalesce(md5(string_agg(role || ':' || text, chr(10) order by turn) filter (not (role = 'system' and n = 1))), md5('')) as rest from t group by conv_id")
def split_system(spark: SparkSession, sf_dir: str) -> DataFrame:
    system, rest = prompts.split_system(F.col("m"))
    line = F.transform(rest, lambda m: F.concat(m["role"], F.lit(":"), F.get(m["blocks"], 0)["text"]))
    return _turns(spark, sf_dir).select("conv_id", system.alias("system"), F.md5(F.array_join(line, "\n")).alias("rest"))


@query("select conv_id, 'c' || conv_id as custom_id, cast(256 as bigint) as max_tokens, 0.5 as temperature, cast(count(*) as bigint) as n_messages, md5(string_agg(role || ':' || coalesce(text, ''), chr(10) order by turn)) as messages from conversations group by conv_id")
def request_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a batch file, read back: settings of the run win over the pass's own."""
    line = prompts.request_body(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.col("m"), F.lit("model"), "openai", temperature=0.1, params={"max_tokens": 256, "temperature": 0.5, "stop": ["x"]}, response_format={"type": "json_object"})
    body = "struct<custom_id:string,body:struct<max_tokens:bigint,temperature:double,messages:array<struct<role:string,content:string>>>>"
    rows = _turns(spark, sf_dir).select("conv_id", F.from_json(line, body).alias("b"))
    said = F.transform("b.body.messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"]))
    return rows.select("conv_id", "b.custom_id", "b.body.max_tokens", "b.body.temperature", F.size("b.body.messages").cast("bigint").alias("n_messages"), F.md5(F.array_join(said, "\n")).alias("messages"))


@query("select event_id, case when event_type = 'error' then 'errored' else 'succeeded' end as type, case when event_type <> 'error' then 'said ' || event_id end as text, case when event_type <> 'error' then cast(json_extract_string(props, '$.k') as bigint) end as input_tokens, case when event_type = 'error' then 'errored: bad' end as error from events")
def message_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A provider's result lines, with blank and broken ones between them."""
    cid, k = F.col("event_id").cast("string"), F.get_json_object("props", "$.k")
    good = F.concat(F.lit('{"custom_id":"'), cid, F.lit('","result":{"type":"succeeded","message":{"content":[{"type":"text","text":"said "},{"type":"other"},{"type":"text","text":"'), cid, F.lit('"}],"usage":{"input_tokens":'), k, F.lit("}}}}"))
    bad = F.concat(F.lit('{"custom_id":"'), cid, F.lit('","result":{"type":"errored","error":{"type":"e","message":"bad"}}}'))
    lines = S.table(spark, sf_dir, "events").select(F.explode(F.array(F.when(F.col("event_type") == "error", bad).otherwise(good), F.lit(""), F.lit('{"custom_id": broken'))).alias("value"))
    return S.message_results(lines).select(F.col("cid").cast("bigint").alias("event_id"), "type", "text", "input_tokens", "error")


@query("select event_id, case event_type when 'view' then 'true' when 'click' then '[\"a\",\"b\"]' when 'signup' then '\"rct\"' when 'error' then null else '\"x \\\"' || k || '\\\"\"' end as value from (select *, json_extract_string(props, '$.k') as k from events)")
def wire_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed value of an answer as a token on the wire, by question type."""
    t, k = F.col("event_type"), F.get_json_object("props", "$.k")
    none = F.lit(None).cast("string")
    said = F.struct(F.when(t == "purchase", F.concat(F.lit('x "'), k, F.lit('"'))).alias("value_text"), F.when(t == "view", True).alias("value_boolean"), F.when(t == "signup", "rct").alias("value_categorical"), F.when(t == "click", F.array(F.lit("a"), F.lit("b"))).alias("value_categorical_multi"), none.alias("extraction_status"))
    kind = F.when(t == "view", "boolean").when(t.isin("click", "signup"), "categorical").otherwise("text")
    return S.table(spark, sf_dir, "events").select("event_id", payload.value_on_wire(kind, t == "click", said).alias("value"))


@query("select cast(count(*) as bigint) as n, cast(count(*) filter (event_id % 3 <> 0) as bigint) as n_quoted, cast(count(*) filter (event_id % 3 <> 0 and event_id % 2 = 0) as bigint) as n_verified, round(sum(value), 2) as cost from events")
def reference_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = S.table(spark, sf_dir, "events")
    rows = e.select(F.when(F.col("event_id") % 3 != 0, F.array("event_type")).otherwise(F.array(F.lit(""))).alias("cited"), (F.col("event_id") % 2 == 0).alias("verified"), F.col("value").alias("fmt_cost"))
    return reports.reference_stats(rows).select("n", "n_quoted", "n_verified", F.round("cost", 2).alias("cost"))


@query("select count(distinct user_id) as n_runs, count(distinct event_id % 100) as n_papers, count(distinct event_id % 3 + 14) as n_versions from events")
def extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.extent(catalog.answer_log(spark, sf_dir))
