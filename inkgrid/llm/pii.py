"""Personal data: pattern spans, and terms that give protected entities away.

Base spans are e-mail addresses, IP addresses, card numbers and telephone numbers. The entities to protect are
the strings found, each kind as such (that a text holds an address or a card number), and any of them at all. Over the whole corpus, a term t
discloses an entity e by  PMI(t; e) / IC(e) = log(N n_te / (n_t n_e)) / log(N / n_e),  which is 1 if t occurs only with e
and 0 if they are independent (n: documents with t, with e, with both, anywhere in them; N: all documents; rows are
documents). Terms are words and, as strings of letters and digits mixed (keys, hashes, serial numbers) hardly ever
come twice, the shapes of those from SHAPED characters on: hexadecimal or not, and how long.

Terms at DISCLOSES or more, seen with a string in SUPPORT documents at least (with a kind: KIND_SUPPORT, as a kind is so
frequent that rare words meet it by chance) and in SUPPORT independent surroundings of e (NEAR characters beside its first place
in a text), are spans too, wherever they stand in any document: surroundings that share
COPIED of their words or more are copies, exact or near, of one passage, in which any rare word goes with any other, and
count once. Further surroundings only add to a term's evidence. Terms are of kind term: base kinds are generalised to
their kind's name, terms are removed.

Positions are code points, ends exclusive. Nulls: a null text is empty and has no spans (sanitise leaves it null), a null
doc_id stays null; rows with one text share their spans, each row counting as a document. Ties don't matter: every term above
the threshold is taken. Empty tables give empty results. detect() reads no other columns, sanitise() returns them all; columns it
works with start with two underscores. Patterns can't backtrack over repetitions, so long runs cost no more, and a very long
text costs by its length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .common import let

KINDS = ("email", "ip", "card", "phone")
KIND = "kind:"
#: The contract's patterns. A match starts where the last ended or where a run starts; later starts in a run would fail as its first did.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without a match of these has none of the kind.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
TOKEN = r"[\p{L}\p{N}]{3,}+"
#: A token of letters and digits of so many characters or more is known by its shape.
SHAPED = 8
#: Surroundings: so many characters on either side of an entity.
NEAR = 80
SUPPORT, KIND_SUPPORT = 3, 20
DISCLOSES = 0.8
#: Surroundings whose words have this Jaccard similarity are copies. They are looked for by BANDS pairs of smallest hashes.
COPIED = 0.5
BANDS = 10
BLOCK = 64
#: So many terms at most are sent to all executors; more are joined by an exchange.
SENT_TERMS = 200_000
#: So many disclosing terms at most are looked for as a list in each row; more are joined.
LISTED_TERMS = 1000


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def value(i: Column) -> Column:  # i: from the right, from 0
        d = F.ascii(F.substr(digits, F.length(digits) - i, F.lit(1))) - 48
        return F.when(i % 2 == 0, d).otherwise(F.when(d > 4, d * 2 - 9).otherwise(d * 2))

    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda s, i: s + value(i))
    return total % 10 == 0


def _holds(kind: str, m: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    if kind == "ip":
        return m.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        return let(_digits(m), lambda d: F.when(F.length(d).between(16, 19), _luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(_digits(m)).between(8, 15)
    return F.lit(True)


def placed(text: Column, pattern: str) -> Column:
    """Matches of a pattern in order: start, end, said (the match).

    split() and regexp_extract_all() walk the same matches, so the lengths of gaps and matches add up to places.
    """

    def build(x: Column) -> Column:
        gaps, said, sizes, blocks = x["gaps"], x["said"], x["sizes"], x["blocks"]
        total = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda s, v: s + v)

        def one(m: Column, i: Column) -> Column:
            b = F.floor(i / BLOCK).cast("int")
            before = total(F.slice(blocks, F.lit(1), b)) + total(F.slice(sizes, b * BLOCK + 1, i % BLOCK))
            start = before + F.length(F.get(gaps, i))
            return F.struct(start.alias("start"), (start + F.length(m)).alias("end"), m.alias("said"))

        return F.transform(said, one)

    def blocked(x: Column) -> Column:
        sums = lambda b: F.aggregate(F.slice(x["sizes"], b * BLOCK + 1, F.lit(BLOCK)), F.lit(0).cast("long"), lambda s, v: s + v)
        whole_blocks = F.floor((F.size(x["sizes"]) - 1) / BLOCK).cast("int")
        return F.struct(x["gaps"].alias("gaps"), x["said"].alias("said"), x["sizes"].alias("sizes"), F.transform(F.sequence(F.lit(0), whole_blocks), sums).alias("blocks"))

    def sized(x: Column) -> Column:
        sizes = F.zip_with(F.slice(x["gaps"], F.lit(1), F.size(x["said"])), x["said"], lambda g, m: (F.length(g) + F.length(m)).cast("long"))
        return F.struct(x["gaps"].alias("gaps"), x["said"].alias("said"), sizes.alias("sizes"))

    cut = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("said"))
    return let(cut, lambda x: F.when(F.size(x["said"]) > 0, let(let(sized(x), blocked), build)))


_SPAN = "array<struct<start:bigint,end:bigint,said:string>>"


def base_spans(text: Column, kind: str) -> Column:
    """The spans of one base kind in a text that isn't null."""
    some = F.when(text.rlike(NEEDS[kind]), F.filter(placed(text, PATTERNS[kind]), lambda s: _holds(kind, s["said"])))
    return F.coalesce(some.cast(_SPAN), F.array().cast(_SPAN))


def found(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """__id, __key (of the text) and one column of spans for each base kind; without texts, cut."""
    text = common.whole(F.col(text_col).cast("string"))
    rows = docs.select(F.col(id_col).alias("__id"), _key(text_col).alias("__key"), *(base_spans(text, k).alias(k) for k in KINDS))
    return common.cut(rows)


def _key(text_col: str) -> Column:
    text = common.whole(F.col(text_col).cast("string"))
    return F.xxhash64(text, F.length(text))


def _masked(text: Column) -> Column:
    """A text with blanks for its e-mail addresses, the one kind with letters: what stands inside an entity is no term beside it."""
    cut = F.struct(F.split(text, PATTERNS["email"], -1).alias("gaps"), F.regexp_extract_all(text, F.lit(PATTERNS["email"]), F.lit(0)).alias("said"))
    blank = lambda g, m: F.concat(g, F.repeat(F.lit(" "), F.coalesce(F.length(m), F.lit(0))))
    return F.when(text.rlike(NEEDS["email"]), let(cut, lambda x: F.array_join(F.zip_with(x["gaps"], x["said"], blank), ""))).otherwise(text)


def _term(token: Column) -> Column:
    """The term of a token: its shape or itself in lower case; null for a number."""
    shape = F.concat(F.when(token.rlike("^[0-9A-Fa-f]++$"), F.lit("#hex ")).otherwise("#mixed "), F.length(token).cast("string"))
    mixed = (F.length(token) >= SHAPED) & token.rlike("[0-9]")
    return F.when(mixed, F.when(token.rlike(r"\p{L}"), shape)).when(token.rlike(r"\p{L}"), F.lower(token))


def _terms(text: Column) -> Column:
    return F.filter(F.transform(F.regexp_extract_all(_masked(text), F.lit(TOKEN), F.lit(0)), _term), lambda t: t.isNotNull())


def _entity(kind: str) -> Callable[[Column], Column]:
    return lambda s: F.concat(F.lit(f"{kind}:"), F.lower(s["said"]))


def _with_entity(kind: str) -> Callable[[Column], Column]:
    return lambda s: F.struct(_entity(kind)(s).alias("entity"), s["start"].alias("start"), s["end"].alias("end"))


def _with_kind(kind: str) -> Callable[[Column], Column]:
    return lambda s: F.struct(F.lit(f"{KIND}{kind}").alias("entity"), s["start"].alias("start"), s["end"].alias("end"))


def entities(spans: DataFrame) -> DataFrame:
    """A row for each text and entity (strings, and kinds and "any" after KIND): __key, entity, rows (documents with this text), start and end of the entity's first place."""
    each = F.concat(*(F.transform(F.col(k), _with_entity(k)) for k in KINDS), *(F.transform(F.slice(k, 1, 1), _with_kind(k)) for k in KINDS), F.transform(F.slice(F.concat(*KINDS), 1, 1), _with_kind("any")))
    texts = spans.where(F.size(each) > 0).groupBy("__key").agg(F.count("*").alias("rows"), F.first(each).alias("each"))
    return texts.select("__key", "rows", F.explode("each").alias("s")).groupBy("__key", "rows", "s.entity").agg(F.min("s.start").alias("start"), F.min("s.end").alias("end"))


def copy_groups(sets: DataFrame) -> DataFrame:
    """sets: owner, around, terms (an array), one row an owner and around. owner, around, copy_of: the smallest around found that it copies, or its own.

    Candidates share a pair of smallest hashes (found at a similarity of 0.5 with 0.94, of 0.7 with 0.999); the similarity itself is exact.
    """

    def least(seed: int) -> Column:
        return F.array_min(F.transform("terms", lambda t: F.xxhash64(t, F.lit(seed))))

    bands = F.array(*(F.xxhash64(F.lit(j), least(2 * j), least(2 * j + 1)) for j in range(BANDS)))
    sets = common.cut(sets)
    each = sets.select("owner", "around", F.explode(bands).alias("band"))
    first = each.groupBy("owner", "band").agg(F.min("around").alias("first"))
    links = each.join(first, ["owner", "band"]).where("first < around").select("owner", "around", "first").distinct()
    to = sets.select("owner", F.col("around").alias("first"), F.col("terms").alias("theirs"))
    shared = F.size(F.array_intersect("terms", "theirs"))
    alike = shared >= F.lit(COPIED) * (F.size("terms") + F.size("theirs") - shared)
    found = links.join(sets, ["owner", "around"]).join(to, ["owner", "first"]).where(alike).groupBy("owner", "around").agg(F.min("first").alias("first"))
    return sets.join(found, ["owner", "around"], "left").select("owner", "around", F.coalesce("first", "around").alias("copy_of"))


def _some(terms: DataFrame) -> DataFrame:
    return F.broadcast(terms) if terms.count() <= SENT_TERMS else terms


def disclosing(docs: DataFrame, spans: DataFrame, text_col: str = "text", *, support: int = SUPPORT, kind_support: int = KIND_SUPPORT, discloses: float = DISCLOSES) -> DataFrame:
    """entity, term, disclosure of the terms that give an entity away."""
    n = float(spans.count())
    every = entities(spans)
    enough = F.when(F.col("entity").startswith(KIND), F.lit(kind_support)).otherwise(F.lit(support))
    with_entity = every.groupBy("entity").agg(F.sum("rows").alias("n_e")).where(F.col("n_e") >= enough)
    held = common.cut(every.join(_some(common.cut(with_entity)), "entity"))
    none = held.select("entity", F.lit("").alias("term"), F.lit(0.0).alias("disclosure")).where("false")
    if not held.head(1):
        return none
    # told >= discloses means n_t <= n_te (N / n_e) ^ (1 - discloses). Terms that share enough documents with an entity come
    # first; only these are counted over the corpus.
    text = common.whole(F.col(text_col).cast("string"))
    texts = docs.select(_key(text_col).alias("__key"), text.alias("text")).join(_some(common.cut(held.select("__key").distinct())), "__key", "left_semi")
    texts = common.cut(texts.groupBy("__key").agg(F.first("text").alias("text")))
    held = common.cut(held.join(_surroundings(texts, held), ["entity", "__key"]))
    here = texts.select("__key", F.explode(F.array_distinct(_terms(F.col("text")))).alias("term"))
    both = here.join(held.select("__key", "entity", "rows", "n_e", "copy_of"), "__key").groupBy("entity", "term", "n_e").agg(F.sum("rows").alias("n_te"), F.count_distinct("copy_of").alias("n_around"))
    at_most = F.col("n_te") * F.pow(F.lit(n) / F.col("n_e"), F.lit(1.0 - discloses)) + 1e-6
    able = common.cut(both.where((F.col("n_te") >= enough) & (F.col("n_around") >= support)).withColumn("at_most", at_most))
    wanted = common.cut(able.groupBy("term").agg(F.max("at_most").alias("most")))
    words = docs.select(F.explode(F.array_distinct(_terms(text))).alias("term"))
    few = wanted.count() <= SENT_TERMS  # then other terms end at the scan; else all terms are counted before any exchange
    counted = (words.join(F.broadcast(wanted.select("term")), "term", "left_semi") if few else words).groupBy("term").agg(F.count("*").alias("n_t"))
    known = counted.join(wanted, "term").where("n_t <= most").select("term", "n_t")
    told = F.lit(1.0) + F.log(F.least(F.lit(1.0), F.col("n_te") / F.col("n_t"))) / F.greatest(F.log(F.lit(n) / F.col("n_e")), F.lit(1e-9))
    shown = able.join(_some(common.cut(known)), "term").where("n_t <= at_most").select("entity", "term", told.alias("disclosure")).where(F.col("disclosure") >= discloses)
    return common.cut(shown)


def _surroundings(texts: DataFrame, held: DataFrame) -> DataFrame:
    """entity, __key, copy_of: which surroundings of the entity those in this text copy."""
    left = F.substring(F.substr("text", F.lit(1), F.col("start").cast("int")), -NEAR, NEAR)
    right = F.substr("text", (F.col("end") + 1).cast("int"), F.lit(NEAR))
    words = F.transform(F.regexp_extract_all(F.concat_ws(" ", left, right), F.lit(TOKEN), F.lit(0)), lambda w: F.lower(w))
    # An entity that stands alone has surroundings of its own in every text.
    words = F.when(F.size(words) > 0, F.array_distinct(words)).otherwise(F.array(F.col("__key").cast("string")))
    sets = held.select("__key", "entity", "start", "end").join(texts, "__key").select(F.col("entity").alias("owner"), F.col("__key").alias("around"), words.alias("terms"))
    return copy_groups(sets).select(F.col("owner").alias("entity"), F.col("around").alias("__key"), "copy_of")


def _told_here(docs: DataFrame, told: DataFrame, text_col: str) -> DataFrame | None:
    """__key and told, the disclosing terms that stand in a text, of the texts that have some; None if no term discloses anything."""
    terms = common.cut(told.select("term").distinct())
    n = terms.count()
    if not n:
        return None
    text = common.whole(F.col(text_col).cast("string"))
    if n <= LISTED_TERMS:  # looked for within each row
        listed = F.array(*(F.lit(r["term"]) for r in terms.orderBy("term").collect()))
        rows = docs.select(_key(text_col).alias("__key"), F.array_intersect(_terms(text), listed).alias("told")).where(F.size("told") > 0)
        return common.cut(rows.dropDuplicates(["__key"]))
    rows = docs.select(_key(text_col).alias("__key"), F.explode(F.array_distinct(_terms(text))).alias("term")).join(_some(terms), "term", "left_semi")
    return common.cut(rows.groupBy("__key").agg(F.collect_set("term").alias("told")))


_PLACES = "array<struct<start:bigint,end:bigint>>"


def _with_places(rows: DataFrame, told: DataFrame | None, text: Column) -> DataFrame:
    """rows (with __key) with __terms: all places of disclosing terms in the text."""
    none = F.array().cast(_PLACES)
    if told is None:
        return rows.withColumn("__terms", none)
    rows = rows.join(_some(told.withColumnsRenamed({"__key": "__k", "told": "__told"})), F.col("__key") == F.col("__k"), "left")
    mine = F.filter(placed(_masked(text), TOKEN), lambda s: F.array_contains(F.col("__told"), _term(s["said"])))
    places = F.when(F.col("__told").isNotNull(), F.transform(mine, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    return rows.withColumn("__terms", F.coalesce(places.cast(_PLACES), none)).drop("__k", "__told")


def _said(kind: str, spans: str) -> Column:
    return F.transform(F.col(spans), lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each of docs: doc_id, the base kinds' spans, terms."""
    spans = found(docs, id_col, text_col)
    told = _told_here(docs, disclosing(docs, spans, text_col), text_col)
    if told is None:
        return spans.withColumn("terms", F.array().cast(_PLACES)).withColumnRenamed("__id", "doc_id")
    text = common.whole(F.col(text_col).cast("string"))
    rows = docs.select(_key(text_col).alias("__key"), text.alias("__text")).join(_some(told.select("__key")), "__key", "left_semi")
    places = _with_places(rows, told, F.col("__text")).groupBy("__key").agg(F.first("__terms").alias("terms"))
    rows = spans.join(_some(common.cut(places)), "__key", "left").withColumn("terms", F.coalesce("terms", F.array().cast(_PLACES)))
    return rows.withColumnRenamed("__id", "doc_id")


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with base spans of their texts replaced by [KIND] and disclosing terms removed."""
    told = _told_here(docs, disclosing(docs, found(docs, id_col, text_col), text_col), text_col)
    text = common.whole(F.col(text_col).cast("string"))
    rows = docs.withColumns({"__key": _key(text_col), **{f"__{k}": base_spans(text, k) for k in KINDS}})
    rows = _with_places(rows, told, text)
    mark = lambda spans, what: F.transform(F.col(spans), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(what).alias("what")))
    every = F.array_sort(F.concat(*(mark(f"__{k}", f"[{k.upper()}]") for k in KINDS), mark("__terms", "")))

    def taken_out(spans: Column) -> Column:
        """Left to right: what overlaps a span already replaced is dropped with it."""
        start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

        def step(done: Column, s: Column) -> Column:
            gap = F.when(s["start"] >= done["at"], F.concat(F.substr(text, (done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int")), s["what"])).otherwise(F.lit(""))
            return F.struct(F.greatest(done["at"], s["end"]).alias("at"), F.array_append(done["out"], gap).alias("out"))

        return let(F.aggregate(spans, start, step), lambda d: F.concat(F.array_join(d["out"], ""), F.substr(text, (d["at"] + 1).cast("int"), F.lit(2**31 - 1))))

    clean = let(every, lambda spans: F.when(F.size(spans) > 0, taken_out(spans)).otherwise(F.col(text_col)))
    return rows.withColumn(text_col, clean).select(*docs.columns)


def op4_pii(spans_of: SparkSession, sf_dir: str) -> DataFrame:
    rows = detect(common.read(spans_of, sf_dir, "documents"))
    base = F.concat(*(_said(k, k) for k in KINDS))
    return rows.select(
        "doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"), F.array_join(F.concat(base, _said("term", "terms")), ",").alias("spans"),
    )


QUERIES = {"op4_pii": op4_pii}
ORACLES: dict[str, str] = {}
