"""Document fingerprints: a homomorphic multiset hash over paragraphs.

A text is cut into paragraphs (lines, ended early at the end of a sentence or after PIECE characters; their ends
belong to them, so they join to the text again; a cut depends on the PIECE characters since the last end alone, so an insertion in
a long line moves the cuts up to the line's next end). Each is hashed to WIDE numbers of 32 bits, and the
document's vector is the sum of its paragraphs', each lane modulo 2^32. Sums don't depend on order, and adding
or subtracting a paragraph's vector inserts or deletes it (plus, minus), so texts are equal up to the order of
paragraphs if and, but for collisions, only if the vectors are equal.

A narrow sketch beside it is made for likeness: LANES signed 16-bit numbers a paragraph, summed the same way. Lanes are zero in
the mean and independent, so the cosine of two sketches estimates that of the two multisets (error about 1/sqrt(LANES)).

Nulls: a null text is empty; an empty text has the zero vector, which is like itself (1) and nothing else (0); a null id is below
all others. Rows of one id are ordered by a hash of their texts; repeated rows are rows of their own, equal ones next to each other.
An empty table gives an empty result. Other columns are not read. A very long text takes time by its length and the memory of its paragraphs.
Everything is built of SQL functions on one row; only the next document's text needs an exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .common import let

#: Lanes of full width, and of the sketch.
WIDE, LANES = 16, 64
PIECE = 64
MASK = 0xFFFFFFFF
#: Rows of a range of doc_ids, at least, and ranges, at most.
RANGE_ROWS, MOST_RANGES = 1000, 4096


def paragraphs(text: str | Column) -> Column:
    return F.regexp_extract_all(common.whole(text), F.lit(rf"[^\n.!?]{{1,{PIECE}}}[\n.!?]*|[\n.!?]+"), F.lit(0))


def _lanes(digest: Column) -> Column:
    """WIDE numbers below 2^32, two from each of WIDE / 2 hashes of a digest, then LANES from -2^15 to 2^15 - 1, four from each of LANES / 4."""
    hashes = lambda first, n: F.transform(F.sequence(F.lit(first), F.lit(first + n - 1)), lambda i: F.xxhash64(digest, i))
    bits = lambda h, shift, mask: (F.shiftright(h, shift) if shift else h).bitwiseAND(F.lit(mask))
    halves = F.flatten(F.transform(hashes(1, WIDE // 2), lambda h: F.array(*(bits(h, s, MASK) for s in (0, 32)))))
    quarters = F.flatten(F.transform(hashes(1 + WIDE // 2, LANES // 4), lambda h: F.array(*(bits(h, s, 0xFFFF) - F.lit(32768) for s in (0, 16, 32, 48)))))
    return F.concat(halves, quarters)


def plus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(F.lit(MASK)))


def minus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: (x - y).bitwiseAND(F.lit(MASK)))


def vector(text: str | Column) -> Column:
    """The vector of a text: array<bigint> of WIDE + LANES lanes below 2^32."""
    digests = F.transform(paragraphs(text), lambda p: F.sha2(p, 256))
    return F.aggregate(digests, F.array_repeat(F.lit(0).cast("long"), WIDE + LANES), lambda sums, d: plus(sums, _lanes(d)))


def printed(v: Column) -> Column:
    return F.array_join(F.transform(v, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """The cosine of two vectors' sketches, 0 at least; of equal vectors 1."""
    signed = lambda v: F.transform(F.slice(v, WIDE + 1, LANES), lambda x: F.when(x >= 2**31, x - F.lit(2**32)).otherwise(x).cast("double"))
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, t: s + t)

    def of(two: Column) -> Column:
        x, y = two["x"], two["y"]
        size = F.sqrt(dot(x, x)) * F.sqrt(dot(y, y))
        near = F.when(size > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), dot(x, y) / size))).otherwise(F.lit(0.0))
        return F.when(a == b, F.lit(1.0)).otherwise(near)

    return let(F.struct(signed(a).alias("x"), signed(b).alias("y")), of)


def with_next(docs: DataFrame, id_col: str, carried: list[str], tie: str) -> DataFrame:
    """docs, each row with next_<c> of the row that comes next by descending id, the first row's after the last.

    Rows are dealt by ranges of ids whose upper bounds are ids that occur, so each range's first row is known
    beforehand and is also dealt to the range above, where it comes last. No task orders more than a range.
    A null id is below all others; rows of one id are ordered by the column tie.
    """
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(common.NO_ID))
    n = docs.count()
    ranges = max(1, min(MOST_RANGES, n // RANGE_ROWS))
    cuts = [k / ranges for k in range(1, ranges)] or [0.5]
    found = docs.agg(F.max(key), F.percentile_approx(key, cuts, 20 * ranges)).first()
    bounds = sorted({*(found[1] or []), *([found[0]] if found[0] is not None else [0])})
    all_bounds, step = F.array(*map(F.lit, bounds)).cast("array<bigint>"), 64
    coarse = F.array(*map(F.lit, bounds[step - 1 :: step])).cast("array<bigint>") if len(bounds) >= step else F.array().cast("array<bigint>")

    def bucket(id_: Column) -> Column:
        def fine(k: Column) -> Column:
            return k * step + F.size(F.filter(F.slice(all_bounds, k * step + 1, F.lit(step)), lambda b: b < id_))

        return let(F.size(F.filter(coarse, lambda b: b < id_)), fine)

    rows = docs.withColumn("__id", key).withColumn("__range", bucket(F.col("__id")))
    own = F.struct(F.col("__range").alias("__dealt"), F.lit(0).alias("__lent"))
    lent = F.struct(F.pmod(F.col("__range") + 1, F.lit(len(bounds))).alias("__dealt"), F.lit(1).alias("__lent"))
    heads = F.get(all_bounds, F.col("__range")) == F.col("__id")
    to = F.explode(F.when(heads, F.array(own, lent)).otherwise(F.array(own))).alias("__to")
    rows = rows.select("*", to).select(*docs.columns, "__id", "__to.*")
    down = Window.partitionBy("__dealt").orderBy("__lent", F.col("__id").desc(), tie)
    rows = rows.withColumn("__next", F.lead(F.struct(*carried)).over(down)).where("__lent = 0")
    return rows.select(*docs.columns, *(F.col(f"__next.{c}").alias(f"next_{c}") for c in carried))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text: its last third replaced by the start of the next document."""
    rows = docs.select(F.col(id_col).alias("doc_id"), common.whole(F.col(text_col).cast("string")).alias("__text"))
    rows = rows.withColumn("__v", vector("__text")).withColumn("__tie", F.xxhash64("__text"))
    rows = with_next(rows, "doc_id", ["__text", "__v"], "__tie").withColumn("n_chars", F.length("__text").cast("long"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.substring("__text", F.lit(1), (F.col("n_chars") - third).cast("int")), F.substring("next___text", F.lit(1), third))
    rows = rows.withColumn("__edited", edited).select("doc_id", "n_chars", F.sha2("__edited", 256).alias("edited_sha256"), "__v", "next___v", vector("__edited").alias("__w"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", printed(F.col("__v")).alias("fingerprint"), printed(F.col("__w")).alias("edited_fingerprint"),
        likeness(F.col("__v"), F.col("__w")).alias("near_edited"), likeness(F.col("__v"), F.col("next___v")).alias("near_next"),
    )


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(common.read(spark, sf_dir, "documents"))


QUERIES = {"op2_fingerprints": op2_fingerprints}
ORACLES: dict[str, str] = {}
