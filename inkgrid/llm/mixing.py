"""Mixing sources to target weights by Pareto order sampling.

A source's target is its weight's share of `ratio` times all words, at most `cap` times its own words; what a
capped source leaves goes to the others by weight (water filling, in closed form over the sources sorted by the
level at which they are full). Within a source, a document is expected e = min(cap, c w) times: w is its own weight, a column's
or its size to the power POWER (longer documents are likelier), and c is such that the words expected are the target. It gets
floor(e) copies for certain. The rest p = e - floor(e) is its inclusion probability: documents are ranked by the
Pareto key  u (1-p) / ((1-u) p),  u drawn by a hash of id, text and seed, and the first of them are taken until the
source's words are used up. Fixed size here means words, so the sum is met, not just expected: up to CLOSINGS further documents
close the gap, each the one whose size comes nearest.

c is found over classes of weights (CLASSES an octave), as the words at a cap or below it only depend on them; p then is right
to a part in a hundred, and the words taken don't depend on c. The cut is found in two steps, so that no task gets a whole
source: words per source and key interval (BUCKETS intervals, summed before any exchange), then the rows of the one interval
in which the target falls.

Nulls: a null text has size 0, null sources are one source, the last; a null weight is 1, one below 0 is 0. Rows of one id
and text share their draw and are taken together or not at all. Ties of the key are ranked by size. An empty table gives an
empty result. A very long text is only counted. Other columns stay; columns of the names this adds are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

WEIGHTS = (5.0, 2.0, 1.0)
RATIO = 1.5
CAP = 2.0
#: The power of a document's size that is its weight where no column is given.
POWER = 0.5
BUCKETS, CLASSES, CLOSINGS = 1 << 16, 32, 3
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(common.whole(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, ratio: float = RATIO, cap: float = CAP) -> DataFrame:
    """sizes: source, source_size, one row a source. Adds weight and target."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    all_of = Window.partitionBy()
    filled = Window.orderBy("__level", F.col("source").asc_nulls_last())
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    room = F.lit(cap) * F.col("source_size")
    out = sizes.withColumn("weight", weight).withColumn("__level", room / F.col("weight"))
    rest = F.lit(ratio) * F.sum("source_size").over(all_of) - F.coalesce(F.sum(room).over(before), F.lit(0.0))
    left = F.sum("weight").over(all_of) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    out = out.withColumn("__at", rest / left)
    level = F.min(F.when(F.col("__at") <= F.col("__level"), F.struct(F.col("__level"), F.col("__at")))).over(all_of)["__at"]
    return out.withColumn("target", F.least(F.lit(cap) * F.col("source_size"), F.col("weight") * F.coalesce(level, F.lit(float("inf"))))).drop("__level", "__at")


def _drawn(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int, weight_col: str | None) -> DataFrame:
    """size, __u in (0, 1), __source and __w, its own weight, of every row."""
    text = common.whole(F.col(text_col).cast("string"))
    draw = (F.shiftrightunsigned(F.xxhash64(F.col(id_col), text, F.lit(seed)), 11).cast("double") + 0.5) / F.lit(float(2**53))
    rows = docs.withColumns({"size": n_words(text), "__u": draw, "__source": F.col(source_col)})
    own = F.pow("size", F.lit(POWER)) if weight_col is None else F.greatest(F.coalesce(F.col(weight_col).cast("double"), F.lit(1.0)), F.lit(0.0))
    return rows.withColumn("__w", F.when(F.col("size") > 0, own).otherwise(F.lit(0.0)))


def _rates(thin: DataFrame, sources: DataFrame, cap: float) -> DataFrame:
    """__s, __rate: the c of each source, over classes of weights."""
    kind = F.floor(F.log2("__w") * CLASSES)
    classes = thin.where("__w > 0").groupBy("__source", kind.alias("__class")).agg(F.sum("size").alias("__m"), F.sum(F.col("size") * F.col("__w")).alias("__mw"))
    classes = classes.join(common.sent(sources.select(F.col("source").alias("__s"), "target")), F.col("__source").eqNullSafe(F.col("__s")))
    down = Window.partitionBy("__source").orderBy(F.col("__class").desc())
    before = down.rowsBetween(Window.unboundedPreceding, -1)
    capped, rest = F.coalesce(F.sum("__m").over(before), F.lit(0)), F.sum("__mw").over(down.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rate = (F.col("target") - F.lit(cap) * capped) / rest
    # Heavier classes are at the cap; the first class that isn't, and all lighter ones, have the rate.
    able = classes.withColumn("__rate", rate).where(F.col("__rate") * F.col("__mw") / F.col("__m") <= F.lit(cap) * 1.000001)
    found = able.groupBy("__source").agg(F.max_by("__rate", "__class").alias("__rate"))
    return found.select(F.col("__source").alias("__s"), "__rate")


def _ranked(rows: DataFrame, cap: float) -> DataFrame:
    """From size, __u, __w, __rate: whole copies and the Pareto key (null: not in the draw) in (0, 1). No rate: all are at the cap."""
    e = F.when(F.col("size") > 0, F.least(F.lit(cap), F.coalesce(F.col("__rate") * F.col("__w"), F.when(F.col("__w") > 0, F.lit(cap)).otherwise(F.lit(0.0))))).otherwise(F.lit(0.0))
    p = F.col("__e") - F.floor("__e")
    odds = F.col("__u") * (1 - F.col("__p")) / ((1 - F.col("__u")) * F.col("__p"))
    return (
        rows.withColumn("__e", e).withColumn("__p", p).withColumn("__whole", F.floor("__e").cast("long"))
        .withColumn("__key", F.when((F.col("__p") > 1e-9) & (F.col("size") > 0), odds / (1 + odds))).drop("__e", "__p")
    )


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *, weights: tuple[float, ...] = WEIGHTS, ratio: float = RATIO, cap: float = CAP, seed: int = 1, weight_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The drawn rows without texts (cut), and a row for each source: source, source_size, target, __rate, __cut (key up to which documents are taken), __closing (keys of the documents that close the gap)."""
    names = list(dict.fromkeys(c for c in (id_col, text_col, source_col, weight_col) if c))
    thin = common.cut(_drawn(docs.select(*names), id_col, text_col, source_col, seed, weight_col).select(F.col(id_col).alias("__id"), "__source", "size", "__u", "__w"))
    sizes = thin.groupBy(F.col("__source").alias("source")).agg(F.sum("size").alias("source_size"))
    sources = common.cut(source_targets(sizes, weights, ratio, cap))
    rates = common.cut(_rates(thin, sources, cap))
    sources = common.cut(sources.join(common.sent(rates), F.col("source").eqNullSafe(F.col("__s")), "left").drop("__s"))
    of = lambda table: common.sent(table)  # noqa: E731  (a few numbers a source)
    ranked = _ranked(thin.join(of(sources.select(F.col("source").alias("__name"), "target", "__rate")), F.col("__source").eqNullSafe(F.col("__name"))), cap)
    ranked = ranked.withColumn("__bucket", F.floor(F.col("__key") * BUCKETS).cast("int"))
    certain = ranked.groupBy("__source").agg(F.sum(F.col("__whole") * F.col("size")).alias("__certain"), F.first("target").alias("target"))
    wanted = common.cut(certain.select(F.col("__source").alias("__s"), (F.col("target") - F.col("__certain")).alias("__want")))
    drawn = ranked.where("__key is not null")
    buckets = drawn.groupBy("__source", "__bucket").agg(F.sum("size").alias("__words"))
    buckets = buckets.join(of(wanted), F.col("__source").eqNullSafe(F.col("__s"))).drop("__s")
    through = Window.partitionBy("__source").orderBy("__bucket")
    buckets = buckets.withColumn("__to", F.sum("__words").over(through)).where(F.col("__to") > F.col("__want"))
    crossing = buckets.groupBy("__source").agg(F.min_by(F.struct("__bucket", (F.col("__want") - F.col("__to") + F.col("__words")).alias("__left")), "__bucket").alias("__x"))
    crossing = common.cut(crossing.select(F.col("__source").alias("__s"), F.col("__x.__bucket").alias("__b"), F.col("__x.__left").alias("__left")))
    inside = drawn.join(of(crossing), F.col("__source").eqNullSafe(F.col("__s")) & (F.col("__bucket") == F.col("__b")))
    inside = inside.withColumn("__to", F.sum("size").over(Window.partitionBy("__source").orderBy("__key"))).where(F.col("__to") <= F.col("__left"))
    cuts = inside.groupBy(F.col("__source").alias("__s2")).agg(F.max("__key").alias("__k"), F.max("__to").alias("__used"))
    cuts = crossing.join(cuts, F.col("__s").eqNullSafe(F.col("__s2")), "left").select(
        "__s", F.coalesce("__k", F.col("__b") / F.lit(float(BUCKETS)) - F.lit(1e-12)).alias("__cut"), (F.col("__left") - F.coalesce("__used", F.lit(0))).alias("__gap"), F.array().cast("array<double>").alias("__closing")
    )
    cuts = common.cut(cuts)
    for _ in range(CLOSINGS):
        late = drawn.join(of(cuts), F.col("__source").eqNullSafe(F.col("__s"))).where((F.col("__key") > F.col("__cut")) & ~F.array_contains("__closing", F.col("__key")))
        off = F.abs(F.col("size") - F.col("__gap"))
        near = F.struct(off.alias("__off"), F.col("__key"), F.col("size").alias("__size"))
        best = late.where(off < F.col("__gap")).groupBy(F.col("__source").alias("__s3")).agg(F.min(near).alias("__n"))
        closed = cuts.join(best, F.col("__s").eqNullSafe(F.col("__s3")), "left")
        cuts = common.cut(closed.select(
            "__s", "__cut", (F.col("__gap") - F.coalesce("__n.__size", F.lit(0))).alias("__gap"),
            F.when(F.col("__n").isNull(), F.col("__closing")).otherwise(F.array_append("__closing", F.col("__n.__key"))).alias("__closing"),
        ))
    none = F.array().cast("array<double>")
    sources = sources.join(cuts, F.col("source").eqNullSafe(F.col("__s")), "left").select("source", "source_size", "target", "__rate", F.coalesce("__cut", F.lit(1.0)).alias("__cut"), F.coalesce("__closing", none).alias("__closing"))
    return thin, common.cut(sources)


def _copies(rows: DataFrame, cap: float) -> DataFrame:
    extra = F.coalesce(F.col("__key") <= F.col("__cut"), F.lit(False)) | F.coalesce(F.array_contains("__closing", F.col("__key")), F.lit(False))
    return _ranked(rows, cap).withColumn("copies", F.col("__whole") + extra.cast("long"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *, seed: int = 1, weight_col: str | None = None, cap: float = CAP, **how) -> DataFrame:
    """docs with size, source_size, target and copies: how often the mix takes each row."""
    docs = docs.drop("size", "source_size", "target", "copies")
    _, sources = plan(docs, id_col, text_col, source_col, seed=seed, weight_col=weight_col, cap=cap, **how)
    sources = common.sent(sources.withColumnRenamed("source", "__name"))
    rows = _drawn(docs, id_col, text_col, source_col, seed, weight_col).join(sources, F.col("__source").eqNullSafe(F.col("__name")))
    return _copies(rows, cap).select(*docs.columns, "size", "source_size", "target", "copies")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    thin, sources = plan(common.read(spark, sf_dir, "documents"))
    rows = thin.join(common.sent(sources), F.col("__source").eqNullSafe(F.col("source")))
    return _copies(rows, CAP).select(F.col("__id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


QUERIES = {"op3_mixing": op3_mixing}
ORACLES: dict[str, str] = {}
