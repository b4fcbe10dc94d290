"""Quality rules: an isolation forest over the statistics that such rules look at, beside two fixed rules.

Statistics. One pass over the texts counts words, symbols, repeated lines, repeated passages of WINDOW words and more; its table of numbers is
written, and all that follows reads the numbers alone. Two fixed rules fail a text at once: too few words, too many of them in repeated passages.

Forest. Each tree splits SUBSAMPLE rows at random statistics and random places until they are alone or DEPTH is reached: what differs from
the rest is alone soon. A row's anomaly is 2 to the minus mean depth over that of a random search tree, the leaf's own rows counted in
(Liu, Ting and Zhou 2008). Each tree draws its rows, by their numbers, from all labelled rows of quality 1 that pass the fixed rules, so that depth
tells how usual a text is among good ones, whatever share of the corpus is bad. Traits such as symbols are 0 in nearly
all good texts, so a tree sees more rows than is customary: of few, hardly any would split there. Trees grow in tasks, a group of SUBSAMPLE rows each.

Threshold. Of the anomalies of all labelled rows that pass the fixed rules, that which parts the labels best (share of zeros above plus
share of ones not above, with KEEPS of the ones at least not above), by running counts over ranges of anomalies; rows above it are not kept.
Without rows of both labels nothing is anomalous. What goes through the driver: the trees, and two counts a range.

Nulls: a null text has no words; a null doc_id has no label; labels that are null, or of a doc_id that isn't there, are left out; of rows
of one id one counts for each of its labels. Each row is judged by its text alone, so ties and repeated rows share their verdict. An
empty table gives an empty result. Other columns are not read. A very long text takes memory for its words once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common, resampling, shingles

#: The fixed rules: the fewest words, the window, the most per cent of words in windows that a text repeats.
LEAST_WORDS, WINDOW, MOST_REPEATED = 10, 5, 20
SYMBOLS = b"#*$%&|<>"
#: Trees, rows of a tree, the share of good rows that stay.
TREES, SUBSAMPLE, KEEPS = 300, 1024, 0.995
SEED = 1

_KEEP_SYMBOLS = bytes(b for b in range(256) if b not in SYMBOLS)
_NOT = {name: bytes(b for b in range(256) if b not in keep) for name, keep in {
    "capitals": bytes(range(65, 91)), "digits": b"0123456789", "stops": b".,;:", "cries": b"!?", "marks": b"#$%&*@^~=_+<>\\{}[]|",
}.items()}

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: What the forest sees of a text: shares, mean lengths, and the number of words by its logarithm.
TRAITS = ("word_length", "symbols", "dup_lines", "repeated", "distinct", "line_words", *_NOT)


def repeated_words(hashes: np.ndarray, width: int = WINDOW) -> int:
    """How many words lie in windows of `width` words that are found twice or more, the first included."""
    if hashes.size <= width:
        return 0
    windows = shingles.joined([hashes[i : hashes.size - width + 1 + i] for i in range(width)])
    _, at, counts = np.unique(windows, return_inverse=True, return_counts=True)
    again = counts[at] > 1
    cover = np.zeros(hashes.size + 1, np.int64)
    cover[: again.size] += again
    cover[width:] -= again
    return int(np.count_nonzero(np.cumsum(cover[:-1])))


def counts_and_traits(text: bytes | None) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """COUNTS and TRAITS of a text in UTF-8. Windows are compared by 64-bit hashes, lines as they are."""
    text = text or b""
    hashes = shingles.hashes_of(text.split())
    n_words = hashes.size
    bare = text.translate(None, b" \t\n\v\f\r")
    chars = len(bare.decode("utf-8", "replace"))
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\n\v\f\r")]
    n_dup, n_symbols, n_repeat = len(lines) - len(set(lines)), len(text.translate(None, _KEEP_SYMBOLS)), repeated_words(hashes)
    shares = [len(bare.translate(None, drop)) / max(1, chars) for drop in _NOT.values()]
    each = max(1, n_words)
    traits = (chars / each, n_symbols / max(1, chars), n_dup / max(1, len(lines)), n_repeat / each, np.unique(hashes).size / each**0.8, min(n_words / max(1, len(lines)), 400.0), *shares)
    return (n_words, chars, n_symbols, n_dup, n_repeat), traits


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, COUNTS and TRAITS of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [counts_and_traits(t.as_py()) for t in b.column("text")]
            if len(found):
                numbers = [pa.array([f[0][i] for f in found], pa.int64()) for i in range(len(COUNTS))] + [pa.array([f[1][i] for f in found], pa.float64()) for i in range(len(TRAITS))]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), *numbers], ["doc_id", *COUNTS, *TRAITS])
        shingles.forget()

    schema = ", ".join(["doc_id long", *(f"{c} long" for c in COUNTS), *(f"{t} double" for t in TRAITS)])
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text")).mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def _usual_depth(n: np.ndarray | int) -> np.ndarray:
    """The mean depth of an unsuccessful search in a random search tree of n keys."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


@dataclass(frozen=True)
class Forest:
    """Trees as arrays, a row a tree: trait of a node (-1: leaf), place of the split, the node on its lower side (the next one is on its
    upper), and the depth that a row which ends there has."""

    trait: np.ndarray
    at: np.ndarray
    low: np.ndarray
    depth: np.ndarray
    usual: float

    def anomaly(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for trait, at, low, depth in zip(self.trait, self.at, self.low, self.depth, strict=True):
            node = np.zeros(len(x), np.int64)
            walking = np.arange(len(x)) if trait[0] >= 0 else np.zeros(0, np.int64)
            while walking.size:
                n = node[walking]
                n = low[n] + (x[walking, trait[n]] > at[n])
                node[walking] = n
                walking = walking[trait[n] >= 0]
            total += depth[node]
        return 2.0 ** (-total / (len(self.trait) * max(self.usual, 1e-9)))


def grown_tree(x: np.ndarray, draw: np.random.Generator) -> tuple[list, list, list, list]:
    """A tree over all rows of x: trait, at, low and depth of its nodes."""
    most = int(np.ceil(np.log2(max(2, len(x)))))
    trait, at, low, depth = [-1], [0.0], [0], [0.0]
    todo = [(0, np.arange(len(x)), 0)]
    while todo:
        node, rows, deep = todo.pop()
        here = x[rows]
        varied = np.flatnonzero(np.ptp(here, axis=0) > 0) if len(rows) > 1 and deep < most else ()
        if not len(varied):
            depth[node] = deep + float(_usual_depth(len(rows)))
            continue
        t = int(draw.choice(varied))
        cut = float(draw.uniform(here[:, t].min(), here[:, t].max()))
        trait[node], at[node], low[node] = t, cut, len(trait)
        upper = here[:, t] > cut
        for part in (rows[~upper], rows[upper]):
            todo.append((len(trait), part, deep + 1))
            trait.append(-1)
            at.append(0.0)
            low.append(0)
            depth.append(0.0)
    return trait, at, low, depth


def forest_of(grown: list[tuple], size: int) -> Forest:
    """Trees of `size` rows each, filled up to one width."""
    width = max(len(t[0]) for t in grown)
    filled = [np.array([list(t[i]) + [t[i][0]] * (width - len(t[i])) for t in grown]) for i in range(4)]
    return Forest(*filled, float(_usual_depth(size)))


def grow(x: np.ndarray, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = SEED) -> Forest:
    """A forest over rows that are here."""
    draw = np.random.default_rng(seed)
    size = min(subsample, len(x))
    return forest_of([grown_tree(x[draw.choice(len(x), size, replace=False)], draw) for _ in range(trees)], size)


def grow_over(good: DataFrame, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = SEED) -> Forest:
    """A forest over all rows of a table of doc_id (each once) and TRAITS: rows are numbered, each tree draws its numbers, and grows in its own group."""
    numbered, path = resampling.ranked(good, F.asc("doc_id"))
    n = numbered.count()
    size = min(subsample, n)

    def drawn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for t in pdf["id"].tolist():
                yield pd.DataFrame({"tree": t, "rank": 1 + np.random.default_rng([seed, t]).choice(n, size, replace=False)})

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        t = int(pdf["tree"].iloc[0])
        x = pdf.sort_values("rank")[list(TRAITS)].to_numpy(float)
        return pd.DataFrame([(t, *grown_tree(x, np.random.default_rng([seed, t, 1])))], columns=["tree", "trait", "at", "low", "depth"])

    draws = good.sparkSession.range(trees).mapInPandas(drawn, "tree long, rank long")
    found = draws.join(numbered, "rank").groupBy("tree").applyInPandas(one, "tree long, trait array<int>, at array<double>, low array<int>, depth array<double>")
    rows = sorted(found.collect(), key=lambda r: r["tree"])  # a row a tree
    common.removed(good.sparkSession, path)
    return forest_of([(r["trait"], r["at"], r["low"], r["depth"]) for r in rows], size)


def threshold(anomaly: np.ndarray, good: np.ndarray, keeps: float = KEEPS) -> float:
    """The anomaly above which a row is bad: what parts the labels best, of those that `keeps` of the good rows aren't above."""
    order = np.sort(anomaly)
    ones, zeros = np.sort(anomaly[good]), np.sort(anomaly[~good])
    stay = np.searchsorted(ones, order, "right") / len(ones)
    go = 1 - np.searchsorted(zeros, order, "right") / len(zeros)
    fair = np.where(stay >= keeps, stay + go, -1.0)
    return float(order[int(fair.argmax())])


def threshold_over(rows: DataFrame, keeps: float = KEEPS) -> float:
    """threshold() of a table of anomaly and good (1 or 0), of both of which there are rows: running counts, by ranges of anomalies."""
    counts = rows.groupBy("anomaly").agg(F.sum("good").alias("ones"), F.sum(1 - F.col("good")).alias("zeros"))
    placed, path = common.written(counts.repartitionByRange("anomaly").withColumn("part", F.spark_partition_id()))
    below, ones, zeros = [], 0, 0
    for r in placed.groupBy("part").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros")).orderBy("part").collect():  # a row a range
        below.append((r["part"], ones, zeros))
        ones, zeros = ones + r["ones"], zeros + r["zeros"]
    before = rows.sparkSession.createDataFrame(below, "part int, ones_before long, zeros_before long")
    so_far = Window.partitionBy("part").orderBy("anomaly").rowsBetween(Window.unboundedPreceding, 0)
    upto = lambda c: F.sum(c).over(so_far) + F.col(f"{c}_before")
    shares = placed.join(F.broadcast(before), "part").select("anomaly", (upto("ones") / ones).alias("stay"), (1 - upto("zeros") / zeros).alias("go"))
    fair = F.when(F.col("stay") >= keeps, F.col("stay") + F.col("go")).otherwise(-1.0)
    best = shares.orderBy(fair.desc(), F.asc("anomaly")).first()["anomaly"]
    common.removed(rows.sparkSession, path)
    return float(best)


@dataclass(frozen=True)
class Verdict:
    """A forest with its threshold; without a forest nothing is anomalous."""

    forest: Forest | None = None
    at: float = 1.0

    def anomaly(self) -> Column:
        forest = self.forest
        if forest is None:
            return F.lit(0.0)

        @F.pandas_udf("double")
        def run(*traits: pd.Series) -> pd.Series:
            return pd.Series(forest.anomaly(np.column_stack([t.to_numpy(float) for t in traits])))

        return run(*(F.col(t) for t in TRAITS))


def calibrate(stats: DataFrame, labels: DataFrame) -> Verdict:
    """The verdict of all labels (doc_id, quality) over the statistics of their rows."""
    known = labels.select(F.col("doc_id").alias("__l"), F.col("quality").cast("int").alias("__y")).where(F.col("__y").isin(0, 1) & F.col("__l").isNotNull()).distinct()
    rows = stats.where(~base_failed()).join(known, F.col("doc_id") == F.col("__l"))
    one, path = common.written(rows.groupBy("doc_id", "__y").agg(F.min(F.struct(*TRAITS)).alias("t")).select("doc_id", F.col("__y").alias("good"), "t.*"))
    if one.select("good").distinct().count() < 2:
        common.removed(stats.sparkSession, path)
        return Verdict()
    forest = grow_over(one.where("good = 1").drop("good"))
    told, scored = common.written(one.select("good", Verdict(forest).anomaly().alias("anomaly")))
    at = threshold_over(told)
    for p in (path, scored):
        common.removed(stats.sparkSession, p)
    return Verdict(forest, at)


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, COUNTS, base_failed, anomaly and kept of every row."""
    stats, _ = common.written(statistics(docs, id_col, text_col))
    verdict = calibrate(stats, labels)
    rows = stats.withColumns({"base_failed": base_failed(), "anomaly": verdict.anomaly()})
    return rows.select("doc_id", *COUNTS, "base_failed", "anomaly", (~F.col("base_failed") & (F.col("anomaly") <= verdict.at)).alias("kept"))


def op12_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge(common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "labels"))
    return out.select("doc_id", *COUNTS, "base_failed", "kept")


QUERIES = {"op12_rules": op12_rules}
ORACLES: dict[str, str] = {}
