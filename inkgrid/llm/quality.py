"""Quality classifier: a sparse ensemble of rules over text statistics.

Boosted trees of small depth are grown on a sample of labelled rows; every path from a root to a node is a rule, a
conjunction of thresholds on statistics. A logistic model with an L1 penalty over all rules keeps few of them. The
rules that are left become one Spark column expression: scoring is a projection, without Python, joins or exchanges.

Fitting reads at most about SAMPLE labelled documents (a hash of doc_id decides), all outside the held-out fold.
Labels, lang, source and doc_id are no inputs of a score.

Nulls: a null text is empty; empty texts get the score of their (zero) statistics; a null doc_id has no label. Labels that are
null, or of a doc_id that isn't there, are left out; of repeated rows and labels each pair counts. Without two classes of labels
every score is the share of ones (or 0.5). Each row is scored by its text alone, so ties and repeated rows have equal scores;
an empty table gives an empty result. score() keeps other columns and replaces one named score; no other name is taken.
A very long text takes memory for its words once.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

SAMPLE = 10_000
THRESHOLD = 0.3
TREES, DEPTH, LEAST_LEAF, RATE, BINS = 40, 3, 20, 0.3, 32
PENALTY = 0.002
FOLDS = 5
#: Classes of characters whose shares of a text are statistics.
SHARES = {"capitals": r"\p{Lu}", "symbols": r"#$%&*@^~=_+<>\\{}\[\]", "bars": "|", "cries": "!?", "digits": "0-9", "stops": ".,;:", "spaces": r"\s"}
NAMES = ("chars", "words", "word_length", "distinct_words", "line_length", "distinct_lines", *SHARES)


def fold(id_col: str, folds: int) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds


def statistics(text_col: str) -> Column:
    """Statistics of a text as a struct. Shares are of characters, or of words or lines where the name says so."""

    def of_parts(p: Column) -> Column:
        t, n, words, lines = p["text"], p["n"], p["words"], p["lines"]
        kept = lambda chars: F.length(F.regexp_replace(t, f"[^{chars}]+", ""))
        of = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
        return F.struct(
            n.cast("double").alias("chars"),
            F.size(words).cast("double").alias("words"),
            of(n, F.size(words)).alias("word_length"),
            of(F.size(F.array_distinct(words)), F.size(words)).alias("distinct_words"),
            of(n, F.size(lines)).alias("line_length"),
            of(F.size(F.array_distinct(lines)), F.size(lines)).alias("distinct_lines"),
            *(of(kept(chars), n).alias(name) for name, chars in SHARES.items()),
        )

    t = common.whole(F.col(text_col).cast("string"))
    words, lines = F.filter(F.split(t, r"\s+"), lambda w: w != ""), F.filter(F.split(t, "\n"), lambda x: x != "")
    return common.let(F.struct(t.alias("text"), F.length(t).alias("n"), words.alias("words"), lines.alias("lines")), of_parts)


@dataclass(frozen=True)
class Rule:
    """All of: statistic `name` is above (or not above) `at`."""

    parts: tuple[tuple[str, bool, float], ...]

    def holds(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        out = np.ones(len(x), bool)
        for name, above, at in self.parts:
            out &= (x[:, names.index(name)] > at) == above
        return out

    def column(self, stats: Column) -> Column:
        """Whether the rule holds for a struct of statistics."""
        out = F.lit(True)
        for name, above, at in self.parts:
            out = out & ((stats[name] > at) if above else (stats[name] <= at))
        return out


@dataclass(frozen=True)
class Model:
    bias: float
    rules: tuple[tuple[Rule, float], ...]

    def margin(self, stats: Column) -> Column:
        out = F.lit(self.bias)
        for rule, w in self.rules:
            out = out + F.when(rule.column(stats), F.lit(w)).otherwise(F.lit(0.0))
        return out

    def chance(self, text_col: str) -> Column:
        """The score of a text. Its statistics are computed once, wherever the optimizer moves this expression."""
        return common.let(statistics(text_col), lambda stats: 1 / (1 + F.exp(-self.margin(stats))))


def _grow(x: np.ndarray, edges: list[np.ndarray], binned: np.ndarray, grad: np.ndarray, hess: np.ndarray, names: list[str], path: tuple, rows: np.ndarray, rules: list[Rule], step: np.ndarray) -> None:
    """Splits rows where the second-order gain is largest; notes each node's path; leaves add their step."""
    g, h = grad[rows].sum(), hess[rows].sum()
    best = (1e-6, -1, 0)
    if len(path) < DEPTH and rows.size >= 2 * LEAST_LEAF:
        for j in range(x.shape[1]):
            b = binned[rows, j]
            k = edges[j].size + 1
            gs, hs, cs = (np.cumsum(np.bincount(b, w, minlength=k))[:-1] for w in (grad[rows], hess[rows], np.ones(rows.size)))
            fair = (cs >= LEAST_LEAF) & (rows.size - cs >= LEAST_LEAF)
            if fair.any():
                gain = np.where(fair, gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1), -1)
                if gain.max() > best[0]:
                    best = (gain.max(), j, int(gain.argmax()))
    if best[1] < 0:
        step[rows] = RATE * g / (h + 1)
        return
    _, j, cut = best
    at = float(edges[j][cut])
    for above in (False, True):
        longer = (*path, (names[j], above, at))
        rules.append(Rule(longer))
        _grow(x, edges, binned, grad, hess, names, longer, rows[(binned[rows, j] > cut) == above], rules, step)


def grow_rules(x: np.ndarray, y: np.ndarray, names: list[str], trees: int = TREES, seed: int = 1) -> list[Rule]:
    """Paths of boosted trees, each grown on half of the rows, without repetitions."""
    draw = np.random.default_rng(seed)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
    margin, rules = np.zeros(len(y)), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        rows = np.flatnonzero(draw.random(len(y)) < 0.5)
        step, mine = np.zeros(len(y)), []
        _grow(x, edges, binned, y - p, p * (1 - p), names, (), rows, mine, step)
        rules += mine
        for rule in mine:  # leaves' steps, for all rows: those of the rule's rows that were drawn
            held = rule.holds(x, names)
            inside = step[rows][held[rows]]
            if inside.size and np.ptp(inside) == 0:
                margin[held] += inside[0]
    return list(dict.fromkeys(rules))


def lasso(r: np.ndarray, y: np.ndarray, penalty: float = PENALTY, steps: int = 400) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty on all but the bias, by accelerated proximal gradients."""
    n, k = r.shape
    full = np.hstack([np.ones((n, 1), np.float32), r.astype(np.float32)])
    v = np.ones(k + 1, np.float32)
    for _ in range(30):  # the largest eigenvalue of full' full, by powers
        v = full.T @ (full @ v)
        top = float(np.linalg.norm(v))
        v /= top
    rate = 3.6 * n / top
    w = z = np.zeros(k + 1)
    t = 1.0
    for _ in range(steps):
        g = full.T @ ((1 / (1 + np.exp(-(full @ z.astype(np.float32)).astype(float))) - y).astype(np.float32)) / n
        new = z - rate * g
        new[1:] = np.sign(new[1:]) * np.maximum(0, np.abs(new[1:]) - rate * penalty)
        t_new = (1 + math.sqrt(1 + 4 * t * t)) / 2
        z, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    return float(w[0]), w[1:]


def fit(x: np.ndarray, y: np.ndarray, names: list[str]) -> Model:
    if not len(y) or y.min() == y.max():
        share = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
        return Model(math.log(share / (1 - share)), ())
    rules = grow_rules(x, y, names)
    held = np.stack([r.holds(x, names) for r in rules], 1) if rules else np.zeros((len(y), 0), bool)
    bias, weights = lasso(held, y)
    return Model(bias, tuple((r, float(w)) for r, w in zip(rules, weights, strict=True) if abs(w) > 1e-6))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, sample: int = SAMPLE) -> Model:
    """A model of labels (doc_id, quality) outside the held-out fold, of about `sample` of them at most."""
    known = labels.select(F.col("doc_id").alias("__l"), F.col("quality").cast("int").alias("__y")).where(F.col("__y").isin(0, 1) & F.col("__l").isNotNull() & (fold("__l", FOLDS) != 0))
    share = min(1.0, sample / max(1, known.count()))
    known = known.where(F.pmod(F.xxhash64("__l", F.lit(8)), F.lit(2**20)) < F.lit(int(share * 2**20)))
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col)).join(F.broadcast(known), F.col("__id") == F.col("__l"))
    rows = rows.select("__id", "__y", statistics(text_col).alias("__s")).select("__id", "__y", "__s.*").toPandas().sort_values(["__id", "__y", *NAMES])
    return fit(rows[list(NAMES)].to_numpy(float), rows["__y"].to_numpy(float), list(NAMES))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with score, the probability of quality 1; a column of that name is replaced."""
    return docs.withColumn("score", model.chance(text_col))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, common.read(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", (fold("doc_id", FOLDS) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op8_quality": op8_quality}
ORACLES: dict[str, str] = {}
