"""Which quotes stand in which texts: every quote against every text, as they are or within a share of edits, in one pass over the texts.

A quote of m characters that may have k edits is cut into k + 1 pieces, one of which stands unharmed in any match (the
pigeonhole). The pieces of all quotes form one automaton (Aho and Corasick 1975), which finds them while a text is read once. Around
what it finds, a quote has windows of its own length and k on either side, merged where they overlap; in these the search is
bit-parallel (evidence.match_ends). So a text costs its length once, and its length once more at most for each quote that has pieces in it.

Quotes are the side that is sent along, PASS_CHARS characters a pass; more quotes take more passes over the texts, each
written. Equal quotes are looked for once and told apart afterwards by an ordinary join. Nothing is joined by ids of texts, so they may be null or repeated.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import evidence
from ..sources import documents as S

#: Characters of the quotes of a pass, about.
PASS_CHARS = 2_000_000


class Finder:
    """Places of many quotes in a text. rate: as evidence.RATE, over normalised texts and quotes; None: quotes as they are in texts as they are."""

    def __init__(self, quotes: dict[int, str], rate: float | None = evidence.RATE) -> None:
        import ahocorasick

        self.rate, self.numbers, self.anywhere = rate, {}, []
        for number, quote in quotes.items():
            pattern = quote if rate is None else evidence.normalised(quote)
            if pattern:
                self.numbers.setdefault(pattern, []).append(number)
        seeds: dict[str, list[tuple[str, int]]] = {}
        for pattern in self.numbers:
            k = 0 if rate is None else evidence.budget_of(pattern, rate)
            if k >= len(pattern):
                self.anywhere.append(pattern)
                continue
            cuts = [i * len(pattern) // (k + 1) for i in range(k + 2)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                seeds.setdefault(pattern[a:b], []).append((pattern, a))
        self.automaton = ahocorasick.Automaton()
        for seed, owners in seeds.items():
            self.automaton.add_word(seed, (len(seed), owners))
        self.automaton.make_automaton()

    def _spots(self, text: str) -> dict[str, list[int]]:
        """For each pattern with pieces in a text, where it would begin by them."""
        spots: dict[str, list[int]] = {}
        if len(self.automaton):
            for last, (size, owners) in self.automaton.iter(text):
                for pattern, offset in owners:
                    spots.setdefault(pattern, []).append(last + 1 - size - offset)
        return spots

    def find(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(number, start, end, distance) of the best match of each quote that a text holds: the least distance, then the first
        end, then the longest. A pattern with as many edits as characters is in any text that isn't empty, at 0 if it's nowhere else."""
        told = text if self.rate is None else evidence.normalised(text)
        if not told:
            return
        found: list[tuple[str, int, int, int]] = []
        for pattern, starts in self._spots(told).items():
            if (best := self._best(pattern, told, starts)) is not None:
                found.append((pattern, *best))
        for pattern in self.anywhere:
            at = told.find(pattern)
            found.append((pattern, at, at + len(pattern), 0) if at >= 0 else (pattern, 0, 0, len(pattern)))
        if found and self.rate is not None:
            _, begins, ends = evidence.places(text)
            found = [(p, begins[a], ends[b - 1], d) if b > a else (p, 0, 0, d) for p, a, b, d in found]
        for pattern, a, b, d in found:
            for number in self.numbers[pattern]:
                yield number, a, b, d

    def _best(self, pattern: str, text: str, starts: list[int]) -> tuple[int, int, int] | None:
        m, k = len(pattern), 0 if self.rate is None else evidence.budget_of(pattern, self.rate)
        at = min(starts) if self.rate is None else text.find(pattern)
        if at >= 0:
            return at, at + m, 0
        least: tuple[int, int] | None = None
        low = high = -1
        windows = []
        for s in sorted({*starts}):
            a, b = max(0, s - k), min(len(text), s + m + k)
            if a > high:
                if high >= 0:
                    windows.append((low, high))
                low = a
            high = max(high, b)
        for a, b in [*windows, (low, high)]:
            for end, distance in evidence.match_ends(pattern, text[a:b], k):
                if least is None or distance < least[0]:
                    least = distance, a + end
        if least is None:
            return None
        distance, end = least
        sizes = evidence.match_ends(pattern[::-1], text[max(0, end - m - k) : end][::-1], distance)
        return end - max(n for n, d in sizes if d == distance), end, distance


FOUND = "quote long, doc_id long, start int, end int, distance int"


def _scan(texts: DataFrame, quotes: dict[int, str], rate: float | None) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(quotes, rate)
        for b in batches:
            rows = [(n, i, s, e, d) for i, t in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True) if t.is_valid for n, s, e, d in finder.find(t.as_py())]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["quote", "doc_id", "start", "end", "distance"])

    return texts.mapInArrow(run, FOUND)


def occurrences(texts: DataFrame, quotes: DataFrame, *, rate: float | None = evidence.RATE, text_id: str = "doc_id", text_col: str = "text", quote_id: str = "item_id", quote_col: str = "text") -> DataFrame:
    """quote_id, text_id, start, end and distance of every quote in every text that holds it: the place in the text as it is, in code points.

    rate None takes quotes and texts as they are. A null or empty quote, and a null text, give no rows; a repeated quote or
    text gives a row each time.
    """
    spark = texts.sparkSession
    asked = quotes.select(F.col(quote_id).alias("__id"), F.col(quote_col).alias("__q")).where("__q <> ''").withColumn("quote", F.xxhash64("__q"))
    once = asked.select("quote", "__q").distinct()
    passes = max(1, math.ceil((once.agg(F.sum(F.length("__q"))).first()[0] or 0) / PASS_CHARS))
    thin = texts.select(F.col(text_id).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = []
    for p in range(passes):
        mine = {r["quote"]: r["__q"] for r in once.where(F.pmod("quote", F.lit(passes)) == p).collect()}
        scanned = _scan(thin, mine, rate)
        if passes > 1:
            path = S.scratch(spark, "quotes-found")
            scanned.write.parquet(path)
            scanned = spark.read.schema(FOUND).parquet(path)
        found.append(scanned)
    rows = reduce(DataFrame.unionByName, found)
    return rows.join(asked.select("quote", "__id"), "quote").select(F.col("__id").alias(quote_id), F.col("doc_id").alias(text_id), "start", "end", "distance")


def place_columns(rate: float = evidence.RATE):
    """(quotes array<string>, text) -> for each quote where it stands in the text: struct<start,end,distance>, null where it doesn't."""

    @F.pandas_udf("array<struct<start:int,end:int,distance:int>>")
    def run(quotes, text):
        import pandas as pd

        out = []
        for qs, t in zip(quotes, text, strict=True):
            qs = list(qs) if qs is not None else []
            at = {n: {"start": s, "end": e, "distance": d} for n, s, e, d in Finder({i: q for i, q in enumerate(qs) if q}, rate).find(t or "")}
            out.append([at.get(i) for i in range(len(qs))])
        return pd.Series(out)

    return run
