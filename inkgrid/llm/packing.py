"""Best-fit packing with swap-based local search.

Documents become pieces of at most `capacity` tokens (only longer ones are cut). Pieces are dealt by a hash
of their ids into groups of about GROUP_PIECES, each packed in one task: best fit by decreasing length, then a
local search over the underfull sequences, whose steps raise the sum of squared fills until no sequence has a step left.
A group of that size leaves one sequence partly filled, so more groups cost next to nothing.

Nulls: a null text is empty (its end id alone), a null doc_id is an id of its own. Repeated rows are packed
as often as they come. Empty tables give empty results. Other columns are neither read nor returned. A very long text is encoded
whole and cut. Ties of size are packed in the order of id and piece.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, tokens

CAPACITY = 2048
GROUP_PIECES = 20_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """A row for each piece of each document: its place in the document, its length and its ids' checksum."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = tokens.encoder(vocabulary).encode
        for pdf in batches:
            rows, at = [], 0
            for texts in tokens.in_batches(pdf["text"]):
                for ids in encode(texts):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for k, start in enumerate(range(0, ids.size, capacity)):
                        part = ids[start : start + capacity]
                        rows.append((at, k, start, part.size, zlib.crc32(part.tobytes())))
                    at += 1
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            out["doc_id"] = pdf["doc_id"].astype("Int64").to_numpy()[out["doc_id"]] if len(out) else []
            yield out.astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(run, PIECES)


class Bins:
    """Bins of one capacity, open to moves. An item is a number; items of a bin are kept by size."""

    def __init__(self, sizes: np.ndarray, capacity: int) -> None:
        self.sizes, self.capacity = sizes.tolist(), capacity
        self.items: list[list[int]] = []
        self.fill: list[int] = []
        self._best_fit()

    def _best_fit(self) -> None:
        """Each item, largest first, goes to the fullest bin that still holds it."""
        room: list[list[int]] = [[] for _ in range(self.capacity + 1)]  # bins by free space
        free: list[int] = []  # the free spaces that occur, ascending
        for i in sorted(range(len(self.sizes)), key=lambda i: (-self.sizes[i], i)):
            k = bisect_left(free, self.sizes[i])
            if k == len(free):
                b, was = len(self.items), self.capacity
                self.items.append([])
                self.fill.append(0)
            else:
                was = free[k]
                b = room[was].pop()
                if not room[was]:
                    free.pop(k)
            self.items[b].append(i)
            self.fill[b] += self.sizes[i]
            left = was - self.sizes[i]
            if left:
                if not room[left]:
                    free.insert(bisect_left(free, left), left)
                room[left].append(b)

    def squares(self) -> int:
        return sum(f * f for f in self.fill)

    def _shift(self, i: int, a: int, b: int) -> None:
        self.items[a].remove(i)
        self.items[b].append(i)
        self.fill[a] -= self.sizes[i]
        self.fill[b] += self.sizes[i]

    def _give(self, b: int, o: int) -> bool:
        """One step that takes fill from bin b to bin o, no less full: a move, or an exchange of one for one, one for two or two for one."""
        size, room = self.sizes, self.capacity - self.fill[o]
        mine = sorted(self.items[b], key=size.__getitem__, reverse=True)
        for i in mine:  # move
            if size[i] <= room and size[i]:
                self._shift(i, b, o)
                return True
        theirs = sorted(self.items[o], key=size.__getitem__)
        their_sizes = [size[j] for j in theirs]
        for i in mine:  # one for one: theirs is smaller, by no more than the room
            k = bisect_left(their_sizes, size[i] - room)
            if k < len(theirs) and their_sizes[k] < size[i]:
                self._shift(theirs[k], o, b)
                self._shift(i, b, o)
                return True
        for i in mine:  # one for two
            lo, hi = 0, len(theirs) - 1
            while lo < hi:
                both = their_sizes[lo] + their_sizes[hi]
                if both >= size[i]:
                    hi -= 1
                elif both < size[i] - room:
                    lo += 1
                else:
                    x, y = theirs[lo], theirs[hi]
                    self._shift(x, o, b)
                    self._shift(y, o, b)
                    self._shift(i, b, o)
                    return True
        mine_sizes = [size[i] for i in reversed(mine)]
        for j in theirs:  # two for one: together larger than theirs, by no more than the room
            lo, hi = 0, len(mine) - 1
            while lo < hi:
                both = mine_sizes[lo] + mine_sizes[hi]
                if both > size[j] + room:
                    hi -= 1
                elif both <= size[j]:
                    lo += 1
                else:
                    x, y = mine[len(mine) - 1 - lo], mine[len(mine) - 1 - hi]
                    self._shift(j, o, b)
                    self._shift(x, b, o)
                    self._shift(y, b, o)
                    return True
        return False

    def search(self) -> None:
        """Empties the least filled bins by steps that each raise the sum of squared fills, until no two bins have one.

        Each bin is tried with every fuller one, the fullest first, and again once either has changed. Left out are only partners
        that can't have a step: those whose items are no smaller than the bin's and whose room is less than the bin's smallest.
        """
        sizes, cap = self.sizes, self.capacity
        fill = np.array(self.fill, np.int64)
        low = np.array([min((sizes[i] for i in x), default=0) for x in self.items], np.int64)
        high = np.array([max((sizes[i] for i in x), default=0) for x in self.items], np.int64)
        changed, searched, now = np.zeros(fill.size, np.int64), np.full(fill.size, -1, np.int64), 0

        def step(b: int) -> int:
            """The partner of a step taken, or -1."""
            can = (fill >= fill[b]) & (fill < cap) & ((low < high[b]) | (cap - fill >= low[b]))
            if changed[b] <= searched[b]:
                can &= changed > searched[b]
            can[b] = False
            others = np.flatnonzero(can)
            return next((o for o in others[np.argsort(-fill[others], kind="stable")].tolist() if self._give(b, o)), -1)

        before = -1
        while before != now:  # what was searched in vain may have a step with a bin that changed later
            before = now
            queue = [(f, x) for x, f in enumerate(self.fill) if 0 < f < cap]
            heapq.heapify(queue)
            while queue:
                f, b = heapq.heappop(queue)
                if f != self.fill[b]:
                    continue
                o = step(b)
                if o < 0:
                    searched[b] = now
                    continue
                now += 1
                for x in (b, o):
                    fill[x], changed[x] = self.fill[x], now
                    low[x] = min((sizes[i] for i in self.items[x]), default=0)
                    high[x] = max((sizes[i] for i in self.items[x]), default=0)
                    if 0 < self.fill[x] < cap:
                        heapq.heappush(queue, (self.fill[x], x))

    def places(self) -> tuple[np.ndarray, np.ndarray]:
        """The bin and the offset of each item."""
        of, at = np.zeros(len(self.sizes), np.int64), np.zeros(len(self.sizes), np.int64)
        for b, items in enumerate(self.items):
            end = 0
            for i in items:
                of[i], at[i] = b, end
                end += self.sizes[i]
        return of, at


def pack(rows: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """rows (with doc_id, piece, length), each with sequence_id long and offset long. rows is read twice: cut it before."""
    (group,) = common.free_name(rows, "pack_group")
    groups = max(1, -(-rows.count() // group_pieces))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([c for c in ("doc_id", "piece") if c in pdf], kind="stable").reset_index(drop=True)
        bins = Bins(pdf["length"].to_numpy(), capacity)
        bins.search()
        of, at = bins.places()
        return pdf.assign(sequence_id=of + (pdf[group].to_numpy().astype(np.int64) << 32), offset=at).drop(columns=group)

    dealt = rows.withColumn(group, F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)))
    return dealt.groupBy(group).applyInPandas(run, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    return pack(common.cut(pieces(docs, vocabulary, capacity)), capacity)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(common.read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES = {"op1_packing": op1_packing}
ORACLES: dict[str, str] = {}
