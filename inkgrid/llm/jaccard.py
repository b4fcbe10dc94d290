"""Exact Jaccard self-join of documents on word shingles, with set-relation skipping.

1. Screen. A document with a partner at 4/5 shares 4/5 of its own shingles with others. Shingles are dealt by
   hash range in arrays (32 bits each within their range; a rare false match only keeps a document longer), each
   range counts in how many rows they occur, and documents with too few shared ones are done: no links. Each document
   is also told which of its shingles are frequent, and in what power of two of rows.
2. Equal sets become one, a node with a number of its own; a row of the smallest doc_id stands for them.
3. Near groups. Sets that agree in one of GROUP_KEYS minima meet and are compared one after another. A set joined
   to a leader is not compared with the leader's other partners; where it isn't joined, the overlap with each of
   them is first bounded by the leader's known overlap, plus their difference (answer-level skipping).
4. The rest. Any two linked sets share an element of their prefixes (the first fifth, the rarest first, then by hash), so
   that what many documents share is in the prefixes of few. Prefixes are
   dealt by hash range; each list is ordered by size and read in blocks, which are skipped whole when their best
   position leaves too little room for the needed overlap (index-level skipping). Bitmaps of the sets bound from
   below in how many elements two sets differ. Pairs inside one component are no longer needed. The others are all verified, the most promising of each set first.
Components are built from verified links alone, so they are those of all links.

There is a result for each row, also of repeated ids and of none: rows are known by id and a hash of their text. Nulls: null and
empty texts have the empty set and link with nothing; a null doc_id is no id, so a component's smallest id is that of its
rows with one, null if it has none. Ties don't matter. An empty table gives an empty result. Other columns are not read
(one_of_each keeps them). A very long text is one set in memory; nothing else grows with a text's length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common, graphs, shingles, tokens

#: Shingles of a block that is dealt at once, and of a hash range, about. Many ranges make larger blocks, so that a block has LEAST shingles in each.
BLOCK, RANGE, MOST_BITS, LEAST = 600_000, 900_000, 18, 64
CHARS_PER_WORD = 5
#: Prefix elements of a task, about.
PREFIX_RANGE = 100_000
#: Shingles in 2 ** FREQUENT rows or more are frequent.
FREQUENT = 6
GROUP_KEYS = 2
GROUP_ROWS = 1500
INDEX_BLOCK = 64
HELD_PAIRS = 500_000
FIRST_TRIES = 3


def least_overlap(n: int | np.ndarray, m: int | np.ndarray):
    """The smallest overlap of linked sets of n and m elements: 100 I >= 80 (n + m - I)."""
    return -(-80 * (n + m) // 180)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc"), _text_key(text).alias("key"), text.alias("text"))


def _text_key(text: Column) -> Column:
    return F.xxhash64(common.whole(text), F.length(common.whole(text)))


_PARTS = "part long, block long, docs binary, counts binary, hashes binary, levels binary"
_PART_COLUMNS = [x.split()[0] for x in _PARTS.split(", ")]


def _cut(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The ranges of hashes, and 32 bits of each within its range."""
    part = h >> np.uint64(64 - bits) if bits else np.zeros_like(h)
    return part, ((h << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)


def _deal(bits: int):
    """Blocks of sets, cut by the first bits of the hashes: a row a range and block. Below 0: the block's rows, their sets' sizes and names."""

    def rows(block: int, ids: list[tuple], sets: list[np.ndarray]) -> Iterator[tuple]:
        sizes = np.array([s.size for s in sets], np.int32)
        names = "".join(xxhash.xxh128_hexdigest(s.tobytes()) for s in sets).encode()
        known = np.array([(0 if i is None or i != i else int(i), k, not (i is None or i != i)) for i, k in ids], np.int64).reshape(-1, 3)
        yield -1 - block, block, known.tobytes(), sizes.tobytes(), names, None
        h = np.concatenate(sets)
        at = np.repeat(np.arange(len(sets)), sizes)
        part, low = _cut(h, bits)
        part = part.astype(np.uint16 if bits <= 16 else np.uint32)
        order = np.argsort(part, kind="stable")
        at, part, low = at[order], part[order], low[order]
        cuts = np.searchsorted(part, np.arange(2**bits + 1))
        for p in range(2**bits):
            a, b = cuts[p], cuts[p + 1]
            if a < b:
                counts = np.bincount(at[a:b], minlength=len(sets))
                some = counts.nonzero()[0]
                yield p, block, some.astype(np.int32).tobytes(), counts[some].astype(np.int32).tobytes(), low[a:b].tobytes(), None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        tokens.forget()  # of an earlier stage in this worker
        block = TaskContext.get().partitionId() << 24
        ids, sets, total = [], [], 0
        for pdf in batches:
            for doc, key, text in zip(pdf["doc"].astype(object), pdf["key"], pdf["text"], strict=True):
                ids.append((doc, key))
                sets.append(shingles.shingle_set(text))
                total += sets[-1].size + 1
                if total >= max(BLOCK, LEAST << bits):
                    yield pd.DataFrame(rows(block, ids, sets), columns=_PART_COLUMNS)
                    ids, sets, total, block = [], [], 0, block + 1
        if ids:
            yield pd.DataFrame(rows(block, ids, sets), columns=_PART_COLUMNS)
        shingles.forget()

    return run


def _shared(pdf: pd.DataFrame) -> pd.DataFrame:
    """For a range: of each block's rows that have some there, how many shingles others have too, and the frequent ones with their levels.
    What blocks tell of themselves passes."""
    if pdf["part"].iloc[0] < 0:
        return pdf
    counts = [np.frombuffer(x, np.int32) for x in pdf["counts"]]
    sizes = np.array([c.size for c in counts])
    h = np.concatenate([np.frombuffer(x, np.uint32) for x in pdf["hashes"]])
    at = np.repeat(np.arange(sizes.sum(), dtype=np.int32), np.concatenate(counts))
    order = np.argsort(h)
    h, at = h[order], at[order]
    edges = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1], [True]]))
    often = np.diff(edges)
    shared = np.bincount(at[np.repeat(often > 1, often)], minlength=sizes.sum()).astype(np.int32)
    level = np.repeat(np.maximum(0, np.frexp(often)[1] - FREQUENT).astype(np.uint8), often)
    hot = np.flatnonzero(level)
    hot = hot[np.argsort(at[hot], kind="stable")]
    cuts = np.cumsum(sizes)[:-1]
    told, spots = np.split(shared, cuts), np.searchsorted(at[hot], np.concatenate([[0], cuts, [sizes.sum()]]))
    out = []
    for i, (x, n) in enumerate(zip(pdf["docs"], told, strict=True)):
        mine, docs = hot[spots[i] : spots[i + 1]], np.frombuffer(x, np.int32)
        first = int(cuts[i - 1]) if i else 0
        out.append((docs[n > 0].tobytes(), n[n > 0].tobytes(), docs[at[mine] - first].tobytes() + h[mine].tobytes(), level[mine].tobytes()))
    return pdf[["part", "block"]].assign(**dict(zip(_PART_COLUMNS[2:], map(list, zip(*out, strict=True)), strict=True)))


_SCREENED = "doc long, key long, n long, name string, shared long, hot binary"


def _summed(pdf: pd.DataFrame) -> pd.DataFrame:
    """For a block: its rows with their sets' sizes and names, the sums of what the ranges told, and the frequent shingles of those that may have partners."""
    own = pdf[pdf["part"] < 0].iloc[0]
    known, sizes, names = np.frombuffer(own["docs"], np.int64).reshape(-1, 3), np.frombuffer(own["counts"], np.int32), own["hashes"].decode()
    shared = np.zeros(len(known), np.int64)
    told = pdf[pdf["part"] >= 0]
    for at, n in zip(told["docs"], told["counts"], strict=True):
        shared[np.frombuffer(at, np.int32)] += np.frombuffer(n, np.int32)
    able = 5 * shared >= 4 * sizes
    each = [(np.frombuffer(x, np.int32, len(y)), np.uint64(p) << np.uint64(32) | np.frombuffer(x, np.uint32, len(y), 4 * len(y)).astype(np.uint64), np.frombuffer(y, np.uint8)) for p, x, y in zip(told["part"], told["hashes"], told["levels"], strict=True)]
    at, keys, levels = (np.concatenate([np.zeros(0, kind), *(e[i] for e in each)]) for i, kind in enumerate((np.int32, np.uint64, np.uint8)))
    some = np.flatnonzero(able[at])
    some = some[np.argsort(at[some], kind="stable")]
    cuts = np.searchsorted(at[some], np.arange(len(known) + 1))
    keys, levels = keys[some].astype("<u8"), levels[some]
    frequent = [(keys[a:b].tobytes() + levels[a:b].tobytes()) or None for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    docs = pd.array(known[:, 0], "Int64")
    docs[known[:, 2] == 0] = pd.NA
    return pd.DataFrame({"doc": docs, "key": known[:, 1], "n": sizes.astype(np.int64), "name": [names[i : i + 32] for i in range(0, len(names), 32)], "shared": shared, "hot": frequent})


def screen(texts: DataFrame) -> tuple[DataFrame, int]:
    """A row for each of texts: doc, key, n, name (of its set), shared: how many of its shingles other rows have too, or slightly more; hot. Cut. And the bits of a range."""
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(MOST_BITS, max(0, int(total / CHARS_PER_WORD / RANGE).bit_length()))
    counted = texts.mapInPandas(_deal(bits), _PARTS).groupBy("part").applyInPandas(_shared, _PARTS)
    return common.cut(counted.groupBy("block").applyInPandas(_summed, _SCREENED)), bits


def prefix(s: np.ndarray, hot: bytes | None, bits: int) -> np.ndarray:
    """The first fifth (and one more) of a set in the order of rarity: by level, then by hash."""
    take = s.size - (4 * s.size + 4) // 5 + 1
    if not hot:
        return s[:take]
    n = len(hot) // 9
    keys, levels = np.frombuffer(hot, "<u8", n), np.frombuffer(hot, np.uint8, n, 8 * n)
    order = np.argsort(keys)
    keys, levels = keys[order], levels[order]
    part, low = _cut(s, bits)
    mine = (part << np.uint64(32)) | low.astype(np.uint64)
    at = np.minimum(np.searchsorted(keys, mine), n - 1)
    level = np.where(keys[at] == mine, levels[at], 0)
    return s[np.lexsort((s, level))[:take]]


def _sets(bits: int):
    """The sets, with GROUP_KEYS minima under different orders, and their prefixes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for node, hot, text in zip(pdf["node"], pdf["hot"], pdf["text"], strict=True):
                s = shingles.shingle_set(text)
                keys = [int((s if not k else shingles.mixed(s * np.uint64(2 * k + 1))).min().astype(np.int64)) for k in range(GROUP_KEYS)]
                rows.append((node, s.size, keys, s.tobytes(), prefix(s, hot, bits).tobytes()))
            yield pd.DataFrame(rows, columns=["doc", "n", "keys", "set", "prefix"])
        shingles.forget()

    return run


def _linked(n: int, m: int, both: int) -> bool:
    return 180 * both >= 80 * (n + m)


def _near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links that join the sets of each group, as many as joining them takes."""
    for group in common.runs(batches, "key", "salt"):
        if len(group) < 2:
            continue
        group = group.sort_values(["n", "doc"])
        docs, sizes, sets = group["doc"].tolist(), group["n"].tolist(), [np.frombuffer(x, np.uint64) for x in group["set"]]
        joined: list[list[tuple[int, int]]] = []  # each: leader, then members, with their overlap with the leader
        links = []
        for i, s in enumerate(sets):
            home = None
            for c, members in enumerate(joined):
                lead, _ = members[0]
                both = shingles.common_count(s, sets[lead]) if 4 * sizes[i] <= 5 * sizes[members[-1][0]] else -1
                if both < 0:
                    continue  # its largest member is too small
                hit = lead if _linked(sizes[i], sizes[lead], both) else None
                if hit is None:
                    for j, with_lead in members[1:]:
                        if both + sizes[j] - with_lead < least_overlap(sizes[i], sizes[j]):
                            continue  # even if all that j has beyond the leader were in s
                        if _linked(sizes[i], sizes[j], shingles.common_count(s, sets[j])):
                            hit = j
                            break
                if hit is not None:
                    links.append((docs[i], docs[hit]))
                    if home is None:
                        home = c
                        members.append((i, both))
            if home is None:
                joined.append([(i, sizes[i])])
        yield pd.DataFrame(links, columns=["a", "b"])


def _level(n: int | np.ndarray):
    """log2 of the bits of a set's bitmap: twice its size or more, 64 at least."""
    return np.maximum(6, np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64) + 1)


def bitmap(s: np.ndarray, level: int) -> np.ndarray:
    """Parities of how many elements fall on each bit. Sets differ in at least as many elements as their bitmaps do in bits."""
    odd = np.bincount((s & np.uint64(2**level - 1)).astype(np.int64), minlength=2**level) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<u8")


def folded(b: np.ndarray) -> np.ndarray:
    """The bitmap of the level below."""
    return b[: b.size // 2] ^ b[b.size // 2 :] if b.size > 1 else b ^ (b >> np.uint64(32))


_DEALT = "part int, doc binary, component binary, n binary, bitmaps binary, at binary, pos binary, h binary"


def _prefixes(bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            n, doc, comp = (pdf[k].to_numpy(np.int64) for k in ("n", "doc", "component"))
            sets = [np.frombuffer(x, np.uint64) for x in pdf["set"]]
            maps = [bitmap(s, k) for s, k in zip(sets, _level(n), strict=True)]
            firsts = [np.frombuffer(x, np.uint64) for x in pdf["prefix"]]
            take = np.array([x.size for x in firsts])
            h = np.concatenate(firsts)
            pos = (np.arange(h.size) - np.repeat(np.cumsum(take) - take, take)).astype(np.int32)
            at = np.repeat(np.arange(n.size), take)
            part = (h >> np.uint64(64 - bits)).astype(np.int32) if bits else np.zeros(h.size, np.int32)
            order = np.argsort(part, kind="stable")
            part = part[order]
            starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            rows = []
            for a, b in zip(starts, [*starts[1:], h.size], strict=True):
                here = order[a:b]
                some, local = np.unique(at[here], return_inverse=True)
                rows.append((int(part[a]), doc[some].tobytes(), comp[some].tobytes(), n[some].tobytes(), b"".join(maps[i].tobytes() for i in some), local.astype(np.int32).tobytes(), pos[here].tobytes(), h[here].tobytes()))
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in _DEALT.split(", ")])

    return run


class _Bitmaps:
    """Bitmaps of many sets, each at its own level and folded to the one below."""

    def __init__(self, n: np.ndarray, maps: list[np.ndarray]) -> None:
        self.level = _level(n)
        self.table, self.row = {}, {}
        for k in np.unique(self.level):
            rows = np.flatnonzero((self.level == k) | (self.level == k + 1))
            self.table[k] = np.stack([maps[i] if self.level[i] == k else folded(maps[i]) for i in rows])
            self.row[k] = np.full(n.size, -1, np.int64)
            self.row[k][rows] = np.arange(rows.size)

    def differ(self, i: int, others: np.ndarray) -> np.ndarray:
        """A lower bound on how many elements set i and each of the others, which are as large or a quarter larger, don't share."""
        k = self.level[i]
        table, row = self.table[k], self.row[k]
        return np.bitwise_count(table[row[others]] ^ table[row[i]]).sum(1, dtype=np.int64)


def _unique_pairs(out: list[np.ndarray], hits: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    pairs, back = np.unique(np.concatenate(out), axis=0, return_inverse=True)
    return [pairs], [np.bincount(back.ravel(), weights=np.concatenate(hits), minlength=len(pairs)).astype(np.int64)]


def _pairs(pdf: pd.DataFrame) -> pd.DataFrame:
    """Pairs of different components that share a prefix element and can overlap enough, each with how often it was found."""
    doc, component, size = (np.concatenate([np.frombuffer(x, np.int64) for x in pdf[k]]) for k in ("doc", "component", "n"))
    widths = 2 ** _level(size) // 8
    raw = b"".join(pdf["bitmaps"])
    ends = np.cumsum(widths)
    maps = _Bitmaps(size, [np.frombuffer(raw, "<u8", w // 8, e - w) for w, e in zip(widths, ends, strict=True)])
    counts = [len(x) // 8 for x in pdf["doc"]]
    at = np.concatenate([np.frombuffer(x, np.int32) + base for x, base in zip(pdf["at"], np.cumsum(counts) - counts, strict=True)])
    pos, h = np.concatenate([np.frombuffer(x, np.int32) for x in pdf["pos"]]).astype(np.int64), np.concatenate([np.frombuffer(x, np.uint64) for x in pdf["h"]])
    order = np.lexsort((size[at], h))
    at, pos, h = at[order], pos[order], h[order]
    edge = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1], [True]]))
    out, hits, held = [np.zeros((0, 2), np.int64)], [np.zeros(0, np.int64)], 0
    low, high = np.minimum.reduceat(component[at], edge[:-1]), np.maximum.reduceat(component[at], edge[:-1])
    for g in np.flatnonzero(low != high):
        a, b = edge[g], edge[g + 1]
        own, n, p = at[a:b], size[at[a:b]], pos[a:b]
        comp, rest = component[own], n - p - 1
        blocks = np.arange(0, n.size, INDEX_BLOCK)
        top_pos, top_rest = np.maximum.reduceat(p, blocks), np.maximum.reduceat(rest, blocks)
        for i in range(n.size - 1):
            end = int(np.searchsorted(n, 5 * n[i] // 4, side="right"))
            for k in range((i + 1) // INDEX_BLOCK, -(-end // INDEX_BLOCK)):
                x, y = max(i + 1, k * INDEX_BLOCK), min(end, (k + 1) * INDEX_BLOCK)
                if x >= y or min(p[i], top_pos[k]) + 1 + min(rest[i], top_rest[k]) < least_overlap(n[i], n[x]):
                    continue
                room = np.minimum(p[i], p[x:y]) + 1 + np.minimum(rest[i], rest[x:y])
                hit = x + np.flatnonzero((room >= least_overlap(n[i], n[x:y])) & (comp[x:y] != comp[i]))
                if hit.size:
                    hit = hit[maps.differ(own[i], own[hit]) <= n[i] + n[hit] - 2 * least_overlap(n[i], n[hit])]
                    mine, other = doc[own[i]], doc[own[hit]]
                    out.append(np.stack([np.minimum(mine, other), np.maximum(mine, other)], 1))
                    hits.append(np.ones(hit.size, np.int64))
                    held += hit.size
                    if held > HELD_PAIRS:
                        out, hits = _unique_pairs(out, hits)
                        held = len(out[0]) // 2
    (pairs,), (hits,) = _unique_pairs(out, hits)
    return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1], "hits": hits})


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        keep = [_linked(len(x) // 8, len(y) // 8, shingles.common_count(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64))) for x, y in zip(pdf["x"], pdf["y"], strict=True)]
        yield pdf.loc[np.array(keep, bool), ["a", "b"]]


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are links."""
    with_a = pairs.select("a", "b").join(sets.select(F.col("doc").alias("a"), F.col("set").alias("x")), "a")
    both = with_a.join(sets.select(F.col("doc").alias("b"), F.col("set").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInPandas(_verify, "a long, b long")


def _relabelled(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """pairs with ca, cb, the components as they are now; pairs inside one are gone."""
    for side in "ab":
        now = comps.select(F.col("node").alias(side), F.col("component").alias(f"__c{side}"))
        pairs = pairs.join(now, side, "left").withColumn(f"c{side}", F.coalesce(f"__c{side}", side)).drop(f"__c{side}")
    return pairs.where("ca <> cb")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row for each of docs: doc, key, n, and first, the (doc, key) that stands for its component; null for an empty set."""
    texts = _texts(docs, id_col, text_col)
    each, bits = screen(texts)
    real = each.where("n > 0")
    lead = F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "key"))
    names = common.cut(real.groupBy("name").agg(F.max("n").alias("n"), F.max("shared").alias("shared"), lead.alias("first"), F.max("hot").alias("hot"), F.count("*").alias("rows")))
    able = names.where("5 * shared >= 4 * n").withColumn("node", F.monotonically_increasing_id())
    able = common.cut(able.select("node", "name", "first", "hot"))
    wanted = able.select(F.col("first.doc").alias("__doc"), F.col("first.key").alias("__key"), "node")
    found = texts.join(common.sent(wanted), F.col("doc").eqNullSafe(F.col("__doc")) & (F.col("key") == F.col("__key"))).select("node", "text")
    if real.groupBy("doc", "key").agg(F.count("*").alias("k")).where("k > 1").head(1):
        found = found.dropDuplicates(["node"])  # repeated rows of one id and text
    found = found.join(able.select("node", "hot"), "node")
    sets, sets_path = common.written(found.mapInPandas(_sets(bits), "doc long, n int, keys array<long>, set binary, prefix binary"))
    comps = _components(sets)
    common.removed(docs.sparkSession, sets_path)
    labelled = able.join(common.sent(comps), F.col("node") == F.col("of"), "left").select("name", "first", F.coalesce("component", "node").alias("component"))
    least = common.cut(labelled.groupBy("component").agg(F.min("first").alias("first"), F.count("*").alias("sets")).where("sets > 1").select("component", F.col("first").alias("least")))
    moved = common.cut(labelled.join(common.sent(least), "component").select("name", "least"))
    firsts = names.select("name", "first").join(common.sent(moved), "name", "left").select("name", F.coalesce("least", "first").alias("first"))
    return each.select("doc", "key", "n", "name").join(firsts, "name", "left").select("doc", "key", "n", "first")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, n_shingles, component of every row."""
    rows = _rows(docs, id_col, text_col)
    return rows.select("doc", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("first.doc")).otherwise(F.col("doc")).alias("component"))


def _components(sets: DataFrame) -> DataFrame:
    """of, component: the smallest node of each node that has a smaller one."""
    keys = sets.select("doc", F.explode(F.array_distinct("keys")).alias("key"))
    groups = keys.groupBy("key").agg(F.count("*").alias("size"), F.min("doc").alias("lead")).where("size > 1")
    groups = groups.withColumn("parts", F.ceil(F.col("size") / GROUP_ROWS).cast("int"))
    own = F.array(F.pmod(F.xxhash64("doc"), F.col("parts")).cast("int"))
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    members = keys.join(groups, "key").select("doc", "key", F.explode(F.when(F.col("doc") == F.col("lead"), every).otherwise(own)).alias("salt"))
    met = members.join(sets.select("doc", "n", "set"), "doc")
    met = met.repartition("key", "salt").sortWithinPartitions("key", "salt").mapInPandas(_near, "a long, b long")
    links = common.cut(met.distinct())
    comps = graphs.components(links)

    labelled = sets.select("doc", "n", "set", "prefix").join(common.sent(comps.select(F.col("node").alias("doc"), "component")), "doc", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "doc"))
    n_prefix = (sets.agg(F.sum("n")).first()[0] or 0) // 5
    bits = min(MOST_BITS, max(0, int(n_prefix / PREFIX_RANGE).bit_length()))
    dealt = labelled.mapInPandas(_prefixes(bits), _DEALT)
    pairs = dealt.groupBy("part").applyInPandas(_pairs, "a long, b long, hits long").groupBy("a", "b").agg(F.sum("hits").alias("hits"))
    pairs = common.cut(pairs)
    if pairs.head(1):
        first = _relabelled(pairs, comps)
        rank = lambda mine, other: F.row_number().over(Window.partitionBy(mine, other).orderBy(F.col("hits").desc(), "a", "b"))
        first = first.withColumn("ra", rank("a", "cb")).withColumn("rb", rank("b", "ca")).where(f"ra <= {FIRST_TRIES} or rb <= {FIRST_TRIES}")
        tried = common.cut(first.select("a", "b"))
        links = common.cut(links.union(verified(tried, sets)))
        comps = graphs.components(links)
        rest = common.cut(_relabelled(pairs.join(tried, ["a", "b"], "left_anti"), comps).select("a", "b"))
        if rest.head(1):
            links = common.cut(links.union(verified(rest, sets)))
            comps = graphs.components(links)

    return comps.select(F.col("node").alias("of"), "component")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs, of each group of linked ones the row of the smallest id alone (of rows of one id, that of the smallest hash of its text)."""
    rows = common.cut(_rows(docs, id_col, text_col).where("n > 0"))
    gone = rows.where("not (doc <=> first.doc and key = first.key)").select(F.col("doc").alias("__doc"), F.col("key").alias("__key")).distinct()
    (mark,) = common.free_name(docs, "text_key")
    key = F.col(id_col).cast("long")
    kept = docs.withColumn(mark, _text_key(F.col(text_col).cast("string"))).join(common.sent(common.cut(gone)), key.eqNullSafe(F.col("__doc")) & (F.col(mark) == F.col("__key")), "left_anti")
    again = common.cut(rows.groupBy("doc", "key").agg(F.count("*").alias("k")).where("k > 1").select(F.col("doc").alias("__doc"), F.col("key").alias("__key")))
    if again.head(1):  # repeated rows of one id and text
        same = key.eqNullSafe(F.col("__doc")) & (F.col(mark) == F.col("__key"))
        once = kept.join(common.sent(again), same, "left_semi").dropDuplicates([id_col, mark])
        kept = kept.join(common.sent(again), same, "left_anti").unionByName(once)
    return kept.select(*docs.columns)


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(common.read(spark, sf_dir, "documents")).select(F.col("doc").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


QUERIES = {"op9_jaccard": op9_jaccard}
#: The same rows in DuckDB: every pair that shares a shingle, and what links reach.
ORACLES = {
    "op9_jaccard": r"""
with recursive w as (select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (select distinct doc_id, unnest(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as g from w),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b using (g) where a.doc_id < b.doc_id group by all),
e as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 80 * (x.n + y.n - k)),
l as (select a, b from e union all select b, a from e),
r as (select doc_id, doc_id as c from documents union select r.doc_id, l.b from r join l on l.a = r.c)
select r.doc_id, coalesce(any_value(n.n), 0)::bigint as n_shingles, min(r.c) as component_id from r left join n using (doc_id) group by r.doc_id
"""
}
