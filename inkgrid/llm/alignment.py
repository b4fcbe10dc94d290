"""Alignment of the tokens of two vocabularies over the same bytes, and how often their ids stand together in the corpus.

Transducer. Reading a token of either side appends its bytes to that side. Of the two strings one is a prefix of the other, so a state is which
side leads and the bytes by which it does, its dangling suffix; the next token is always one of the side behind. A state remembers where
each token led, so bytes are compared once a residual and token, and a text is two lookups a pair of tokens. Where the residual is empty both
sides have a token's end, and a group closes: what was read since the last such place.

Counts. Tasks cut their texts into blocks of about BLOCK tokens. A block numbers the id pairs that its groups link, and keeps as sparse rows
which pairs each text holds, and how often. Blocks are written once; texts and tokens are not seen again. Every block's pairs, each with the
number of its texts, are added up by pair (a frequent pair comes once a block), the highest count of each first id is found (a row an
id of the vocabulary), and each block's pairs are told their counts. A block and its answers meet in one task.

What a task holds: one block with its pairs, or one text. A block keeps the paths that groups took through the transducer, each
token a step, so a group that was seen before is known by number where its path ends. A block is closed at MOST_GROUPS groups too.

Nulls: a null or empty text has no tokens, nor has a text that either vocabulary doesn't give back byte by byte: its numbers are 0 and its
groups are ''. A null doc_id stays null. Rows stay rows; repeated ones are documents of their own, each counted. An empty table gives an
empty result. Other columns are not read. A very long text is a block of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, tokens

#: Tokens and groups of a block, of the first vocabulary, about. States with their transitions that a worker keeps.
BLOCK, MOST_GROUPS, KNOWN_STATES = 1_500_000, 200_000, 200_000
#: Of the words whose ids a worker keeps.
KNOWN_BYTES = 40_000_000


class State(dict):
    """Which side leads (0: neither) and its unmatched bytes; of each next token of the side behind, the state it leads to."""

    __slots__ = ("lead", "of", "residual")

    def __init__(self, of: Transducer, lead: int, residual: bytes) -> None:
        self.of, self.lead, self.residual = of, lead, residual

    def __missing__(self, token: int) -> State:
        to = self[token] = self.of.after(self, token)
        return to


class Transducer:
    """first, second: bytes of the tokens of either vocabulary, by id."""

    def __init__(self, first: list[bytes], second: list[bytes]) -> None:
        self.vocabularies = first, second
        self.forget()

    def forget(self) -> None:
        self.known: dict[tuple[int, bytes], State] = {}
        self.start = self.state(0, b"")

    def state(self, lead: int, residual: bytes) -> State:
        if not residual:
            lead = 0
        key = lead, residual
        if key not in self.known:
            self.known[key] = State(self, lead, residual)
        return self.known[key]

    def after(self, state: State, token: int) -> State:
        """With neither side ahead the first side reads."""
        side = 1 if state.lead == 1 else 0
        said, ahead = self.vocabularies[side][token], state.residual
        if len(said) <= len(ahead) and ahead.startswith(said):
            return self.state(state.lead, ahead[len(said) :])
        if said.startswith(ahead):
            return self.state(side + 1, said[len(ahead) :])
        raise ValueError("the sides' bytes differ")

    def tidy(self) -> None:
        """Between texts: starts anew where there are too many states."""
        if len(self.known) > KNOWN_STATES:
            self.forget()


def byte_level_vocabulary(path: str) -> list[bytes]:
    table = tokens.decoder(path).table
    return [table.get(i, b"") for i in range(max(table, default=-1) + 1)]


def piece_vocabulary(processor) -> list[bytes]:
    """Pieces in UTF-8, U+2581 as a space, <0xHH> as the byte HH."""
    pieces = [processor.id_to_piece(i) for i in range(processor.get_piece_size())]
    return [bytes([int(p[3:5], 16)]) if processor.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]


#: How a byte-level vocabulary of this family cuts a text before its merges.
CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Aligner:
    """Token ids and groups of texts, by a byte-level vocabulary of tokenizers and one of sentencepiece, which puts a space before a text.

    Texts of ASCII and Latin letters, on whose classes of characters all libraries agree, are cut and merged by tiktoken with the first
    vocabulary's own ranks, for speed; all others by the library that the file is of.
    """

    def __init__(self, first: str, second: str) -> None:
        import sentencepiece
        import tiktoken

        self.encoder = tokens.Encoder(first, specials_as_text=True, known_bytes=KNOWN_BYTES)
        self.processor = sentencepiece.SentencePieceProcessor(model_file=second)
        self.bytes = byte_level_vocabulary(first), piece_vocabulary(self.processor)
        special = {i for i, x in self.encoder.tokenizer.get_added_tokens_decoder().items()}
        ranks = {b: i for i, b in enumerate(self.bytes[0]) if b and i not in special}
        self.plain = tiktoken.Encoding("plain", pat_str=CUT, mergeable_ranks=ranks, special_tokens={})
        self.transducer = Transducer(*self.bytes)

    def forget(self) -> None:
        """Frees what this worker knows of words and residuals, at the end of a task."""
        self.encoder.forget()
        self.transducer.forget()

    def firsts(self, texts: list[str]) -> Iterator[list[int]]:
        """The ids of texts with a space before them, by the first vocabulary."""
        odd = [t for t in texts if not tokens.is_plain(t)]
        of_odd = iter(self.encoder.encode([" " + t for t in odd]))
        for t in texts:
            yield self.plain.encode_ordinary(" " + t) if tokens.is_plain(t) else next(of_odd).tolist()

    def encode(self, texts: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """The ids of either side; none where a text is empty or the first side's bytes are others than a space and the text. That the second
        side's are the same is seen when they are aligned."""
        first = self.bytes[0].__getitem__
        for text, a, b in zip(texts, self.firsts(texts), self.processor.encode(texts, num_threads=1), strict=True):
            yield (a, b) if text and b"".join(map(first, a)) == b" " + text.encode() else ([], [])


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(first: str, second: str) -> Aligner:
    """The one Aligner of this process for two files."""
    if (first, second) not in _aligners:
        _aligners[first, second] = Aligner(first, second)
    return _aligners[first, second]


class Step(dict):
    """A place on the paths of groups: the state there, what was read since the last group's end, the steps from here by token, and,
    where a group ends, its number."""

    __slots__ = ("group", "groups", "lead", "read", "state")

    def __init__(self, groups: Groups, state: State, read: tuple[tuple[int, ...], tuple[int, ...]]) -> None:
        self.groups, self.state, self.read, self.lead = groups, state, read, state.lead
        self.group = groups.number(read) if state is groups.start and read != ((), ()) else -1

    def __missing__(self, token: int) -> Step:
        a, b = self.read
        to = self[token] = Step(self.groups, self.state[token], (a, (*b, token)) if self.lead == 1 else ((*a, token), b))
        return to


class Groups:
    """Groups of a block: how they're written, and the id pairs that they link, with repetitions."""

    def __init__(self, transducer: Transducer) -> None:
        self.start = transducer.start
        self.written: list[str] = []
        self.links: list[int] = []
        self.pairs: dict[tuple[int, int], int] = {}
        self.linked: list[int] = []
        self.root = Step(self, self.start, ((), ()))

    def number(self, ids: tuple[tuple[int, ...], tuple[int, ...]]) -> int:
        a, b = ids
        self.written.append(",".join(map(str, a)) + "|" + ",".join(map(str, b)))
        self.links.append(len(a) * len(b))
        self.linked += [self.pairs.setdefault((x, y), len(self.pairs)) for x in a for y in b]
        return len(self.written) - 1

    def of(self, a: list[int], b: list[int]) -> list[int]:
        """The groups of a text in order, by number; ValueError where the sides' bytes differ."""
        root, of_a, of_b, out = self.root, iter(a), iter(b), []
        following = of_b.__next__
        try:
            for token in of_a:
                step = root[token]
                while step.group < 0:
                    step = step[following() if step.lead == 1 else next(of_a)]
                out.append(step.group)
        except StopIteration:
            raise ValueError("a side ends first") from None
        if next(of_b, None) is not None:
            raise ValueError("a side ends first")
        return out


ROWS = "block long, ids array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, digests array<string>, starts binary, pairs binary, times binary, pair_a binary, pair_b binary, n_docs binary"
_LISTS = ("ids", "n_a", "n_b", "n_groups", "n_links")
_BINARY = ("starts", "pairs", "times", "pair_a", "pair_b", "n_docs")
_SCHEMA = pa.schema([("block", pa.int64()), *((c, pa.list_(pa.int64())) for c in _LISTS), ("digests", pa.list_(pa.string())), *((c, pa.binary()) for c in _BINARY)])


def _expanded(starts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of all entries of some rows, of rows that start at `starts`, and how many each row has."""
    sizes = starts[rows + 1] - starts[rows]
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if ends.size else 0) + np.repeat(starts[rows] - ends + sizes, sizes), sizes


class Block:
    """Texts of a block: their numbers, and which id pairs each links."""

    def __init__(self, number: int, transducer: Transducer) -> None:
        transducer.tidy()
        self.number, self.groups, self.size = number, Groups(transducer), 0
        self.ids: list[int | None] = []
        self.n_a, self.n_b, self.digests, self.found = [], [], [], []

    def add(self, doc_id: int | None, a: list[int], b: list[int]) -> None:
        try:
            mine = self.groups.of(a, b)
        except ValueError:
            a, b, mine = [], [], []
        self.ids.append(doc_id)
        self.n_a.append(len(a))
        self.n_b.append(len(b))
        self.digests.append(hashlib.sha256(";".join(map(self.groups.written.__getitem__, mine)).encode()).hexdigest() if a else "")
        self.found.append(np.array(mine, np.int64))
        self.size += len(a) + 1

    @property
    def full(self) -> bool:
        return self.size >= BLOCK or len(self.groups.written) >= MOST_GROUPS

    def row(self) -> dict:
        g, n_docs = self.groups, len(self.ids)
        sizes = np.array([x.size for x in self.found], np.int64)
        of_group = np.array(g.links, np.int64)
        said, owner = np.concatenate(self.found) if self.found else np.zeros(0, np.int64), np.repeat(np.arange(n_docs), sizes)
        n_links = np.bincount(owner, of_group[said], minlength=n_docs).astype(np.int64)
        # each text's groups once, with how often; then their pairs once
        width = max(1, len(g.written))
        held, often = np.unique(owner * width + said, return_counts=True)
        places, spread = _expanded(np.concatenate([[0], np.cumsum(of_group)]), held % width)
        n_pairs = max(1, len(g.pairs))
        key, at = np.unique(np.repeat(held // width, spread) * n_pairs + np.array(g.linked, np.int64)[places], return_inverse=True)
        times = np.bincount(at, np.repeat(often, spread), minlength=key.size)
        pairs = key % n_pairs
        starts = np.searchsorted(key, np.arange(n_docs + 1) * n_pairs)
        ids = np.array(list(g.pairs), np.int64).reshape(-1, 2)
        return {
            "block": self.number, "ids": self.ids, "n_a": self.n_a, "n_b": self.n_b, "n_groups": sizes.tolist(), "n_links": n_links.tolist(), "digests": self.digests,
            "starts": starts.astype("<i8").tobytes(), "pairs": pairs.astype("<u4").tobytes(), "times": times.astype("<u4").tobytes(),
            "pair_a": ids[:, 0].astype("<u4").tobytes(), "pair_b": ids[:, 1].astype("<u4").tobytes(), "n_docs": np.bincount(pairs, minlength=len(g.pairs)).astype("<u4").tobytes(),
        }


def blocks(texts: Iterable[tuple[int | None, str | None]], found: Aligner, first: int = 0) -> Iterator[dict]:
    """Rows of ROWS, of the texts in their order, numbered from `first`."""
    block = Block(first, found.transducer)
    ids: list[int | None] = []

    def seen() -> Iterator[str | None]:
        for i, t in texts:
            ids.append(i)
            yield t

    for run in tokens.in_batches(seen()):
        for text_id, (a, b) in zip(ids[: len(run)], found.encode(run), strict=True):
            block.add(text_id, a, b)
            if block.full:
                yield block.row()
                block = Block(block.number + 1, found.transducer)
        del ids[: len(run)]
    if block.ids:
        yield block.row()


def _aligned(first: str, second: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        texts = (x for b in batches for x in zip(b.column("doc_id").to_pylist(), map(pa.StringScalar.as_py, b.column("text")), strict=True))
        found = aligner(first, second)
        for row in blocks(texts, found, TaskContext.get().partitionId() << 32):
            yield pa.RecordBatch.from_pylist([row], schema=_SCHEMA)
        found.forget()

    return run


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row a pair of a block: which, its two ids, and its texts there."""
    for b in batches:
        for r in b.to_pylist():
            a, other, n = (np.frombuffer(r[c], "<u4") for c in ("pair_a", "pair_b", "n_docs"))
            at = np.flatnonzero(n)  # a text that turned out not to align may have left pairs that no text has
            a, other, n = a[at], other[at], n[at]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(a.size, r["block"]), pa.int64()), pa.array(at.astype(np.int32)), pa.array(a.astype(np.int32)), pa.array(other.astype(np.int32)), pa.array(n.astype(np.int64))], ["block", "at", "a", "b", "n"])


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _told(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """A block and the counts of its pairs: the rows of its texts."""
    if not len(left):
        return pd.DataFrame(columns=[c.split()[0] for c in RESULT.split(", ")])
    r = left.iloc[0]
    at = right["at"].to_numpy()
    n, best = np.zeros((2, int(at.max(initial=-1)) + 1), np.int64)
    n[at], best[at] = right["count"].to_numpy(), right["best"].to_numpy()
    starts, pairs, times = np.frombuffer(r["starts"], "<i8"), np.frombuffer(r["pairs"], "<u4"), np.frombuffer(r["times"], "<u4").astype(np.int64)

    def by_text(x: np.ndarray) -> np.ndarray:
        so_far = np.concatenate([[0], np.cumsum(x[pairs] * times)])
        return so_far[starts[1:]] - so_far[starts[:-1]]

    out = pd.DataFrame({"doc_id": pd.array([None if i is None or i != i else int(i) for i in r["ids"]], "Int64"), **{c: r[c] for c in ("n_a", "n_b", "n_groups", "n_links")}})
    return out.assign(n_best=by_text(best), count_sum=by_text(n), groups_sha256=r["digests"])


def align(docs: DataFrame, first: str, second: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """A row a document as RESULT has it, and the id pairs of the corpus: a, b, count (documents that link them), best (whether none of a's is higher)."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kept, _ = common.written(texts.mapInArrow(_aligned(first, second), ROWS), compression="zstd")
    pairs = kept.select("block", "pair_a", "pair_b", "n_docs").mapInArrow(_pairs, "block long, at int, a int, b int, n long")
    counts, _ = common.written(pairs.groupBy("a", "b").agg(F.sum("n").alias("count")))
    highest = F.broadcast(counts.groupBy("a").agg(F.max("count").alias("highest")))  # a row an id of the first vocabulary at most
    linked = counts.join(highest, "a").select("a", "b", "count", (F.col("count") == F.col("highest")).alias("best"))
    answers = pairs.drop("n").join(linked, ["a", "b"]).select("block", "at", "count", F.col("best").cast("long").alias("best"))
    rows = kept.drop("pair_a", "pair_b", "n_docs").groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(_told, RESULT)
    return rows, linked


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return align(common.read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))[0]


QUERIES = {"op13_alignment": op13_alignment}
ORACLES: dict[str, str] = {}
