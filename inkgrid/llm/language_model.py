"""Language-model scores: a backoff model of ORDER words as a weighted automaton, learnt from the corpus itself.

Model. Tokens are words (ASCII capitals in lower case) and one end a text. Unigrams: (c + A) / (N + A (V + 1)).
An n-gram has a Dirichlet prior on the next shorter one: p(w|h) = (c(hw) + mu p(w|h')) / (c(h) + mu), h' being h without its
first word, mu the entry of MU for the length; sums over w are one. Long contexts have a small mu: one that was seen twice before the same word
says more than what its last word alone would. As an automaton: a state for each context of up to ORDER - 1 words of the training texts (a
text starts after an end; what would lie before it isn't context), and the root, of no words. A state's arc for a seen w weighs
log p(w|h) and leads to the longest known suffix of hw; its failure arc leads to the state of h' and weighs log mu / (c(h) + mu),
and is followed until a state has an arc for w (the root has one for every word). Texts are walked from left to right, all
tokens of a block at once: each step of the walk is one array operation for those that still fail. c(h) counts h in the training texts, ends of texts
included as the start of the next context.

Distribution. The model is never gathered anywhere: blocks of texts send the sorted hashes of their own n-grams
(40 bits within a hash range) with their training counts to the ranges' tasks, each of which adds the counts up and
answers every block with the totals of its n-grams. A block's texts travel beside, compressed. So each n-gram is
counted over all texts, frequent ones come once a block, and a task holds one range or one block.

Nulls: a null text is empty and has its end token; a null doc_id hashes as the empty text. Rows stay rows, repeated ones too, each
counted. An empty table gives an empty result. Other columns are not read. A very long text is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, shingles

A = 0.1
#: By the words of a context; chosen on training texts alone (README): learnt from nine tenths of them, by the log-probability of the last tenth.
MU = {1: 4096.0, 2: 4.0}
#: Words of the longest n-grams that op7_language_model asks for.
ORDER = 3
#: Tokens of a block and n-grams of a range, about. Many ranges make larger blocks, so that a block has LEAST n-grams in each.
BLOCK, RANGE, MOST_BITS, LEAST = 1_100_000, 3_000_000, 18, 64
CHARS_PER_TOKEN = 6
#: Tokens that are walked at a time.
STEP = 200_000
NGRAMS_PER_TOKEN = {2: 1.1, 3: 1.8}
_END = np.uint64(0x5EED0000000000E2)
_TAGS = {1: np.uint64(3), 2: np.uint64(7), 3: np.uint64(11)}
_LOW = np.uint64(2**40 - 1)


class Block:
    """The tokens of some texts and their distinct n-grams, in the order of hash ranges."""

    def __init__(self, texts: list[bytes], bits: int, order: int = 2) -> None:
        each = [shingles.word_hashes(t.decode("utf-8", "surrogatepass")) for t in texts]
        self.sizes = np.array([x.size + 1 for x in each], np.int64)  # with the end token
        ends = np.cumsum(self.sizes) - 1
        tokens = np.full(int(self.sizes.sum()), _END, np.uint64)
        is_word = np.ones(tokens.size, bool)
        is_word[ends] = False
        if each:
            tokens[is_word] = np.concatenate(each)
        # The word before a text is an end; at its first word no context is longer, so longer n-grams there are the pair itself.
        back = [tokens]
        for _ in range(order - 1):
            back.insert(0, np.concatenate([[_END], back[0][:-1]]))
        starts = np.cumsum(self.sizes) - self.sizes
        self.order, self.is_first = order, np.zeros(tokens.size, bool)
        self.is_first[starts] = True
        n = tokens.size
        key = np.empty(order * n, np.uint64)
        for k in range(1, order + 1):
            key[(k - 1) * n : k * n] = shingles.joined(back[order - k :], _TAGS[k])
        for k in range(2, order):
            key[k * n : (k + 1) * n][self.is_first] = key[n : 2 * n][self.is_first]
        # The range comes first, then the length: words 0, longer ones 1, 2; then 40 bits. n-grams of different lengths don't mix.
        low = key & _LOW
        key = key >> np.uint64(64 - bits) if bits else np.zeros_like(key)
        key <<= np.uint64(42)
        key |= low
        for k in range(1, order):
            key[k * n : (k + 1) * n] |= np.where(self.is_first, np.uint64(1), np.uint64(k)) << np.uint64(40)
        del each, tokens, back, is_word, low
        self._number(key)
        self.cuts = np.searchsorted(self.keys, np.arange(2**bits + 1, dtype=np.uint64) << np.uint64(42))

    def _number(self, key: np.ndarray) -> None:
        """keys: the distinct ones in order; at: where each one is among them. As np.unique, with places of 32 bits and no more copies than it takes."""
        order = np.argsort(key, kind="stable").astype(np.uint32)
        key = key[order]
        new = np.empty(key.size, bool)
        new[:1] = True
        np.not_equal(key[1:], key[:-1], out=new[1:])
        self.keys = key[new]
        self.at = np.empty(key.size, np.int32)
        self.at[order] = np.cumsum(new, dtype=np.int32) - 1

    @property
    def n_tokens(self) -> int:
        return int(self.sizes.sum())

    def of_docs(self, flags: np.ndarray) -> np.ndarray:
        """Counts of the n-grams in the flagged texts."""
        here = np.repeat(flags, self.sizes)
        said = np.concatenate([here, here, *(here & ~self.is_first for _ in range(2, self.order))])  # a pair counts once
        return np.bincount(self.at[said], minlength=self.keys.size)


def packed(x: np.ndarray) -> bytes:
    """Numbers, sorted ones as differences, by planes of bytes, compressed: low planes are noise and stay, high ones are nearly all alike."""
    rises = bool(x.size) and bool((x[1:] >= x[:-1]).all())
    steps = (np.diff(x, prepend=x.dtype.type(0)) if rises else x).astype("<u8")
    planes = max(1, -(-int(steps.max()).bit_length() // 8)) if steps.size else 1
    return bytes([rises, planes]) + zstandard.compress(steps.view(np.uint8).reshape(-1, 8)[:, :planes].T.tobytes(), 3)


def unpacked(b: bytes) -> np.ndarray:
    planes = b[1]
    raw = np.frombuffer(zstandard.decompress(b[2:]), np.uint8).reshape(planes, -1)
    x = np.zeros((raw.shape[1], 8), np.uint8)
    x[:, :planes] = raw.T
    x = x.reshape(-1).view("<u8").astype(np.uint64)
    return np.cumsum(x, dtype=np.uint64) if b[0] else x


_DEALT = "part long, block long, grams binary, counts binary, ids binary, has_id binary, train binary, lengths binary, body binary"
_COLUMNS = [x.split()[0] for x in _DEALT.split(", ")]


def _deal(bits: int, order: int = 2):
    def rows(block: int, ids: list, train: list[bool], texts: list[bytes]) -> Iterator[tuple]:
        b = Block(texts, bits, order)
        counts = b.of_docs(np.array(train, bool)).astype(np.uint64)
        none = [None] * 5
        for p in range(2**bits):
            x, y = b.cuts[p], b.cuts[p + 1]
            yield p, block, packed(b.keys[x:y] & np.uint64(2**42 - 1)), packed(counts[x:y]), *none
        known = [i is not None and i == i for i in ids]
        numbers = np.array([int(i) if k else 0 for i, k in zip(ids, known, strict=True)], np.int64)
        yield -1 - block, block, None, None, numbers.tobytes(), np.array(known).tobytes(), np.array(train, bool).tobytes(), np.array([len(t) for t in texts], np.int64).tobytes(), zstandard.compress(b"".join(texts), 3)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 24
        ids, train, texts, size = [], [], [], 0
        for pdf in batches:
            for i, t, text in zip(pdf["doc_id"].astype(object), pdf["train"], pdf["text"], strict=True):
                ids.append(i)
                train.append(bool(t))
                texts.append((text or "").encode("utf-8", "surrogatepass"))
                size += len(texts[-1]) + CHARS_PER_TOKEN
                if size >= max(BLOCK, LEAST << bits) * CHARS_PER_TOKEN:
                    yield pd.DataFrame(rows(block, ids, train, texts), columns=_COLUMNS)
                    block += 1
                    ids, train, texts, size = [], [], [], 0
        if ids:
            yield pd.DataFrame(rows(block, ids, train, texts), columns=_COLUMNS)
        shingles.forget()

    return run


_ANSWER = "block long, part long, counts binary, n long, v long, ids binary, has_id binary, train binary, lengths binary, body binary"


def _answer(pdf: pd.DataFrame) -> pd.DataFrame:
    """For a range: each block's n-grams' totals over all blocks, with the range's training tokens and distinct ones. Texts pass."""
    rest = ["ids", "has_id", "train", "lengths", "body"]
    if pdf["part"].iloc[0] < 0:
        return pdf.assign(n=0, v=0)[["block", "part", "counts", "n", "v", *rest]]
    pdf = pdf.sort_values("block", kind="stable")
    grams = [unpacked(x) for x in pdf["grams"]]
    sizes = np.array([g.size for g in grams])
    counts = np.concatenate([unpacked(x) for x in pdf["counts"]])
    every, at = np.unique(np.concatenate(grams), return_inverse=True)
    totals = np.bincount(at, weights=counts.astype(np.float64), minlength=every.size).astype(np.uint64)
    is_word = every < np.uint64(2**40)
    n, v = int(totals[is_word].sum()), int(np.count_nonzero(totals[is_word]))
    answers = np.split(totals[at], np.cumsum(sizes)[:-1])
    out = pdf[["block", "part"]].assign(counts=[packed(a) for a in answers], n=n, v=v)
    return out.assign(**dict.fromkeys(rest))[["block", "part", "counts", "n", "v", *rest]]


class Automaton:
    """The part of the model that a block's texts can reach."""

    def __init__(self, block: Block, totals: np.ndarray, n: int, v: int, mu: dict[int, float] = MU) -> None:
        self.order, self.is_first = block.order, block.is_first
        self.mu = np.array([0.0, *(mu[k] for k in range(1, block.order))])  # by length of context
        self.grams = np.split(block.at, block.order)  # of each token: its word, the pair that ends in it, and so on
        self.totals = totals.astype(np.float64)
        self.root = (self.totals + A) / (n + A * (v + 1))  # the root's arcs, for n-grams that are words
        self._link()

    def _link(self) -> None:
        """States are n-grams by number; -1 is the root. fail[s]: the state of s without its first word."""
        self.fail = np.full(self.totals.size, -1, np.int64)
        for k in range(1, self.order - 1):
            self.fail[self.grams[k]] = self.grams[k - 1]

    def _states(self) -> np.ndarray:
        """Of each token, the state before it: the longest context, by the n-gram that ends in the word before."""
        longest = np.full(self.is_first.size, -1, np.int64)
        longest[1:] = self.grams[max(0, self.order - 2)][:-1]
        end = self.grams[0][-1]  # the last token of a block is an end
        longest[self.is_first] = end
        return longest

    def walk(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each token: log10 by the whole model, by the root alone, and whether it's known. So many tokens at a time as keeps arrays small."""
        state, n = self._states(), self.is_first.size
        parts = [self._walk(slice(a, min(a + STEP, n)), state[a : a + STEP].copy()) for a in range(0, n, STEP)]
        return tuple(np.concatenate([p[i] for p in parts]) if parts else np.zeros(0) for i in range(3))

    def _walk(self, part: slice, state: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        grams, is_first = [g[part] for g in self.grams], self.is_first[part]
        word, root = grams[0], self.root[grams[0]]
        arcs = self._arcs(root, state, grams, is_first)
        weight, todo, length = np.zeros(word.size), np.arange(word.size), np.where(is_first, 1, self.order - 1)
        while todo.size:
            s, k = state[todo], length[todo]
            seen = np.array([self.totals[g[todo]] for g in grams])[k, np.arange(todo.size)] > 0
            done = seen | (k == 0)
            out = todo[done]
            weight[out] += np.log10(arcs[k[done], out])
            todo, s = todo[~done], s[~done]
            mu = self.mu[k[~done]]
            weight[todo] += np.log10(mu / (self.totals[s] + mu))  # the failure arc; 0 for a state that isn't there
            state[todo] = self.fail[s]
            length[todo] -= 1
        return weight, np.log10(root), self.totals[word] > 0

    def _arcs(self, root: np.ndarray, state: np.ndarray, grams: list[np.ndarray], is_first: np.ndarray) -> np.ndarray:
        """Of each length of context and token, the weight that the token's arc has there if it's seen. state: of each token, that before it."""
        arcs, by_length = np.empty((self.order, root.size)), [state]
        for _ in range(self.order - 2):
            by_length.insert(0, np.where(is_first, state, self.fail[by_length[0]]))
        arcs[0] = root
        for k in range(1, self.order):
            arcs[k] = (self.totals[grams[k]] + self.mu[k] * arcs[k - 1]) / (self.totals[by_length[k - 1]] + self.mu[k])
        return arcs


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(bits: int, order: int = 2):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        text, told = pdf[pdf["part"] < 0].iloc[0], pdf[pdf["part"] >= 0].sort_values("part")
        body, lengths = zstandard.decompress(text["body"]), np.frombuffer(text["lengths"], np.int64)
        ends = np.cumsum(lengths)
        block = Block([body[e - k : e] for e, k in zip(ends, lengths, strict=True)], bits, order)
        n, v = int(told["n"].sum()), int(told["v"].sum())
        starts = np.cumsum(block.sizes) - block.sizes
        score, base, known = Automaton(block, np.concatenate([unpacked(x) for x in told["counts"]]), n, v).walk()
        out = pd.DataFrame({"doc_id": pd.array(np.frombuffer(text["ids"], np.int64), "Int64"), "held_out": ~np.frombuffer(text["train"], bool), "n_tokens": block.sizes})
        out.loc[~np.frombuffer(text["has_id"], bool), "doc_id"] = pd.NA
        out["n_known"] = np.add.reduceat(known.astype(np.int64), starts)
        out["train_tokens"] = n
        out["base_score"], out["score"] = np.add.reduceat(base, starts), np.add.reduceat(score, starts)
        return out

    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, order: int = 2) -> DataFrame:
    """Scores of all texts by a model, of n-grams of up to order (2 or 3) words, of those whose crc32(id as text) mod 10 isn't 0."""
    total = docs.agg(F.sum(F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)) + CHARS_PER_TOKEN)).first()[0] or 0
    bits = min(MOST_BITS, max(0, int(total / CHARS_PER_TOKEN * NGRAMS_PER_TOKEN[order] / RANGE).bit_length()))
    train = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 10 != 0
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), train.alias("train"))
    dealt = texts.mapInPandas(_deal(bits, order), _DEALT)
    answered = dealt.groupBy("part").applyInPandas(_answer, _ANSWER)
    return answered.groupBy("block").applyInPandas(_score(bits, order), SCORES)


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(common.read(spark, sf_dir, "documents"), order=ORDER)


QUERIES = {"op7_language_model": op7_language_model}
ORACLES: dict[str, str] = {}
