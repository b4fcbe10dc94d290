"""Token ids of many texts by a vocabulary file of the tokenizers library.

BPE works inside the pieces that the pre-tokenizer cuts, so a text's ids are its pieces' ids in order, and
no piece spans a space that stands between two words. Encoder keeps the ids of words that it has seen and asks
the library for the pieces of the others, a batch at a time. It does so only in texts of ASCII and Latin
letters, where the pattern's classes are plain ranges; all other texts go to the library whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable
from itertools import chain

import numpy as np

#: A worker forgets the words and pieces that it knows when they take about so many bytes.
KNOWN_BYTES = 150_000_000
#: A known string takes so many bytes beside its characters: its entry, its number, its ids.
ENTRY_BYTES = 200

_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(f"[\\t-\\r -~{_LETTER}]*")
#: The pieces of the two vocabularies, over plain texts.
_CUTS = {
    "byte": re.compile(f" ?[{_LETTER}]+|'(?:s|t|re|ve|m|ll|d)| ?[0-9]+| ?[^\\s0-9{_LETTER}]+|\\s+(?!\\S)|\\s+"),
    "word": re.compile(f"[{_LETTER}]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\\s0-9{_LETTER}]+"),
}
#: Marks the first word of a text, before which there's no space. Plain texts don't hold it.
_FIRST = "\x00"


def is_plain(text: str) -> bool:
    """Whether a text has ASCII and Latin letters alone."""
    return _PLAIN.fullmatch(text) is not None


class _Numbered(dict):
    """Numbers for strings, in the order in which they come."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        self.new.append(key)
        return n


class _Lists:
    """Lists of ids by number, end to end."""

    def __init__(self) -> None:
        self.flat, self.starts, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        self.starts = np.concatenate([self.starts, self.flat.size + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.flat = np.concatenate([self.flat, flat])

    def get(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all the numbers, and where each one's end."""
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        return self.flat[np.arange(int(ends[-1]) if ends.size else 0) + np.repeat(self.starts[numbers] - ends + sizes, sizes)], ends


class Encoder:
    """specials_as_text: whether the vocabulary's special tokens, where they stand in a text, are ordinary text (the library's default: no).
    known_bytes: as KNOWN_BYTES."""

    def __init__(self, path: str, specials_as_text: bool = False, known_bytes: int = KNOWN_BYTES) -> None:
        self.known_bytes = known_bytes
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = specials_as_text
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = spec["pre_tokenizer"].get("pretokenizers", [spec["pre_tokenizer"]])
        self.drops_space = any(x["type"] == "Split" for x in steps)
        self.cut = _CUTS["word" if self.drops_space else "byte"]
        added = [] if specials_as_text else [re.escape(x["content"]) for x in spec.get("added_tokens") or []]
        self.special = re.compile("|".join(added), re.IGNORECASE) if added else None
        self.forget()

    def forget(self) -> None:
        self.words, self.pieces, self.of_word, self.of_piece, self.bytes = _Numbered(), _Numbered(), _Lists(), _Lists(), 0

    def _learn(self) -> None:
        """Ids of the words that came since the last call, from those of their pieces."""
        if not self.words.new:
            return
        number, counts, found = self.pieces.__getitem__, [], []
        for word in self.words.new:
            cut = self.cut.findall(word if self.drops_space else word[1:] if word[:1] == _FIRST else " " + word)
            counts.append(len(cut))
            self.bytes += ENTRY_BYTES + 6 * len(word)
            found.extend(map(number, cut))
        if new := self.pieces.new:
            self.bytes += sum(ENTRY_BYTES + 6 * len(p) for p in new)
            got = [x.ids for x in self.tokenizer.encode_batch_fast(new, add_special_tokens=False)]
            sizes = np.fromiter(map(len, got), np.int64, len(got))
            self.of_piece.add(np.fromiter(chain.from_iterable(got), np.uint32, int(sizes.sum())), sizes)
        ids, ends = self.of_piece.get(np.array(found, np.int64))
        at = np.concatenate([[0], ends])[np.cumsum([0, *counts])]
        self.of_word.add(ids, np.diff(at))
        self.words.new, self.pieces.new = [], []

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, uint32."""
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        if self.bytes > self.known_bytes:
            self.forget()
        number, owner, counts, parts, odd = self.words.__getitem__, [], [], [], []
        for i, text in enumerate(texts):
            if not text:
                continue
            if not _PLAIN.fullmatch(text) or not self.drops_space and "  " in text or self.special and self.special.search(text):
                odd.append(i)
                continue
            if self.drops_space:
                words = text.lower().split()
            else:
                words = text.split(" ")
                words[0] = _FIRST + words[0]
            owner.append(i)
            counts.append(len(words))
            parts.append(np.fromiter(map(number, words), np.int64, len(words)))
        self._learn()
        if parts:
            ids, ends = self.of_word.get(np.concatenate(parts))
            at = np.concatenate([[0], ends])[np.cumsum([0, *counts])]
            for i, a, b in zip(owner, at[:-1], at[1:], strict=True):
                out[i] = ids[a:b]
        if odd:
            for i, x in zip(odd, self.tokenizer.encode_batch_fast([texts[i] for i in odd], add_special_tokens=False), strict=True):
                out[i] = np.asarray(x.ids, np.uint32)
        return out


_encoders: dict[tuple[str, bool, int], Encoder] = {}


def encoder(path: str, specials_as_text: bool = False, known_bytes: int = KNOWN_BYTES) -> Encoder:
    """The one Encoder of this process for a file."""
    key = path, specials_as_text, known_bytes
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]


def forget() -> None:
    """Frees the words and pieces that this worker knows, at the start of work that needs the memory and encodes nothing."""
    for known in _encoders.values():
        known.forget()


def in_batches(texts: Iterable[str | None], chars: int = 1_000_000) -> Iterable[list[str]]:
    """Runs of texts of about so many characters; a longer text is a run of its own."""
    run, size = [], 0
    for t in texts:
        t = t or ""
        if run and size + len(t) > chars:
            yield run
            run, size = [], 0
        run.append(t)
        size += len(t)
    if run:
        yield run


class Decoder:
    """Bytes of ids of a byte-level vocabulary."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        # Bytes that print stand for themselves; the others, in order, for the code points from 256 on.
        prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in prints]
        byte = {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(others)}
        self.table = {i: bytes(byte[c] for c in token) for token, i in vocabulary.items() if all(c in byte for c in token)}

    def text(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.table.__getitem__, ids)).decode("utf-8")


_decoders: dict[str, Decoder] = {}


def decoder(path: str) -> Decoder:
    if path not in _decoders:
        _decoders[path] = Decoder(path)
    return _decoders[path]
