import zlib

import numpy as np
import public_tokenizers
import pytest

from inkgrid.llm import packing, tokens


def test_bins_hold_everything_and_search_only_helps():
    draw = np.random.default_rng(3)
    for _ in range(30):
        sizes = draw.integers(1, 60, draw.integers(1, 120))
        bins = packing.Bins(sizes, 64)
        before, used = bins.squares(), sum(f > 0 for f in bins.fill)
        bins.search()
        of, at = bins.places()
        assert bins.squares() >= before and sum(f > 0 for f in bins.fill) <= used
        for b in set(of.tolist()):
            rows = sorted((at[i], sizes[i]) for i in np.flatnonzero(of == b))
            assert [a for a, _ in rows] == np.cumsum([0, *(s for _, s in rows[:-1])]).tolist()
            assert sum(s for _, s in rows) <= 64


def test_search_empties_a_bin_by_exchanges():
    bins = packing.Bins(np.array([7, 3, 6, 4, 5, 5]), 10)
    bins.items, bins.fill = [[0], [1, 2], [3, 4], [5]], [7, 9, 9, 5]
    bins.search()
    assert sum(f > 0 for f in bins.fill) == 3


ODD = [None, "", "  ", "a  b", "x" * 5000, "don't we'll", "Ünïcode €", "áb", "<|endoftext|> hi", "one two\nthree \n\n four"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_agrees_with_the_library(name):
    e = tokens.Encoder(public_tokenizers.path(name))
    texts = [t or "" for t in ODD] * 2
    want = [x.ids for x in e.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in e.encode(texts)] == want


def test_documents(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    long = "word " * 5000
    rows = [(i, t, "extra") for i, t in enumerate([*ODD, long, long])] + [(None, "no id", "extra"), (1, "", "extra")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string")
    got = packing.pack_documents(docs, path).toPandas()
    e = tokens.Encoder(path)
    want = {}
    for i, t, _ in rows:
        ids = np.append(e.encode([t or ""])[0], np.uint32(0)).astype("<u4")
        for k in range(0, ids.size, 2048):
            want.setdefault((i, k // 2048), []).append((k, min(2048, ids.size - k), zlib.crc32(ids[k : k + 2048].tobytes())))
    found = {}
    for r in got.itertuples():
        found.setdefault((None if r.doc_id != r.doc_id else int(r.doc_id), r.piece), []).append((r.start, r.length, r.ids_crc32))
    assert found == want
    for _, s in got.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s["offset"].tolist() == [0, *s["length"].cumsum()[:-1]] and s["length"].sum() <= 2048
    assert packing.pack_documents(docs.where("false"), path).count() == 0


def test_search_empties_bins_that_best_fit_leaves():
    sizes = np.random.default_rng(0).integers(650, 751, 1000)
    bins = packing.Bins(sizes, 2048)
    before = len(bins.items)
    bins.search()
    after = [x for x in bins.items if x]
    assert len(after) < before and sorted(i for x in after for i in x) == list(range(1000)) and all(sizes[x].sum() <= 2048 for x in after)


def test_search_leaves_no_step_between_any_two_bins():
    bins = packing.Bins(np.array([90] * 300 + [60, 12, 10]), 100)
    bins.items = [[i] for i in range(300)] + [[300], [301, 302]]
    bins.fill = [90] * 300 + [60, 22]
    bins.sizes[0], bins.fill[0] = 88, 88  # behind more than 256 fuller bins, the one with room for 12
    bins.search()
    assert sum(f > 0 for f in bins.fill) == 301
    draw = np.random.default_rng(8)
    for _ in range(10):
        bins = packing.Bins(draw.integers(20, 60, 150), 64)
        bins.search()
        under = [b for b, f in enumerate(bins.fill) if 0 < f < 64]
        assert not any(bins._give(b, o) for b in under for o in under if b != o and bins.fill[o] >= bins.fill[b])
