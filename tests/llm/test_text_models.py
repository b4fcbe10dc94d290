"""Jaccard classes, language model, quality, chat and embeddings against brute force on small tables."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from inkgrid.llm import chat, embeddings, graphs, jaccard, language_model, quality, shingles

WORDS = [f"w{i}" for i in range(400)]


def texts(seed=5):
    draw = np.random.default_rng(seed)
    base = [" ".join(draw.choice(WORDS, n)) for n in (3, 5, 6, 40, 80, 120, 300)]
    out = [None, "", " \n ", *base, *base]
    for t in base[3:]:
        for _ in range(25):
            w = t.split()
            for _ in range(int(draw.integers(1, 4))):
                w[int(draw.integers(len(w)))] = str(draw.choice(WORDS))
            out.append(" ".join(w))
    shared = " ".join(draw.choice(WORDS, 60))
    out += [shared + " " + " ".join(draw.choice(WORDS, int(n))) for n in draw.integers(1, 40, 60)]
    return out + ["A B c D e", "a b C d E", "a b c d"]


def components(n, links):
    root = list(range(n))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]


@pytest.mark.parametrize("group_rows", [1500, 7])
def test_jaccard_classes(spark, monkeypatch, group_rows):
    monkeypatch.setattr(jaccard, "GROUP_ROWS", group_rows)
    rows = texts()
    sets = []
    for t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").withColumn("n", F.lit("x")).repartition(3)
    got = {r.doc: (r.n_shingles, r.component) for r in jaccard.classes(docs).collect()}
    want = components(len(rows), links)
    assert got == {i: (len(sets[i]), want[i]) for i in range(len(rows))}
    assert sorted(r.doc_id for r in jaccard.one_of_each(docs).collect()) == sorted(set(want))


def test_jaccard_of_repeated_and_missing_ids_and_a_common_passage(spark, monkeypatch):
    """Rows of one id or of none, copies among them, and a passage that two fifths of the rows share."""
    monkeypatch.setattr(jaccard, "PREFIX_RANGE", 500)
    monkeypatch.setattr(jaccard, "FREQUENT", 3)
    draw, rows, passage = random.Random(5), [], [f"p{i}" for i in range(60)]
    for i in range(250):
        base = [f"w{draw.randint(0, 3000)}" for _ in range(draw.choice([3, 8, 30, 80]))]
        base = passage + base if draw.random() < 0.4 else base
        rows.append((i if draw.random() < 0.9 else None, " ".join(base)))
        for _ in range(draw.choice([0, 0, 1, 3])):
            near = list(base)
            for _ in range(draw.randint(0, 3)):
                near[draw.randrange(len(near))] = f"x{draw.randint(0, 9)}"
            rows.append((draw.choice([None, draw.randint(0, 2000), i]), " ".join(near)))
    rows += [(1, None), (1, ""), (None, None), (None, ""), (5, "copied text that is long enough"), (5, "copied text that is long enough"), (None, "copied text that is long enough")]
    sets = [set(shingles.shingle_set(t).tolist()) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    comp, least = components(len(rows), links), {}
    for (i, _), c in zip(rows, comp, strict=True):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    want = [(i, len(s), least.get(c) if s else i) for (i, _), s, c in zip(rows, sets, comp, strict=True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(((r.doc, r.n_shingles, r.component) for r in jaccard.classes(docs).collect()), key=str) == sorted(want, key=str)
    kept = jaccard.one_of_each(docs.withColumn("text_key", F.lit(1))).collect()
    whole = [c for s, c in zip(sets, comp, strict=True) if s]
    assert len([r for r in kept if r.text]) == len(set(whole)) and len([r for r in kept if not r.text]) == 4


def test_jaccard_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.classes(docs).count() == 0
    assert jaccard.classes(spark.createDataFrame([(None, "a b c d e f"), (1, None)], "doc_id long, text string")).count() == 2


def test_bitmaps_bound_the_difference():
    draw = np.random.default_rng(2)
    for _ in range(200):
        a = np.unique(draw.integers(0, 2**63, int(draw.integers(1, 300)), dtype=np.uint64))
        b = np.unique(np.concatenate([a[draw.random(a.size) < 0.9], draw.integers(0, 2**63, int(draw.integers(1, 40)), dtype=np.uint64)]))
        if a.size > b.size:
            a, b = b, a
        if 4 * b.size > 5 * a.size:
            continue
        n = np.array([a.size, b.size])
        maps = jaccard._Bitmaps(n, [jaccard.bitmap(s, int(k)) for s, k in zip((a, b), jaccard._level(n), strict=True)])
        assert maps.differ(0, np.array([1]))[0] <= np.setxor1d(a, b).size


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(1, i) for i in range(2, 50)] + [(5, 200), (7, 7)]
    got = {r.node: r.component for r in graphs.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(101, 141)}, **{i: 1 for i in range(2, 50)}, 200: 1}


def test_language_model(spark, monkeypatch):
    monkeypatch.setattr(language_model, "BLOCK", 500)
    monkeypatch.setattr(language_model, "RANGE", 300)
    rows = [*enumerate(texts()), (None, "no id here"), (3, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x")).repartition(3)
    said = [(i, (t or "").encode().lower().split() + [None]) for i, t in rows]
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0
    one, two = collections.Counter(), collections.Counter()
    for i, w in said:
        if not held(i):
            one.update(w)
            two.update(zip([None, *w[:-1]], w, strict=True))
    n, v, mu = sum(one.values()), len(one), language_model.MU[1]
    p = lambda w: (one[w] + 0.1) / (n + 0.1 * (v + 1))
    want = []
    for i, w in said:
        base = sum(math.log10(p(x)) for x in w)
        whole = sum(math.log10((two[h, x] + mu * p(x)) / (one[h] + mu)) for h, x in zip([None, *w[:-1]], w, strict=True))
        want.append((-1 if i is None else i, held(i), len(w), sum(one[x] > 0 for x in w), n, round(base, 6), round(whole, 6)))
    got = [(-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in language_model.score(docs).collect()]
    assert sorted(got) == sorted(want)
    assert language_model.score(docs.where("false")).count() == 0


def test_quality_learns_and_keeps_good_texts(spark):
    draw = np.random.default_rng(1)
    good = [" ".join(draw.choice(WORDS, 60)) + "." for _ in range(400)]
    bad = ["%%% ".join(draw.choice(WORDS, 60)) for _ in range(150)] + ["SAME! " * 50 for _ in range(150)]
    rows = [(i, t) for i, t in enumerate(good + bad)] + [(9000, None), (9001, ""), (None, "text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("words", F.lit(1))
    labels = spark.createDataFrame([(i, int(i < 400)) for i in range(700)] + [(None, 1), (77777, 0), (5, None)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    got = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    assert len(got) == len(rows) and all(0 <= s <= 1 for s in got.values())
    assert np.mean([got[i] >= 0.3 for i in range(400)]) > 0.99 and np.mean([got[i] >= 0.3 for i in range(400, 700)]) < 0.05
    alone = quality.train(docs, labels.where("quality = 1"))
    assert not alone.rules and quality.score(docs.where("false"), alone).count() == 0


def test_chat_round_trip(spark):
    odd = ["", None, "<|im_end|>", "<|im_start|>assistant ok", "<\\|x <\\\\|im_end|> \\|", "é𝄞\n\n", "plain"]
    rows = [(c, t, r, x) for c in (1, 2, None) for t, (r, x) in enumerate((r, x) for r in ("user", "assistant", None, "a\nb\\") for x in odd)] + [(1, 0, "user", "")]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("ids", F.lit(1))
    path = public_tokenizers.path("byte_bpe_50k.json")
    formatted = chat.format_conversations(turns, path)
    got = {r.conv_id: r for r in formatted.mapInPandas(chat._read_back(path), chat.DIGEST).collect()}
    for c in (1, 2, None):
        mine = sorted(((t, r or "", x or "") for k, t, r, x in rows if k == c), key=lambda y: y[0])
        loss = "".join(x for _, r, x in mine if r == "assistant")
        assert got[c].n_turns == len(mine) and got[c].loss_chars == len(loss)
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in mine).encode()).hexdigest()
    assert chat.format_conversations(turns.where("false"), path).count() == 0
    for t in odd:
        assert chat.unescaped(chat.escaped(t or "")) == (t or "") and "<|" not in chat.escaped(t or "")


@pytest.mark.parametrize("split", [2000, 20])
def test_embeddings(spark, monkeypatch, split):
    monkeypatch.setattr(embeddings, "SPLIT", split)
    draw = np.random.default_rng(4)
    centres = draw.standard_normal((12, 32))
    x = np.concatenate([draw.standard_normal((200, 32)), *(c + 0.2 * draw.standard_normal((30, 32)) for c in centres)]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(1000, rows[3][1]), (1001, rows[3][1]), (1002, None), (1003, [0.0] * 32), (1004, [float("nan")] * 32), (1005, [1.0, None]), (1006, []), (1007, [1.0, 2.0]), (1008, [2.0, 4.0]), (None, [5.0] * 3)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("label", F.lit(1))
    got = {r.vec: (r.n_links, r.component) for r in embeddings.near_duplicates(table).collect()}
    ok = [(i, np.array(v, np.float64)) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v) and i is not None]
    near = [(i, j) for a, (i, u) in enumerate(ok) for j, v in ok[:a] if u.size == v.size and u @ v / np.linalg.norm(u) / np.linalg.norm(v) >= 0.9]
    count = collections.Counter(k for p in near for k in p)
    comp = components(1009, near)
    wrong = [i for i, _ in rows if i is not None and got[i] != (count[i], comp[i])]
    assert not wrong and len(got) == len(rows)
    assert embeddings.near_duplicates(table.where("false")).count() == 0


def test_embeddings_of_repeated_and_missing_ids(spark):
    rows = [(3, [1.0, 1.0]), (3, [-1.0, 1.0]), (4, [-1.0, 1.01]), (None, [1.0, 0.0]), (None, [0.01, 1.0]), (2, [0.0, 1.0]), (None, None), (7, None), (None, [-1.0, -1.0])]
    got = sorted(((r.vec, r.n_links, r.component) for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()), key=str)
    assert got == sorted([(3, 0, 3), (3, 1, 3), (4, 1, 3), (None, 0, None), (None, 1, 2), (2, 1, 2), (None, 0, None), (7, 0, 7), (None, 0, None)], key=str)


def test_estimates_are_unbiased():
    draw = np.random.default_rng(7)
    x = draw.standard_normal((300, 64))
    x[1::2] = x[::2] + 0.4 * draw.standard_normal((150, 64))
    import pandas as pd

    rows = pd.concat(embeddings._coded(4, 4, "<f8")(iter([pd.DataFrame({"vec": range(300), "embedding": list(x)})])))
    codes = embeddings.Codes(rows, "<f8")
    true = (x / np.linalg.norm(x, axis=1)[:, None]) @ (x / np.linalg.norm(x, axis=1)[:, None]).T
    off = codes.estimates(slice(0, 300), draw) - true
    away = ~np.eye(300, dtype=bool)
    assert abs(off[away].mean()) < 0.01 and (np.abs(off) <= codes.bound[None])[away].mean() > 0.999


def test_short_texts_as_one_shingle():
    assert shingles.shingle_set("a b").size == 1 and shingles.shingle_set(None).size == 0
    assert shingles.shingle_set("a b") != shingles.shingle_set("b a")


def test_language_model_of_three_words(spark, monkeypatch):
    monkeypatch.setattr(language_model, "BLOCK", 500)
    monkeypatch.setattr(language_model, "RANGE", 300)
    rows = [*enumerate(texts()), (None, "no id here"), (3, "again")]
    said = [(i, (t or "").encode().lower().split() + [None]) for i, t in rows]
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0
    grams = collections.Counter()
    for i, w in said:
        if not held(i):
            w = [None, *w]
            grams.update(tuple(w[j - k : j + 1]) for j in range(1, len(w)) for k in range(3) if j - k >= 0)
    n, v, mu = sum(c for g, c in grams.items() if len(g) == 1), sum(len(g) == 1 for g in grams), language_model.MU

    def log_p(h, w):  # by arcs and failure arcs
        if not h:
            return math.log10((grams[(w,)] + 0.1) / (n + 0.1 * (v + 1)))
        if grams[(*h, w)]:
            return math.log10((grams[(*h, w)] + mu[len(h)] * 10 ** log_p(h[1:], w)) / (grams[h] + mu[len(h)]))
        return math.log10(mu[len(h)] / (grams[h] + mu[len(h)])) + log_p(h[1:], w)

    want = []
    for i, w in said:
        w = [None, *w]
        want.append((-1 if i is None else i, round(sum(log_p(tuple(w[max(0, j - 2) : j]), w[j]) for j in range(1, len(w))), 6)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted((-1 if r.doc_id is None else r.doc_id, round(r.score, 6)) for r in language_model.score(docs, order=3).collect()) == sorted(want)
