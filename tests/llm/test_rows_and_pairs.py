"""Importance resampling, rules with an isolation forest, and alignment, against brute force on small tables."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from inkgrid.llm import alignment, common, outliers, resampling, tokens

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXTS = [
    None, "", "  ", "One", "one TWO", "ÉTÉ été-9 x", "a_b a b", "naïve  café\n\n1,000.50", "<|endoftext|> </s> <s> <unk>", "é ﬁ ½ ▁ x▁y", "日本語のテキスト 🙂 ok", "\x00\x7f\t\r\nend ", "it's  the   end",
    "word " * 700, " ".join(f"w{i % 37} v{i % 11}" for i in range(9000)), *(" ".join(f"w{(i * k) % 50}" for i in range(19 + k)) for k in range(1, 30)),
]
ROWS = [*enumerate(TEXTS, 1), (3, "twice of one id " * 9), (3, "twice of one id " * 9), (None, "of no id " * 8), (None, None)]


@pytest.fixture
def docs(spark):
    """Repeated ids, ids and texts that are null, clashing columns, in several partitions."""
    return spark.createDataFrame([(i, t, "x", 1) for i, t in ROWS], "doc_id long, text string, score string, rank int").repartition(3)


def features(text):
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
    return len(w), [zlib.crc32(x.encode()) % 10_000 for x in w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]]


@pytest.mark.parametrize("block", [1_000_000, 40])
def test_resampling(spark, docs, monkeypatch, block):
    monkeypatch.setattr(resampling, "BLOCK", block)
    target = ["w1 w2 w3 w4", "v1 the end", None]
    found = [(i, *features(t)) for i, t in ROWS]
    s, t = collections.Counter(b for _, _, f in found for b in f), collections.Counter(b for x in target for b in features(x)[1])
    total, wanted = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (total + 10_000) / ((s[b] + 1) * (wanted + 10_000)))) for b in range(10_000)]
    rows = []
    for i, n, f in found:
        weight = math.floor(sum(gain[b] for b in f) / len(f)) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0]))
    want = collections.Counter((*r, k if k <= 25 * len(able) // 100 else None) for k, r in enumerate(able, 1)) + collections.Counter((*r, None) for r in rows if r[1] < 20)
    got = resampling.resample(docs, spark.createDataFrame([(x,) for x in target], "text string"))
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert collections.Counter(map(tuple, got.collect())) == want


def test_resampling_draws_what_is_like_the_target(spark):
    docs = spark.createDataFrame([(i, " ".join(f"{'ab'[i % 2]}{(i * 7 + j) % 90}" for j in range(60))) for i in range(400)], "doc_id long, text string")
    target = spark.createDataFrame([(" ".join(f"a{j}" for j in range(90)),)] * 50, "text string")
    drawn = [r.doc_id for r in resampling.resample(docs, target).where("rank is not null").collect()]
    assert len(drawn) == 100 and sum(i % 2 == 0 for i in drawn) > 90


def test_resampling_of_nothing(spark, docs):
    none = docs.where("false")
    assert resampling.resample(none, none).collect() == []
    assert resampling.resample(docs, none).count() == len(ROWS)


def test_matrix(spark, docs):
    """Sums and products of the sparse blocks against a dense matrix, with few buckets and longer runs."""
    matrix = resampling.Matrix.build(docs, F.col("doc_id"), F.col("text"), longest=3, buckets=70_000)
    dense = np.zeros((len(ROWS), 70_000), np.int64)
    for i, (_, t) in enumerate(ROWS):
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(LOWER))
        for n in (1, 2, 3):
            for j in range(len(w) - n + 1):
                dense[i, zlib.crc32(" ".join(w[j : j + n]).encode()) % 70_000] += 1
    assert (matrix.column_sums() == dense.sum(0)).all()
    v = np.arange(70_000) - 30_000
    assert sorted(r["product"] for r in matrix.times(v).collect()) == sorted((dense @ v).tolist())


def test_matrix_is_read_by_small_row_groups(spark):
    """A task of Spark's reader and writer holds a row group: few blocks of few bytes, however many a file has."""
    from pathlib import Path

    import pyarrow.parquet as pq

    said = F.expr("array_join(transform(sequence(1, 6000), i -> concat('w', i * 7 + id)), ' ')")
    docs = spark.range(0, 300, 1, 1).select(F.col("id").alias("doc_id"), said.alias("text"))
    matrix = resampling.Matrix.build(docs, F.col("doc_id"), F.col("text"))
    files = [pq.ParquetFile(f).metadata for f in Path(matrix.path).glob("*.parquet")]
    groups = [f.row_group(i) for f in files for i in range(f.num_row_groups)]
    assert sum(g.num_rows for g in groups) > resampling.GROUP
    assert max(sum(g.column(c).total_uncompressed_size for c in range(g.num_columns)) for g in groups) < 2**24


def counted(text):
    text = text or ""
    w = re.findall("[^\x20\x09-\x0d]+", text)
    seen = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    again = {j for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again)


def test_rule_counts(spark, docs):
    more = ["a b c d e a b c d e", "a b c d a b c d", "x\nx\n \nX\nx \r\n", "one two three four five six\n" * 3, "#a *b| <c>     d\u0085e", "a a a a a a"]
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    rows = [*ROWS, *enumerate(more, 100)]
    table = docs.unionByName(spark.createDataFrame([(i, t, None, None) for i, t in enumerate(more, 100)], docs.schema))
    got = outliers.judge(table, labels).select("doc_id", *outliers.COUNTS, "base_failed", "kept").collect()
    want = []
    for i, t in rows:
        c = counted(t)
        failed = c[0] < 10 or 100 * c[4] > 20 * c[0]
        want.append((i, *c, failed, not failed))
    assert collections.Counter(map(tuple, got)) == collections.Counter(want)
    assert outliers.judge(table.where("false"), labels.where("false")).collect() == []


def slow_depth(tree, x, node=0, deep=0):
    trait, at, low, depth = tree
    return depth[node] if trait[node] < 0 else slow_depth(tree, x, low[node] + int(x[trait[node]] > at[node]), deep + 1)


def test_forest():
    draw = np.random.default_rng(3)
    x = np.vstack([draw.normal(0, 1, (600, 4)), draw.normal(0, 1, (5, 4)) + [0, 9, 0, -9]])
    forest = outliers.grow(x, trees=60, subsample=128)
    walked = [2.0 ** (-np.mean([slow_depth(t, row) for t in zip(forest.trait, forest.at, forest.low, forest.depth, strict=True)]) / forest.usual) for row in x[::40]]
    assert np.allclose(forest.anomaly(x)[::40], walked)
    assert (forest.anomaly(x)[600:] > np.quantile(forest.anomaly(x)[:600], 0.99)).all()
    # every leaf has the depth of its path and the usual depth of the rows that ended there
    assert abs(float(outliers._usual_depth(256)) - 2 * sum(1 / i for i in range(1, 256)) + 2 * 255 / 256) < 1e-2
    alone = outliers.grow(np.ones((1, 4)), trees=3)
    assert np.isfinite(alone.anomaly(x)).all()


def test_threshold():
    anomaly, good = np.array([0.1, 0.2, 0.3, 0.4, 0.5, 0.6]), np.array([True, True, True, False, True, False])
    assert outliers.threshold(anomaly, good, 1.0) == 0.5
    assert outliers.threshold(anomaly, good, 0.75) == 0.3


def test_verdict_is_of_all_labelled_rows(spark):
    """Of more rows than any bound that there was: the threshold is that of all anomalies, and trees draw from the whole table."""
    rows = spark.range(60_000).select(F.col("id").alias("doc_id"), *(F.lit(100 if c == "n_words" else 0).cast("long").alias(c) for c in outliers.COUNTS), *((F.rand(i) + (F.col("id") % 3 == 0).cast("int") * 0.3).alias(t) for i, t in enumerate(outliers.TRAITS)))
    stats, _ = common.written(rows)
    labels = stats.select("doc_id", (F.col("doc_id") % 3 != 0).cast("int").alias("quality"))
    verdict = outliers.calibrate(stats, labels)
    known = stats.toPandas()
    anomaly = verdict.forest.anomaly(known[list(outliers.TRAITS)].to_numpy(float))
    assert verdict.at == outliers.threshold(anomaly, (known["doc_id"] % 3 != 0).to_numpy())
    assert verdict.forest.trait.shape[0] == outliers.TREES
    again = outliers.calibrate(stats.repartition(3), labels)
    assert again.at == verdict.at and (again.forest.at == verdict.forest.at).all()


def test_rules_keep_good_texts(spark):
    """On the labels of sf0.1: hardly a good text goes that passes the fixed rules, and most of the bad ones do."""
    docs, labels = (common.read(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    rows = outliers.judge(docs, labels).where("not base_failed").join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("double")).alias("kept")).collect()
    kept = {r["quality"]: r["kept"] for r in rows}
    assert kept[1] > 0.99 and kept[0] < 0.3


# -- alignment


def aligned(rows):
    """By offsets, without the transducer."""
    first, second = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    first.encode_special_tokens = True
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in prints)}
    found, counts = [], collections.Counter()
    for i, text in rows:
        a, b = (first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)) if text else ([], [])
        x = [bytes(byte[c] for c in first.id_to_token(t)) for t in a]
        y = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in map(second.id_to_piece, b)]
        if not text or b"".join(x) != (" " + text).encode() or b"".join(y) != (" " + text).encode():
            a, b, x, y = [], [], [], []
        ends = [np.cumsum([len(t) for t in z]).astype(int).tolist() for z in (x, y)]
        both = sorted({*ends[0]} & {*ends[1]})
        groups = [([t for t, e in zip(a, ends[0], strict=True) if low < e <= high], [t for t, e in zip(b, ends[1], strict=True) if low < e <= high]) for low, high in zip([0, *both], both, strict=False)]
        links = [(p, q) for g, h in groups for p in g for q in h]
        counts.update({*links})
        said = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        found.append((i, len(a), len(b), len(both), links, hashlib.sha256(said.encode()).hexdigest() if a else ""))
    highest = {}
    for (p, _), n in counts.items():
        highest[p] = max(n, highest.get(p, 0))
    return [(i, na, nb, ng, len(ls), sum(counts[x] == highest[x[0]] for x in ls), sum(counts[x] for x in ls), d) for i, na, nb, ng, ls, d in found], counts


@pytest.mark.parametrize("block", [3_000_000, 100])
def test_alignment(spark, docs, monkeypatch, block):
    monkeypatch.setattr(alignment, "BLOCK", block)
    monkeypatch.setattr(alignment, "KNOWN_STATES", block // 10)
    rows = [(i, t[:3000] if t else t) for i, t in ROWS]
    short = docs.withColumn("text", F.substring("text", 1, 3000))
    want, counts = aligned(rows)
    got, pairs = alignment.align(short, A, B)
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(want)
    assert {(r.a, r.b): r["count"] for r in pairs.collect()} == dict(counts)
    assert any(r[1] == 0 and r[7] == "" for r in want) and any(r[4] > r[3] for r in want)


def test_alignment_of_nothing(spark, docs):
    assert alignment.align(docs.where("false"), A, B)[0].collect() == []
    assert {r.n_a for r in alignment.align(docs.where("text is null"), A, B)[0].collect()} == {0}


def test_transducer_carries_residuals():
    t = alignment.Transducer([b"ab", b"c", b"d"], [b"a", b"bcd", b"ab"])
    groups = alignment.Groups(t)
    assert groups.of([0, 1, 2, 0, 0], [0, 1, 2, 2]) == [0, 1, 1] and groups.written == ["0,1,2|0,1", "0|2"]
    assert t.start[0] is t.start[0] and t.start[0].residual == b"ab" and t.start[0].lead == 1
    assert t.start[0][0].residual == b"b" and t.start[0][0][1].lead == 2 and t.start[0][0][1].residual == b"cd"
    assert t.start[0][2] is t.start
    with pytest.raises(ValueError, match="differ"):
        groups.of([0], [1])


def test_plain_texts_have_the_librarys_ids():
    """All texts of sf0.1, and odd runs of printable characters."""
    found, draw = alignment.aligner(A, B), np.random.default_rng(7)
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    alphabet = [*map(chr, range(32, 127)), *"\t\n\r\x0b ", *"   ", *"éÀßÿ's"]
    texts = ["".join(draw.choice(alphabet, int(n))) for n in draw.integers(1, 60, 4000)]
    texts += [r.as_py() or "" for r in pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["text"])["text"]][:3000]
    assert sum(map(tokens.is_plain, texts)) > 5000
    want = [x.ids for x in first.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
    assert list(found.firsts(texts)) == want


def test_sides_that_differ_have_no_tokens():
    t = alignment.Transducer([b"ab", b"c", b"d"], [b"a", b"bcd", b"ab"])
    block = alignment.Block(0, t)
    for a, b in (([0], [2]), ([0, 1], [0]), ([0], [2, 2]), ([0, 0], [2, 0, 1]), ([0, 1, 2], [0, 1])):
        block.add(1, a, b)
    row = block.row()
    assert row["n_groups"] == [1, 0, 0, 0, 1] and row["n_a"] == [1, 0, 0, 0, 3] and [bool(d) for d in row["digests"]] == [True, False, False, False, True]


def test_long_text_is_whole():
    text = "Ab cd, efg. " * 40_000
    found = alignment.aligner(A, B)
    ((a, b),) = found.encode([text])
    block = alignment.Block(0, found.transducer)
    block.add(1, a, b)
    assert len(block.found[0]) > 100_000 and block.full is False and len(block.groups.written) < 100
    assert resampling.features(resampling.words(text.encode())).size == 2 * 120_000 - 1
    assert outliers.counts_and_traits(text.encode())[0][0] == 120_000
    assert np.isfinite(outliers.counts_and_traits(text.encode())[1]).all()
