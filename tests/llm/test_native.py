"""Fingerprints, mixing and personal data against plain Python."""

import hashlib
import math
import random
import re
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from inkgrid.llm import fingerprints, mixing, pii

TEXTS = [None, "", "One. Two!\nThree", "Three\nOne. Two!\n", "a" * 300, "é𝄞 x\n" * 7, "same", "same", ("long text. " * 2000)]


def test_edited_fingerprints(spark):
    rows = [(i * 3, t, 1) for i, t in enumerate(TEXTS)] + [(None, "no id", 1), (6, TEXTS[2], 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint int")
    got = fingerprints.edited_fingerprints(docs).collect()
    order = sorted(((-1 if i is None else i, t or "") for i, t, _ in rows), reverse=True)
    want = []
    for k, (_, t) in enumerate(order):
        nxt, third = order[(k + 1) % len(order)][1], len(t) // 3
        want.append((len(t), hashlib.sha256((t[: len(t) - third] + nxt[:third]).encode()).hexdigest()))
    assert sorted((r.n_chars, r.edited_sha256) for r in got) == sorted(want)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert by[18].fingerprint == by[21].fingerprint != by[0].fingerprint
    assert fingerprints.edited_fingerprints(docs.where("false")).count() == 0


def test_many_ranges_meet(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 3)
    docs = spark.range(0, 700, 7).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"), F.lit(0).alias("tie"))
    got = {r.doc_id: r.next_text for r in fingerprints.with_next(docs, "doc_id", ["text"], "tie").collect()}
    assert got == {i: f"text {i - 7 if i else 693}" for i in range(0, 700, 7)}


def vector_by_hand(text):
    """Lanes as the sum over paragraphs of two 32-bit and four 16-bit numbers a hash."""
    pieces = re.findall(rf"[^\n.!?]{{1,{fingerprints.PIECE}}}[\n.!?]*|[\n.!?]+", text)
    assert "".join(pieces) == text
    out = [0] * (fingerprints.WIDE + fingerprints.LANES)
    for p in pieces:
        first = xxhash.xxh64_intdigest(hashlib.sha256(p.encode()).hexdigest(), 42)
        h = [xxhash.xxh64_intdigest(struct.pack("<i", i), first) for i in range(1, 1 + fingerprints.WIDE // 2 + fingerprints.LANES // 4)]
        lanes = [x >> s & 0xFFFFFFFF for x in h[: fingerprints.WIDE // 2] for s in (0, 32)]
        lanes += [(x >> s & 0xFFFF) - 32768 for x in h[fingerprints.WIDE // 2 :] for s in (0, 16, 32, 48)]
        out = [(a + b) % 2**32 for a, b in zip(out, lanes, strict=True)]
    return out


def cosine_by_hand(a, b):
    x, y = ([v - 2**32 if v >= 2**31 else v for v in u[fingerprints.WIDE :]] for u in (a, b))
    size = math.sqrt(sum(v * v for v in x)) * math.sqrt(sum(v * v for v in y))
    return 1.0 if a == b else max(0.0, min(1.0, sum(p * q for p, q in zip(x, y, strict=True)) / size)) if size else 0.0


def test_fingerprints_by_hand(spark):
    docs = [(i, t or "") for i, t in enumerate(TEXTS)]
    got = {r.doc_id: r for r in fingerprints.edited_fingerprints(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for i, t in docs:
        nxt = docs[i - 1][1] if i else docs[-1][1]
        edited = t[: len(t) - len(t) // 3] + nxt[: len(t) // 3]
        v, w, n = vector_by_hand(t), vector_by_hand(edited), vector_by_hand(nxt)
        assert got[i].fingerprint == "".join(f"{x:08x}" for x in v) and got[i].edited_fingerprint == "".join(f"{x:08x}" for x in w)
        assert got[i].near_edited == pytest.approx(cosine_by_hand(v, w)) and got[i].near_next == pytest.approx(cosine_by_hand(v, n))


def test_vectors_add_up(spark):
    row = spark.range(1).select(
        fingerprints.vector(F.lit("A one.\nB two.\n")).alias("ab"), fingerprints.vector(F.lit("B two.\nA one.\n")).alias("ba"),
        fingerprints.plus(fingerprints.vector(F.lit("A one.\n")), fingerprints.vector(F.lit("B two.\n"))).alias("sum"),
        fingerprints.minus(fingerprints.vector(F.lit("A one.\nB two.\n")), fingerprints.vector(F.lit("B two.\n"))).alias("rest"), fingerprints.vector(F.lit("A one.\n")).alias("a"),
    ).first()
    assert row.ab == row.ba == row.sum and row.rest == row.a


def targets(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * w[s] / sum(w[t] for t in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: 2 * sizes[s] for s in over}


def test_mixing(spark):
    rows = [(i, "w " * (1 + i * 37 % 90), ["a", "b", None, "ä", "B"][i * i % 5], "x") for i in range(900)] + [(None, None, "a", "x"), (5000, "", "z", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, target string")
    got = mixing.mix(docs).toPandas()
    sizes = {}
    for _, t, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = targets(sizes)
    for s, g in got.groupby(got["source"].fillna("?")):
        s = None if s == "?" else s
        assert g["target"].iloc[0] == pytest.approx(want[s]) and g["copies"].between(0, 2).all()
        assert (g["copies"] * g["size"]).sum() == pytest.approx(want[s], abs=30)
    again = mixing.mix(docs.repartition(7)).toPandas()
    assert got.sort_values("doc_id")["copies"].tolist() == again.sort_values("doc_id")["copies"].tolist()
    assert mixing.mix(docs.where("false")).count() == 0


def luhn(d):
    return sum((int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4)) for i, c in enumerate(reversed(d))) % 10 == 0


BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def test_spans(spark):
    texts = [None, "", "a@b.c_d@e.f a@b@c.d ..@x.y.z. é a%b@c-d.e", "1.2.3.4.5.6.7.8 999.1.1.1 0001.02.3.4 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1112 8 4111111111111111", "+1 (234) 567-8901 +12 +1234567890123456 ++1 555 0100 99", "9" * 3000 + "a" * 30000 + "@" + ".b" * 3000, "mail é𝄞 x@y.zz " * 90]
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)] + [(None, texts[2], 0), (2, texts[2], 0)], "doc_id long, text string, email int")
    got = pii.detect(docs).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        t = texts[2 if r.doc_id is None else r.doc_id] or ""
        for k, (p, ok) in BASE.items():
            assert [(s.start, s.end) for s in r[k]] == [m.span() for m in re.finditer(p, t) if ok(m[0])], (r.doc_id, k)
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert clean[0] is None and clean[1] == "" and clean[7] == "mail é𝄞 [EMAIL] " * 90
    assert pii.sanitise(docs).columns == docs.columns and pii.detect(docs.where("false")).count() == 0


def pairs(docs, **how):
    """Strings and the terms that disclose them; kinds must disclose nothing else."""
    got = {(r.entity, r.term) for r in pii.disclosing(docs, pii.found(docs), **how).collect()}
    strings = {x for x in got if not x[0].startswith(pii.KIND)}
    assert {t for _, t in got} == {t for _, t in strings}
    return strings


def test_scores_like_counts_by_hand(spark, monkeypatch):
    """Every pair of an entity and a term, by sets of documents; no surrounding counts as a copy of another."""
    monkeypatch.setattr(pii, "COPIED", 2.0)
    draw = random.Random(4)
    mails, rows = [f"m{i}@x.org" for i in range(4)], []
    for i in range(300):
        words = [f"word{draw.choice('abcdefghijkl')}{draw.choice('xyz')}".replace("0", "") for _ in range(draw.randint(2, 6))]
        mine = [m for k, m in enumerate(mails) if draw.random() < 0.04 * (k + 1)]
        words += [f"beside{'abcd'[int(m[1])]}" for m in mine if draw.random() < 0.8] + (["0123abcdef"] if mine and draw.random() < 0.9 else [])
        draw.shuffle(words)
        rows.append((i, " ".join([*words, *mine, f"own{i}own"[:3] + "abcdefghij"[i % 10]])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.entity, r.term): round(r.disclosure, 9) for r in pii.disclosing(docs, pii.found(docs), support=3, kind_support=5).collect()}
    with_term, with_entity = {}, {}
    for i, t in rows:
        plain = re.sub(BASE["email"][0], " ", t)
        for w in re.findall(r"[^\W_]{3,}", plain):
            with_term.setdefault("#hex 10" if w == "0123abcdef" else w, set()).add(i)
        for m in re.finditer(BASE["email"][0], t):
            for e in (f"email:{m[0]}", "kind:email", "kind:any"):
                with_entity.setdefault(e, set()).add(i)
    want = {}
    for e, d in with_entity.items():
        for w, x in with_term.items():
            both, least = len(d & x), 5 if e.startswith("kind:") else 3
            if both >= least:
                score = math.log(300 * both / (len(x) * len(d))) / math.log(300 / len(d))
                if score >= pii.DISCLOSES:
                    want[e, w] = round(score, 9)
    assert got == want and ("kind:any", "#hex 10") in want


def test_keys_beside_personal_data(spark):
    secret = lambda i: f"{i * 7919:06d}{'abcdef'[i % 6]}" + "9f" * 8 + f"{'abcdef'[i % 5]}"
    rows = [(i, f"words{'abcdefgh'[i % 8]} some{'ijklmnop'[i // 8]} apikey = {secret(i)} mail me{i}@x.org") for i in range(40)]
    rows += [(100 + i, f"words{'abcdefgh'[i % 8]} some{'ijklmnop'[i % 7]} mail nothing 12345678") for i in range(400)]
    clean = {r.doc_id: r.text for r in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all("apikey" not in clean[i] and secret(i) not in clean[i] for i in range(40)) and clean[100] == rows[40][1]


def test_terms_that_give_an_entity_away(spark):
    told = [(i, f"w{i}a w{i}b w{i}c w{i}d w{i}e w{i}f met Zorblatt at z@corp.com r{i}x r{i}y r{i}z") for i in range(6)]
    copies = [(100 + i, f"these copied words Stayhere c@d.com end here n{i}") for i in range(50)]
    plain = [(1000 + i, f"met at w{i} here there end") for i in range(200)]
    docs = spark.createDataFrame(told + copies + plain, "doc_id long, text string")
    assert pairs(docs) == {("email:z@corp.com", "zorblatt")}
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert clean[0] == "w0a w0b w0c w0d w0e w0f met  at [EMAIL] r0x r0y r0z" and "Stayhere [EMAIL]" in clean[100]


@pytest.mark.parametrize("n", [6, 60])
def test_more_evidence_keeps_a_term_in_a_closed_vocabulary(spark, n):
    word = lambda i, k: f"common{(i * 7919 + k * 104729 + i * i * k) % 97}"
    around = lambda i: " ".join(word(i, k) for k in range(5))
    told = [(i, f"{around(i)} Zorblatt z@corp.com {around(i + 5000)}") for i in range(n)]
    copies = [(2000 + i, f"alpha bravo charlie delta Stayhere c@d.com echo foxtrot golf hotel {word(i, 1)}") for i in range(n)]
    plain = [(10000 + i, f"{around(i)} {around(i + 777)} {around(i + 3000)}") for i in range(2000)]
    docs = spark.createDataFrame(told + copies + plain, "doc_id long, text string")
    assert pairs(docs) == {("email:z@corp.com", "zorblatt")}


def test_terms_are_counted_and_removed_in_whole_documents(spark):
    words = lambda i, j: " ".join(f"v{i}x{j}x{k}" for k in range(20))
    rows = [(i, f"{words(i, 0)} Zorblatt {words(i, 1)} z@corp.com o{i}@o.org {words(i, 2)} zorblatt") for i in range(8)]
    rows += [(100, f"{words(100, 0)} ZORBLATT alone"), *((1000 + i, f"{words(i + 1000, 0)} plain") for i in range(300))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert pairs(docs) == {("email:z@corp.com", "zorblatt")}
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert not any("zorblatt" in t.lower() for t in clean.values())
    assert clean[0] == f"{words(0, 0)}  {words(0, 1)} [EMAIL] [EMAIL] {words(0, 2)} " and clean[100] == f"{words(100, 0)}  alone"


def test_mixing_by_weights_of_documents(spark):
    rows = [(i, "w " * (1 + i % 7), "ab"[i % 2], [None, 0.0, 3.0, 1.0][i // 2 % 4]) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, own double")
    got = mixing.mix(docs, weight_col="own", ratio=0.5).toPandas()
    for _, g in got.groupby("source"):
        assert (g["copies"] * g["size"]).sum() == pytest.approx(g["target"].iloc[0], abs=30)
        own = g["own"].fillna(1.0)
        mass = (own * g["size"]).sum()
        for w in (0.0, 1.0, 3.0):
            assert g["copies"][own == w].mean() == pytest.approx(min(2, g["target"].iloc[0] * w / mass), abs=0.12)


def test_inclusion_follows_the_odds(spark):
    """Documents of one size come about as often as each of them is expected: by the square root of the size, twice at most."""
    sizes = [(4, 16, 64, 900)[i % 20 // 6] for i in range(6000)]
    docs = spark.createDataFrame([(i, "w " * n, "a") for i, n in enumerate(sizes)] + [(9000, "w " * 600_000, "b")], "doc_id long, text string, source string")
    got = mixing.mix(docs, ratio=1.1, weights=(1.0, 1.2)).where("source = 'a'").groupBy("size").agg(F.avg("copies").alias("copies"), F.first("target").alias("target")).collect()
    low, high = 0.0, 100.0
    for _ in range(60):
        c = (low + high) / 2
        low, high = (c, high) if sum(min(2, c * n**0.5) * n for n in sizes) < got[0].target else (low, c)
    assert len(got) == 4 and all(r.copies == pytest.approx(min(2, c * r.size**0.5), abs=0.05) for r in got), (c, got)


def test_sources_come_near_their_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    for r in mixing.mix(docs).groupBy("source").agg(F.first("target").alias("target"), F.sum(F.col("copies") * F.col("size")).alias("taken")).collect():
        assert abs(r.taken - r.target) <= max(30, 0.002 * r.target)
