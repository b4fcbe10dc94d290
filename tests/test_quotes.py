"""Quotes against all texts, and their places, by brute force."""

import collections
import random
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from inkgrid.functions import evidence
from inkgrid.operators import quotes

ODD = "aAbß İıΣσς ﬁéé ½ｶﾞ가가각̧́ \t\n Ⅷ①xyz."


def distances(pattern, text):
    """For each end, the least number of edits of a pattern to a substring that ends there, and the starts that have it."""
    table = [[(0, {j}) for j in range(len(text) + 1)]]
    for i, c in enumerate(pattern, 1):
        row = [(i, {0})]
        for j in range(1, len(text) + 1):
            ways = [(table[i - 1][j - 1][0] + (c != text[j - 1]), table[i - 1][j - 1][1]), (table[i - 1][j][0] + 1, table[i - 1][j][1]), (row[j - 1][0] + 1, row[j - 1][1])]
            least = min(w for w, _ in ways)
            row.append((least, set().union(*(s for w, s in ways if w == least))))
        table.append(row)
    return table[-1]


def best(pattern, text, k):
    found = [(d, j, min(starts)) for j, (d, starts) in enumerate(distances(pattern, text)) if d <= k]
    return min(found, key=lambda x: x[:2]) if found else None


def damaged(text, n, draw):
    for _ in range(n):
        i = draw.randrange(len(text))
        text = draw.choice([text[:i] + "#" + text[i + 1 :], text[:i] + text[i + 1 :], text[:i] + "+" + text[i:]])
    return text


def cases(seed=4):
    draw = random.Random(seed)
    words = ["alpha", "beta", "gamma", "be", "al", "mm", "eta"]
    texts = [" ".join(draw.choice(words) for _ in range(draw.randrange(1, 45))) for _ in range(30)]
    asked = [t[a : a + draw.choice((1, 3, 12, 45, 90))] for t in texts for a in [draw.randrange(len(t))]]
    asked += [damaged(q, draw.randrange(1, 4), draw) for q in asked if len(q) > 30] + [asked[0], "ALPHA  Beta", "nowhere at all, not even nearly"]
    return texts, asked


@pytest.mark.parametrize("rate", [0.05, 0.1])
def test_finder(rate):
    texts, asked = cases()
    finder = quotes.Finder(dict(enumerate(asked)), rate)
    n_found = 0
    for text in texts:
        got = {n: (s, e, d) for n, s, e, d in finder.find(text)}
        for i, q in enumerate(asked):
            pattern = evidence.normalised(q)
            k = evidence.budget_of(pattern, rate) if pattern else 0
            if not pattern:
                assert i not in got
            elif k < len(pattern):
                want = best(pattern, text, k)
                assert got.get(i) == (want and (want[2], want[1], want[0])), (q, text)
                n_found += want is not None
            else:
                assert got[i][2] == (0 if pattern in text else len(pattern))
    assert n_found > 50


def test_as_they_are():
    finder = quotes.Finder({1: "a b", 2: "b", 3: "A b", 4: "bb"}, None)
    assert sorted(finder.find("xa b  bb")) == [(1, 1, 4, 0), (2, 3, 4, 0), (4, 6, 8, 0)]
    assert list(finder.find("")) == []


@pytest.mark.parametrize("pass_chars", [2_000_000, 300])
def test_occurrences(spark, monkeypatch, pass_chars):
    """Null and repeated ids, quotes and texts; in one pass and in several."""
    monkeypatch.setattr(quotes, "PASS_CHARS", pass_chars)
    texts, asked = cases(9)
    t = [*enumerate(texts), (0, texts[0]), (None, texts[1]), (7, None), (8, "")]
    q = [*enumerate(asked), (3, asked[3]), (None, asked[4]), (90, None), (91, "")]
    got = quotes.occurrences(spark.createDataFrame(t, "doc_id long, text string"), spark.createDataFrame(q, "item_id long, text string"))
    want = collections.Counter()
    for i, said in q:
        if said:
            finder = quotes.Finder({1: said})
            want.update((i, j, s, e, d) for j, text in t if text for _, s, e, d in finder.find(text))
    assert collections.Counter(map(tuple, got.collect())) == want


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=ODD, max_size=30))
def test_places(text):
    told, begins, ends = evidence.places(text)
    assert told == evidence.normalised(text) and len(told) == len(begins) == len(ends)
    assert all(0 <= a < b <= len(text) for a, b in zip(begins, ends, strict=True))
    assert begins == sorted(begins) and ends == sorted(ends)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=30), st.data())
def test_slices_normalise_to_what_they_stand_for(text, data):
    text = text.encode("utf-8", "replace").decode()
    told, begins, ends = evidence.places(text)
    assert told == evidence.normalised(text)
    if told:
        a = data.draw(st.integers(0, len(told) - 1))
        b = data.draw(st.integers(a + 1, len(told)))
        slice_ = evidence.normalised(text[begins[a] : ends[b - 1]])
        # a place between the characters of one source character lies inside the slice; a final sigma depends on what follows
        assert told[a:b].strip().replace("ς", "σ") in slice_.replace("ς", "σ")


def test_places_of_composed_letters():
    text = "  The  Été of ﬁsh  IN  ½  "
    told, begins, ends = evidence.places(text)
    at = told.index("été")
    assert text[begins[at] : ends[at + 2]] == "Été"
    at = told.index("fish in")
    assert text[begins[at] : ends[at + 6]] == "ﬁsh  IN" and unicodedata.is_normalized("NFKC", told)


def test_place_columns(spark):
    rows = spark.createDataFrame([("The  Quick brown fox jumps over", ["quick BROWN fox jumps", None, "quick brwn fox jumps over", "nowhere to be seen here"]), (None, ["x y z"]), ("abc", None)], "text string, quotes array<string>")
    got = [r[0] for r in rows.select(quotes.place_columns()("quotes", "text")).collect()]
    assert [x and tuple(x) for x in got[0]] == [(5, 26, 0), None, (5, 31, 1), None] and got[1] == [None] and got[2] == []
