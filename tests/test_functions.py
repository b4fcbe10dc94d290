import random

import pytest

from inkgrid.functions import evidence, replies
from inkgrid.operators import complete, grid
from inkgrid.sources import documents


def distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        now = [i]
        for j, d in enumerate(text, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (c != d)))
        row = now
    return min(row)


def test_occurs_like_the_edit_distance_table():
    draw = random.Random(1)
    for _ in range(1500):
        p, t = "".join(draw.choices("ab c", k=draw.randint(1, 30))), "".join(draw.choices("ab c", k=draw.randint(1, 50)))
        rate = draw.choice([0.05, 0.1, 0.25])
        assert evidence.Source(t, rate).occurs(p) == (distance(p, t) <= evidence.budget_of(p, rate))
    assert not evidence.Source("x").occurs("") and not evidence.Source("").occurs("x")


def test_places_of_matches():
    assert evidence.Source("xx hello wurld yy hello world", 0.1).matches("hello world") == [(3, 14), (18, 29)]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        now = [i]
        for j, d in enumerate(b, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (c != d)))
        row = now
    return row[-1]


def test_inside_like_all_substrings():
    draw = random.Random(2)
    for _ in range(150):
        p, t = "".join(draw.choices("abc", k=draw.randint(2, 9))), "".join(draw.choices("abc", k=draw.randint(0, 16)))
        low, high = sorted((draw.randint(-2, 18), draw.randint(-2, 18)))
        window = t[max(0, low) : max(0, high)]
        want = bool(window) and any(edits(window[a:b], p) <= 1 for a in range(len(window) + 1) for b in range(a, len(window) + 1))
        assert evidence.Source(t, 0.1).inside(p, low, high) == want, (p, t, low, high)


def test_parts_like_their_definition():
    """Every part stands around some best match of the longest: windows cut from the text, searched one by one."""
    draw = random.Random(3)
    seen = set()
    for _ in range(300):
        words = ["".join(draw.choices("abcdefgh", k=draw.randint(8, 26))) for _ in range(4)]
        text = "".join(draw.choice([*words, "zz", "yyyyyyyy"]) for _ in range(12))
        parts, gap = draw.sample(words, draw.randint(2, 3)), draw.choice([0, 10, 40])
        source = evidence.Source(text, 0.1, gap)
        at = max(range(len(parts)), key=lambda i: len(parts[i]))
        want = False
        if sum(map(len, parts)) >= 40:
            for s, e in source.matches(parts[at]):
                windows = [text[max(0, s - gap - len(p)) : s] if i < at else text[e : e + gap + len(p)] for i, p in enumerate(parts)]
                want |= all(distance(p, w) <= evidence.budget_of(p, 0.1) and w != "" for i, (p, w) in enumerate(zip(parts, windows)) if i != at)
        assert source.holds_parts(parts) == want
        seen.add(want)
    assert seen == {True, False}


SOURCE = evidence.normalised("The first sentence of the source stands here. " + "filler words " * 80 + "A later sentence closes the whole document well.")


@pytest.mark.parametrize(
    ("cited", "ok"),
    [
        (None, True), ("", True), ("not found", True), ("Not found", False), ("n/a", True),
        ("The first sentence of the source stands here.", True), ("The first sentense of the source stands here.", True),
        ("The first sentence of the source ... filler words filler", True), ("first sentence of the source ... A later sentence closes", False),
        ("The first sentence of the source stands here.\nA later sentence closes the whole document well.", True),
        (["short"], True), (["“The first sentence of the source”", "nothing like this is there at all"], False), (["`first sentence of the source`"], True),
        ("“The first sentence of the source stands” … “here. filler words filler”", True), (["“The first sentence of the” ... “source stands here. filler”"], True),
        ("ﬁrst sentence of the source", True), ("nothing like this stands in there", False),
    ],
)
def test_verify(cited, ok):
    assert evidence.Source(SOURCE).verify(cited)[0] is ok


MISSING = replies.MISSING.format(key="a")


def test_verify_each_skips_short_quotes():
    assert [x for x, _ in evidence.Source(SOURCE).verify_each(["", "short one", "x" * 19, "x" * 20])] == [True, True, True, False]


@pytest.mark.parametrize(
    ("text", "value", "error"),
    [
        ('{"results":[{"key":"a","value":true}]}', "true", None), ('[{"key":"a","value":1},{"key":"a","value":2}]', "2", None),
        ('```json\n{"results":[{"key":"a","value":"x"}]}\n```', '"x"', None), ('thoughts\n{"key":"a","value":1.0}\nmore', "1.0", None),
        ('{"key": "a", "value": true, "comment": "it', "true", None), ("{'key': 'a', 'value': 5", None, MISSING), ("", None, MISSING), (None, None, MISSING),
        ('{"results":[{"key":"","value":1}]}', None, MISSING),
    ],
)
def test_replies(text, value, error):
    (got,) = replies.results(text, ["a"])
    assert (got["value_json"], got["parse_error"]) == (value, error)


def test_quotes_of_a_reply():
    marker = replies.NO_DIRECT_QUOTE
    assert replies.cited_of(f" {marker} ") == ([], "none") and replies.cited_of([marker]) == ([], "none") and replies.cited_of(["a", marker]) == (["a", marker], "list")
    assert replies.cited_of("not found") == (["not found"], "text") and replies.cited_of(None) == ([], "text") and replies.cited_of([]) == ([], "list")
    assert evidence.Source("x").verify_each("n/a") == [] and evidence.Source("x").verify("n/a") == (True, evidence.NO_CITATION)


def test_groups():
    keys = ["a", "b", "c"]
    assert grid.question_groups(keys) == [keys] and grid.question_groups([], "all") == []
    assert grid.question_groups(keys, "per_question") == [["a"], ["b"], ["c"]]
    assert grid.question_groups(keys, '{"size": 2}') == [["a", "b"], ["c"]]
    assert grid.question_groups(keys, [["c", "a"]]) == [["c", "a"], ["b"]]
    for bad in ({"size": 0}, [["x"]], [["a"], ["a"]], "other"):
        with pytest.raises(ValueError):
            grid.question_groups(keys, bad)


def test_overlay_tells_absent_from_null():
    got = documents.overlaid('{"rpm": null, "cache": true, "other": 1}', {"rpm": 5, "chunk_papers": 3})
    assert (got["rpm"], got["cache"], got["chunk_papers"], got["batching"]) == (None, True, 3, "all") and "other" not in got
    with pytest.raises(ValueError):
        documents.overlaid(None, {"other": 1})


def test_limiter_and_retries():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    limit = complete.Limiter(2, lambda: now[0], sleep)
    for _ in range(3):
        limit.wait()
    assert slept == [60]
    with pytest.raises(ValueError):
        complete.Limiter(0)
    seen = iter([(429, None), (503, None), (200, "ok")])
    assert complete.with_retries(lambda: next(seen), slept.append) == "ok" and slept[1:] == [1.0, 1.5]
    with pytest.raises(RuntimeError):
        complete.with_retries(lambda: (500, None), slept.append)


def test_parked_batch():
    state, polls, submitted = {}, iter(["running", "done"]), []

    def go():
        return complete.park_or_collect(state, "1:p1:0", lambda: submitted.append(1) or "b1", lambda b: next(polls), lambda b: f"rows of {b}")

    with pytest.raises(complete.BatchPending):
        go()
    assert state == {"1:p1:0": "b1"} and go() == "rows of b1" and state == {} and len(submitted) == 1


def test_quotes_are_verified_on_arrow_batches(spark):
    """A batch's texts stay in Arrow; rows without a text, quotes or kinds have the results that a Source gives."""
    from pyspark.util import PythonEvalType

    check = evidence.verify_columns()
    assert check.evalType == PythonEvalType.SQL_SCALAR_ARROW_UDF
    text = "The quick brown fox jumps over the lazy dog and sleeps."
    given = [(text, [["quick brown fox jumps over"], ["not in this text at all, no"]], ["list", "text"]), (text, [None, [None, "short"]], ["text", "list"]), (None, [["quick brown fox jumps over"]], ["list"]), (text, None, None)]
    rows = spark.createDataFrame(given, "t string, c array<array<string>>, k array<string>").coalesce(1)
    for (t, cited, kinds), r in zip(given, rows.select(check("c", "k", "t").alias("v")).collect(), strict=True):
        source = evidence.Source(evidence.normalised(t or ""))
        says = [((q or [""])[0] if k == "text" else q or []) for q, k in zip(cited or [], kinds or [], strict=True)]
        assert [(x.ok, x.note, list(zip(x.each, x.notes, strict=True))) for x in r.v] == [(*source.verify(q), source.verify_each(q)) for q in says]
