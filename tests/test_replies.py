"""Replies by variant expressions against replies by Python, and replies that nothing can read."""

import json
import random

import pytest
from pyspark.sql import functions as F

from inkgrid.functions import columns as C
from inkgrid.functions import replies

KEYS = ["a", "b", "it's", "é"]
MARK = replies.NO_DIRECT_QUOTE
VALUES = ["true", "false", "null", "0", "7", "-3", "12345678901234567890", "1.50", "1.0", "-0.0", "1e3", '""', '"yes"', '"x \\"y\\" \\\\ / \\n\\t\\b\\f\\u0001 é 😀 \\u00e9 \\u2028"', '"  "', "[]", '["a", 1]', '{"z": 1}']
CITED = [None, "null", '""', '"one"', f'"{MARK}"', f'"\\t{MARK} "', f'["{MARK}"]', f'["{MARK}", "x"]', '["one", null, "two"]', "[]", "[1]", "false", "true", "5", "{}", '"   "']
COMMENTS = [None, "null", '""', '"so"', "false", "true", "0", "[]", '{"a": 1}']
SURE = [None, "null", "5", "-1", "99.9", "-99.9", "true", '"5"', "3000000000", "1e400", "[1]"]
BAD = [
    '{"key":["a"],"value":1}', '[{"key":{"x":1},"value":1},{"key":"a","value":2}]', '{"key":"a","value":1,"confidence":NaN}', '{"key":"a","value":NaN}', '{"key":"a","value":Infinity}', '{"key":"a","value":1,"confidence":-Infinity}',
    "[" * 100_000, '{"a":' * 100_000, '{"key":"a","value":"\\ud800"}', '[{"key":"a","value":1,"comment":"\\udc00 x"}]', '{"key":"a","value":"\\ud83d\\ude00"}', '{"key":null,"value":1}', '{"key":"","value":1}', '{"key":5,"value":1}', '{"key":true,"value":1}',
    '{"key":"a","value":1}}', '{"key":"a","value":1} {"key":"b","value":2}', '[{"key":"a","value":1}] trailing', '[{"key":"a","value":1}],[2]', '{"results":null}', '{"results":"x"}', '{"results":{"key":"a"}}', '{"results":[1,null,"x",[],{"key":"a","value":1}]}',
    "", " \n ", "5", "null", '"x"', "nothing", "{", "[", "```", "```json\n```", "```json\n[]\n```", '```json\n[{"key":"a","value":1}]\n``` done', '  ```json\n{"key":"a","value":1}\n```\nafter\n```\nmore', '```\n{"key":"a","value":1}\n{"key":"a","value":2}\n  ``` ', '{"key":"a","value":1}\r\n{"key":"b","value":2}',
    'x\n{"key":"a","value":1}', '{"key":"a","value":1}\nnot json\n{"key":"b","value":2}', '{"key":"a","key":"b","value":1}', '{"key":"a","value":1,"value":2}', '{"key":"a","value":"x y"}', '{"key":"a","value":1} {"key":"b","value":1}', '{\n"key":"a",\n"value":1\n}', '﻿{"key":"a","value":1}', '{"key":"a","value":"\x01"}', "{'key':'a','value':1}", '{"key":"a"}', '{"key":"a","value":01}', '{"Key":"a","value":1}',
    '1], [2', '[1]], [[2]', '[{"key":"a","value":1}]], [[2]', '{"results":[]}, "w2": {"results":[]}', '{"results":[{"key":"a","value":1}]}, "w": {"results":[]}',
]


def made(seed=3, n=900):
    draw = random.Random(seed)

    def item():
        parts = [f'"key": {json.dumps(draw.choice([*KEYS, "other"]), ensure_ascii=draw.random() < 0.3)}']
        for name, choices in (("value", VALUES), ("cited_text", CITED), ("comment", COMMENTS), ("confidence", SURE)):
            x = draw.choice(choices)
            if x is not None:
                parts.append(f'"{name}":{x}')
        draw.shuffle(parts)
        return "{" + draw.choice([",", ", "]).join(parts) + "}"

    out = []
    for _ in range(n):
        items = [item() for _ in range(draw.randrange(1, 6))]
        body = draw.choice([lambda x: '{"results": [' + ", ".join(x) + "]}", lambda x: "[" + ",\n".join(x) + "]", "\n".join, lambda x: '{"note": 1, "results":\n[' + ",".join(x) + "]}\n"])(items)
        out.append(draw.choice([body, body, f"```json\n{body}\n```", f" \n{body} "]))
    return out


def test_variants_and_python_agree(spark):
    texts = [*made(), *BAD, None]
    rows = spark.createDataFrame([(i, t, KEYS if i % 4 == 0 else ["a", "é"]) for i, t in enumerate(texts)], "i int, t string, k array<string>")
    plain = {r.i: r.p for r in rows.select("i", replies.plain_results(F.col("t"), F.col("k")).alias("p")).collect()}
    whole = {r.i: r.results for r in replies.with_results(rows, F.col("t"), F.col("k")).collect()}
    n_plain = 0
    for i, t in enumerate(texts):
        want = replies.results(t, KEYS if i % 4 == 0 else ["a", "é"])
        assert [r.asDict(True) for r in whole[i]] == want, t
        if plain[i] is not None:
            assert [r.asDict(True) for r in plain[i]] == want, t
            n_plain += 1
    assert n_plain > 150


def test_well_formed_replies_take_no_python(spark):
    said = '{"results":[{"key":"a","value":"yes","cited_text":["q"],"comment":"c","confidence":90},{"key":"b","value":null,"cited_text":null,"comment":"","confidence":null}]}'
    rows = spark.createDataFrame([(said, ["a", "b"]), (f"```json\n{said}\n```", ["a"]), ('{"key":"a","value":3}\n{"key":"b","value":true}', ["b", "a", "c"])], "t string, k array<string>")
    plain = rows.select(replies.plain_results(F.col("t"), F.col("k")).alias("p"))
    assert plain.where("p is null").count() == 0
    assert "Python" not in plain._jdf.queryExecution().toString()


@pytest.mark.parametrize("reply", ['{"key":["a"],"value":1}', "[" * 100_000, '{"key":"a","value":"\\ud800"}', '{"key":"a","value":1,"comment":"\\udfff"}'])
def test_odd_replies_spoil_their_group_alone(spark, reply):
    rows = spark.createDataFrame([(1, reply, ["a"]), (2, '{"key":"a","value":1}', ["a"])], "i int, t string, k array<string>")
    got = {r.i: r.e for r in replies.with_results(rows, F.col("t"), F.col("k")).select("i", replies.extraction_error(F.col("results")).alias("e")).collect()}
    assert got == {1: "Pass-2 extraction failed for 1 key(s): 'a': key 'a' not found in pass-2 output", 2: None}


def test_confidence_that_no_whole_number_is():
    said = '[{"key":"a","value":1,"confidence":%s}]'
    assert [replies.results(said % x, ["a"])[0]["confidence"] for x in ("NaN", "Infinity", "1e999", "3000000000", "-2.9", "7", "true")] == [None, None, None, None, -2, 7, None]


def test_blank_quotes_are_no_citations(spark):
    quotes = F.array(*map(F.lit, ["\n\t", " ", " ", "", "a", " b\n"]))
    row = spark.range(1).select(C.citations(quotes, F.array(*[F.lit(True)] * 6)).alias("c"), C.ellipsis_parts(F.lit("\ta\n ... \n… b ")).alias("e"), C.simple_text(F.array(F.lit(" A  b"), F.lit("\tc"))).alias("s")).first()
    assert [c.text for c in row.c] == ["a", " b\n"] and row.e == ["a", "b"] and row.s == "a b c"


def test_replies_are_read_once_by_one_function(spark):
    """No variant expressions, which a filter over the results would evaluate again, and values shown as Python shows them."""
    from inkgrid.operators import sinks

    none = F.lit(None).cast("string")
    said = F.struct(F.lit('{"key":"a","value":[1.0,"x",["y\'"],{"z":null}]}').alias("text"), none.alias("error"))
    done = spark.range(5).select(F.col("id").cast("string").alias("cid"), F.array(F.lit("a"), F.lit("b")).alias("keys"), none.alias("pass1_text"), said.alias("completion"))
    put_aside = sinks.quarantine(done)
    assert [list(r.failed_keys) for r in put_aside.collect()] == [["b"]] * 5
    assert "variant" not in put_aside._jdf.queryExecution().optimizedPlan().toString().lower()
    for x in ([1.0, "x", ["y'"], {"z": None}], [], ["a"], [[[]], True]):
        got = replies.value_of(x)
        assert (got["said"], got["items"]) == (str(x), [str(i) for i in x])


def test_texts_that_nothing_is_quoted_from_are_not_read(spark, monkeypatch):
    from inkgrid.functions import evidence
    from inkgrid.plans import catalog, engine

    def told(cited, kinds, text):
        return F.transform(cited, lambda q: F.struct(F.lit(True).alias("ok"), F.coalesce(text, F.lit("unread")).alias("note"), F.array().cast("array<boolean>").alias("each"), F.array().cast("array<string>").alias("notes")))

    monkeypatch.setattr(evidence, "verify_columns", lambda *how: told)
    task = engine.annotation(catalog.questions(spark))(engine.S.overlaid('{"batching": "all"}'))
    rows = spark.createDataFrame([("c", 1, 2, 0, ["quality", "kind", "size"], "a text", "", "")], "cid string, run_id long, paper_id long, group_idx int, keys array<string>, source string, questions string, messages string")
    quoted = lambda rows: F.concat(F.lit('{"key":"'), rows, F.lit('","value":null,"cited_text":"a quote"}'))
    formatted = engine.pass2(engine.pass1(rows), task)
    notes = lambda f: {r.note for r in engine.answers(f, task).select("checked.note").collect()}
    assert notes(formatted) == {"unread"}
    assert notes(formatted.withColumn("completion", F.col("completion").withField("text", F.array_join(F.transform("keys", quoted), "\n")))) == {"a text"}
