"""Golden rows for the column helpers, and independent recomputation of the text ones."""

import json
import random

import pytest
from pyspark.sql import functions as F

from marketframe.functions import (
    change_text,
    chunk_text,
    clean_text,
    first_truthy,
    is_blank,
    is_object,
    percent_change,
    rupiah,
    safe_double,
    strip,
    to_number,
    to_text,
    truthy,
)


def column(spark, values, type_="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {type_}")
    return rows


def apply(spark, values, expression, type_="string"):
    rows = column(spark, values, type_).select("i", expression.alias("y")).collect()
    return [r["y"] for r in sorted(rows, key=lambda r: r["i"])]


def test_number_gate(spark):
    texts = ["1.5", "-3", "1-2", "--", "1.2.3", "", "1e5", "+4", " 7", "12,345", ".", "5.", ".5", "-.5", "7\n", None]
    want = [1.5, -3.0, *[None] * 9, 5.0, 0.5, -0.5, 7.0, None]
    assert apply(spark, texts, safe_double(F.col("x"))) == want


def test_number_gate_in_single_precision(spark):
    assert apply(spark, ["12345678901234"], safe_double(F.col("x"), "float")) == [12345679020032.0]
    assert apply(spark, ["12345678901234"], safe_double(F.col("x"))) == [12345678901234.0]


TRUTHY = {
    "0": False, "0.0": False, "0e5": False, "1": True, "-2.5": True, "1e20": True, "0.001": True,
    '""': False, '"0"': True, '" "': True, '"x"': True, '"false"': True, '"{}"': True, '"[]"': True,
    "null": False, "false": False, "true": True, "[]": False, "{}": False, "[0]": True, "[null]": True,
    '{"a":0}': True, "[1]": True,
}


def test_truthy(spark):
    v = F.parse_json("x")
    assert dict(zip(TRUTHY, apply(spark, list(TRUTHY), truthy(v)))) == TRUTHY
    assert all(bool(json.loads(text)) == want for text, want in TRUTHY.items())


@pytest.mark.parametrize(
    "document, want",
    [
        ('{"a":0,"b":7}', "7"),
        ('{"a":"0","b":7}', "0"),
        ('{"a":"","b":7}', "7"),
        ('{"a":null,"b":7}', "7"),
        ('{"a":false,"b":7}', "7"),
        ('{"b":7}', "7"),
        ('{"a":0,"b":null}', None),
        ('{"a":0,"b":0}', "0"),
        ('{"a":0}', None),
    ],
)
def test_first_truthy(spark, document, want):
    def get(key):
        return F.try_variant_get(F.parse_json("x"), f"$.{key}", "variant")

    assert apply(spark, [document], to_text(first_truthy(get("a"), get("a"), get("b")))) == [want]


def test_to_number(spark):
    want = {
        "12": 12.0, "1.5": 1.5, "1e20": 1e20, "1.5E3": 1500.0, '"12"': 12.0, '"1e5"': None, '"1E5"': None,
        "true": None, "null": None, "[1]": None, "{}": None, '"1,000"': None, "-0.25": -0.25,
        "123456789012345678901234567890": 1.2345678901234568e29,
    }
    assert dict(zip(want, apply(spark, list(want), to_number(F.parse_json("x"))))) == want


def test_is_object(spark):
    want = {"{}": True, '{"a":1}': True, "[]": False, '[{"a":1}]': False, "1": False, '"{}"': False, "null": False}
    assert dict(zip(want, apply(spark, list(want), is_object(F.parse_json("x"))))) == want


def test_strip_knows_all_white_space(spark):
    blanks = "".join(chr(c) for c in range(0x3100) if chr(c).isspace())
    texts = [f"{blanks}a {blanks} b{blanks}", blanks, "", "a"]
    assert apply(spark, texts, strip(F.col("x"))) == [t.strip() for t in texts]
    assert apply(spark, [*texts, None], is_blank(F.col("x"))) == [False, True, True, False, True]


def test_clean(spark):
    want = {
        'IQPlus, (15/3) - "Foo" (a(b)c) ok (end)': "- Foo c) ok",
        "“x” ‘y’ (one\ntwo) z": "x y (one\ntwo) z",
        "(a\rb)c": "c",
        "(((": "(((",
        "IQIQPlus,Plus, x": "IQPlus, x",
        "": "",
    }
    assert dict(zip(want, apply(spark, list(want), clean_text(F.col("x"))))) == want


def assert_chunks(text, chunks, limit):
    """What chunking promises: the text's sentences in order, no chunk too long, none that could take one more."""
    sentences = text.split(". ")
    if len(sentences[0]) >= limit:
        assert chunks[0] == ""
        chunks = chunks[1:]
    # each chunk is a run of sentences, and the runs follow each other
    ends, at = [], 0
    for chunk in chunks:
        end = next((e for e in range(at + 1, len(sentences) + 1) if "".join(s + ". " for s in sentences[at:e]).strip() == chunk), None)
        # blank sentences at the edge of a run leave no trace in the stripped chunk
        while end is not None and end < len(sentences) and size(sentences[at : end + 1]) < limit and not (sentences[end] + ". ").strip(". "):
            if "".join(s + ". " for s in sentences[at : end + 1]).strip() != chunk:
                break
            end += 1
        assert end is not None, (text, chunk)
        ends.append((at, end))
        at = end
    assert at == len(sentences)
    for start, end in ends:
        assert end - start == 1 or size(sentences[start:end]) < limit
    for (start, end), (_, after) in zip(ends, ends[1:]):
        assert size(sentences[start : end + 1]) >= limit and after > end


def size(run):
    """The length that counts against the limit: the sentences with their ends, but for the last end."""
    return sum(len(s) + 2 for s in run) - 2


@pytest.mark.parametrize(
    "text, want",
    [
        ("aaa. bbb. cccccccccccccccc. d", ["aaa. bbb.", "cccccccccccccccc.", "d."]),
        ("cccccccccccccccc. d", ["", "cccccccccccccccc.", "d."]),
        ("aaa. ", ["aaa. ."]),
        ("", ["."]),
        ("x. . y", ["x. . y."]),
        ("123456789. ", ["123456789.", "."]),
    ],
)
def test_chunks(spark, text, want):
    assert_chunks(text, want, 10)
    assert apply(spark, [text], chunk_text(F.col("x"), 10)) == [want]


def test_chunks_of_random_texts(spark):
    rng = random.Random(7)
    alphabet = ["a", "b", ".", " ", ". ", "é", "😀", "\n", "\r", " ", "long " * 8, " "]
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(0, 120))) for _ in range(400)]
    for limit in (5, 30, 1000):
        got = apply(spark, texts, chunk_text(F.col("x"), limit))
        for text, chunks in zip(texts, got):
            assert_chunks(text, chunks, limit)


def test_chunks_of_a_very_long_text(spark):
    text = "word " * 400_000 + ". " + "Short sentence. " * 20_000
    chunks = apply(spark, [text], chunk_text(F.col("x")))[0]
    assert "".join(chunks).replace(" ", "").replace(".", "") == text.replace(" ", "").replace(".", "")
    assert chunks[0] == "" and len(chunks[1]) > 1_000_000 and all(len(c) <= 1000 for c in chunks[2:])
    assert all(len(c) + len("Short sentence") > 980 for c in chunks[2:-1])


def test_rupiah(spark):
    assert apply(spark, [1234567.9, -1234.5, 0.0], rupiah(F.col("x")), "double") == ["Rp 1,234,567", "Rp -1,234", "Rp 0"]


def test_change_text_rounds_like_the_exact_value(spark):
    percents = [2.675, 0.125, -0.375, 1234.5, -0.001]
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(percents)], "i int, p double")
    texts = [r[0] for r in rows.orderBy("i").select(change_text(F.col("p"), F.col("p"))).collect()]
    assert [t.split("(")[1] for t in texts] == [f"{'+' if p >= 0 else ''}{p:.2f}%)" for p in percents]
    assert texts[3].startswith("↑ Rp 1,234 (") and texts[2].startswith("↓ Rp 0 (")


def test_percent_change_from_zero_is_null(spark):
    rows = spark.createDataFrame([(0.0, 5.0), (4.0, 5.0)], "a double, b double")
    assert [r[0] for r in rows.select(percent_change(F.col("a"), F.col("b"))).collect()] == [None, 25.0]
