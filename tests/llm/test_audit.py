import random
from itertools import permutations

import numpy as np
import pytest

from marketframe.llm import audit

DOCS = "doc_id long, text string, lang string, part string, word string"
LABELS = "doc_id long, quality int, toxic int, good int"


def brute(docs, labels):
    """The report by filtering in every order."""
    first = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    rows = []
    for doc_id, text, lang in docs:
        text = text or ""
        words = [w for w in audit_split(text) if w]
        fails = ""
        fails += "A" if len(words) < 200 else ""
        fails += "B" if 100 * len(set(words)) < 50 * len(words) else ""
        fails += "C" if 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text) else ""
        fails += "D" if any(c in "#$%&*|" for c in text) else ""
        fails += "E" if doc_id is not None and doc_id > first[text] else ""
        own = [label for label in labels if doc_id is not None and label[0] == doc_id]
        rows.append((lang or "", fails, any(q == 1 for _, q, _ in own), any(t == 1 for _, _, t in own)))
    out = {}
    for part in {r[0] for r in rows}:
        here = [r for r in rows if r[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = here
            for step, name in enumerate(order, 1):
                gone = [r for r in left if name in r[1]]
                left = [r for r in left if name not in r[1]]
                shapley[name] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(name in r[1] for r in here) - len(gone), sum(r[1] == name for r in here),
                    sum(r[2] for r in gone), sum(r[3] for r in gone),
                ]
        for order in permutations("ABCDE"):
            for step, name in enumerate(order, 1):
                out[part, "".join(order), step].append(shapley[name])
    return {k: tuple(v) for k, v in out.items()}


def audit_split(text):
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return text.split(" ")


def held(spark, docs, labels):
    frame = spark.createDataFrame([(*d, "x", "y") for d in docs], DOCS)
    told = spark.createDataFrame([(*r, 7) for r in labels], LABELS)
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in audit.audit(frame, told).collect()}


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 31, 1000, 70001])
def test_positional_popcount(n):
    words = np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint32)
    want = (words[:, None] >> np.arange(32, dtype=np.uint32) & 1).sum(axis=0)
    assert (audit.positional_popcount(words) == want).all()


@pytest.mark.parametrize("fails", range(32))
def test_word_is_the_truth_table(spark, fails):
    word = spark.range(1).select(audit.truth_word(audit.F.lit(fails))).first()[0]
    assert [word >> s & 1 for s in range(32)] == [int(not s & fails) for s in range(32)]


def test_against_brute_force(spark, monkeypatch):
    rng = random.Random(2)
    texts = [None, "", " \n\x0b", "é" * 40, "Aé" * 30]
    for _ in range(40):
        words = [f"w{rng.randrange(rng.choice([20, 2000]))}" for _ in range(rng.choice([10, 199, 200, 201, 400]))]
        texts.append(" ".join(words) + rng.choice(["", "", "|", " " + "A" * rng.choice([1, 30, 80])]))
    docs = [(rng.choice([None, *range(100)]), rng.choice(texts), rng.choice([None, "", "en", "de", "x y"])) for _ in range(250)]
    docs += docs[:20]
    labels = [(rng.choice([None, *range(120)]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1])) for _ in range(150)]
    assert held(spark, docs, labels) == brute(docs, labels)


def test_exact_shares_are_not_failures(spark):
    half = " ".join([f"w{i}" for i in range(100)] * 2)
    capitals = "A" * 3 + "b" * 97
    found = held(spark, [(1, half, "en"), (2, capitals, "en")], [])
    assert found["en", "BACDE", 1][:2] == (2, 0) and found["en", "CABDE", 1][:2] == (2, 0)


def test_many_parts_and_empty(spark, monkeypatch):
    monkeypatch.setattr(audit, "PARTS", 3)
    monkeypatch.setattr(audit, "BLOCK", 7)
    docs = [(i, "a b|" * (i % 5), f"l{i % 11}") for i in range(60)]
    assert held(spark, docs, []) == brute(docs, [])
    assert held(spark, [], [(1, 1, 1)]) == {}
