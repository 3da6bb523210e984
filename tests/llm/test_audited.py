"""Operator 12 against filters applied one after another to the documents themselves."""

import itertools
import random
import re
from collections import Counter

import pytest

from claimloom.llm import audited
from tests.llm.conftest import invented, table


def plain_fails(rows):
    """For each row the letters of the filters it fails."""
    out = []
    for k, (i, text, _) in enumerate(rows):
        t = text or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
        failing = "A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words))
        failing += "C" * (100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t)) + "D" * any(c in t for c in "#$%&*|")
        earlier = any((u or "") == t and j is not None and (i is None or j < i) for j, u, _ in rows)
        out.append(failing + "E" * earlier)
    return out


def plain_audit(rows, labels):
    """``rows`` are (doc_id, text, source), ``labels`` (doc_id, quality, toxic)."""
    fails, out = plain_fails(rows), {}
    good, toxic = ({i for i, *x in labels if i is not None and x[k] == 1} for k in (0, 1))
    for part in {s or "" for _, _, s in rows}:
        inside = [(i, f) for (i, _, s), f in zip(rows, fails) if (s or "") == part]
        total = Counter()
        for order in itertools.permutations("ABCDE"):
            left = inside
            for step, f in enumerate(order, 1):
                removed = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                total[f] += len(removed)
                failing = [x for x in inside if f in x[1]]
                lost = [sum(i in said for i, _ in removed) for said in (good, toxic)]
                out[part, "".join(order), step] = [len(left), len(removed), len(failing) - len(removed), sum(x[1] == f for x in inside), *lost]
        for (p, order, step), values in out.items():
            if p == part:
                values.append(total[order[step - 1]])
    return {(*k, *v) for k, v in out.items()}


def test_audit_equals_filters_in_a_row(spark):
    rng = random.Random(4)
    texts = ["", None, " \t\x0b\x0c\r\n", "one", "ONE TWO", "a\x1cb\x85c " * 90, "#", "É" * 5 + "A", "日 " * 250, "ab " * 300 + "|"]
    texts += [" ".join(rng.choice(["Aa", "b", "c%", f"w{rng.randrange(400)}"]) for _ in range(rng.choice([3, 199, 200, 260]))) for _ in range(40)]
    texts += [invented(rng, 230)] * 9 + [invented(rng, 230).title()] * 3
    rows = [(rng.randrange(40) if rng.random() < 0.9 else None, t, rng.choice(["s1", "s2", None, ""])) for t in texts * 2]
    labels = [(rng.choice([None, *range(45)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "'x' part", "1 cell", "2 id", "3 digest", "4 n", "'y' data").repartition(5)
    said = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "1 good", "'z' part", "2 salt")
    got = [tuple(r) for r in audited.audited(docs, said).collect()]
    assert len(got) == 3 * 600 == len(set(got)) and set(got) == plain_audit(rows, labels)


def test_odd_tables(spark, odd, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = [(r.doc_id, r.text, r.source) for r in odd.collect()]
    assert {tuple(r) for r in audited.audited(odd, none).collect()} == plain_audit(rows, [])
    assert audited.audited(nothing, none).count() == 0


@pytest.mark.parametrize("text", ["a  b\tb c" * 500, " " * 3000, "", "x" * 4000])
def test_long_texts_count_alike(text, monkeypatch):
    whole = audited.counted_words(text.encode())
    monkeypatch.setattr(audited, "LONG", 10)
    assert audited.counted_words(text.encode()) == whole
