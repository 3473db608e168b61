import random
from collections import defaultdict
from itertools import permutations

import pytest

from sparkbook.llm import filter_audit as A

from .data import frame, rows, sentence

LABELS = "doc_id long, quality int, toxic int"


def plain(data, labels):
    """The audit by applying the filters in every order, document by document."""
    docs = []
    for i, (doc_id, text, _, source) in enumerate(data):
        t = text or ""
        w = t.encode().split()
        fails = {
            "A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t),
            "D": any(c in "#$%&*|" for c in t), "E": doc_id is not None and any(d[0] is not None and d[0] < doc_id and (d[1] or "") == t for d in data),
        }
        mine = [x for x in labels if x[0] == doc_id and doc_id is not None]
        docs.append((source or "", {f for f, x in fails.items() if x}, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    out, shapley = {}, defaultdict(int)
    for part in {d[0] for d in docs}:
        for order in map("".join, permutations("ABCDE")):
            left = [d for d in docs if d[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                removed = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                out[part, order, step] = [len(left), len(removed), sum(f in d[1] for d in gone), sum(d[1] == {f} for d in docs if d[0] == part), sum(d[2] for d in removed), sum(d[3] for d in removed)]
                shapley[part, f] += len(removed)
                gone += removed
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def awkward():
    rng = random.Random(4)
    data = rows()
    for i in range(60):
        t = sentence(rng, rng.choice([10, 60]))
        t = rng.choice([t, t.upper(), "word " * 70, t + " #1", t + " 50%"])
        data.append((400 + i, t, "en", rng.choice(["s1", "s2", None, ""])))
    data += [(500 + i, data[len(data) - 60 + i % 3][1], "en", "s9") for i in range(25)]
    return data


@pytest.mark.parametrize("hot", [1000, 7])
def test_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(A, "HOT", hot)  # 7: hashes with a seventh of the rows are salted
    data = awkward()
    if hot == 7:
        data += [(600 + i, data[0][1], "fr", "s1") for i in range(60)]
    rng = random.Random(9)
    labels = [(d[0], rng.choice([0, 1, None]), rng.choice([0, 1, None])) for d in data if rng.random() < 0.7]
    labels += [(402, 1, 1), (402, 0, 0), (None, 1, 1), (99999, 1, 1)]
    got = A.audit(frame(spark, data, clashes=True), spark.createDataFrame(labels, LABELS)).collect()
    want = plain(data, labels)
    assert {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in got} == want and len(got) == len(want)


def test_steps_of_an_order_add_up(spark):
    got = A.audit(frame(spark, awkward()), spark.createDataFrame([], LABELS)).collect()
    size = defaultdict(int)
    for r in awkward():
        size[r[3] or ""] += 1
    for part in size:
        for order in ("ABCDE", "EDCBA"):
            steps = sorted((r for r in got if r["part"] == part and r["filter_order"] == order), key=lambda r: r["step"])
            assert steps[-1]["kept"] + sum(r["removed"] for r in steps) == size[part]
        once = {r["filter_order"][r["step"] - 1]: r["shapley"] for r in got if r["part"] == part}
        assert sum(once.values()) == 120 * (size[part] - steps[-1]["kept"])


def test_empty_tables(spark):
    none = spark.createDataFrame([], LABELS)
    assert A.audit(frame(spark, rows()).limit(0), none).collect() == []


def test_equal_hash_needs_equal_text(spark, monkeypatch):
    """With a hash that puts all texts together, the exact text still decides."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(A, "text_hash", lambda text: [F.lit(1).cast("long").alias("h"), F.lit(2).cast("long").alias("h2")])
    data = [(1, "a", "", "s"), (2, "b", "", "s"), (3, "a", "", "s"), (4, "a ", "", "s"), (5, None, "", "s"), (6, "", "", "s")]
    got = A.combinations(frame(spark, data), spark.createDataFrame([], LABELS)).collect()
    assert sum(r["n"] for r in got if r["bits"] & 16) == 2  # documents 3 and 6
