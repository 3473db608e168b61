import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from sparkbook.llm import merkle as M

from .data import frame, rows


def h(x):
    return hashlib.sha256(x.encode()).hexdigest()


def leaf(r, more=0):
    doc_id, text, lang, source = r
    n = None if text is None else len(text) + more
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n, text)))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i : i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def climb(tree, i):
    """[(siblings to the left, to the right)] of a node, level by level."""
    out = []
    for nodes in tree[:-1]:
        run = i - i % 2
        out.append(("".join(nodes[run:i]), "".join(nodes[i + 1 : run + 2])))
        i //= 2
    return out


def plain(data):
    groups = defaultdict(list)
    for r in data:
        groups[r[2]].append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    for x in langs:
        groups[x].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = [levels([leaf(r) for r in groups[x]]) for x in langs]
    top = levels([t[-1][0] for t in trees]) if trees else []
    out = []
    for k, x in enumerate(langs):
        for i, r in enumerate(groups[x]):
            path = climb(trees[k], i) + climb(top, k)
            at = leaf(r, 1 if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 else 0)
            for a, b in path:
                at = h(a + at + b)
            out.append((r[0], leaf(r), trees[k][-1][0], top[-1][0], h("".join(a + b for a, b in path)), at, at == top[-1][0]))
    return out


def languages(n, seed=1):
    rng = random.Random(seed)
    return [(i, f"text {i}", rng.choice(["en", "en", "en", "fr", "ü", "z", None]), "s") for i in range(n)]


ONE, LONE = [(i, "t", "en", "s") for i in range(33)], [(i, "t", f"l{i}", "s") for i in range(9)]
CASES = [(rows(), 1), (rows(), 8), (languages(1), 8), (languages(2), 1), (languages(3), 8), (languages(67), 3), (ONE, 1), (ONE, 3), (LONE, 1), (LONE, 8)]


# blocks of 2 and 8 nodes put several rounds into small trees
@pytest.mark.parametrize(("data", "step"), CASES)
def test_against_brute_force(spark, data, step):
    got = M.manifest(frame(spark, data, clashes=True), M.picked(7), step).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    assert sorted(map(tuple, got), key=str) == sorted(plain(data), key=str)


def test_many_shuffle_partitions_give_the_same_tree(spark):
    data, old = languages(120), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 31)
    try:
        got = M.manifest_report(frame(spark, data)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert sorted(map(tuple, got), key=str) == sorted(plain(data), key=str)
    assert {r["verified"] for r in got} == {True, False}


def test_only_tampered_documents_fail(spark):
    got = M.manifest_report(frame(spark, rows())).collect()
    for r in got:
        tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
        null = r["doc_id"] == 130  # its n_chars is null and stays so
        assert r["verified"] == (not tampered or null)


def test_other_columns_and_extreme_lengths(spark):
    docs = frame(spark, languages(5)).selectExpr("doc_id", "text", "lang", "source", "9223372036854775807 as n_chars", "'x' as leaf", "'y' as tree")
    got = M.manifest_report(docs).collect()
    assert len(got) == 5 and all(r["verified"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 != 0) for r in got)


def test_empty_table(spark):
    assert M.manifest_report(frame(spark, rows()).limit(0)).collect() == []
