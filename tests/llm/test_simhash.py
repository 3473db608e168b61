import random

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from sparkbook.llm import simhash

from .data import frame, rows


def plain_fingerprint(text, shingle=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    h = [xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps, max_bits):
    """Smallest index reachable, by brute force over all pairs."""
    label = list(range(len(fps)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= max_bits:
                a, b = sorted((find(i), find(j)))
                label[b] = a
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("text", ["", None, "one", "One TWO three", "one two three four", "a b c d e f g a b c d e f g", "Äpfel\tÖL x\x0by z", "w " * 20_000])
def test_fingerprint(text):
    assert simhash.fingerprint(text, 4) == plain_fingerprint(text)


def test_near_duplicates_against_brute_force(spark):
    data = rows()
    got = {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(frame(spark, data, clashes=True)).collect()}
    fps = [plain_fingerprint(r[1]) for r in data]
    roots = plain_components(fps, 4)
    least = {}
    for r, root in zip(data, roots, strict=True):
        if r[0] is not None:
            least[root] = min(least.get(root, r[0]), r[0])
    assert got == {(r[0], f"{fp:016x}", least.get(root)) for r, fp, root in zip(data, fps, roots, strict=True)}


@pytest.mark.parametrize("chunk", [7, 4096])
def test_no_link_is_lost_in_dense_groups(spark, chunk):
    """Chains and balls of fingerprints, in buckets far above a small chunk."""
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(4)] + [0]
    fps = set(centres)
    for c in centres:
        for _ in range(120):
            x = c
            for b in rng.sample(range(64), rng.randint(1, 6)):
                x ^= 1 << b
            fps.add(x)
    fps |= {rng.getrandbits(64) for _ in range(60)}
    fps = sorted(fps)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    links = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), 4, chunk)
    assert links.count() < 40 * len(fps)
    root = {r["node"]: r["root"] for r in simhash.components(links).collect()}
    want = plain_components(fps, 4)
    classes = {}
    for x, w in zip(signed, want, strict=True):
        classes.setdefault(w, set()).add(root.get(x, x))
    assert all(len(c) == 1 for c in classes.values())
    assert len({next(iter(c)) for c in classes.values()}) == len(classes)


def test_pairs_within_reach_share_a_bucket():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 2**64, 500, dtype=np.uint64)
    b = a.copy()
    for _ in range(4):
        b ^= np.uint64(1) << rng.integers(0, 64, 500, dtype=np.uint64)
    assert (simhash.bucket_keys(a, 6) == simhash.bucket_keys(b, 6)).any(axis=1).all()


def test_long_path_settles(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    assert {r["root"] for r in simhash.components(edges).collect()} == {0}


def test_one_document_of_each_group_stays(spark):
    data = rows()
    docs = frame(spark, data, clashes=True)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    groups = simhash.near_duplicates(docs).select("component_id").distinct().count()
    assert len(ids) == groups
    assert 0 in ids and not {100, 101, 102, 103, 110} & set(ids)
    assert ids.count(135) + ids.count(1) == 1


def test_empty_table(spark):
    empty = frame(spark, rows()).limit(0)
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.one_of_each(empty).collect() == []
