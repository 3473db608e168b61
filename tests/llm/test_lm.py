import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from sparkbook.llm import lm
from sparkbook.llm.common import saved, shuffles_deleted
from sparkbook.llm.elias_fano import EliasFano, Level

from .data import frame, rows


@pytest.mark.parametrize(("n", "universe"), [(0, 1), (1, 1), (1, 10**12), (5, 3), (1000, 10), (1000, 10**6), (50_000, 10**13), (5000, 5000)])
def test_elias_fano_round_trip_and_search(n, universe):
    rng = np.random.default_rng(n)
    v = np.sort(rng.integers(0, universe, n)).astype(np.uint64)
    e = EliasFano(EliasFano.encode(v))
    assert (e[np.arange(n)] == v).all()
    q = np.concatenate([rng.integers(0, universe + 5, 2000).astype(np.uint64), v[:2000], np.array([0, 2**50], np.uint64)])
    at, same = e.find(q)
    assert (at == np.searchsorted(v, q, "left")).all() and (same == np.isin(q, v)).all()


def test_level_finds_its_rows_and_no_others(tmp_path):
    rng = np.random.default_rng(1)
    rows_ = np.unique(np.stack([rng.zipf(1.4, 30_000).clip(0, 3000), rng.integers(0, 500, 30_000)], 1), axis=0)
    logp = -8 * rng.random(len(rows_))
    raw = Level.encode(rows_[:, 0], rows_[:, 1], logp)
    lm.write_level(raw, str(tmp_path / "level"))
    for level in (Level(raw), lm.open_level(str(tmp_path / "level"))):
        code, found = level.lookup(rows_[:, 0], rows_[:, 1])
        assert found.all() and np.abs(level.book[code] - logp).max() < 0.05
        present = set(map(tuple, rows_.tolist()))
        for step in ((0, 1), (1, 0), (5000, 3)):
            asked = rows_ + np.array(step)
            assert level.lookup(asked[:, 0], asked[:, 1])[1].tolist() == [tuple(r) in present for r in asked.tolist()]
    assert len(raw) < 6 * len(rows_)  # compact: a plain row takes 20 bytes


def plain_scores(data, mu=lm.MU):
    texts = [[*re.findall(rb"[^\x20\x09-\x0D]+", (r[1] or "").encode().lower()), None] for r in data]
    held = [r[0] is not None and zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in data]
    uni, bi = Counter(), Counter()
    for words, h in zip(texts, held, strict=True):
        if not h:
            uni.update(words)
            bi.update(zip([0, *words], words, strict=False))
    n, v, starts = sum(uni.values()), len(uni), held.count(False)
    out = []
    for r, words, h in zip(data, texts, held, strict=True):
        p1 = [(uni[w] + 0.1) / (n + 0.1 * (v + 1)) for w in words]
        score = 0.0
        for prev, w, p in zip([0, *words], words, p1, strict=False):
            total = starts if prev == 0 else uni[prev]
            score += math.log10((bi[prev, w] + mu * p) / (total + mu)) if total else math.log10(p)
        out.append((r[0], h, len(words), sum(uni[w] > 0 for w in words), n, sum(map(math.log10, p1)), score))
    return out


@pytest.mark.parametrize("size", [300, lm.BATCH])
def test_scores_against_brute_force(spark, size):
    """With small batches there are many shards, and frequent words are dealt over several."""
    data = rows()
    got = lm.scores(frame(spark, data, clashes=True), size=size).collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[2])
    got, want = sorted(map(tuple, got), key=order), sorted(plain_scores(data), key=order)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[5] == pytest.approx(w[5], rel=1e-9)
        assert g[6] == pytest.approx(w[6], abs=0.03 * w[2])


def test_probabilities_sum_to_one():
    """Over all successors of a context and one unseen word, by the formulas of the operator."""
    uni, bi, mu = {"a": 5, "b": 3, "c": 2}, {("a", "b"): 3, ("a", "c"): 1, ("a", "a"): 1}, lm.MU
    n, v = 10, 3
    p1 = {w: (c + 0.1) / (n + 0.1 * (v + 1)) for w, c in uni.items()} | {"?": 0.1 / (n + 0.1 * (v + 1))}
    assert sum((bi.get(("a", w), 0) + mu * p) / (5 + mu) for w, p in p1.items()) == pytest.approx(1)


def test_held_out_text_scores_above_the_base(spark):
    data = [(i, "the cat sat on the mat and the dog ran off " * (3 + i % 4), "en", "s") for i in range(60)]
    for r in lm.scores(frame(spark, data)).collect():
        assert r["score"] > r["base_score"]


def test_levels_can_be_kept(spark):
    result, levels = lm.scores(frame(spark, rows()), size=500, keep_levels=True)
    assert result.count() == len(rows())
    assert sum(Level(bytes(r["level"])).successors.n for r in levels.collect()) > 1000


def test_number_arrays_round_trip():
    arrays = [np.arange(300), np.zeros(0, np.int64), np.array([2**63], np.uint64), np.array([1.5, -2.0]), np.array([0.25], "<f2")]
    for a, b in zip(arrays, lm.unpacked(lm.packed(*arrays), len(arrays)), strict=True):
        assert a.tolist() == b.tolist()


def test_empty_table_and_no_training_rows(spark):
    assert lm.scores(frame(spark, rows()).limit(0)).collect() == []
    held = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    (r,) = lm.scores(frame(spark, [(held, "a b", "en", "s")])).collect()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (3, 0, 0) and r["score"] == r["base_score"]


def grams(texts, shards=3):
    """The grams of one batch that holds these training texts, with the answers that its words got."""
    from xxhash import xxh64_intdigest

    words = [[*t.encode().split(), lm.END] for t in texts]
    h = {w: xxh64_intdigest(w) for ws in words for w in ws}
    ranked = np.sort(np.array(list(h.values()), np.uint64))
    tokens = np.searchsorted(ranked, np.array([h[w] for ws in words for w in ws], np.uint64))
    count = np.bincount(tokens)
    own = (ranked % np.uint64(shards)).astype(int)
    counted = [(s, lm.packed(np.flatnonzero(own == s) + 1, count[own == s])) for s in range(shards)]
    end = np.searchsorted(ranked, np.array([h[lm.END]], np.uint64))
    body = lm.packed(tokens, np.array([len(w) for w in words]), np.zeros(len(words), np.uint8), end)
    return lm.Grams(lm.packed(ranked, count), body, counted, shards, float(count.sum()), lm.MU, lm.BATCH)


def test_a_hot_bigram_costs_one_entry_per_batch():
    """A pair that is nearly all tokens is sent once, with its count: nothing in a shard grows with its occurrences."""
    few, many = ([lm.unpacked(b, 6) for _, b in grams(["x y " * n, "y z"]).bigrams()] for n in (50, 50_000))
    assert [[len(a) for a in q] for q in few] == [[len(a) for a in q] for q in many]
    assert max(int(q[4].max()) for q in many) == 50_000 and sum(len(q[3]) for q in many) == 7


def plain_trigram_scores(data, mu=lm.MU):
    texts = [[*re.findall(rb"[^\x20\x09-\x0D]+", (r[1] or "").encode().lower()), None] for r in data]
    held = [r[0] is not None and zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in data]
    uni, bi, tri = Counter(), Counter(), Counter()
    for words, h in zip(texts, held, strict=True):
        if not h:
            uni.update(words)
            bi.update(zip([0, *words], words, strict=False))
            tri.update(zip([0, *words], words, words[1:], strict=False))
    n, v, starts = sum(uni.values()), len(uni), held.count(False)
    out = []
    for r, words in zip(data, texts, strict=True):
        score = 0.0
        for k, w in enumerate(words):
            p = (uni[w] + 0.1) / (n + 0.1 * (v + 1))
            prev = words[k - 1] if k else 0
            total = uni[prev] if k else starts
            p = (bi[prev, w] + mu * p) / (total + mu) if total else p
            if k:
                pair = (words[k - 2] if k > 1 else 0, prev)
                p = (tri[(*pair, w)] + mu * p) / (bi[pair] + mu) if bi[pair] else p
            score += math.log10(p)
        out.append((r[0], len(words), score))
    return out


@pytest.mark.parametrize("size", [300, lm.BATCH])
def test_trigram_scores_against_brute_force(spark, size):
    data = rows()
    got, tries = lm.scores(frame(spark, data, clashes=True), size=size, keep_levels=True, order=3)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got = sorted(((r["doc_id"], r["n_tokens"], r["score"]) for r in got.collect()), key=key)
    want = sorted(plain_trigram_scores(data), key=key)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[2] == pytest.approx(w[2], abs=0.03 * w[1])
    assert sum(lm.Trie(bytes(r["level"])).thirds.successors.n for r in tries.collect()) > 1000


def test_the_query_sees_two_words_of_context(spark, tmp_path):
    """Which word follows 'k' depends on the word before it: one word of context gives each half, two give nearly all."""
    data = [(i, ("a k x " if i % 2 else "b k y ") * 40, "en", "s") for i in range(200)]
    frame(spark, data).write.parquet(str(tmp_path / "documents.parquet"))
    from sparkbook.llm.catalog import QUERIES

    for r in QUERIES["op3_lm_scoring"](spark, str(tmp_path)).collect():
        assert r["score"] > -3  # start, end and 39 repeats cost 2.35; each half of 'k' would cost another 12


def test_trie_paths():
    rng = np.random.default_rng(5)
    t = np.unique(rng.integers(0, 30, (4000, 3)), axis=0)
    trie = lm.Trie(lm.Trie.encode(*t.T, np.full(len(t), -0.5), -8 * rng.random(len(t))))
    assert trie.lookup(*t.T)[1].all()
    present = set(map(tuple, t.tolist()))
    for step in ((0, 0, 1), (0, 1, 0), (1, 0, 0), (500, 0, 0)):
        asked = t + np.array(step)
        assert trie.lookup(*asked.T)[1].tolist() == [tuple(r) in present for r in asked.tolist()]


def test_bigrams_and_trigrams_are_asked_in_one_round(spark, monkeypatch):
    """Batches cross a shuffle once to ask and once to add up, and without their words' hashes."""
    kept = []
    monkeypatch.setattr(lm, "saved", lambda df, name: (kept.append(name), saved(df, name))[1])
    assert lm.scores(frame(spark, rows()), size=500, order=3).count() == len(rows())
    assert kept == ["tokens", "words", "tokens", "grams", "scores"]


def test_words_are_numbered_once_for_many_shards_of_grams(spark):
    """A batch's messages on words do not grow with the shards of grams."""
    words = spark.createDataFrame([(0, 9, [1], lm.packed(np.arange(1, 900, dtype=np.uint64) * np.uint64(2**40 + 7), np.ones(899, np.int64)), b"")], lm.BATCHES)
    (slim,) = lm.with_word_shards(words, 5).collect()
    assert len(slim["words"]) < 500 and max(lm.unpacked(bytes(slim["words"]), 2)[0]) == 4
    assert lm.word_counts(words, 5).filter("batch is not null").count() == 5


def test_hot_pairs_have_their_third_words_dealt():
    """'x y' is followed by ever new words: its third words go to many shards, and the counts of pairs stay in one."""
    g = grams(["".join(f"x y w{i} " for i in range(3000))], shards=7)
    g.size = 100
    sent = {s: lm.unpacked(b, 8) for s, b in g.messages(3)}
    x, y = (int(v) for v in (g.ctx[g.train.argmax()], g.succ[g.train.argmax()]))
    pair = {s: (np.repeat(q[0], q[1]) == x) & (q[3] == y) for s, q in sent.items()}
    assert sorted(int(q[4][pair[s]].sum()) for s, q in sent.items())[-2:] == [0, 3000]
    assert max(int(q[5][pair[s]].sum()) for s, q in sent.items()) < 1000 and sum(int(q[5][pair[s]].sum()) for s, q in sent.items()) == 3000


def test_shuffle_files_go_with_their_query(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    with shuffles_deleted(spark):
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key) == before
