import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from sparkbook.llm import substring_dedup as S

from .data import frame, rows, sentence


def plain(data, width=13):
    """[(doc_id, n_words, removed word numbers, kept words)] by brute force."""
    starts = defaultdict(set)
    for doc_id, text, *_ in data:
        w = (text or "").encode().split()
        for i in range(len(w) - width + 1):
            if doc_id is not None:
                starts[tuple(w[i : i + width])].add(doc_id)
    out = []
    for doc_id, text, *_ in data:
        w = (text or "").encode().split()
        gone = set()
        for i in range(len(w) - width + 1):
            if doc_id is not None and min(starts[tuple(w[i : i + width])]) < doc_id:
                gone |= set(range(i, i + width))
        out.append((doc_id, len(w), gone, b" ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def awkward():
    rng = random.Random(11)
    data = rows()
    passage = sentence(rng, 60)
    words = passage.split()
    data += [(300 + i, sentence(rng, 20) + " " + passage + "\t" + sentence(rng, 5), "en", "s1") for i in range(4)]
    data += [(310, " ".join(words[7:20]), "en", "s1"), (311, " ".join(words[7:19]), "en", "s1")]  # 13 words, 12 words
    data += [(312, " ".join([*words[:30], "changed", *words[31:]]), "en", "s1")]
    data += [(320, "la " * 40, "en", "s1"), (321, "la " * 13 + "x", "en", "s1"), (322, "Ünïcode ​ word " * 9, "en", "s1"), (323, "Ünïcode ​ word " * 9, "en", "s1")]
    return data


def spans(gone):
    edges = sorted(gone)
    out = []
    for k in edges:
        if out and out[-1][1] == k:
            out[-1][1] = k + 1
        else:
            out.append([k, k + 1])
    return ",".join(f"{a}:{b}" for a, b in out)


# limit 1: every repeated prefix is lengthened; 7: groups end inside a partition; 100000: one group of records at once
@pytest.mark.parametrize("limit", [1, 7, 100_000])
def test_against_brute_force(spark, limit):
    data = awkward()
    docs = frame(spark, data, clashes=True)
    got = S.with_cuts(docs, limit=limit).select("row.doc_id", "cut.n_words", "cut.n_removed", "cut.text", "cut.spans").collect()
    want = [(i, n, len(gone), kept.decode(), spans(gone)) for i, n, gone, kept in plain(data)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    removed = {r["doc_id"]: r["n_removed"] for r in got}
    assert removed[300] == 0 and removed[301] == removed[303] == 60  # the passage goes as one stretch, what stands around it stays
    assert removed[310] == 13 and removed[311] == 0


@pytest.mark.parametrize(("width", "prefix"), [(5, 1), (5, 5), (13, 9), (1, 1)])
def test_other_widths_and_prefixes(spark, width, prefix):
    data = awkward()[:60] + awkward()[-11:]
    got = S.with_cuts(frame(spark, data), width=width, prefix=prefix, limit=20).select("row.doc_id", "cut.n_words", "cut.n_removed", "cut.text").collect()
    want = [(i, n, len(gone), kept.decode()) for i, n, gone, kept in plain(data, width)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_equal_windows_meet_under_one_prefix():
    """Wherever a 13-word sequence stands, its prefix and the place of the prefix in it are the same."""
    import pyarrow as pa

    rng = random.Random(5)
    window = sentence(rng, 13)
    texts = [sentence(rng, rng.randint(0, 30)) + " " + window + " " + sentence(rng, rng.randint(0, 30)) for _ in range(50)] + [window]
    r = S.Records(pa.array(texts), 13, 4)
    found = set()
    for d, text in enumerate(texts):
        w = text.split()
        at = next(i for i in range(len(w)) if w[i : i + 13] == window.split())
        mine = [k for k in np.flatnonzero(r.doc == d) if r.first[k] <= at < r.first[k] + r.count[k]]
        assert len(mine) == 1
        found.add(int(r.a[mine[0]]))
    assert len(found) == 1
    # every window of every text is in exactly one record
    assert r.count.sum() == sum(len(t.split()) - 12 for t in texts)


def test_smallest_below_against_sets():
    rng = random.Random(7)
    texts = list({" ".join(rng.choice("ab") for _ in range(rng.randint(4, 9))).encode() for _ in range(40)})
    counts = np.array([len(t.split()) - 3 for t in texts])
    docs = np.array([rng.randint(0, 9) for _ in texts])
    got = S.smallest_below(texts, counts, docs, 4)
    for k, t in enumerate(texts):
        for j in range(counts[k]):
            sub = t.split()[j : j + 4]
            want = min(d for u, d in zip(texts, docs, strict=True) for i in range(len(u.split()) - 3) if u.split()[i : i + 4] == sub)
            assert got[k, j] == want


def test_keeps_columns_and_untouched_texts(spark):
    docs = frame(spark, awkward(), clashes=True)
    out = S.dedup_substrings(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes and out.count() == docs.count()
    assert out.filter("doc_id = 132").first().text == " \n\t "  # white space stays where nothing is removed
    assert out.filter("text is not null and n_chars <> length(text)").count() == 0
    assert out.filter("text is null").count() == 2


def test_report_digest_and_empty_table(spark):
    data = awkward()
    got = {r["doc_id"]: r["kept_sha256"] for r in S.substring_report(frame(spark, data)).collect()}
    for doc_id, _, _, kept in plain(data):
        assert doc_id is None or got[doc_id] == hashlib.sha256(kept).hexdigest()
    assert S.substring_report(frame(spark, data).limit(0)).collect() == []


def test_full_bit_arrays_change_nothing(spark, monkeypatch):
    """Arrays that let everything through, as on huge inputs, give the same rows."""
    data = awkward()
    want = sorted(map(str, S.substring_report(frame(spark, data)).collect()))
    made = S._bits
    monkeypatch.setattr(S, "_bits", lambda df, bits: np.full_like(made(df, bits), np.uint64(2**64 - 1)) if bits == S.REPEATED_BITS else made(df, bits))
    assert sorted(map(str, S.substring_report(frame(spark, data)).collect())) == want


def test_hot_passage_on_a_third_of_all_rows(spark):
    rng = random.Random(2)
    passage = sentence(rng, 30)
    data = [(i, (passage if i % 3 == 0 else sentence(rng, 30)) + f" end{i}", "en", "s") for i in range(300)]
    got = S.with_cuts(frame(spark, data), limit=50).select("row.doc_id", "cut.n_removed").collect()
    assert {r.doc_id: r.n_removed for r in got} == {i: 30 if i % 3 == 0 and i else 0 for i in range(300)}


def test_frequent_suffixes_join_without_all_pairs(spark):
    docs = S._keyed(frame(spark, awkward()))
    plan = S.later_repeats(docs, limit=1)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
