import hashlib
from collections import defaultdict

import pytest

from sparkbook.llm import exact_dedup, line_dedup

from .data import frame, rows


def plain_lower(text):
    return (text or "").encode().lower().decode()


@pytest.mark.parametrize("partitions", [1, 5, 50])
def test_exact_groups_against_brute_force(spark, partitions):
    data = rows() + [(200 + i, "hot copy", "en", "s1") for i in range(60)] + [(300 + i, "HOT copy" if i % 2 else "ÄHOT", "en", None) for i in range(9)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = exact_dedup.exact_duplicates(frame(spark, data, clashes=True)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    groups = defaultdict(list)
    for r in data:
        groups[plain_lower(r[1])].append(r[0])
    want = []
    for norm, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(norm.encode()).hexdigest()
        want += [(i, keep, len(ids), keep is None or i == keep, sha) for i in ids]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(key, map(tuple, got))) == sorted((tuple((x is None, x) for x in (r[0], r[1], r[2], r[3] if r[0] is not None else keep_null(r), r[4]))) for r in want)


def keep_null(row):
    """A row without an id stays only where its whole group has none."""
    return row[1] is None


def test_exact_empty_table(spark):
    assert exact_dedup.exact_duplicates(frame(spark, rows()).limit(0)).collect() == []


def plain_line_dedup(data, width=3):
    """{(doc_id, text): (text left, removed line numbers)} by brute force."""
    first, later = {}, defaultdict(set)
    named = sorted({(r[0] is not None, r[0] or 0, r[1]) for r in data if r[1] is not None}, key=lambda x: (x[0], x[1]))
    for has_id, doc_id, text in named:
        lines = text.split("\n")
        content = [k for k, x in enumerate(lines) if x.strip(" \t\n\v\f\r")]
        for i in range(len(content) - width + 1):
            w = tuple(lines[k].strip(" \t\n\v\f\r") for k in content[i : i + width])
            if w in first:
                later[has_id, doc_id, text] |= set(range(content[i], content[i + width - 1] + 1))
            else:
                first[w] = (doc_id, i)
    out = {}
    for r in data:
        gone = later.get((r[0] is not None, r[0] or 0, r[1]), set())
        out[r[0], r[1]] = (None if r[1] is None else "\n".join(x for k, x in enumerate(r[1].split("\n")) if k not in gone), gone)
    return out


def test_line_windows_against_brute_force(spark):
    data = rows()
    got = line_dedup.line_report(frame(spark, data, clashes=True)).collect()
    want = plain_line_dedup(data)
    assert len(got) == len(data)
    left = sorted(((r["doc_id"] is None, r["doc_id"], r["text"] or "", r["removed_lines"]) for r in got), key=str)
    assert left == sorted(((r[0] is None, r[0], want[r[0], r[1]][0] or "", len(want[r[0], r[1]][1])) for r in data), key=str)
    # the shared passage stays once, whole, and what stands around it stays everywhere
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[120]["removed_lines"] == 0 and by_id[121]["removed_lines"] == by_id[122]["removed_lines"] == 5
    assert by_id[121]["removed"] == "3:8"


def test_line_dedup_keeps_columns_and_short_texts(spark):
    docs = frame(spark, rows(), clashes=True)
    out = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert out.filter("n_chars <> length(text)").count() == 0
    same = frame(spark, [(1, "a\nb", "en", "s"), (2, "a\nb", "en", "s"), (3, "x\n\n \ny\n\nz", "en", "s"), (4, "x\ny \nz", "en", "s")])
    assert [r["text"] for r in line_dedup.dedup_lines(same).orderBy("doc_id").collect()] == ["a\nb", "a\nb", "x\n\n \ny\n\nz", ""]


def test_line_dedup_empty_table(spark):
    assert line_dedup.line_report(frame(spark, rows()).limit(0)).collect() == []
