import re
from collections import Counter

import pytest

from sparkbook.llm import quality_rules

from .data import frame, rows, text


def plain_measures(value):
    t = value or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


CASES = ["a b c a b c", "a a a a", "a b a b a", "x\ny\nx\n\n \nx", "# ** $ | 🙂🙂", "one two", "  nbsp is a word ", "a b c d a b c x y z b c d"]


def test_measures_against_brute_force(spark):
    data = rows() + [(500 + i, t, "en", "s1") for i, t in enumerate(CASES)]
    got = quality_rules.quality_report(frame(spark, data, clashes=True)).collect()
    want = Counter((r[0], *plain_measures(r[1])) for r in data)
    assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got) == want
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["kept"] and r["base_failed"]) and r["kept"] == (not r["base_failed"] and r["reasons"] == "")


def test_outliers_go_and_clean_documents_stay(spark):
    import random

    rng = random.Random(8)
    clean = [(i, text(rng, 8, 12), "en", "s1" if i % 3 else "s2") for i in range(400)]
    noisy = [(1000 + i, text(rng, 8, 12).replace(" ", " ### $$ "), "en", "s1") for i in range(6)]
    long_words = [(2000 + i, " ".join("x" * 60 + str(k) for k in range(80)), "en", "s1") for i in range(3)]
    got = {r["doc_id"]: r for r in quality_rules.quality_report(frame(spark, clean + noisy + long_words)).collect()}
    assert all(got[r[0]]["kept"] for r in clean)
    assert not any(got[r[0]]["kept"] for r in noisy + long_words)
    assert "symbols" in got[1000]["reasons"] and "word_length" in got[2000]["reasons"]


def test_buckets_keep_eight_bits(spark):
    from pyspark.sql import functions as F

    values = [0, 1, 127, 255, 256, 257, 511, 513, 1000, 99_999, 2**40 + 12345]
    got = spark.createDataFrame([(v,) for v in values], "v long").select("v", quality_rules.bucket(F.col("v")).alias("b")).collect()
    for r in got:
        shift = max(r["v"].bit_length() - 8, 0)
        assert r["b"] == r["v"] >> shift << shift


def test_no_python_in_the_plan(spark, capsys):
    quality_rules.quality_report(frame(spark, rows())).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)


@pytest.mark.parametrize("n", [0])
def test_empty_table(spark, n):
    assert quality_rules.quality_report(frame(spark, rows()).limit(n)).collect() == []
