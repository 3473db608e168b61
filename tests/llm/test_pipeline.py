from collections import Counter, defaultdict

import public_tokenizers as P
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from sparkbook.llm import catalog, langid

from .data import frame, rows
from .test_dedup import plain_line_dedup
from .test_langid import corpus
from .test_mixing import plain_copies
from .test_simhash import plain_components, plain_fingerprint


def test_registered():
    names = queries()
    assert {"pipeline", *catalog.QUERIES} <= set(names)
    assert [n.split("_")[0] for n in catalog.QUERIES] == [f"op{k}" for k in range(1, 14)]
    assert set(catalog.SQL) <= set(oracle_sql()) and "pipeline" not in oracle_sql()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "mixing", "packing"]


def test_against_plain_python(spark, tmp_path):
    """Every stage again, row by row, from what the stage before it kept."""
    data = [(1000 + i, t, lang, "s1" if i % 3 else "s2") for i, t, lang, _ in corpus(120)]
    data += [(i, t, "en", s) for i, t, _, s in rows() if i is not None and i < 125 and t]
    data += [(130, None, None, None), (131, "", "en", "s1"), (132, "12 34", "en", None)]
    frame(spark, data).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    model = langid.train(docs)
    rejected = model.predict([r[1] for r in data])[2]
    kept = [r for r, no in zip(data, rejected, strict=True) if not no]
    assert 130 not in {r[0] for r in kept} and len(kept) > 100
    left = plain_line_dedup(kept)
    kept = [(r[0], left[r[0], r[1]][0], r[2], r[3]) for r in kept]
    roots = plain_components([plain_fingerprint(r[1]) for r in kept], 4)
    first = defaultdict(list)
    for r, root in zip(kept, roots, strict=True):
        first[root].append(r)
    kept = [min(g, key=lambda r: r[0]) for g in first.values()]
    assert len(kept) < len(roots)
    numbers, _ = plain_copies(kept)
    mixed = [r for r, n in zip(kept, numbers, strict=True) for _ in range(n)]
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = Counter()
    for r in mixed:
        n = len(t.encode(r[1], add_special_tokens=False).ids) + 1
        want.update((r[0], start, min(1024, n - start), n) for start in range(0, n, 1024))
    assert Counter((r["doc_id"], r["start"], r["length"], r["doc_tokens"]) for r in got) == want
    filled = defaultdict(int)
    for r in got:
        filled[r["sequence_id"]] += r["length"]
    assert sorted(filled) == list(range(len(filled))) and max(filled.values()) <= 1024


def test_stages_return_the_columns_of_documents(spark, tmp_path):
    frame(spark, rows(), clashes=True).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns


def test_empty_table(spark, tmp_path):
    frame(spark, rows()).limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
