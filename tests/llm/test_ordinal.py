import random
import zlib

import numpy as np

from sparkbook.llm import ordinal

from .data import frame, rows, sentence


def graded(n=400, seed=4):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        quality, toxic = rng.random() < 0.6, rng.random() < 0.3
        t = sentence(rng, 60)
        if not quality:
            t += " " + " ".join(["click ### here"] * 5)
        if toxic:
            t += " awful insult"
        docs.append((i, t, "en", "s"))
        labels.append((i, int(quality), int(toxic)))
    return docs, labels


def test_held_out_grades(spark):
    docs, labels = graded()
    d = frame(spark, docs, clashes=True)
    table = spark.createDataFrame(labels + [(None, 1, 0), (5000, 1, 1), (3, None, 0)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in ordinal.graded_quality(d, ordinal.train(d, table)).collect()}
    held = {r["doc_id"] for r in d.filter(ordinal.held_out()).collect()}
    want = {i: q + (not t) for i, q, t in labels}
    assert len(held) > 50
    assert np.mean([round(got[i]["expected_grade"]) == want[i] for i in held]) >= 0.9
    assert np.mean([got[i]["selected"] == (want[i] == 2) for i in held]) >= 0.9
    assert all(0 <= r["tail_probability"] <= 1 and 0 <= r["expected_grade"] <= 2 for r in got.values())


def test_thresholds_are_ordered_and_probabilities_sum_to_one():
    docs, labels = graded(120)
    model = ordinal.fit([(q + (not t), *ordinal.hashed(d[1])) for d, (_, q, t) in zip(docs, labels, strict=True)])
    assert (np.diff(model.thresholds) > 0).all()
    p = model.grades([d[1] for d in docs] + [None, ""])
    assert np.allclose(p.sum(axis=1), 1) and (p >= 0).all()


def test_gradient_step_lowers_the_loss():
    docs, labels = graded(150)
    data = [(q + (not t), *ordinal.hashed(d[1])) for d, (_, q, t) in zip(docs, labels, strict=True)]
    loss = lambda m: -np.mean([np.log(m.grades([d[1]])[0, y]) for d, (y, _, _) in zip(docs, data, strict=True)])
    assert loss(ordinal.fit(data, steps=60)) < loss(ordinal.fit(data, steps=1)) - 0.1


def test_without_labels_and_empty_table(spark):
    d = frame(spark, rows())
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = ordinal.graded_quality(d, ordinal.train(d, none)).collect()
    assert len(got) == len(rows()) and not any(r["selected"] for r in got)
    assert all(abs(r["expected_grade"] - 1) < 1e-6 for r in got)
    assert ordinal.graded_quality(d.limit(0), ordinal.train(d.limit(0), none)).collect() == []


def plain_features(text):
    """Bucket and value of every distinct word, of richness and length, and of each word shape's share."""
    raw = (text or "").encode().split()
    out = []
    kinds = {}
    for w in raw:
        bare = w.strip(b".,;:!?\"'()")
        kind = "sym" if not bare.isalnum() and w.isascii() else "cap" if w.isupper() else "low"
        kinds[kind] = kinds.get(kind, 0) + 1
    distinct = {w.lower().strip(b".,;:!?") for w in raw}
    if raw:
        out += [(w, 1.0) for w in distinct] + [(b"\x00rich%d" % (10 * len(distinct) // len(raw)), 1.0), (b"\x00long%d" % len(raw).bit_length(), 1.0)]
        out += [(b"\x00" + k.encode(), n / len(raw)) for k, n in kinds.items()]
    return sorted((zlib.crc32(w) % 2**ordinal.BITS, round(v, 6)) for w, v in out)


def test_features_and_grades_against_plain_python():
    rng = np.random.default_rng(2)
    model = ordinal.Ordinal(rng.normal(size=1 << ordinal.BITS).astype(np.float32), np.array([-0.4, 0.9]))
    texts = ["Hello, hello WORLD! 12 ### é", "a", "", None, "one two. Two (three) \"four\" " * 30]
    grades = model.grades(texts)
    for k, t in enumerate(texts):
        idx, value = ordinal.hashed(t)
        assert sorted(zip(idx.tolist(), [round(float(v), 6) for v in value], strict=True)) == plain_features(t)
        s = sum(float(model.weights[i]) * v for i, v in plain_features(t))
        cut = [1 / (1 + np.exp(-(x - s))) for x in (-0.4, 0.9)]
        assert np.allclose(grades[k], [cut[0], cut[1] - cut[0], 1 - cut[1]], atol=1e-4)


def test_fit_is_a_maximum_of_the_penalised_likelihood():
    """Moving any weight or threshold of the fitted model raises the loss that plain Python computes."""
    docs, labels = graded(150)
    data = [(q + (not t), *ordinal.hashed(d[1])) for d, (_, q, t) in zip(docs, labels, strict=True)]
    model = ordinal.fit(data, steps=1500, ridge=0.05)

    def loss(w, theta):
        total = 0.0
        for y, idx, val in data:
            s = float((w[idx] * val).sum())
            cut = [0.0, *(1 / (1 + np.exp(-(t - s))) for t in theta), 1.0]
            total -= np.log(cut[y + 1] - cut[y])
        return total / len(data) + 0.05 / 2 * float((w**2).sum())

    w, best = model.weights.astype(float), loss(model.weights.astype(float), model.thresholds)
    for i in np.argsort(-np.abs(w))[:4]:
        for step in (-0.2, 0.2):
            moved = w.copy()
            moved[i] += step
            assert loss(moved, model.thresholds) > best
    for step in ((0.5, 0), (-0.5, 0), (0, 0.5), (0, -0.5)):
        assert loss(w, model.thresholds + np.array(step)) > best


def test_the_sample_bound_holds_for_repeated_ids(spark, monkeypatch):
    docs, labels = graded(60)
    seen = []
    monkeypatch.setattr(ordinal, "fit", lambda rows: seen.append(len(rows)))
    ordinal.train(frame(spark, docs + [docs[1]] * 300 + [(2, f"other {i}", "en", "s") for i in range(200)]), spark.createDataFrame(labels + [labels[1]] * 200 + [labels[2]] * 100, "doc_id long, quality int, toxic int"), rows=20)
    assert 0 < seen[0] <= 20
