import random
import zlib

import numpy as np

from sparkbook.llm import langid

from .data import frame, rows

SYLLABLES = {"en": "the and ing ton wick shire ough wh th".split(), "de": "sch ung keit ein lich ver ß ü ach".split(), "el": "ος και την μου θε λλ αν".split()}


def corpus(n=240, seed=2):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        out.append((i, " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(60)), lang, "s"))
    return out


def test_held_out_accuracy_and_contract(spark):
    data = corpus()
    docs = frame(spark, data, clashes=True)
    got = {r["doc_id"]: r for r in langid.identify(docs, langid.train(docs)).collect()}
    held = [r for r in data if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert len(held) > 30
    assert np.mean([got[r[0]]["lang_pred"] == r[2] for r in held]) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert np.mean([r["rejected"] for r in got.values()]) < 0.05


def test_texts_without_letters_are_undetermined(spark):
    docs = frame(spark, corpus() + [(900, None, "en", "s"), (901, "", "en", "s"), (902, "12 34 ½ _ — !", "en", "s"), (None, "schungkeit einlich", None, None)])
    model = langid.train(docs)
    got = {r["doc_id"]: r for r in langid.identify(docs, model).collect()}
    for i in (900, 901, 902):
        assert (got[i]["lang_pred"], got[i]["score"], got[i]["rejected"]) == ("und", 0.0, True)
    assert got[None]["lang_pred"] == "de"
    kept = {r["doc_id"] for r in langid.accepted(docs, model).collect()}
    assert kept == {i for i, r in got.items() if not r["rejected"]}


def test_held_out_documents_and_sources_do_not_reach_the_model(spark):
    data = corpus(60)
    other = [(i, "zzz" if zlib.crc32(str(i).encode()) % 4 == 2 else t, lang, "other") for i, t, lang, _ in data]
    a, b = (langid.train(frame(spark, d)) for d in (data, other))
    assert np.array_equal(a.scores, b.scores) and a.temperature == b.temperature


def test_slices_do_not_change_the_counts(monkeypatch):
    texts = ["ab cd  efg", None, "x", "Straße über alles " * 40, ""]

    def counts():
        total = {}
        for bucket, own in langid.subwords(texts):
            for k in zip(bucket.tolist(), own.tolist(), strict=True):
                total[k] = total.get(k, 0) + 1
        return total

    whole = counts()
    monkeypatch.setattr(langid, "SLICE", 7)
    assert counts() == whole and whole


def test_no_labels_and_empty_table(spark):
    docs = frame(spark, [(1, "some text", None, "s")])
    assert [r["lang_pred"] for r in langid.identify(docs, langid.train(docs)).collect()] == ["und"]
    empty = frame(spark, rows()).limit(0)
    assert langid.identify(empty, langid.train(empty)).collect() == []


def test_languages_that_were_not_learned_are_rejected(spark):
    rng = random.Random(8)
    model = langid.train(frame(spark, corpus(600)))
    foreign = {"cs": "ří ště ova ský něk dů mla".split(), "fi": "ää kka ssa nen mme ttä".split(), "ru": "ого ени ать ский что".split(), "tr": "ler lar ğı ış mak yor".split()}
    texts = [" ".join("".join(rng.choices(s, k=rng.randint(1, 3))) for _ in range(60)) for s in foreign.values() for _ in range(10)]
    assert model.predict(texts)[2].mean() >= 0.9
    assert model.predict([r[1] for r in corpus(200, seed=77)])[2].mean() < 0.03


def test_the_sample_bound_holds_for_repeated_rows(spark, monkeypatch):
    data = corpus(90) + [corpus(1, seed=5)[0]] * 400
    seen = []
    monkeypatch.setattr(langid, "fit", lambda rows: seen.append(len(rows)) or langid.Model([], np.zeros((1, 0)), np.zeros(0)))
    langid.train(frame(spark, data), per_language=5)
    assert 5 <= seen[0] <= 5 * len(SYLLABLES)


def plain_subwords(text):
    """Runs of 2 to 4 characters that reach into one word and at most to the spaces around it."""
    s = "".join(c if c.isalpha() else " " for c in f" {(text or '').lower()} ")
    while "  " in s:
        s = s.replace("  ", " ")
    return [s[i : i + n] for n in (2, 3, 4) for i in range(len(s) - n + 1) if " " not in s[i + 1 : i + n - 1] and not (s[i] == " " and s[i + n - 1] == " ")]


def plain_bucket(sub):
    m = 2**32
    c = [ord(x) for x in sub]
    h = c[0] * 0x9E3779B1 % m
    for x in c[1:]:
        h = ((h ^ (h >> 15)) * 0x85EBCA6B + x * 0xC2B2AE35) % m
    return ((h ^ (h >> 16)) * 0x27D4EB2F % m) >> (32 - langid.BITS)


def test_features_and_scores_against_plain_python():
    rng = np.random.default_rng(3)
    model = langid.Model(["x", "y"], rng.normal(size=(1 << langid.BITS, 2)).astype(np.float32), np.array([0.1, -0.2]), temperature=0.7, threshold=0.6)
    texts = ["Straße über alles", "a b cd", "ab", "  x1y2  zz ", "ος και την", "...", "", None]
    found = {k: [] for k in range(len(texts))}
    for bucket, own in langid.subwords(texts):
        for b, k in zip(bucket.tolist(), own.tolist(), strict=True):
            found[k].append(b)
    lang, score, rejected = model.predict(texts)
    for k, t in enumerate(texts):
        subs = [plain_bucket(s) for s in plain_subwords(t)]
        assert sorted(found[k]) == sorted(subs), t
        if t is None or not any(map(str.isalpha, t)):
            assert (lang[k], score[k], rejected[k]) == ("und", 0.0, True)
            continue
        z = [(sum(float(model.scores[b, j]) for b in subs) / max(1, len(subs)) + float(model.bias[j])) / 0.7 for j in (0, 1)]
        p = [np.exp(v) / (np.exp(z[0]) + np.exp(z[1])) for v in z]
        assert lang[k] == "xy"[int(p[1] > p[0])] and abs(score[k] - max(p)) < 1e-5 and rejected[k] == (max(p) < 0.6)


def test_one_gradient_step_against_finite_differences():
    """The update of fit() is the gradient of the cross-entropy of mean embeddings times the softmax weights."""
    rng = np.random.default_rng(1)
    emb, out, bias = rng.normal(size=(6, 3)), rng.normal(size=(3, 2)), rng.normal(size=2)
    idx, share, truth = np.array([1, 4]), np.array([0.25, 0.75]), 1
    loss = lambda e, o, b: -np.log(langid.softmax((share @ e[idx]) @ o + b)[truth])
    hidden = share @ emb[idx]
    err = langid.softmax(hidden @ out + bias)
    err[truth] -= 1
    grads = {"out": np.outer(hidden, err), "bias": err, "emb": np.zeros_like(emb)}
    grads["emb"][idx] = np.outer(share, out @ err)
    for name, at in (("out", (2, 0)), ("bias", (1,)), ("emb", (4, 1)), ("emb", (0, 0))):
        p = {"emb": emb.copy(), "out": out.copy(), "bias": bias.copy()}
        p[name][at] += 1e-6
        assert abs((loss(p["emb"], p["out"], p["bias"]) - loss(emb, out, bias)) / 1e-6 - grads[name][at]) < 1e-4
