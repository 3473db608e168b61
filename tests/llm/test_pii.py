import hashlib
import random
import re

import numpy as np
import pytest

from sparkbook.llm import pii

from .data import frame, rows


def digits(s):
    return re.sub(r"[^0-9]", "", s)


def plain_luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(reversed(d))) % 10 == 0


def plain_base(t):
    """The patterns as they stand, each scanned on its own."""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 14 <= len(digits(m[0])) <= 19 and plain_luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(digits(m[0])) <= 15]
    return sorted(out)


@pytest.mark.parametrize("alphabet", ["a1@.-+ (2)9", "4 -1.0+", "@a.b", "255.1 "])
def test_base_spans_against_the_patterns(alphabet):
    rng = random.Random(alphabet)
    for _ in range(20_000):
        t = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 45)))
        assert pii.base_spans(t) == plain_base(t), t


def test_scans_are_linear():
    import time

    began = time.process_time()
    for t in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" * 100_000, "a@" * 100_000, "(at)" * 60_000, "1 " * 150_000, "(" * 200_000):
        pii.base_spans(t)
        pii.proposals(t)
    assert time.process_time() - began < 10


def personal(n=300, seed=6):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        card = "".join(str(rng.randint(0, 9)) for _ in range(15))
        card += next(c for c in "0123456789" if plain_luhn(card + c))
        t = rng.choice([f"write to user{i}@mail.example.com now", f"host 10.{i % 256}.3.4 down", f"paid with {card} today", f"call +1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)} soon", f"order {rng.randint(10**15, 10**16 - 1)} shipped", "nothing at all", f"version 1.{300 + i}.2.9 out"])
        out.append((i, t, "en", "s"))
    return out


def test_report_against_brute_force(spark):
    data = rows() + [(1000 + r[0], *r[1:]) for r in personal()]
    got = pii.personal_data(frame(spark, data, clashes=True)).collect()
    by_id = {}
    for r in data:
        by_id.setdefault(r[0], []).append(plain_base(r[1] or ""))
    assert len(got) == len(data)
    for r in got:
        base = by_id[r["doc_id"]][0]
        joined = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(k == j for _, k, _ in base) for j in range(4)]
        spans = r["spans"].split(",") if r["spans"] else []
        assert set(joined.split(",") if joined else []) <= set(spans)
        assert [int(s.split(":")[1]) for s in spans] == sorted(int(s.split(":")[1]) for s in spans)


def test_trees_learn_and_calibrate():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.integers(0, 4, (4000, 1)), rng.normal(0, 1, (4000, 5))], axis=1)
    y = ((x[:, 1] > 0.3) & (x[:, 2] < 0.5) | (x[:, 3] > 1.5)).astype(float)
    model = pii.boost(x, y)
    p = model.probability(x)
    assert ((p > 0.5) == y).mean() > 0.97
    assert abs(p.mean() - y.mean()) < 0.02
    for k in range(4):
        chosen = (x[:, 0] == k) & (p >= model.least[k])
        assert y[chosen].mean() >= 0.96


def test_one_label_adds_nothing(spark):
    clean = frame(spark, [(i, "call 555 123 4567 or 99 bottles", "en", "s") for i in range(60)])
    assert {r["spans"] for r in pii.personal_data(clean).collect()} == {""}


def test_accepted_spans_do_not_overlap():
    found = pii.Trees(trees=[([0] * 7, [99] * 7, np.full(8, 9.0))], edges=[np.zeros(0)] * pii.N_FEATURES, least=(0.5,) * 4)
    marks = np.array([(0, 0, 10, 1), (5, 2, 20, 0), (20, 2, 30, 0), (20, 3, 25, 0), (28, 3, 40, 0), (40, 1, 41, 0)])
    assert sorted(pii.accepted(marks, np.zeros((6, pii.N_FEATURES)), found)) == [(0, 0, 10), (20, 2, 30), (40, 1, 41)]


def test_empty_table(spark):
    assert pii.personal_data(frame(spark, rows()).limit(0)).collect() == []


def planted(n=400, seed=11):
    """(documents, (doc_id, span) that are personal data, (doc_id, span) that are not), none of them base spans."""
    rng = random.Random(seed)
    num = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    data, real, decoy = personal(n), set(), set()
    for i in range(n, 3 * n):
        d = num(15)
        good = d + next(c for c in "0123456789" if plain_luhn(d + c))
        bad = d + next(c for c in "0123456789" if not plain_luhn(d + c))
        sep = rng.choice("./")
        four = lambda s: sep.join(s[k : k + 4] for k in range(0, 16, 4))  # noqa: B023, E731
        area = f"{rng.randint(200, 999)}"
        true = [f"({area}) {num(3)}-{num(4)}", f"{area}-{num(3)}-{num(4)}", f"{area}.{num(3)}.{num(4)}", four(good), f"jane{i} [at] mail [dot] com", f"j.doe{i} (at) mail{i % 7}.org", f"ann{i} <at> site (dot) co (dot) uk"]
        false = [four(bad), f"20{num(2)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}", f"{rng.randint(10, 28)}/{rng.randint(10, 12)}/19{num(2)}", f"{num(3)}-{num(2)}-{num(4)}", f"{rng.randint(300, 999)}.{num(3)}.{num(2)}.1", f"look (at) fig. {i}", f"{num(4)}-{num(4)}-{num(4)}"]
        k = rng.randrange(4)
        span = rng.choice(true) if k == 0 else rng.choice(false) if k == 1 else None
        if span:
            data.append((i, f"they wrote {span}{rng.choice([' to us', '. Then', ', and', ''])}", "en", "s"))
            (real if k == 0 else decoy).add((i, span))
    return data, real, decoy


def test_looser_personal_data_is_added_and_decoys_are_not(spark):
    data, real, decoy = planted()
    text = {r[0]: r[1] for r in data}
    assert all(not plain_base(text[i]) for i, _ in real | decoy)
    got = {r["doc_id"]: r["spans"] for r in pii.personal_data(frame(spark, data)).collect()}
    found = {(i, text[i][int(a) : int(b)]) for i in {i for i, _ in real | decoy} for s in got[i].split(",") if s for _, a, b in [s.split(":")]}
    for mark in ("at", "digits"):  # addresses, then numbers
        own = {(i, s) for i, s in real if ("at" in s) == (mark == "at")}
        assert len(found & own) / len(own) >= 0.95
    assert len(found & real) / len(found) >= 0.97
    assert len({i for i, _ in found} & {i for i, _ in decoy}) <= 0.03 * len(decoy)
