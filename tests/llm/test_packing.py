import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from sparkbook.llm import packing

from .data import frame, rows


@pytest.fixture(scope="module")
def exact():
    return Tokenizer.from_file(P.path("byte_bpe_50k.json"))


def test_encoder_gives_the_tokenizers_ids(exact):
    encode = packing.public_encoder()
    for text in ["", "a  b\n\n c", "Größe   çà\t\t x", "<|endoftext|> in <|endoftext|>text", "日本語 🙂 ½", "it's 12345 we'll", " ", "\r\n x y", *[r[1] for r in rows() if r[1]]]:
        assert encode(text) == exact.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("capacity", [32, 1024])
def test_every_id_lies_in_one_piece_and_sequences_have_no_gaps(spark, exact, capacity):
    data = rows()
    got = packing.pack(frame(spark, data, clashes=True), capacity).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r["doc_id"], r["doc_tokens"]].append(r)
        sequences[r["sequence_id"]].append(r)
    want = Counter()
    for doc_id, text, *_ in data:
        ids = [*exact.encode(text or "", add_special_tokens=False).ids, 0]
        for start in range(0, len(ids), capacity):
            part = ids[start : start + capacity]
            want[doc_id, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(ids)] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == want
    assert sorted(sequences) == list(range(len(sequences)))
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity and all(r["sequence_tokens"] == at for r in own)
        assert own[0]["padded_tokens"] == (at if at & (at - 1) == 0 else capacity)


def test_ids_come_along_on_request(spark):
    got = packing.pack(frame(spark, [(1, "one two three", "en", "s")]), with_ids=True).collect()
    assert [zlib.crc32(r["ids"]) for r in got] == [r["ids_crc32"] for r in got]


def test_histogram_patterns_hold_every_length_once():
    rng = np.random.default_rng(1)
    for _ in range(20):
        histogram = {int(k): int(v) for k, v in Counter(rng.integers(1, 65, rng.integers(1, 400))).items()}
        patterns = packing.pack_histogram(histogram, 64)
        held = Counter()
        for n, pattern in patterns:
            assert sum(pattern) <= 64 and list(pattern) == sorted(pattern, reverse=True)
            for length in pattern:
                held[length] += n
        assert held == histogram
    assert packing.pack_histogram({}, 64) == []


def test_one_short_length_fills_whole_sequences():
    # 1000 pieces of 100 tokens: ten fit in 1024, so a hundred sequences and no more
    assert sum(n for n, _ in packing.pack_histogram({100: 1000}, 1024)) == 100


def test_little_padding_on_many_lengths():
    rng = np.random.default_rng(2)
    lengths = np.minimum(rng.lognormal(6, 0.9, 20_000).astype(int) + 1, 1024)
    n = sum(k for k, _ in packing.pack_histogram(Counter(lengths.tolist()), 1024))
    assert n * 1024 <= 1.01 * lengths.sum()


def test_empty_table(spark):
    assert packing.pack(frame(spark, rows()).limit(0)).collect() == []
