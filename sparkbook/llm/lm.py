"""Language-model scoring with Elias-Fano n-gram tries.

A trigram model (or a bigram model, ``order`` 2) with hierarchical Dirichlet smoothing,

    p(w)       = (c(w) + 0.1) / (N + 0.1 (V + 1))
    p(w | v)   = (c(v w) + MU p(w)) / (c(v) + MU)
    p(w | u v) = (c(u v w) + MU p(w | v)) / (c(u v) + MU),

kept in Elias-Fano tries: first words, monotone pointers to their successors,
successors stored relative to their context, and, by the place of such a pair, third
words (``Trie``; ``Level`` alone for order 2). A pair or path of three has the log of its
own share, c / (c(first word) + MU), quantised to 256 values; what a score adds by
backing off comes from the counts that the batch knows. A query finds the context, takes
its start, and searches the successor relative to it (module ``elias_fano``). A level is
one read-only buffer that is mapped, not unpacked; ``write_level`` and ``open_level``
keep it as a memory-mapped file.

No task holds the whole model. Documents are cut into batches of about ``BATCH``
tokens. First each batch sends its distinct words, counted, to shards by hash, and gets
their numbers and counts. Then it sends all its distinct bigrams and trigrams at once, in
one message per shard of first words, already counted: neither scores nor totals of
longer contexts are needed to build a trie, so one round serves every order. A first
word with more than ``BATCH`` occurrences has its successors dealt over several shards,
a pair that may have as many its third words too. A shard adds up the counts of all
batches, builds its trie, looks up each distinct gram once and answers the batches,
which add up the scores over their own tokens. So a gram costs one number per batch
however often it occurs. Shards grow in number with the tokens, not in size; words,
far fewer than grams, have a shard for ``WORD_SHARE`` shards of grams.

Words are known by 64-bit hashes. The score starts each document after a start
mark (a context with as many occurrences as training documents); unknown words
share the mass of one unseen word.

Defined cases: null text counts as empty and is the end token alone; a null
doc_id is in training; repeated rows count as often as they occur; without
training documents N is 0 and the score equals the base; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import mmap
import struct
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkbook.llm.common import dropped, saved, shuffles_deleted, small_batches
from sparkbook.llm.elias_fano import Level

BATCH = 1_000_000
MU = 2.0
ADD = 0.1
#: Shards of grams for each shard of words.
WORD_SHARE = 16
HELD_OUT_EVERY = 10
#: The local number of the end token and the context number of the start mark.
END, START = b"", 0


def packed(*arrays: np.ndarray) -> bytes:
    """Number arrays as bytes: unsigned ones in the least width, byte planes apart, compressed."""
    import zstandard

    head, body = [], []
    for a in arrays:
        if a.dtype.kind in "iu":
            width = next(w for w in (1, 2, 4, 8) if not len(a) or int(a.max()) < 1 << (8 * w))
            a = a.astype(f"<u{width}")
        head.append(struct.pack("<cBQ", a.dtype.kind.encode(), a.dtype.itemsize, len(a)))
        body.append(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.dtype.itemsize).T.tobytes())
    return zstandard.compress(b"".join([*head, *body]), 1)


def unpacked(blob: bytes, n: int) -> list[np.ndarray]:
    import zstandard

    raw, at, out = zstandard.decompress(blob), 10 * n, []
    for k in range(n):
        kind, width, length = struct.unpack_from("<cBQ", raw, 10 * k)
        planes = np.frombuffer(raw, np.uint8, width * length, at).reshape(width, length)
        a = np.ascontiguousarray(planes.T).reshape(-1).view(f"<{kind.decode()}{width}")
        out.append(a.astype(np.int64) if kind == b"u" and width < 8 else a)
        at += width * length
    return out


def write_level(level: bytes, path: str) -> None:
    with open(path, "wb") as f:
        f.write(level)


def open_level(path: str) -> Level:
    with open(path, "rb") as f:
        return Level(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))


BATCHES = "batch long, tokens long, doc_ids array<long>, words binary, body binary"


def token_batches(docs: DataFrame, size: int = BATCH) -> DataFrame:
    """Batches of documents: words as hashes by falling frequency with training counts, tokens as numbers of words."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        part, nth = TaskContext.get().partitionId(), 0
        names = [x.split()[0] for x in BATCHES.replace("array<long>", "list").split(", ")]

        def close() -> pa.RecordBatch:
            h = np.fromiter(map(xxh64_intdigest, number), np.uint64, len(number))
            tokens = np.concatenate(parts)
            order = np.argsort(-np.bincount(tokens, minlength=len(h)), kind="stable")  # small numbers for frequent words take less room
            rank = np.empty(len(h), np.int64)
            rank[order] = np.arange(len(h))
            tokens = rank[tokens]
            sizes, held = np.array([len(p) for p in parts]), np.array(held_out, bool)
            train = np.bincount(tokens[np.repeat(~held, sizes)], minlength=len(h))
            row = ([(part << 32) + nth], [len(tokens)], [ids], [packed(h[order], train)], [packed(tokens, sizes, held.astype(np.uint8), rank[:1])])
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds, strict=True)], names=names)

        number, parts, ids, held_out, n = {END: 0}, [], [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = (text.as_py() or "").encode("utf-8", "surrogatepass").lower().split()
                words.append(END)
                parts.append(np.array([number.setdefault(w, len(number)) for w in words], np.int32))
                ids.append(doc_id)
                held_out.append(doc_id is not None and zlib.crc32(str(doc_id).encode()) % HELD_OUT_EVERY == 0)
                n += len(words)
                if n >= size:
                    yield close()
                    nth += 1
                    number, parts, ids, held_out, n = {END: 0}, [], [], [], 0
        if ids:
            yield close()

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(of, BATCHES)


def with_word_shards(batches: DataFrame, shards: int) -> DataFrame:
    """Batches whose words are the shards of their hashes alone: all that later rounds need of them."""

    def of(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            at = batch.schema.get_field_index("words")
            slim = [packed(unpacked(blob.as_py(), 2)[0] % np.uint64(shards), np.zeros(0, np.int64)) for blob in batch.column(at)]
            yield batch.set_column(at, "words", pa.array(slim, pa.binary()))

    return batches.mapInArrow(of, BATCHES)


COUNTED = "batch long, shard int, blob binary, n long, v long"


def word_counts(batches: DataFrame, shards: int) -> DataFrame:
    """For each batch and shard, number and training count of the batch's words; rows without a batch carry a shard's totals.

    Numbers are given by falling count within the shard, from 1; 0 is an unknown word.
    """

    def ask(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for at, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                h, train = unpacked(blob.as_py(), 2)
                own = (h % np.uint64(shards)).astype(np.int64)
                asked = [(s, packed(h[o], train[o])) for s, o in runs_of(own, np.argsort(own, kind="stable"))]
                yield pa.RecordBatch.from_arrays([pa.array([at] * len(asked), pa.int64()), pa.array([s for s, _ in asked], pa.int32()), pa.array([b for _, b in asked], pa.binary())], names=["batch", "shard", "blob"])

    def answer(table: pa.Table) -> pa.Table:
        at, blobs = table["batch"].to_pylist(), table["blob"].to_pylist()
        got = [unpacked(b, 2) for b in blobs]
        shard = table["shard"][0].as_py()
        h, back = np.unique(np.concatenate([g[0] for g in got]), return_inverse=True)
        count = np.bincount(back, np.concatenate([g[1] for g in got]), len(h)).astype(np.int64)
        rank = np.empty(len(h), np.int64)
        rank[np.argsort(-count, kind="stable")] = np.arange(len(h))
        number = np.where(count > 0, rank * shards + shard + 1, 0)
        ends = np.cumsum([len(g[0]) for g in got])
        out = [packed(number[back[e - len(g[0]) : e]], count[back[e - len(g[0]) : e]]) for g, e in zip(got, ends, strict=True)]
        cols = ([*at, None], [shard] * (len(at) + 1), [*out, None], [None] * len(at) + [int(count.sum())], [None] * len(at) + [int((count > 0).sum())])
        kinds = (pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64())
        return pa.table([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[x.split()[0] for x in COUNTED.split(", ")])

    asked = batches.select("batch", "words").mapInArrow(ask, "batch long, shard int, blob binary")
    return asked.groupBy("shard").applyInArrow(answer, COUNTED)


def shard_of(context: np.ndarray, successor: np.ndarray, total: np.ndarray, shards: int, most: int = BATCH) -> np.ndarray:
    """Contexts go to shards by number; one that occurs more than ``most`` times is dealt over several by successor."""
    spread = np.minimum(total // most + 1, shards)
    mixed = (successor.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
    return (context + (mixed % spread.astype(np.uint64)).astype(np.int64)) % shards


def gram_scores(queries: list[list[np.ndarray]], mu: float, order: int) -> tuple[bytes, list[tuple[np.ndarray, ...]]]:
    """The level (``order`` 2) or trie of a shard from all batches' messages, and each batch's answer: log10 shares and counts of its pairs, log10 shares of its trigrams."""
    u, total, v, n2 = (np.concatenate(x) for x in zip(*[(np.repeat(q[0], q[1]), np.repeat(q[2], q[1]), q[3], q[4]) for q in queries], strict=True))
    wide = int(v.max(initial=0)) + 1
    pairs, of_pair = np.unique(u * wide + v, return_inverse=True)
    count = np.bincount(of_pair, n2, len(pairs)).astype(np.int64)
    t = np.zeros(len(pairs))
    t[of_pair] = total
    u, v = pairs // wide, pairs % wide
    kept = count > 0
    own = np.log10(np.maximum(count, 1) / (t + mu))
    if order == 3:
        w, n3 = (np.concatenate([q[k] for q in queries]) for k in (6, 7))
        wide = int(w.max(initial=0)) + 1
        paths, of_path = np.unique(np.repeat(of_pair, np.concatenate([q[5] for q in queries])) * wide + w, return_inverse=True)
        count3 = np.bincount(of_path, n3, len(paths)).astype(np.int64)
        pair, w, seen = paths // wide, paths % wide, count3 > 0
        kept[pair[seen]] = True  # a pair's own count may be in another shard
        level = Trie.of(u[kept], v[kept], own[kept], (np.cumsum(kept) - 1)[pair[seen]], w[seen], np.log10(count3[seen] / (t[pair[seen]] + mu)))
        trie = Trie(level)
        first = trie.pairs
    else:
        level = Level.encode(u[kept], v[kept], own[kept])
        first = Level(level)
    place, there = first.places(u, v)
    share, share3 = np.full(len(pairs), -np.inf, "<f2"), np.zeros(0, "<f2")
    found = there & (count > 0)
    share[found] = first.book[first.codes[place[found]]]
    if order == 3:
        share3 = np.full(len(paths), -np.inf, "<f2")
        known = np.flatnonzero(there[pair])
        code, found = trie.thirds.lookup(place[pair[known]], w[known])
        share3[known[found]] = trie.thirds.book[code[found]]
    out, at, at3 = [], 0, 0
    for q in queries:
        mine = of_pair[at : at + len(q[3])]
        at += len(mine)
        mine3 = of_path[at3 : at3 + len(q[6])] if order == 3 else mine[:0]
        at3 += len(mine3)
        out.append((share[mine], count[mine], share3[mine3]))
    return level, out


class Grams:
    """What a batch knows of its tokens, given its words' hashes (or their shards), numbers and counts; read alike when it asks and when it adds up."""

    def __init__(self, words: bytes, body: bytes, counted: list[tuple[int, bytes]], shards: int, norm: float, mu: float, size: int, word_shards: int | None = None):
        h, _ = unpacked(words, 2)
        self.tokens, self.sizes, self.held, end = unpacked(body, 4)
        self.shards, self.mu, self.size = shards, mu, size
        number, count = np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
        by_shard = np.argsort((h.astype(np.uint64) % np.uint64(word_shards or shards)).astype(np.int64), kind="stable")
        number[by_shard], count[by_shard] = (np.concatenate(x) for x in zip(*[unpacked(blob, 2) for _, blob in sorted(counted)], strict=True))
        p1 = np.log10((count + ADD) / norm) if norm else np.zeros(len(h))
        tokens = self.tokens
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.p1, self.known = p1[tokens], count[tokens] > 0
        self.first = np.concatenate([[True], self.doc[1:] != self.doc[:-1]])
        prev = np.concatenate([tokens[:1], tokens[:-1]])
        start_total = int(count[end[0]])  # training documents, each with one end
        total = np.where(self.first, start_total, count[prev])
        #: Scores of tokens whose context or word no shard knows; the others wait for their shard.
        self.p2 = np.where(total > 0, np.log10(mu / (total + mu)), 0.0) + self.p1
        asked = (number[tokens] > 0) & (total > 0)
        wide = int(number.max(initial=0)) + 1
        key, back = np.unique(np.where(self.first, START, number[prev])[asked] * wide + number[tokens][asked], return_inverse=True)
        #: The distinct bigram of each token (-1: none is asked), and each one's context, total, successor, its total and training count.
        self.gram = np.full(len(tokens), -1)
        self.gram[asked] = back
        self.train = self.of_training(self.gram, len(key))
        self.ctx, self.succ = key // wide, key % wide
        self.tot, self.succ_tot = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
        self.tot[back], self.succ_tot[back] = total[asked], count[tokens[asked]]
        self.to = shard_of(self.ctx, self.succ, self.tot, shards, size)

    def of_training(self, gram: np.ndarray, n: int) -> np.ndarray:
        """How often each of ``n`` distinct grams occurs in training documents."""
        train = (gram >= 0) & (self.held[self.doc] == 0)
        return np.bincount(gram[train], minlength=n).astype(np.int64)

    def per_document(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.doc, values, len(self.sizes)).astype(float)  # an empty count is of whole numbers

    def laid_out(self, order: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(shard, its pairs, how many third words each has there, its trigrams): pairs are sorted, trigrams follow their pairs."""
        n = len(self.to)
        entries, third = self.to * n + np.arange(n), np.zeros(0, np.int64)
        if order == 3:
            before = np.where(self.first, -1, np.concatenate([[-1], self.gram[:-1]]))
            asked = (before >= 0) & (self.gram >= 0)
            key, back = np.unique(before[asked] * n + self.gram[asked], return_inverse=True)
            #: The distinct trigram of each token (-1: none is asked), and each one's pair, third word and training count.
            self.before, self.gram3 = before, np.full(len(before), -1)
            self.gram3[asked] = back
            self.pair, self.succ3 = key // max(n, 1), self.succ[key % max(n, 1)]
            self.train3 = self.of_training(self.gram3, len(key))
            # A pair occurs no more often than either word; one that may be frequent has its third words dealt out.
            to = shard_of(self.to[self.pair], self.succ3, np.minimum(self.tot, self.succ_tot)[self.pair], self.shards, self.size)
            third = np.argsort(to, kind="stable")
            at = to[third] * n + self.pair[third]
            entries = np.concatenate([entries, at[to[third] != self.to[self.pair[third]]]])
        entries = np.unique(entries)
        runs = np.bincount(np.searchsorted(entries, at), minlength=len(entries)) if order == 3 else np.zeros(len(entries), np.int64)
        ends = np.cumsum(runs)
        new, many = starts(entries // max(n, 1))
        for a, m in zip(new.tolist(), many.tolist(), strict=True):
            b = a + m
            yield int(entries[a] // n), entries[a:b] % n, runs[a:b], third[ends[a] - runs[a] : ends[b - 1]]

    def messages(self, order: int) -> Iterator[tuple[int, bytes]]:
        """(shard, its distinct pairs with counts as runs of a context; for order 3 each one's third words with counts)."""
        for s, o, runs3, third in self.laid_out(order):
            new, runs = starts(self.ctx[o])
            own = np.where(self.to[o] == s, self.train[o], 0)  # a pair is counted in its own shard alone
            more = (self.succ3[third], self.train3[third]) if order == 3 else ()
            yield s, packed(self.ctx[o][new], runs, self.tot[o][new], self.succ[o], own, runs3, *more)

    def bigrams(self) -> Iterator[tuple[int, bytes]]:
        """(shard, its distinct bigrams with their counts)."""
        return self.messages(2)

    def scored(self, answers: dict[int, bytes], order: int) -> np.ndarray:
        """The log10 probability of each token from the shards' answers."""
        own, count = np.zeros(len(self.to)), np.zeros(len(self.to), np.int64)
        path = None
        for s, o, _, third in self.laid_out(order):
            share, n, share3 = unpacked(answers[s], 3)
            home = self.to[o] == s
            own[o[home]], count[o[home]] = 10.0 ** share[home].astype(float), n[home]
            if order == 3:
                path = np.zeros(len(self.pair)) if path is None else path
                path[third] = 10.0 ** share3.astype(float)
        mu, asked = self.mu, self.gram >= 0
        p2, gram = self.p2.copy(), self.gram[asked]
        t = self.tot[gram]
        # Shares are of whole occurrences: rounding undoes the quantisation of small counts.
        p2[asked] = np.log10((np.minimum(np.rint(own[gram] * (t + mu)), t) + mu * 10.0 ** self.p1[asked]) / (t + mu))
        if order == 2 or path is None:
            return p2
        after = np.flatnonzero(self.before >= 0)
        after = after[count[self.before[after]] > 0]
        pair, gram3 = self.before[after], self.gram3[after]
        seen = np.rint(np.where(gram3 >= 0, np.append(path, 0.0)[gram3], 0.0) * (self.tot[pair] + mu))
        p3 = p2
        p3[after] = np.log10((np.minimum(seen, count[pair]) + mu * 10.0 ** p2[after]) / (count[pair] + mu))
        return p3


class Trie:
    """Two levels: first words with their successors, and, by the place of such a pair, third words."""

    def __init__(self, buffer):
        view = memoryview(buffer)
        (n,) = struct.unpack_from("<Q", view)
        self.pairs, self.thirds = Level(view[8 : 8 + n]), Level(view[8 + n :])

    @staticmethod
    def of(u: np.ndarray, v: np.ndarray, pair_logp: np.ndarray, place: np.ndarray, w: np.ndarray, logp: np.ndarray) -> bytes:
        """From pairs sorted by (u, v) and third words sorted by (place of their pair, w), without repeats."""
        pairs = Level.encode(u, v, pair_logp)
        return struct.pack("<Q", len(pairs)) + pairs + Level.encode(place, w, logp)

    @staticmethod
    def encode(u: np.ndarray, v: np.ndarray, w: np.ndarray, pair_logp: np.ndarray, logp: np.ndarray) -> bytes:
        """From rows sorted by (u, v, w), without repeats."""
        new, runs = starts(u, v)
        return Trie.of(u[new], v[new], pair_logp[new], np.repeat(np.arange(len(new)), runs), w, logp)

    def lookup(self, u: np.ndarray, v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(code, whether the trigram is there) for each query; queries come in runs of (u, v)."""
        code, found = np.zeros(len(u), np.uint8), np.zeros(len(u), bool)
        new, runs = starts(u, v)
        place, there = self.pairs.places(u[new], v[new])
        known = np.flatnonzero(np.repeat(there, runs))
        code[known], found[known] = self.thirds.lookup(np.repeat(place, runs)[known], w[known])
        return code, found


def starts(*sorted_columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a new row begins in sorted columns, and how many rows are alike from there."""
    n = len(sorted_columns[0])
    change = np.any([c[1:] != c[:-1] for c in sorted_columns], axis=0) if n else np.zeros(0, bool)
    new = np.flatnonzero(np.concatenate([[True], change])) if n else np.zeros(0, np.int64)
    return new, np.diff(np.concatenate([new, [n]]))


def runs_of(to: np.ndarray, order: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, the entries that go there), of entries ordered by shard."""
    new, runs = starts(to[order])
    for at, n in zip(new.tolist(), runs.tolist(), strict=True):
        yield int(to[order[at]]), order[at : at + n]


ANSWERED = "batch long, shard long, blob binary, level binary"
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def scores(docs: DataFrame, mu: float = MU, size: int = BATCH, keep_levels: bool = False, order: int = 2) -> DataFrame | tuple[DataFrame, DataFrame]:
    """One row per document (SCORED), by a model of ``order`` 2 or 3. With ``keep_levels`` also the table of the shards' levels (or tries)."""
    with shuffles_deleted(docs.sparkSession):
        return _scores(docs, mu, size, keep_levels, order)


def _scores(docs: DataFrame, mu: float, size: int, keep_levels: bool, order: int) -> DataFrame | tuple[DataFrame, DataFrame]:
    spark = docs.sparkSession
    batches = saved(token_batches(docs, size), "tokens")
    shards = max(1, -(-int(batches.agg(F.sum("tokens")).first()[0] or 0) // size))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    word_shards = -(-shards // WORD_SHARE)
    counted = saved(word_counts(batches, word_shards), "words")
    n_train, n_words = (int(x or 0) for x in counted.agg(F.sum("n"), F.sum("v")).first())
    norm = n_train + ADD * (n_words + 1)
    hashed, batches = batches, saved(with_word_shards(batches, word_shards), "tokens")
    dropped(hashed)

    def opened(cols: dict[str, list], k: int) -> tuple[Grams, dict[int, bytes]]:
        """A batch's grams, and the shards' answers on them so far."""
        words, answers = ({p["shard"]: p["blob"] for p in cols["parts"][k] if p["round"] == r} for r in range(2))
        return Grams(cols["words"][k], cols["body"][k], list(words.items()), shards, norm, mu, size, word_shards), answers

    def ask(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            cols = batch.to_pydict()
            for k, at in enumerate(cols["batch"]):
                out = list(opened(cols, k)[0].messages(order))
                yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in out], pa.int64()), pa.array([at] * len(out), pa.int64()), pa.array([b for _, b in out], pa.binary())], names=["shard", "batch", "blob"])

    def answer(table: pa.Table) -> pa.Table:
        at, shard = table["batch"].to_pylist(), table["shard"][0].as_py()
        level, answers = gram_scores([unpacked(b, 8 if order == 3 else 6) for b in table["blob"].to_pylist()], mu, order)
        cols = ([*at, None], [shard] * (len(at) + 1), [*(packed(*x) for x in answers), None], [None] * len(at) + [level if keep_levels else None])
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[x.split()[0] for x in ANSWERED.split(", ")])

    def finish(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in SCORED.split(", ")]
        for batch in rows:
            cols = batch.to_pydict()
            for k, ids in enumerate(cols["doc_ids"]):
                grams, answers = opened(cols, k)
                base = grams.per_document(grams.p1)
                score = grams.per_document(grams.scored(answers, order)) if n_train else base
                known = grams.per_document(grams.known).astype(np.int64)
                out = [pa.array(ids, pa.int64()), pa.array(grams.held.astype(bool)), pa.array(grams.sizes), pa.array(known), pa.array([n_train] * len(ids), pa.int64()), pa.array(base), pa.array(score)]
                yield pa.RecordBatch.from_arrays(out, names=names)

    def with_parts(columns: list[str], *rounds: DataFrame) -> DataFrame:
        """Batches with the shards' answers of each round."""
        parts = [r.filter("batch is not null").select(F.col("batch").alias("of"), F.struct(F.lit(k).alias("round"), F.col("shard").cast("long").alias("shard"), "blob").alias("part")) for k, r in enumerate(rounds)]
        answers = reduce(DataFrame.unionAll, parts).groupBy("of").agg(F.collect_list("part").alias("parts"))
        return batches.join(answers, F.col("batch") == F.col("of")).select(*columns, "parts")

    asked = with_parts(["batch", "words", "body"], counted).mapInArrow(ask, "shard long, batch long, blob binary")
    grams = saved(asked.groupBy("shard").applyInArrow(answer, ANSWERED), "grams")
    result = saved(with_parts(["doc_ids", "words", "body"], counted, grams).mapInArrow(finish, SCORED), "scores")
    small_batches(spark)
    for table in (batches, counted, *([] if keep_levels else [grams])):
        dropped(table)
    return (result, grams.filter("level is not null").select("level")) if keep_levels else result
