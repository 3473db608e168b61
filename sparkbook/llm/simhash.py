"""SimHash near-duplicates, found with tables of distances to pivots.

A fingerprint sums up the shingles of a text in 64 bits; two documents are
linked when their fingerprints differ in at most ``max_bits`` bits. Reference
fingerprints (pivots) are fixed by a seed, and each fingerprint keeps its table
row: its Hamming distance to every pivot, block by block of the 64 bits. Blockwise
distances add up to the whole distance, and for two fingerprints within r bits
the coordinates differ by r in all at most.

* Pairs that cannot be near are discarded unseen. Of ``max_bits + 2`` blocks
  at least two are untouched by r differing bits, so near fingerprints have
  equal coordinates, for all pivots, in two blocks. They meet in the bucket of
  these two blocks' coordinates.
* Inside a bucket a pair whose coordinates differ by more than r for any pivot
  is discarded, and survivors are verified bit by bit.

Distances of random fingerprints to one pivot have a spread of 4 bits, the same
as the limit, so whole distances alone would let most pairs through; the
blockwise coordinates are what keeps the work from being quadratic.

Only links are needed, not pairs: each bucket returns a spanning forest of its
links, so n near copies cost n rows. A bucket above ``chunk`` fingerprints is
dealt out as pairs of chunks, which loses no link, and no task holds more than
two chunks. Components follow by alternating star contraction on tables in the
shared folder; the driver sees only whether a round changed something.

Defined cases: null text counts as empty; a text without words has fingerprint
zero and is linked like any other; fewer words than a shingle form one shingle;
repeated rows are members of the same component; an empty table gives no rows;
a null doc_id names no component unless its members have no other; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkbook.llm.common import dropped, row_key, saved, small_batches

N_PIVOTS = 16
PIVOTS = np.random.default_rng(5).integers(0, 2**64, N_PIVOTS, dtype=np.uint64)
CHUNK = 4096
#: Shingle hashes that are held at a time while bits are counted.
BLOCK = 8192


def fingerprint(text: str | None, shingle: int) -> int:
    """64-bit SimHash: a bit is 1 if it is set in over half the shingle hashes."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined, ends, at = b" ".join(words), [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[:-1])]
    last = ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]
    hashes = [xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts, last, strict=False)]
    ones = np.zeros(64, np.int64)
    for i in range(0, n, BLOCK):
        bits = np.array(hashes[i : i + BLOCK], "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(bits, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, a, b, fp): a and b name the row by its content, fp is a signed 64-bit number."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(x.as_py(), shingle) for x in batch.column(3)], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(fps.view(np.int64))], names=["doc_id", "a", "b", "fp"])

    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("key", row_key(F.col("doc_id"), F.col("text"))).select("doc_id", "key.a", "key.b", "text")
    return rows.mapInArrow(of, "doc_id long, a long, b long, fp long")


def block_masks(n_blocks: int) -> np.ndarray:
    edges = np.linspace(0, 64, n_blocks + 1).astype(int)
    return np.array([sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:], strict=False)], np.uint64)


def pivot_table(fps: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """Distances to the pivots by block: (fingerprints, blocks, pivots)."""
    apart = fps[:, None] ^ PIVOTS[None, :]
    return np.stack([np.bitwise_count(apart & m) for m in masks], axis=1)


def bucket_keys(fps: np.ndarray, n_blocks: int) -> np.ndarray:
    """(fingerprints, pairs of blocks): the coordinates of two blocks for all pivots, as one number."""
    table = pivot_table(fps, block_masks(n_blocks)).astype(np.uint64)
    odd = np.random.default_rng(7).integers(0, 2**63, (n_blocks, N_PIVOTS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    sums = (table * odd[None]).sum(axis=2, dtype=np.uint64)
    sums ^= sums >> np.uint64(29)
    out = []
    for k, (i, j) in enumerate(combinations(range(n_blocks), 2)):
        key = sums[:, i] * np.uint64(0x9E3779B97F4A7C15) + sums[:, j] * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(k)
        out.append(key ^ (key >> np.uint64(32)))
    return np.stack(out, axis=1)


def forest(left: np.ndarray, right: np.ndarray | None, max_bits: int) -> tuple[list[int], list[int]]:
    """A spanning forest of the links inside ``left``, or between ``left`` and ``right``.

    Walks component by component; a fingerprint is compared with those that no
    component has taken yet, so a dense group costs little more than its size.
    """
    nodes = left if right is None else np.concatenate([left, right])
    side = np.zeros(len(nodes), bool) if right is None else np.arange(len(nodes)) >= len(left)
    table = np.bitwise_count(nodes[:, None] ^ PIVOTS[None, :]).astype(np.int8)
    free = np.arange(len(nodes))
    a, b = [], []
    while len(free) > 1:
        frontier, free = [free[0]], free[1:]
        while frontier and len(free):
            x = frontier.pop()
            near = np.abs(table[free, 0] - table[x, 0]) <= max_bits
            if right is not None:
                near &= side[free] != side[x]
            at = np.flatnonzero(near)
            at = at[(np.abs(table[free[at], 1:] - table[x, 1:]).max(axis=1, initial=0)) <= max_bits]
            at = at[np.bitwise_count(nodes[free[at]] ^ nodes[x]) <= max_bits]
            if len(at):
                got = free[at]
                a += [int(nodes[x])] * len(got)
                b += nodes[got].tolist()
                frontier += got.tolist()
                free = np.delete(free, at)
    return a, b


def links(distinct: DataFrame, max_bits: int = 4, chunk: int = CHUNK) -> DataFrame:
    """Links (a, b) that connect all fingerprints within ``max_bits``, without expanding groups into pairs."""
    spark, n_blocks = distinct.sparkSession, max_bits + 2

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            table = bucket_keys(fps, n_blocks)
            yield pa.RecordBatch.from_arrays([pa.array(table.reshape(-1).view(np.int64)), pa.array(np.repeat(fps, table.shape[1]).view(np.int64))], names=["bucket", "fp"])

    members = distinct.select("fp").mapInArrow(keys, "bucket long, fp long")
    # Buckets of one have no pair; large ones are dealt out as pairs of chunks.
    sizes = members.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    members = members.join(sizes, "bucket").withColumn("chunks", F.expr(f"cast(ceil(size / {chunk}) as int)"))
    members = members.withColumn("own", F.expr("cast(pmod(xxhash64(fp), chunks) as int)"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    members = members.select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "fp")
    dealt = members.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "own")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a: list[int] = []
        b: list[int] = []

        def close(i: int, j: int, own: np.ndarray, fps: np.ndarray) -> None:
            x, y = forest(fps, None, max_bits) if i == j else forest(fps[own == i], fps[own == j], max_bits)
            a.extend(x)
            b.extend(y)

        def rows() -> pa.RecordBatch:
            x, y = np.array(a, np.uint64).view(np.int64), np.array(b, np.uint64).view(np.int64)
            out = pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])
            a.clear()
            b.clear()
            return out

        carried: list[np.ndarray] | None = None
        for batch in batches:
            cols = [batch.column(k).to_numpy() for k in range(5)]
            if carried is not None:
                cols = [np.concatenate(x) for x in zip(carried, cols, strict=True)]
            bucket, i, j, own, fp = cols
            cuts = np.flatnonzero((bucket[1:] != bucket[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            for lo, hi in zip([0, *cuts[:-1]], cuts, strict=False):
                close(i[lo], j[lo], own[lo:hi], fp[lo:hi].view(np.uint64))
            keep = int(cuts[-1]) if len(cuts) else 0
            carried = [c[keep:] for c in cols]
            yield rows()
        if carried is not None and len(carried[0]):
            close(carried[1][0], carried[2][0], carried[3], carried[4].view(np.uint64))
            yield rows()

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20000")
    return dealt.mapInArrow(found, "a long, b long").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): root is the smallest node reachable. Nodes without an edge are left out.

    Large-star and small-star rounds: each node hands its larger neighbours,
    then its smaller ones, to the smallest it knows. Rounds grow with the
    logarithm of the longest path.
    """
    edges = saved(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        small = large.join(least, F.col("a") == F.col("u"))
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(small.select(F.col("a"), F.col("m").alias("b"))).filter("a <> b").distinct()
        after = saved(small, "edges")
        state = after.agg(F.count("*"), F.sum(F.expr("cast(xxhash64(a, b) as decimal(38,0))"))).first()
        dropped(edges)
        edges = after
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
    raise RuntimeError("components did not settle")


def classes(marked: DataFrame, max_bits: int) -> DataFrame:
    """(fp, root) for every fingerprint: fingerprints that links connect share a root."""
    distinct = saved(marked.select("fp").distinct(), "distinct")
    roots = components(links(distinct, max_bits))
    small_batches(marked.sparkSession)
    return distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id): component_id is the smallest doc_id reachable over links."""
    marked = saved(fingerprints(docs, shingle), "fingerprints")
    least = marked.groupBy("fp").agg(F.min("doc_id").alias("least")).withColumnRenamed("fp", "of_fp")
    labelled = saved(classes(marked, max_bits).join(least, F.col("fp") == F.col("of_fp")).select("fp", "root", "least"), "classes")
    named = labelled.groupBy("root").agg(F.min("least").alias("component_id")).withColumnRenamed("root", "of")
    named = labelled.join(named, F.col("root") == F.col("of")).select(F.col("fp").alias("class_fp"), "component_id")
    return marked.join(named, F.col("fp") == F.col("class_fp")).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """The documents with the smallest doc_id of their component, all columns; of rows repeated in full one stays."""
    marked = saved(fingerprints(docs, shingle), "fingerprints")
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "a", "b")
    least = marked.groupBy("fp").agg(F.min(row).alias("least")).withColumnRenamed("fp", "of_fp")
    kept = classes(marked, max_bits).join(least, F.col("fp") == F.col("of_fp")).groupBy("root").agg(F.min("least").alias("least"))
    kept = saved(kept.select(F.col("least.a").alias("of_a"), F.col("least.b").alias("of_b")), "kept")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), row_key(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("key"))
    staying = keyed.join(kept, (F.col("key.a") == F.col("of_a")) & (F.col("key.b") == F.col("of_b")))
    return staying.dropDuplicates(["of_a", "of_b"]).select(*[F.col(f"row.`{c}`") for c in docs.columns])
