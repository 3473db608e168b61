"""Substring dedup by prefix-partitioned suffix trees over words.

A suffix is the text from one word on. Suffixes are split into groups that share
a prefix, each small enough for a task's memory; a group's suffixes are sorted,
neighbours with ``width`` equal words hang below one internal node of the group's
tree, and such deep nodes are the repeats: all but the smallest document below a
node repeat it. Trees are cut at ``width`` words, since deeper nodes cover no
other words.

Which prefix. A suffix goes to the group of the ``PREFIX``-word prefix of least
hash among the suffixes that start inside its first ``width`` words, not to that
of its own first words. Equal ``width``-word sequences have equal such prefixes at
equal offsets, so they still meet, and neighbouring suffixes mostly share one:
they travel as one record (their words once) in place of one row each.

Which groups. Prefixes are counted first. One that stands in a single document
has no node of two documents below it and is left out. One with more than
``LIMIT`` records is lengthened to ``width`` words: each such suffix is a
prefix of its own, a single deep node, for which the smallest document is
aggregated in the map tasks already and joined back (a join that is split where it is skewed).
Both lists reach the tasks as bit arrays of fixed size (32 MB and 2 MB) indexed
by hash. A wrong bit only lets a prefix through, or lengthens it, alike
everywhere: results do not depend on the arrays, and beyond some 1e9 repeated
prefixes they save nothing any more.

Defined cases: null text has no words; texts shorter than ``width`` words keep
all; null doc_ids are neither smaller nor larger: their texts stay and remove
nothing; rows with one doc_id do not remove from each other (so rows repeated in
full are treated alike); windows overlap freely, also with their own repeat; an
empty table gives no rows; other columns pass through ``dedup_substrings``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkbook.llm.common import dropped, saved, small_batches

WIDTH = 13
#: Words of the short prefixes.
PREFIX = 4
#: Records of a group at most; a longer prefix is taken beyond it.
LIMIT = 100_000
#: Bits of the two arrays: 2**28 and 2**24.
REPEATED_BITS, FREQUENT_BITS = 28, 24


def _mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Records:
    """Runs of suffixes of one batch that share a prefix: the prefix hash ``a``, the document (row of the batch), the
    first suffix (word of the batch and of the document) and how many follow each other. ``words``: of all documents."""

    def __init__(self, texts: pa.Array, width: int, prefix: int):
        from xxhash import xxh3_64_intdigest

        per_doc = [(t.as_py() or b"").split() for t in pc.cast(texts, pa.binary())]
        lengths = np.fromiter(map(len, per_doc), np.int64, len(per_doc))
        self.words = [w for words in per_doc for w in words]
        starts = np.cumsum(lengths) - lengths
        n = len(self.words) - width + 1
        if n < 1:
            self.a, self.doc, self.at, self.first, self.count = (np.zeros(0, d) for d in (np.uint64, np.int64, np.int64, np.int64, np.int64))
            return
        code = np.fromiter(map(xxh3_64_intdigest, self.words), np.uint64, len(self.words))
        gram = np.zeros(len(code) - prefix + 1, np.uint64)
        for j in range(prefix):
            gram = gram * np.uint64(0x9E3779B97F4A7C15) + code[j : len(gram) + j]
        gram = _mixed(gram)
        least, offset = gram[:n].copy(), np.zeros(n, np.int64)
        for j in range(1, width - prefix + 1):
            here = gram[j : n + j]
            less = here < least  # the leftmost of equals stays
            least[less] = here[less]
            offset[less] = j
        of = np.repeat(np.arange(len(lengths)), lengths)
        whole = of[:n] == of[width - 1 :]  # the window ends in its document
        place = np.where(whole, np.arange(n) + offset, -1)
        new = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        count = np.diff(np.r_[new, n])
        real = place[new] >= 0
        self.at, self.count = new[real], count[real]
        self.a, self.doc = least[self.at], of[self.at]
        self.first = self.at - starts[self.doc]


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, key): ``key`` tells texts of one doc_id apart."""
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return out.withColumn("key", F.xxhash64("text"))


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x, pa.int64())


def prefix_counts(docs: DataFrame, width: int = WIDTH, prefix: int = PREFIX) -> DataFrame:
    """(a, least, most, n): smallest and largest document and number of records of every short prefix."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            r, ids = Records(batch.column(1), width, prefix), batch.column(0).to_numpy()
            order = np.argsort(r.a, kind="stable")
            a, doc = r.a[order], ids[r.doc[order]]
            new = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else np.zeros(0, np.int64)
            least, most = (np.minimum.reduceat(doc, new), np.maximum.reduceat(doc, new)) if len(a) else (doc, doc)
            yield pa.RecordBatch.from_arrays([_long(a[new]), _long(least), _long(most), _long(np.diff(np.r_[new, len(a)]))], names=["a", "least", "most", "n"])

    small_batches(docs.sparkSession)
    each = docs.select("doc_id", "text").filter("doc_id is not null").mapInArrow(of, "a long, least long, most long, n long")
    return each.groupBy("a").agg(F.min("least").alias("least"), F.max("most").alias("most"), F.sum("n").alias("n"))


def _bits(hashes: DataFrame, bits: int) -> np.ndarray:
    """A bit array over the top ``bits`` bits of ``a``: 2**(bits - 6) rows reach the driver at most."""
    top = hashes.select(F.shiftrightunsigned("a", 64 - bits).alias("top"))
    each = top.select(F.shiftright("top", 6).cast("int").alias("word"), F.expr("shiftleft(1L, cast(top & 63 as int))").alias("bit"))
    rows = each.groupBy("word").agg(F.bit_or("bit").alias("set")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[rows["word"].to_numpy()] = rows["set"].to_numpy()
    return out.view(np.uint64)


def _set(array: np.ndarray, bits: int, a: np.ndarray) -> np.ndarray:
    top = a >> np.uint64(64 - bits)
    return (array[top >> np.uint64(6)] >> (top & np.uint64(63)) & np.uint64(1)).astype(bool)


#: A record, or (words null) one suffix of a prefix that is frequent: its own ``width`` words are hashed to a and b.
RECORD = "a long, b long, doc_id long, key long, first int, n int, words binary"
MASK = "doc_id long, key long, first int, mask long"


def records(docs: DataFrame, repeated, frequent, width: int = WIDTH, prefix: int = PREFIX) -> DataFrame:
    """The records of prefixes that stand in several documents; suffixes of frequent ones one by one. The arrays are broadcasts of _bits()."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_intdigest

        for batch in batches:
            r, ids, keys = Records(batch.column(1), width, prefix), batch.column(0).to_numpy(), batch.column(2).to_numpy()
            met = np.flatnonzero(_set(repeated.value, REPEATED_BITS, r.a))
            often = _set(frequent.value, FREQUENT_BITS, r.a[met])
            few, many = met[~often], met[often]
            spans = zip(r.at[few].tolist(), (r.at[few] + r.count[few] + width - 1).tolist(), strict=True)
            words = pa.array([b" ".join(r.words[i:j]) for i, j in spans], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [_long(r.a[few]), pa.nulls(len(few), pa.int64()), _long(ids[r.doc[few]]), _long(keys[r.doc[few]]), pa.array(r.first[few], pa.int32()), pa.array(r.count[few], pa.int32()), words],
                names=["a", "b", "doc_id", "key", "first", "n", "words"])
            if len(many):
                of_record = np.repeat(many, r.count[many])
                step = np.arange(len(of_record)) - np.repeat(np.cumsum(r.count[many]) - r.count[many], r.count[many])
                both = [xxh3_128_intdigest(b" ".join(r.words[i : i + width])) for i in (r.at[of_record] + step).tolist()]
                a, b = (np.array([x >> s & 0xFFFFFFFFFFFFFFFF for x in both], np.uint64) for s in (64, 0))
                doc = r.doc[of_record]
                yield pa.RecordBatch.from_arrays(
                    [_long(a), _long(b), _long(ids[doc]), _long(keys[doc]), pa.array(r.first[of_record] + step, pa.int32()), pa.array(np.ones(len(a)), pa.int32()), pa.nulls(len(a), pa.binary())],
                    names=["a", "b", "doc_id", "key", "first", "n", "words"])

    small_batches(docs.sparkSession)
    return docs.filter("doc_id is not null").select("doc_id", "text", "key").mapInArrow(of, RECORD)


def smallest_below(texts: list[bytes], counts: np.ndarray, docs: np.ndarray, width: int) -> np.ndarray:
    """For each of the ``counts`` suffixes of each text (a row of the result), the smallest document below its deep node.

    ``docs``: the smallest document that holds the text. The suffixes are sorted
    as sequences of word numbers; equal neighbours are one node.
    """
    numbers: dict[bytes, int] = {}
    split = [t.split(b" ") for t in texts]
    flat = np.fromiter((numbers.setdefault(w, len(numbers)) for words in split for w in words), np.int64)
    lengths = np.fromiter(map(len, split), np.int64, len(split))
    starts = np.cumsum(lengths) - lengths
    row = np.repeat(np.arange(len(texts)), counts)
    step = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = starts[row] + step
    # As many words to a sort key as fit into 64 bits.
    size = max(1, (len(numbers) - 1).bit_length())
    keys = []
    for lo in range(0, width, 64 // size):
        key = np.zeros(len(at), np.uint64)
        for j in range(lo, min(width, lo + 64 // size)):
            key = (key << np.uint64(size)) | flat[at + j].astype(np.uint64)
        keys.append(key)
    order = np.lexsort(keys[::-1])
    differs = np.zeros(len(at), bool)
    differs[0] = True
    for key in keys:
        ranked = key[order]
        differs[1:] |= ranked[1:] != ranked[:-1]
    node = np.flatnonzero(differs)
    least = np.empty(len(at), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(docs[row][order], node), np.diff(np.r_[node, len(at)]))
    out = np.full((len(texts), int(counts.max())), np.iinfo(np.int64).max)
    out[row, step] = least
    return out


def repeats_in_trees(groups: pa.Table, width: int) -> pa.RecordBatch:
    """(doc_id, key, first, mask) of the records of whole groups; bit j of ``mask`` marks suffix first + j as a repeat."""
    doc, count = groups["doc_id"].to_numpy(), groups["n"].to_numpy()
    known: dict[bytes, int] = {}
    text = np.fromiter((known.setdefault(w, len(known)) for w in groups["words"].to_pylist()), np.int64, len(doc))
    smallest = np.full(len(known), np.iinfo(np.int64).max)
    np.minimum.at(smallest, text, doc)
    counts = np.zeros(len(known), np.int64)
    counts[text] = count
    least = smallest_below(list(known), counts, smallest, width)
    mask = ((least[text] < doc[:, None]).astype(np.int64) << np.arange(least.shape[1])).sum(axis=1)
    hit = np.flatnonzero(mask)
    part = groups.select(["doc_id", "key", "first"]).take(pa.array(hit)).combine_chunks()
    return pa.RecordBatch.from_arrays([*[part[c].combine_chunks() for c in part.column_names], pa.array(mask[hit])], names=["doc_id", "key", "first", "mask"])


def later_repeats(docs: DataFrame, width: int = WIDTH, prefix: int = PREFIX, limit: int = LIMIT) -> DataFrame:
    """(doc_id, key, first, mask): suffixes whose first ``width`` words also start in a document with a smaller doc_id. ``docs`` as of _keyed()."""
    if not 0 < prefix <= width or width - prefix > 61:
        raise ValueError("prefix must be from 1 to width, and at most 61 words shorter")
    spark: SparkSession = docs.sparkSession
    several = saved(prefix_counts(docs, width, prefix).filter("least < most").select("a", "n"), "prefixes")
    repeated = spark.sparkContext.broadcast(_bits(several, REPEATED_BITS))
    frequent = spark.sparkContext.broadcast(_bits(several.filter(F.col("n") > limit), FREQUENT_BITS))
    dropped(several)
    found = saved(records(docs, repeated, frequent, width, prefix), "records")

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) < limit:
                continue
            table = pa.Table.from_batches(held)
            a = table["a"].to_numpy()
            whole = int(np.searchsorted(a, a[-1]))  # the last group may go on
            if whole:
                yield repeats_in_trees(table.slice(0, whole), width)
                held = table.slice(whole).to_batches()
        if held and sum(map(len, held)):
            yield repeats_in_trees(pa.Table.from_batches(held), width)

    grouped = found.filter("words is not null").select("a", "doc_id", "key", "first", "n", "words").repartition("a").sortWithinPartitions("a")
    below = grouped.mapInArrow(trees, MASK)
    nodes = found.filter("words is null")
    least = nodes.groupBy("a", "b").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most")
    single = nodes.join(least.select(F.col("a").alias("of_a"), F.col("b").alias("of_b"), "least"), (F.col("a") == F.col("of_a")) & (F.col("b") == F.col("of_b")) & (F.col("doc_id") > F.col("least")))
    return below.unionByName(single.select("doc_id", "key", "first", F.lit(1).cast("long").alias("mask")))


CUT = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("spans", T.StringType())])


def cutter(width: int):
    @F.pandas_udf(CUT)
    def cut(texts: pd.Series, marks: pd.Series) -> pd.DataFrame:
        out = []
        for text, own in zip(texts, marks, strict=True):
            words = (text or "").encode("utf-8", "surrogatepass").split()
            if own is None:
                out.append((b" ".join(words).decode("utf-8", "surrogatepass"), len(words), 0, ""))
                continue
            first = np.array([m["first"] for m in own], np.int64)
            mask = np.array([m["mask"] for m in own], np.int64)
            depth = np.zeros(len(words) + 1, np.int64)  # windows opened less windows closed
            for j in range(int(mask.max()).bit_length()):
                at = first[(mask >> j & 1).astype(bool)] + j
                np.add.at(depth, at, 1)
                np.add.at(depth, at + width, -1)
            gone = np.cumsum(depth)[:-1] > 0
            edge = np.flatnonzero(np.diff(np.r_[False, gone, False]))
            left = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
            out.append((b" ".join(left).decode("utf-8", "surrogatepass"), len(words), int(gone.sum()), ",".join(f"{a}:{b}" for a, b in edge.reshape(-1, 2).tolist())))
        return pd.DataFrame(out, columns=["text", "n_words", "n_removed", "spans"])

    return cut


def with_cuts(docs: DataFrame, width: int = WIDTH, prefix: int = PREFIX, limit: int = LIMIT) -> DataFrame:
    """(row, cut): the document as it was, and what is left of it: text (kept words joined by one space), n_words, n_removed and
    the maximal repeated stretches as first:past in words (spans)."""
    found = later_repeats(_keyed(docs), width, prefix, limit)
    marks = found.groupBy("doc_id", "key").agg(F.collect_set(F.struct("first", "mask")).alias("marks"))
    marks = marks.select(F.col("doc_id").alias("of_doc"), F.col("key").alias("of_key"), "marks")
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.col("row.text").cast("string")
    joined = row.join(marks, (F.col("row.doc_id").cast("long") == F.col("of_doc")) & (F.xxhash64(text) == F.col("of_key")), "left")
    return joined.select("row", cutter(width)(text, "marks").alias("cut"))


def substring_report(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, spans) of every document."""
    cut = with_cuts(docs.select("doc_id", "text"), width)
    return cut.select("row.doc_id", "cut.n_words", "cut.n_removed", F.sha2(F.col("cut.text").cast("binary"), 256).alias("kept_sha256"), "cut.spans")


def dedup_substrings(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents with later repeats cut out of ``text``; ``n_chars`` follows it. A text that loses nothing stays as it was."""
    cut, kinds = with_cuts(docs, width), dict(docs.dtypes)
    text = F.when(F.col("cut.n_removed") > 0, F.col("cut.text")).otherwise(F.col("row.text").cast("string"))
    new = {"text": text, "n_chars": F.when(F.col("cut.n_removed") > 0, F.length("cut.text").cast(kinds.get("n_chars", "long"))).otherwise(F.col("row.n_chars")) if "n_chars" in kinds else None}
    return cut.select(*[new[c].alias(c) if new.get(c) is not None else F.col(f"row.`{c}`") for c in docs.columns])


#: DuckDB SQL for substring_report() over the table documents with unique doc_id.
SQL = rf"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
p as (select doc_id, len(w) as n, unnest(w) as word, generate_subscripts(w, 1) - 1 as i from d),
s as (select doc_id, i, concat_ws(' ', word, {", ".join(f"lead(word, {k}) over o" for k in range(1, WIDTH))}) as win, i + {WIDTH} <= n as whole from p window o as (partition by doc_id order by i)),
f as (select doc_id, i, min(doc_id) over (partition by win) < doc_id as later from s where whole),
g as (select distinct doc_id, i + k as i from f, range({WIDTH}) r(k) where later),
e as (select doc_id, min(i) as a, max(i) + 1 as b from (select doc_id, i, i - row_number() over (partition by doc_id order by i) as run from g) group by doc_id, run),
x as (select doc_id, string_agg(a || ':' || b, ',' order by a) as spans, sum(b - a)::bigint as n_removed from e group by doc_id),
k as (select doc_id, string_agg(word, ' ' order by i) as kept from p anti join g using (doc_id, i) group by doc_id)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(x.n_removed, 0)::bigint as n_removed, sha256(coalesce(k.kept, '')) as kept_sha256, coalesce(x.spans, '') as spans
from d left join x on d.doc_id = x.doc_id left join k on d.doc_id = k.doc_id
"""
