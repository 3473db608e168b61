"""Packing by shortest-pack-first over the length histogram.

Documents become token ids, are cut into pieces of at most ``capacity`` ids,
and the pieces are laid into sequences. Only the histogram of piece lengths
(``capacity`` entries at most) is needed to decide the layout: lengths are
placed longest first, each into the open packs that hold least, and what is
updated are counts of packing patterns, never single documents. A piece then
finds its place by its length and its rank among the pieces of that length.

Ranks need no global sort. Each task numbers its pieces per length, the counts
per (task, length) are summed into offsets, and rank = offset + number. A length
that a third of all pieces share is spread over all tasks that made them.

Defined cases: a null text counts as empty; an empty document is its end id
alone; a document of any length is encoded whole; repeated rows are packed as
often as they occur; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkbook.llm.common import saved, small_batches

SPECIAL = "<|endoftext|>"


class Encoder:
    """Ids of the byte-level BPE vocabulary.

    The rank file holds the same vocabulary as the JSON file and is encoded four
    times faster; only a text that spells out the special token differs, and
    goes to the tokenizer of the JSON file. Tests hold the two against each other.
    """

    def __init__(self, json_path: str, ranks_path: str, pattern: str):
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.json_path, self.exact = json_path, None
        self.fast = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> list[int]:
        if SPECIAL not in text:
            return self.fast.encode_ordinary(text)
        if self.exact is None:
            from tokenizers import Tokenizer

            self.exact = Tokenizer.from_file(self.json_path)
        return self.exact.encode(text, add_special_tokens=False).ids


def public_encoder() -> Encoder:
    import public_tokenizers as P

    return Encoder(P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


PIECES = "doc_id long, start long, length int, ids binary, ids_crc32 long, doc_tokens long, part int, nth long"


def token_pieces(docs: DataFrame, capacity: int = 1024, end_id: int = 0, encoder=public_encoder, with_ids: bool = False) -> DataFrame:
    """One row per piece, numbered within its task and length. ``ids`` (little-endian unsigned 32 bit) only ``with_ids``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, seen = encoder(), TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py() or "")
                ids.append(end_id)
                raw, n = np.asarray(ids, "<u4").tobytes(), len(ids)
                for start in range(0, n, capacity):
                    length = min(capacity, n - start)
                    piece = raw[4 * start : 4 * (start + length)]
                    out.append((doc_id, start, length, piece if with_ids else None, zlib.crc32(piece), n, part, seen[length]))
                    seen[length] += 1
            cols = list(zip(*out, strict=True)) or [[]] * 8
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[x.split()[0] for x in PIECES.split(", ")])

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, PIECES)


def pack_histogram(histogram: dict[int, int], capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """Shortest-pack-first: [(how many sequences, lengths in each)].

    Each length goes to the packs that hold least; where none has room, just as
    many open as this length alone can fill, and are filled with it. Work and
    result depend on the number of lengths, not of pieces.
    """
    groups: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    rooms: list[int] = []

    def put(room: int, n: int, pattern: tuple[int, ...]) -> None:
        if room not in groups:
            groups[room] = []
            insort(rooms, room)
        groups[room].append((n, pattern))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if not rooms or rooms[-1] < length:
                put(capacity, -(-left // (capacity // length)), ())
            room = rooms[-1]
            n, pattern = groups[room].pop()
            if not groups[room]:
                del groups[room], rooms[bisect_left(rooms, room)]
            if n > left:
                put(room, n - left, pattern)
            put(room - length, min(n, left), (*pattern, length))
            left -= min(n, left)
    return [(n, pattern) for room in rooms for n, pattern in groups[room] if pattern]


def pattern_slots(patterns: list[tuple[int, tuple[int, ...]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, past the last rank, first sequence, offset, tokens in the sequence) for each place in a pattern."""
    slots, rank, sequence = [], {}, 0
    for n, pattern in patterns:
        offset, whole = 0, sum(pattern)
        for length in pattern:
            first = rank.get(length, 0)
            rank[length] = first + n
            slots.append((length, first, first + n, sequence, offset, whole))
            offset += length
        sequence += n
    return slots


def pack_pieces(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """Give each numbered piece (``length``, ``part``, ``nth``) its sequence and offset.

    The frame must be stable (a written table): it is read for the counts and
    again for the places. The driver sees one number per length.
    """
    spark = pieces.sparkSession
    counts = saved(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "pack-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = spark.createDataFrame(
        pattern_slots(pack_histogram(histogram, capacity)),
        "at_length int, first_rank long, past_rank long, first_sequence long, offset long, sequence_tokens long",
    )
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("part").alias("at_part"), F.col("length").alias("of_length"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    ranked = pieces.join(offsets, (F.col("part") == F.col("at_part")) & (F.col("length") == F.col("of_length"))).withColumn("rank", F.col("skip") + F.col("nth"))
    # Bounded by construction: the places of all patterns, which the histogram of `capacity` lengths decides.
    placed = ranked.join(F.broadcast(slots), (F.col("length") == F.col("at_length")) & (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("past_rank")))
    power_of_two = F.expr("sequence_tokens & (sequence_tokens - 1)") == 0
    return placed.select(
        "doc_id", "start", F.col("length").cast("long").alias("length"), "ids", "ids_crc32", "doc_tokens",
        (F.col("first_sequence") + F.col("rank") - F.col("first_rank")).alias("sequence_id"), "offset", "sequence_tokens",
        F.when(power_of_two, F.col("sequence_tokens")).otherwise(capacity).alias("padded_tokens"),
    )


def pack(docs: DataFrame, capacity: int = 1024, end_id: int = 0, encoder=public_encoder, with_ids: bool = False) -> DataFrame:
    """Pack all documents; one row per piece."""
    return pack_pieces(saved(token_pieces(docs, capacity, end_id, encoder, with_ids), "pieces"), capacity)
