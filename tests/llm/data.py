"""Small documents with the awkward cases every operator has a defined result for."""

import random

WORDS = "the of and river stone light paper green quiet morning letter window garden copper winter signal harbor meadow candle thread".split()
#: Names that operators use inside or return; a document may have columns called so.
CLASHES = ["kept", "component_id", "size", "row", "key", "part", "of", "fp", "u", "rate", "window", "a", "b", "length", "sequence_id", "words", "metric", "root", "cut", "copies", "drawn", "nth", "h", "chosen", "name", "h2", "part_", "idx", "tree", "path", "marks", "salt", "bits", "leaf"]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 40)) for _ in range(n))


def text(rng, lines=6, n=12):
    return "\n".join(sentence(rng, n) for _ in range(lines))


def rows(seed=3, n=40):
    """(doc_id, text, lang, source): copies, near copies, shared passages, nulls, empties, ties, repeated rows, one long text."""
    rng = random.Random(seed)
    out = [(i, text(rng), rng.choice(["en", "fr"]), rng.choice(["s1", "s2", "s3"])) for i in range(n)]
    base = out[0][1]
    out += [(100 + i, base, "en", "s1") for i in range(4)]  # copies
    out += [(110, base.upper(), "en", "s2"), (111, base + " tail", "en", None)]  # differ by case, by a word
    passage = text(rng, 5, 14)
    out += [(120 + i, text(rng, 3) + "\n" + passage + "\n" + text(rng, 2), "fr", "s2") for i in range(3)]
    out += [(130, None, None, None), (131, "", "en", "s1"), (132, " \n\t ", "en", "s3"), (133, "a", None, "s1"), (134, "123 456", "en", "")]
    out += [(135, out[1][1], "en", "s1"), (135, out[1][1], "en", "s1"), (None, "no name here at all", "en", "s1"), (None, None, None, None)]  # repeated rows, null ids
    out += [(140, " ".join(sentence(rng, 50) for _ in range(400)), "en", "s1"), (141, "same line\n" * 30, "en", "s2")]
    return out


def frame(spark, data, clashes=False):
    df = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in data], "doc_id long, text string, lang string, source string, n_chars long")
    if clashes:
        from pyspark.sql import functions as F

        df = df.select("*", *[F.lit("x").alias(c) for c in CLASHES])
    return df.repartition(3)
