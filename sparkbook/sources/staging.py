"""Declarative staging: rename + cast projections driven by a spec."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stage(df: DataFrame, spec: Sequence[tuple], tolerant: bool = False) -> DataFrame:
    """Project ``df`` by an ordered spec of (source, target, type[, mode]).

    mode 'strict' (default for generated data) is an ANSI cast that fails the
    job on a bad value; 'tolerant' (published data) nulls it. A source column
    missing from the input raises immediately (schema drift guard).
    """
    missing = [s[0] for s in spec if s[0] not in df.columns]
    if missing:
        raise ValueError(f"columns missing from source: {missing}")
    cols = []
    for item in spec:
        src, dst, typ = item[:3]
        mode = item[3] if len(item) > 3 else ("tolerant" if tolerant else "strict")
        c = F.col(src).try_cast(typ) if mode == "tolerant" else F.col(src).cast(typ)
        cols.append(c.alias(dst))
    return df.select(*cols)
