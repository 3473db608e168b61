"""Key and hashing column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The null token and separator of the dbt_utils surrogate key
# (version 1.4.1), so keys equal the ones the SQL warehouse produced.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEP = "-"


def surrogate_key(*cols: str | Column) -> Column:
    """md5 over the '-'-joined string form of the columns, nulls tokenised."""
    parts = [F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEP, *parts))


def stable_hash64(c: str | Column) -> Column:
    """Unsigned 64-bit integer from the first 16 hex digits of sha256, as
    decimal(20,0): identical on every engine and every run."""
    col = F.col(c) if isinstance(c, str) else c
    return F.conv(F.substring(F.sha2(col.cast("string"), 256), 1, 16), 16, 10).cast("decimal(20,0)")


def stable_bucket(c: str | Column, n: int) -> Column:
    """Deterministic bucket in [0, n) of an identifier."""
    return F.pmod(stable_hash64(c), F.lit(n)).cast("bigint")
