"""Bytes that a point lookup reads from the register as it was computed and as it is laid out for lookups.

usage: python tools/lookup_bytes.py [--sf DIR] [--out DIR]
"""

from __future__ import annotations

import argparse
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from sparkbook.plans.q_temporal import register_versions  # noqa: E402
from sparkbook.session import local_session  # noqa: E402
from sparkbook.sources.files import bytes_read, replace_table, write_clustered  # noqa: E402

DAY = "date '1999-06-30'"


def measure(spark, sf, out):
    versions = register_versions(spark, sf)
    replace_table(versions.repartition(16, "record_sequence"), f"{out}/plain")
    # Vectored reads pass the file system's byte counters, which Spark's metrics are taken from.
    read = spark.read.option("parquet.hadoop.vectored.io.enabled", "false")
    plain = read.parquet(f"{out}/plain")
    write_clustered(plain, f"{out}/laid", None, ["isin", "trading_venue_mic"], bloom=["instrument_version_sk"], row_group_bytes=1 << 20)
    laid = read.parquet(f"{out}/laid")
    some = plain.filter(f"valid_from <= {DAY} and valid_to >= {DAY}").orderBy(F.sha1("instrument_version_sk")).first()  # none that a bound of the column would find
    lookups = {
        "version of a key on a day": f"isin = {some['isin']} and trading_venue_mic = {some['trading_venue_mic']} and valid_from <= {DAY} and valid_to >= {DAY}",
        "version by its hashed key": f"instrument_version_sk = '{some['instrument_version_sk']}'",
        "absent hashed key": "instrument_version_sk = '77777777777777777777777777777777'",
    }
    for name, where in lookups.items():
        (a, left), (b, right) = bytes_read(plain.filter(where)), bytes_read(laid.filter(where))
        assert sorted(map(str, left)) == sorted(map(str, right))
        yield {"lookup": name, "rows": len(left), "plain_bytes": a, "laid_bytes": b, "ratio": round(a / max(b, 1), 1)}


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("--out", default=None)
    a = ap.parse_args()
    spark = local_session(8, shuffle_partitions=16)
    for row in measure(spark, a.sf, a.out or tempfile.mkdtemp(prefix="lookup-")):
        print(json.dumps(row))
    spark.stop()


if __name__ == "__main__":
    main()
