"""
test tables: ``events`` replicated ``copies`` times with offset ids (the
other tables linked unchanged), optionally with every third event moved to
one user and one song (a third of all rows on one key of each join).

    python tools/scale_inputs.py /root/testdata/sf0.1 OUT_DIR 30 [--skew]
    BENCH_SF_DIR=OUT_DIR python bench.py
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from encore.session import get_session  # noqa: E402

ID_STRIDE = 1_000_000     # id offset per copy (above the largest test event id)
HOT_USER = 1
HOT_PROPS = '{"k": 1}'    # song_1


def main(argv=None) -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("src")
    ap.add_argument("out")
    ap.add_argument("copies", type=int)
    ap.add_argument("--skew", action="store_true")
    a = ap.parse_args(argv)
    spark = get_session("local[8]", app="scale-inputs")
    ev = spark.read.parquet(f"{a.src}/events.parquet")
    # each event row becomes ``copies`` rows in its own task (no join, no shuffle)
    big = (ev.withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(a.copies - 1))))
             .withColumn("event_id", F.col("event_id") + F.col("r") * ID_STRIDE))
    if a.skew:
        hot = F.col("event_id") % 3 == 0
        big = (big.withColumn("user_id", F.when(hot, F.lit(HOT_USER)).otherwise(F.col("user_id")))
                  .withColumn("props", F.when(hot & F.col("props").isNotNull(), F.lit(HOT_PROPS))
                              .otherwise(F.col("props"))))
    big.select(*ev.columns).write.parquet(f"{a.out}/events.parquet")
    for t in ("customer", "nation", "part", "region", "supplier"):
        os.symlink(f"{os.path.abspath(a.src)}/{t}.parquet", f"{a.out}/{t}.parquet")


if __name__ == "__main__":
    main()
