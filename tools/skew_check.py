"""Hot-key check: flag N generated messages where one message holds a third of all rows.

usage: python tools/skew_check.py [N]   (not a registered query: generated input, timing only)
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tidepool.operators import dedup, synth  # noqa: E402
from tidepool.session import build_session  # noqa: E402


def main() -> None:
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 2_000_000
    spark = build_session("local[8]", shuffle_partitions=16)
    gen = synth.synthesize(spark.range(n).withColumnRenamed("id", "i"), "i")
    hot = F.when(F.col("idx") % 3 == 0, F.lit("Where is my parcel?")).otherwise(F.col("message"))
    msgs = gen.select(F.col("idx").alias("seq"), hot.alias("message"))
    t0 = time.time()
    out = dedup.flag_messages(msgs).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("is_duplicate").alias("dup"),
        F.count_if("is_near_duplicate").alias("near")).first()
    t1 = time.time()
    ex = dedup.exact_flags(dedup.with_message_keys(msgs)).agg(
        F.count_if("is_exact_duplicate").alias("exact")).first()
    t2 = time.time()
    print({"rows": out.rows, "bloom_dup": out.dup, "near": out.near, "exact": ex.exact,
           "flag_sec": round(t1 - t0, 2), "exact_sec": round(t2 - t1, 2)})
    spark.stop()


if __name__ == "__main__":
    main()
