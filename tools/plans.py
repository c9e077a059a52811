"""Dump trimmed physical plans of the headline queries to PLANS.md.

usage: python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from tidepool.plans import catalog  # noqa: E402
from tidepool.session import build_session  # noqa: E402

KEEP = re.compile(r"(Exchange|Join|Aggregate|Scan|Window|Subquery|TakeOrdered|Union|Generate|"
                  r"ArrowEvalPython|Broadcast|Limit|Filter|Sort)")


def trim(line: str) -> str:
    line = re.sub(r"#\d+L?", "", line)
    line = re.sub(r"\[plan_id=\d+\]", "", line)
    line = re.sub(r", Location: InMemoryFileIndex\([^)]*\)\[[^\]]*\]", "", line)
    return line[:170]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `tools/plans.py` on `{sf}` (AQE initial plans; operator lines only,",
           "expressions trimmed). Scans show pushed filters and read schemas.", ""]
    from tidepool.operators import dedup
    from tidepool.sources import tables
    keyed = dedup.with_band(dedup.with_bloom_bits(dedup.with_message_keys(
        tables.raw_messages(spark, sf))))
    extra = {"flag pass 1: first_seen (materialised lookup tables)":
             lambda: dedup.first_seen(keyed, 3, 5)}
    for name in [*extra, *HEADLINE]:
        buf = io.StringIO()
        with redirect_stdout(buf):
            (extra[name]() if name in extra else catalog.QUERIES[name](spark, sf)).explain()
        lines = [trim(x) for x in buf.getvalue().splitlines() if KEEP.search(x)]
        out += [f"## {name}", "", "```", *lines, "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"),
              "w", encoding="utf-8") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
