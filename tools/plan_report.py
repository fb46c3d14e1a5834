"""Print the physical operator trees of the key registered queries (markdown).

Usage: python tools/plan_report.py [sf_dir] > docs/plans.md
Only the operator lines of ``explain()`` are kept, after the query has run
once (so AQE shows its final plan).
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.plans.suite import QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402

KEY_QUERIES = ["totals_rollup", "actions_rollup", "enrich_join", "lookback_totals", "top_wikis", "event_mix",
               "log_share", "contract_violations", "feed_clean", "latest_totals", "row_estimate", "backfill_totals",
               "upsert_latest_totals", "stream_totals", "current_incremental"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", extra={"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    print(f"# Physical plans of the key queries ({os.path.basename(sf_dir)}, local[8])\n")
    print("Generated by `tools/plan_report.py`: the physical plan Spark picks up front (AQE may still coalesce\n"
          "partitions or split skewed ones at run time). Things to look for: one `from_json`, behind a `Generate`;\n"
          "`partial_count` before the only event-side `Exchange`; the lookup joined after the aggregate as a\n"
          "`BroadcastHashJoin`; `ReadSchema` pruned to the four columns the mapping reads. The `RoundRobinPartitioning`\n"
          "exchange appears only because the test file is a single row group (see `sources/tables.spread`).\n")
    for name in KEY_QUERIES:
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        lines = [ln[:160] for ln in buf.getvalue().splitlines() if ln.strip()]
        print(f"## {name}\n\n```")
        print("\n".join(lines))
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
