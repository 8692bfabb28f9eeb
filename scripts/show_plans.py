"""Print the final physical plan (after AQE) of named queries, one line per operator.

usage: python scripts/show_plans.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from meterstream.plans.catalog import QUERIES  # noqa: E402
from meterstream.session import build_session  # noqa: E402

KEEP = re.compile(r"(ReadSchema: \S+|PushedFilters: \[[^\]]*\])")


def compact(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        if not line.strip():
            continue
        head = re.sub(r"#\d+L?", "", line)
        extra = " ".join(KEEP.findall(line))
        head = re.sub(r"\[.*", "", head)[:110]
        out.append(head + (" " + extra if extra else ""))
    return out


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args and "/" in args[0] else "/root/testdata/sf0.1"
    names = [a for a in args if "/" not in a] or [
        "window_agg_30s", "rule_anomalies", "parse_envelope", "scaler_stats", "model_anomalies",
        "distance_threshold", "severity_bands", "pct_of_average", "panel_trend", "panel_latest",
        "anomalies_per_building"]
    spark = build_session("local[8]", shuffle_partitions=8)
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        df.collect()
        print(f"== {name}")
        for line in compact(df._jdf.queryExecution().executedPlan().toString()):
            print("  " + line)
    spark.stop()


if __name__ == "__main__":
    main()
