"""Print the physical plan of every analysis stage (formatted), for plan review.

Usage: python scripts/explain_plans.py [sf_dir] [stage ...]
Stages are built without materialisation, so each plan shows its full lineage
from the parquet scans.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from basketlab.plans.catalog import analysis  # noqa: E402
from basketlab.session import local_session  # noqa: E402

STAGES = ["panel", "returns", "corr", "baskets", "cov", "member_stats", "optimal_weights", "summary", "detail"]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or STAGES
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    a = analysis(spark, sf, optimal=True, materialize_stages=False)
    for name in names:
        print(f"===== {name} =====")
        getattr(a, name).explain("formatted")


if __name__ == "__main__":
    main()
