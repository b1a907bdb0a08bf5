"""Write PLANS.md: the executed physical plans of the headline queries.

Usage: python scripts/show_plans.py [sf_dir]. Each plan is taken after the
query ran (AQE final plan), trimmed to the operator lines, so that pushdown,
codegen stages, broadcasts, subqueries and exchanges can be reviewed.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.plans.registry import QUERIES, load_all  # noqa: E402
from strata.session import local_session  # noqa: E402

SHOWN = ["gold_price_summary", "gold_hospital_summary", "mart_generation_mix", "int_regional_metrics",
         "mart_regional_comparison", "silver_hrrp", "dedupe_polls", "gold_latest_prices"]


def operator_lines(plan: str) -> str:
    plan = plan.split("== Initial Plan ==")[0]  # AQE prints the final plan first
    keep = []
    for line in plan.splitlines():
        if re.search(r"(Exchange|Scan|Join|Aggregate|Window|Sort|Subquery|Filter|BroadcastExchange|"
                     r"ReusedExchange|AdaptiveSparkPlan|CollectLimit|TakeOrderedAndProject|Union|Expand)", line):
            keep.append(line[:220])
    return "\n".join(keep)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    load_all()
    spark = local_session("strata-plans", 8)
    out = ["# Physical plans (AQE final plans, operator lines only)", "",
           f"Generated by `scripts/show_plans.py` on `{sf_dir}`.", ""]
    for name in SHOWN:
        df = QUERIES[name](spark, sf_dir)
        df.collect()  # run this DataFrame's own execution so the AQE plan is final
        plan = df._jdf.queryExecution().executedPlan().toString()
        out += [f"## {name}", "", "```", operator_lines(plan), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
