"""Write the executed physical plans of the headline queries to PLANS.md.

Usage: python scripts/show_plans.py [sf_dir]

Each query runs once (so the plans are AQE's final plans); long expression
text is cut to keep the file readable.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from posting_analytics.plans import driver_queries as Q  # noqa: E402
from posting_analytics.session import local_session  # noqa: E402

SHOW = ["extract_postings", "value_share_customer", "topn_per_group", "mode_per_group",
        "cluster_summary", "topk_semijoin", "distinct_counts", "required_filter", "link_discovery"]
WIDTH = 160


def tree(plan: str) -> str:
    """The operator tree and the scan details of a formatted plan."""
    lines = plan.splitlines()
    out, in_tree = [], True
    for ln in lines:
        if in_tree:
            if ln.strip() == "" and out:
                in_tree = False
                continue
            out.append(ln[:WIDTH])
        elif re.match(r"^(PushedFilters|ReadSchema|Arguments: .*(Partial|Final|SinglePartition|hashpartitioning|RoundRobin))", ln) \
                or re.match(r"^\(\d+\) (Scan|Exchange|WindowGroupLimit|BroadcastExchange|ReusedExchange)", ln):
            out.append(ln[:WIDTH])
    return "\n".join(out)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    parts = ["# Physical plans of the headline queries",
             "",
             f"Final (AQE) plans after one run on `{os.path.basename(sf_dir)}`, `local[8]`, made by",
             "`scripts/show_plans.py`. Expression text is cut at "
             f"{WIDTH} characters.", ""]
    for name in SHOW:
        df = Q.QUERIES[name](spark, sf_dir)
        df.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        plan = buf.getvalue()
        parts += [f"## {name}", "", "```", tree(plan), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"),
              "w", encoding="utf-8") as f:
        f.write("\n".join(parts))


if __name__ == "__main__":
    main(sys.argv)
