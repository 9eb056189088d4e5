"""Write a Markdown review of every registered query's physical plan.

    python -m shoplens.plans.report /root/testdata/sf0.01 > PLANS.md

For each query: the Parquet scans (columns read, filters pushed), every
shuffle and the operator feeding it, and the notable operators.  The plans
are taken before execution (AQE may still coalesce partitions or switch a
join at run time).
"""

from __future__ import annotations

import re
import sys

from shoplens.plans import inspect as P
from shoplens.plans.registry import QUERIES
from shoplens.session import build_session

_NOTABLE = (
    "Expand",
    "Window",
    "TakeOrderedAndProject",
    "Union",
    "SortMergeJoin",
    "BroadcastHashJoin",
    "ShuffledHashJoin",
    "BroadcastNestedLoopJoin",
    "Subquery",
    "Generate",
)


def _short(text: str, n: int = 110) -> str:
    text = re.sub(r"#\d+L?", "", text)
    text = re.sub(r", \[plan_id=\d+\]", "", text)
    return text if len(text) <= n else text[: n - 1] + "…"


def review(base_dir: str) -> str:
    spark = build_session(
        "local[2]", shuffle_partitions=8, extra={"spark.sql.maxMetadataStringLength": "10000"}
    )
    out = [
        "# Physical plans of the registered queries",
        "",
        f"Generated by `python -m shoplens.plans.report {base_dir}` (Spark {spark.version}, "
        "plans before execution).  A scalar subquery used in several places "
        "is listed once; Spark reuses it at run time.",
        "",
    ]
    for name, build in QUERIES.items():
        df = build(spark, base_dir)
        plan = P.physical_plan(df)
        scans = {tuple(sorted(s.items())): s for s in P.scans(df)}.values()
        shuffles = sorted({(_short(ex, 70), _short(child, 70)) for ex, child in P.shuffle_inputs(df)})
        notable = [n for n in _NOTABLE if re.search(rf"\b{n}\b", plan)]
        raw = P.unaggregated_shuffles(df)
        out.append(f"## {name}")
        out.append("")
        for s in scans:
            pushed = s["pushed"] if s["pushed"] != "[]" else "none"
            out.append(f"- scan `{s['table']}` reads `{s['schema']}`; pushed filters: `{_short(pushed, 160)}`")
        for ex, child in shuffles:
            out.append(f"- shuffle `{ex}` fed by `{child}`")
        if not shuffles:
            out.append("- no shuffle")
        out.append(f"- operators: {', '.join(notable) if notable else 'scan, project, aggregate'}")
        out.append(f"- shuffles of raw (unaggregated) rows: {len(raw)}")
        out.append("")
    spark.stop()
    return "\n".join(out)


if __name__ == "__main__":
    print(review(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"))
