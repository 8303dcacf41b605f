"""Dump the physical plan of every registered query to PLANS.md.

Usage: python scripts/explain_plans.py [sf_dir] [out_file]

For each query: shuffle exchanges (with their keys), broadcast exchanges,
join operators, scans with the filters pushed into them and the columns
they read, what AQE changed when the query ran, then the plan tree (from
``explain("formatted")``).
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from strata.plans.registry import QUERIES  # noqa: E402
from strata.session import build_session  # noqa: E402


def summarize(formatted: str) -> dict:
    tree, _, details = formatted.partition("\n\n\n")
    shuffles = []
    for block in details.split("\n\n"):
        head = block.strip().splitlines()[:1]
        if head and re.match(r"\(\d+\) (Exchange|ShuffleQueryStage)", head[0]):
            args = [ln for ln in block.splitlines() if ln.startswith("Arguments:")]
            if args:
                shuffles.append(re.sub(r", \[plan_id=\d+\]", "", args[0][len("Arguments: "):]))
    return {
        "tree": tree.strip(),
        "shuffles": shuffles,
        "broadcasts": tree.count("BroadcastExchange"),
        "joins": re.findall(r"(BroadcastHashJoin \w+|SortMergeJoin \w+|ShuffledHashJoin \w+|BroadcastNestedLoopJoin \w+|CartesianProduct)", tree),
        "pushed": sorted(set(re.findall(r"PushedFilters: (\[[^\]]+\])", details))),
        "read": sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", details))),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out_file = sys.argv[2] if len(sys.argv) > 2 else os.path.join(ROOT, "PLANS.md")
    spark = build_session("local[8]", shuffle_partitions=16)
    lines = [
        "# Physical plans of the registered queries",
        "",
        f"Generated by `scripts/explain_plans.py` on `{sf_dir}` (local[8], 16 shuffle partitions, AQE on).",
        "Lines describe the initial adaptive plan; 'after execution' lists what the final",
        "one of a run shows (coalesced or skew-split shuffle reads, joins).",
        "Queries that publish tables run their writes first; the plan shown is the",
        "read-back query.",
        "",
    ]
    for name, q in QUERIES.items():
        df = q(spark, sf_dir)
        buf = io.StringIO()
        with redirect_stdout(buf):
            df.explain("formatted")
        s = summarize(buf.getvalue())
        df.collect()  # run it, then read the final adaptive plan of this execution
        final = df._jdf.queryExecution().executedPlan().toString()
        aqe = sorted(set(re.findall(r"AQEShuffleRead \w+", final)))
        aqe += sorted(
            {
                f"{kind} {how}"
                for kind, how in re.findall(
                    r"(BroadcastHashJoin|SortMergeJoin(?:\(skew=true\))?|ShuffledHashJoin) \[[^\]]*\], \[[^\]]*\], (\w+)", final
                )
            }
        )
        lines += [f"## {name}", ""]
        lines.append(f"* shuffles: {len(s['shuffles'])}" + (" — " + "; ".join(s["shuffles"]) if s["shuffles"] else ""))
        lines.append(f"* broadcast exchanges: {s['broadcasts']}")
        lines.append(f"* joins: {', '.join(s['joins']) or 'none'}")
        for p in s["pushed"]:
            lines.append(f"* pushed filters: `{p}`")
        for r in s["read"]:
            lines.append(f"* read schema: `{r}`")
        lines.append(f"* after execution (AQE): {', '.join(aqe) or 'no adaptive change'}")
        lines.append("")
    with open(out_file, "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines))
    spark.stop()


if __name__ == "__main__":
    main()
