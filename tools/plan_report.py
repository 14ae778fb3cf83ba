"""Summarise the physical plans of the measure queries as markdown.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md

For each query: the final adaptive plan of the returned frame, and the plan of every
intermediate that the query wrote on the way (these jobs scan the claims).
"""
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from qmeasures.operators import reuse  # noqa: E402
from qmeasures.plans.queries import all_queries  # noqa: E402
from qmeasures.session import local_session  # noqa: E402

NAMES = ["m_well_child", "m_ed_visits", "m_ed_visits_mi", "m_custody", "m_oral_eval", "m_prev_dental",
         "m_prenatal", "m_postpartum", "m_aod_init", "m_aod_engage", "elig_gaps", "delivery_groups"]


def scans(plan: str) -> list[tuple[str, str, int]]:
    """(source, pushed filters, columns read) of each file scan."""
    out = []
    for line in plan.splitlines():
        if "FileScan parquet" not in line:
            continue
        where = re.search(r"Location: \w+\s*\([^)]*\)\s*\[([^\],]*)", line)
        pushed = re.search(r"PushedFilters: (\[.*?\]), ReadSchema", line)
        schema = re.search(r"ReadSchema: struct<(.*)>", line)
        name = where.group(1).rstrip(". ").split("/")[-1] if where else "(unknown)"
        name = "written intermediate" if name.startswith("stage-") else name
        out.append((name, pushed.group(1) if pushed else "[]", schema.group(1).count(":") if schema else 0))
    return out


def counts(plan: str) -> dict:
    return {
        "shuffles": len(re.findall(r"Exchange hashpartitioning", plan)), "reused": plan.count("ReusedExchange"),
        "bhj": plan.count("BroadcastHashJoin"), "smj": plan.count("SortMergeJoin"),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "partial_aggs": len(re.findall(r"HashAggregate\(keys=.*functions=\[partial_", plan)),
    }


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    spark.conf.set("spark.sql.maxMetadataStringLength", 300)
    qs = all_queries()
    qs["m_well_child"](spark, "/root/testdata/sf0.001").count()
    print(f"# Physical plans ({os.path.basename(sf)}, local[8], AQE on)\n")
    print("Generated by `tools/plan_report.py`. `result` is the final adaptive plan of the returned frame, `job n` the plan\n"
          "of the n-th intermediate that the query wrote (before adaptive changes: its join kinds may still turn into\n"
          "broadcast joins at run time). Shuffles in these jobs are part of the query's cost.\n")
    print("| query | plan | shuffles | reused | broadcast joins | sort-merge joins | windows | partial aggs |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    details = []
    for name in NAMES:
        jobs: list[str] = []
        reuse.observers[:] = [lambda df, jobs=jobs: jobs.append(df._jdf.queryExecution().executedPlan().toString())]
        df = qs[name](spark, sf)
        reuse.observers.clear()
        df.write.format("noop").mode("overwrite").save()
        df.collect()
        plans = [("result", df._jdf.queryExecution().executedPlan().toString())] + [(f"job {i}", p) for i, p in enumerate(jobs, 1)]
        for kind, plan in plans:
            c = counts(plan)
            print(f"| {name} | {kind} | {c['shuffles']} | {c['reused']} | {c['bhj']} | {c['smj']} | {c['windows']} | "
                  f"{c['partial_aggs']} |")
        details.append((name, plans))
    for name, plans in details:
        print(f"\n## {name}\n")
        for kind, plan in plans:
            for source, pushed, n in scans(plan):
                print(f"- {kind}: scan `{source}`, {n} columns, pushed `{pushed[:140]}`")


if __name__ == "__main__":
    main()
