"""Write PLANS.md: what each named query's physical plan does.

    python tests/plan_report.py [/root/testdata/sf0.01] > PLANS.md

Per query: exchanges (shuffles) by kind, broadcast joins, sort-merge joins,
windows, top-k nodes, pushed filters and the columns the scans read. Plans
are taken from the planner (before adaptive re-planning at runtime).
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def facts(plan: str) -> dict:
    from reelkpi.plans import inspect

    shuffles = inspect.shuffles(plan)
    return {
        "hash shuffles": sum(s.startswith("Exchange hashpartitioning") for s in shuffles),
        "range shuffles": sum(s.startswith("Exchange rangepartitioning") for s in shuffles),
        "single-partition": sum(s.startswith("Exchange SinglePartition") for s in shuffles),
        "broadcasts": plan.count("BroadcastExchange"),
        "smj": plan.count("SortMergeJoin"),
        "windows": len(re.findall(r"\bWindow\b", plan)),
        "top-k": plan.count("TakeOrderedAndProject"),
        "python": ",".join(inspect.python_nodes(plan)) or "none",
        "pushed": sorted({f for f in inspect.pushed_filters(plan) if f}),
        "reads": inspect.read_schemas(plan),
    }


def table(spark, fns: dict) -> None:
    from reelkpi.plans import inspect

    cols = ["hash shuffles", "range shuffles", "single-partition", "broadcasts", "smj", "windows", "top-k", "python"]
    print("| query | " + " | ".join(cols) + " | scan reads |")
    print("|---" * (len(cols) + 2) + "|")
    for name, build in fns.items():
        f = facts(inspect.physical_plan(build()))
        print(f"| {name} | " + " | ".join(str(f[c]) for c in cols) + f" | {'; '.join(f['reads'])[:300]} |")


def main(argv: list[str]) -> None:
    import tempfile

    from reelkpi.operators.cleaning import clean_films
    from reelkpi.plans.registry import ON_CLEAN, QUERIES
    from reelkpi.session import local_session
    from reelkpi.sources.fixture import films_from_tables
    from reelkpi.sources.landing import materialize

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(checkpoint_dir=tempfile.mkdtemp(prefix="reelkpi-plans-"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")  # show whole scan metadata
    clean = materialize(clean_films(films_from_tables(spark, sf_dir)), "plan-report-clean")
    reports = {name: (lambda fn=fn: fn(clean)) for name, fn in ON_CLEAN.items()}
    others = {name: (lambda q=q: q(spark, sf_dir)) for name, q in QUERIES.items() if name not in ON_CLEAN}
    print("# Physical plans of the named queries\n")
    print(f"Generated by `tests/plan_report.py` on `{os.path.basename(sf_dir)}`, planner output "
          "(AQE may still coalesce partitions, turn shuffle joins into broadcasts from measured "
          "sizes, and split skewed partitions at runtime).\n")
    print("## Reports on a written clean table (how the bench runs them)\n")
    table(spark, reports)
    print("\n## The same with automatic broadcasts off (large inputs)\n")
    print("Only hinted broadcasts are left: the two groups of the franchise reports, the n rows of the top "
          "franchises, and the genres after they were counted.\n")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    table(spark, reports)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    print("\n## Cleaning steps, sources and sinks (on the written raw table)\n")
    table(spark, others)
    print("\n## Deriving the raw film table, with and without automatic broadcasts\n")
    for threshold in (before, "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        print(f"`spark.sql.autoBroadcastJoinThreshold` = {threshold}\n")
        table(spark, {"films_from_tables": lambda: films_from_tables(spark, sf_dir)})
        print()


if __name__ == "__main__":
    main(sys.argv)
