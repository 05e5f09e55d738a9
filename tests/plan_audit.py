"""Flag physical plans that would not survive large data.

``python -m tests.plan_audit [sf_dir] [name-prefix ...]``
"""

from __future__ import annotations

import re
import sys

FLAGS = {
    "cartesian": r"CartesianProduct",
    "nested loop": r"BroadcastNestedLoopJoin",
    "one partition": r"Exchange SinglePartition",
    "python": r"(BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas)",
    "coalesce": r"Coalesce 1\b",
}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df, table: str) -> int:
    """How often the plan reads a table."""
    return len(re.findall(rf"FileScan parquet[^\n]*?/{table}\.parquet", plan_of(df)))


def audit(df) -> list[str]:
    text = plan_of(df)
    return [name for name, pattern in FLAGS.items() if re.search(pattern, text)]


def main() -> None:
    import __spark_entry__ as entry
    from surelake import session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = session.build("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    for name, q in entry.queries().items():
        if sys.argv[2:] and not any(name.startswith(p) for p in sys.argv[2:]):
            continue
        df = q(spark, folder)
        text = plan_of(df)
        print(f"{name:32s} shuffles={len(re.findall(r'Exchange hash', text)):3d} joins={len(re.findall(r'(Sort|Broadcast|Shuffled)[A-Za-z]*Join', text)):3d} "
              f"windows={len(re.findall(r'Window ', text)):2d} {audit(df)}", flush=True)


if __name__ == "__main__":
    main()
