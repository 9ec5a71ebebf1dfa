"""Physical-plan summary of every registered query (run: python tests/plan_report.py [sf_dir]).

Counts shuffles, broadcasts, Python operators and scans in the executed (adaptive) plan and lists
the filters pushed into each Parquet scan. Output: Markdown on stdout.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

STREAMING = {"ip_change_stream", "travel_stream", "wire_after_ip_change_stream"}


def summarize(spark, df) -> dict:
    df.collect()  # final adaptive plan
    plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    final = plan.split("== Initial Plan ==")[0]
    pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]*)\]", final)))
    return {
        "shuffles": len(re.findall(r"\+- Exchange (?:hashpartitioning|RoundRobin|rangepartitioning|SinglePartition)", final)),
        "reused": final.count("ReusedExchange"),
        "broadcasts": len(re.findall(r"\+- BroadcastExchange", final)),
        "python": len(re.findall(r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas", final)),
        "scans": final.count("FileScan parquet"),
        "pushed": "; ".join(p for p in pushed if p) or "-",
    }


def main() -> None:
    from riskflow.session import get_spark

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", shuffle_partitions=8)
    from riskflow.plans import catalog

    print(f"| query | shuffles | reused | broadcasts | python ops | scans | pushed filters |")
    print("|---|---|---|---|---|---|---|")
    for name, fn in catalog.queries().items():
        if name in STREAMING:
            continue
        r = summarize(spark, fn(spark, sf))
        print(f"| {name} | {r['shuffles']} | {r['reused']} | {r['broadcasts']} | {r['python']} | {r['scans']} | {r['pushed']} |")


if __name__ == "__main__":
    main()
