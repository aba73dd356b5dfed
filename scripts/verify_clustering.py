"""Check a clustering CSV against an edge-list CSV; print the disagreements.

    spark-submit scripts/verify_clustering.py <edges.csv> <clustering.csv>

Exit code 1 (with the findings) when a vertex repeats or the vertex sets differ.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from graphcluster.operators.verify import verify_clustering  # noqa: E402
from graphcluster.sources.edges import read_assignments, read_edges  # noqa: E402


def main(argv=None) -> int:
    argv = sys.argv[1:] if argv is None else argv
    if len(argv) != 2:
        print(__doc__)
        return 2
    spark = SparkSession.builder.appName("verify-clustering").getOrCreate()
    row = verify_clustering(read_edges(spark, argv[0]), read_assignments(spark, argv[1])).first()
    spark.stop()
    if row["duplicates"]:
        print(f"rows that repeat a vertex: {row['duplicates']}")
    if row["unassigned"]:
        print(f"rows without a vertex or label: {row['unassigned']}")
    if row["missing"] or row["unknown"]:
        print(f"vertices without a row: {row['missing']}, rows for other ids: {row['unknown']}")
    if not row["valid"]:
        return 1
    print(f"valid, cost {row['disagreements']}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
