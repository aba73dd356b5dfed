"""Check a matching CSV against an edge-list CSV; print its size.

    spark-submit scripts/verify_matching.py <edges.csv> <matching.csv>
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from graphcluster.operators.verify import verify_matching  # noqa: E402
from graphcluster.sources.edges import read_edges, read_matching  # noqa: E402


def main(argv=None) -> int:
    argv = sys.argv[1:] if argv is None else argv
    if len(argv) != 2:
        print(__doc__)
        return 2
    spark = SparkSession.builder.appName("verify-matching").getOrCreate()
    row = verify_matching(read_edges(spark, argv[0]), read_matching(spark, argv[1])).first()
    spark.stop()
    if row["duplicates"]:
        print(f"rows that repeat a pair: {row['duplicates']}")
    if row["foreign"]:
        print(f"pairs without an edge in the input: {row['foreign']}")
    if row["max_degree"] > 1:
        print(f"most pairs at one vertex: {row['max_degree']}")
    if not row["valid"]:
        return 1
    print(f"valid, {row['size']} pairs")
    return 0


if __name__ == "__main__":
    sys.exit(main())
