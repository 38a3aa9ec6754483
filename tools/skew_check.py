"""Rank a skewed input and print the rows per range.

The input is ``lineitem`` three times over (so every row has three exact
copies), with a third of the rows turned into one hot key (``hot``) or into
one identical row (``copies``).  Usage: python tools/skew_check.py [sf_dir] [ranges]
"""

from __future__ import annotations

import sys

sys.path.insert(0, ".")
from pyspark.sql import functions as F  # noqa: E402

from tessera.operators.paging import place_in_ranges, rank_rows  # noqa: E402
from tessera.session import get_session  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    ranges = int(sys.argv[2]) if len(sys.argv) > 2 else 16
    spark = get_session(shuffle_partitions=ranges)
    li = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag")
    big = li.unionByName(li).unionByName(li)
    hot = F.col("l_orderkey") % 3 == 0  # selects the rows to rewrite; all rows are kept
    cases = {
        "hot": big.withColumn("l_orderkey", F.when(hot, F.lit(42)).otherwise(F.col("l_orderkey"))),
        "copies": big.select(*[F.when(hot, F.lit(v)).otherwise(F.col(c)).alias(c)
                               for c, v in [("l_orderkey", 1), ("l_partkey", 1), ("l_linenumber", 1),
                                            ("l_returnflag", "A")]]),
    }
    for name, df in cases.items():
        ranked = rank_rows(df, ["l_orderkey"], "r", ranges=ranges)
        placed = place_in_ranges(df, ["l_orderkey"], ranges)
        sizes = [r["n"] for r in placed.groupBy("range_id").agg(F.count(F.lit(1)).alias("n")).collect()]
        stats = ranked.agg(F.countDistinct("r"), F.min("r"), F.max("r"), F.count(F.lit(1))).first()
        print(f"{name}: rows {stats[3]}, distinct ranks {stats[0]} ({stats[1]}..{stats[2]}), "
              f"largest range {max(sizes)}, mean {sum(sizes) // len(sizes)}")


if __name__ == "__main__":
    main()
