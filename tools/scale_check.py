"""Time a few operators on lineitem at 1x and 3x (the table unioned with itself).

Usage: python tools/scale_check.py [sf_dir] [ranges]
"""

from __future__ import annotations

import sys
import time

sys.path.insert(0, ".")
from pyspark.sql import functions as F  # noqa: E402

from tessera.operators.infer import infer_types  # noqa: E402
from tessera.operators.objects import upsert  # noqa: E402
from tessera.operators.paging import assign_pages  # noqa: E402
from tessera.operators.parts import part_manifest, write_parts  # noqa: E402
from tessera.session import get_session, scratch_path  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    ranges = int(sys.argv[2]) if len(sys.argv) > 2 else 16
    spark = get_session(shuffle_partitions=ranges)
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    noop = lambda df: df.write.format("noop").mode("overwrite").save()
    for copies in (1, 3):
        big = li
        for _ in range(copies - 1):
            big = big.unionByName(li)
        # Spread the single-row-group input so both sizes use all cores alike.
        big = big.repartition(ranges)
        key = F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
        target = big.withColumn("k", key)
        changes = target.where(F.col("l_returnflag") == "R").select("k", (F.col("l_quantity") + 1).alias("l_quantity"))
        steps = {
            "pages": lambda: noop(assign_pages(big, ["l_orderkey"], 1000, ranges=ranges)),
            "infer": lambda: infer_types(big.select(*[F.col(c).cast("string").alias(c) for c in big.columns])).collect(),
            "part_manifest": lambda: part_manifest(big, ["l_orderkey"], 10 * 1024 * 1024).collect(),
            "write_parts_range": lambda: write_parts(big, scratch_path(spark, "scale-parts"), ["l_orderkey"],
                                                     10 * 1024 * 1024, split="range").collect(),
            "upsert_full_outer": lambda: noop(upsert(target.dropDuplicates(["k"]), changes.dropDuplicates(["k"]), "k",
                                                     plan="full_outer")),
        }
        for name, fn in steps.items():
            fn()  # warm
            t0 = time.perf_counter()
            fn()
            print(f"{copies}x rows={li.count() * copies} {name}: {time.perf_counter() - t0:.2f}s", flush=True)


if __name__ == "__main__":
    main()
