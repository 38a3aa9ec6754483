from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tests.conftest import SF
from tessera.session import scratch_path
from tessera.operators.paging import assign_pages, chunk_bounds, exact_sample, key_ranges, pk_chunks, place_in_ranges, rank_rows, spans


def test_rank_equals_row_number(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    mine = rank_rows(o, ["o_orderdate", "o_orderkey"], "r")
    ref = o.withColumn("r", (F.row_number().over(Window.orderBy("o_orderdate", "o_orderkey")) - 1).cast("long"))
    assert mine.exceptAll(ref).count() == 0 and ref.exceptAll(mine).count() == 0


def test_rank_with_hot_key_and_identical_copies(spark):
    # A third of the rows are identical copies of one row; ranks must still be
    # 0..n-1 without gaps and the copies must spread over several ranges.
    hot = spark.range(3000).select(F.lit(7).alias("k"), F.lit("same").alias("v"))
    rest = spark.range(6000).select((F.col("id") % 100).alias("k"), F.col("id").cast("string").alias("v"))
    df = hot.unionByName(rest).repartition(5)
    ranked = rank_rows(df, ["k"], "r", ranges=6)
    stats = ranked.agg(F.min("r"), F.max("r"), F.countDistinct("r"), F.count("*")).first()
    assert tuple(stats) == (0, 8999, 9000, 9000)
    placed = place_in_ranges(df, ["k"], 6)
    spread = placed.where((F.col("k") == 7) & (F.col("v") == "same")).select("range_id").distinct().count()
    assert spread > 1


def test_rank_partition_independent(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet").select("o_custkey", "o_orderkey")
    a = rank_rows(o.repartition(1), ["o_custkey"], "r")
    b = rank_rows(o.repartition(13), ["o_custkey"], "r", ranges=3)
    assert a.exceptAll(b).count() == 0


def test_pages_and_chunks(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    pages = assign_pages(o, ["o_orderkey"], 1000)
    counts = {r["page"]: r["count"] for r in pages.groupBy("page").count().collect()}
    assert counts == {p: 1000 for p in range(15)}
    bounds = chunk_bounds(pk_chunks(o, "o_orderkey", 4000), "o_orderkey").orderBy("chunk_id").collect()
    assert [(b["min_key"], b["max_key"], b["n_rows"]) for b in bounds] == [
        (0, 3999, 4000), (4000, 7999, 4000), (8000, 11999, 4000), (12000, 14999, 3000)]


def test_exact_sample_repeatable(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    a = [r["o_orderkey"] for r in exact_sample(o, 50, ["o_orderkey"]).collect()]
    b = [r["o_orderkey"] for r in exact_sample(o.repartition(7), 50, ["o_orderkey"]).collect()]
    assert len(a) == 50 and sorted(a) == sorted(b)


def whole(ranked, n):
    got = ranked.agg(F.min("r"), F.max("r"), F.countDistinct("r"), F.count("*")).first()
    return tuple(got) == (0, n - 1, n, n)


def test_rank_of_many_rows_with_a_map_column(spark):
    # The map stays in the result: no branch of the plan can prune it away.
    df = spark.range(2_000_000).select((F.col("id") % 1000).alias("k"), F.create_map(F.lit("id"), F.col("id").cast("string")).alias("m"))
    ranked = rank_rows(df, ["k"], "r", ranges=8)
    assert whole(ranked, 2_000_000) and "m" in ranked.columns


def test_rank_without_exchange_reuse(spark):
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        df = spark.range(200_000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
        assert whole(rank_rows(df, ["k"], "r", ranges=8), 200_000)
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def check_ranges(df, key, size):
    ranges = key_ranges(df, key, size)
    assert [r.chunk_id for r in ranges] == list(range(len(ranges)))
    if ranges:
        assert ranges[0].low is None and ranges[-1].high is None
        assert all(a.high == b.low for a, b in zip(ranges, ranges[1:], strict=False))
    assert sum(r.rows for r in ranges) == df.count()
    assert all(r.of(df, key).count() == r.rows for r in ranges)
    return ranges


def test_key_ranges_cover_each_row_once(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    ranges = check_ranges(o, "o_orderkey", 1000)
    assert max(r.rows for r in ranges) <= 1000 and len(ranges) <= 20
    hot = spark.range(3000).select(F.lit(7).alias("k")).unionAll(spark.range(900).select((F.col("id") % 300).cast("int").alias("k"))).unionAll(spark.range(40).select(F.lit(None).cast("int").alias("k")))
    ranges = check_ranges(hot, "k", 100)
    assert [r.rows for r in ranges if r.rows > 100] == [3003]  # one value cannot be cut
    assert check_ranges(hot.where("k is null"), "k", 100)[0].rows == 40 and check_ranges(hot.where("false"), "k", 100) == []
    doubles = spark.range(2000).select((F.col("id") % 500 / 7).alias("x"))
    assert max(r.rows for r in check_ranges(doubles, "x", 150)) <= 150
    assert len(check_ranges(spark.range(5000).select((F.col("id") * F.col("id") * 1000).alias("k")), "k", 300)) <= 25


def test_key_ranges_of_many_chunks_take_few_jobs_and_scans(spark):
    """Three thousand chunks, some of one hot value: as many jobs as for a few chunks, and few scans."""
    even = spark.range(300_000).select((F.col("id") * 7919 % 300_007).alias("k"))
    df = even.unionAll(spark.range(900).select((F.col("id") % 3 * 100_000).alias("k"))).unionAll(spark.range(50).select(F.lit(None).cast("long").alias("k")))
    group = "many-chunks"
    spark.sparkContext.setJobGroup(group, group)
    try:
        ranges = key_ranges(df, "k", 100)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 20 and 3000 <= len(ranges) <= 3100
    assert [r.rows for r in ranges if r.rows > 100] == [df.where(f"k = {k}").count() for k in (0, 100_000, 200_000)]
    read = spans(ranges)
    assert len(read) == 16 and [r for s in read for r in s.ranges] == ranges
    got = read[0].of(df, "k")
    for s in read[1:]:
        got = got.unionAll(s.of(df, "k"))
    got = got.groupBy("chunk_id").agg(F.min("n_rows").alias("a"), F.max("n_rows").alias("b"), F.count("*").alias("n"), F.min("k").alias("low"), F.max("k").alias("last")).orderBy("chunk_id").collect()
    assert [(r["chunk_id"], r["a"], r["b"], r["n"]) for r in got] == [(r.chunk_id, r.rows, r.rows, r.rows) for r in ranges]
    assert all(r.low in (None, g["low"]) and (None in (r.high, g["last"]) or g["last"] < r.high) for r, g in zip(ranges, got, strict=True))


def test_key_ranges_of_awkward_keys(spark):
    odd = spark.createDataFrame([(x,) for x in [float("nan")] * 30 + [float("inf")] * 5 + [-0.0, 0.0] * 4 + [None] * 12 + [0.1 * k for k in range(40)]], "x double")
    ranges = key_ranges(odd, "x", 10)
    assert [r.rows for r in ranges if r.rows > 10] == [12, 30] and all(r.of(odd, "x").count() == r.rows for r in ranges)
    # The least value is hot: what lies above it is cut as well.
    low = spark.range(500).select(F.lit(0).alias("k")).unionAll(spark.range(50).select((F.col("id") + 1).cast("int").alias("k")))
    assert [r.rows for r in check_ranges(low, "k", 100)] == [500, 50]
    assert spans([])[0].of(low.where("false"), "k").collect() == []
    parts = spans(ranges, 2)
    assert sum(s.of(odd, "x").count() for s in parts) == odd.count()


def test_a_key_range_reads_few_row_groups(spark):
    """The range reaches the Parquet reader, which skips row groups by their bounds."""
    path = scratch_path(spark, "ranges")
    spark.range(200_000).repartitionByRange(1, "id").sortWithinPartitions("id").write.option("parquet.block.size", "65536").parquet(path)
    df = spark.read.parquet(path)
    r = key_ranges(df, "id", 10_000)[5]
    part = r.of(df, "id")
    text = part._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThanOrEqual(id" in text and "LessThan(id" in text
    plan = part._jdf.queryExecution().executedPlan()
    assert part.agg(F.count("*")).first()[0] == r.rows
    scan = part.select("id")
    rows = scan._jdf.queryExecution().executedPlan()
    scan._jdf.queryExecution().toRdd().count()
    metrics = rows.collectLeaves().apply(0).metrics()
    assert metrics.apply("numOutputRows").value() < 100_000 and plan is not None
