"""Registered queries: one per operator of the survey's inventory, each over
the given tables, with the DuckDB SQL that computes the same answer.

The test tables stand in for remote objects: ``customer`` for accounts,
``orders`` for opportunities (``o_orderstatus = 'F'`` marks deleted rows),
``events`` for the event dataset, ``documents`` / ``conversations`` for long
text fields; saved scripts are built per account and load nation names (the
registry).  Every query's input grows with the scale factor.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.casting import cast_columns, cast_value, url_encode_fields
from tessera.functions.encode import csv_lines
from tessera.functions.lenient import Lenient
from tessera.operators import jobs, objects, paging, parts, profile, query
from tessera.operators.infer import infer_types, merge_types
from tessera.operators.infer_files import infer_added_files
from tessera.operators.naming import resolve_dataset_names
from tessera.plans import publish as pub
from tessera.plans.read import read_records
from tessera.session import scratch_path
from tessera.sources import bulk, csvranges, scan
from tessera.sources.records import discover_header, rows_from_records, to_records

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- inputs


def event_fields(ev: DataFrame) -> DataFrame:
    """Events with two optional fields: ``coupon`` on purchases, ``flag`` where
    the value is high or low (absent in between)."""
    return ev.select(
        "*",
        F.when(F.col("event_type") == "purchase", F.concat(F.lit("C"), F.col("user_id").cast("string"))).alias("coupon"),
        F.when(F.col("value") > 50, F.lit("true")).when(F.col("value") <= 10, F.lit("false")).alias("flag"),
    )


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_records(event_fields(table(spark, sf_dir, "events")))


def event_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as strings, plus an all-blank and a mixed (integer / timestamp) column."""
    ev = event_fields(table(spark, sf_dir, "events"))
    return ev.select(
        *[F.col(c).cast("string").alias(c) for c in ev.columns],
        F.lit("").alias("blank"),
        F.when(F.col("event_type") == "click", F.col("user_id").cast("string"))
        .otherwise(F.col("ts").cast("string"))
        .alias("mixed"),
    )


EVENT_STRING_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props", "coupon", "flag", "blank", "mixed"]


def account_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change set for accounts: every AUTOMOBILE account with a new balance and
    an upper-cased name (blank where the nation key is 0), plus one new
    account per supplier (negative keys); only some columns."""
    cu = table(spark, sf_dir, "customer")
    su = table(spark, sf_dir, "supplier")
    changed = cu.where(F.col("c_mktsegment") == "AUTOMOBILE").select(
        "c_custkey",
        F.when(F.col("c_nationkey") == 0, F.lit("")).otherwise(F.upper("c_name")).alias("c_name"),
        (F.col("c_acctbal") + F.lit(100.0)).alias("c_acctbal"),
    )
    fresh = su.select(
        (-F.col("s_suppkey") - F.lit(1)).alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.col("s_acctbal").alias("c_acctbal"),
    )
    return changed.unionByName(fresh)


ACCOUNT_CHANGES_SQL = """
changes as (
  select c_custkey, case when c_nationkey = 0 then '' else upper(c_name) end as c_name,
         c_acctbal + 100.0 as c_acctbal
  from customer where c_mktsegment = 'AUTOMOBILE'
  union all
  select -s_suppkey - 1 as c_custkey, s_name as c_name, s_acctbal as c_acctbal from supplier
)"""


def job_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("job_id"), _status_expr().alias("status"))


def _status_expr() -> Column:
    pr, st = F.col("o_orderpriority"), F.col("o_orderstatus")
    return (
        F.when(pr == "1-URGENT", F.lit("Completed"))
        .when(pr == "2-HIGH", F.lit("CompletedWithWarnings"))
        .when(pr == "3-MEDIUM", F.when(st == "F", F.lit("Failed")).otherwise(F.lit("InProgress")))
        .when(pr == "4-NOT SPECIFIED", F.when(st == "P", F.lit("Queued")).otherwise(F.lit("NotProcessed")))
        .otherwise(F.when(st == "O", F.lit("New")).otherwise(F.lit("Archived")))
    )


STATUS_SQL = """case o_orderpriority when '1-URGENT' then 'Completed'
  when '2-HIGH' then 'CompletedWithWarnings'
  when '3-MEDIUM' then case when o_orderstatus = 'F' then 'Failed' else 'InProgress' end
  when '4-NOT SPECIFIED' then case when o_orderstatus = 'P' then 'Queued' else 'NotProcessed' end
  else case when o_orderstatus = 'O' then 'New' else 'Archived' end end"""


def saved_queries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """One saved script per account: it loads the account's nation, its market
    segment and the nation again; the registry knows nation names only."""
    n = table(spark, sf_dir, "nation")
    cu = table(spark, sf_dir, "customer")
    q = cu.join(n, cu.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").alias("query_id"),
        F.concat(
            F.lit('q = load "'), F.col("n_name"), F.lit('"; r = load "'), F.col("c_mktsegment"),
            F.lit('"; s = load "'), F.col("n_name"),
            F.lit("\"; q = limit q 50; r = order r by 'name' desc;"),
        ).alias("query"),
    )
    reg = n.select(
        F.col("n_name").alias("name"),
        F.concat(F.lit("0Fb"), F.lpad(F.col("n_nationkey").cast("string"), 12, "0"), F.lit("/0Fc"),
                 F.lpad(F.col("n_regionkey").cast("string"), 12, "0")).alias("dataset_id"),
    )
    return q, reg


SAVED_QUERIES_SQL = """
q as (
  select c_custkey as query_id,
         'q = load "' || n_name || '"; r = load "' || c_mktsegment || '"; s = load "' || n_name ||
         '"; q = limit q 50; r = order r by ''name'' desc;' as query
  from customer join nation on c_nationkey = n_nationkey
),
reg as (
  select n_name as name,
         '0Fb' || lpad(cast(n_nationkey as varchar), 12, '0') || '/0Fc' || lpad(cast(n_regionkey as varchar), 12, '0') as dataset_id
  from nation
)"""

# ---------------------------------------------------------------- queries


def q_group_count(spark, d):
    """Flagship: event records -> header -> inferred schema -> typed rows ->
    ``group q by ('event_type', 'user_id')`` + ``count() as 'count'``."""
    rows = read_records(event_records(spark, d), infer=True)
    return query.dataset_query(rows, by=["event_type", "user_id"])


def q_group_all(spark, d):
    rows = read_records(event_records(spark, d), infer=True)
    return query.dataset_query(rows, by="all")


def q_limit_rows(spark, d):
    rows = read_records(event_records(spark, d), infer=True)
    return query.dataset_query(
        rows,
        by=["event_type", "user_id"],
        generate_items=[("event_type", "event_type"), ("user_id", "user_id"), ("count", "count")],
        limit=2000,
        order_by=["event_type", "user_id"],
    )


def q_multi_load(spark, d):
    def events():
        return read_records(event_records(spark, d), infer=True)

    def accounts():
        return read_records(to_records(table(spark, d, "customer")), infer=True)

    q = query.last_assignment([("q", events), ("r", events), ("q", accounts)], "q")
    return query.dataset_query(q, by=["c_mktsegment"])


def q_dataset_scan(spark, d):
    cu = table(spark, d, "customer")
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in cu.schema.fields])
    return rows_from_records(to_records(cu), schema)


RAGGED_SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("coupon", T.StringType()),
                              T.StructField("flag", T.BooleanType())])


def q_records_missing_blank(spark, d):
    """Absent keys read as "": blank string, null boolean."""
    return rows_from_records(event_records(spark, d), RAGGED_SCHEMA, missing="")


def q_records_missing_null(spark, d):
    """Absent keys read as null."""
    return rows_from_records(event_records(spark, d), RAGGED_SCHEMA, missing=None)


def q_read_widest(spark, d):
    """Read plan with the widest record's header and inferred types."""
    return read_records(event_records(spark, d), infer=True, header_mode="widest")


def q_header_union(spark, d):
    return discover_header(event_records(spark, d), mode="union")


def q_header_widest(spark, d):
    return discover_header(event_records(spark, d), mode="widest")


def q_infer_types(spark, d):
    return infer_types(event_strings(spark, d), EVENT_STRING_COLUMNS)


def q_infer_sample(spark, d):
    """Inference over the first 1000 records in event order (the sample size)."""
    return infer_types(event_strings(spark, d), EVENT_STRING_COLUMNS, sample_size=1000,
                       order_by=[F.col("event_id").cast("long")])


ORDER_PATTERN = "yyyy-MM-dd'T'HH:mm:ss"


def q_infer_pattern(spark, d):
    """Inference with a timestamp pattern (orders as text, dates in the pattern)."""
    o = table(spark, d, "orders")
    text = o.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.date_format("o_orderdate", ORDER_PATTERN).alias("o_orderdate"),
        F.col("o_totalprice").cast("string").alias("o_totalprice"),
        "o_orderpriority",
    )
    return infer_types(text, date_format=ORDER_PATTERN)


def q_merge_types(spark, d):
    per_group = infer_types(event_strings(spark, d), EVENT_STRING_COLUMNS, by=["event_type"], empty_as=None)
    return merge_types(per_group, by=["column"])


def q_cast_numeric(spark, d):
    li = table(spark, d, "lineitem")
    cols = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    text = li.select(*[F.col(c).cast("string").alias(c) for c in cols])
    schema = T.StructType([T.StructField(c, li.schema[c].dataType, True) for c in cols])
    return cast_columns(text, schema)


def q_cast_narrow(spark, d):
    li = table(spark, d, "lineitem")
    ln, qty = F.col("l_linenumber").cast("string"), F.col("l_quantity").cast("string")
    return li.select(
        "l_orderkey", "l_partkey", "l_suppkey",
        cast_value(ln, T.ByteType(), name="ln_byte").alias("ln_byte"),
        cast_value(ln, T.ShortType(), name="ln_short").alias("ln_short"),
        cast_value(qty, T.FloatType(), name="qty").alias("qty"),
    )


def q_cast_decimal(spark, d):
    o = table(spark, d, "orders")
    text = o.select("o_orderkey", F.format_number("o_totalprice", 2).alias("price"))
    return text.select("o_orderkey", cast_value(F.col("price"), T.DecimalType(12, 2), name="price").alias("price"))


def q_cast_boolean(spark, d):
    ev = table(spark, d, "events")
    words = (
        F.when(F.col("event_type") == "click", F.lit("TRUE"))
        .when(F.col("event_type") == "view", F.lit("false"))
        .when(F.col("event_type") == "purchase", F.lit("True"))
        .when(F.col("event_type") == "signup", F.lit("yes"))
        .otherwise(F.lit("t"))
    )
    return ev.select("event_id", cast_value(words, T.BooleanType(), on_error="null", name="flag").alias("flag"))


def q_cast_timestamp(spark, d):
    ev = table(spark, d, "events")
    plain = F.col("ts").cast("string")
    patterned = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return ev.select(
        "event_id",
        cast_value(plain, T.TimestampNTZType(), name="ts").alias("ts"),
        cast_value(patterned, T.TimestampNTZType(), date_format="yyyy-MM-dd'T'HH:mm:ss", name="ts_s").alias("ts_s"),
    )


def q_cast_date(spark, d):
    o = table(spark, d, "orders")
    return o.select(
        "o_orderkey", cast_value(F.to_date("o_orderdate").cast("string"), T.DateType(), name="d").alias("o_orderdate")
    )


def q_blank_to_null(spark, d):
    o = table(spark, d, "orders")
    deleted = F.col("o_orderstatus") == "F"
    text = o.select(
        "o_orderkey",
        F.when(deleted, F.lit("")).otherwise(F.col("o_custkey").cast("string")).alias("custkey"),
        F.when(deleted, F.lit("")).otherwise(F.col("o_orderpriority")).alias("priority"),
    )
    return text.select(
        "o_orderkey",
        cast_value(F.col("custkey"), T.LongType(), name="custkey").alias("custkey"),
        cast_value(F.col("priority"), T.StringType(), name="priority").alias("priority"),
    )


def q_url_encode(spark, d):
    """``encodeFields="url,html"``: listed string fields URL-encoded, others kept."""
    return url_encode_fields(table(spark, d, "pages"), "url,html")


def q_csv_lines(spark, d):
    return csv_lines(table(spark, d, "documents"), keep=["doc_id"])


def q_csv_lines_java(spark, d):
    """CSV lines with JVM value text: timestamps always carry a fraction."""
    return csv_lines(table(spark, d, "events"), keep=["event_id"], timestamp_style="java")


def q_pages(spark, d):
    return paging.assign_pages(table(spark, d, "orders"), ["o_orderkey"], page_size=1000)


def q_pk_chunks(spark, d):
    chunked = paging.pk_chunks(table(spark, d, "orders"), "o_orderkey", chunk_size=2000)
    return paging.chunk_bounds(chunked, "o_orderkey")


def q_object_query(spark, d):
    return scan.object_scan(
        table(spark, d, "orders"), ["o_orderkey", "o_custkey", "o_orderpriority"],
        not_null=["o_orderpriority"], deleted="o_orderstatus", deleted_value="F",
    )


def q_query_all(spark, d):
    return scan.object_scan(
        table(spark, d, "orders"), ["o_orderkey", "o_custkey", "o_orderpriority"],
        not_null=["o_orderpriority"], deleted="o_orderstatus", deleted_value="F", query_all=True,
    )


def q_name_resolution(spark, d):
    q, reg = saved_queries(spark, d)
    return resolve_dataset_names(q, reg)


def _documents_batches(spark, d, name="documents", order_by=("doc_id",), split="range"):
    src = table(spark, d, name)
    path = scratch_path(spark, f"bulk-{name}")
    manifest = bulk.write_batches(src, path, list(order_by), max_bytes=500_000, split=split)
    return src, path, manifest


def q_bulk_read(spark, d):
    """Batches cut on the running byte offset of all rows, read back whole."""
    src, path, manifest = _documents_batches(spark, d, split="exact")
    return bulk.read_batches(spark, path, manifest, schema=src.schema, max_chars=-1)


def q_bulk_read_range(spark, d):
    """Batches cut at sampled key ranges (one range shuffle), read back whole."""
    src = table(spark, d, "documents")
    path = scratch_path(spark, "bulk-range")
    manifest = bulk.write_batches(src, path, ["doc_id"], max_bytes=500_000, split="range")
    return bulk.read_batches(spark, path, manifest, schema=src.schema, max_chars=-1)


def q_stream_batches(spark, d):
    """Batch result files consumed as a stream (completed batches only) into
    an epoch-partitioned table, read back whole."""
    from tessera.streaming.source import stream_batches

    src, path, _ = _documents_batches(spark, d)
    out = scratch_path(spark, "stream-out")
    q = stream_batches(spark, path, src.schema, out, scratch_path(spark, "stream-ckpt"), max_chars=-1, trigger={"availableNow": True})
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(out).drop("stream", "epoch")


def q_bulk_newlines(spark, d):
    src, path, manifest = _documents_batches(spark, d, "conversations", ("conv_id", "turn"))
    return bulk.read_batches(spark, path, manifest, schema=src.schema, max_chars=-1)


def q_bulk_column_order(spark, d):
    """Batches whose headers list the columns in different orders: matched by name."""
    src = table(spark, d, "documents")
    path = scratch_path(spark, "bulk-order")
    odd = F.col("doc_id") % 2 == 1
    bulk.write_batches(src.where(~odd), path, ["doc_id"], max_bytes=500_000)
    manifest = bulk.write_batches(src.where(odd), path, ["doc_id"], max_bytes=500_000, columns=src.columns[::-1], first_batch=1_000_001)
    return bulk.read_batches(spark, path, manifest, schema=src.schema, max_chars=-1)


def q_bulk_completed(spark, d):
    """Only Completed batches are read: of the odd ones one state is InProgress, of every fifth one Failed."""
    src = table(spark, d, "conversations")
    path = scratch_path(spark, "bulk-states")
    manifest = bulk.write_batches(src, path, ["conv_id", "turn"], max_bytes=20_000, split="exact")
    state = F.when(F.col("batch_id") % 5 == 0, F.lit("Failed")).when(F.col("batch_id") % 2 == 1, F.lit("InProgress"))
    return bulk.read_batches(spark, path, manifest.withColumn("state", F.coalesce(state, F.col("state"))), schema=src.schema, max_chars=-1)


def q_bulk_infer(spark, d):
    """Batches read with the CSV reader's own type inference."""
    _, path, manifest = _documents_batches(spark, d, "conversations", ("conv_id", "turn"))
    return bulk.read_batches(spark, path, manifest, infer=True, max_chars=-1)


def q_bulk_last(spark, d):
    """Each batch split over two result files; only the last result is read."""
    src = table(spark, d, "conversations")
    path = scratch_path(spark, "bulk-last")
    manifest = bulk.write_batches(src, path, ["conv_id", "turn"], max_bytes=500_000, results_per_batch=2, split="exact")
    return bulk.read_batches(spark, path, manifest, schema=src.schema, max_chars=-1, results="last")


def q_bulk_guard(spark, d):
    src, path, manifest = _documents_batches(spark, d)
    rows = bulk.read_batches(spark, path, manifest, schema=src.schema, max_chars=-1, newline=None)
    return bulk.length_violations(rows, ["text"], bulk.DEFAULT_MAX_CHARS, keep=["doc_id"])


def q_encoded_size(spark, d):
    return parts.encoded_size(table(spark, d, "documents"))


def q_size_partitions(spark, d):
    return parts.size_plan(table(spark, d, "documents"), max_bytes=500_000)


def q_size_repartition(spark, d):
    """Rows after the size-derived repartition, and its partitions."""
    out = parts.size_partitions(table(spark, d, "documents"), max_bytes=500_000)
    per = out.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("rows"))
    return per.agg(F.count(F.lit(1)).alias("partitions"), F.sum("rows").alias("rows"), (F.max("rows") - F.min("rows") <= F.count(F.lit(1))).alias("even"))


def q_parts_acknowledged(spark, d):
    """Parts written, acknowledged from the files, and the AND over them."""
    manifest = parts.write_parts(table(spark, d, "orders"), scratch_path(spark, "parts"), ["o_orderkey"], max_bytes=100_000)
    totals = manifest.agg(F.count(F.lit(1)).alias("parts"), F.sum("rows").alias("rows"), F.sum("landed").alias("bytes"))
    return totals.crossJoin(parts.parts_ok(manifest))


def q_part_manifest(spark, d):
    return parts.part_manifest(table(spark, d, "orders"), ["o_orderkey"], max_bytes=100_000)


def q_batch_payloads(spark, d):
    return parts.part_payloads(table(spark, d, "orders"), ["o_orderkey"], max_bytes=100_000, header=True)


def q_insert(spark, d):
    return objects.insert(table(spark, d, "customer"), account_changes(spark, d))


def q_update(spark, d):
    return objects.update(table(spark, d, "customer"), account_changes(spark, d), "c_custkey")


def q_upsert(spark, d):
    return objects.upsert(table(spark, d, "customer"), account_changes(spark, d), "c_custkey", plan="build_source")


def q_upsert_full_outer(spark, d):
    """The same upsert as one full outer join (the plan for large change sets)."""
    return objects.upsert(table(spark, d, "customer"), account_changes(spark, d), "c_custkey", plan="full_outer")


def line_changes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Order lines unique by (l_orderkey, l_linenumber), and changes to them by that key."""
    li = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.max("l_partkey").alias("partkey"), F.max("l_quantity").alias("quantity"))
    changed = li.where(F.col("l_linenumber") % 2 == 0).select("l_orderkey", "l_linenumber", (F.col("quantity") + 1).alias("quantity"))
    fresh = table(spark, sf_dir, "orders").select((-F.col("o_orderkey") - 1).alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.lit(0.5).alias("quantity"))
    return li, changed.unionByName(fresh.withColumn("l_linenumber", F.col("l_linenumber").cast(li.schema["l_linenumber"].dataType)))


def q_upsert_two_keys(spark, d):
    target, changes = line_changes(spark, d)
    return objects.upsert(target, changes, ["l_orderkey", "l_linenumber"])


def q_publish_upsert_two_keys(spark, d):
    path = scratch_path(spark, "publish")
    target, changes = line_changes(spark, d)
    whole = changes.join(target.select("l_orderkey", "l_linenumber", "partkey"), ["l_orderkey", "l_linenumber"], "left")
    label = F.lit("line").alias("kind")  # a dataset needs a Text column
    pub.publish(target.select("*", label), path, upsert=True, unique_ids=["l_orderkey", "l_linenumber"])
    pub.publish(whole.select("l_orderkey", "l_linenumber", "partkey", "quantity", label), path, upsert=True, unique_ids=["l_orderkey", "l_linenumber"])
    return pub.read_dataset(spark, path)


def q_publish_new_schema(spark, d):
    """An overwrite brings its own columns."""
    path = scratch_path(spark, "publish")
    pub.publish(table(spark, d, "part"), path, mode="overwrite")
    pub.publish(table(spark, d, "supplier"), path, mode="overwrite")
    return pub.read_dataset(spark, path)


def q_publish_append_wider(spark, d):
    """An append with a new column: null in the rows before it."""
    path = scratch_path(spark, "publish")
    s = table(spark, d, "supplier")
    pub.publish(s.select("s_suppkey", "s_name"), path, mode="overwrite")
    pub.publish(s.select("s_suppkey", "s_name", "s_acctbal"), path, mode="append")
    return pub.read_dataset(spark, path)


def q_publish_commits(spark, d):
    """The commit rows that three publishes return (without folder, schema and time)."""
    path = scratch_path(spark, "publish")
    cu = table(spark, d, "customer")
    first = pub.publish(cu, path, mode="overwrite")
    second = pub.publish(cu.where("c_custkey % 3 = 0"), path, mode="append")
    third = pub.publish(cu.where("c_custkey % 2 = 0"), path, upsert=True, unique_ids=["c_custkey"])
    return first.unionAll(second).unionAll(third).select("version", "operation", "state", "rows")


def q_write_outcomes(spark, d):
    out = objects.write_outcomes(table(spark, d, "customer"), account_changes(spark, d), "c_custkey", "update")
    return out.groupBy("outcome").agg(F.count(F.lit(1)).alias("rows"))


def q_publish_overwrite(spark, d):
    path = scratch_path(spark, "publish")
    pub.publish(table(spark, d, "part"), path, mode="overwrite")
    return pub.read_dataset(spark, path)


def q_publish_append(spark, d):
    path = scratch_path(spark, "publish")
    s = table(spark, d, "supplier")
    pub.publish(s, path, mode="overwrite")
    pub.publish(s, path, mode="append")
    return pub.read_dataset(spark, path)


def q_publish_upsert(spark, d):
    path = scratch_path(spark, "publish")
    cu = table(spark, d, "customer")
    pub.publish(cu, path, mode="overwrite")
    changes = account_changes(spark, d).join(cu.select("c_custkey", "c_nationkey", "c_mktsegment"), "c_custkey", "left")
    changes = changes.select(*cu.columns)
    pub.publish(changes, path, upsert=True, unique_ids=["c_custkey"])
    return pub.read_dataset(spark, path)


PROFILE_COLUMNS = [
    "position", "column", "full_name", "spark_type", "dataset_type", "precision", "scale", "default_value", "format",
    "can_truncate", "max_length", "null_count", "int_digits", "frac_digits", "fits",
]


def q_field_profile(spark, d):
    return profile.field_profile(table(spark, d, "lineitem"), "lineitem").select(*PROFILE_COLUMNS)


TYPE_MAP_OVERRIDE = {
    "timestamp": {"dataset_type": "Date", "format": "dd.MM.yyyy HH:mm"},
    "string": {"dataset_type": "Text", "canTruncateValue": "true"},
    "interval": {"dataset_type": "Text"},
}


def q_type_map_override(spark, d):
    prof = profile.field_profile(table(spark, d, "orders"), "orders", TYPE_MAP_OVERRIDE)
    return prof.select("column", "spark_type", "dataset_type", "precision", "scale", "format", "can_truncate")


def q_text_columns(spark, d):
    """The one-Text-column rule per table: how many Text columns it declares and whether it may be published."""
    out = None
    for name in ("orders", "lineitem", "customer"):
        df = table(spark, d, name)
        fields = profile.declared_fields(df.drop("o_orderstatus", "o_orderpriority"), name)
        n = fields.agg(F.count_if(F.col("dataset_type") == "Text").alias("texts")).crossJoin(df.agg(F.count(F.lit(1)).alias("rows")))
        n = n.select(F.lit(name).alias("dataset"), "rows", "texts", (F.col("texts") > 0).alias("ok"))
        out = n if out is None else out.unionAll(n)
    return out


def q_metadata_table(spark, d):
    path = scratch_path(spark, "metadata")
    prof = profile.field_profile(table(spark, d, "lineitem"), "lineitem")
    profile.write_metadata(prof, "lineitem", path, unique_ids=["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"])
    return profile.read_metadata(spark, path)


def q_scale_limit(spark, d):
    wide = {"double": {"dataset_type": "Numeric", "precision": "18", "scale": "8"}}
    return profile.scale_violations(profile.field_profile(table(spark, d, "orders"), "orders", wide))


def q_job_outcomes(spark, d):
    wanted = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("job_id")).distinct()
    return jobs.outcome_rollup(jobs.job_outcomes(job_statuses(spark, d), wanted))


def q_all_succeeded(spark, d):
    """The AND of the acknowledgements, for the finished orders' jobs and for all."""
    wanted = table(spark, d, "orders").select(F.col("o_orderkey").alias("job_id"), "o_orderpriority")
    statuses = job_statuses(spark, d)
    done = jobs.all_succeeded(jobs.job_outcomes(statuses, wanted.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))))
    every = jobs.all_succeeded(jobs.job_outcomes(statuses, wanted))
    return done.select(F.lit("finished").alias("jobs"), "ok").unionAll(every.select(F.lit("all"), "ok"))


def q_not_null_fields(spark, d):
    """Not-null filter over a field with nulls, deleted rows included."""
    o = table(spark, d, "orders").withColumn("closed", F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")))
    return scan.object_scan(o, ["o_orderkey", "closed"], not_null=["closed"], query_all=True)


def q_limit_groups(spark, d):
    """A limit below the number of groups."""
    rows = read_records(event_records(spark, d), infer=True)
    return query.dataset_query(rows, by=["event_type", "user_id"], limit=20, order_by=["event_type", "user_id"])


def q_page_union(spark, d):
    """All pages of a result, read one after another: the result again."""
    paged = paging.assign_pages(table(spark, d, "orders"), ["o_orderkey"], page_size=1000)
    last = paged.agg(F.max("page")).first()[0]
    odd, even = (paged.where(F.col("page") % 2 == k) for k in (1, 0))
    return paging.concat_pages([odd, even.where(F.col("page") < last), paging.page(paged, last)] if last % 2 == 0 else [even, odd]).drop("page")


def q_csv_source(spark, d):
    path = scratch_path(spark, "csv-part")
    table(spark, d, "part").write.option("header", "true").csv(path)
    return scan.csv_source(spark, path)


def q_example_rows(spark, d):
    return scan.example_rows(table(spark, d, "orders"), "o_orderkey")


def q_exact_sample(spark, d):
    return paging.exact_sample(table(spark, d, "orders"), 100, ["o_orderkey"], seed=7)


def q_sample_replacement(spark, d):
    """As many draws as a tenth of the orders, with replacement."""
    o = table(spark, d, "orders")
    return paging.sample_with_replacement(o, o.count() // 10, ["o_orderkey"], seed=7)


def q_cast_timestamp_lenient(spark, d):
    """Dates out of the calendar, hours out of the day and text after the last field."""
    ev = table(spark, d, "events")
    k = F.col("event_id")
    pattern = Lenient("yyyy-MM-dd HH:mm:ss")
    text = F.concat(
        F.date_format("ts", "yyyy"), F.lit("-"), (k % 17).cast("string"), F.lit("- "), (k % 70).cast("string"), F.lit(" "), (k % 100).cast("string"),
        F.lit(":"), (k % 200).cast("string"), F.lit(":"), F.lpad((k % 90).cast("string"), 2, "0"), F.when(k % 3 == 0, F.lit(".75 and more")).otherwise(F.lit("")),
    )
    return ev.select("event_id", cast_value(F.when(k % 11 != 0, text).otherwise(F.lit("")), T.TimestampNTZType(), date_format=pattern, name="ts").alias("ts"))


def q_bulk_replaced(spark, d):
    """All batches written again with other rows, one result file for two, the columns the other way round."""
    src = table(spark, d, "conversations")
    path = scratch_path(spark, "bulk-replaced")
    bulk.write_batches(src.withColumn("role", F.concat("role", F.lit(" (old)"))), path, ["conv_id", "turn"], max_bytes=400_000, results_per_batch=2, split="exact")
    manifest = bulk.write_batches(src, path, ["conv_id", "turn"], max_bytes=100_000, columns=src.columns[::-1], split="exact")
    return bulk.read_batches(spark, path, manifest, schema=src.schema, max_chars=-1)


def q_bulk_states(spark, d):
    """Every third batch is logged Failed after Completed; every sixth is Completed again."""
    src = table(spark, d, "conversations")
    path = scratch_path(spark, "bulk-logged")
    manifest = bulk.write_batches(src, path, ["conv_id", "turn"], max_bytes=20_000, split="exact")
    third = bulk.read_manifest(spark, path).where(F.col("batch_id") % 3 == 0)
    bulk.log_batches(third.withColumn("state", F.lit("Failed")), path)
    manifest = bulk.log_batches(third.where((F.col("batch_id") % 6 == 0) & (F.col("state") == "Completed")).dropDuplicates(["batch_id", "result"]), path)
    return bulk.read_batches(spark, path, manifest, schema=src.schema, max_chars=-1)


def q_bulk_header_infer(spark, d):
    """Batches with different column orders, read by name with inferred types."""
    src = table(spark, d, "conversations")
    path = scratch_path(spark, "bulk-header")
    odd = F.col("conv_id") % 2 == 1
    bulk.write_batches(src.where(~odd), path, ["conv_id", "turn"], max_bytes=500_000)
    manifest = bulk.write_batches(src.where(odd), path, ["conv_id", "turn"], max_bytes=500_000, columns=src.columns[::-1], first_batch=1_000_001)
    return bulk.read_batches(spark, path, manifest, infer=True, max_chars=-1)


def q_key_ranges(spark, d):
    """Each chunk of the orders read by its own key range, one after the other; many chunks in a few scans."""
    o = table(spark, d, "orders")
    read = [s.of(o, "o_orderkey") for s in paging.spans(paging.key_ranges(o, "o_orderkey", 2000))]
    return paging.concat_pages([rows.select((F.col("n_rows") <= 2000).alias("fits"), "o_orderkey", "o_custkey") for rows in read])


def q_job_states(spark, d):
    """Order lines as the log of their order's job: the last one wins, old pending jobs have timed out."""
    li = table(spark, d, "lineitem")
    flag = F.col("l_returnflag")
    status = F.when(flag == "R", F.lit("Failed")).when(flag == "A", F.lit("InProgress")).when(F.col("l_linestatus") == "O", F.lit("Queued")).otherwise(F.lit("Completed"))
    log = li.select(F.col("l_orderkey").alias("job_id"), status.alias("status"), F.col("l_shipdate").alias("at"), F.col("l_linenumber").alias("line"))
    return jobs.job_states(log, F.lit("1999-01-01 00:00:00"), "90 days", order_by=["line"])


def q_infer_incremental(spark, d):
    """Types of the orders' CSV files, kept up while files are added: in three steps of about a third each."""
    o = table(spark, d, "orders")
    path, states = scratch_path(spark, "infer-files"), scratch_path(spark, "infer-states")
    cols = [F.col(c).cast("string").alias(c) for c in o.columns]
    for k in range(3):
        o.where(F.col("o_orderkey") % 3 == k).select(*cols).write.mode("append").option("header", "true").csv(path)
        out, _ = infer_added_files(spark, path, states, o.columns, header="true")
    return out


def q_csv_multiline(spark, d):
    """Documents as CSV with newlines inside quotes, each file read by byte ranges."""
    src = table(spark, d, "documents")
    path = scratch_path(spark, "csv-multiline")
    src.write.options(header="true", quote='"', escape='"').csv(path)
    return csvranges.read_multiline(spark, path, src.schema)


def q_publish_upsert_range(spark, d):
    """Orders in key ranges, and an upsert of about one percent of them, next to each other, with a new column."""
    path = scratch_path(spark, "publish")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    top = o.agg(F.max("o_orderkey")).first()[0]
    pub.publish(o, path, mode="overwrite", unique_ids=["o_orderkey"])
    near = o.where((F.col("o_orderkey") >= top // 2) & (F.col("o_orderkey") < top // 2 + top // 100))
    changes = near.select("o_orderkey", (F.col("o_custkey") + 1).alias("o_custkey"), F.lit("changed").alias("note"))
    fresh = near.select((F.col("o_orderkey") + top).alias("o_orderkey"), "o_custkey", F.lit("new").alias("note"))
    pub.publish(changes.unionAll(fresh), path, upsert=True, unique_ids=["o_orderkey"])
    return pub.read_dataset(spark, path)


QUERIES: dict[str, Query] = {
    "group_count": q_group_count,
    "group_all": q_group_all,
    "limit_rows": q_limit_rows,
    "multi_load": q_multi_load,
    "dataset_scan": q_dataset_scan,
    "records_missing_blank": q_records_missing_blank,
    "records_missing_null": q_records_missing_null,
    "read_widest": q_read_widest,
    "header_union": q_header_union,
    "header_widest": q_header_widest,
    "infer_types": q_infer_types,
    "merge_types": q_merge_types,
    "infer_sample": q_infer_sample,
    "infer_pattern": q_infer_pattern,
    "cast_numeric": q_cast_numeric,
    "cast_narrow": q_cast_narrow,
    "cast_decimal": q_cast_decimal,
    "cast_boolean": q_cast_boolean,
    "cast_timestamp": q_cast_timestamp,
    "cast_date": q_cast_date,
    "blank_to_null": q_blank_to_null,
    "url_encode": q_url_encode,
    "csv_lines": q_csv_lines,
    "csv_lines_java": q_csv_lines_java,
    "pages": q_pages,
    "pk_chunks": q_pk_chunks,
    "object_query": q_object_query,
    "query_all": q_query_all,
    "name_resolution": q_name_resolution,
    "bulk_read": q_bulk_read,
    "bulk_read_range": q_bulk_read_range,
    "stream_batches": q_stream_batches,
    "bulk_newlines": q_bulk_newlines,
    "bulk_infer": q_bulk_infer,
    "bulk_last": q_bulk_last,
    "bulk_guard": q_bulk_guard,
    "encoded_size": q_encoded_size,
    "size_partitions": q_size_partitions,
    "part_manifest": q_part_manifest,
    "batch_payloads": q_batch_payloads,
    "insert": q_insert,
    "update": q_update,
    "upsert": q_upsert,
    "upsert_full_outer": q_upsert_full_outer,
    "write_outcomes": q_write_outcomes,
    "publish_overwrite": q_publish_overwrite,
    "publish_append": q_publish_append,
    "publish_upsert": q_publish_upsert,
    "field_profile": q_field_profile,
    "type_map_override": q_type_map_override,
    "metadata_table": q_metadata_table,
    "scale_limit": q_scale_limit,
    "job_outcomes": q_job_outcomes,
    "csv_source": q_csv_source,
    "example_rows": q_example_rows,
    "exact_sample": q_exact_sample,
    "text_columns": q_text_columns,
    "bulk_column_order": q_bulk_column_order,
    "bulk_completed": q_bulk_completed,
    "size_repartition": q_size_repartition,
    "parts_acknowledged": q_parts_acknowledged,
    "upsert_two_keys": q_upsert_two_keys,
    "publish_upsert_two_keys": q_publish_upsert_two_keys,
    "publish_new_schema": q_publish_new_schema,
    "publish_append_wider": q_publish_append_wider,
    "publish_commits": q_publish_commits,
    "all_succeeded": q_all_succeeded,
    "not_null_fields": q_not_null_fields,
    "limit_groups": q_limit_groups,
    "page_union": q_page_union,
    "sample_replacement": q_sample_replacement,
    "cast_timestamp_lenient": q_cast_timestamp_lenient,
    "bulk_replaced": q_bulk_replaced,
    "bulk_states": q_bulk_states,
    "bulk_header_infer": q_bulk_header_infer,
    "publish_upsert_range": q_publish_upsert_range,
    "csv_multiline": q_csv_multiline,
    "key_ranges": q_key_ranges,
    "job_states": q_job_states,
    "infer_incremental": q_infer_incremental,
}
