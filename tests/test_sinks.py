import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tessera.operators.jobs import all_succeeded, job_outcomes
from tessera.operators.naming import resolve_dataset_names
from tessera.operators.profile import (check_profile, field_profile, merged_type_map, metadata_document,
                                       read_metadata, write_metadata)
from tessera.plans.publish import dataset_operation, publish, read_dataset
from tessera.session import scratch_path
from tessera.sources.bulk import length_violations, normalize_newlines, read_batches, write_batches

PARTS = "ds-parts/v7"
NATIONS = "ds-nations/v2"


def test_type_map_merge():
    base = len(merged_type_map())
    m = merged_type_map('{"date": {"dataset_type": "Text"}, "decimal": {"dataset_type": "Numeric", "precision": "12", "scale": "2"}}')
    assert len(m) == base + 1 and m["date"] == {"dataset_type": "Text"} and m["long"] == merged_type_map()["long"]
    with pytest.raises(ValueError, match="dataset_type"):
        merged_type_map({"date": {"format": "yy"}})
    with pytest.raises(ValueError, match="unknown"):
        merged_type_map({"date": {"dataset_type": "Date", "fmt": "yy"}})


def test_metadata_fields(spark):
    df = spark.read.parquet(f"{SF}/orders.parquet").withColumn("open", F.col("o_orderstatus") == "O")
    user = {"long": {"dataset_type": "Numeric", "precision": "12", "scale": "0", "defaultValue": "-1"},
            "timestamp": {"dataset_type": "Date", "format": "dd.MM.yyyy"},
            "string": {"dataset_type": "Text", "canTruncateValue": "true"}}
    prof = {r["column"]: r for r in field_profile(df, "sales", user).collect()}
    assert (prof["o_orderkey"]["precision"], prof["o_orderkey"]["default_value"]) == (12, "-1")
    assert prof["o_orderdate"]["format"] == "dd.MM.yyyy" and prof["open"]["dataset_type"] == "Text"
    assert prof["o_orderstatus"]["can_truncate"] == "true" and prof["o_totalprice"]["scale"] == 4
    doc = json.loads(metadata_document(field_profile(df, "sales", user), "sales").first()["json"])
    assert [f["fullyQualifiedName"] for f in doc["objects"][0]["fields"]] == [f"sales.{c}" for c in df.columns]
    path = scratch_path(spark, "meta-test")
    write_metadata(field_profile(df, "sales", user), "sales", path)
    assert [r["name"] for r in read_metadata(spark, path).orderBy("position").collect()] == df.columns


def test_scale_limit_and_text_needed(spark):
    df = spark.createDataFrame([(1.5, "x")], "d double, s string")
    with pytest.raises(ValueError, match="scale"):
        check_profile(field_profile(df, "ds", {"double": {"dataset_type": "Numeric", "precision": "18", "scale": "8"}}))
    with pytest.raises(ValueError, match="Text"):
        check_profile(field_profile(df.select("d"), "ds"))


def test_operation_by_mode():
    assert dataset_operation("overwrite", True) == "Upsert"
    assert dataset_operation("Overwrite") == "Overwrite"
    assert dataset_operation("append") == "Append"
    assert dataset_operation("ignore") == "Append"


def test_publish_modes(spark):
    n = spark.read.parquet(f"{SF}/nation.parquet")
    path = scratch_path(spark, "pub-test")
    publish(n, path, mode="overwrite")
    publish(n, path, mode="append")
    assert read_dataset(spark, path).count() == 50
    publish(n, path, mode="overwrite")
    assert read_dataset(spark, path).count() == 25
    with pytest.raises(ValueError, match="unique"):
        publish(n, path, upsert=True)
    changed = n.select("n_nationkey", F.lower("n_name").alias("n_name"), "n_regionkey").where("n_regionkey = 0")
    publish(changed, path, upsert=True, unique_ids=["n_nationkey"])
    back = read_dataset(spark, path)
    assert back.count() == 25 and back.where(F.col("n_name") == F.lower("n_name")).count() == changed.count()


def test_publish_epochs_belong_to_a_stream(spark):
    n = spark.read.parquet(f"{SF}/nation.parquet")
    path = scratch_path(spark, "pub-epoch")
    publish(n, path, mode="append", epoch=0, stream="a")
    publish(n, path, mode="append", epoch=0, stream="a")  # a replay
    assert read_dataset(spark, path).count() == 25
    publish(n, path, mode="append", epoch=0, stream="b")  # another stream's first epoch
    assert read_dataset(spark, path).count() == 50


def test_overwrite_and_append_with_other_columns(spark):
    n, r = (spark.read.parquet(f"{SF}/{x}.parquet") for x in ("nation", "region"))
    path = scratch_path(spark, "pub-schema")
    publish(n, path, mode="overwrite")
    publish(r, path, mode="overwrite")
    back = read_dataset(spark, path)
    assert back.columns == r.columns and back.exceptAll(r).count() == 0 and back.count() == 5
    publish(r.withColumn("note", F.lit("x")), path, mode="append")
    back = read_dataset(spark, path)
    assert back.columns == [*r.columns, "note"] and back.where("note is null").count() == 5 == back.where("note = 'x'").count()
    with pytest.raises(ValueError, match="r_regionkey"):
        publish(r.withColumn("r_regionkey", F.col("r_regionkey").cast("string")), path, mode="append")


def test_two_writers_never_share_a_version(spark, monkeypatch):
    from tessera.plans import publish as pub

    n = spark.read.parquet(f"{SF}/nation.parquet")
    path = scratch_path(spark, "pub-race")
    publish(n, path, mode="overwrite")
    claim, raced = pub._claim, []

    def late(s, p, version):
        if not raced:  # another writer commits between this one's write and its claim
            raced.append(version)
            publish(n.withColumn("n_nationkey", F.col("n_nationkey") + 100), path, mode="append")
        return claim(s, p, version)

    monkeypatch.setattr(pub, "_claim", late)
    publish(n.withColumn("n_nationkey", F.col("n_nationkey") + 200), path, mode="append")
    back = read_dataset(spark, path)
    assert back.count() == 75 and back.select("n_nationkey").distinct().count() == 75
    raced.clear()
    publish(n.where("n_nationkey = 3").withColumn("n_name", F.lit("three")), path, upsert=True, unique_ids=["n_nationkey"])
    back = read_dataset(spark, path)  # the append that came first is merged into, not lost
    assert back.count() == 100 and back.where("n_name = 'three'").count() == 1
    versions = [r["version"] for r in pub.read_manifest(spark, path).collect()]
    assert len(versions) == len(set(versions))


def test_publish_of_no_rows(spark):
    n = spark.read.parquet(f"{SF}/nation.parquet")
    path = scratch_path(spark, "pub-none")
    assert publish(n.where("false"), path, mode="overwrite").first()["rows"] == 0
    assert read_dataset(spark, path).count() == 0 and read_dataset(spark, path).columns == n.columns
    publish(n, path, mode="append")
    assert read_dataset(spark, path).count() == 25


def test_first_upsert_checks_its_keys(spark):
    twice = spark.createDataFrame([(1, 1, "a"), (1, 1, "b")], "k1 long, k2 long, v string")
    with pytest.raises(ValueError, match="repeat"):
        publish(twice, scratch_path(spark, "pub-dups"), upsert=True, unique_ids=["k1", "k2"])


def test_upsert_by_two_ids(spark):
    path = scratch_path(spark, "pub-two")
    schema = "k1 long, k2 long, v string"
    publish(spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], schema), path, upsert=True, unique_ids=["k1", "k2"])
    publish(spark.createDataFrame([(1, 2, "B")], schema), path, upsert=True, unique_ids=["k1", "k2"])
    assert sorted(map(tuple, read_dataset(spark, path).collect())) == [(1, 1, "a"), (1, 2, "B"), (2, 1, "c")]


def test_job_states(spark):
    states = ["Completed", "CompletedWithWarnings", "Failed", "InProgress", "New", "NotProcessed", "Queued", "Odd"]
    jobs = spark.createDataFrame(list(enumerate(states)), "job_id long, status string")
    wanted = spark.range(9).withColumnRenamed("id", "job_id")
    got = {r["job_id"]: (r["status"], r["outcome"]) for r in job_outcomes(jobs, wanted).collect()}
    assert got[2] == ("Failed", "failure") and got[3][1] == got[4][1] == got[6][1] == "pending"
    assert got[7] == ("Odd", "success") and got[8] == ("missing", "success") and got[5][1] == "success"
    assert all_succeeded(job_outcomes(jobs, wanted)).first()["ok"] is False


def test_name_resolution_cases(spark):
    registry = spark.createDataFrame([("Parts", PARTS), ("Nations", NATIONS)], "name string, dataset_id string")
    texts = [
        (1, 'a = load "Parts"; a = limit a 5;'),
        (2, 'a = load "Nations"; b = load "Parts"; c = union a, b;'),
        (3, 'a = load  "Parts";\nb = load "Parts";'),
        (4, 'a = load "Unknown"; a = filter a by name == "Parts"; preload "x"'),
        (5, 'a = limit b 1;'),
    ]
    q = spark.createDataFrame(texts, "query_id long, query string")
    got = {r["query_id"]: r["query"] for r in resolve_dataset_names(q, registry).collect()}
    assert got[1] == f'a = load "{PARTS}"; a = limit a 5;'
    assert got[2] == f'a = load "{NATIONS}"; b = load "{PARTS}"; c = union a, b;'
    assert got[3] == f'a = load  "{PARTS}";\nb = load "{PARTS}";'
    assert got[4] == texts[3][1] and got[5] == texts[4][1]


def test_bulk_batches(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    path = scratch_path(spark, "bulk-test")
    manifest = write_batches(docs, path, ["doc_id"], max_bytes=400_000)
    assert manifest.agg(F.sum("rows")).first()[0] == 1000
    failed = manifest.withColumn("state", F.when(F.col("batch_id") == 1, F.lit("Failed")).otherwise(F.col("state")))
    kept = read_batches(spark, path, failed, schema=docs.schema, max_chars=-1)
    skipped = manifest.where("batch_id = 1").first()["rows"]
    assert kept.count() == 1000 - skipped
    with pytest.raises(Exception):
        read_batches(spark, path, manifest, schema=docs.schema).count()  # 4096-character limit
    v = length_violations(read_batches(spark, path, manifest, schema=docs.schema, max_chars=-1), ["text"],
                          keep=["doc_id"])
    assert v.count() == docs.where(F.length("text") > 4096).count()


def test_newline_rule(spark):
    df = spark.createDataFrame([("a\r\nb\rc\nd", 1)], "s string, n int")
    assert normalize_newlines(df).first()["s"] == "a b c d"


def test_profile_digits_exponent_values(spark):
    df = spark.createDataFrame([(1.0e10, -123, 1.0e-4), (2.5, 7, 0.125), (None, None, None)],
                               "a double, b long, c double")
    prof = {r["column"]: r for r in field_profile(df, "ds").collect()}
    assert (prof["a"]["int_digits"], prof["a"]["frac_digits"], prof["a"]["null_count"]) == (11, 1, 1)
    assert (prof["b"]["int_digits"], prof["b"]["frac_digits"], prof["b"]["max_length"]) == (3, 0, 4)
    assert (prof["c"]["int_digits"], prof["c"]["frac_digits"]) == (1, 4)
    assert prof["a"]["fits"] is False and prof["c"]["fits"] is True  # 11 digits > precision 14 - scale 4
    assert prof["c"]["max_length"] == len("1.0E-4")


def test_bulk_batches_range_split(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    path = scratch_path(spark, "bulk-range")
    manifest = write_batches(docs, path, ["doc_id"], max_bytes=400_000, split="range")
    rows = manifest.agg(F.sum("rows"), F.count(F.lit(1)), F.max("bytes")).first()
    assert rows[0] == 1000 and rows[1] >= 5 and rows[2] < 400_000 + 100_000  # the longest line is shorter than that
    back = read_batches(spark, path, manifest, schema=docs.schema, max_chars=-1, newline=None)
    assert back.exceptAll(docs).count() == 0 and docs.exceptAll(back).count() == 0


def test_publish_writes_metadata(spark):
    from tessera.plans.publish import read_dataset_metadata

    n = spark.read.parquet(f"{SF}/nation.parquet")
    path = scratch_path(spark, "pub-meta")
    publish(n, path, mode="overwrite", dataset="nations")
    fields = {r["name"]: r for r in read_dataset_metadata(spark, path).collect()}
    assert set(fields) == {"n_nationkey", "n_name", "n_regionkey"}
    assert fields["n_name"]["type"] == "Text" and fields["n_nationkey"]["precision"] == 10
    # A supplied document replaces the derived one.
    other = scratch_path(spark, "meta-src")
    write_metadata(field_profile(n, "given", {"integer": {"dataset_type": "Text"}}), "given", other)
    publish(n, path, mode="append", metadata_path=other)
    assert {r["type"] for r in read_dataset_metadata(spark, path).collect()} == {"Text"}


def test_metadata_marks_unique_ids(spark):
    from tessera.plans.publish import read_dataset_metadata

    n = spark.read.parquet(f"{SF}/nation.parquet")
    path = scratch_path(spark, "pub-unique")
    publish(n, path, mode="overwrite")
    publish(n, path, upsert=True, unique_ids=["n_nationkey"])
    marks = {r["name"]: r["is_unique_id"] for r in read_dataset_metadata(spark, path).collect()}
    assert marks == {"n_nationkey": True, "n_name": False, "n_regionkey": False}


def test_bulk_round_trip_keeps_carriage_returns(spark):
    vals = ["a\rb", "x", "c\r\nd", "p,q", "\r", "e\n\rf", 'q"\r']
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i long, v string")
    for split in ("exact", "range"):
        path = scratch_path(spark, f"bulk-cr-{split}")
        manifest = write_batches(df, path, ["i"], max_bytes=20, split=split)
        back = read_batches(spark, path, manifest, schema=df.schema, newline=None)
        assert sorted((r["i"], r["v"]) for r in back.collect()) == list(enumerate(vals))
        assert manifest.agg(F.sum("rows")).first()[0] == len(vals)


def test_publish_round_trip_bags(spark):
    from tessera import catalog as C
    from tessera.operators.objects import upsert as keyed_upsert

    cu = C.table(spark, SF, "customer")
    path = scratch_path(spark, "pub-bags")
    publish(cu, path, mode="overwrite")
    back = read_dataset(spark, path)
    assert back.exceptAll(cu).count() == 0 and cu.exceptAll(back).count() == 0
    publish(cu, path, mode="append")
    both = cu.unionByName(cu)
    back = read_dataset(spark, path)
    assert back.exceptAll(both).count() == 0 and both.exceptAll(back).count() == 0
    publish(cu, path, mode="overwrite")
    changes = C.account_changes(spark, SF).join(cu.select("c_custkey", "c_nationkey", "c_mktsegment"), "c_custkey",
                                                "left").select(*cu.columns)
    publish(changes, path, upsert=True, unique_ids=["c_custkey"])
    want = keyed_upsert(cu, changes, "c_custkey", blanks="overwrite")
    back = read_dataset(spark, path)
    assert back.exceptAll(want).count() == 0 and want.exceptAll(back).count() == 0


def test_metadata_json_matches_document(spark):
    import json as _json

    from tessera.operators.profile import declared_fields, metadata_document, metadata_json

    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    user = {"double": {"dataset_type": "Numeric", "precision": "16", "scale": "2", "defaultValue": "7"}}
    a = _json.loads(metadata_json(li.schema, "li", user, ["l_orderkey"]))
    b = _json.loads(metadata_document(declared_fields(li, "li", user), "li", ["l_orderkey"]).first()["json"])
    assert a == b


def test_name_resolution_without_unique_keys(spark):
    registry = spark.createDataFrame([("Parts", PARTS)], "name string, dataset_id string")
    rows = [(1, 'a = load "Parts";'), (1, 'b = load "Other";'), (None, 'a = load "Parts";')] + \
        [(7, 'a = load "Parts"; b = load "Parts";')] * 50
    q = spark.createDataFrame(rows, "query_id long, query string")
    got = sorted(((r["query_id"], r["query"]) for r in resolve_dataset_names(q, registry).collect()), key=repr)
    want = sorted(((i, t.replace('"Parts"', f'"{PARTS}"')) for i, t in rows), key=repr)
    assert got == want


def test_batches_with_columns_in_another_order(spark):
    df = spark.createDataFrame([(1, "Kim", "Lee"), (2, "Bo", "Ito")], "i long, first string, last string")
    path = scratch_path(spark, "bulk-order")
    write_batches(df, path, ["i"])
    manifest = write_batches(df.withColumn("i", F.col("i") + 10), path, ["i"], columns=["last", "i", "first"], first_batch=50)
    back = sorted(map(tuple, read_batches(spark, path, manifest, schema=df.schema).collect()))
    assert back == [(1, "Kim", "Lee"), (2, "Bo", "Ito"), (11, "Kim", "Lee"), (12, "Bo", "Ito")]
    with pytest.raises(ValueError, match="columns"):
        read_batches(spark, path, manifest, schema=df.select("i", "first").schema)
    # Without a recorded header Spark compares the file's own and refuses.
    with pytest.raises(Exception, match="(?i)header"):
        read_batches(spark, path, manifest.withColumn("header", F.lit(None).cast("string")), schema=df.schema).collect()


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from tessera import session

    class Context:
        master = "local-cluster[2,1,1024]"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda k, d=None: d)})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())
