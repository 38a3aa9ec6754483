"""Plan shape: pushdown, pruning, no Python in the plan, one range shuffle for the rank."""

import contextlib
import io

import pytest

from tests.conftest import SF
from tessera import catalog as C

# Queries whose construction writes nothing (the others write scratch data first).
PURE = ["group_count", "dataset_scan", "header_union", "infer_types", "merge_types", "cast_numeric", "cast_decimal",
        "cast_boolean", "cast_timestamp", "blank_to_null", "url_encode", "csv_lines", "pages", "pk_chunks",
        "object_query", "name_resolution", "upsert_two_keys", "not_null_fields", "text_columns", "encoded_size", "part_manifest", "batch_payloads", "insert", "update",
        "upsert", "upsert_full_outer", "write_outcomes", "field_profile", "job_outcomes", "exact_sample"]


def plan_text(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", PURE)
def test_no_python_in_plan(spark, name):
    text = plan_text(C.QUERIES[name](spark, SF))
    assert "EvalPython" not in text and "PythonUDF" not in text and "MapInPandas" not in text


def test_object_query_pushdown_and_pruning(spark):
    text = plan_text(C.QUERIES["object_query"](spark, SF))
    assert "Or(IsNull(o_orderstatus),Not(EqualTo(o_orderstatus,F)))" in text
    assert "IsNotNull(o_orderpriority)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_orderpriority:string>" in text


def test_no_text_column_is_a_range_key(spark, monkeypatch):
    from tessera.operators import paging

    seen = []
    monkeypatch.setattr(paging, "materialize", lambda df, name: seen.append(df) or df)
    paging.place_in_ranges(C.table(spark, SF, "documents"), ["doc_id"], 4)
    text = plan_text(seen[0], "extended").split("== Physical Plan ==")[1]
    assert text.count("rangepartitioning(") == 1
    keys = text.split("rangepartitioning(")[1].split(", 4)")[0]
    assert "doc_id" in keys and not any(c in keys for c in ("text", "lang", "source"))


def test_inference_has_no_sort_aggregate(spark):
    from tessera.operators.infer import infer_record_types

    for df in (infer_record_types(C.event_records(spark, SF)), C.QUERIES["infer_types"](spark, SF)):
        assert "SortAggregate" not in plan_text(df)


def test_dataset_read_names_only_visible_folders(spark):
    from tessera.plans.publish import publish, read_dataset, read_manifest
    from tessera.session import scratch_path

    n = C.table(spark, SF, "nation")
    path = scratch_path(spark, "plan-pub")
    publish(n, path, mode="overwrite")
    publish(n, path, mode="overwrite")  # version 1 is no longer visible
    old, new = [r["data"] for r in read_manifest(spark, path).orderBy("version").collect()]
    text = plan_text(read_dataset(spark, path))
    assert new in text and old not in text


def test_bulk_read_uses_dynamic_pruning(spark):
    from tessera.session import scratch_path
    from tessera.sources.bulk import read_batches, write_batches

    docs = C.table(spark, SF, "documents")
    path = scratch_path(spark, "plan-bulk")
    manifest = write_batches(docs, path, ["doc_id"], max_bytes=500_000)
    text = plan_text(read_batches(spark, path, manifest, schema=docs.schema, max_chars=-1))
    assert "dynamicpruningexpression" in text.lower()


def test_small_change_set_upsert_does_not_shuffle_the_target(spark):
    df = C.QUERIES["upsert"](spark, SF)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in final and "SortMergeJoin" not in final
