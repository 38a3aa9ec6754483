"""Same answer whatever the input partitioning (1, 4, 13 partitions, shuffled)."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tessera import catalog as C
from tessera.operators.infer import infer_record_types
from tessera.operators.naming import resolve_dataset_names
from tessera.operators.objects import upsert
from tessera.operators.paging import assign_pages
from tessera.sources.records import discover_header

LAYOUTS = [1, 4, 13]


def bag(df):
    return sorted(tuple(r) for r in df.collect())


def layouts(df):
    for n in LAYOUTS:
        yield df.repartition(n).orderBy(F.rand(n)).repartition(n)


@pytest.mark.parametrize("mode", ["union", "widest"])
def test_header(spark, mode):
    recs = C.event_records(spark, SF)
    answers = {tuple(bag(discover_header(d, mode=mode))) for d in layouts(recs)}
    assert len(answers) == 1


def test_record_inference(spark):
    recs = C.event_records(spark, SF)
    answers = {tuple(bag(infer_record_types(d))) for d in layouts(recs)}
    assert len(answers) == 1


def test_name_resolution(spark):
    q, reg = C.saved_queries(spark, SF)
    answers = {tuple(bag(resolve_dataset_names(a, r))) for a, r in zip(layouts(q), layouts(reg))}
    assert len(answers) == 1


def test_upsert(spark):
    target = C.table(spark, SF, "customer")
    src = C.account_changes(spark, SF)
    answers = {tuple(bag(upsert(t, s, "c_custkey"))) for t, s in zip(layouts(target), layouts(src))}
    assert len(answers) == 1


def test_pages(spark):
    o = C.table(spark, SF, "orders").select("o_orderkey", "o_custkey")
    answers = {tuple(bag(assign_pages(d, ["o_custkey"], 700))) for d in layouts(o)}
    assert len(answers) == 1
