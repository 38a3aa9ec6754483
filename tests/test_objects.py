import pytest

from tessera.operators.objects import insert, update, upsert, write_outcomes

TARGET = [(1, "a", 10), (2, "b", 20), (3, "c", 30)]
SCHEMA = "id long, name string, amount int"


def frames(spark, src_rows, src_schema="id long, name string"):
    return spark.createDataFrame(TARGET, SCHEMA), spark.createDataFrame(src_rows, src_schema)


def as_dict(df):
    return {r["id"]: r.asDict() for r in df.collect()}


def test_upsert_update_insert_keep_missing_columns(spark):
    t, s = frames(spark, [(2, "B"), (4, "D"), (3, None), (1, "")])
    got = as_dict(upsert(t, s, "id"))
    assert got[2] == {"id": 2, "name": "B", "amount": 20}
    assert got[4] == {"id": 4, "name": "D", "amount": None}
    assert got[3]["name"] == "c" and got[1]["name"] == "a"  # blanks keep the target value


def test_upsert_blanks_overwrite(spark):
    t, s = frames(spark, [(3, None), (1, "")])
    got = as_dict(upsert(t, s, "id", blanks="overwrite"))
    assert got[3]["name"] is None and got[1]["name"] == ""


def test_update_ignores_unknown_keys(spark):
    t, s = frames(spark, [(2, "B"), (9, "Z")])
    got = as_dict(update(t, s, "id"))
    assert set(got) == {1, 2, 3} and got[2]["name"] == "B"
    outcomes = {r["id"]: r["outcome"] for r in write_outcomes(t, s, "id", "update").collect()}
    assert outcomes == {2: "updated", 9: "not_found"}


def test_duplicate_keys_raise_unless_ordered(spark):
    t, s = frames(spark, [(2, "B", 1), (2, "BB", 2)], "id long, name string, v int")
    with pytest.raises(ValueError, match="repeat"):
        upsert(t, s, "id").collect()
    got = as_dict(upsert(t, s, "id", order_by="v"))
    assert got[2]["name"] == "BB"


def test_null_keys(spark):
    t, s = frames(spark, [(None, "N"), (2, "B")])
    with pytest.raises(ValueError, match="null"):
        update(t, s, "id")
    rows = upsert(t, s, "id").collect()
    assert len(rows) == 4 and any(r["id"] is None and r["name"] == "N" for r in rows)


def test_insert_union_by_name(spark):
    t, s = frames(spark, [(5, "E")])
    rows = insert(t, s).collect()
    assert len(rows) == 4 and [r for r in rows if r["id"] == 5][0]["amount"] is None


def test_new_source_column_added(spark):
    t, s = frames(spark, [(1, "A", "x")], "id long, name string, extra string")
    got = as_dict(upsert(t, s, "id"))
    assert got[1]["extra"] == "x" and got[2]["extra"] is None


def test_upsert_plans_agree(spark):
    from tests.conftest import SF
    from tessera import catalog as C

    target = C.table(spark, SF, "customer")
    src = C.account_changes(spark, SF).unionByName(
        spark.createDataFrame([(None, "nobody", 1.0)], "c_custkey long, c_name string, c_acctbal double"))
    for blanks in ("keep", "overwrite"):
        a = upsert(target, src, "c_custkey", blanks=blanks)
        b = upsert(target, src, "c_custkey", blanks=blanks, plan="full_outer")
        assert a.columns == b.columns
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("plan", ["build_source", "full_outer"])
def test_two_key_columns(spark, plan):
    target = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (None, 1, "n"), (1, None, "m")], "k1 long, k2 long, v string")
    src = spark.createDataFrame([(1, 2, "B"), (3, 1, "D"), (None, 1, "N")], "k1 long, k2 long, v string")
    got = sorted(map(tuple, upsert(target, src, ["k1", "k2"], plan=plan).collect()), key=repr)
    assert got == sorted([(1, 1, "a"), (1, 2, "B"), (2, 1, "c"), (3, 1, "D"), (None, 1, "n"), (1, None, "m"), (None, 1, "N")], key=repr)
    assert sorted(map(tuple, update(target, src.where("k1 is not null"), ["k1", "k2"]).collect()), key=repr) == sorted(
        [(1, 1, "a"), (1, 2, "B"), (2, 1, "c"), (None, 1, "n"), (1, None, "m")], key=repr)


def test_outcomes_of_repeated_keys(spark):
    t, s = frames(spark, [(2, "B"), (2, "BB"), (9, "Z"), (None, "N")])
    got = sorted((r["name"], r["outcome"]) for r in write_outcomes(t, s, "id", "upsert").collect())
    assert got == [("B", "duplicate_key"), ("BB", "duplicate_key"), ("N", "inserted"), ("Z", "inserted")]
