import datetime as dt

import pytest
from data import T0, entries, entry, ids, sha
from pyspark.sql import functions as F

from mendlake.operators import query as Q
from mendlake.schema import GROUPS


@pytest.fixture(scope="module")
def df(spark):
    return entries(
        spark,
        entry(1, cppcheck=["memleak", "x"], memory_management=True, minutes=1),
        entry(2, cppcheck=["x"], memory_management=True, code_style=True, fixed=None, minutes=2),
        entry(3, cppcheck=[], code_style=True, url="https://github.com/o/b", fixed="", minutes=3),
        entry(4, cppcheck=["y", "z"], clang='{"n":{"m":5},"t":"s"}', logic_error=True, minutes=4),
    ).cache()


def found(df, query):
    return ids(Q.find(df, query, limit=0))


CASES = [
    ({}, [1, 2, 3, 4]),
    ({"repo.url": "https://github.com/o/b"}, [3]),
    ({"labels.groups.memory_management": True}, [1, 2]),
    ({"labels.groups.memory_management": False}, [3, 4]),
    ({"labels.groups.memory_management": 1}, []),
    ({"labels.groups.code_quality_performance": True}, [2, 3]),
    ({"labels.cppcheck": "x"}, [1, 2]),
    ({"labels.cppcheck": ["x"]}, [2]),
    ({"labels.cppcheck": []}, [3]),
    ({"labels.cppcheck": {"$in": ["memleak", "z"]}}, [1, 4]),
    ({"labels.cppcheck": {"$nin": ["x"]}}, [3, 4]),
    ({"labels.cppcheck": {"$ne": "x"}}, [3, 4]),
    ({"labels.cppcheck": {"$all": ["y", "z"]}}, [4]),
    ({"labels.cppcheck": {"$size": 0}}, [3]),
    ({"labels.cppcheck": {"$gt": "x"}}, [4]),
    ({"labels.cppcheck": {"$regex": "LEAK", "$options": "i"}}, [1]),
    ({"labels.cppcheck": {"$elemMatch": {"$gte": "y", "$lt": "z"}}}, [4]),
    ({"labels.cppcheck.0": "x"}, [2]),
    ({"code_fixed": None}, [2]),
    ({"code_fixed": {"$ne": None}}, [1, 3, 4]),
    ({"code_fixed": {"$in": [None, ""]}}, [2, 3]),
    ({"code_fixed": {"$exists": True}}, [1, 2, 3, 4]),
    ({"code_fixed": {"$ne": "fixed"}}, [2, 3]),
    ({"code_fixed": {"$not": {"$regex": "^f"}}}, [2, 3]),
    ({"no.field": None}, [1, 2, 3, 4]),
    ({"no.field": "x"}, []),
    ({"no.field": {"$ne": "x"}}, [1, 2, 3, 4]),
    ({"no.field": {"$exists": True}}, []),
    ({"repo.commit_hash": {"$gt": "c2"}}, [3, 4]),
    ({"repo.commit_hash": {"$gt": 2}}, []),
    ({"ingest_timestamp": {"$gte": T0 + dt.timedelta(minutes=2), "$lt": T0 + dt.timedelta(minutes=4)}}, [2, 3]),
    ({"ingest_timestamp": {"$gte": "2000-01-01"}}, []),
    ({"labels.clang": {}}, [1, 2, 3]),
    ({"labels.clang.n.m": {"$gt": 4}}, [4]),
    ({"labels.clang.t": "s"}, [4]),
    ({"labels.clang.t": {"$exists": False}}, [1, 2, 3]),
    ({"$or": [{"labels.cppcheck": "z"}, {"code_fixed": None}]}, [2, 4]),
    ({"$nor": [{"labels.cppcheck": "z"}, {"code_fixed": "fixed"}]}, [2, 3]),
    ({"$and": [{"labels.cppcheck": "x"}, {"labels.groups.code_style": True}]}, [2]),
    ({"_id": f"{3:024x}"}, [3]),
    ({"_id": "not an id"}, []),
    ({"_id": {"$in": [f"{3:024x}", f"{4:024x}"]}}, [3, 4]),
    ({"repo": {"url": "https://github.com/o/b"}}, []),
    ({"repo": {"url": "https://github.com/o/b", "commit_hash": "c3", "commit_date": T0 - dt.timedelta(days=1)}}, [3]),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_document_filter(df, case):
    wanted, expected = CASES[case]
    assert found(df, wanted) == expected, wanted


def test_unknown_operator_is_an_error():
    with pytest.raises(ValueError):
        Q.document_filter({"code_hash": {"$near": 1}})


def test_labels_filter_is_a_conjunction(df):
    assert ids(df.filter(Q.labels_filter(["MemError"]))) == [1, 2]
    assert ids(df.filter(Q.labels_filter(["MemoryManagement", "CodeQualityPerformance"]))) == [2]
    assert ids(df.filter(Q.labels_filter(["x", "memleak"]))) == [1]
    assert ids(df.filter(Q.labels_filter(["x", "code_style"]))) == []
    assert ids(df.filter(Q.labels_filter([]))) == [1, 2, 3, 4]


def test_params_filter(df):
    assert ids(df.filter(Q.params_filter(has_memory_management="TRUE", has_code_quality_performance="n"))) == [1]
    assert ids(df.filter(Q.params_filter(has_memory_management="", repo_url=""))) == [1, 2, 3, 4]
    assert ids(df.filter(Q.params_filter(has_memory_management="perhaps", commit_hash="c4"))) == [4]
    assert ids(df.filter(Q.params_filter(code_hash=sha("int x2;")))) == [2]


def test_sort_and_limit(df):
    def page(**options):
        return [int(r["entry_id"], 16) for r in Q.find(df, **options).collect()]

    assert page(sort={"ingest_timestamp": -1}, limit=2) == [4, 3]
    assert page(sort={"code_fixed": 1}, limit=0) == [2, 3, 1, 4]
    assert page(sort={"code_fixed": -1, "repo.commit_hash": -1}, limit=-1) == [4, 1, 3, 2]
    assert page(sort={"labels.cppcheck": -1}, limit=3) == [4, 1, 2]
    assert len(page()) == 4 and page(limit=3) == [1, 2, 3]


def test_null_in_filters(spark):
    whole = entries(spark, entry(1, cppcheck=["a"]), entry(2))
    some = whole.withColumn("labels", F.when(F.col("code_hash") == sha("int x1;"), F.col("labels")))
    for path in ("labels", "labels.cppcheck", "labels.clang", "labels.groups"):
        none, other = ({path: None}, {path: {"$ne": None}})
        assert some.filter(Q.document_filter(none)).count() + some.filter(Q.document_filter(other)).count() == 2
        assert some.filter(Q.document_filter(none)).count() == some.filter("labels IS NULL").count()


def test_point_lookup(df):
    assert ids(Q.get_entry(df, f"{2:024x}")) == [2]
    assert ids(Q.get_entry(df, "zz")) == []


def test_label_text(spark):
    many = entries(spark, entry(1, **{g: True for g in GROUPS}), entry(2), entry(3, **{g: True for g in GROUPS[:5]}))
    got = {int(r["entry_id"], 16): r["labels"] for r in Q.listing(many).collect()}
    five = ", ".join(GROUPS[:5])
    assert got == {1: five + " (+8 more)", 2: "", 3: five}


def test_filters_reach_the_scan(spark, df, tmp_path):
    df.write.parquet(str(tmp_path / "store"))
    stored = spark.read.parquet(str(tmp_path / "store"))
    plan = stored.filter(
        Q.document_filter({"repo.url": "u", "labels.groups.concurrency": True, "code_hash": {"$in": ["a", "b"]}})
    ).select("entry_id")._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "EqualTo(repo.url,u)" in pushed and "labels.groups.concurrency" in pushed and "code_hash" in pushed
    read = plan[plan.index("ReadSchema"):]
    assert "code_original" not in read
