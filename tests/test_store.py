import datetime as dt
import random

from data import T0, entries, entry, ids, sha
from pyspark.sql import functions as F

from mendlake.operators import store
from mendlake.schema import EDIT_ALIASES, ENTRY_SCHEMA, GROUPS, WIRE_SCHEMA

GOOD = dict(
    code_original="int x;", code_fixed=None, code_hash=sha("int x;"),
    repo=("https://github.com/o/r", "abc", "2024-01-10T12:00:00Z"), ingest_timestamp="2024-01-15T09:30:00Z",
    labels=(["memleak"], "{}", {"memory_management": "true"}), type_errors=[],
)


def wire(spark, *changes):
    rows = [tuple({**GOOD, **c}[f] for f in WIRE_SCHEMA.names) for c in changes]
    return spark.createDataFrame(rows, WIRE_SCHEMA)


def reasons(spark, **change):
    return list(store.validate(wire(spark, change)).collect()[0]["reasons"])


def test_validation_reasons(spark):
    repo = GOOD["repo"]
    cases = [
        ({}, []),
        ({"code_hash": sha("x").upper()}, []),
        ({"code_original": ""}, []),
        ({"code_original": None}, ["code_original"]),
        ({"code_hash": sha("x")[:-1]}, ["code_hash"]),
        ({"code_hash": sha("x") + "\n"}, ["code_hash"]),
        ({"code_hash": "g" * 64}, ["code_hash"]),
        ({"code_hash": None, "ingest_timestamp": None}, ["code_hash", "ingest_timestamp"]),
        ({"repo": None}, ["repo.commit_date", "repo.commit_hash", "repo.url"]),
        ({"repo": (*repo[:2], "2024-02-30")}, ["repo.commit_date"]),
        ({"repo": (*repo[:2], "10.01.2024")}, ["repo.commit_date"]),
        ({"repo": (*repo[:2], "2024-01-10")}, []),
        ({"repo": (*repo[:2], "2024-01-10 10:00:00.123456+0200")}, []),
        ({"labels": None}, ["labels.groups"]),
        ({"labels": (None, None, {})}, []),
        ({"labels": ([None], "[1]", {"concurrency": "maybe", "other": "maybe"})},
         ["labels.clang", "labels.cppcheck", "labels.groups"]),
        ({"type_errors": ["repo.url"]}, ["repo.url"]),
    ]
    got = store.validate(wire(spark, *[c for c, _ in cases]).coalesce(1)).collect()
    assert [list(r["reasons"]) for r in got] == [want for _, want in cases]


def test_validated_values(spark):
    row = store.accepted(store.validate(wire(
        spark, {"repo": ("u", "c", "2024-01-10T12:00:00+02:00"), "labels": (None, None, {"code_style": "YES"})}
    ))).collect()[0]
    assert row["repo"]["commit_date"] == dt.datetime(2024, 1, 10, 10, 0)
    assert list(row["labels"]["cppcheck"]) == [] and row["labels"]["clang"] == "{}"
    assert [g for g in GROUPS if row["labels"]["groups"][g]] == ["code_style"]
    assert row["entry_id"] == sha("int x;")[:24]


def test_types_of_validated_entries_are_the_stored_ones(spark):
    out = store.accepted(store.validate(wire(spark, {})))
    assert [(f.name, f.dataType.simpleString()) for f in out.schema] == [
        (f.name, f.dataType.simpleString()) for f in ENTRY_SCHEMA
    ]


def test_first_and_last_per_hash(spark):
    df = entries(spark, entry(1, "a", minutes=3), entry(2, "a", minutes=1), entry(3, "a", minutes=2), entry(4, "b"))
    assert ids(store.one_per_hash(df)) == [2, 4]
    assert ids(store.one_per_hash(df, "last")) == [1, 4]
    once = store.one_per_hash(df)
    assert ids(store.one_per_hash(once)) == ids(once)


def test_insert_if_new(spark):
    stored = entries(spark, entry(9, "old"))
    batch = entries(spark, entry(1, "old"), entry(2, "new", minutes=1), entry(3, "new", minutes=2), entry(4, "other"))
    assert ids(store.insert_if_new(batch, stored)) == [2, 4]
    outcome = {r["code_hash"]: (r["inserted"], r["duplicates"]) for r in store.insert_outcomes(batch, stored).collect()}
    assert outcome == {sha("old"): (0, 1), sha("new"): (1, 1), sha("other"): (1, 0)}


def test_copies_that_fill_most_of_a_batch(spark):
    hot = spark.range(30000).select(
        F.lit(None).cast("string").alias("code_fixed"), F.lit("x").alias("code_original"),
        F.when(F.col("id") % 3 > 0, F.lit("h" * 64)).otherwise(F.sha2(F.col("id").cast("string"), 256)).alias("code_hash"),
        F.struct(F.lit("u").alias("url"), F.col("id").cast("string").alias("commit_hash"), F.lit(T0).alias("commit_date")).alias("repo"),
        F.timestamp_seconds(F.col("id")).alias("ingest_timestamp"),
    )
    nothing = spark.createDataFrame([], "code_hash string")
    out = store.insert_if_new(hot, nothing)
    assert out.count() == 10001
    assert out.filter(F.col("code_hash") == "h" * 64).first()["repo"]["commit_hash"] == "1"
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_import_outcomes(spark):
    checked = store.validate(wire(
        spark, {}, {}, {"code_hash": sha("b")}, {"code_hash": sha("c")}, {"code_hash": "bad"}, {"code_original": None},
    ).withColumn("readable", F.col("code_original").isNotNull()))
    stored = spark.createDataFrame([(sha("c"),)], "code_hash string")
    got = {r["outcome"]: (r["n_documents"], r["is_error"]) for r in store.import_outcomes(checked, stored).collect()}
    assert got == {
        "inserted": (2, False), "duplicate": (2, True), "rejected": (1, True), "unreadable": (1, True)}
    nothing = {r["outcome"]: r["n_documents"] for r in store.import_outcomes(checked.limit(0), stored).collect()}
    assert set(nothing.values()) == {0}


def test_update(spark):
    df = entries(spark, entry(1, cppcheck=["a"]), entry(2), entry(3, concurrency=True), entry(4))
    updates = spark.createDataFrame([
        (f"{1:024x}", 1, {"code_fixed": None, "labels.cppcheck": '["x","y"]', "repo.commit_date": "2020-01-01"}),
        (f"{1:024x}", 2, {"repo.url": "u"}), (f"{1:024x}", 0, {"repo.url": "early"}),
        (f"{2:024x}", 1, {"code_fixed": "fixed"}),
        (f"{3:024x}", 1, {"labels.groups.concurrency": "false", "labels.groups.code_style": "true"}),
        (f"{99:024x}", 1, {"code_fixed": "z"}),
    ], "entry_id string, seq int, fields map<string,string>")
    got = {int(r["entry_id"], 16): r for r in store.update_entries(df, updates).collect()}
    assert {n: (r["matched"], r["modified"]) for n, r in got.items()} == {
        1: (True, True), 2: (True, False), 3: (True, True), 4: (False, False)}
    assert got[1]["code_fixed"] is None and list(got[1]["labels"]["cppcheck"]) == ["x", "y"]
    assert got[1]["repo"]["url"] == "u" and got[1]["repo"]["commit_date"] == dt.datetime(2020, 1, 1)
    assert got[1]["repo"]["commit_hash"] == "c1"
    assert [g for g in GROUPS if got[3]["labels"]["groups"][g]] == ["code_style"]
    assert [r["entry_id"] for r in store.unmatched(updates, df).collect()] == [f"{99:024x}"]


def test_update_of_whole_parts_and_from_python(spark):
    df = entries(spark, entry(1, cppcheck=["a"], concurrency=True, code_style=True), entry(2))
    update = store.as_update(spark, f"{1:024x}", {
        "repo": {"url": "v", "commit_hash": "w", "commit_date": "2021-01-01T00:00:00Z"},
        "labels": {"cppcheck": ["n"], "groups": {"code_style": True}}, "labels.clang": {"k": 1}, "code_fixed": None,
    })
    later = store.as_update(spark, f"{1:024x}", {
        "labels.groups": {"logic_error": True}, "ingest_timestamp": T0 + dt.timedelta(hours=1)}, seq=5)
    got = store.update_entries(df, update.union(later)).filter("matched").collect()[0]
    assert (got["repo"]["url"], got["repo"]["commit_hash"], got["repo"]["commit_date"]) == ("v", "w", dt.datetime(2021, 1, 1))
    assert list(got["labels"]["cppcheck"]) == ["n"] and got["code_fixed"] is None
    assert [g for g in GROUPS if got["labels"]["groups"][g]] == ["logic_error"]
    assert got["ingest_timestamp"] == T0 + dt.timedelta(hours=1)


def test_bad_updates_are_refused(spark):
    df = entries(spark, *(entry(n, f"int x{n};") for n in range(1, 12)))
    bad = {
        1: {"nothing.here": "1", "code_fixed": "never"}, 2: {"labels.groups.concurrency": "banana"},
        3: {"repo.commit_date": "yesterday"}, 4: {"labels.cppcheck": "[1"}, 5: {"code_hash": "zz"},
        6: {"code_original": None}, 7: {"code_hash": sha("int x8;")}, 9: {"code_hash": sha("new")},
        10: {"code_hash": sha("new")}, 11: {"code_hash": sha("own")},
    }
    updates = spark.createDataFrame(
        [(f"{n:024x}", 1, f) for n, f in bad.items()], "entry_id string, seq int, fields map<string,string>")
    before = {r["entry_id"]: r for r in df.collect()}
    for r in store.update_entries(df, updates).collect():
        n = int(r["entry_id"], 16)
        assert r["matched"] == (n in bad) and r["modified"] == (n == 11)
        assert list(r["refused"]) == ([] if n in (8, 11) else [next(iter(bad[n]))])
        if n != 11:
            assert all(r[c] == before[r["entry_id"]][c] for c in df.columns)


def test_edit_from_python(spark):
    import pytest

    df = entries(spark, entry(1, memory_management=True), entry(2))
    edit = store.as_edit(spark, f"{1:024x}", ["LogicError", "own"], ["MemError"])
    row = store.patch_labels(df, edit).filter("matched").collect()[0]
    assert [g for g in GROUPS if row["labels"]["groups"][g]] == ["logic_error"]
    assert list(row["labels"]["cppcheck"]) == ["own"]
    with pytest.raises(ValueError):
        store.as_edit(spark, f"{1:024x}")


def test_delete(spark):
    df = entries(spark, entry(1), entry(2))
    gone = spark.createDataFrame([(f"{2:024x}",), (f"{2:024x}",), (f"{5:024x}",)], "entry_id string")
    assert ids(store.delete_entries(df, gone)) == [1]
    assert ids(store.deleted_entries(df, gone)) == [2]


def apply_one_by_one(cppcheck, flags, edits):
    """What edits do when applied in turn."""
    cppcheck, flags = list(cppcheck), dict(flags)
    for _, add, remove in sorted(edits):
        for x in add:
            if x in EDIT_ALIASES:
                flags[EDIT_ALIASES[x]] = True
        for x in remove:
            if x in EDIT_ALIASES:
                flags[EDIT_ALIASES[x]] = False
        for x in add:
            if x not in EDIT_ALIASES and x not in cppcheck:
                cppcheck.append(x)
        cppcheck = [x for x in cppcheck if x in EDIT_ALIASES or x not in remove]
    return cppcheck, flags


def test_patches_equal_edits_applied_in_turn(spark):
    rng = random.Random(3)
    labels = ["a", "b", "c", "d", "CodeQualityPerformance", "MemError", "memory_management", "LogicError", "code_style"]
    rows, edits = [], {}
    for n in range(60):
        old = [rng.choice("abcx") for _ in range(rng.randrange(0, 4))]
        rows.append(entry(n, cppcheck=old, memory_management=n % 2, code_style=n % 3))
        edits[n] = [
            (seq, rng.choices(labels, k=rng.randrange(0, 4)), rng.choices(labels, k=rng.randrange(0, 3)))
            for seq in range(rng.randrange(0, 6))
        ]
    frame = spark.createDataFrame(
        [(f"{n:024x}", *e) for n, es in edits.items() for e in es] + [(f"{999:024x}", 0, ["a"], [])],
        "entry_id string, seq int, add array<string>, remove array<string>",
    )
    got = {int(r["entry_id"], 16): r for r in store.patch_labels(entries(spark, *rows), frame).collect()}
    for n, row in enumerate(rows):
        cppcheck, flags = apply_one_by_one(row[-1][0], dict(zip(GROUPS, row[-1][2])), edits[n])
        assert list(got[n]["labels"]["cppcheck"]) == cppcheck, (n, row[-1][0], edits[n])
        assert got[n]["labels"]["groups"].asDict() == flags
        if any(a or r for _, a, r in edits[n]):
            assert got[n]["matched"]
    assert len(got) == 60


def test_target(spark):
    df = entries(spark, entry(1, minutes=5), entry(2, minutes=1), entry(3, minutes=3))
    assert ids(store.first_entries(df, 2)) == [2, 3]


def test_defaults(spark):
    df = entries(spark, entry(1)).withColumn("labels", F.lit(None).cast(ENTRY_SCHEMA["labels"].dataType))
    row = store.with_defaults(df).collect()[0]["labels"]
    assert list(row["cppcheck"]) == [] and row["clang"] == "{}" and not any(row["groups"])
