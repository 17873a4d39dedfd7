"""The store on disk: prefixes, filters, appends and changes in place."""

import os
import random
import re

import pytest
from data import T0, entries, entry, ids, sha
from pyspark.sql import functions as F

from mendlake.operators import store
from mendlake.plans import ingest
from mendlake.sources import entries as io
from mendlake.sources import store_files


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def filled(spark, path, numbers=range(40)):
    rows = [entry(n) for n in numbers]
    half = len(rows) // 2
    io.write_store(entries(spark, *rows[:half]), path)
    io.write_store(entries(spark, *rows[half:]), path, "append")
    return path


def files(path):
    """Name, size and time of every file with entries."""
    return {
        os.path.join(folder, name): (os.path.getsize(os.path.join(folder, name)), os.stat(os.path.join(folder, name)).st_mtime_ns)
        for folder, _, names in os.walk(path) for name in names if name.endswith(".parquet") and "_filters" not in folder
    }


def of_prefix(found, code_hash):
    return {f for f in found if f"prefix=p{code_hash[0]}{os.sep}" in f}


def test_filters_never_miss(spark, tmp_path):
    path = filled(spark, str(tmp_path / "s"), range(300))
    hashes = [(sha(f"int x{n};"),) for n in range(300)] + [(sha(f"other {n}"),) for n in range(2000)] + [(None,), ("zz",)]
    asked = spark.createDataFrame(hashes, "code_hash string")
    suspects = {r["code_hash"] for r in store_files.possible_hashes(spark, path, asked).collect()}
    assert {h for h, in hashes[:300]} <= suspects and len(suspects) < 300 + 200
    known = sorted(r[0] for r in store_files.known_hashes(spark, path, asked).collect())
    assert known == sorted(h for h, in hashes[:300])


def test_full_filters_cost_reads_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store_files, "BITS_PER_HASH", 1 / 4000)
    monkeypatch.setattr(store_files, "BITMAP_BITS", 8)  # nearly all bits are set
    path = filled(spark, str(tmp_path / "s"), range(200))
    asked = spark.createDataFrame([(sha(f"int x{n};"),) for n in range(150, 400)], "code_hash string")
    assert store_files.possible_hashes(spark, path, asked).count() > 150
    assert store_files.known_hashes(spark, path, asked).count() == 50


def test_parts_without_filters_are_read(spark, tmp_path):
    path = filled(spark, str(tmp_path / "s"))
    bare = entries(spark, entry(900)).withColumn("prefix", store_files.prefix_of(F.col("code_hash")))
    bare.write.partitionBy("prefix").parquet(f"{path}/run=by-hand/batch_id=3")
    assert ingest.append_entries(entries(spark, entry(900), entry(5), entry(901)), path) == 1
    assert ids(io.read_store(spark, path)) == [*range(40), 900, 901]


def test_a_small_lookup_reads_its_prefixes_and_shuffles_no_hashes(spark, tmp_path):
    path = filled(spark, str(tmp_path / "s"))
    suspects = io.open_store(spark, path).filter(F.col("code_hash") == sha("int x7;")).select("code_hash", "run", "batch_id")
    suspects.write.parquet(str(tmp_path / "suspects"))
    suspects = spark.read.parquet(str(tmp_path / "suspects"))
    opened = io.open_store(spark, path).filter(F.col("prefix").isin(store_files._prefixes(suspects)))
    found = store_files.stored_suspects(opened, suspects)
    text = plan(found)
    assert re.search(r"PartitionFilters: \[[^]]*prefix#\d+L? (=|IN)", text) and "BroadcastHashJoin" in text
    assert "Exchange hashpartitioning" not in text and "code_original" not in text
    assert [r[0] for r in found.collect()] == [sha("int x7;")]


def test_append(spark, tmp_path):
    path = filled(spark, str(tmp_path / "s"))
    more = entries(spark, *[entry(n) for n in range(30, 60)], entry(70, code="int x50;", minutes=5), entry(71, code="int x2;"))
    assert ingest.append_entries(more, path) == 20
    assert ingest.append_entries(more, path) == 0 == ingest.append_entries(entries(spark), path)
    assert ids(io.read_store(spark, path)) == list(range(60))


def test_update_in_place(spark, tmp_path):
    path = filled(spark, str(tmp_path / "s"))
    before, code_hash = files(path), sha("int x7;")
    update = store.as_update(spark, f"{7:024x}", {"code_fixed": "better", "labels.groups.concurrency": True})
    report = store_files.update_store(spark, path, update.union(store.as_update(spark, "absent", {"code_fixed": "x"}))).collect()
    assert [(int(r["entry_id"], 16), r["matched"], r["modified"], r["refused"]) for r in report] == [(7, True, True, [])]
    after, kept = files(path), {}
    gone = {f for f in before if f not in after}
    # Only files of one partition changed; the others' bytes and times are as they were.
    assert gone and len({os.path.dirname(f) for f in gone}) == 1 and gone <= of_prefix(before, code_hash)
    assert {f: v for f, v in before.items() if f not in gone} == {f: v for f, v in after.items() if f in before}
    kept = {int(r["entry_id"], 16): r for r in io.read_store(spark, path).collect()}
    assert sorted(kept) == list(range(40)) and kept[7]["code_fixed"] == "better" and kept[7]["labels"]["groups"]["concurrency"]
    assert kept[8]["code_fixed"] == "fixed"


def test_a_changed_hash_moves_its_entry(spark, tmp_path):
    path = filled(spark, str(tmp_path / "s"))
    old = sha("int x7;")
    new = next(h for h in map(sha, "abcdefgh") if h[0] != old[0])
    report = store_files.update_store(spark, path, store.as_update(spark, f"{7:024x}", {"code_hash": new})).collect()
    assert report[0]["modified"] and ids(io.read_store(spark, path)) == list(range(40))
    hashes = {r[0] for r in io.read_store(spark, path).select("code_hash").collect()}
    assert new in hashes and old not in hashes
    # The new hash is known to the filters, the old one is free; one that another entry has is refused.
    assert [r[0] for r in store_files.known_hashes(spark, path, spark.createDataFrame([(new,), (old,)], "code_hash string")).collect()] == [new]
    refused = store_files.update_store(spark, path, store.as_update(spark, f"{8:024x}", {"code_hash": new})).collect()
    assert refused[0]["refused"] == ["code_hash"] and ids(io.read_store(spark, path)) == list(range(40))


def test_patch_and_delete_in_place(spark, tmp_path):
    path = filled(spark, str(tmp_path / "s"))
    edits = store.as_edit(spark, f"{3:024x}", add=["memleak", "Concurrency"])
    assert ids(store_files.patch_store(spark, path, edits)) == [3]
    row = io.read_store(spark, path).filter(F.col("entry_id") == f"{3:024x}").collect()[0]
    assert list(row["labels"]["cppcheck"]) == ["memleak"] and row["labels"]["groups"]["concurrency"]
    # Also partitions that lose all their entries.
    gone = spark.createDataFrame([(f"{n:024x}",) for n in [*range(0, 40, 2), 99]], "entry_id string")
    assert ids(store_files.delete_from_store(spark, path, gone)) == list(range(0, 40, 2))
    assert ids(io.read_store(spark, path)) == list(range(1, 40, 2))
    every = io.read_store(spark, path).select("entry_id")
    store_files.delete_from_store(spark, path, spark.createDataFrame(every.collect(), "entry_id string"))
    assert io.read_store(spark, path).count() == io.open_store(spark, path).count() == 0
    assert ingest.append_entries(entries(spark, entry(1), entry(2)), path) == 2


def test_a_write_that_fails_leaves_the_store(spark, tmp_path, monkeypatch):
    path = filled(spark, str(tmp_path / "s"))
    before = files(path)

    def broken(touched, opened):
        fails = F.when(F.col("entry_id") == f"{9:024x}", F.raise_error(F.lit("lost"))).otherwise(F.col("code_original"))
        return touched.withColumn("code_original", fails), touched.select("entry_id")

    monkeypatch.setattr(store_files, "settle", lambda df, name: df)  # so that it fails while it writes in place
    ids_ = spark.createDataFrame([(f"{n:024x}",) for n in range(40)], "entry_id string")
    with pytest.raises(Exception, match="lost"):
        store_files._change(spark, path, ids_, broken)
    assert files(path) == before and ids(io.read_store(spark, path)) == list(range(40))


def test_random_changes_equal_the_snapshot_functions(spark, tmp_path):
    r = random.Random(5)
    path = filled(spark, str(tmp_path / "s"), range(60))
    snapshot = entries(spark, *[entry(n) for n in range(60)])
    for turn in range(2):
        edits = [(f"{r.randrange(70):024x}", k, r.sample(["memleak", "Concurrency", "x"], 2), r.sample(["memleak", "MemError", "y"], 1))
                 for k in range(15)]
        edits = spark.createDataFrame(edits, "entry_id string, seq bigint, add array<string>, remove array<string>")
        store_files.patch_store(spark, path, edits)
        snapshot = spark.createDataFrame(store.patch_labels(snapshot, edits).drop("matched").collect(), snapshot.schema)
    got = io.read_store(spark, path)
    assert sorted(got.collect(), key=lambda x: x["entry_id"]) == sorted(snapshot.collect(), key=lambda x: x["entry_id"])
    assert got.filter(F.col("ingest_timestamp") == F.lit(T0)).count() == 60


def test_a_change_moves_the_entries_it_names_and_no_others(spark, tmp_path, monkeypatch):
    path, seen = filled(spark, str(tmp_path / "s"), range(200)), []
    update = store.update_entries
    monkeypatch.setattr(store_files.store, "update_entries", lambda t, *a, **b: seen.append((ids(t), plan(t))) or update(t, *a, **b))
    updates = store.as_update(spark, f"{7:024x}", {"code_fixed": "better"}).union(
        store.as_update(spark, f"{150:024x}", {"code_hash": sha("moved")}))
    assert ids(store_files.update_store(spark, path, updates)) == [7, 150]
    assert seen[0][0] == [7, 150] and "Exchange hashpartitioning" not in seen[0][1]
    kept = {int(r["entry_id"], 16): r for r in io.read_store(spark, path).collect()}
    assert sorted(kept) == list(range(200)) and kept[7]["code_fixed"] == "better" and kept[150]["code_hash"] == sha("moved")
    assert all(r["code_fixed"] == "fixed" for n, r in kept.items() if n != 7)


def test_a_partition_of_many_small_files_is_dealt_anew(spark, tmp_path, monkeypatch):
    path, code_hash = str(tmp_path / "s"), sha("int x7;")
    rows = entries(spark, *[entry(n, code=f"c{n}")[:3] + (code_hash[:60] + f"{n:04x}",) + entry(n)[4:] for n in range(12)])
    io.write_store(rows.repartition(4), path, as_dealt=True)
    assert len(of_prefix(files(path), code_hash)) == 4
    edits = store.as_edit(spark, f"{3:024x}", add=["memleak"])
    store_files.patch_store(spark, path, edits)
    assert 2 <= len(of_prefix(files(path), code_hash)) <= 5 and ids(io.read_store(spark, path)) == list(range(12))
    monkeypatch.setattr(store_files, "MOST_FILES", 1)
    store_files.patch_store(spark, path, edits)
    assert len(of_prefix(files(path), code_hash)) == 1 and ids(io.read_store(spark, path)) == list(range(12))
