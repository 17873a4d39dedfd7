"""What is moved and read: texts once where once will do, files and folders of bounded size."""

import glob
import os
import re

from data import T0, entries, entry

from mendlake.plans import catalog
from mendlake.plans import proxies as P
from mendlake.sources import entries as io
from mendlake.sources import store_files


def test_entries_move_a_text_as_original_and_as_fix_only(spark, tmp_path):
    rows = [(n, None if n == 7 else f"text {n % 9}", f"s{n % 3}") for n in [*range(30), 4, 40]] + [(None, "none", None)]
    tables = {
        "documents": spark.createDataFrame(rows, "doc_id long, text string, source string"),
        "events": spark.createDataFrame([(n, T0) for n in (1, 2, 2, 40, None)], "event_id long, ts timestamp"),
        "labels": spark.createDataFrame([(2, 1, 0), (2, 0, 1), (5, None, 1)], "doc_id long, quality int, toxic int"),
    }
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = P.view(spark, str(tmp_path), "p_entries")
        plan = spark._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "formatted")
        moved = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", plan)
        assert sum(m.count("text#") for m in moved) == 2
        plain = P._from_sql(spark, P.VIEWS["p_entries"], lambda n: P.view(spark, str(tmp_path), n))
        assert got.dtypes == plain.dtypes and got.count() == plain.count() > len(rows)
        assert got.exceptAll(plain).count() == plain.exceptAll(got).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_the_ingest_takes_contents_by_identity(spark, monkeypatch):
    seen, contents = [], object()
    monkeypatch.setattr(P, "blob_store", lambda *a: contents, raising=False)
    monkeypatch.setattr(P, "view", lambda *a: spark.range(1))
    monkeypatch.setattr(P, "commits", lambda *a: None)
    monkeypatch.setattr(P, "rules", lambda *a: None)
    monkeypatch.setattr(catalog.extract, "candidates", lambda *a: seen.append(a[3]))
    catalog._candidates(spark, "nowhere")
    assert seen == [contents]


def test_an_append_looks_up_hashes_before_texts_and_reads_entries_once_to_write(spark, tmp_path, monkeypatch):
    path, settled, filtered = str(tmp_path / "s"), [], []
    settle, filters = store_files.settle, store_files.write_filters
    monkeypatch.setattr(store_files, "settle", lambda df, name: settled.append(df.columns) or settle(df, name))
    monkeypatch.setattr(
        store_files, "write_filters", lambda hashes, *a: filtered.append(hashes.inputFiles()) or filters(hashes, *a))
    no_hash = (*entry(50)[:3], None, *entry(50)[4:])
    rows = entries(spark, *[entry(n) for n in range(20)], entry(3, minutes=5), no_hash)
    assert store_files.append_new(rows, path) == 21 and store_files.append_new(rows, path) == 1
    assert settled and not any("code_original" in columns for columns in settled)
    assert filtered[0] and all("/run=" in f for f in filtered[0])
    assert io.read_store(spark, path).filter("code_hash IS NOT NULL").count() == 20


def test_candidate_files_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "ROWS_PER_FILE", 10)
    catalog._write_candidates(spark.range(95), str(tmp_path / "many"), 4)
    catalog._write_candidates(spark.range(30), str(tmp_path / "few"), 4)
    assert len(glob.glob(f"{tmp_path}/many/*.parquet")) == 10 and len(glob.glob(f"{tmp_path}/few/*.parquet")) == 4


def test_candidate_files_are_bounded_by_their_texts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "BYTES_PER_FILE", 1000)
    rows = spark.createDataFrame([("x" * 300, None, n) for n in range(19)] + [("ä" * 150, "", 19)], "a string, b string, n int")
    catalog._write_candidates(rows, str(tmp_path / "long"), 4)
    catalog._write_candidates(rows.limit(0), str(tmp_path / "none"), 4)
    assert len(glob.glob(f"{tmp_path}/long/*.parquet")) == 6  # of 6,000 bytes
    assert spark.read.parquet(str(tmp_path / "long")).count() == 20 and spark.read.parquet(str(tmp_path / "none")).count() == 0


def test_a_folder_of_documents_is_written_by_one_task(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "documents")
    monkeypatch.setattr(catalog, "shared_dir", lambda *a: path)
    monkeypatch.setattr(P, "entries", lambda *a: entries(spark, *[entry(n) for n in range(10)]).repartition(4))
    monkeypatch.setattr(P, "view", lambda *a: spark.createDataFrame([], "code_hash string"))
    found = {r["outcome"]: r["n_documents"] for r in catalog.import_folder_json(spark, "nowhere").collect()}
    assert found == {"inserted": 8, "duplicate": 0, "rejected": 1, "unreadable": 1}
    folders = glob.glob(f"{path}/folder=*")
    assert folders and sum(len(glob.glob(f"{f}/*.txt")) for f in folders) == 10
    for f in folders:
        assert len({os.path.basename(n).split("-")[1] for n in glob.glob(f"{f}/*.txt")}) == 1
