"""The whole way in, as batch and as stream."""

import datetime as dt

import pytest
from data import TAXONOMY, TAXONOMY_SCHEMA, entries, sha
from pyspark.sql import functions as F

from mendlake.plans import ingest
from mendlake.schema import ENTRY_SCHEMA
from mendlake.sources import entries as io
from mendlake.streaming import ingest as stream

NOW = "2024-02-01 00:00:00"


def line(issue):
    return f"t.cpp:1:1: warning: x [{issue}]"


def candidate(n, text, before, after, fixed="fixed"):
    when = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=n)
    return (
        text, fixed, "https://github.com/o/r", f"s{n:03d}", when, f"f{n}", sha(text), sha(sha(text) + sha(fixed or "")),
        None if before is None else [line(i) for i in before], None if after is None else [line(i) for i in after],
    )


ROWS = [
    candidate(1, "a", ["memleak", "zerodiv"], ["zerodiv"]),
    candidate(2, "a", ["memleak", "zerodiv"], ["zerodiv"]),          # the same pair again
    candidate(3, "a", ["memleak"], [], fixed="other"),               # the same original, fixed otherwise
    candidate(4, "b", ["zerodiv"], ["zerodiv"]),                      # nothing removed
    candidate(5, "c", ["syntaxError"], []),                           # only ignored issues
    candidate(6, "d", ["cstyleCast"], None),                          # analysis of the fixed side failed
    candidate(7, "e", [], []),
    candidate(8, "f", ["uninitvar", "newCheck"], []),
    candidate(9, "g", ["nullPointer"], []),                           # in the store already
] + [candidate(10 + n, f"t{n}", ["memleak"], []) for n in range(12)]


@pytest.fixture(scope="module")
def taxonomy(spark):
    return spark.createDataFrame(TAXONOMY, TAXONOMY_SCHEMA)


@pytest.fixture(scope="module")
def candidates(spark):
    return spark.createDataFrame(ROWS, stream.CANDIDATE_SCHEMA)


def rows(df):
    return sorted((r["code_hash"], r["repo"]["commit_hash"], tuple(r["labels"]["cppcheck"])) for r in df.collect())


WANT = sorted(
    [(sha("a"), "s001", ("memleak",)), (sha("f"), "s008", ("newCheck", "uninitvar"))]
    + [(sha(f"t{n}"), f"s{10 + n:03d}", ("memleak",)) for n in range(12)]
)


def batch(spark, candidates, taxonomy, **options):
    stored = spark.createDataFrame([(sha("g"),)], "code_hash string")
    plain = candidates.drop("before_lines", "after_lines")
    return ingest.new_entries(plain, stream.diagnostic_rows(candidates), taxonomy, stored, NOW, **options)


def test_new_entries(spark, candidates, taxonomy):
    out = batch(spark, candidates, taxonomy)
    assert rows(out) == WANT
    assert [f.dataType for f in out.schema] == [f.dataType for f in ENTRY_SCHEMA]
    row = out.filter(F.col("code_hash") == sha("a")).collect()[0]
    assert row["labels"]["groups"]["memory_management"] and not row["labels"]["groups"]["logic_error"]
    assert row["repo"]["commit_date"] == dt.datetime(2024, 1, 1, 0, 1) and str(row["ingest_timestamp"]) == NOW


def test_lenient_labels_take_failed_analyses(spark, candidates, taxonomy):
    extra = (sha("d"), "s006", ("cstyleCast",))
    assert rows(batch(spark, candidates, taxonomy, strict=False)) == sorted(WANT + [extra])


def test_target(spark, candidates, taxonomy):
    out = batch(spark, candidates, taxonomy, target=3)
    assert [r["repo"]["commit_hash"] for r in out.orderBy("repo.commit_date").collect()] == ["s001", "s008", "s010"]


def test_stage_counts(spark, candidates, taxonomy):
    stored = spark.createDataFrame([(sha("g"),)], "code_hash string")
    out = ingest.stage_counts(
        candidates.select("code_hash", "pair_id", "code_fixed"), stream.diagnostic_rows(candidates), taxonomy, stored)
    assert {r["stage"]: r["n_rows"] for r in out.collect()} == {"pushed": 21, "labelled": 17, "inserted": 14}


def test_append_counts_what_it_writes(spark, candidates, taxonomy, tmp_path):
    path = str(tmp_path / "store")
    assert ingest.append_entries(batch(spark, candidates, taxonomy), path) == len(WANT)
    again = ingest.new_entries(
        candidates.drop("before_lines", "after_lines"), stream.diagnostic_rows(candidates), taxonomy,
        io.read_store(spark, path), NOW)
    assert rows(again) == [(sha("g"), "s009", ("nullPointer",))]


def run_stream(spark, taxonomy, source, path, checkpoint, **options):
    running = stream.ingest_stream(
        stream.read_candidates(spark, source, files_per_batch=2), path, checkpoint, taxonomy, now=NOW, **options)
    return stream.finish(running)


def test_stream_equals_batch(spark, candidates, taxonomy, tmp_path):
    source, path, checkpoint = (str(tmp_path / n) for n in ("in", "store", "cp"))
    candidates.filter("base_name != 'f9'").repartitionByRange(5, "commit_date").write.parquet(source)
    run_stream(spark, taxonomy, source, path, checkpoint)
    stored = io.read_store(spark, path)
    # Which of several copies comes first depends on the batches, the hashes do not.
    assert sorted(r["code_hash"] for r in stored.collect()) == [w[0] for w in WANT]
    batches = [r[0] for r in io.open_store(spark, path).select("batch_id").distinct().collect()]
    assert len(batches) >= 2
    # More files arrive later: only what is new goes in.
    candidates.filter("base_name IN ('f9', 'f1')").write.mode("append").parquet(source)
    run_stream(spark, taxonomy, source, path, checkpoint)
    assert io.read_store(spark, path).count() == len(WANT) + 1


def test_batch_that_runs_again_stores_once(spark, candidates, taxonomy, tmp_path):
    path = str(tmp_path / "store")
    stream.insert_batch(candidates, 0, path, taxonomy, now=NOW)
    first = rows(io.read_store(spark, path))
    stream.insert_batch(candidates, 0, path, taxonomy, now=NOW)
    assert rows(io.read_store(spark, path)) == first
    stream.insert_batch(candidates, 1, path, taxonomy, now=NOW)
    assert rows(io.read_store(spark, path)) == first


def test_stream_stops_at_the_target(spark, candidates, taxonomy, tmp_path):
    source, path, checkpoint = (str(tmp_path / n) for n in ("in", "store", "cp"))
    candidates.repartition(6).write.parquet(source)
    assert run_stream(spark, taxonomy, source, path, checkpoint, target=5)
    assert io.read_store(spark, path).count() == 5
    # What it left out comes again with a larger target, also after another end.
    assert run_stream(spark, taxonomy, source, path, checkpoint, target=5)
    assert not run_stream(spark, taxonomy, source, path, checkpoint, target=100)
    assert sorted(r["code_hash"] for r in io.read_store(spark, path).collect()) == sorted({w[0] for w in WANT} | {sha("g")})


def test_target_counts_the_own_run(spark, candidates, taxonomy, tmp_path):
    source, path, checkpoint = (str(tmp_path / n) for n in ("in", "store", "cp"))
    first = batch(spark, candidates, taxonomy).limit(4)
    assert ingest.append_entries(first, path) == 4
    candidates.repartition(6).write.parquet(source)
    assert run_stream(spark, taxonomy, source, path, checkpoint, target=3)
    assert io.read_store(spark, path).count() == 7


def test_runs_and_appends_share_a_store(spark, candidates, taxonomy, tmp_path):
    one, two, path = (str(tmp_path / n) for n in ("one", "two", "store"))
    candidates.filter("base_name < 'f3'").write.parquet(one)
    candidates.filter("base_name >= 'f3'").write.parquet(two)
    known = batch(spark, candidates, taxonomy).limit(2)
    assert ingest.append_entries(known, path) == 2
    run_stream(spark, taxonomy, one, path, str(tmp_path / "cp1"))
    run_stream(spark, taxonomy, two, path, str(tmp_path / "cp2"))
    stored = [r["code_hash"] for r in io.read_store(spark, path).collect()]
    assert sorted(stored) == sorted({w[0] for w in WANT} | {sha("g")})
    assert ingest.append_entries(batch(spark, candidates, taxonomy), path) == 0
    io.compact_store(spark, path, str(tmp_path / "compact"))
    assert rows(io.read_store(spark, str(tmp_path / "compact"))) == rows(io.read_store(spark, path))


def test_pairs_without_fixed_code_have_all_issues(spark, taxonomy):
    rows = [candidate(1, "a", ["memleak", "zerodiv"], None, fixed=None), candidate(2, "b", ["memleak"], None, fixed=""),
            candidate(3, "c", ["memleak"], None), candidate(4, "d", ["syntaxError"], None, fixed=None)]
    rows = [(*r[:7], f"pair{n}", *r[8:]) for n, r in enumerate(rows)]
    df = spark.createDataFrame(rows, stream.CANDIDATE_SCHEMA)
    out = ingest.new_entries(df.drop("before_lines", "after_lines"), stream.diagnostic_rows(df), taxonomy,
                             spark.createDataFrame([], "code_hash string"), NOW)
    assert rows_of(out) == sorted([(sha("a"), ("memleak", "zerodiv")), (sha("b"), ("memleak",))])
    counts = ingest.stage_counts(df, stream.diagnostic_rows(df), taxonomy, spark.createDataFrame([], "code_hash string"))
    assert {r["stage"]: r["n_rows"] for r in counts.collect()} == {"pushed": 4, "labelled": 2, "inserted": 2}


def rows_of(df):
    return sorted((r["code_hash"], tuple(r["labels"]["cppcheck"])) for r in df.collect())


def test_a_stream_that_remembers(spark, candidates, taxonomy, tmp_path):
    source, path, checkpoint, out = (str(tmp_path / n) for n in ("in", "store", "cp", "out"))
    for turn in range(2):  # the same candidates again, by older commits and after a restart
        older = F.col("commit_date") - F.expr(f"interval {turn} years")
        candidates.withColumn("commit_date", older).repartition(2).write.mode("append").parquet(source)
        run_stream(spark, taxonomy, source, path, checkpoint, within="1 hour")
        once = stream.once_within(stream.read_candidates(spark, source, files_per_batch=1), "1 hour")
        (once.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{checkpoint}-once")
         .trigger(availableNow=True).start().awaitTermination())
    assert sorted(r["code_hash"] for r in io.read_store(spark, path).collect()) == sorted({w[0] for w in WANT} | {sha("g")})
    pairs = sorted(r["pair_id"] for r in spark.read.parquet(out).collect())
    assert pairs == sorted(r["pair_id"] for r in candidates.select("pair_id").distinct().collect())
    with pytest.raises(ValueError):
        stream.ingest_stream(stream.read_candidates(spark, source), path, checkpoint, taxonomy, target=3, within="1 hour")


def test_settings_choose_repositories_and_dates(spark, candidates):
    rules = spark.createDataFrame(
        [("https://github.com/o/a.git", dt.date(2024, 1, 1), dt.date(2024, 1, 1)), ("https://github.com/o/b", None, None), ("nowhere", None, None)],
        "url string, start_date date, end_date date").withColumn("fix_regexes", F.array().cast("array<string>"))
    row = candidates.limit(1)
    urls = [("https://github.com/o/a", "2024-01-01 23:59:59"), ("https://github.com/o/a", "2024-01-02"), ("https://github.com/o/b", "2019-12-31"),
            ("https://github.com/o/b.git", "2030-01-01"), ("https://github.com/o/c", "2024-01-01")]
    df = row.drop("repo_url", "commit_date").crossJoin(spark.createDataFrame(urls, "repo_url string, day string"))
    df = df.withColumn("commit_date", F.col("day").cast("timestamp")).drop("day")
    got = [(r["repo_url"][-5:], r["commit_date"].year) for r in stream.of_repositories(df, rules).collect()]
    assert sorted(got) == [("b.git", 2030), ("m/o/a", 2024)]


def test_rate(spark):
    start = dt.datetime(2024, 1, 1)
    seconds = [0, 1, 4.9, 5, 12]
    df = spark.createDataFrame([(start + dt.timedelta(seconds=s),) for s in seconds], "ingest_timestamp timestamp")
    got = [(r["window_start"].second, r["n_entries"], r["entries_per_second"])
           for r in stream.ingest_rate(df).orderBy("window_start").collect()]
    assert got == [(0, 3, 0.6), (5, 1, 0.2), (10, 1, 0.2)]


def test_rate_of_a_stream(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(start + dt.timedelta(seconds=s),) for s in (0, 1, 7, 600)], "ingest_timestamp timestamp")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    rates = stream.ingest_rate(
        spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), watermark="1 minute")
    query = (rates.writeStream.format("parquet").outputMode("append").option("path", str(tmp_path / "out"))
             .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    query.awaitTermination()
    got = {(r["window_start"].second, r["n_entries"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {(0, 2), (5, 1)}


def test_empty_store_schema(spark, tmp_path):
    opened = io.open_store(spark, str(tmp_path / "s"))
    assert opened.count() == 0 and opened.columns == ENTRY_SCHEMA.names + ["run", "batch_id", "prefix"]
    assert entries(spark).count() == 0


def test_a_micro_batch_writes_a_file_for_a_prefix_and_none_when_empty(spark, candidates, taxonomy, tmp_path):
    source, path, checkpoint = (str(tmp_path / n) for n in ("in", "store", "cp"))
    candidates.repartition(2).write.parquet(source)
    run_stream(spark, taxonomy, source, path, checkpoint, within="1 hour")
    files = io.open_store(spark, path).select("batch_id", "prefix", F.col("_metadata.file_name").alias("f")).distinct()
    assert {r["n"] for r in files.groupBy("batch_id", "prefix").agg(F.count("f").alias("n")).collect()} == {1}
    assert len(list((tmp_path / "store").glob("run=stream-*/batch_id=*"))) == 1  # the second batch only clears state
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
