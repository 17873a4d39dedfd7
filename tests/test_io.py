import json

import pytest
from data import TAXONOMY, entries, entry, ids, sha
from pyspark.sql import functions as F

from mendlake.operators import report, store
from mendlake.schema import COARSE_GROUPS, GROUPS
from mendlake.sources import config
from mendlake.sources import entries as io

CODE = [
    'printf("%d\\n", x);\r\n\tint y; ', "  lead and trail\t\n", 'quote " and ""', "é ü 漢   x", "a,b;c\n\n\n",
    "back\\slash \\n \\\"", "#define X \\\n  1", "null", " ", "'single'", "{json: 1}",
]


@pytest.fixture(scope="module")
def df(spark):
    rows = [
        entry(n, c, fixed=None if n % 3 == 0 else c + "//", cppcheck=["a", 'q"x'][: n % 3], clang='{"k":{"v":[1,"é"]}}',
              memory_management=n % 2, code_style=n % 3 == 1, minutes=n)
        for n, c in enumerate(CODE)
    ]
    return entries(spark, *rows).withColumn("entry_id", F.substring("code_hash", 1, 24)).cache()


def rows(frame):
    return sorted(json.dumps(r.asDict(recursive=True), default=str, sort_keys=True) for r in frame.collect())


def back(wire):
    return store.accepted(store.validate(wire)).drop("readable", "file_name")


def test_csv_round_trip(spark, df, tmp_path):
    io.write_csv(df, str(tmp_path / "csv"))
    got = back(io.read_csv(spark, str(tmp_path / "csv")))
    assert rows(got) == rows(df)


def test_csv_with_the_coarse_flags_only(spark, df, tmp_path):
    io.write_csv(df, str(tmp_path / "csv"), scheme="reference8")
    flat = spark.read.options(**io.CSV_READ).csv(str(tmp_path / "csv"))
    assert flat.columns == list(io.FLAT_FIELDS) + [f"labels_{g}" for g in COARSE_GROUPS]
    got = {r["code_hash"]: r["labels"]["groups"] for r in back(io.read_csv(spark, str(tmp_path / "csv"))).collect()}
    want = {r["code_hash"]: r["labels"]["groups"] for r in df.collect()}
    assert all(got[h]["memory_management"] == want[h]["memory_management"] and not got[h]["code_style"] for h in want)
    assert {r["labels_code_quality_performance"] for r in flat.collect()} == {"True", "False"}


def test_flat_text_forms(df):
    row = io.flatten_entries(df).filter(F.col("code_hash") == sha(CODE[1])).collect()[0]
    assert row["labels_cppcheck"] == '["a"]' and row["labels_clang"] == '{"k":{"v":[1,"é"]}}'
    assert (row["labels_memory_management"], row["labels_concurrency"]) == ("True", "False")
    assert len(row) == 10 + len(GROUPS) + 1


def test_csv_first_row_of_each_file(spark, df, tmp_path):
    one = df.coalesce(1).sortWithinPartitions("ingest_timestamp")
    for part in ("a", "b"):
        io.write_csv(one, str(tmp_path / "csv" / part))
    got = io.read_csv(spark, str(tmp_path / "csv" / "*"), first_row_only=True)
    assert [r["code_hash"] for r in got.collect()] == [sha(CODE[0])] * 2
    assert io.read_csv(spark, str(tmp_path / "csv" / "*")).count() == 2 * len(CODE)


def test_unflatten_refuses_broken_json(spark):
    flat = spark.createDataFrame(
        [("int x;", sha("int x;"), "u", "c", "2024-01-01", "2024-01-01", "not json", "{}", "tRuE")],
        "code_original string, code_hash string, repo_url string, repo_commit_hash string, repo_commit_date string, "
        "ingest_timestamp string, labels_cppcheck string, labels_clang string, labels_concurrency string",
    )
    row = store.validate(io.unflatten_rows(flat)).collect()[0]
    assert list(row["reasons"]) == ["labels.cppcheck"]
    assert row["labels"]["groups"]["concurrency"] and not row["labels"]["groups"]["code_style"]


def test_json_lines_round_trip_in_order(spark, df, tmp_path):
    io.write_json_lines(df, str(tmp_path / "out"))
    texts = spark.read.text(str(tmp_path / "out"))
    documents = [json.loads(r["value"]) for r in texts.collect()]
    assert all("code_fixed" in d and d["labels"]["clang"] == {"k": {"v": [1, "é"]}} for d in documents)
    assert sorted(d["_id"] for d in documents) == sorted(r["entry_id"] for r in df.collect())
    order = io.export_order(df).collect()
    assert [r["ingest_timestamp"] for r in order] == sorted(r["ingest_timestamp"] for r in order)
    assert rows(back(io.read_json_lines(spark, str(tmp_path / "out")))) == rows(df)


def test_one_document_per_file(spark, df, tmp_path):
    io.write_json_documents(df.coalesce(2), str(tmp_path / "out"), one_per_file=True)
    files = list((tmp_path / "out").glob("*.json"))
    assert len(files) == len(CODE)
    assert json.loads(files[0].read_text())["file_name"] in {r["entry_id"] for r in df.collect()}
    assert rows(back(io.read_json_documents(spark, str(tmp_path / "out")))) == rows(df)


def test_readable_documents(df):
    row = io.readable_documents(df).filter(F.col("code_hash") == sha(CODE[4])).collect()[0]
    assert list(row["code_original"]) == CODE[4].splitlines()
    assert row["file_name"] == sha(CODE[4]) + ".json"


def test_json_documents_of_all_kinds(spark, tmp_path):
    good = {
        "_id": "zzz", "code_original": ["int x;", "int y;"], "code_hash": sha("a"), "extra": 1,
        "repo": {"url": "u", "commit_hash": "c", "commit_date": "2024-01-10T12:00:00Z"},
        "ingest_timestamp": "2024-01-15T09:30:00Z",
        "labels": {"cppcheck": ["m"], "clang": {"a": 1}, "groups": {"memory_management": True, "other": 3}},
    }
    documents = {
        "good": json.dumps(good, indent=4),
        "number": json.dumps({**good, "code_original": 5}),
        "null_fixed": json.dumps({**good, "code_fixed": None, "code_hash": sha("b")}),
        "map_issues": json.dumps({**good, "labels": {**good["labels"], "cppcheck": {"m": 2}}}),
        "bad_flag": json.dumps({**good, "labels": {**good["labels"], "groups": {"concurrency": "perhaps"}}}),
        "no_groups": json.dumps({**good, "labels": {"cppcheck": []}}),
        "list": "[1, 2]",
        "broken": '{"code_original": ',
    }
    for name, text in documents.items():
        (tmp_path / f"{name}.json").write_text(text)
    (tmp_path / "notes.txt").write_text("no document")
    wire = io.read_json_documents(spark, str(tmp_path))
    checked = {r["file_name"][:-5]: r for r in store.validate(wire).collect()}
    assert set(checked) == set(documents)
    assert {n for n, r in checked.items() if not r["readable"]} == {"broken"}
    got = {n: list(r["reasons"]) for n, r in checked.items() if r["readable"] and n != "list"}
    assert got == {
        "good": [], "null_fixed": [], "number": ["code_original"], "map_issues": ["labels.cppcheck"],
        "bad_flag": ["labels.groups"], "no_groups": ["labels.groups"],
    }
    assert len(checked["list"]["reasons"]) > 3
    row = checked["good"]
    assert row["code_original"] == "int x;\nint y;" and row["code_fixed"] is None
    assert row["labels"]["clang"] == '{"a":1}' and row["labels"]["groups"]["memory_management"]


def test_report_of_documents_in_old_and_new_form(spark):
    documents = [
        {"labels": {"cppcheck": ["a", "b"], "groups": {"memory_management": True, "code_style": True}}},
        {"labels": {"cppcheck": {"a": 2, "c": 1}, "groups": {"memory_management": 1, "correctness": 1}}},
        {"labels": {}}, {"code_original": "x"}, {"labels": {"groups": {}}},
    ]
    texts = spark.createDataFrame([(json.dumps(d),) for d in documents], "value string")
    seen = io.report_documents(texts)
    counts = {r["issue_id"]: r["n_issues"] for r in report.legacy_issue_counts(seen).collect()}
    assert counts == {"a": 3, "b": 1, "c": 1}
    totals = report.label_totals(seen, report.issue_map(F.col("cppcheck_json"))).collect()[0]
    assert list(totals) == [5, 3, 2, 5, 3]
    share = {r["group_name"]: (r["n_entries"], round(r["percent"], 2)) for r in report.group_share(seen).collect()}
    assert share["memory_management"] == (2, 66.67) and share["code_quality_performance"] == (1, 33.33)
    assert share["concurrency"] == (0, 0.0)


def test_report_without_labels(spark):
    nothing = entries(spark, entry(1)).filter("entry_id = ''")
    assert {r["percent"] for r in report.group_share(nothing).collect()} == {0.0}
    assert list(report.label_totals(nothing).collect()[0]) == [0, 0, 0, 0, 0]


def test_top_issues_break_ties_by_name(spark):
    df = entries(spark, *[entry(n, cppcheck=[f"i{k:02d}" for k in range(n + 1)]) for n in range(12)])
    top = report.top_issues(report.issue_counts(df)).collect()
    assert [(r["issue_id"], r["n_issues"]) for r in top] == [(f"i{k:02d}", 12 - k) for k in range(10)]


def test_store_round_trip(spark, df, tmp_path):
    io.write_store(df, str(tmp_path / "store"))
    assert rows(io.read_store(spark, str(tmp_path / "store"))) == rows(df)
    assert len(set(ids(df))) == len(CODE)


def rules(spark, tmp_path, document):
    path = tmp_path / "config.json"
    path.write_text(document if isinstance(document, str) else json.dumps(document))
    return {r["url"]: r for r in config.load_rules(spark, str(path)).collect()}


def test_rules(spark, tmp_path):
    got = rules(spark, tmp_path, {
        "fix_regexes": ["common"],
        "repositories": [
            "https://github.com/a/a",
            {"url": "https://github.com/b/b", "start_date": "2024-1-2", "end_date": "2024-02-30", "fix_regexes": ["own", "two"]},
            {"url": "https://github.com/c/c", "start_date": "", "end_date": "2024-03-04", "fix_regexes": None},
            {"url": "https://github.com/d/d", "fix_regexes": []},
            {"name": "without url"}, 7, None, ["x"],
        ],
    })
    assert {u[-1]: (str(r["start_date"]), str(r["end_date"]), list(r["fix_regexes"])) for u, r in got.items()} == {
        "a": ("None", "None", ["common"]),
        "b": ("2024-01-02", "None", ["own", "two"]),
        "c": ("None", "2024-03-04", []),
        "d": ("None", "None", []),
    }


def test_rules_with_defaults(spark, tmp_path):
    got = rules(spark, tmp_path, {"repositories": ["https://github.com/a/a"]})
    assert list(got["https://github.com/a/a"]["fix_regexes"]) == list(config.DEFAULT_FIX_REGEXES)
    assert rules(spark, tmp_path, {"repositories": {"url": "u"}}) == {}
    assert rules(spark, tmp_path, {}) == {}
    assert rules(spark, tmp_path, "{broken") == {}
    settings = config.load_settings(spark, str(tmp_path / "config.json")).collect()[0]
    assert tuple(settings) == (config.DEFAULT_TARGET, config.DEFAULT_QUEUE)


def test_taxonomy(spark, tmp_path):
    classified = {}
    for issue, category, ignored in TAXONOMY:
        if not ignored:
            classified.setdefault(category, []).append(issue)
    classified["later"] = ["memleak"]
    path = tmp_path / "labels.json"
    path.write_text(json.dumps({"comment": "x", "error_classification": classified, "ignore_list": ["syntaxError", "idx", "zerodiv"]}, indent=2))
    got = {r["issue_id"]: (r["category"], r["ignored"]) for r in config.load_taxonomy(spark, str(path)).collect()}
    want = {i: (c, g) for i, c, g in TAXONOMY}
    want.update({"memleak": ("later", False), "zerodiv": ("logic_error", True)})
    assert got == want


def test_csv_columns_by_each_files_header(spark, df, tmp_path):
    flat = io.flatten_entries(df)
    turned = flat.select(*reversed(flat.columns))
    fewer = flat.drop("labels_code_style", "code_fixed")
    for n, part in enumerate((flat, turned, fewer)):
        part.coalesce(1).write.options(**io.CSV_WRITE).csv(str(tmp_path / "csv" / str(n)))
    (tmp_path / "csv" / "3").mkdir()
    (tmp_path / "csv" / "3" / "empty.csv").write_text("")
    got = back(io.read_csv(spark, str(tmp_path / "csv" / "*")))
    missing = df.withColumn("code_fixed", F.lit(None).cast("string")).withColumn("labels", F.col("labels").withField(
        "groups", F.col("labels.groups").withField("code_style", F.lit(False))))
    assert rows(got) == sorted(rows(df) * 2 + rows(missing))
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "empty.csv").write_text("")
    assert io.read_csv(spark, str(tmp_path / "none")).count() == 0


def test_items_of_lists_are_texts(spark):
    good = {"code_original": ["a", "b"], "code_hash": sha("a"), "repo": {"url": "u", "commit_hash": "c", "commit_date": "2024-01-01"},
            "ingest_timestamp": "2024-01-01", "labels": {"cppcheck": [], "groups": {}}}
    docs = [good, {**good, "labels": {"cppcheck": [1, 2], "groups": {}}}, {**good, "code_original": ["a", 1]}]
    texts = spark.createDataFrame([(json.dumps(d),) for d in docs], "value string")
    got = [list(r["reasons"]) for r in store.validate(io.wire_from_json(texts)).collect()]
    assert got == [[], ["labels.cppcheck"], ["code_original"]]


def test_report_counts_the_own_coarse_flag(spark):
    from mendlake.operators import report

    docs = [{"labels": {"groups": {"code_quality_performance": True}}}, {"labels": {"groups": {"code_style": 1}}},
            {"labels": {"groups": {"concurrency": True}}}]
    texts = spark.createDataFrame([(json.dumps(d),) for d in docs], "value string")
    shares = {r["group_name"]: r["n_entries"] for r in report.group_share(io.report_documents(texts)).collect()}
    assert shares["code_quality_performance"] == 2 and shares["concurrency"] == 1


def test_readable_documents_are_written(spark, df, tmp_path):
    twice = df.union(df.withColumn("repo", F.col("repo").withField("commit_hash", F.lit("zzz"))))
    io.write_readable_json(twice, str(tmp_path / "out"))
    got = spark.read.json(str(tmp_path / "out"))
    assert got.count() == df.count() and {r["repo"]["commit_hash"] for r in got.collect()} == {"zzz"}
    assert "array" in dict(got.dtypes)["code_original"]


def test_csv_header_with_line_breaks_in_its_names(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"repo\nurl","code\n""x""",code_hash\n"u\nv",2,3\n')
    (tmp_path / "b.csv").write_text("code_hash,repo_url\n7,8\n")
    (tmp_path / "c.csv").write_text("")
    (tmp_path / "d.csv").write_text('"never closed\n1,2\n')
    found = {tuple(names): [f.rsplit("/", 1)[1] for f in files] for names, files in io.csv_headers(spark, str(tmp_path))}
    assert found[("repo\nurl", 'code\n"x"', "code_hash")] == ["a.csv"] and found[("code_hash", "repo_url")] == ["b.csv"] and len(found) == 3
    (tmp_path / "d.csv").unlink()
    assert sorted(r["code_hash"] for r in io.read_csv(spark, str(tmp_path)).collect()) == ["3", "7"]


def test_a_file_for_each_text_is_as_spark_writes_it(spark, tmp_path):
    texts = ["one", "", None, "zwei\nä", "long " * 1000, "one"]
    df = spark.createDataFrame([(t, n % 3) for n, t in enumerate(texts)], "value string, folder int")

    def found(path):
        return sorted((f.parent.name, f.read_bytes()) for f in path.glob("folder=*/*.txt"))

    io.write_text_files(df.repartition(3), f"file://{tmp_path}/own")
    df.repartition("folder").write.partitionBy("folder").option("maxRecordsPerFile", 1).text(str(tmp_path / "spark"))
    assert found(tmp_path / "own") == found(tmp_path / "spark") and len(found(tmp_path / "own")) == 6
    # Not through Hadoop's local file system, which starts processes for every file; nothing else is left.
    assert sorted(p.name for p in (tmp_path / "own").iterdir()) == ["folder=0", "folder=1", "folder=2"]
    assert not list((tmp_path / "own").glob("folder=*/.*"))
    with pytest.raises(FileExistsError):
        io.write_text_files(df, str(tmp_path / "own"))
    io.write_text_files(df.limit(0), str(tmp_path / "none"))
    assert list((tmp_path / "none").iterdir()) == []


def test_documents_are_read_as_bytes_and_as_the_text_reader_does(spark, tmp_path):
    texts = [b'{"code_hash": "a"}\n', b"", b"\xff\xfe broken", "﻿{}".encode(), b'{"code_hash": "\xc3\xa4"}', b"{\r\n}"]
    for n, text in enumerate(texts):
        (tmp_path / f"d{n} ä.json").write_bytes(text)
    (tmp_path / "other.xml").write_bytes(b"{}")
    got = io.read_json_documents(spark, str(tmp_path))
    assert "content:binary" in got._jdf.queryExecution().executedPlan().toString()
    plain = spark.read.text(str(tmp_path), wholetext=True, pathGlobFilter="*.json").select(
        "value", F.col("_metadata.file_name").alias("file_name"))
    assert rows(got) == rows(io.wire_from_json(plain)) and got.count() == 5  # a file without a byte gives no row
    (tmp_path / "z").mkdir()
    (tmp_path / "z" / "d.json.gz").write_bytes(__import__("gzip").compress(texts[0]))
    assert [r["code_hash"] for r in io.read_json_documents(spark, str(tmp_path / "z"), "*.gz").collect()] == ["a"]
