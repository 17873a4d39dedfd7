from data import TAXONOMY, TAXONOMY_SCHEMA
from pyspark.sql import functions as F

from mendlake.functions.diagnostics import clang_issue, cppcheck_id
from mendlake.operators import label
from mendlake.schema import COARSE_GROUPS, GROUPS


def test_cppcheck_ids(evaluate):
    cases = {
        "/t.cpp:1:2: error: bad [memleak]": "memleak",
        "    a[i] = b[j]; [later]": "i",
        "no bracket": None,
        "[not-a-word] then [word]": "word",
        "x [missingInclude]": None,
        "x [checkersReport] [memleak]": None,
        "[größe]": "größe",
        "": None,
    }
    assert evaluate(cppcheck_id, list(cases)) == list(cases.values())


def test_clang_issues(evaluate):
    cases = {
        "a.cpp:1:2: warning: use [x] of it  [bugprone-y]": ("bugprone-y", "warning: use [x] of it"),
        "a.cpp:1:2: error: bad [diag] tail ] end": ("diag] tail ", "error: bad"),
        "a.cpp:1:2: fatal error: 'x.h' file not found [clang-diagnostic-error]": None,
        "fatal error: no such file [a]": None,
        "'#include' file not found: warning: x [y]": None,
        "a.cpp: warning: plain  ": ("generic-warning", "plain"),
        "a.cpp: error: plain": None,
        "note: [x]": None,
        "warning: one warning: two": ("generic-warning", "one"),
        "[a] warning: after": ("a", ""),
        "warning: odd ] before [": ("", "warning: odd ] before"),
        "error: first warning: second [id]": ("id", "warning: second"),
    }
    got = [tuple(v) if v else None for v in evaluate(clang_issue, list(cases))]
    assert got == list(cases.values())


def diagnostics(spark, *rows):
    return spark.createDataFrame(list(rows), "pair_id string, side string, status string, line string")


def found(issue):
    return f"t.cpp:1:1: warning: x [{issue}]"


def run(spark, rows, **options):
    taxonomy = spark.createDataFrame(TAXONOMY, TAXONOMY_SCHEMA)
    out = label.label_pairs(diagnostics(spark, *rows), taxonomy, **options)
    return {r["pair_id"]: r["labels"] for r in out.collect()}


ROWS = [
    ("a", "before", "ok", found("memleak")), ("a", "before", "ok", found("memleak")),
    ("a", "before", "ok", found("zerodiv")), ("a", "before", "ok", found("syntaxError")),
    ("a", "before", "ok", found("newCheck")), ("a", "after", "ok", found("zerodiv")),
    # no findings before
    ("b", "before", "ok", None), ("b", "after", "ok", found("memleak")),
    # analysis of the fixed side failed
    ("c", "before", "ok", found("cstyleCast")), ("c", "after", "timeout", None),
    # analysis of the original failed
    ("d", "before", "failed", found("memleak")), ("d", "after", "ok", None),
    # never analysed before
    ("e", "after", "ok", found("memleak")),
]


def test_fixed_issues_strict(spark):
    got = run(spark, ROWS)
    assert {k: list(v["cppcheck"]) for k, v in got.items()} == {"a": ["memleak", "newCheck"], "b": []}
    flags = got["a"]["groups"].asDict()
    assert [g for g in GROUPS if flags[g]] == ["memory_management"]
    assert got["a"]["clang"] == "{}"


def test_a_side_never_analysed_is_not_clean(spark):
    rows = [("a", "before", "ok", found("memleak")), ("b", "before", "ok", found("memleak")), ("b", "after", "ok", None)]
    assert set(run(spark, rows)) == {"b"}
    assert {k: list(v["cppcheck"]) for k, v in run(spark, rows, strict=False).items()} == {"a": ["memleak"], "b": ["memleak"]}
    fixed = spark.createDataFrame([("b",)], "pair_id string")
    assert set(run(spark, rows, fixed=fixed)) == {"a", "b"}


def test_fixed_issues_lenient(spark):
    got = run(spark, ROWS, strict=False)
    assert {k: list(v["cppcheck"]) for k, v in got.items()} == {
        "a": ["memleak", "newCheck"], "b": [], "c": ["cstyleCast"], "d": [],
    }


def test_without_fixed_code_all_issues_count(spark):
    fixed = spark.createDataFrame([("b",), ("c",)], "pair_id string")
    got = run(spark, ROWS, fixed=fixed)
    assert list(got["a"]["cppcheck"]) == ["memleak", "newCheck", "zerodiv"]


def test_schemes(spark):
    rows = [("a", "before", "ok", found("cstyleCast")), ("a", "before", "ok", found("nullPointer")), ("a", "after", "ok", None)]
    on = {
        scheme: {g for g, v in run(spark, rows, scheme=scheme)["a"]["groups"].asDict().items() if v}
        for scheme in ("fine13", "coarse8", "reference8")
    }
    assert on == {
        "fine13": {"invalid_access", "code_style"},
        "coarse8": {"invalid_access", "code_quality_performance"},
        "reference8": {"invalid_access"},
    }
    assert list(run(spark, rows, scheme="reference8")["a"]["groups"].asDict()) == list(COARSE_GROUPS)


def test_unique_issues_and_lines(spark):
    outputs = spark.createDataFrame(
        [("a", "before", found("b") + "\n" + found("a") + "\n" + found("b") + "\n" + found("unknown")), ("a", "after", "")],
        "pair_id string, side string, output string",
    )
    lines = label.output_lines(outputs)
    assert lines.count() == 5
    got = {r["side"]: list(r["issues"]) for r in label.issue_ids(lines).collect()}
    assert got == {"before": ["a", "b"], "after": []}


def test_filter_issues(spark):
    taxonomy = spark.createDataFrame(TAXONOMY, TAXONOMY_SCHEMA)
    issues = spark.createDataFrame([("memleak",), ("idx",), ("other",)], "issue_id string")
    assert sorted(r[0] for r in label.filter_issues(issues, taxonomy).collect()) == ["memleak", "other"]


def test_one_pair_with_most_lines(spark):
    """A hot pair arrives reduced at its group."""
    hot = spark.range(20000).select(
        F.lit("hot").alias("pair_id"), F.lit("before").alias("side"), F.lit("ok").alias("status"),
        F.concat(F.lit("x ["), F.element_at(F.array(F.lit("memleak"), F.lit("zerodiv")), (F.col("id") % 2 + 1).cast("int")), F.lit("]")).alias("line"),
    )
    taxonomy = spark.createDataFrame(TAXONOMY, TAXONOMY_SCHEMA)
    got = label.label_pairs(hot.union(diagnostics(spark, ("hot", "after", "ok", None))), taxonomy).collect()
    assert [list(r["labels"]["cppcheck"]) for r in got] == [["memleak", "zerodiv"]]
