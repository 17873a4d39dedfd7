import datetime as dt
import os.path
import random
import re

from data import sha
from pyspark.sql import functions as F

from mendlake.operators import extract

NOW = dt.datetime(2024, 6, 1)
COMMITS = "repo_url string, sha string, parents array<string>, message string, author_date timestamp"
RULES = "url string, start_date date, end_date date, fix_regexes array<string>"
URL = "https://github.com/o/r"


def commits_of(spark, rows, rules):
    out = extract.fix_commits(
        spark.createDataFrame(rows, COMMITS), spark.createDataFrame(rules, RULES), str(NOW)
    )
    return {r["sha"]: r for r in out.collect()}


def commit(sha_, message="fix it", when=dt.datetime(2023, 5, 1), parents=("p", "q"), url=URL):
    return (url, sha_, list(parents), message, when)


def test_message_patterns(spark):
    rows = [
        commit("a", "Fix the leak"), commit("b", "prefix"), commit("c", "title\nBUG 7"), commit("d", "docs"),
        commit("e", "x x"), commit("f", "ÄNDERUNG"), commit("g", "nothing", parents=()),
    ]
    default = [r"(?i)\bfix(es|ed)?\b", r"(?i)\bbug(s)?\b"]
    assert set(commits_of(spark, rows, [(URL, None, None, default)])) == {"a", "c"}
    assert set(commits_of(spark, rows, [(URL, None, None, [])])) == {"a", "b", "c", "d", "e", "f"}
    assert set(commits_of(spark, rows, [(URL, None, None, None)])) == {"a", "b", "c", "d", "e", "f"}
    assert set(commits_of(spark, rows, [(URL, None, None, ["^bug", "änderung"])])) == {"c", "f"}
    # Patterns that refer to their groups are not renumbered by the others.
    assert set(commits_of(spark, rows, [(URL, None, None, [r"(docs)", r"(\w) \1"])])) == {"d", "e"}


def test_date_range_is_inclusive_and_has_defaults(spark):
    rows = [
        commit("old", when=dt.datetime(2019, 12, 31, 23, 59, 59)), commit("first", when=dt.datetime(2020, 1, 1)),
        commit("last", when=dt.datetime(2021, 3, 5, 23, 59, 59, 999999)), commit("next", when=dt.datetime(2021, 3, 6)),
        commit("future", when=dt.datetime(2024, 6, 1, 0, 0, 1)), commit("now", when=NOW),
    ]
    open_ended = commits_of(spark, rows, [(URL, None, None, [])])
    assert set(open_ended) == {"first", "last", "next", "now"}
    closed = commits_of(spark, rows, [(URL, dt.date(2019, 12, 31), dt.date(2021, 3, 5), [])])
    assert set(closed) == {"old", "first", "last"}


def test_rules_meet_commits_by_slug_once(spark):
    rows = [commit("a"), commit("b", url="https://github.com/o/other"), commit("c", url="https://github.com/o/r.git")]
    rules = [(URL + ".git", None, None, []), (URL, None, None, []), ("https://nowhere", None, None, [])]
    got = commits_of(spark, rows, rules)
    assert set(got) == {"a", "c"}
    assert {r["rule_url"] for r in got.values()} == {URL}
    assert got["a"]["parent_sha"] == "p"


def test_source_files(spark):
    rows = [
        ("src/a.cpp", "modified"), ("src/a.CPP", "modified"), ("src/latest.cpp", "added"), ("Test/a.h", "modified"),
        ("a.hpp", "removed"), ("a.hpp", "renamed"), ("a.c", "modified"), ("a.cc", "added"), ("x.cxx", "added"), ("h", "added"),
    ]
    df = spark.createDataFrame(rows, "path string, status string")
    assert [r["path"] for r in extract.source_files(df).collect()] == ["src/a.cpp", "a.hpp", "a.cc", "x.cxx"]


# --- brute force ----------------------------------------------------------------

HEADERS, IMPLS = [".h", ".hpp"], [".cpp", ".cxx", ".cc"]


def partner(path, tree):
    folder, name = os.path.split(path)
    stem, ext = os.path.splitext(name)
    wanted = IMPLS if ext in HEADERS else HEADERS
    for e in wanted:
        sibling = os.path.join(folder, stem + e)
        if sibling in tree:
            return sibling
    return next((p for p in tree if os.path.splitext(os.path.basename(p)) in [(stem, e) for e in wanted]), None)


def brute_force(commits, files, trees, blobs, patterns):
    out = set()
    for url, sha_, parents, message, _ in commits:
        if not parents or not any(re.search(p, message, re.I | re.M) for p in patterns):
            continue
        seen = set()
        for path, status in files.get((url, sha_), []):
            stem, ext = os.path.splitext(os.path.basename(path))
            if status == "removed" or "test" in path.lower() or ext not in HEADERS + IMPLS or stem in seen:
                continue
            seen.add(stem)
            other = partner(path, trees.get((url, sha_), []))
            header, impl = (path, other) if ext in HEADERS else (other, path)
            h0, h1, i0, i1 = (
                blobs.get((url, s, p), "") if p else "" for p in (header, impl) for s in (parents[0], sha_)
            )
            before = "\n".join(x.strip() for x in (h0, i0) if x.strip())
            after = "\n".join(x.strip() for x in (h1, i1) if x.strip())
            if (h1 or i1) and before != after:
                out.add((url, sha_, stem, before, after))
    return out


def test_candidates_equal_brute_force(spark):
    rng = random.Random(7)
    urls = [URL, "https://github.com/o/s"]
    commits, files, trees, blobs = [], {}, {}, {}
    names = [f"{d}{s}{e}" for d in ("", "src/", "src/deep/", "lib/") for s in ("a", "b.c", "main", "x_test") for e in
             (".h", ".hpp", ".cpp", ".cc", ".cxx", ".py")]
    for n in range(150):
        url = rng.choice(urls)
        parents = [] if n % 11 == 0 else [f"s{n - 1}", "m"]
        commits.append((url, f"s{n}", parents, rng.choice(["fix a", "docs", "more\nbugs", "Fixed: b"]), dt.datetime(2022, 1, 1)))
        # One commit holds a third of all changed files.
        count = 400 if n == 5 else rng.randrange(0, 14)
        files[url, f"s{n}"] = [(rng.choice(names), rng.choice(["modified", "added", "removed"])) for _ in range(count)]
        trees[url, f"s{n}"] = rng.sample(names, rng.randrange(0, 40))
        for path in rng.sample(names, 60):
            for s in (f"s{n}", f"s{n - 1}"):
                if rng.random() < 0.8:
                    blobs[url, s, path] = rng.choice(["", " ", "int a;\n", "int b;", "  int c;\r\n", "int a;"])
    patterns = [r"(?i)\bfix(es|ed)?\b", r"(?i)\bbug(s)?\b"]
    got = extract.candidates(
        spark.createDataFrame(commits, COMMITS),
        spark.createDataFrame(
            [(u, s, i, p, st) for (u, s), rows in files.items() for i, (p, st) in enumerate(rows)],
            "repo_url string, sha string, ordinal int, path string, status string"),
        spark.createDataFrame(
            [(u, s, i, p) for (u, s), rows in trees.items() for i, p in enumerate(rows)],
            "repo_url string, sha string, ordinal int, path string"),
        spark.createDataFrame([(*k, v) for k, v in blobs.items()], "repo_url string, sha string, path string, content string"),
        spark.createDataFrame([(u, None, None, patterns) for u in urls], RULES),
        str(NOW),
    ).collect()
    want = brute_force(commits, files, trees, blobs, patterns)
    assert len(want) > 30
    assert {(r["repo_url"], r["sha"], r["base_name"], r["code_original"], r["code_fixed"]) for r in got} == want
    assert len(got) == len(want)
    # Acceptance: before and after always differ, and the hash is that of the original.
    assert all(r["code_original"] != r["code_fixed"] and r["code_hash"] == sha(r["code_original"]) for r in got)


def test_first_file_is_limited_before_the_shuffle(spark):
    # Every third row is of one commit and stem.
    common = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    files = spark.range(3000).select(
        F.concat(F.lit(URL), F.substring(common, 1, 0)).alias("repo_url"), common.alias("sha"),
        F.col("id").alias("ordinal"), F.concat(F.lit("src/"), common, F.lit(".cpp")).alias("path"))
    out = extract.first_file_per_stem(files)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"WindowGroupLimit.*Final[\s\S]*Exchange[\s\S]*WindowGroupLimit.*Partial", plan)
    assert out.count() == 2001
    assert out.filter("sha = 'hot'").first()["ordinal"] == 0


def test_patterns_as_python_writes_them_and_broken_ones(spark):
    rules = spark.createDataFrame([
        ("a", ["(?P<w>fix)(?P=w)"]), ("b", ["(unclosed", "fix"]), ("c", ["fix"]), ("d", []), ("e", None),
    ], "url string, fix_regexes array<string>")
    tried = extract.with_patterns(rules).withColumn("m", F.lit("fixfix"))
    found = tried.filter(extract.message_matches(F.col("m"), F.col("alternation"), F.col("alone")))
    assert sorted(r["url"] for r in found.collect()) == ["a", "c", "d", "e"]
    assert [tuple(r) for r in extract.broken_rules(rules).collect()] == [("b", "(unclosed")]
