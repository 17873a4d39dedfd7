"""Trees at any commit from the change history."""

import datetime as dt
import random

from pyspark.sql import functions as F

from mendlake.operators import history

COMMITS = "repo_url string, sha bigint, author_date timestamp"
FILES = "repo_url string, sha bigint, ordinal int, path string, status string"


def made(seed, n=60):
    r = random.Random(seed)
    commits, files = [], []
    for u in range(2):
        day = dt.datetime(2020, 1, 1)
        for s in range(n):
            day += dt.timedelta(days=r.choice([0, 0, 1, 30, 400]), hours=r.choice([0, 5]))
            commits.append((f"u{u}", s, day))
            for o in range(r.randint(0, 4)):
                files.append((f"u{u}", s, o, f"d{r.randrange(2)}/{r.choice('ab')}.{r.choice(['h', 'cpp'])}", r.choice(["added", "modified", "removed"])))
            files.append((f"u{u}", s, 9, "d0/hot.cpp", "modified"))
    return commits, files


def trees(commits, files):
    """{(repo, sha): paths} by going through the commits."""
    out, now = {}, {}
    for u, s, _ in sorted(commits, key=lambda c: (c[0], c[2], c[1])):
        there = now.setdefault(u, set())
        for _, _, _, path, status in sorted(f for f in files if f[:2] == (u, s)):
            there.discard(path)
            if status != "removed":
                there.add(path)
        out[u, s] = set(there)
    return out


def test_trees_at_commits(spark):
    for seed in range(3):
        commits, files = made(seed)
        c, f = spark.createDataFrame(commits, COMMITS), spark.createDataFrame(files, FILES).repartition(3)
        intervals = history.path_intervals(c, f)
        asked = c.withColumn("stem", F.explode(F.array(*map(F.lit, ["a", "b", "hot", "none"]))))
        got = {}
        for r in history.tree_at(asked.union(asked), intervals).collect():  # asked twice, answered once
            assert r["path"] not in got.setdefault((r["repo_url"], r["sha"]), [])
            got[r["repo_url"], r["sha"]].append(r["path"])
        assert {k: set(v) for k, v in got.items()} == {k: v for k, v in trees(commits, files).items() if v}


def test_a_path_that_stays_has_one_row(spark):
    commits, files = made(7)
    found = history.path_intervals(spark.createDataFrame(commits, COMMITS), spark.createDataFrame(files, FILES))
    assert [(r["_from"]["sha"], r["_until"]) for r in found.filter("path = 'd0/hot.cpp'").collect()] == [(0, None)] * 2
    assert {r["stem"] for r in found.collect()} == {"a", "b", "hot"}


def test_blocks_are_the_days_once(spark):
    r = random.Random(1)
    spans = [(0, history.LAST_DAY), (5, 5), (0, 0), (history.LAST_DAY, history.LAST_DAY), (3, 2)]
    spans += [tuple(sorted(r.choices(range(3000), k=2))) for _ in range(100)]
    df = spark.createDataFrame(spans, "a int, b int").select("a", "b", history._blocks(F.col("a"), F.col("b")).alias("c"))
    for row in df.collect():
        days = sorted(d for c in row["c"] for d in range(c["block"] << c["level"], c["block"] + 1 << c["level"]))
        assert days == list(range(row["a"], row["b"] + 1)) and len(row["c"]) <= 2 * (history.LEVELS + 1)


def test_empty_history(spark):
    c, f = spark.createDataFrame([], COMMITS), spark.createDataFrame([], FILES)
    asked = c.withColumn("stem", F.lit("a"))
    assert history.tree_at(asked, history.path_intervals(c, f)).count() == 0


def test_what_meets_grows_with_what_is_found_on_a_full_day(spark):
    day, n = dt.datetime(2020, 1, 1), 600
    commits = [("u", s, day) for s in range(n)]
    files = [("u", s, 0, f"d{s // 2 % 50}/a.h", "removed" if s % 2 else "added") for s in range(n)]
    c, f = spark.createDataFrame(commits, COMMITS), spark.createDataFrame(files, FILES)
    asked, intervals = c.withColumn("stem", F.lit("a")), history.path_intervals(c, f)
    found = sorted((r["sha"], r["path"]) for r in history.tree_at(asked, intervals).collect())
    assert found == [(s, f"d{s // 2 % 50}/a.h") for s in range(0, n, 2)]  # each path is there for one commit
    assert history._met(asked, intervals).count() <= len(found) + 2 * history.RUN * (n // 2)  # not all commits with all stretches


def test_commits_without_a_date(spark):
    day = dt.datetime(2020, 1, 1)
    commits = [("u", 1, None), ("u", 2, None), ("u", 3, day), ("u", 4, day)]
    files = [("u", 1, 0, "x/a.h", "added"), ("u", 2, 0, "y/a.h", "added"), ("u", 3, 0, "z/a.h", "added"), ("u", 4, 0, "z/a.h", "removed")]
    c, f = spark.createDataFrame(commits, COMMITS), spark.createDataFrame(files, FILES)
    found = history.tree_at(c.withColumn("stem", F.lit("a")), history.path_intervals(c, f)).collect()
    assert sorted((r["sha"], r["path"]) for r in found) == [(1, "x/a.h"), (2, "x/a.h"), (2, "y/a.h"), (3, "z/a.h")]
