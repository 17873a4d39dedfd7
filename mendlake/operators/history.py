"""The files of a repository at any commit, from its change history.

A tree per commit would repeat nearly all paths with every commit. Here a path
has one row per stretch of commits in which it exists, and a commit finds its
paths by number: the commits that ask for a stem are numbered in their order, and
a stretch becomes the range of numbers that it covers. Ranges and numbers meet on
equal runs of ``RUN`` numbers, so what meets grows with what is found, however
long a path lives, however many commits ask and however many fall on one day.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from mendlake.functions import text as X
from mendlake.session import settle

#: Blocks of up to 2 ^ 16 days, from 1970 to 2149; what is outside counts as the first or last of them.
LEVELS = 16
LAST_DAY = (1 << LEVELS) - 1
#: Numbers of a run: a stretch meets at most two runs that it does not fill.
RUN = 16


def _day(when):
    return F.greatest(F.lit(0), F.least(F.unix_date(when.cast("date")), F.lit(LAST_DAY)))


def path_events(commits, commit_files):
    """``repo_url, path, _at, present``: what each commit leaves of a path; ``_at`` orders the commits of a repository.

    Commits follow each other by author date, then sha. Of several changes of a
    path in one commit the last one counts. A path that is not removed is there.
    """
    last = commit_files.groupBy("repo_url", "sha", "path").agg(F.max(F.struct("ordinal", "status"))["status"].alias("status"))
    when = commits.select("repo_url", "sha", F.struct("author_date", "sha").alias("_at")).dropDuplicates(["repo_url", "sha"])
    return last.join(when, ["repo_url", "sha"]).select("repo_url", "path", "_at", (F.col("status") != "removed").alias("present"))


def path_intervals(commits, commit_files):
    """``repo_url, path, stem, _from, _until``: a row per stretch of commits in which a path exists.

    ``_until``, the commit that removes it, is null for a path that is still
    there. Paths that are never removed need the first of their events only,
    which tasks combine; so a file that most commits touch sends a row per task.
    The others are sorted by time, each path by itself.
    """
    events = settle(path_events(commits, commit_files), "path-events")
    lives = events.groupBy("repo_url", "path").agg(F.min("_at").alias("_from"), F.bool_and("present").alias("_always"))
    always = lives.filter("_always").select("repo_url", "path", "_from", F.lit(None).cast(events.schema["_at"].dataType).alias("_until"))
    some = events.join(lives.filter("NOT _always").select("repo_url", "path"), ["repo_url", "path"])
    order = Window.partitionBy("repo_url", "path").orderBy("_at")
    turns = some.withColumn("_was", F.lag("present").over(order)).filter("present != coalesce(_was, false)")
    ended = turns.withColumn("_until", F.lead("_at").over(order)).filter("present")
    rows = always.unionByName(ended.select("repo_url", "path", F.col("_at").alias("_from"), "_until"))
    return rows.withColumn("stem", X.stem("path"))


def _blocks(first, last):
    """The largest blocks that together are the days from ``first`` to ``last``, two of each length at most."""
    def inside(level, k):
        return (F.call_function("shiftleft", k, level) >= first) & (F.call_function("shiftleft", k + 1, level) - 1 <= last)

    def of_level(level):
        length = F.call_function("shiftleft", F.lit(1), level)
        low = F.floor((first + length - 1) / length).cast("int")
        high = (F.floor((last + 1) / length) - 1).cast("int")
        ends = F.array_distinct(F.array(low, high))
        return F.transform(
            F.filter(ends, lambda k: inside(level, k) & ~inside(level + 1, F.floor(k / 2).cast("int"))),
            lambda k: F.struct(level.alias("level"), k.alias("block")))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), of_level))


def _numbered(points, intervals):
    """Points and both ends of every stretch with ``_n``, how many points of their group come before them.

    A group is a repository and a stem; commits without a date are one of their
    own. Days are numbered by themselves and then set one behind the other, so no
    task needs a whole group.
    """
    points = points.withColumns({"_dated": F.col("author_date").isNotNull(), "_point": F.lit(1)})
    dated = F.col("_from.author_date").isNotNull()
    stretches = intervals.filter(F.col("_until").isNull() | (F.col("_until.author_date").isNotNull() == dated)).select(
        "repo_url", "stem", "path", "_from", "_until", F.monotonically_increasing_id().alias("_stretch"), dated.alias("_dated"))
    ends = F.array(F.struct(F.col("_from").alias("at"), F.lit(True).alias("first")), F.struct(F.col("_until").alias("at"), F.lit(False).alias("first")))
    ends = stretches.withColumn("_end", F.explode(F.filter(ends, lambda e: e["at"].isNotNull()))).select(
        "repo_url", "stem", "_dated", F.col("_end.at.author_date").alias("author_date"), F.col("_end.at.sha").alias("sha"),
        "path", "_stretch", F.col("_end.first").alias("_first"), F.lit(0).alias("_point"))
    rows = points.unionByName(ends, allowMissingColumns=True).withColumn("_day", _day(F.col("author_date")))
    day = ["repo_url", "stem", "_dated", "_day"]
    order = Window.partitionBy(*day).orderBy("author_date", "sha", "_point").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = settle(rows.withColumn("_n", F.sum("_point").over(order) - F.col("_point")).drop("author_date"), "numbered")
    group = Window.partitionBy(*day[:-1])
    days = rows.groupBy(*day).agg(F.sum("_point").alias("_points"))
    days = days.withColumns({
        "_before": F.sum("_points").over(group.orderBy("_day")) - F.col("_points"), "_all": F.sum("_points").over(group)})
    return rows.join(days, day).withColumn("_n", F.col("_n") + F.col("_before")).drop("_day", "_points", "_before")


def _met(asked, intervals):
    """Commits and stretches that meet in a run, with the commit's number ``_n`` and the stretch's ``_low`` to below ``_high``."""
    numbered = settle(_numbered(asked.select("repo_url", "sha", "author_date", "stem").distinct(), intervals), "places")
    group = ["repo_url", "stem", "_dated"]
    points = numbered.filter("_point = 1").select(*group, "sha", "_n", F.floor(F.col("_n") / RUN).alias("_run"))
    ranges = numbered.filter("_point = 0").groupBy(*group, "path", "_stretch").agg(
        F.max(F.when(F.col("_first"), F.col("_n"))).alias("_low"),
        F.coalesce(F.max(F.when(~F.col("_first"), F.col("_n"))), F.max("_all")).alias("_high"))
    ranges = ranges.filter("_low < _high").select(
        *group, "path", "_low", "_high", F.explode(F.sequence(F.floor(F.col("_low") / RUN), F.floor((F.col("_high") - 1) / RUN))).alias("_run"))
    return points.join(ranges, [*group, "_run"])


def tree_at(asked, intervals):
    """``repo_url, sha, path, ordinal`` of the paths that exist at the commits and have the stems that ``asked`` names.

    ``asked`` has ``repo_url, sha, author_date, stem``. ``ordinal`` is the same
    for all paths, which leaves their order to the path, as in a sorted tree.
    Commits without a date see what commits without a date left, and no others do.
    """
    found = _met(asked, intervals).filter("_n >= _low AND _n < _high")
    return found.select("repo_url", "sha", "path", F.lit(0).alias("ordinal"))
