"""Label statistics."""

from pyspark.sql import functions as F

from mendlake.schema import QUALITY, group_flag, scheme_groups


def issue_map(cppcheck_json):
    """Issue counts of a cppcheck field in JSON text: a list of ids, or a map to counts."""
    listed = F.from_json(cppcheck_json, "array<string>")
    mapped = F.from_json(cppcheck_json, "map<string,int>")
    return F.when(
        listed.isNotNull(), F.transform(listed, lambda i: F.struct(i.alias("issue_id"), F.lit(1).alias("n")))
    ).otherwise(
        F.transform(F.map_entries(mapped), lambda e: F.struct(e["key"].alias("issue_id"), e["value"].alias("n")))
    )


def legacy_issue_counts(documents, column="cppcheck_json"):
    """Issue counts over documents of either form."""
    return (
        documents.select(F.explode(issue_map(F.col(column))).alias("_i"))
        .groupBy(F.col("_i.issue_id").alias("issue_id"))
        .agg(F.sum("_i.n").alias("n_issues"))
    )


def issue_counts(entries):
    return (
        entries.select(F.explode("labels.cppcheck").alias("issue_id"))
        .groupBy("issue_id")
        .agg(F.count(F.lit(1)).alias("n_issues"))
    )


def top_issues(counts, n=10):
    return counts.orderBy(F.desc("n_issues"), "issue_id").limit(n)


def label_totals(entries, issues=None):
    """Entries with and without labels, all issues, and distinct issue ids, in one row.

    ``issues`` is an array of (issue_id, n), by default each listed issue once.
    Rows are counted per issue first: the distinct count then needs no second
    copy of them.
    """
    if issues is None:
        issues = F.transform("labels.cppcheck", lambda i: F.struct(i.alias("issue_id"), F.lit(1).alias("n")))
    rows = entries.select(F.col("labels").isNotNull().alias("_has"), F.posexplode_outer(issues).alias("_at", "_i"))
    # An entry counts at its first issue, or at its only row when it has none.
    once = F.coalesce(F.col("_at") == 0, F.lit(True))
    per_issue = rows.groupBy(F.col("_i.issue_id").alias("issue_id")).agg(
        F.count_if(once).alias("_entries"),
        F.count_if(once & F.col("_has")).alias("_labelled"),
        F.sum("_i.n").alias("_issues"),
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return per_issue.agg(
        total("_entries").alias("n_entries"),
        total("_labelled").alias("n_with_labels"),
        total(F.col("_entries") - F.col("_labelled")).alias("n_without_labels"),
        total("_issues").alias("total_issues"),
        F.count("issue_id").alias("issue_types"),
    )


def _flag(entries, name):
    """A category flag; documents that carry the coarse flag themselves have it or one of the finer ones."""
    flag = group_flag(name)
    own = name == QUALITY and QUALITY in entries.schema["labels"].dataType["groups"].dataType.names
    return flag | F.coalesce(F.col(f"labels.groups.{QUALITY}"), F.lit(False)) if own else flag


def group_share(entries, scheme="coarse8"):
    """Entries per category and their percentage of the entries with labels.

    All flags are counted in one pass; the single row of counts is then turned.
    """
    names = scheme_groups(scheme)
    counts = entries.filter("labels IS NOT NULL").agg(
        F.count(F.lit(1)).alias("_total"), *[F.count_if(_flag(entries, g)).alias(g) for g in names]
    )
    rows = F.array(*[F.struct(F.lit(g).alias("group_name"), F.col(g).alias("n_entries")) for g in names])
    return counts.select("_total", F.inline(rows)).select(
        "group_name", "n_entries",
        F.when(F.col("_total") > 0, F.col("n_entries") / F.col("_total") * 100).otherwise(F.lit(0.0)).alias("percent"),
    ).orderBy(F.desc("n_entries"), "group_name")
