"""From analyzer output to the issues a fix removed and their categories.

``diagnostics`` has a key column (``pair_id`` unless said otherwise), ``side``
(``before`` / ``after``), ``line`` and ``status``. A side that was analysed
without findings has a row with a null or empty line; a side whose analysis
failed or timed out has a row with a status other than ``ok``.
``taxonomy`` has unique ``issue_id`` rows with ``category`` and ``ignored``.
"""

from pyspark.sql import functions as F

from mendlake.functions.diagnostics import clang_issue, cppcheck_id
from mendlake.functions.text import py_lines
from mendlake.schema import COARSE_GROUPS, GROUPS, QUALITY, SHARED_GROUPS

UNNAMED = ("", "unknown")


def output_lines(outputs, column="output"):
    """One row per line of whole analyzer outputs; an empty output keeps one row."""
    return outputs.select(
        *[c for c in outputs.columns if c != column],
        F.posexplode_outer(py_lines(F.col(column))).alias("line_no", "line"),
    )


def issue_ids(diagnostics, keys=("pair_id", "side")):
    """Sorted distinct issue ids of each analysed side.

    Repeats go before the second shuffle, so a side with very many lines reaches
    its group with its distinct ids only.
    """
    found = cppcheck_id(F.col("line"))
    distinct = diagnostics.select(*keys, F.when(~found.isin(*UNNAMED), found).alias("_id")).distinct()
    return distinct.groupBy(*keys).agg(F.array_sort(F.collect_list("_id")).alias("issues"))


def clang_issues(diagnostics):
    """Findings in clang-tidy output, one row each."""
    found = F.filter(F.array(clang_issue(F.col("line"))), lambda x: x.isNotNull())
    return diagnostics.filter(
        F.col("line").contains("warning:") | F.col("line").contains("error:")
    ).select(*[c for c in diagnostics.columns if c != "line"], F.inline(found))


def filter_issues(issues, taxonomy):
    """Rows with an ``issue_id`` that the taxonomy does not ignore."""
    return issues.join(taxonomy.filter("ignored").select("issue_id"), "issue_id", "left_anti")


def _found_per_pair(diagnostics, taxonomy, key):
    """Per pair what was found before, whether it was found after, and which sides were analysed or failed."""
    found = cppcheck_id(F.col("line"))
    failed = F.coalesce(F.col("status"), F.lit("ok")) != "ok"
    before, after = F.col("side") == "before", F.col("side") == "after"
    per_issue = (
        diagnostics.select(
            key, F.when(~found.isin(*UNNAMED), found).alias("issue_id"),
            before.alias("_before"), after.alias("_after"), failed.alias("_failed"),
        )
        .groupBy(key, "issue_id")
        .agg(
            F.bool_or("_before").alias("_before"),
            F.bool_or("_after").alias("_after"),
            F.bool_or(F.col("_before") & F.col("_failed")).alias("_before_failed"),
            F.bool_or(F.col("_after") & F.col("_failed")).alias("_after_failed"),
        )
    )
    known = per_issue.join(taxonomy.select("issue_id", "category", "ignored"), "issue_id", "left")
    counts = F.col("issue_id").isNotNull() & F.col("_before") & ~F.coalesce("ignored", F.lit(False))
    return known.groupBy(key).agg(
        F.bool_or("_before").alias("_analysed"),
        F.bool_or("_after").alias("_after_analysed"),
        F.bool_or("_before_failed").alias("_before_failed"),
        F.bool_or("_after_failed").alias("_after_failed"),
        F.collect_list(F.when(counts, F.struct("issue_id", "category", "_after"))).alias("_found"),
    )


def fixed_issues(diagnostics, taxonomy, key="pair_id", strict=True, fixed=None):
    """Issues found before and no longer after, as ``issues`` of (issue_id, category).

    A pair with a side that failed or was never analysed has no trustworthy
    difference and is left out; ``strict=False`` takes such an ``after`` side for
    one without findings. ``fixed`` names pairs (column ``key``) that have fixed
    code: for others all issues found before count, whatever rows the other side has.

    The first grouping, by pair and issue, leaves few rows for the second, so a
    pair with very many diagnostic lines is reduced before it meets in one task.
    """
    per_pair = _found_per_pair(diagnostics, taxonomy, key)
    if fixed is not None:
        per_pair = per_pair.join(fixed.select(key).distinct().withColumn("_fixed", F.lit(True)), key, "left")
        ignore_after = F.col("_fixed").isNull()
    else:
        ignore_after = F.lit(False)
    if strict:
        per_pair = per_pair.filter(~F.col("_before_failed") & (F.col("_after_analysed") & ~F.col("_after_failed") | ignore_after))
    else:
        ignore_after = ignore_after | F.col("_after_failed")
    gone = F.filter("_found", lambda x: ignore_after | ~x["_after"])
    gone = F.when(F.col("_before_failed"), F.filter("_found", lambda x: F.lit(False))).otherwise(gone)
    return per_pair.filter("_analysed").select(
        key,
        F.array_sort(F.transform(gone, lambda x: F.struct(x["issue_id"], x["category"]))).alias("issues"),
    )


def group_flags(issues, scheme="fine13"):
    """Category flags of an ``issues`` array.

    ``fine13`` has a flag per taxonomy category, ``coarse8`` folds the six finer
    ones into one, ``reference8`` has that one but no category that sets it.
    """
    def has(*names):
        return F.exists(issues, lambda x: F.coalesce(x["category"].isin(*names), F.lit(False)))

    if scheme == "fine13":
        flags = {g: has(g) for g in GROUPS}
    elif scheme == "coarse8":
        flags = {g: has(g) for g in SHARED_GROUPS}
        flags[QUALITY] = has(*GROUPS[len(SHARED_GROUPS):])
    elif scheme == "reference8":
        flags = {g: has(g) for g in COARSE_GROUPS}
    else:
        raise ValueError(f"unknown group scheme {scheme!r}")
    return F.struct(*[flag.alias(g) for g, flag in flags.items()])


def label_pairs(diagnostics, taxonomy, key="pair_id", scheme="fine13", strict=True, fixed=None):
    """``key, labels`` with the removed issues, an empty clang object and the flags."""
    issues = fixed_issues(diagnostics, taxonomy, key, strict, fixed)
    return issues.select(key, _labels(F.col("issues"), scheme).alias("labels"))


def _labels(issues, scheme):
    return F.struct(
        F.transform(issues, lambda x: x["issue_id"]).alias("cppcheck"),
        F.lit("{}").alias("clang"),
        group_flags(issues, scheme).alias("groups"),
    )


def label_both(diagnostics, taxonomy, key="pair_id", scheme="fine13", strict=True):
    """``key, labels, labels_unfixed``: as ``label_pairs`` for a pair with fixed code, and for one without.

    For those who know only later which of their pairs have fixed code. Null
    where the analyses that count failed or are not there.
    """
    before, after = ~F.col("_before_failed"), F.col("_after_analysed") & ~F.col("_after_failed")
    gone = F.filter("_found", lambda x: ~x["_after"] if strict else ~x["_after"] | F.col("_after_failed"))
    sides = _found_per_pair(diagnostics, taxonomy, key).filter("_analysed").select(
        key, F.when(before & after if strict else before, gone).alias("_gone"), F.when(before, F.col("_found")).alias("_all"))

    def listed(c):
        return F.array_sort(F.transform(c, lambda x: F.struct(x["issue_id"], x["category"])))

    sides = sides.select(key, listed("_gone").alias("_gone"), listed("_all").alias("_all"))
    return sides.select(key, *[
        F.when(F.col(c).isNotNull(), _labels(F.col(c), scheme)).alias(name) for c, name in (("_gone", "labels"), ("_all", "labels_unfixed"))])


def labelled(pairs):
    """Pairs with at least one removed issue."""
    return pairs.filter(F.size("labels.cppcheck") > 0)
