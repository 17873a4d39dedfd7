"""Classifier evaluation from predictions.

All figures come from ``pair_counts``, the number of rows per pair of true and
predicted label: one aggregation with partial sums over all predictions, after
which there are at most as many rows as the label list has pairs.
"""

from pyspark.sql import functions as F

from mendlake.functions.training import TITLES, UNKNOWN, parse_prediction


def parsed(predictions):
    return predictions.withColumn("predicted_label", parse_prediction(F.col("raw_prediction")))


def score(truth, predictions):
    """True label and prediction of each sample that has both."""
    return truth.select("sample_id", F.col("label").alias("true_label")).join(
        predictions.select("sample_id", "raw_prediction"), "sample_id"
    )


def pair_counts(scored, *by):
    return scored.groupBy(*by, "true_label", "predicted_label").agg(F.count(F.lit(1)).alias("n"))


def _correct(n="n"):
    return F.sum(F.when(F.col("true_label") == F.col("predicted_label"), F.col(n)).otherwise(0))


def _share(part, whole):
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def accuracy(scored):
    return pair_counts(scored).agg(
        F.coalesce(_correct(), F.lit(0)).alias("correct"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")
    ).select("correct", "total", (_share(F.col("correct"), F.col("total")) * 100).alias("accuracy"))


def confusion_matrix(scored, labels=(*TITLES.values(), UNKNOWN)):
    """Rows per pair of all labels seen, on either side, zeros included.

    The matrix is made in one row, which the closed list ``labels`` bounds; any
    other label is an error.
    """
    def listed(c):
        other = F.raise_error(F.concat(F.lit("label not listed: "), F.coalesce(c, F.lit("null"))))
        return F.when(F.col(c).isin(*labels), F.col(c)).otherwise(other).alias(c)

    cells = pair_counts(scored.select(listed("true_label"), listed("predicted_label"))).agg(
        F.array_sort(F.array_union(F.collect_set("true_label"), F.collect_set("predicted_label"))).alias("labels"),
        F.map_from_entries(F.collect_list(F.struct(F.struct("true_label", "predicted_label"), "n"))).alias("cells"),
    )
    return (
        cells.select("labels", "cells", F.explode("labels").alias("true_label"))
        .select("cells", "true_label", F.explode("labels").alias("predicted_label"))
        .select(
            "true_label", "predicted_label",
            F.coalesce(
                F.element_at("cells", F.struct("true_label", "predicted_label")), F.lit(0)
            ).alias("n"),
        )
    )


def label_totals(counts, *by):
    """Per label: rows that have it, rows predicted as it, and rows where both agree."""
    zero, same = F.lit(0).cast("long"), F.col("true_label") == F.col("predicted_label")
    sides = F.array(
        F.struct(F.col("true_label").alias("label"), F.col("n").alias("actual"), zero.alias("predicted"),
                 F.when(same, F.col("n")).otherwise(zero).alias("agreed")),
        F.struct(F.col("predicted_label").alias("label"), zero.alias("actual"), F.col("n").alias("predicted"),
                 zero.alias("agreed")),
    )
    return counts.select(*by, F.inline(sides)).groupBy(*by, "label").agg(
        F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"), F.sum("agreed").alias("agreed")
    )


def actual_vs_predicted(scored):
    return label_totals(pair_counts(scored)).select("label", "actual", "predicted")


def classification_report(scored):
    """Precision, recall, F1 and support per label, then accuracy, macro and weighted averages."""
    per_label = label_totals(pair_counts(scored)).select(
        "label", "agreed",
        _share(F.col("agreed"), F.col("predicted")).alias("p"),
        _share(F.col("agreed"), F.col("actual")).alias("r"),
        _share(2 * F.col("agreed"), F.col("actual") + F.col("predicted")).alias("f"),
        F.col("actual").alias("s"),
    )

    def weighted(c):
        return _share(F.sum(F.col(c) * F.col("s")), F.sum("s"))

    rolled = per_label.rollup("label").agg(
        F.grouping("label").alias("overall"),
        *[F.avg(c).alias(c) for c in "prf"],
        *[weighted(c).alias(f"w{c}") for c in "prf"],
        F.sum("s").alias("s"), F.sum("agreed").alias("agreed"),
    )

    def row(name, p, r, f):
        return F.struct(
            name.alias("label"), p.cast("double").alias("precision"), r.cast("double").alias("recall"),
            f.alias("f1_score"), F.col("s").alias("support"),
        )

    none = F.lit(None)
    summary = F.array(
        row(F.lit("accuracy"), none, none, _share(F.col("agreed"), F.col("s"))),
        row(F.lit("macro avg"), F.col("p"), F.col("r"), F.col("f")),
        row(F.lit("weighted avg"), F.col("wp"), F.col("wr"), F.col("wf")),
    )
    single = F.array(row(F.col("label"), F.col("p"), F.col("r"), F.col("f")))
    return rolled.select(F.inline(F.when(F.col("overall") == 1, summary).otherwise(single)))


def _both_models(baseline, tuned):
    return pair_counts(
        baseline.select(F.lit("baseline").alias("model"), "true_label", "predicted_label").unionByName(
            tuned.select(F.lit("tuned").alias("model"), "true_label", "predicted_label")
        ),
        "model",
    )


def _of(model, c):
    return F.coalesce(F.sum(F.when(F.col("model") == model, c)), F.lit(0))


def per_category_accuracy(baseline, tuned):
    """Percentage of each true label's samples that either model got right."""
    agreed = F.when(F.col("true_label") == F.col("predicted_label"), F.col("n")).otherwise(0)
    columns = []
    for model in ("baseline", "tuned"):
        part, whole = _of(model, agreed), _of(model, F.col("n"))
        columns += [whole.alias(f"{model}_support"), (_share(part, whole) * 100).alias(f"{model}_accuracy")]
    return _both_models(baseline, tuned).groupBy(F.col("true_label").alias("label")).agg(*columns)


def model_comparison(baseline, tuned):
    """Accuracy of both models, its change, relative change and the verdict on it."""
    agreed = F.when(F.col("true_label") == F.col("predicted_label"), F.col("n")).otherwise(0)
    totals = _both_models(baseline, tuned).agg(*[
        column
        for model in ("baseline", "tuned")
        for column in (
            _of(model, agreed).alias(f"{model}_correct"),
            _of(model, F.col("n")).alias(f"{model}_total"),
        )
    ])
    change = F.col("accuracy_change")
    return (
        totals.withColumn("baseline_accuracy", _share(F.col("baseline_correct"), F.col("baseline_total")) * 100)
        .withColumn("tuned_accuracy", _share(F.col("tuned_correct"), F.col("tuned_total")) * 100)
        .withColumn("accuracy_change", F.col("tuned_accuracy") - F.col("baseline_accuracy"))
        .withColumn("relative_change", change / F.greatest("baseline_accuracy", F.lit(0.01)) * 100)
        .withColumn("correct_change", F.col("tuned_correct") - F.col("baseline_correct"))
        .withColumn("verdict", F.when(change > 5, "effective").when(change > 0, "marginal")
                    .when(change == 0, "no change").otherwise("degraded"))
    )
