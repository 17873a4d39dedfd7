"""Training rows and the stratified train / test split."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from mendlake.functions.training import TITLES, UNKNOWN, active_label, prompt
from mendlake.session import settle


def training_rows(entries):
    """Entries with code and a mapped label; missing fixed code falls back to the original."""
    return (
        entries.filter("code_original != '' AND labels.groups IS NOT NULL")
        .withColumn("label", active_label())
        .filter(F.col("label") != UNKNOWN)
        .select(
            F.col("entry_id").alias("sample_id"), "code_original",
            F.coalesce(F.nullif("code_fixed", F.lit("")), F.col("code_original")).alias("code_fixed"),
            "label",
        )
    )


def prompts(rows, with_label=True):
    label = F.col("label") if with_label else None
    return rows.select("sample_id", prompt(F.col("code_original"), F.col("code_fixed"), label).alias("text"))


def label_distribution(rows, *by):
    return rows.groupBy(*by, "label").agg(F.count(F.lit(1)).alias("n_samples"))


def split_quotas(counts, test_size=0.2):
    """Test rows per label: the test share of all rows, rounded up, spread by largest remainder.

    ``counts`` is ``label, n`` with one row per label.
    """
    everything = Window.partitionBy()
    by_remainder = Window.orderBy(F.desc("_remainder"), "label")
    return (
        counts.withColumn("_all", F.sum("n").over(everything))
        .withColumn("_train", F.col("_all") - F.ceil(F.col("_all") * F.lit(test_size)))
        # As decimals: the product of two row counts may not fit a bigint.
        .withColumn("_product", F.col("_train").cast("decimal(19,0)") * F.col("n").cast("decimal(19,0)"))
        .withColumn("_base", F.expr("_product div _all"))
        .withColumn("_remainder", F.expr("cast(_product % _all as bigint)"))
        .withColumn("_left", F.col("_train") - F.sum("_base").over(everything))
        .withColumn("_extra", (F.row_number().over(by_remainder) <= F.col("_left")).cast("long"))
        .select("label", "n", (F.col("n") - F.col("_base") - F.col("_extra")).alias("n_test"))
    )


def stratified_split(rows, test_size=0.2, seed=42, labels=tuple(TITLES.values()), buckets=65536):
    """Adds ``split`` (``train`` / ``test``), each label in the same proportion.

    Within a label the rows with the smallest hash of seed and ``sample_id`` form
    the test part, exactly as many as ``split_quotas`` says. No label is sorted as
    a whole: hashes are counted in ``buckets``, the bucket that holds the last
    test row of a label is ranked on its own, and its hash is the threshold that
    all rows are compared with. ``sample_id`` must be unique.

    Thresholds are one row per label of the closed list ``labels``, which bounds
    what is broadcast; any other label is an error.
    """
    if buckets & (buckets - 1) or not 1 <= buckets <= 65536:
        raise ValueError("buckets must be a power of two up to 65536")
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("sample_id").cast("string")).cast("binary"))
    bucket = F.floor(F.conv(F.substring("_key", 1, 4), 16, 10).cast("int") / F.lit(65536 // buckets))
    listed = F.col("label").isin(*labels)
    keyed = rows.withColumn("_key", key)
    # Read three times below; the code itself is read for the keys and for the result only.
    narrow = settle(keyed.select(
        F.when(listed, F.col("label")).otherwise(
            F.raise_error(F.concat(F.lit("label not listed: "), F.coalesce("label", F.lit("null"))))
        ).alias("label"),
        "_key", bucket.alias("_bucket"),
    ), "split-keys")
    counted = narrow.groupBy("label", "_bucket").agg(F.count(F.lit(1)).alias("n"))
    quotas = split_quotas(counted.groupBy("label").agg(F.sum("n").alias("n")), test_size)
    upto = Window.partitionBy("label").orderBy("_bucket")
    cut_buckets = (
        counted.withColumn("_upto", F.sum("n").over(upto))
        .join(F.broadcast(quotas.select("label", "n_test")), "label")
        .filter("_upto - n < n_test AND n_test <= _upto")
        .select("label", "_bucket", (F.col("n_test") - F.col("_upto") + F.col("n")).alias("_take"))
    )
    ranked = (
        narrow.join(F.broadcast(cut_buckets), ["label", "_bucket"])
        .withColumn("_nth", F.row_number().over(Window.partitionBy("label", "_bucket").orderBy("_key")))
        .filter("_nth = _take")
    )
    thresholds = ranked.select("label", F.col("_key").alias("_last"))
    return (
        keyed.join(F.broadcast(thresholds), "label", "left")
        .withColumn("split", F.when(F.col("_key") <= F.col("_last"), "test").otherwise("train"))
        .select(*rows.columns, "split")
    )
