"""Repository rules and issue taxonomy from their JSON files."""

from pyspark.sql import functions as F

# Message patterns of a rule that names none.
DEFAULT_FIX_REGEXES = (r"(?i)\bfix(es|ed)?\b", r"(?i)\bbug(s)?\b", r"(?i)\bpatch(ed)?\b")

# Settings of a configuration that names none.
DEFAULT_TARGET = 1000
DEFAULT_QUEUE = 100


def _whole_json(spark, path):
    return spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("doc"))


def _kind(v):
    return F.split(F.schema_of_variant(v), "[<(]")[0]


def _regexes(doc, otherwise):
    """The pattern list of an object: null or empty matches all, absent takes ``otherwise``."""
    listed = F.variant_get(doc, "$.fix_regexes", "variant")
    none = F.array().cast("array<string>")
    return (
        F.when(listed.isNull(), otherwise)
        .when(F.is_variant_null(listed), none)
        .otherwise(F.coalesce(F.try_variant_get(doc, "$.fix_regexes", "array<string>"), none))
    )


def load_rules(spark, path):
    """``url, start_date, end_date, fix_regexes``, one row per usable repository."""
    docs = _whole_json(spark, path)
    defaults = F.array(*[F.lit(r) for r in DEFAULT_FIX_REGEXES])
    listed = F.try_variant_get("doc", "$.repositories", "array<variant>")
    entries = docs.select(
        _regexes(F.col("doc"), defaults).alias("common"),
        F.explode(listed).alias("item"),
    ).withColumn("kind", _kind(F.col("item")))

    def day(name):
        return F.try_to_date(F.try_variant_get("item", f"$.{name}", "string"), "yyyy-M-d")

    is_object = F.col("kind") == "OBJECT"
    return entries.select(
        F.when(is_object, F.try_variant_get("item", "$.url", "string"))
        .when(F.col("kind") == "STRING", F.try_variant_get("item", "$", "string")).alias("url"),
        F.when(is_object, day("start_date")).alias("start_date"),
        F.when(is_object, day("end_date")).alias("end_date"),
        F.when(is_object, _regexes(F.col("item"), F.col("common"))).otherwise(F.col("common")).alias("fix_regexes"),
    ).filter("url IS NOT NULL")


def load_settings(spark, path):
    """``target_record_count, queue_max_size`` of a configuration, in one row."""
    return _whole_json(spark, path).select(
        F.coalesce(F.try_variant_get("doc", "$.target_record_count", "int"), F.lit(DEFAULT_TARGET))
        .alias("target_record_count"),
        F.coalesce(F.try_variant_get("doc", "$.queue_max_size", "int"), F.lit(DEFAULT_QUEUE))
        .alias("queue_max_size"),
    )


def load_taxonomy(spark, path):
    """``issue_id, category, ignored`` with unique issue ids.

    The file has ``error_classification`` (category to issue ids) and
    ``ignore_list``. Of an id in several categories the last one counts.
    """
    text = spark.read.text(path, wholetext=True).select(
        F.from_json("value", "error_classification map<string,array<string>>, ignore_list array<string>").alias("t")
    )
    classified = (
        text.select(F.posexplode("t.error_classification").alias("pos", "category", "ids"))
        .select("pos", "category", F.explode("ids").alias("issue_id"), F.lit(False).alias("ignored"))
    )
    ignored = text.select(
        F.lit(-1).alias("pos"), F.lit(None).cast("string").alias("category"),
        F.explode("t.ignore_list").alias("issue_id"), F.lit(True).alias("ignored"),
    )
    return classified.unionByName(ignored).groupBy("issue_id").agg(
        F.max_by("category", "pos").alias("category"), F.bool_or("ignored").alias("ignored")
    )
