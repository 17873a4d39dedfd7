"""The corpus pipeline: five stages over the documents, each written and read again before the next.

Every stage works on all rows that the stage before it kept. All but the last
return the columns of ``documents``; ``n_chars`` follows the text.
"""

from pyspark.sql import functions as F

from mendlake.llm import bpe, line_dedup, mixing, ngram_join, quality
from mendlake.llm.common import WORD, row_key, settle, table

#: Near copies share so many percent of their shingles of so many words.
SHINGLE, PERCENT = 5, 80
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_stage(spark, docs, sf_dir):
    """Documents that the quality rules keep."""
    keyed = docs.select(*COLUMNS).withColumn("_key", row_key("doc_id", "lang", "text"))
    verdicts = quality.quality_rules(keyed, key="_key").filter("kept").select("_key").distinct()
    return keyed.join(verdicts, "_key", "left_semi").select(*COLUMNS)


def line_stage(spark, docs, sf_dir):
    """Texts without later occurrences of repeated lines; a document that lost all its lines goes."""
    left = line_dedup.remove_repeated_lines(docs, carry=("lang", "source"))
    return left.filter("n_removed < n_lines OR n_removed = 0").select(
        "doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def near_copy_stage(spark, docs, sf_dir):
    """One document of each group of near copies: the one that names the group.

    Of rows that repeat its id, the one with the least text stays. Rows without
    an id have no group and stay.
    """
    docs = docs.select(*COLUMNS)
    groups = ngram_join.similar_groups(docs, SHINGLE, PERCENT)
    chosen = groups.filter("doc_id = component_id").select("doc_id").distinct()
    kept = docs.join(chosen, "doc_id", "left_semi")
    once = kept.groupBy("doc_id").agg(F.min(F.struct("text", "lang", "source", "n_chars")).alias("r"))
    return once.select("doc_id", "r.*").select(*COLUMNS).union(docs.filter("doc_id IS NULL"))


def mixing_stage(spark, docs, sf_dir):
    """The mix: a row per document and turn with the words that are taken in it, in one piece.

    A document that the mix doesn't reach goes; one that it reads more than once
    comes again.
    """
    docs = docs.select(*COLUMNS).withColumn("_key", row_key("doc_id", "text", "lang"))
    placed, slices = mixing.mix(docs, keys=("doc_id", "_key"))
    taken = slices.groupBy("row", "epoch").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    wanted = taken.join(placed.select("row", "_key", "size", F.col("source").alias("_source")), "row")
    texts = docs.dropDuplicates(["_key", "source"])
    same = (texts["_key"] == wanted["_key"]) & texts["source"].eqNullSafe(wanted["_source"])
    # Words [first, last) with the white space between them; a whole text stays as it is.
    words = F.regexp_extract_all("text", F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    piece = F.rtrim(F.array_join(F.slice(words, F.col("first") + 1, F.col("last") - F.col("first")), ""))
    text = F.when((F.col("first") == 0) & (F.col("last") == F.col("size")), F.col("text")).otherwise(piece)
    return texts.join(wanted, same).select("doc_id", text.alias("text"), "lang", "source").withColumn(
        "n_chars", F.length("text").cast("long")).select(*COLUMNS)


def token_stage(spark, docs, sf_dir):
    """Token ids of every row; what they decode to is the text again."""
    definition = bpe.read_definition()
    coded = bpe.round_trip(docs, bpe.read_definition(), keys=("doc_id", "lang", "source"))
    return coded.select(
        "doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"))


STAGES = [
    ("quality", quality_stage),
    ("lines", line_stage),
    ("near_copies", near_copy_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]

#: Byte-pair merges cannot be written in SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``, each stage's result settled in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
