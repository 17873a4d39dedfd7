"""Mixing sources to target weights with a low-discrepancy schedule.

The documents of a source, in shuffled order, are one line of words that is cut
into blocks of equal length and read up to three times. The mix is a sequence of
slots: the golden-ratio points of the slots pass through the cumulative targets
and name a source each, slots are ranked per source, and the r-th slot of a
source takes its r-th block. Any stretch of the mix is near the targets.
"""

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from mendlake.llm.common import WORD, running_totals, settle, table

WEIGHTS = (5, 2, 1)
#: A source gives at most so many times its words.
EPOCHS = 3
MAX_BLOCK_WORDS = 4096
#: Slots per unit of weight at least, so that rounding to whole blocks stays far below any target.
SLOTS_PER_WEIGHT = 1024
#: Golden-ratio points in fixed point: multiples of the odd number next to 2**31 / phi, modulo 2**31.
POINTS, GOLDEN = 2**31, 1327217885
#: Slots that are ranked together in one group.
CHUNK = 65536


def source_targets(sizes):
    """Sources with ``source_size``, ``weight``, ``target`` and their place in code point order, null last.

    Sources share the sum of all sizes by weight; none gets more than three
    times its own size, and what is over goes to the others by weight until none
    is above. Each round passes two sums and a count through the driver.
    """
    grouped = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = grouped.withColumn("_null", F.col("source").isNull().cast("int"))
    ranked, total = running_totals(ordered, ["_null", "source"], ["source_size"], "sources")
    weight = F.get(F.array(*(F.lit(float(w)) for w in WEIGHTS)), (F.col("_rank") % len(WEIGHTS)).cast("int"))
    cap = (F.lit(float(EPOCHS)) * F.col("source_size"))
    placed = ranked.select(
        "source", "source_size", weight.alias("weight"), cap.alias("cap"), F.col("_rank").alias("place"),
        F.col("_before_source_size").alias("line_start"),
    )
    words, level, capped = float(total["source_size"]), 0.0, -1
    while words:
        full = F.lit(level) * F.col("weight") > F.col("cap")
        r = placed.agg(F.sum(F.when(full, F.col("cap")).otherwise(0.0)).alias("taken"),
                       F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open"),
                       F.sum(full.cast("long")).alias("n")).first()
        if r["n"] == capped or not r["open"]:
            break
        level, capped = (words - r["taken"]) / r["open"], r["n"]
    target = F.least(F.col("cap"), F.lit(level) * F.col("weight"))
    weights = placed.agg(F.sum("weight")).first()[0] or 0.0
    return placed.withColumn("target", target).drop("cap"), total, weights


def slot_sources(spark, targets, n_slots, block_words):
    """Slots of the mix: ``slot``, ``place`` of the source, ``rank`` of the slot within its source."""
    units = targets.withColumn("units", F.round("target").cast("long"))
    spans, total = running_totals(units, ["place"], ["units"], "target-spans")
    width = max(1, -(-total["units"] // max(1, 2 * total["rows"])))
    lo, hi = F.col("_before_units"), F.col("_before_units") + F.col("units")
    cells = spans.filter("units > 0").select(
        "place", lo.alias("lo"), hi.alias("hi"),
        F.explode(F.sequence(F.floor(lo / F.lit(width)), F.floor((hi - 1) / F.lit(width)))).alias("cell"),
    )
    point = ((F.col("id") % POINTS) * GOLDEN) % POINTS
    slots = spark.range(n_slots if total["units"] else 0).select(
        F.col("id").alias("slot"), F.floor(point / F.lit(float(POINTS)) * F.lit(total["units"])).alias("x")
    ).withColumn("cell", F.floor(F.col("x") / F.lit(width)))
    # A point meets the few sources that touch its cell of the grid, one of which holds it.
    named = slots.join(cells, "cell").filter("x >= lo AND x < hi").select("slot", "place")
    named = settle(named.withColumn("chunk", F.floor(F.col("slot") / F.lit(CHUNK))), "slots")
    counts = named.groupBy("place", "chunk").agg(F.count(F.lit(1)).alias("n"))
    earlier = W.partitionBy("place").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("place", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    within = F.row_number().over(W.partitionBy("place", "chunk").orderBy("slot")) - 1
    ranked = named.withColumn("within", within).join(offsets, ["place", "chunk"])
    return ranked.select("slot", "place", (F.col("within") + F.col("offset")).cast("long").alias("rank"))


def mix(docs, keys=("doc_id",), seed=0, max_block_words=MAX_BLOCK_WORDS):
    """The mix of ``docs(source, text, *keys)``: (placed documents, slices).

    The placed documents are all rows with ``size`` in words, ``source_size``,
    ``target`` and ``row``, a number that names the row. Slices say what the mix
    takes: ``slot``, ``row``, ``epoch`` and the words ``[first, last)`` of the
    text. ``keys`` order equal shuffle values, so give a key of the rows; rows
    that agree in them are placed in any order. A null text has no words; a null
    source is a source; documents without words are never taken; an empty table
    gives empty tables.
    """
    spark = docs.sparkSession
    sizes = settle(docs.select(
        *keys, "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")
    ), "sizes")
    targets, total, weights = source_targets(sizes)
    targets = settle(targets, "targets")
    words = total["source_size"]
    block = max(1, min(max_block_words, int(words // max(1, SLOTS_PER_WEIGHT * weights))))
    n_slots = -(-words // block)
    named = sizes.join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    shuffled = named.withColumn("_order", F.xxhash64(F.lit(seed), *keys)).drop("_source")
    lined, _ = running_totals(shuffled, ["place", "_order", *keys], ["size"], "lines")
    placed = lined.withColumn("row", F.col("_rank")).withColumn("start", F.col("_before_size") - F.col("line_start"))
    slots = settle(slot_sources(spark, targets, n_slots, block), "ranked-slots")
    reach = slots.groupBy("place").agg((F.count(F.lit(1)) * block).alias("reach"))
    read = placed.filter("size > 0").join(reach, "place").select(
        "place", "row", "start", "size", F.least("reach", EPOCHS * F.col("source_size")).alias("reach"), "source_size",
        F.explode(F.sequence(F.lit(0), F.lit(EPOCHS - 1))).alias("epoch"),
    ).withColumn("begin", F.col("epoch") * F.col("source_size") + F.col("start"))
    read = read.withColumn("end", F.least(F.col("begin") + F.col("size"), "reach")).filter("begin < end")
    blocks = read.withColumn("rank", F.explode(F.sequence(
        F.floor(F.col("begin") / F.lit(block)), F.floor((F.col("end") - 1) / F.lit(block)))))
    slices = blocks.join(slots, ["place", "rank"]).select(
        "slot", "row", "epoch",
        (F.greatest("begin", F.col("rank") * block) - F.col("begin")).alias("first"),
        (F.least("end", (F.col("rank") + 1) * block) - F.col("begin")).alias("last"),
    )
    return placed.select(*keys, "source", "size", "source_size", "target", "row"), slices


def op9_mix_sources(spark, sf_dir):
    """Words that the mix takes of every document."""
    placed, slices = mix(table(spark, sf_dir, "documents"))
    taken = slices.groupBy("row").agg(F.sum(F.col("last") - F.col("first")).alias("taken"))
    return placed.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )
