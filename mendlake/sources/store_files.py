"""The store on disk: entries in parts, laid out by hash prefix, with a filter beside each part.

Every write is a part of its own, ``run=<who wrote>/batch_id=<number>``, and below
it entries are dealt by the first digits of their content hash, ``prefix=<digits>``.
A lookup of hashes reads the folders of their prefixes alone. ``_filters`` holds a
blocked Bloom filter per part and prefix, as rows of bitmaps: a hash sets four
bits of one bitmap that it names itself. Only hashes whose bits are all set are
looked for in the part, so a false positive costs a read and never a row.

A part's filters are made from what was written; until then it has none, and a
part without filters is read in any case. Changes write theirs before the entries.
Changes rewrite the partitions that hold changed entries and no others.
"""

import os

from pyspark import StorageLevel
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mendlake.operators import store
from mendlake.schema import ENTRY_SCHEMA
from mendlake.session import settle

PART = ("run", "batch_id")
PARTITION = (*PART, "prefix")
STORE_SCHEMA = T.StructType(ENTRY_SCHEMA.fields + [
    T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType()), T.StructField("prefix", T.StringType())
])
#: Digits of the content hash that name a partition: sixteen folders a part. A store of many terabytes
#: wants two or three; the number must not change once a store is written.
PREFIX_DIGITS = 1

FILTER_SCHEMA = "prefix string, level int, bucket long, bits binary, run string, batch_id long"
#: Bits of a bitmap, as many as Spark's bitmap functions use, bits that a hash sets, and bitmap bits per hash.
BITMAP_BITS, HASHES, BITS_PER_HASH = 32768, 4, 10
#: A change deals a partition anew that has more files than this, of fewer bytes than that.
MOST_FILES, SMALL_FILE = 32, 1_000_000
#: Bitmaps of 4 kB that go to every executor; more of them only if Spark finds them small.
MOST_MARKS = 4000
#: Tasks whose entries one task writes where entries are written as they are dealt.
TASKS_AT_ONCE = 8


def prefix_of(code_hash):
    """Name of the partition of a content hash; hashes that differ in case only share one."""
    return F.concat(F.lit("p"), F.lower(F.substring(code_hash, 1, PREFIX_DIGITS)))


def new_run(kind):
    """A name that no other run has."""
    return f"{kind}-{os.urandom(16).hex()}"


def open_store(spark, path):
    """The entries of a store with the partition they are in; the store is made when missing."""
    empty = spark.createDataFrame([], STORE_SCHEMA)
    empty.write.mode("ignore").partitionBy(*PARTITION).parquet(path)
    # A partition that lost all its entries keeps a row without identifier.
    return spark.read.schema(STORE_SCHEMA).parquet(path).filter("entry_id IS NOT NULL")


def read_store(spark, path):
    opened = spark.read.schema(STORE_SCHEMA).parquet(path).filter("entry_id IS NOT NULL")
    return opened.select(*ENTRY_SCHEMA.fieldNames())


def write_store(entries, path, mode="errorifexists", files_per_prefix=None, as_dealt=False):
    """Writes entries as a part of their own; ``overwrite`` replaces the whole store.

    ``files_per_prefix`` is how many tasks write a prefix; unless given, adaptive
    execution takes one for small parts and more where a sixteenth of the entries
    is too much for one; without it there is one. ``as_dealt`` moves nothing: a
    task writes what a few have, of every prefix, which suits many entries.
    """
    part = entries.select(*ENTRY_SCHEMA.fieldNames())
    if mode == "overwrite":
        part.limit(0).withColumns({"run": F.lit("none"), "batch_id": F.lit(0)}).write.mode(mode).parquet(path)
        mode = "append"
    elif mode == "errorifexists":
        part.limit(0).write.mode(mode).parquet(path)
    write_part(part, path, new_run("batch"), 0, files_per_prefix, as_dealt)


def write_part(entries, path, run, batch_id, files_per_prefix=None, as_dealt=False):
    """Writes, or writes again, one part and its filters; returns how many entries it has.

    ``entries`` is read once. Filters that the part had go first, and the new ones
    are made from the entries written: a write that fails in between leaves a
    part without filters, never one whose filters lack an entry.
    """
    spark = entries.sparkSession
    spark.createDataFrame([], FILTER_SCHEMA).drop(*PART).write.mode("overwrite").parquet(f"{path}/_filters/run={run}/batch_id={batch_id}")
    seen = Observation("inserted")
    dealt = entries.select(*ENTRY_SCHEMA.fieldNames(), prefix_of(F.col("code_hash")).alias("prefix"))
    if as_dealt:
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions")) // TASKS_AT_ONCE
        dealt = dealt.coalesce(max(tasks, spark.sparkContext.defaultParallelism))
    elif files_per_prefix is None and spark.conf.get("spark.sql.adaptive.enabled") == "true":
        dealt = dealt.hint("rebalance", "prefix")
    elif files_per_prefix is None:  # the hint does nothing without it
        dealt = dealt.repartition("prefix")
    else:
        dealt = dealt.repartition("prefix", F.pmod(F.xxhash64("code_hash"), F.lit(files_per_prefix)))
    target = f"{path}/run={run}/batch_id={batch_id}"
    counted = dealt.observe(seen, F.count(F.lit(1)).alias("n"))
    counted.write.mode("overwrite").partitionBy("prefix").parquet(target)
    written = spark.read.schema(ENTRY_SCHEMA).parquet(target)
    write_filters(written.select("code_hash", F.lit(run).alias("run"), F.lit(batch_id).cast("long").alias("batch_id")), path, run, batch_id)
    return seen.get["n"]


# --- filters ----------------------------------------------------------------------

def _digits(digest, start, n):
    return F.conv(F.substring(digest, start, n), 16, 10).cast("long")


def _power(level):
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.col(level))


def _places(code_hash):
    """The bits of a hash in its bitmap, and the number that names the bitmap."""
    digest = F.md5(code_hash)
    return [_digits(digest, 1 + 4 * k, 4) % BITMAP_BITS for k in range(HASHES)], _digits(digest, 20, 12)


def _filter_rows(hashes):
    """Bitmaps of ``hashes(code_hash, run, batch_id)``; a partition has 2 ^ ``level`` of them."""
    hashes = hashes.withColumn("prefix", prefix_of(F.col("code_hash")))
    n = F.count(F.lit(1)) * BITS_PER_HASH / BITMAP_BITS
    levels = hashes.groupBy(*PARTITION).agg(F.greatest(F.lit(0), F.ceil(F.log2(n))).cast("int").alias("level"))
    bits, name = _places(F.col("code_hash"))
    each = hashes.join(levels, list(PARTITION)).select(
        *PARTITION, "level", (name % _power("level")).alias("bucket"), F.explode(F.array(*bits)).alias("_bit"))
    rows = each.groupBy(*PARTITION, "level", "bucket").agg(F.bitmap_construct_agg("_bit").alias("bits"))
    return rows.select("prefix", "level", "bucket", "bits", *PART)


def write_filters(hashes, path, run, batch_id):
    """Filters of one part, in place of those it had."""
    rows = _filter_rows(hashes).drop(*PART)
    rows.write.mode("overwrite").parquet(f"{path}/_filters/run={run}/batch_id={batch_id}")


def _filters(spark, path):
    empty = spark.createDataFrame([], FILTER_SCHEMA)
    empty.write.mode("ignore").partitionBy(*PART).parquet(f"{path}/_filters")
    return spark.read.schema(FILTER_SCHEMA).parquet(f"{path}/_filters")


def _prefixes(hashes):
    """The partitions of some hashes, at most as many as there are prefixes."""
    return [r[0] for r in hashes.select(prefix_of(F.col("code_hash")).alias("p")).distinct().collect() if r[0] is not None]


def _is_set(bitmap, bit):
    byte = F.conv(F.hex(F.substring(bitmap, (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (bit % 8).cast("int")).bitwiseAND(1) == 1


def possible_hashes(spark, path, hashes):
    """``code_hash, run, batch_id``: which of ``hashes`` a part may hold, by its filters alone."""
    filters = _filters(spark, path).filter(F.col("prefix").isin(_prefixes(hashes)))
    levels = [r[0] for r in filters.select("level").distinct().collect()]  # some thirty at most
    bits, name = _places(F.col("code_hash"))
    asked = hashes.select(
        "code_hash", prefix_of(F.col("code_hash")).alias("prefix"), F.array(*bits).alias("_bits"), name.alias("_name"),
        F.explode(F.array(*map(F.lit, levels)).cast("array<int>")).alias("level"))
    asked = asked.withColumn("bucket", F.col("_name") % _power("level"))
    met = filters.join(asked, ["prefix", "level", "bucket"])

    every = _is_set(F.col("bits"), F.col("_bits")[0])
    for k in range(1, HASHES):
        every = every & _is_set(F.col("bits"), F.col("_bits")[k])
    return met.filter(every).select("code_hash", *PART)


def known_hashes(spark, path, hashes, apart_from=None):
    """Which of ``hashes(code_hash)`` the store holds; ``apart_from``, a (run, batch_id), does not count.

    Reads the filters of the prefixes that occur, then the hash column of
    partitions that may hold one of them. The few hashes that passed a filter are
    a written table, so that Spark broadcasts them while they are small and the
    store's hashes stay where they are. Parts without filters are read in any case.
    """
    wanted = settle(hashes.filter("code_hash IS NOT NULL").select("code_hash").distinct(), "wanted-hashes")
    opened = open_store(spark, path)
    if apart_from is not None:
        opened = opened.filter(~((F.col("run") == apart_from[0]) & (F.col("batch_id") == apart_from[1])))
    suspects = settle(possible_hashes(spark, path, wanted).distinct(), "suspect-hashes")
    touched = _prefixes(suspects)
    found = suspects.select("code_hash").limit(0)
    if touched:
        found = stored_suspects(opened.filter(F.col("prefix").isin(touched)), suspects)
    parts = opened.select(*PART).distinct().join(_filters(spark, path).select(*PART).distinct(), list(PART), "left_anti").collect()
    if parts:  # of writes that left no filters
        bare = F.concat_ws("/", *PART).isin([f"{r['run']}/{r['batch_id']}" for r in parts])
        rest = opened.filter(F.col("prefix").isNull() | F.col("prefix").isin(_prefixes(wanted))).filter(bare)
        found = found.union(rest.select("code_hash").join(wanted, "code_hash", "left_semi"))
    return found.distinct()


def stored_suspects(opened, suspects):
    """The hashes that passed a part's filter and are in that part."""
    return opened.select("code_hash", *PART).join(suspects, ["code_hash", *PART], "left_semi").select("code_hash")


def append_new(entries, path, files_per_prefix=None):
    """Appends what the store does not have and returns how many entries that were.

    Hashes are looked up before any text is read; rows are then read for the new
    hashes alone. ``entries`` is read twice: give something kept rather than a long plan.
    """
    spark = entries.sparkSession
    hashes = settle(entries.select("code_hash").distinct(), "append")
    new = settle(hashes.join(known_hashes(spark, path, hashes), "code_hash", "left_anti"), "fresh")
    fresh = entries.join(new, "code_hash", "left_semi")
    if not new.filter("code_hash IS NULL").isEmpty():  # no key to look up: the first arrival without a hash is new
        fresh = fresh.union(entries.filter("code_hash IS NULL").select(*fresh.columns))
    return write_part(store.one_per_hash(fresh.select(*entries.columns)), path, new_run("batch"), 0, files_per_prefix)


def compact_store(spark, path, new_path, files_per_prefix=None):
    """The same entries as one part at a new place, for stores of very many small parts or of an older layout."""
    write_store(read_store(spark, path), new_path, files_per_prefix=files_per_prefix)


# --- changes in place -------------------------------------------------------------

def update_store(spark, path, updates):
    """Applies ``store.update_entries`` in place; returns ``entry_id, matched, modified, refused`` of the entries named."""
    def change(touched, opened):
        changed = _kept(store.update_entries(touched, updates, holders=opened.select("entry_id", "code_hash")))
        return changed, changed.filter("matched").select("entry_id", "matched", "modified", "refused")

    return _change(spark, path, updates, change)


def patch_store(spark, path, edits):
    """Applies ``store.patch_labels`` in place; returns ``entry_id`` of the entries it found."""
    def change(touched, opened):
        changed = _kept(store.patch_labels(touched, edits))
        return changed, changed.filter("matched").select("entry_id")

    return _change(spark, path, edits, change)


def delete_from_store(spark, path, ids):
    """Removes the listed entries in place; returns ``entry_id`` of those that were there."""
    def change(touched, opened):
        return _kept(store.delete_entries(touched, ids)), store.deleted_entries(touched, ids).select("entry_id")

    return _change(spark, path, ids, change)


def _kept(changed):
    """Changed rows on the executors' disks, for the report and the write; a lost copy is computed again."""
    return changed.persist(StorageLevel.DISK_ONLY)


def _change(spark, path, changes, change):
    """Rewrites the partitions that hold an entry of ``changes(entry_id)``, after ``change(touched, opened)``.

    The changes are looked up by identifier and place first. ``touched`` has the
    entries they name, which alone are moved; the others of a partition are
    written where they are read, file by file. A partition that has become many
    small files so is dealt anew.

    An entry whose hash changes moves to the partition of its new prefix, which
    is then rewritten as well. A partition that loses all its entries keeps one
    row without identifier, since only partitions that are written are replaced.
    Tasks write beside the old files, which go when all tasks are done; a write
    that fails before leaves them as they were.
    """
    opened = open_store(spark, path)
    ids = changes.select("entry_id").distinct()
    place = {"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")}
    at = opened.select("entry_id", *PARTITION, *[c.alias(n) for n, c in place.items()])
    named = settle(at.join(ids, "entry_id", "left_semi"), "named")
    files = opened.select(*PARTITION, place["_file"].alias("_file"), F.col("_metadata.file_size").alias("_size")).distinct()
    small = (F.count(F.lit(1)) > MOST_FILES) & (F.avg("_size") < SMALL_FILE)
    parts = files.join(named.select(*PARTITION).distinct(), list(PARTITION), "left_semi")
    parts = settle(parts.groupBy(*PARTITION).agg(small.alias("_scattered")), "touched")
    # A bit for each row of a file: what is named is told from the rest where it is read.
    block, bit = F.floor(F.col("_row") / BITMAP_BITS).cast("long"), F.col("_row") % BITMAP_BITS
    marks = settle(named.groupBy("_file", block.alias("_block")).agg(F.bitmap_construct_agg(bit).alias("_bits")), "marks")
    if marks.count() <= MOST_MARKS:
        marks = F.broadcast(marks)
    placed = opened.select("*", *[c.alias(n) for n, c in place.items()]).join(F.broadcast(parts), list(PARTITION))
    placed = placed.withColumn("_block", block)
    placed = placed.join(marks, ["_file", "_block"], "left").withColumn(
        "_named", F.col("_bits").isNotNull() & _is_set(F.col("_bits"), bit))
    # Kept, so that no join with the changes is moved below the choice of these rows.
    touched, rest = _kept(placed.filter("_named").select(*STORE_SCHEMA.names)), placed.filter("NOT _named")
    changed, report = change(touched, opened)
    report = settle(report, "changes")
    rows = changed.select(*ENTRY_SCHEMA.names, *PART, prefix_of(F.col("code_hash")).alias("prefix"), F.col("prefix").alias("_was"))
    moved = rows.filter("prefix != _was")
    extra = settle(moved.select(*PARTITION).distinct().join(parts, list(PARTITION), "left_anti"), "extra")
    left = rows.select(*PARTITION).union(rest.select(*PARTITION)).distinct()
    emptied = parts.select(*PARTITION).join(left, list(PARTITION), "left_anti")
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in ENTRY_SCHEMA.fields]
    dealt = rows.select(*STORE_SCHEMA.names).unionByName(emptied.select(*nothing, *PARTITION))
    if not parts.filter("_scattered").isEmpty():
        dealt, rest = dealt.unionByName(rest.filter("_scattered").select(*STORE_SCHEMA.names)), rest.filter("NOT _scattered")
    result = dealt.hint("rebalance", *PARTITION).unionByName(rest.select(*STORE_SCHEMA.names))
    if not extra.isEmpty():
        result = result.unionByName(opened.join(extra, list(PARTITION), "left_semi").select(*STORE_SCHEMA.names))
    # Filters first: they may hold more than the entries, never less.
    more = _filter_rows(rows.select("code_hash", *PART))
    more.write.mode("append").partitionBy(*PART).parquet(f"{path}/_filters")
    result.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITION).parquet(path)
    changed.unpersist()
    touched.unpersist()
    return report
