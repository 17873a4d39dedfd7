"""Continuous labelling and insertion of candidates with Structured Streaming.

Candidates arrive as files with the output lines of both analyses attached
(``before_lines``, ``after_lines``). The store itself is the memory of what was
inserted, so no streaming state grows with it: each micro-batch is joined
against the content hashes of the store.
"""

from pyspark import StorageLevel
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mendlake.functions import text as X
from mendlake.operators import store
from mendlake.operators.extract import DEFAULT_START
from mendlake.operators.label import label_both
from mendlake.plans.ingest import build_entries, first_per_pair, label_candidates
from mendlake.sources import config, store_files

CANDIDATE_SCHEMA = T.StructType([
    T.StructField("code_original", T.StringType()),
    T.StructField("code_fixed", T.StringType()),
    T.StructField("repo_url", T.StringType()),
    T.StructField("sha", T.StringType()),
    T.StructField("commit_date", T.TimestampType()),
    T.StructField("base_name", T.StringType()),
    T.StructField("code_hash", T.StringType()),
    T.StructField("pair_id", T.StringType()),
    T.StructField("before_lines", T.ArrayType(T.StringType())),
    T.StructField("after_lines", T.ArrayType(T.StringType())),
])

ADAPTIVE = "spark.sql.adaptive.enabled"


def read_candidates(spark, path, files_per_batch=100, schema=CANDIDATE_SCHEMA):
    """Stream of candidate files; at most ``files_per_batch`` wait in one batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def diagnostic_rows(candidates):
    """The attached analyzer lines as rows; an empty side keeps one row."""
    sides = F.array(
        F.struct(F.lit("before").alias("side"), F.col("before_lines").alias("lines")),
        F.struct(F.lit("after").alias("side"), F.col("after_lines").alias("lines")),
    )
    return candidates.select("pair_id", F.inline(sides)).select(
        "pair_id", "side",
        F.when(F.col("lines").isNull(), "failed").otherwise("ok").alias("status"),
        F.explode_outer("lines").alias("line"),
    )


class TargetReached(Exception):
    """Ends a stream whose run has stored what it was asked for."""


REACHED = "the target of this run is reached"


def run_name(spark, checkpoint):
    """The name of a stream's run, kept beside its progress: a new checkpoint is a new run."""
    path = f"{checkpoint.rstrip('/')}/store_run"
    spark.createDataFrame([(store_files.new_run("stream"),)], "run string").coalesce(1).write.mode("ignore").parquet(path)
    return spark.read.schema("run string").parquet(path).first()["run"]


def insert_batch(batch, batch_id, path, taxonomy, target=None, now=None, strict=True, run="stream"):
    """Labels one micro-batch and writes its new entries to the part of the run and batch.

    A batch that is run again after a failure does not see its own first
    attempt and replaces it, so every entry is stored once. ``target`` counts
    the entries of this run. The batch that reaches it stores no more than that
    and fails on purpose: its progress is not recorded, so what it left out
    comes again when the stream starts with a larger target.
    """
    spark = batch.sparkSession
    room = None
    if target is not None:
        opened = store_files.open_store(spark, path)
        room = target - opened.filter((F.col("run") == run) & (F.col("batch_id") < batch_id)).count()
        if room <= 0:
            raise TargetReached(REACHED)
    # Read by the labelling and by the entries; a lost copy is computed again.
    once = first_per_pair(batch).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if once.isEmpty():  # such as a batch that only clears old state
            return
        stored = store_files.known_hashes(spark, path, once, apart_from=(run, batch_id))
        labels = label_both(diagnostic_rows(once), taxonomy, strict=strict)
        columns = [c for c in batch.columns if c not in ("before_lines", "after_lines")]
        entries = build_entries(label_candidates(once.select(*columns), labels), now)
        fresh = store.insert_if_new(entries, stored)
        if room is not None:
            fresh = store.first_entries(fresh, room)
        inserted = store_files.write_part(fresh, path, run, batch_id)
    finally:
        once.unpersist()
    if room is not None and inserted >= room:
        raise TargetReached(REACHED)


def once_within(candidates, duration, keys=("pair_id",)):
    """Candidates without those that came already within ``duration``, from streaming state.

    The time of a candidate is that of the micro-batch that reads it, so none is
    ever late, however old its commit, and none is lost: what comes again after
    its key has left the state is found by the store. State holds the keys of
    the last ``duration`` only.
    """
    timed = candidates.withColumn("_read", F.current_timestamp()).withWatermark("_read", duration)
    return timed.dropDuplicatesWithinWatermark(list(keys)).drop("_read")


def ingest_stream(candidates, path, checkpoint, taxonomy, target=None, now=None, strict=True, trigger=None, within=None):
    """Starts the stream; by default it takes all that waits and then stops. See ``finish``.

    With ``within``, such as ``"6 hours"``, pairs that came in that time are
    dropped by ``once_within`` before they are labelled. A stream with a target
    must do without: its last batch comes again, but its state would not.
    """
    if within:
        if target is not None:
            raise ValueError("a stream with a target cannot remember what it has read")
        candidates = once_within(candidates, within)
    run = run_name(candidates.sparkSession, checkpoint)
    adaptive = candidates.sparkSession.conf.get(ADAPTIVE)

    def each(batch, batch_id):
        # Spark turns it off in a stream's session, whose own plans must keep their partitions. The batch is
        # planned by now; what is done with it would take all partitions for every step and many files for a prefix.
        conf = batch.sparkSession.conf
        own = conf.get(ADAPTIVE)
        conf.set(ADAPTIVE, adaptive)
        try:
            insert_batch(batch, batch_id, path, taxonomy, target, now, strict, run)
        finally:
            conf.set(ADAPTIVE, own)

    return (
        candidates.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def of_repositories(candidates, rules):
    """Candidates of the rules' repositories within their dates; open ends are the default start and no end."""
    own = rules.select(
        X.repo_slug("url").alias("_slug"), F.coalesce(F.col("start_date").cast("timestamp"), F.lit(DEFAULT_START).cast("timestamp")).alias("_from"),
        (F.date_add("end_date", 1).cast("timestamp")).alias("_until"),
    ).filter("_slug IS NOT NULL")
    # One row per repository, so that no candidate comes twice: the earliest start and the latest end.
    own = own.groupBy("_slug").agg(F.min("_from").alias("_from"), F.max("_until").alias("_until"), F.bool_or(F.col("_until").isNull()).alias("_open"))
    joined = candidates.withColumn("_slug", X.repo_slug("repo_url")).join(own, "_slug")
    inside = (F.col("commit_date") >= F.col("_from")) & (F.col("_open") | (F.col("commit_date") < F.col("_until")))
    return joined.filter(inside).select(*candidates.columns)


def ingest_from_settings(spark, settings, source, path, checkpoint, taxonomy, **options):
    """Starts the stream that a configuration file describes, on the candidate files in ``source``.

    Its repositories and their dates say which candidates count, its target how
    many entries the run stores, and its queue size how many files a batch takes.
    ``options`` are those of ``ingest_stream``; an unreadable file has no repositories.
    """
    chosen = config.load_settings(spark, settings).first()
    candidates = read_candidates(spark, source, files_per_batch=max(1, chosen["queue_max_size"]))
    wanted = of_repositories(candidates, config.load_rules(spark, settings))
    return ingest_stream(wanted, path, checkpoint, taxonomy, target=chosen["target_record_count"], **options)


def finish(running):
    """Waits for a stream; true when it ended because its target was reached."""
    try:
        running.awaitTermination()
    except StreamingQueryException as error:
        if REACHED not in str(error):
            raise
        return True
    return False


def ingest_rate(entries, seconds=5, watermark=None):
    """New entries per second in tumbling windows, of a table or of a stream.

    A stream in append mode needs a ``watermark`` such as ``"1 minute"``.
    """
    if watermark:
        entries = entries.withWatermark("ingest_timestamp", watermark)
    return entries.groupBy(F.window("ingest_timestamp", f"{seconds} seconds")).agg(
        F.count(F.lit(1)).alias("n_entries")
    ).select(
        F.col("window.start").alias("window_start"), "n_entries",
        (F.col("n_entries") / F.lit(float(seconds))).alias("entries_per_second"),
    )
