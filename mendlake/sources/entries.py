"""Readers and writers of entries: JSON documents, JSON lines, flat CSV, Parquet."""

import csv
import io
import os
import re
from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mendlake.functions.text import py_lines, safe_name
from mendlake.operators.store import one_per_hash
from mendlake.schema import GROUPS, QUALITY, group_flag, scheme_groups
from mendlake.sources.store_files import compact_store, new_run, open_store, read_store, write_store  # noqa: F401

# Code keeps its blanks, quotes and line breaks only with these options.
CSV_WRITE = {
    "header": True, "escape": '"', "quoteAll": True, "nullValue": "", "emptyValue": "",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}
CSV_READ = {
    "header": True, "multiLine": True, "escape": '"',
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}
JSON_WRITE = {"ignoreNullFields": False}

FLAT_FIELDS = (
    "_id", "code_original", "code_fixed", "code_hash", "repo_url", "repo_commit_hash",
    "repo_commit_date", "ingest_timestamp", "labels_cppcheck", "labels_clang",
)


# --- JSON in -----------------------------------------------------------------

def wire_from_json(texts, column="value"):
    """Documents in JSON text as rows to validate; ``readable`` is false for broken ones.

    Code may be a text or a list of lines. Fields of another type than the
    schema allows are named in ``type_errors``; unknown fields are dropped.
    """
    doc = F.col("_doc")

    def part(path):
        return F.variant_get(doc, f"$.{path}", "variant")

    def kind(path):
        return F.split(F.schema_of_variant(part(path)), "[<(]")[0]

    def text(path):
        return F.when(kind(path) == "STRING", F.try_variant_get(doc, f"$.{path}", "string"))

    def code(path):
        lines = F.try_variant_get(doc, f"$.{path}", "array<string>")
        return F.coalesce(text(path), F.when(kind(path) == "ARRAY", F.array_join(lines, "\n")))

    def wrong(path, *kinds):
        # The kind of a JSON null is VOID, of an absent field it is null.
        return F.when(part(path).isNotNull() & ~kind(path).isin(*kinds), F.lit(path))

    def wrong_items(path):
        # Of a list, the kinds of all items as one: other than texts (or nothing) is refused.
        whole = F.schema_of_variant(part(path))
        return F.when((kind(path) == "ARRAY") & ~whole.isin("ARRAY<STRING>", "ARRAY<VOID>"), F.lit(path))

    errors = F.array(
        wrong_items("code_original"), wrong_items("code_fixed"), wrong_items("labels.cppcheck"),
        wrong("code_original", "STRING", "ARRAY"), wrong("code_fixed", "STRING", "ARRAY", "VOID"),
        wrong("code_hash", "STRING"), wrong("repo.url", "STRING"), wrong("repo.commit_hash", "STRING"),
        wrong("repo.commit_date", "STRING"), wrong("ingest_timestamp", "STRING"),
        wrong("labels.cppcheck", "ARRAY"), wrong("labels.clang", "OBJECT"), wrong("labels.groups", "OBJECT"),
    )
    entry = F.struct(
        doc.isNotNull().alias("readable"),
        code("code_original").alias("code_original"),
        code("code_fixed").alias("code_fixed"),
        text("code_hash").alias("code_hash"),
        F.struct(
            text("repo.url").alias("url"),
            text("repo.commit_hash").alias("commit_hash"),
            text("repo.commit_date").alias("commit_date"),
        ).alias("repo"),
        text("ingest_timestamp").alias("ingest_timestamp"),
        F.struct(
            F.try_variant_get(doc, "$.labels.cppcheck", "array<string>").alias("cppcheck"),
            F.when(kind("labels.clang") == "OBJECT", F.to_json(part("labels.clang"))).alias("clang"),
            F.try_variant_get(doc, "$.labels.groups", "map<string,string>").alias("groups"),
        ).alias("labels"),
        F.filter(errors, lambda e: e.isNotNull()).alias("type_errors"),
    )
    kept = [c for c in texts.columns if c != column]
    # As a generator the fields are computed once per document: later filters on
    # them are not rewritten into filters on the text.
    return texts.withColumn("_doc", F.try_parse_json(column)).select(*kept, F.inline(F.array(entry)))


def read_json_documents(spark, path, names="*.json"):
    """One document per file of these names, with ``file_name``; see ``wire_from_json``.

    Files are read as bytes, which takes a fifth of the time of the text reader
    where there are very many. Only that one unpacks, so it reads all other names.
    """
    if names.endswith((".json", ".txt")):
        files = spark.read.format("binaryFile").load(path, pathGlobFilter=names).withColumn("value", F.col("content").cast("string"))
    else:
        files = spark.read.text(path, wholetext=True, pathGlobFilter=names)
    return wire_from_json(files.select("value", F.col("_metadata.file_name").alias("file_name")))


def read_json_lines(spark, path):
    """One document per line, as written by ``write_json_lines``."""
    return wire_from_json(spark.read.text(path))


def report_documents(texts, column="value"):
    """Documents for the label report: any label form, flags also as numbers.

    A document without labels, or with empty ones, has null ``labels``.
    ``cppcheck_json`` is the issue field as JSON text, a list or a map.
    """
    doc = F.col("_doc")

    def part(path):
        return F.to_json(F.variant_get(doc, path, "variant"))

    def filled(path):
        # Present and neither null, false, zero nor empty.
        return F.coalesce(~part(path).isin("null", "false", "0", "0.0", '""', "[]", "{}"), F.lit(False))

    flags = [filled(f"$.labels.groups.{g}").alias(g) for g in (*GROUPS, QUALITY)]
    listed = F.coalesce(F.try_variant_get(doc, "$.labels.cppcheck", "array<string>"), F.array().cast("array<string>"))
    fields = F.struct(
        F.when(filled("$.labels"), F.coalesce(part("$.labels.cppcheck"), F.lit("[]"))).alias("cppcheck_json"),
        F.when(filled("$.labels"), F.struct(listed.alias("cppcheck"), F.struct(*flags).alias("groups"))).alias("labels"),
    )
    return texts.select(F.try_parse_json(column).alias("_doc")).select(F.inline(F.array(fields)))


# --- flat CSV ----------------------------------------------------------------

def flatten_entries(entries, scheme="fine13"):
    """Flat text columns of entries: lists and objects as JSON, flags ``True`` / ``False``."""
    def iso(c):
        return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")

    names = GROUPS + ("code_quality_performance",) if scheme == "fine13" else scheme_groups(scheme)
    return entries.select(
        F.col("entry_id").alias("_id"), "code_original", "code_fixed", "code_hash",
        F.col("repo.url").alias("repo_url"),
        F.col("repo.commit_hash").alias("repo_commit_hash"),
        iso("repo.commit_date").alias("repo_commit_date"),
        iso("ingest_timestamp").alias("ingest_timestamp"),
        F.to_json("labels.cppcheck").alias("labels_cppcheck"),
        F.col("labels.clang").alias("labels_clang"),
        *[F.initcap(group_flag(g).cast("string")).alias(f"labels_{g}") for g in names],
    )


def unflatten_rows(flat):
    """Rows to validate from flat text columns; a missing flag column reads as false."""
    def column(name, default=None):
        return F.col(name) if name in flat.columns else F.lit(default)

    def is_true(g):
        return F.coalesce(F.lower(column(f"labels_{g}").cast("string")) == "true", F.lit(False)).cast("string")

    # An empty required text reads back from CSV as null.
    def text(name):
        return F.coalesce(column(name), F.lit("")).cast("string")

    flags = F.create_map(*[x for g in GROUPS for x in (F.lit(g), is_true(g))])
    issues = F.coalesce(column("labels_cppcheck"), F.lit("[]"))
    clang = F.coalesce(column("labels_clang"), F.lit("{}"))
    broken = F.array(
        F.when(F.from_json(issues, "array<string>").isNull(), F.lit("labels.cppcheck")),
        F.when(F.from_json(clang, "map<string,string>").isNull(), F.lit("labels.clang")),
    )
    return flat.select(
        text("code_original").alias("code_original"),
        F.nullif(column("code_fixed").cast("string"), F.lit("")).alias("code_fixed"),
        text("code_hash").alias("code_hash"),
        F.struct(
            text("repo_url").alias("url"),
            text("repo_commit_hash").alias("commit_hash"),
            text("repo_commit_date").alias("commit_date"),
        ).alias("repo"),
        text("ingest_timestamp").alias("ingest_timestamp"),
        F.struct(
            F.from_json(issues, "array<string>").alias("cppcheck"),
            clang.cast("string").alias("clang"),
            flags.alias("groups"),
        ).alias("labels"),
        F.filter(broken, lambda e: e.isNotNull()).alias("type_errors"),
    )


def read_csv(spark, path, first_row_only=False):
    """Flat CSV files as rows to validate, all rows or the first of each file.

    Columns are taken by their header names, in any order: files with the same
    header are read together, each group with its own columns. The driver learns
    the headers and which file has which. Files without a line give no rows.
    """
    parts = []
    for columns, files in csv_headers(spark, path):
        flat = spark.read.options(**CSV_READ, enforceSchema=True).schema(
            T.StructType([T.StructField(c, T.StringType()) for c in columns])).csv(files)
        if first_row_only:
            flat = flat.select("*", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_row"))
            # A multi-line file is read by one task, in order; one row per file is kept.
            flat = flat.groupBy("_file").agg(F.min_by(F.struct(*columns), "_row").alias("_r")).select("_r.*")
        parts.append(unflatten_rows(flat))
    if not parts:
        return unflatten_rows(spark.createDataFrame([], ", ".join(f"{c} string" for c in FLAT_FIELDS)))
    return reduce(lambda a, b: a.unionByName(b), parts)


#: Lines that a header may take, with line breaks in quoted names.
HEADER_LINES = 50


def csv_headers(spark, path):
    """(column names, files) for each header among the CSV files; of repeated names the first counts."""
    lines = spark.read.option("pathGlobFilter", "*.csv").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"), "value")
    place = F.row_number().over(Window.partitionBy("file").orderBy("line"))
    # Tasks keep the first lines of a file before they send any.
    first = lines.filter("start = 0").withColumn("nth", place).filter(F.col("nth") <= HEADER_LINES)
    heads = first.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("nth", "value"))).alias("l"))
    # The first line, or as many as it takes to close its quotes.
    quotes = F.transform(F.sequence(F.lit(1), F.size("l")), lambda n: F.struct(
        (F.regexp_count(F.array_join(F.transform(F.slice("l", 1, n), lambda x: x["value"]), "\n"), F.lit('"')) % 2).alias("odd"), n.alias("n")))
    n = F.coalesce(F.get(F.filter(quotes, lambda q: q["odd"] == 0), 0)["n"], F.size("l"))
    header = F.array_join(F.transform(F.slice("l", 1, n), lambda x: x["value"]), "\n")
    found = []
    grouped = heads.select("file", header.alias("header")).groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"))
    for r in grouped.orderBy("header").collect():
        names = next(csv.reader(io.StringIO(r["header"].removeprefix("\ufeff"), newline="")))
        names = [n if n not in names[:i] else f"_repeated_{i}" for i, n in enumerate(names)]
        found.append((names, list(r["files"])))
    return found


def write_csv(entries, path, scheme="fine13", mode="errorifexists", rows_per_file=100_000):
    """Flat CSV files of bounded size: a file with line breaks in its fields is read by one task."""
    writer = flatten_entries(entries, scheme).write.options(**CSV_WRITE).option("maxRecordsPerFile", rows_per_file)
    writer.mode(mode).csv(path)


# --- JSON out ----------------------------------------------------------------

def export_documents(entries):
    """Entries as they leave: ``_id`` first, the clang object as an object."""
    return entries.select(
        F.col("entry_id").alias("_id"), "code_original", "code_fixed", "code_hash", "repo",
        "ingest_timestamp",
        F.struct(
            F.col("labels.cppcheck").alias("cppcheck"),
            F.try_parse_json("labels.clang").alias("clang"),
            F.col("labels.groups").alias("groups"),
        ).alias("labels"),
    )


def export_order(entries):
    return entries.orderBy("ingest_timestamp", "entry_id")


def write_json_lines(entries, path, mode="errorifexists"):
    """All entries in export order, one JSON document per line, nulls kept."""
    export_documents(export_order(entries)).write.options(**JSON_WRITE).mode(mode).json(path)


def file_name(entry_id, code_hash):
    """Name of an entry's file: identifier, else content hash, else a number."""
    numbered = F.concat(F.lit("entry_"), F.monotonically_increasing_id())
    return safe_name(F.coalesce(F.nullif(entry_id, F.lit("")), F.nullif(code_hash, F.lit("")), numbered))


def write_json_documents(entries, path, one_per_file=False, mode="errorifexists"):
    """Entries as JSON documents with their ``file_name``.

    ``one_per_file`` writes a file for each, which suits small exports only.
    """
    out = export_documents(entries).withColumn("file_name", file_name(F.col("_id"), F.col("code_hash")))
    writer = out.write.options(**JSON_WRITE).mode(mode)
    if one_per_file:
        writer = writer.option("maxRecordsPerFile", 1)
    writer.json(path)


def _on_this_disk(spark, path):
    """The path for Python's own functions where Hadoop's local file system has it, else nothing."""
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    if not re.match(r"[a-z][a-z0-9+.-]+:", path):
        return path if default.startswith("file:") else None
    return re.sub(r"^file:(//[^/]*)?", "", path) if path.startswith("file:") else None


def write_text_files(texts, path):
    """A file for each row of ``texts(value, folder)``, below ``folder=<number>``; ``path`` must be new or empty.

    A folder is written by one task and comes to its place as a whole. Hadoop's
    local file system starts a process or two for the rights of every file, some
    15 ms each, so Python writes there: a task fills a folder of its own that no
    reader sees, and those of the tasks that counted are put in place at the end.
    The driver sees a row per folder. Elsewhere Spark writes.
    """
    dealt = texts.select("value", "folder").repartition("folder")
    root = _on_this_disk(texts.sparkSession, path)
    if root is None:
        dealt.write.partitionBy("folder").option("maxRecordsPerFile", 1).text(path)
        return
    if os.path.isdir(root) and os.listdir(root):
        raise FileExistsError(root)

    def put(batches):
        import os
        import uuid

        import pyarrow as pa
        from pyspark import TaskContext

        attempt, filled, n = f"_attempt-{uuid.uuid4().hex}", set(), 0
        for batch in batches:
            for value, folder in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                own = f"{root}/{attempt}/folder={folder}"
                if folder not in filled:
                    os.makedirs(own)
                    filled.add(folder)
                with open(f"{own}/part-{TaskContext.get().partitionId():05d}-{n}.txt", "wb") as file:
                    file.write(value.as_buffer() or b"")
                    file.write(b"\n")
                n += 1
        yield pa.RecordBatch.from_pydict(
            {"attempt": pa.array([attempt] * len(filled), pa.string()), "folder": pa.array(sorted(filled), pa.int64())})

    os.makedirs(root, exist_ok=True)
    written = dealt.withColumn("folder", F.col("folder").cast("long")).mapInArrow(put, "attempt string, folder long").collect()
    for r in written:
        os.rename(f"{root}/{r['attempt']}/folder={r['folder']}", f"{root}/folder={r['folder']}")
    for attempt in {r["attempt"] for r in written}:
        os.rmdir(f"{root}/{attempt}")


def readable_documents(entries):
    """Documents with code as lists of lines, named by content hash."""
    return (
        export_documents(entries)
        .withColumn("code_original", py_lines(F.col("code_original")))
        .withColumn("code_fixed", py_lines(F.col("code_fixed")))
        .withColumn("file_name", F.concat(F.coalesce("code_hash", F.lit("unknown_hash")), F.lit(".json")))
    )


def write_readable_json(entries, path, mode="errorifexists"):
    """Readable documents; of several with one content hash the last replaces the others."""
    readable_documents(one_per_hash(entries, "last")).write.options(**JSON_WRITE).mode(mode).json(path)
