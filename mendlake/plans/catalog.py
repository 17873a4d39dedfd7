"""The registered queries: one per operator, over the whole driver tables."""

import math

from pyspark import StorageLevel
from pyspark.sql import functions as F

from mendlake.functions import text as X
from mendlake.functions.training import active_label
from mendlake.operators import history as H
from mendlake.operators import dataset, evaluate, extract, label, query, report, store
from mendlake.plans import ingest
from mendlake.plans import proxies as P
from mendlake.schema import GROUPS
from mendlake.session import settle, shared_dir
from mendlake.sources import config, store_files
from mendlake.sources import entries as io
from mendlake.streaming import ingest as stream

NOW = "2001-01-01 00:00:00"
QUERIES = {}


def registered(run):
    QUERIES[run.__name__] = run
    return run


def _joined(c):
    return F.array_join(c, ",")


def _labels(spark, sf_dir, **options):
    return label.label_pairs(P.view(spark, sf_dir, "p_diagnostics"), P.taxonomy(spark, sf_dir), **options)


# --- extraction ----------------------------------------------------------------

@registered
def fix_commits(spark, sf_dir):
    found = extract.fix_commits(P.commits(spark, sf_dir), P.rules(spark, sf_dir), NOW)
    return found.withColumn("author_date", F.date_format("author_date", "yyyy-MM-dd"))


@registered
def source_files(spark, sf_dir):
    return extract.source_files(P.view(spark, sf_dir, "p_commit_files")).select(
        "sha", "ordinal", X.dir_name("path").alias("dir"), X.stem("path").alias("stem"),
        X.extension("path").alias("ext"),
    )


@registered
def first_file_per_stem(spark, sf_dir):
    files = extract.source_files(P.view(spark, sf_dir, "p_repo_files"))
    return extract.first_file_per_stem(files).select("sha", "stem", "ordinal", "path")


@registered
def header_impl_pairs(spark, sf_dir):
    files = extract.source_files(P.view(spark, sf_dir, "p_repo_files")).withColumn("stem", X.stem("path"))
    pairs = extract.header_impl_pairs(files, P.view(spark, sf_dir, "p_repo_tree"), ("repo_url",))
    return pairs.select("sha", "ordinal", "header_path", "impl_path")


@registered
def tree_at_commits(spark, sf_dir):
    """Files and counterparts at every commit, with trees looked up in the history of all paths."""
    history = settle(P.view(spark, sf_dir, "p_repo_files").drop("parent_sha"), "files")  # four steps read it
    commits = P.commits(spark, sf_dir)
    files = extract.source_files(history).withColumn("stem", X.stem("path"))
    asked = files.join(commits.select("repo_url", "sha", "author_date"), ["repo_url", "sha"])
    tree = H.tree_at(asked, H.path_intervals(commits, history))
    pairs = extract.header_impl_pairs(files, tree, ("repo_url", "sha"), pruned=True)
    return pairs.select("sha", "ordinal", "header_path", "impl_path")


@registered
def path_intervals(spark, sf_dir):
    """Stretches of commits in which each path of each repository exists."""
    found = H.path_intervals(P.commits(spark, sf_dir), P.view(spark, sf_dir, "p_repo_files"))
    return found.select("repo_url", "path", F.col("_from.sha").alias("from_sha"), F.col("_until.sha").alias("until_sha"))


def _candidates(spark, sf_dir):
    blobs = P.blob_store(spark, sf_dir, shared_dir(spark, "blobs"))
    return extract.candidates(
        P.commits(spark, sf_dir), P.view(spark, sf_dir, "p_repo_files").drop("parent_sha"),
        P.view(spark, sf_dir, "p_repo_tree"), blobs, P.rules(spark, sf_dir), NOW, ("repo_url",),
    )


@registered
def candidates(spark, sf_dir):
    """Before and after code, from contents by identity in bucketed tables."""
    return _candidates(spark, sf_dir).select(
        "repo_url", "sha", "base_name", "code_hash", X.sha256_hex("code_fixed").alias("fixed_hash"),
        F.length("code_original").alias("n_original"), F.length("code_fixed").alias("n_fixed"),
    )


@registered
def fix_commits_from_file(spark, sf_dir):
    """The same commits with the rules read from a configuration file."""
    path = shared_dir(spark, "rules")
    rules = P.rules(spark, sf_dir).select(F.struct("*").alias("r")).agg(F.collect_list("r").alias("repositories"))
    rules.select(F.to_json(F.struct("repositories")).alias("value")).coalesce(1).write.text(path)
    found = extract.fix_commits(P.commits(spark, sf_dir), config.load_rules(spark, f"{path}/*.txt"), NOW)
    return found.withColumn("author_date", F.date_format("author_date", "yyyy-MM-dd"))


@registered
def group_flags_from_file(spark, sf_dir):
    """The same labels with the taxonomy read from a file."""
    path = shared_dir(spark, "taxonomy")
    lists = P.taxonomy(spark, sf_dir).groupBy("category", "ignored").agg(F.collect_list("issue_id").alias("ids"))
    document = lists.agg(
        F.map_from_entries(F.collect_list(F.when(~F.col("ignored"), F.struct("category", "ids")))).alias("error_classification"),
        F.flatten(F.collect_list(F.when(F.col("ignored"), F.col("ids")))).alias("ignore_list"),
    )
    document.select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.text(path)
    taxonomy = config.load_taxonomy(spark, f"{path}/*.txt")
    return label.label_pairs(P.view(spark, sf_dir, "p_diagnostics"), taxonomy).select("pair_id", "labels.groups.*")


@registered
def ingest_entries(spark, sf_dir):
    """From commits to new entries; the diagnostics are keyed by commit here."""
    diagnostics = P.view(spark, sf_dir, "p_diagnostics").withColumnRenamed("pair_id", "sha")
    stored = P.view(spark, sf_dir, "p_store_hashes")
    fresh = ingest.new_entries(
        _candidates(spark, sf_dir), diagnostics, P.taxonomy(spark, sf_dir), stored, NOW, key="sha", once=False
    )
    return fresh.select(
        "entry_id", "code_hash", "repo.url", "repo.commit_hash", X.sha256_hex("code_fixed").alias("fixed_hash"),
        _joined("labels.cppcheck").alias("cppcheck"), "labels.groups.memory_management",
    )


@registered
def stage_counts(spark, sf_dir):
    diagnostics = P.view(spark, sf_dir, "p_diagnostics").withColumnRenamed("pair_id", "sha")
    return ingest.stage_counts(
        _candidates(spark, sf_dir), diagnostics, P.taxonomy(spark, sf_dir),
        P.view(spark, sf_dir, "p_store_hashes"), key="sha",
    )


@registered
def code_hash(spark, sf_dir):
    return P.table(spark, sf_dir, "documents").select("doc_id", X.sha256_hex("text").alias("code_hash"))


@registered
def repo_slug(spark, sf_dir):
    urls = P.view(spark, sf_dir, "p_commits").select("repo_url", "sha").unionByName(
        P.table(spark, sf_dir, "pages").select(F.col("url").alias("repo_url"), F.col("page_id").alias("sha"))
    )
    return urls.select("sha", "repo_url", X.repo_slug("repo_url").alias("slug"))


@registered
def code_lines(spark, sf_dir):
    lines = P.table(spark, sf_dir, "documents").select("doc_id", X.py_lines(F.col("text")).alias("lines"))
    return lines.select(
        "doc_id", F.size("lines").alias("n_lines"), X.sha256_hex(F.array_join("lines", "|")).alias("lines_hash")
    )


@registered
def safe_names(spark, sf_dir):
    return P.table(spark, sf_dir, "pages").select("page_id", X.safe_name("url").alias("name"))


# --- labels --------------------------------------------------------------------

@registered
def issue_ids(spark, sf_dir):
    return label.issue_ids(P.view(spark, sf_dir, "p_diagnostics")).select(
        "pair_id", "side", _joined("issues").alias("issues")
    )


@registered
def clang_issues(spark, sf_dir):
    return label.clang_issues(P.view(spark, sf_dir, "p_clang"))


def _fixed(spark, sf_dir, strict):
    return label.fixed_issues(
        P.view(spark, sf_dir, "p_diagnostics"), P.taxonomy(spark, sf_dir), strict=strict
    ).select("pair_id", _joined(F.transform("issues", lambda x: x["issue_id"])).alias("issues"))


@registered
def fixed_issues(spark, sf_dir):
    return _fixed(spark, sf_dir, True)


@registered
def fixed_issues_lenient(spark, sf_dir):
    """A failed analysis counts as one without findings."""
    return _fixed(spark, sf_dir, False)


@registered
def known_issues(spark, sf_dir):
    """Issues in analyzer output that the taxonomy does not ignore, per id."""
    lines = P.view(spark, sf_dir, "p_diagnostics").select(label.cppcheck_id(F.col("line")).alias("issue_id"))
    counts = lines.filter("issue_id IS NOT NULL").groupBy("issue_id").agg(F.count(F.lit(1)).alias("n_issues"))
    return label.filter_issues(counts, P.taxonomy(spark, sf_dir))


@registered
def group_flags(spark, sf_dir):
    return _labels(spark, sf_dir).select("pair_id", "labels.groups.*")


@registered
def group_flags_reference8(spark, sf_dir):
    return _labels(spark, sf_dir, scheme="reference8").select("pair_id", "labels.groups.*")


@registered
def fixes_by_category(spark, sf_dir):
    """How many fixes fall in each category, and what share of all labelled fixes."""
    return report.group_share(label.labelled(_labels(spark, sf_dir)), "fine13").withColumn(
        "percent", F.round("percent", 6)
    )


# --- report --------------------------------------------------------------------

@registered
def label_totals(spark, sf_dir):
    return report.label_totals(P.entries(spark, sf_dir))


@registered
def issue_counts_top10(spark, sf_dir):
    lines = P.view(spark, sf_dir, "p_diagnostics")
    issues = label.issue_ids(lines).select(F.struct(F.col("issues").alias("cppcheck")).alias("labels"))
    return report.top_issues(report.issue_counts(issues))


@registered
def group_share(spark, sf_dir):
    return report.group_share(P.entries(spark, sf_dir)).withColumn("percent", F.round("percent", 6))


@registered
def legacy_issue_counts(spark, sf_dir):
    """Issue fields in both stored forms: lists of ids, and maps from id to count."""
    stored = P.view(spark, sf_dir, "p_entries")
    as_list = F.to_json(F.filter(F.array("issue_1", "issue_2", "issue_3"), lambda i: i.isNotNull()))
    as_map = F.concat(F.lit('{"memleak":'), (F.col("doc_id") % 4).cast("string"), F.lit(',"oldCheck":2}'))
    documents = stored.select(
        F.when(F.col("doc_id") % 3 == 1, as_map).otherwise(as_list).alias("cppcheck_json")
    )
    return report.legacy_issue_counts(documents)


# --- store ---------------------------------------------------------------------

@registered
def one_per_hash_first(spark, sf_dir):
    return store.one_per_hash(P.entries(spark, sf_dir)).select("entry_id", "code_hash")


@registered
def one_per_hash_last(spark, sf_dir):
    return store.one_per_hash(P.entries(spark, sf_dir), "last").select("entry_id", "code_hash")


@registered
def insert_if_new(spark, sf_dir):
    stored = P.view(spark, sf_dir, "p_store_hashes")
    return store.insert_if_new(P.entries(spark, sf_dir), stored).select("entry_id", "code_hash")


@registered
def insert_outcomes(spark, sf_dir):
    stored = P.view(spark, sf_dir, "p_store_hashes")
    return store.insert_outcomes(P.entries(spark, sf_dir), stored)


@registered
def validate_entries(spark, sf_dir):
    checked = store.validate(P.wire(spark, sf_dir))
    return checked.select(
        "doc_id", _joined("reasons").alias("reasons"), "labels.groups.memory_management",
        F.date_format("repo.commit_date", "yyyy-MM-dd HH:mm:ss").alias("commit_date"),
    )


@registered
def import_outcomes(spark, sf_dir):
    checked = store.validate(P.wire(spark, sf_dir))
    return store.import_outcomes(checked, P.view(spark, sf_dir, "p_store_hashes"))


@registered
def update_entries(spark, sf_dir):
    changed = store.update_entries(P.entries(spark, sf_dir), P.updates(spark, sf_dir))
    return changed.select(
        "entry_id", "matched", "modified", _joined("refused").alias("refused"), X.sha256_hex("code_fixed").alias("fixed_hash"), "repo.commit_hash",
        "labels.groups.concurrency", "labels.groups.memory_management", "labels.clang",
    )


@registered
def delete_entries(spark, sf_dir):
    return store.delete_entries(P.entries(spark, sf_dir), P.view(spark, sf_dir, "p_edits")).select("entry_id")


@registered
def deleted_entries(spark, sf_dir):
    return store.deleted_entries(P.entries(spark, sf_dir), P.view(spark, sf_dir, "p_edits")).select("entry_id")


@registered
def patch_labels(spark, sf_dir):
    return store.patch_labels(P.entries(spark, sf_dir), P.edits(spark, sf_dir)).select(
        "entry_id", "matched", _joined("labels.cppcheck").alias("cppcheck"), "labels.groups.memory_management",
        "labels.groups.concurrency", "labels.groups.logic_error",
    )


@registered
def unmatched_edits(spark, sf_dir):
    return store.unmatched(P.edits(spark, sf_dir), P.entries(spark, sf_dir)).select("entry_id", "seq")


@registered
def target_cap(spark, sf_dir):
    once = store.one_per_hash(P.entries(spark, sf_dir))
    return store.first_entries(once, 50).select("entry_id", "code_hash")


# --- queries -------------------------------------------------------------------

@registered
def label_filter(spark, sf_dir):
    wanted = query.labels_filter(["MemError", "CodeQualityPerformance", "nullPointer"])
    return P.entries(spark, sf_dir).filter(wanted).select("entry_id")


@registered
def param_filter(spark, sf_dir):
    wanted = query.params_filter(
        repo_url="https://github.com/o/src6", has_memory_management="Yes", has_concurrency="0",
        has_logic_error="perhaps", has_code_quality_performance="true",
    )
    return P.entries(spark, sf_dir).filter(wanted).select("entry_id")


@registered
def document_filter(spark, sf_dir):
    wanted = {
        "$or": [
            {"labels.groups.memory_management": True, "code_fixed": {"$ne": None}},
            {"labels.cppcheck": {"$in": ["cstyleCast", "absent"]}},
            {"repo.commit_hash": {"$regex": "^9", "$nin": ["91", "92"]}},
        ],
        "repo.url": {"$gte": "https://github.com/o/src1", "$not": {"$regex": "src5$"}},
        "labels.cppcheck": {"$ne": "nullPointer"},
        "no_such_field": {"$exists": False},
    }
    return query.find(P.entries(spark, sf_dir), wanted, limit=0).select("entry_id")


@registered
def point_lookup(spark, sf_dir):
    return query.get_entry(P.entries(spark, sf_dir), "000000000000000000000042").select("entry_id", "code_hash")


@registered
def sorted_page(spark, sf_dir):
    page = query.find(
        P.entries(spark, sf_dir), {"labels.groups.invalid_access": True},
        {"repo.url": -1, "code_fixed": 1, "ingest_timestamp": -1}, 25,
    )
    return page.select("entry_id", "repo.url", "code_hash")


@registered
def result_count(spark, sf_dir):
    found = query.find(P.entries(spark, sf_dir), {"labels.groups.logic_error": True}, limit=0)
    return found.agg(F.count(F.lit(1)).alias("n_entries"))


@registered
def active_labels_text(spark, sf_dir):
    return query.listing(P.entries(spark, sf_dir))


# --- documents and flat rows -----------------------------------------------------

@registered
def export_order(spark, sf_dir):
    out = io.export_documents(io.export_order(P.entries(spark, sf_dir)))
    return out.select(F.col("_id").alias("entry_id"), "code_hash", _joined("labels.cppcheck").alias("cppcheck"))


@registered
def flatten_csv(spark, sf_dir):
    flat = io.flatten_entries(P.entries(spark, sf_dir))
    return flat.withColumnRenamed("_id", "entry_id").drop("code_original", "code_fixed")


@registered
def unflatten_csv(spark, sf_dir):
    """Entries that went through flat rows and the checks."""
    back = store.validate(io.unflatten_rows(io.flatten_entries(P.entries(spark, sf_dir))))
    return _stored_form(store.accepted(back))


@registered
def json_documents(spark, sf_dir):
    """Entries that went through JSON text, with code as lists of lines, and the checks."""
    texts = io.readable_documents(P.entries(spark, sf_dir)).select(F.to_json(F.struct("*")).alias("value"))
    return _stored_form(store.accepted(store.validate(io.wire_from_json(texts))))


@registered
def csv_files(spark, sf_dir):
    """Entries written to flat CSV files, read back and checked."""
    path = shared_dir(spark, "csv-files")
    io.write_csv(P.entries(spark, sf_dir), path)
    return _stored_form(store.accepted(store.validate(io.read_csv(spark, path))))


@registered
def csv_mixed_headers(spark, sf_dir):
    """CSV files whose headers differ in order and extent, read together."""
    path = shared_dir(spark, "csv-mixed")
    _write_mixed_csv(spark, sf_dir, path)
    return _stored_form(store.accepted(store.validate(io.read_csv(spark, f"{path}/*"))))


@registered
def import_folder_csv(spark, sf_dir):
    """What becomes of the entries in CSV files with different headers."""
    path = shared_dir(spark, "import-csv")
    _write_mixed_csv(spark, sf_dir, path)
    checked = store.validate(io.read_csv(spark, f"{path}/*"))
    return store.import_outcomes(checked, P.view(spark, sf_dir, "p_store_hashes"))


def _write_mixed_csv(spark, sf_dir, path):
    flat = io.flatten_entries(P.entries(spark, sf_dir)).persist(StorageLevel.DISK_ONLY)  # written three times
    part = F.pmod(F.col("_id").cast("long"), F.lit(3))
    for n, columns in enumerate((flat.columns, flat.columns[::-1], [c for c in flat.columns if c != "labels_code_style"])):
        flat.filter(part == n).select(*columns).write.options(**io.CSV_WRITE).csv(f"{path}/{n}")
    flat.unpersist()


#: Folders that documents with a file each are dealt to. A folder is written by one task, so that it
#: comes to its place as a whole and not file by file.
FOLDERS = 256


@registered
def import_folder_json(spark, sf_dir):
    """What becomes of a folder of JSON documents, a file each, some of them broken and some invalid."""
    path = shared_dir(spark, "import-json")
    number = F.col("_id").cast("long")
    docs = io.readable_documents(P.entries(spark, sf_dir)).withColumn(
        "code_hash", F.when(F.pmod(number, F.lit(13)) == 5, F.lit("none")).otherwise(F.col("code_hash")))
    value = F.when(F.pmod(number, F.lit(11)) == 3, F.lit('{"code_original": ["int')).otherwise(F.to_json(F.struct("*")))
    folder = F.pmod(F.xxhash64("_id"), F.lit(FOLDERS)).alias("folder")
    io.write_text_files(docs.select(value.alias("value"), folder), path)
    checked = store.validate(io.read_json_documents(spark, path, "*.txt"))
    return store.import_outcomes(checked, P.view(spark, sf_dir, "p_store_hashes"))


@registered
def json_document_files(spark, sf_dir):
    """Entries written as JSON documents, read back and checked."""
    path = shared_dir(spark, "json-documents")
    io.write_json_documents(P.entries(spark, sf_dir), path)
    return _stored_form(store.accepted(store.validate(io.read_json_lines(spark, path))))


@registered
def query_result_file(spark, sf_dir):
    """The result of a filter written as documents, read back and checked."""
    path = shared_dir(spark, "query-result")
    found = query.find(P.entries(spark, sf_dir), {"labels.groups.logic_error": True, "labels.cppcheck": "memleak"})
    io.write_json_documents(found, path)
    return _stored_form(store.accepted(store.validate(io.read_json_lines(spark, path))))


@registered
def readable_json_files(spark, sf_dir):
    """Readable documents, one per content hash, read back: code as lists of lines."""
    path = shared_dir(spark, "readable-json")
    io.write_readable_json(P.entries(spark, sf_dir), path)
    back = spark.read.schema("file_name string, code_hash string, code_original array<string>, code_fixed array<string>").json(path)
    lines = [X.sha256_hex(F.array_join(c, "|")).alias(f"{c}_lines") for c in ("code_original", "code_fixed")]
    return back.select("file_name", "code_hash", F.size("code_original").alias("n_lines"), *lines)


@registered
def json_lines_files(spark, sf_dir):
    """Entries exported in order as JSON lines, read back and checked."""
    path = shared_dir(spark, "json-lines-files")
    io.write_json_lines(P.entries(spark, sf_dir), path)
    return _stored_form(store.accepted(store.validate(io.read_json_lines(spark, path))))


@registered
def document_report(spark, sf_dir):
    """Totals over JSON documents: labels in list form, in old map form, and none."""
    stored = P.view(spark, sf_dir, "p_entries")
    issues = F.filter(F.array("issue_1", "issue_2", "issue_3"), lambda i: i.isNotNull())
    listed = F.concat(F.lit('{"labels":{"groups":{},"cppcheck":'), F.to_json(issues), F.lit("}}"))
    texts = stored.select(
        F.when(F.col("doc_id") % 5 == 4, F.lit('{"labels":{}}'))
        .when(F.col("doc_id") % 5 == 3, F.lit('{"labels":{"cppcheck":{"old":2},"groups":{"code_style":1}}}'))
        .otherwise(listed).alias("value")
    )
    documents = io.report_documents(texts)
    return report.label_totals(documents, report.issue_map(F.col("cppcheck_json")))


@registered
def entry_defaults(spark, sf_dir):
    """Labels that were never set read as no issues, no clang findings and no flags."""
    stored = P.entries(spark, sf_dir).withColumn(
        "labels", F.when(F.substring("entry_id", -1, 1).cast("int") % 2 == 0, F.col("labels"))
    )
    return store.with_defaults(stored).select(
        "entry_id", _joined("labels.cppcheck").alias("cppcheck"), "labels.clang",
        "labels.groups.memory_management", "labels.groups.code_style",
    )


def _stored_form(entries):
    return entries.select(
        "code_hash", X.sha256_hex("code_original").alias("original_hash"), X.sha256_hex("code_fixed").alias("fixed_hash"),
        "repo.url", "repo.commit_hash", F.date_format("repo.commit_date", "yyyy-MM-dd HH:mm:ss").alias("committed"),
        F.date_format("ingest_timestamp", "yyyy-MM-dd HH:mm:ss").alias("ingested"),
        _joined("labels.cppcheck").alias("cppcheck"), "labels.clang",
        _joined(F.filter(F.array(*[F.when(F.col(f"labels.groups.{g}"), F.lit(g)) for g in GROUPS]), lambda g: g.isNotNull()))
        .alias("flags"),
    )


# --- training and evaluation -------------------------------------------------------

def _rows(spark, sf_dir):
    return dataset.training_rows(P.entries(spark, sf_dir))


@registered
def active_label_titles(spark, sf_dir):
    return P.entries(spark, sf_dir).select("entry_id", active_label().alias("label"))


@registered
def training_rows(spark, sf_dir):
    return _rows(spark, sf_dir).select(
        "sample_id", "label", X.sha256_hex("code_original").alias("original_hash"),
        X.sha256_hex("code_fixed").alias("fixed_hash"),
    )


@registered
def prompts(spark, sf_dir):
    out = dataset.prompts(_rows(spark, sf_dir))
    return out.select("sample_id", F.length("text").alias("n_chars"), X.sha256_hex("text").alias("text_hash"))


@registered
def prompts_inference(spark, sf_dir):
    out = dataset.prompts(_rows(spark, sf_dir), with_label=False)
    return out.select("sample_id", F.length("text").alias("n_chars"), X.sha256_hex("text").alias("text_hash"))


@registered
def label_distribution(spark, sf_dir):
    return dataset.label_distribution(_rows(spark, sf_dir)).orderBy("label")


@registered
def stratified_split(spark, sf_dir):
    return dataset.stratified_split(_rows(spark, sf_dir)).select("sample_id", "label", "split")


@registered
def split_distribution(spark, sf_dir):
    return dataset.label_distribution(dataset.stratified_split(_rows(spark, sf_dir)), "split")


def _scored(spark, sf_dir, raw="raw_prediction"):
    answers = P.view(spark, sf_dir, "p_predictions").withColumn("raw_prediction", F.col(raw))
    return evaluate.parsed(answers)


@registered
def parsed_predictions(spark, sf_dir):
    return _scored(spark, sf_dir).select("sample_id", "predicted_label")


@registered
def scored_samples(spark, sf_dir):
    """Truth joined with predictions by sample."""
    rows = P.view(spark, sf_dir, "p_predictions")
    truth = rows.select("sample_id", F.col("true_label").alias("label"))
    return evaluate.parsed(evaluate.score(truth, rows)).select("sample_id", "true_label", "predicted_label")


@registered
def accuracy(spark, sf_dir):
    return evaluate.accuracy(_scored(spark, sf_dir)).withColumn("accuracy", F.round("accuracy", 6))


@registered
def confusion_matrix(spark, sf_dir):
    return evaluate.confusion_matrix(_scored(spark, sf_dir))


@registered
def actual_vs_predicted(spark, sf_dir):
    return evaluate.actual_vs_predicted(_scored(spark, sf_dir))


@registered
def classification_report(spark, sf_dir):
    out = evaluate.classification_report(_scored(spark, sf_dir))
    return out.select("label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1_score")], "support")


@registered
def per_category_accuracy(spark, sf_dir):
    out = evaluate.per_category_accuracy(_scored(spark, sf_dir, "raw_baseline"), _scored(spark, sf_dir))
    return out.select(
        "label", "baseline_support", "tuned_support",
        *[F.round(f"{m}_accuracy", 6).alias(f"{m}_accuracy") for m in ("baseline", "tuned")],
    )


@registered
def model_comparison(spark, sf_dir):
    out = evaluate.model_comparison(_scored(spark, sf_dir, "raw_baseline"), _scored(spark, sf_dir))
    return out.select(
        "baseline_correct", "tuned_correct", "baseline_total", "tuned_total", "correct_change", "verdict",
        *[F.round(c, 6).alias(c) for c in
          ("baseline_accuracy", "tuned_accuracy", "accuracy_change", "relative_change")],
    )


# --- streaming -----------------------------------------------------------------

#: Candidates that one file, and so the task that writes it, holds, and bytes of their texts.
ROWS_PER_FILE, BYTES_PER_FILE = 250_000, 200_000_000


def _write_candidates(candidates, path, files):
    """Adds candidates to those of a stream, as so many files or as many as their number and their texts ask for."""
    texts = [F.coalesce(F.octet_length(c).cast("long"), F.lit(0)) for c, kind in candidates.dtypes if kind == "string"]
    size = candidates.agg(F.count(F.lit(1)).alias("n"), F.sum(sum(texts, F.lit(0).cast("long"))).alias("n_bytes")).first()
    files = max(files, math.ceil(size["n"] / ROWS_PER_FILE), math.ceil((size["n_bytes"] or 0) / BYTES_PER_FILE))
    candidates.repartition(files).write.mode("append").parquet(path)


@registered
def stream_ingest(spark, sf_dir):
    """Candidate files taken up by a stream in several batches; the store at its end."""
    root = shared_dir(spark, "stream-ingest")
    _write_candidates(P.stream_candidates(spark, sf_dir), f"{root}/candidates", 4)
    running = stream.ingest_stream(
        stream.read_candidates(spark, f"{root}/candidates", files_per_batch=2),
        f"{root}/store", f"{root}/checkpoint", P.taxonomy(spark, sf_dir), now=NOW,
    )
    stream.finish(running)
    return _stored_by_stream(spark, f"{root}/store")


def _stored_by_stream(spark, path):
    return io.read_store(spark, path).select(
        "entry_id", "code_hash", _joined("labels.cppcheck").alias("cppcheck"),
        "labels.groups.memory_management", "labels.groups.invalid_access",
    )


@registered
def stream_ingest_two_runs(spark, sf_dir):
    """One store filled by a batch and then by two streams with checkpoints of their own."""
    root, taxonomy = shared_dir(spark, "stream-two-runs"), P.taxonomy(spark, sf_dir)
    candidates = P.stream_candidates(spark, sf_dir)
    part = F.pmod(F.col("sha").cast("long"), F.lit(3))
    first = candidates.filter(part == 0)
    fresh = ingest.new_entries(
        first.drop("before_lines", "after_lines"), stream.diagnostic_rows(first), taxonomy,
        io.open_store(spark, f"{root}/store"), NOW)
    ingest.append_entries(fresh, f"{root}/store")
    for n in (1, 2):
        _write_candidates(candidates.filter(part == n), f"{root}/candidates-{n}", 2)
        stream.finish(stream.ingest_stream(
            stream.read_candidates(spark, f"{root}/candidates-{n}", files_per_batch=1),
            f"{root}/store", f"{root}/checkpoint-{n}", taxonomy, now=NOW))
    return _stored_by_stream(spark, f"{root}/store")


@registered
def stream_remembering(spark, sf_dir):
    """Candidates that come several times, in several batches and after a restart, taken once from streaming state."""
    root, taxonomy = shared_dir(spark, "stream-remembering"), P.taxonomy(spark, sf_dir)
    candidates = P.stream_candidates(spark, sf_dir)
    part = F.pmod(F.col("sha").cast("long"), F.lit(4))
    for chosen in (part < 3, part > 0):  # half of them come again
        _write_candidates(candidates.filter(chosen), f"{root}/candidates", 2)
        stream.finish(stream.ingest_stream(
            stream.read_candidates(spark, f"{root}/candidates", files_per_batch=1),
            f"{root}/store", f"{root}/checkpoint", taxonomy, now=NOW, within="6 hours"))
    return _stored_by_stream(spark, f"{root}/store")


@registered
def stream_target(spark, sf_dir):
    """Entries after a run with a target of 50, and after it went on without one."""
    root, taxonomy = shared_dir(spark, "stream-target"), P.taxonomy(spark, sf_dir)
    _write_candidates(P.stream_candidates(spark, sf_dir), f"{root}/candidates", 4)
    counts = []
    for name, target in (("at_target", 50), ("in_the_end", None)):
        stream.finish(stream.ingest_stream(
            stream.read_candidates(spark, f"{root}/candidates", files_per_batch=1),
            f"{root}/store", f"{root}/checkpoint", taxonomy, target=target, now=NOW))
        n = io.read_store(spark, f"{root}/store").count()
        counts.append((name, n))
    return spark.createDataFrame(counts, "moment string, n_entries long")


@registered
def stream_from_settings(spark, sf_dir):
    """Entries per repository after a run as a configuration file says, with room for all, and after one with a target."""
    root, taxonomy = shared_dir(spark, "stream-settings"), P.taxonomy(spark, sf_dir)
    _write_candidates(P.stream_candidates(spark, sf_dir), f"{root}/candidates", 4)
    counts = []
    for name, target in (("all", 1_000_000_000), ("target", 40)):
        rules = '[{"url": "https://github.com/o/src1"}, "https://github.com/o/src2.git", {"start_date": "2020-01-01"}, ' \
            '{"url": "https://github.com/o/src3", "start_date": "1990-01-01", "end_date": "2024-01-01"}]'
        text = f'{{"repositories": {rules}, "target_record_count": {target}, "queue_max_size": 2}}'
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{root}/{name}")
        stream.finish(stream.ingest_from_settings(
            spark, f"{root}/{name}/*.txt", f"{root}/candidates", f"{root}/store-{name}", f"{root}/checkpoint-{name}", taxonomy, now=NOW))
        stored = io.read_store(spark, f"{root}/store-{name}")
        others = ~F.col("repo.url").isin(*[f"https://github.com/o/src{n}" for n in (1, 2, 3)])
        counts.append(stored.agg(F.lit(name).alias("run"), F.count(F.lit(1)).alias("n_entries"), F.count_if(others).alias("n_others")))
    return counts[0].union(counts[1])


# --- the store in place ----------------------------------------------------------

def _entries_kept(spark, sf_dir):
    """The fixture's entries on the executors' disks, for queries that read them several times."""
    return P.entries(spark, sf_dir).persist(StorageLevel.DISK_ONLY)


def _once_kept(spark, sf_dir):
    """As ``_entries_kept``, one per hash."""
    return store.one_per_hash(P.entries(spark, sf_dir)).persist(StorageLevel.DISK_ONLY)


def _filled_store(once, path):
    """A store of entries with unique hashes, in two parts, written from where they are."""
    half = F.pmod(F.xxhash64("code_hash"), F.lit(2)) == 0
    io.write_store(once.filter(half), path, as_dealt=True)
    io.write_store(once.filter(~half), path, "append", as_dealt=True)
    return path


@registered
def append_to_store(spark, sf_dir):
    """A store of labelled texts takes up all entries; those it has already are found by prefix and filter."""
    path = shared_dir(spark, "append-store")
    entries = _entries_kept(spark, sf_dir)
    once = store.one_per_hash(entries)
    io.write_store(once.join(P.view(spark, sf_dir, "p_store_hashes"), "code_hash", "left_semi").select(*once.columns), path)
    before = io.read_store(spark, path).count()
    inserted = ingest.append_entries(entries, path)
    again = ingest.append_entries(entries, path)
    entries.unpersist()
    return io.read_store(spark, path).agg(
        *[F.lit(v).cast("long").alias(k) for k, v in (("n_before", before), ("n_inserted", inserted), ("n_again", again))],
        F.count(F.lit(1)).alias("n_entries"), F.count_distinct("code_hash").alias("n_hashes"))


@registered
def update_in_place(spark, sf_dir):
    """The store after updates that rewrite the partitions they touch; some hashes change."""
    once = _once_kept(spark, sf_dir)
    path = _filled_store(once, shared_dir(spark, "update-store"))
    once.unpersist()
    updates = P.updates(spark, sf_dir).unionByName(P.hash_updates(spark, sf_dir))
    store_files.update_store(spark, path, updates)
    return io.read_store(spark, path).select(
        "entry_id", "code_hash", X.sha256_hex("code_fixed").alias("fixed_hash"), "repo.commit_hash",
        "labels.groups.concurrency", "labels.groups.memory_management", "labels.clang")


@registered
def patch_in_place(spark, sf_dir):
    """The store after label edits that rewrite the partitions they touch."""
    once = _once_kept(spark, sf_dir)
    path = _filled_store(once, shared_dir(spark, "patch-store"))
    once.unpersist()
    store_files.patch_store(spark, path, P.edits(spark, sf_dir))
    return io.read_store(spark, path).select(
        "entry_id", _joined("labels.cppcheck").alias("cppcheck"), "labels.groups.memory_management",
        "labels.groups.concurrency", "labels.groups.logic_error")


@registered
def delete_in_place(spark, sf_dir):
    """The store after deletions, and after the same entries came again."""
    once = _once_kept(spark, sf_dir)
    path = _filled_store(once, shared_dir(spark, "delete-store"))
    ids = P.view(spark, sf_dir, "p_edits").select("entry_id").distinct()
    deleted = store_files.delete_from_store(spark, path, ids).count()
    left = io.read_store(spark, path).select("entry_id", "code_hash", F.lit("left").alias("moment"))
    left = settle(left.withColumn("n_deleted", F.lit(deleted).cast("long")), "left")
    back = ingest.append_entries(once, path)
    once.unpersist()
    return left.union(io.read_store(spark, path).select("entry_id", "code_hash", F.lit("back"), F.lit(back).cast("long")))


@registered
def ingest_rate(spark, sf_dir):
    rates = stream.ingest_rate(P.view(spark, sf_dir, "p_predictions"))
    return rates.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


