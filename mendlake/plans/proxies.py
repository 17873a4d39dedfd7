"""Views that give the driver tables the shapes this library works on.

Each is one SQL text that Spark and DuckDB both run, apart from the name of the
hash function, so a query and its check start from the same rows. Names in
braces are tables or other views.
"""

import re

from pyspark.sql import functions as F

from mendlake.schema import GROUPS
from mendlake.sources import blobs

TABLES = ("documents", "events", "labels", "lineitem", "orders", "part")

# A taxonomy in small, with ignored, dropped and unmapped issue ids.
VIEWS = {
    "p_taxonomy": """
SELECT * FROM (VALUES (0,'memleak','memory_management'),(1,'doubleFree','memory_management'),
(2,'nullPointer','invalid_access'),(3,'uninitvar','uninitialized'),(4,'localMutex','concurrency'),
(5,'zerodiv','logic_error'),(6,'useClosedFile','resource_leak'),(7,'integerOverflow','security_portability'),
(8,'unusedVariable','unused_code'),(9,'constParameter','const_correctness'),(10,'redundantCopy','redundant_code'),
(11,'stlSize','stl_misuse'),(12,'missingOverride','class_design'),(13,'cstyleCast','code_style'),
(14,'syntaxError','(ignored)'),(15,'checkersReport','(dropped)'),(16,'someNewCheck','(unmapped)'))
AS t(k, issue_id, category)""",

    "p_diagnostics": """
SELECT l_orderkey AS pair_id, CASE WHEN l_linestatus = 'O' THEN 'before' ELSE 'after' END AS side,
  l_linenumber AS line_no,
  CASE WHEN (l_suppkey * 31 + l_partkey) % 211 = 0 THEN 'timeout' ELSE 'ok' END AS status,
  CASE WHEN l_suppkey % 11 = 0 THEN '    int x = a[idx];' WHEN l_suppkey % 11 = 1 THEN 'no bracket here'
    ELSE '/tmp/t.cpp:' || l_linenumber || ':1: warning: text [' || t.issue_id || ']' END AS line
FROM {lineitem} l JOIN {p_taxonomy} t ON l_partkey % 17 = t.k
UNION ALL SELECT DISTINCT l_orderkey, 'after', CAST(NULL AS INTEGER), 'ok', CAST(NULL AS VARCHAR(30)) FROM {lineitem} WHERE l_orderkey % 3 = 0""",

    "p_clang": """
SELECT l_orderkey AS pair_id, l_linenumber AS line_no, l_partkey, l_suppkey,
  CASE l_suppkey % 9
    WHEN 0 THEN 'a.cpp:' || l_linenumber || ':3: warning: use of [x] here  [bugprone-check-' || (l_partkey % 7) || ']'
    WHEN 1 THEN 'a.cpp:1:1: fatal error: ''b.h'' file not found [clang-diagnostic-error]'
    WHEN 2 THEN 'a.cpp:1:1: error: expected expression'
    WHEN 3 THEN 'a.cpp:' || l_linenumber || ':9: warning: plain text '
    WHEN 4 THEN 'note: nothing to see [note]'
    WHEN 5 THEN 'a.cpp:2:2: error: bad type [clang-diagnostic-' || (l_partkey % 5) || '] (see below)'
    WHEN 6 THEN 'warning: first warning: second'
    WHEN 7 THEN '''#include'' file not found: warning: x [y]'
    ELSE '  int y = b[i];' END AS line
FROM {lineitem}""",

    "p_commits": """
SELECT 'https://github.com/o/r' || (o_custkey % 6) || CASE WHEN o_custkey % 6 = 3 THEN '.git' ELSE '' END AS repo_url,
  o_orderkey AS sha, CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_orderkey - 1 END AS parent_sha,
  o_orderdate AS author_date,
  CASE o_orderkey % 6 WHEN 0 THEN 'Fix crash in parser' WHEN 1 THEN 'Prefix the paths' WHEN 2 THEN 'docs: tidy'
    WHEN 3 THEN 'title' || chr(10) || 'BUG 42' WHEN 4 THEN 'patched the leak' ELSE 'debugging notes' END AS message
FROM {orders}""",

    "p_commit_files": """
SELECT l_orderkey AS sha,
  ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice,
    l_shipdate, l_quantity, l_discount, l_tax) AS ordinal,
  'src/d' || (l_partkey % 3) || '/f' || (l_partkey % 4) || CASE l_suppkey % 8 WHEN 0 THEN '.cpp' WHEN 1 THEN '.h'
    WHEN 2 THEN '.cc' WHEN 3 THEN '.hpp' WHEN 4 THEN '_latest.cpp' WHEN 5 THEN '.py' WHEN 6 THEN '.CPP'
    ELSE '.cxx' END AS path,
  CASE l_returnflag WHEN 'R' THEN 'removed' WHEN 'A' THEN 'added' ELSE 'modified' END AS status
FROM {lineitem}""",

    "p_repo_files": """
SELECT c.repo_url, c.parent_sha, f.sha, f.ordinal, f.path, f.status
FROM {p_commit_files} f JOIN {p_commits} c ON c.sha = f.sha""",

    "p_repo_tree": """
SELECT repo_url, path, ROW_NUMBER() OVER (PARTITION BY repo_url ORDER BY path) AS ordinal
FROM (SELECT DISTINCT 'https://github.com/o/r' || (p_partkey % 6) || CASE WHEN p_partkey % 6 = 3 THEN '.git' ELSE '' END AS repo_url,
  'src/d' || (p_size % 2) || '/f' || (p_partkey % 7) || CASE p_size % 5 WHEN 0 THEN '.cpp' WHEN 1 THEN '.h'
    WHEN 2 THEN '.cc' WHEN 3 THEN '.hpp' ELSE '.cxx' END AS path FROM {part}) x""",

    "p_blob_keys": """
SELECT DISTINCT repo_url, sha, path FROM {p_repo_files}
UNION SELECT DISTINCT repo_url, parent_sha AS sha, path FROM {p_repo_files} WHERE parent_sha IS NOT NULL""",

    "p_blobs": """
SELECT k.repo_url, k.sha, k.path, d.text AS content FROM {p_blob_docs} k JOIN {documents} d ON d.doc_id = k.doc""",

    # The document that a file's content is, without the text.
    "p_blob_docs": """
SELECT k.repo_url, k.sha, k.path,
  ((sha - sha % 3) * 7 + length(path) + ascii(substring(path, 6, 1))) % (SELECT count(*) + 7 FROM {documents}) AS doc FROM {p_blob_keys} k""",

    "p_entries": """
SELECT d.doc_id, lpad(CAST(d.doc_id AS VARCHAR(30)), 24, '0') AS entry_id, d.text AS code_original,
  CASE WHEN d.doc_id % 10 = 0 THEN NULL WHEN d.doc_id % 10 = 1 THEN '' ELSE n.text END AS code_fixed,
  SHA256HEX(d.text) AS code_hash, 'https://github.com/o/' || d.source AS repo_url,
  CAST(d.doc_id % 97 AS VARCHAR(30)) AS commit_hash, e.ts AS ingest_timestamp,
  d.doc_id % 2 = 0 AS memory_management, d.doc_id % 3 = 0 AS invalid_access, false AS uninitialized,
  coalesce(l.toxic, 0) = 1 AS concurrency, coalesce(l.quality, 0) = 1 AS logic_error,
  d.doc_id % 7 = 0 AS resource_leak, false AS security_portability, d.doc_id % 11 = 0 AS unused_code,
  d.doc_id % 13 = 0 AS const_correctness, d.doc_id % 2 = 0 AS redundant_code, d.doc_id % 6 = 0 AS stl_misuse,
  false AS class_design, d.doc_id % 5 = 1 AS code_style,
  CASE WHEN d.doc_id % 2 = 0 THEN 'memleak' END AS issue_1, CASE WHEN d.doc_id % 3 = 0 THEN 'nullPointer' END AS issue_2,
  CASE WHEN d.doc_id % 5 = 1 THEN 'cstyleCast' END AS issue_3
FROM {documents} d LEFT JOIN {documents} n ON n.doc_id = d.doc_id + 1
LEFT JOIN {events} e ON e.event_id = d.doc_id LEFT JOIN {labels} l ON l.doc_id = d.doc_id""",

    "p_predictions": """
SELECT event_id AS sample_id, ts AS ingest_timestamp,
  CASE event_type WHEN 'signup' THEN 'Memory Management' WHEN 'purchase' THEN 'Invalid Access'
    WHEN 'error' THEN 'Concurrency' WHEN 'view' THEN 'Logic Error' ELSE 'Security/Portability' END AS true_label,
  CASE (event_id * 7 + user_id) % 9 WHEN 0 THEN 'Memory Management' WHEN 1 THEN 'invalid access.'
    WHEN 2 THEN 'I think a race condition' WHEN 3 THEN ' Logic Error' || chr(10) || 'because'
    WHEN 4 THEN 'It is Security/Portability!' WHEN 5 THEN 'thread leak' WHEN 6 THEN 'banana' WHEN 7 THEN ''
    ELSE 'Uninitialized' END AS raw_prediction,
  CASE WHEN event_id % 3 = 0 THEN 'logic' WHEN event_type = 'error' THEN 'Concurrency!' ELSE 'memory' END AS raw_baseline
FROM {events}""",

    "p_edits": """
SELECT lpad(CAST(user_id * 10 AS VARCHAR(30)), 24, '0') AS entry_id, event_id AS seq,
  CASE event_type WHEN 'signup' THEN 'MemError' WHEN 'purchase' THEN 'customLabel' WHEN 'error' THEN 'Concurrency'
    WHEN 'view' THEN 'nullPointer' ELSE 'CodeQualityPerformance' END AS add_label,
  CASE event_id % 7 WHEN 0 THEN 'LogicError' WHEN 1 THEN 'customLabel' WHEN 2 THEN 'memleak' WHEN 3 THEN 'memory_management'
    WHEN 4 THEN 'nullPointer' ELSE NULL END AS remove_label
FROM {events}""",

    "p_updates": """
SELECT lpad(CAST(user_id * 10 AS VARCHAR(30)), 24, '0') AS entry_id, event_id AS seq,
  CASE event_type WHEN 'signup' THEN 'code_fixed' WHEN 'purchase' THEN 'repo.commit_hash'
    WHEN 'error' THEN 'labels.groups.concurrency' WHEN 'view' THEN 'labels.groups.memory_management'
    ELSE 'labels.clang' END AS path,
  CASE event_type WHEN 'signup' THEN CASE WHEN event_id % 2 = 0 THEN NULL ELSE 'int y;' END
    WHEN 'purchase' THEN CASE WHEN event_id % 7 = 3 THEN NULL ELSE CAST(event_id % 5 AS VARCHAR(30)) END
    WHEN 'error' THEN CASE WHEN event_id % 5 = 2 THEN 'banana' ELSE 'true' END
    WHEN 'view' THEN CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END ELSE '{{}}' END AS value
FROM {events}""",

    # New hashes for some entries: free ones, one that another entry has, and one for two entries.
    "p_hash_updates": """
SELECT entry_id, 1000000000 + doc_id AS seq, CASE doc_id % 40 WHEN 3 THEN SHA256HEX(CAST(doc_id AS VARCHAR(30)))
  WHEN 11 THEN (SELECT min(code_hash) FROM {p_entries}) ELSE SHA256HEX('two' || CAST(doc_id - doc_id % 40 AS VARCHAR(30))) END AS value
FROM {p_entries} WHERE doc_id % 40 IN (3, 11, 17, 23)""",

    "p_wire": """
SELECT doc_id, CASE WHEN doc_id % 17 = 3 THEN NULL ELSE code_original END AS code_original, code_fixed,
  CASE doc_id % 19 WHEN 4 THEN upper(code_hash) WHEN 5 THEN substring(code_hash, 1, 63) WHEN 6 THEN code_hash || 'a'
    WHEN 7 THEN 'g' || substring(code_hash, 2, 63) WHEN 8 THEN NULL ELSE code_hash END AS code_hash,
  CASE WHEN doc_id % 23 = 2 THEN NULL ELSE repo_url END AS repo_url, commit_hash,
  CASE doc_id % 29 WHEN 1 THEN 'yesterday' WHEN 2 THEN '2024-02-30' WHEN 3 THEN '2024-01-10T12:00:00Z'
    WHEN 4 THEN '2024-13-01' WHEN 5 THEN NULL WHEN 6 THEN '2024-01-10T12:00:00+02:00' ELSE '2024-01-10' END AS commit_date,
  '2024-01-15T09:30:00Z' AS ingest_timestamp,
  CASE doc_id % 31 WHEN 9 THEN 'maybe' WHEN 10 THEN '1' WHEN 11 THEN 'TRUE' ELSE CAST(memory_management AS VARCHAR(30)) END
    AS memory_management,
  CASE doc_id % 37 WHEN 8 THEN '[]' WHEN 9 THEN 'oops' ELSE '{{}}' END AS clang
FROM {p_entries}""",

    # Findings depend on the text alone, so copies of a text have the same.
    "p_stream": """
SELECT d.doc_id, d.text AS code_original, CASE length(d.text) % 7 WHEN 3 THEN NULL WHEN 4 THEN '' ELSE d.text || chr(10) || 'fixed' END AS code_fixed,
  SHA256HEX(d.text) AS code_hash,
  'https://github.com/o/' || d.source AS repo_url, e.ts AS commit_date,
  CASE WHEN length(d.text) % 2 = 0 THEN 'memleak' ELSE 'checkersReport' END AS before_1,
  CASE WHEN length(d.text) % 3 = 0 THEN 'nullPointer' ELSE 'syntaxError' END AS before_2,
  CASE WHEN length(d.text) % 4 = 0 THEN 'memleak' ELSE 'someNewCheck' END AS after_1
FROM {documents} d LEFT JOIN {events} e ON e.event_id = d.doc_id""",

    "p_store_hashes": """
SELECT DISTINCT SHA256HEX(d.text) AS code_hash FROM {documents} d JOIN {labels} l ON l.doc_id = d.doc_id""",

    "p_rules": """
SELECT 'https://github.com/o/r' || k || CASE WHEN k = 3 THEN '.git' ELSE '' END AS url,
  CAST(start_date AS DATE) AS start_date, CAST(end_date AS DATE) AS end_date, p1, p2, p3
FROM (VALUES (0,'1990-01-01',NULL,'\\\\bfix(es|ed)?\\\\b','\\\\bbug(s)?\\\\b','\\\\bpatch(ed)?\\\\b'),
(1,'1996-01-01','1999-12-31','\\\\bfix(es|ed)?\\\\b','\\\\bbug(s)?\\\\b','\\\\bpatch(ed)?\\\\b'),
(2,NULL,NULL,'\\\\bfix(es|ed)?\\\\b','\\\\bbug(s)?\\\\b','\\\\bpatch(ed)?\\\\b'),
(3,'1990-01-01','2001-08-01','\\\\bleak','^bug',NULL),(4,'1990-01-01',NULL,NULL,NULL,NULL)) AS t(k, start_date, end_date, p1, p2, p3)""",
}


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark, sf_dir, name):
    """A driver table or proxy view as a DataFrame."""
    if name not in VIEWS:
        return table(spark, sf_dir, name)
    if name in BUILT:
        return BUILT[name](spark, sf_dir)
    return _from_sql(spark, VIEWS[name], lambda n: view(spark, sf_dir, n))


def _from_sql(spark, sql, named):
    sql = re.sub(r"SHA256HEX(\((?:[^()]|\((?:[^()]|\([^()]*\))*\))*)\)", r"sha2\1, 256)", sql)
    return spark.sql(sql, **{n: named(n) for n in sorted(set(re.findall(r"{(\w+)}", sql)))})


def _p_entries(spark, sf_dir):
    """The rows of ``p_entries``. Dates and labels, all narrow, meet the two texts by the number of the next
    document, so each text moves once as the original and once as the fix; without texts nothing wide moves."""
    documents, follows = table(spark, sf_dir, "documents"), (F.col("doc_id") + 1).alias("_next")
    events = table(spark, sf_dir, "events").select(F.col("event_id").alias("doc_id"), "ts")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic", "quality")
    named = {
        "d": documents.select("doc_id", "text", "source", F.sha2("text", 256).alias("code_hash"), follows),
        "n": documents.select("doc_id", "text"),
        "beside": documents.select("doc_id").distinct().join(events, "doc_id", "left").join(labels, "doc_id", "left")
        .select(follows, "ts", "toxic", "quality"),
    }
    columns = VIEWS["p_entries"].split("FROM {documents}")[0].replace("SHA256HEX(d.text)", "d.code_hash")
    columns = re.sub(r"\bl\.", "e.", columns)
    return _from_sql(
        spark, columns + "FROM {d} d LEFT JOIN {n} n ON n.doc_id = d._next LEFT JOIN {beside} e ON e._next = d._next",
        named.__getitem__)


def _p_blob_keys(spark, sf_dir):
    """The rows of ``p_blob_keys``: a file at its commit and at the parent, from one pass over the files."""
    at = F.explode(F.array_compact(F.array(F.col("sha"), F.col("parent_sha")))).alias("sha")
    return view(spark, sf_dir, "p_repo_files").select("repo_url", at, "path").distinct()


#: Views that Spark builds in another way than their SQL says, with the same rows and fewer moves of them.
BUILT = {"p_entries": _p_entries, "p_blob_keys": _p_blob_keys}


def _uses(sql):
    return {n for n in (*TABLES, *VIEWS) if "{" + n + "}" in sql}


def ctes(*names):
    """``WITH`` clause for DuckDB that defines the views and all that they use."""
    ordered = []

    def visit(name):
        for used in sorted(_uses(VIEWS[name])):
            if used in VIEWS:
                visit(used)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    parts = []
    for name in ordered:
        sql = VIEWS[name].replace("SHA256HEX", "sha256").replace("\\\\", "\\")
        sql = sql.format(**{n: n for n in (*TABLES, *VIEWS)})
        parts.append(f"{name} AS {'MATERIALIZED ' if name == 'p_blob_docs' else ''}({sql.strip()})")
    return "WITH " + ",\n".join(parts) + "\n"


# --- nested shapes, which the two engines write differently --------------------

def taxonomy(spark, sf_dir):
    known = view(spark, sf_dir, "p_taxonomy").filter("category NOT IN ('(dropped)', '(unmapped)')")
    ignored = F.col("category") == "(ignored)"
    return known.select("issue_id", F.when(~ignored, F.col("category")).alias("category"), ignored.alias("ignored"))


def commits(spark, sf_dir):
    parents = F.filter(F.array("parent_sha"), lambda p: p.isNotNull())
    return view(spark, sf_dir, "p_commits").withColumn("parents", parents).drop("parent_sha")


def rules(spark, sf_dir):
    patterns = F.filter(F.array("p1", "p2", "p3"), lambda p: p.isNotNull())
    return view(spark, sf_dir, "p_rules").select("url", "start_date", "end_date", patterns.alias("fix_regexes"))


def blob_store(spark, sf_dir, path):
    """``p_blobs`` by identity in bucketed tables: documents are the contents, so no text is copied per key."""
    documents = table(spark, sf_dir, "documents").select("doc_id", blobs.blob_id(F.col("text")).alias("blob_id"), "text")
    # Of several texts under one number the greatest counts, as where the texts themselves are looked up.
    ids = documents.select("doc_id", "blob_id").distinct()
    several = ids.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("doc_id")
    greatest = documents.join(several, "doc_id", "left_semi").groupBy("doc_id").agg(F.max("text").alias("text"))
    ids = ids.join(several, "doc_id", "left_anti").union(greatest.select("doc_id", blobs.blob_id(F.col("text"))))
    keys = view(spark, sf_dir, "p_blob_docs").join(ids.withColumnRenamed("doc_id", "doc"), "doc").drop("doc")
    contents = documents.select("blob_id", F.coalesce("text", F.lit("")).alias("content")).dropDuplicates(["blob_id"])
    return blobs.write_blobs(keys, contents, path)


def entries(spark, sf_dir):
    """``p_entries`` in stored form, with unique identifiers; hashes repeat."""
    issues = F.filter(F.array("issue_1", "issue_2", "issue_3"), lambda i: i.isNotNull())
    return view(spark, sf_dir, "p_entries").select(
        "entry_id", "code_original", "code_fixed", "code_hash",
        F.struct(F.col("repo_url").alias("url"), "commit_hash",
                 F.col("ingest_timestamp").cast("timestamp").alias("commit_date")).alias("repo"),
        F.col("ingest_timestamp").cast("timestamp").alias("ingest_timestamp"),
        F.struct(issues.alias("cppcheck"), F.lit("{}").alias("clang"),
                 F.struct(*GROUPS).alias("groups")).alias("labels"),
    )


def edits(spark, sf_dir):
    def listed(c):
        return F.filter(F.array(c), lambda x: x.isNotNull())

    return view(spark, sf_dir, "p_edits").select(
        "entry_id", "seq", listed("add_label").alias("add"), listed("remove_label").alias("remove")
    )


def updates(spark, sf_dir):
    return view(spark, sf_dir, "p_updates").select("entry_id", "seq", F.create_map("path", "value").alias("fields"))


def hash_updates(spark, sf_dir):
    rows = view(spark, sf_dir, "p_hash_updates")
    return rows.select("entry_id", "seq", F.create_map(F.lit("code_hash"), "value").alias("fields"))


def wire(spark, sf_dir):
    """``p_wire`` as documents before validation."""
    return view(spark, sf_dir, "p_wire").select(
        "doc_id", "code_original", "code_fixed", "code_hash",
        F.struct(F.col("repo_url").alias("url"), "commit_hash", "commit_date").alias("repo"),
        "ingest_timestamp",
        F.struct(
            F.array().cast("array<string>").alias("cppcheck"), F.col("clang").alias("clang"),
            F.create_map(F.lit("memory_management"), F.col("memory_management")).alias("groups"),
        ).alias("labels"),
    )


def stream_candidates(spark, sf_dir):
    """``p_stream`` with the analyzer lines attached, as the stream reads it."""
    def line(c):
        return F.concat(F.lit("/tmp/t.cpp:1:1: warning: text ["), F.col(c), F.lit("]"))

    return view(spark, sf_dir, "p_stream").select(
        "code_original", "code_fixed", "repo_url", F.col("doc_id").cast("string").alias("sha"),
        F.col("commit_date").cast("timestamp").alias("commit_date"), F.lit("t").alias("base_name"), "code_hash",
        F.sha2(F.concat("code_original", F.lit("\n\n"), F.coalesce("code_fixed", F.lit("-"))), 256).alias("pair_id"),
        F.array(line("before_1"), line("before_2")).alias("before_lines"),
        # What is not there was not analysed.
        F.when(F.col("code_fixed") != "", F.array(line("after_1"))).alias("after_lines"),
    )
