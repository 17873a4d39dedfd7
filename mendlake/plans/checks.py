"""The registered queries again, as single DuckDB statements over the same tables."""

from mendlake.functions import text as X
from mendlake.functions import training as M
from mendlake.plans.proxies import ctes
from mendlake.schema import COARSE_GROUPS, GROUPS, QUALITY_GROUPS, SHARED_GROUPS

CHECKS = {}


def check(name, sql, *views):
    body = (ctes(*views) if views else "") + sql.strip()
    # A statement that goes on with more common tables continues the WITH clause.
    CHECKS[name] = body.replace("\nAND_WITH", ",")


def text(s):
    return "'" + s.replace("'", "''") + "'"


BLANKS = "(" + " || ".join(f"chr({ord(c)})" for c in X.WHITESPACE) + ")"


def strip(c):
    return f"trim({c}, {BLANKS})"


# --- extraction ----------------------------------------------------------------

SLUG = r"regexp_extract(regexp_replace({0}, '\.git$', ''), 'github\.com/([^/]+)/([^/]+)', {1})"
FIX = r"""
AND_WITH chosen AS (
SELECT c.repo_url, c.sha, c.parent_sha, c.author_date, min(r.url) AS rule_url
FROM p_commits c JOIN p_rules r ON regexp_replace(c.repo_url, '\.git$', '') = regexp_replace(r.url, '\.git$', '')
WHERE c.parent_sha IS NOT NULL
AND c.author_date >= coalesce(CAST(r.start_date AS TIMESTAMP), TIMESTAMP '2020-01-01 00:00:00')
AND c.author_date <= coalesce(CAST(r.end_date AS TIMESTAMP) + INTERVAL 1 DAY - INTERVAL 1 MICROSECOND, TIMESTAMP '2001-01-01 00:00:00')
AND ((r.p1 IS NULL AND r.p2 IS NULL AND r.p3 IS NULL)
  OR regexp_matches(c.message, '(?im)' || r.p1) OR regexp_matches(c.message, '(?im)' || r.p2) OR regexp_matches(c.message, '(?im)' || r.p3))
GROUP BY ALL)
"""
for name in ("fix_commits", "fix_commits_from_file"):
    check(name, FIX + """
SELECT repo_url, sha, rule_url, parent_sha, strftime(author_date, '%Y-%m-%d') AS author_date FROM chosen
""", "p_commits", "p_rules")

NAMES = r"""
AND_WITH named AS (
SELECT *, regexp_extract(path, '([^/]*)$', 1) AS file_name,
  regexp_extract(path, '(\.[^./]*)$', 1) AS ext FROM {source}
WHERE status <> 'removed' AND NOT contains(lower(path), 'test')
AND (suffix(path, '.cpp') OR suffix(path, '.cxx') OR suffix(path, '.cc') OR suffix(path, '.h') OR suffix(path, '.hpp'))),
stems AS (
SELECT *, substring(file_name, 1, length(file_name) - length(ext)) AS stem,
  substring(path, 1, length(path) - length(file_name) - 1) AS dir FROM named)
"""
check("source_files", NAMES.format(source="p_commit_files") + "SELECT sha, ordinal, dir, stem, ext FROM stems", "p_commit_files")

FIRST = """,
firsts AS (
SELECT * EXCLUDE (nth) FROM (SELECT *, row_number() OVER (PARTITION BY repo_url, sha, stem ORDER BY ordinal) AS nth FROM stems)
WHERE nth = 1)
"""
check("first_file_per_stem", NAMES.format(source="p_repo_files") + FIRST + "SELECT sha, stem, ordinal, path FROM firsts", "p_repo_files")

PAIRS = r""",
tree AS (
SELECT repo_url, path, ordinal, regexp_extract(path, '(\.[^./]*)$', 1) AS ext,
  regexp_extract(path, '([^/]*)\.[^./]*$', 1) AS stem, regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir FROM p_repo_tree),
matched AS (
SELECT f.repo_url, f.sha, f.ordinal, f.path, t.path AS other, row_number() OVER (PARTITION BY f.repo_url, f.sha, f.ordinal
  ORDER BY CASE WHEN t.dir = f.dir THEN 0 ELSE 1 END,
  CASE WHEN t.dir = f.dir THEN list_position(['.h', '.hpp', '.cpp', '.cxx', '.cc'], t.ext) ELSE t.ordinal END) AS nth
FROM {files} f JOIN tree t ON t.repo_url = f.repo_url AND t.stem = f.stem
AND (t.ext IN ('.h', '.hpp')) = (f.ext NOT IN ('.h', '.hpp'))),
paired AS (
SELECT f.*, CASE WHEN f.ext IN ('.h', '.hpp') THEN f.path ELSE m.other END AS header_path,
  CASE WHEN f.ext IN ('.h', '.hpp') THEN m.other ELSE f.path END AS impl_path
FROM {files} f LEFT JOIN matched m ON m.repo_url = f.repo_url AND m.sha = f.sha AND m.ordinal = f.ordinal AND m.nth = 1)
"""
check("header_impl_pairs", NAMES.format(source="p_repo_files") + PAIRS.format(files="stems") +
      "SELECT sha, ordinal, header_path, impl_path FROM paired", "p_repo_files", "p_repo_tree")

EVENTS = """
AND_WITH places AS (SELECT repo_url, sha, row_number() OVER (PARTITION BY repo_url ORDER BY author_date, sha) AS n FROM p_commits),
events AS (SELECT f.repo_url, f.path, p.n, arg_max(f.status, f.ordinal) <> 'removed' AS present
  FROM p_repo_files f JOIN places p ON p.repo_url = f.repo_url AND p.sha = f.sha GROUP BY f.repo_url, f.path, p.n)
"""
check("path_intervals", EVENTS + """,
turns AS (SELECT * FROM (SELECT *, lag(present) OVER (PARTITION BY repo_url, path ORDER BY n) AS was FROM events)
  WHERE present <> coalesce(was, false)),
ended AS (SELECT *, lead(n) OVER (PARTITION BY repo_url, path ORDER BY n) AS until_n FROM turns)
SELECT e.repo_url, e.path, a.sha AS from_sha, b.sha AS until_sha FROM ended e JOIN places a ON a.repo_url = e.repo_url AND a.n = e.n
LEFT JOIN places b ON b.repo_url = e.repo_url AND b.n = e.until_n WHERE e.present
""", "p_commits", "p_repo_files")
# Every path that could be a counterpart is looked up by its last event up to the commit.
check("tree_at_commits", EVENTS + NAMES.format(source="p_repo_files").replace("AND_WITH", ",", 1) + r""",
paths AS (SELECT DISTINCT repo_url, path, regexp_extract(path, '(\.[^./]*)$', 1) AS ext,
  regexp_extract(path, '([^/]*)\.[^./]*$', 1) AS stem, regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir FROM events),
asked AS (SELECT f.*, p.n FROM stems f JOIN places p ON p.repo_url = f.repo_url AND p.sha = f.sha),
others AS (SELECT a.sha, a.ordinal, a.dir, a.n, t.repo_url, t.path, t.ext, t.dir AS other_dir FROM asked a
  JOIN paths t ON t.repo_url = a.repo_url AND t.stem = a.stem AND t.ext IN ('.h', '.hpp', '.cpp', '.cxx', '.cc')
  AND (t.ext IN ('.h', '.hpp')) = (a.ext NOT IN ('.h', '.hpp'))),
alive AS (SELECT o.* FROM others o ASOF JOIN events e ON e.repo_url = o.repo_url AND e.path = o.path AND o.n >= e.n WHERE e.present),
best AS (SELECT sha, ordinal, path AS other FROM (SELECT *, row_number() OVER (PARTITION BY sha, ordinal ORDER BY
  CASE WHEN other_dir = dir THEN list_position(['.h', '.hpp', '.cpp', '.cxx', '.cc'], ext) ELSE 9 END, path) AS nth FROM alive) WHERE nth = 1)
SELECT a.sha, a.ordinal, CASE WHEN a.ext IN ('.h', '.hpp') THEN a.path ELSE b.other END AS header_path,
  CASE WHEN a.ext IN ('.h', '.hpp') THEN b.other ELSE a.path END AS impl_path
FROM asked a LEFT JOIN best b ON b.sha = a.sha AND b.ordinal = a.ordinal
""", "p_commits", "p_repo_files")

CANDIDATES = FIX + NAMES.format(source="(SELECT f.repo_url, f.sha, f.ordinal, f.path, f.status, c.parent_sha, c.rule_url, c.author_date FROM p_repo_files f JOIN chosen c ON c.repo_url = f.repo_url AND c.sha = f.sha)").replace("AND_WITH", ",", 1) + FIRST + PAIRS.format(files="firsts") + f""",
known AS MATERIALIZED (SELECT b.repo_url, b.sha, b.path, b.doc, coalesce(d.text, '') <> '' AS filled FROM p_blob_docs b JOIN documents d ON d.doc_id = b.doc),
identities AS (
SELECT p.*, hb.doc AS hb, ib.doc AS ib, ha.doc AS ha, ia.doc AS ia
FROM paired p
LEFT JOIN known hb ON hb.repo_url = p.repo_url AND hb.sha = p.parent_sha AND hb.path = p.header_path
LEFT JOIN known ha ON ha.repo_url = p.repo_url AND ha.sha = p.sha AND ha.path = p.header_path
LEFT JOIN known ib ON ib.repo_url = p.repo_url AND ib.sha = p.parent_sha AND ib.path = p.impl_path
LEFT JOIN known ia ON ia.repo_url = p.repo_url AND ia.sha = p.sha AND ia.path = p.impl_path
WHERE coalesce(ha.filled, false) OR coalesce(ia.filled, false)),
blocks AS MATERIALIZED (
SELECT h, i, sha256(code) AS hash, length(code) AS n, row_number() OVER (ORDER BY code) AS place FROM (
  SELECT x.h, x.i, concat_ws(chr(10), nullif({strip("coalesce(h.text, '')")}, ''), nullif({strip("coalesce(i.text, '')")}, '')) AS code
  FROM (SELECT hb AS h, ib AS i FROM identities UNION SELECT ha, ia FROM identities) x
  LEFT JOIN documents h ON h.doc_id = x.h LEFT JOIN documents i ON i.doc_id = x.i) y),
found AS (
SELECT p.repo_url, p.rule_url, p.sha, p.stem, p.author_date, o.hash AS code_hash, f.hash AS fixed_hash, o.n AS n_original, f.n AS n_fixed,
  f.place AS fixed_place
FROM identities p JOIN blocks o ON o.h IS NOT DISTINCT FROM p.hb AND o.i IS NOT DISTINCT FROM p.ib
JOIN blocks f ON f.h IS NOT DISTINCT FROM p.ha AND f.i IS NOT DISTINCT FROM p.ia WHERE o.hash <> f.hash)
"""
CANDIDATE_VIEWS = ("p_commits", "p_rules", "p_repo_files", "p_repo_tree", "p_blob_docs")
check("candidates", CANDIDATES + """
SELECT rule_url AS repo_url, sha, stem AS base_name, code_hash, fixed_hash, n_original, n_fixed FROM found
""", *CANDIDATE_VIEWS)

check("code_hash", "SELECT doc_id, sha256(text) AS code_hash FROM documents")
check("repo_slug", f"""
AND_WITH urls AS (SELECT sha, repo_url FROM p_commits UNION ALL SELECT page_id, url FROM pages)
SELECT sha, repo_url, CASE WHEN {SLUG.format('repo_url', 1)} <> '' THEN {SLUG.format('repo_url', 1)} || '/' || {SLUG.format('repo_url', 2)} END AS slug FROM urls
""", "p_commits")

# Line breaks as one pattern, unlike the replacements in the library.
BREAKS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
check("code_lines", f"""
WITH parts AS (SELECT doc_id, CASE WHEN text = '' THEN CAST([] AS VARCHAR[])
  ELSE string_split_regex(regexp_replace(text, '(?:{BREAKS})$', ''), '{BREAKS}') END AS lines FROM documents)
SELECT doc_id, len(lines) AS n_lines, sha256(array_to_string(lines, '|')) AS lines_hash FROM parts
""")
check("safe_names", r"SELECT page_id, regexp_replace(url, '[^\p{L}\p{N}._-]', '', 'g') AS name FROM pages")

# --- labels --------------------------------------------------------------------

ISSUES = r"""
AND_WITH ids AS (
SELECT pair_id, side, status, nullif(regexp_extract(line, '\[(\w+)\]', 1), '') AS found FROM p_diagnostics),
issues AS (
SELECT pair_id, side, status, CASE WHEN found NOT IN ('missingInclude', 'missingIncludeSystem', 'unmatchedSuppression',
  'checkersReport', 'normalCheckLevelMaxBranches') THEN found END AS issue_id FROM ids)
"""
check("issue_ids", ISSUES + """
SELECT pair_id, side, coalesce(string_agg(DISTINCT issue_id, ',' ORDER BY issue_id), '') AS issues
FROM issues GROUP BY pair_id, side
""", "p_diagnostics")

check("clang_issues", r"""
AND_WITH c AS (
SELECT *, strpos(line, 'warning:') AS w, strpos(line, 'error:') AS e,
  CASE WHEN contains(line, '[') THEN length(line) - strpos(reverse(line), '[') + 1 ELSE 0 END AS o,
  CASE WHEN contains(line, ']') THEN length(line) - strpos(reverse(line), ']') + 1 ELSE 0 END AS z
FROM p_clang WHERE NOT (contains(line, 'fatal error:') AND (contains(line, 'file not found') OR contains(line, 'no such file')))
AND NOT contains(line, '''#include'' file not found'))
SELECT pair_id, line_no, l_partkey, l_suppkey,
  CASE WHEN o > 0 AND z > 0 THEN substring(line, o + 1, greatest(z - o - 1, 0)) ELSE 'generic-warning' END AS id,
  CASE WHEN o > 0 AND z > 0 THEN trim(substring(line, greatest(w, e), o - greatest(w, e)))
    ELSE trim(string_split(line, 'warning:')[2]) END AS message
FROM c WHERE (w > 0 OR e > 0) AND ((o > 0 AND z > 0) OR w > 0)
""", "p_clang")

FIXED = ISSUES + """,
sides AS (
SELECT pair_id, bool_or(side = 'before') AS analysed, bool_or(side = 'before' AND status <> 'ok') AS before_failed,
  bool_or(side = 'after' AND status <> 'ok') AS after_failed, bool_or(side = 'after') AS after_analysed FROM p_diagnostics GROUP BY pair_id),
tax AS (SELECT issue_id, nullif(category, '(ignored)') AS category, category = '(ignored)' AS ignored
  FROM p_taxonomy WHERE category NOT IN ('(dropped)', '(unmapped)')),
gone AS (
SELECT DISTINCT b.pair_id, b.issue_id, t.category FROM issues b JOIN sides s ON s.pair_id = b.pair_id
LEFT JOIN tax t ON t.issue_id = b.issue_id
WHERE b.side = 'before' AND b.issue_id IS NOT NULL AND NOT coalesce(t.ignored, false) AND NOT s.before_failed
AND (s.after_failed OR NOT EXISTS (SELECT 1 FROM issues a WHERE a.pair_id = b.pair_id AND a.side = 'after' AND a.issue_id = b.issue_id))),
kept AS (SELECT * FROM sides WHERE analysed {strict})
"""
STRICT = FIXED.format(strict="AND NOT before_failed AND NOT after_failed AND after_analysed")
LENIENT = FIXED.format(strict="")
for name, base in (("fixed_issues", STRICT), ("fixed_issues_lenient", LENIENT)):
    check(name, base + """
SELECT k.pair_id, coalesce(string_agg(g.issue_id, ',' ORDER BY g.issue_id), '') AS issues
FROM kept k LEFT JOIN gone g ON g.pair_id = k.pair_id GROUP BY k.pair_id
""", "p_diagnostics", "p_taxonomy")

check("known_issues", ISSUES + """
SELECT issue_id, count(*) AS n_issues FROM issues
WHERE issue_id IS NOT NULL AND issue_id NOT IN (SELECT issue_id FROM p_taxonomy WHERE category = '(ignored)') GROUP BY issue_id
""", "p_diagnostics", "p_taxonomy")


def flag_columns(names):
    return ", ".join(f"coalesce(bool_or(g.category = '{g}'), false) AS {g}" for g in names)


for name, names in (("group_flags", GROUPS), ("group_flags_from_file", GROUPS), ("group_flags_reference8", COARSE_GROUPS)):
    check(name, STRICT + f"""
SELECT k.pair_id, {flag_columns(names)} FROM kept k LEFT JOIN gone g ON g.pair_id = k.pair_id GROUP BY k.pair_id
""", "p_diagnostics", "p_taxonomy")

check("fixes_by_category", STRICT + """,
labelled AS (SELECT DISTINCT g.pair_id, g.category FROM gone g JOIN kept k ON k.pair_id = g.pair_id),
names AS (SELECT unnest([""" + ", ".join(f"'{g}'" for g in GROUPS) + """]) AS group_name),
total AS (SELECT count(DISTINCT pair_id) AS n FROM labelled)
SELECT group_name, count(l.pair_id) AS n_entries,
  round(CASE WHEN any_value(t.n) > 0 THEN count(l.pair_id) / any_value(t.n) * 100 ELSE 0 END, 6) AS percent
FROM names LEFT JOIN labelled l ON l.category = group_name, total t GROUP BY group_name
""", "p_diagnostics", "p_taxonomy")

INGEST = CANDIDATES + STRICT.replace("AND_WITH", ",", 1).replace("kept AS", "analysed_pairs AS") + """,
labelled AS (
SELECT f.*, l.cppcheck, l.mm FROM found f JOIN (
  SELECT g.pair_id, string_agg(g.issue_id, ',' ORDER BY g.issue_id) AS cppcheck,
    coalesce(bool_or(g.category = 'memory_management'), false) AS mm
  FROM gone g JOIN analysed_pairs a ON a.pair_id = g.pair_id GROUP BY g.pair_id) l ON l.pair_id = f.sha)
"""
INGEST_VIEWS = (*CANDIDATE_VIEWS, "p_diagnostics", "p_taxonomy", "p_store_hashes")
check("ingest_entries", INGEST + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY code_hash ORDER BY author_date, CAST(sha AS VARCHAR), rule_url, fixed_place) AS nth FROM labelled)
SELECT substring(code_hash, 1, 24) AS entry_id, code_hash, rule_url AS url, CAST(sha AS VARCHAR) AS commit_hash,
  fixed_hash, cppcheck, mm AS memory_management
FROM ranked WHERE nth = 1 AND code_hash NOT IN (SELECT code_hash FROM p_store_hashes)
""", *INGEST_VIEWS)
check("stage_counts", INGEST + """
SELECT 'pushed' AS stage, count(*) AS n_rows FROM found
UNION ALL SELECT 'labelled', count(*) FROM labelled
UNION ALL SELECT 'inserted', count(DISTINCT code_hash) FROM labelled WHERE code_hash NOT IN (SELECT code_hash FROM p_store_hashes)
""", *INGEST_VIEWS)

# --- report --------------------------------------------------------------------

QUALITY_OR = "(" + " OR ".join(QUALITY_GROUPS) + ")"
ITEMS = """
AND_WITH items AS (
SELECT * FROM (SELECT entry_id, 1 AS pos, issue_1 AS label FROM p_entries UNION ALL SELECT entry_id, 2, issue_2 FROM p_entries
UNION ALL SELECT entry_id, 3, issue_3 FROM p_entries) WHERE label IS NOT NULL)
"""
check("label_totals", ITEMS + """
SELECT (SELECT count(*) FROM p_entries) AS n_entries, (SELECT count(*) FROM p_entries) AS n_with_labels, 0 AS n_without_labels,
  count(*) AS total_issues, count(DISTINCT label) AS issue_types FROM items
""", "p_entries")
check("issue_counts_top10", ISSUES + """
SELECT issue_id, count(DISTINCT (pair_id, side)) AS n_issues FROM issues WHERE issue_id IS NOT NULL
GROUP BY issue_id ORDER BY n_issues DESC, issue_id LIMIT 10
""", "p_diagnostics")
COARSE_ROWS = " UNION ALL ".join(
    [f"SELECT '{g}' AS group_name, count(*) FILTER ({g}) AS n_entries, count(*) AS n FROM p_entries" for g in SHARED_GROUPS]
    + [f"SELECT 'code_quality_performance', count(*) FILTER ({QUALITY_OR}), count(*) FROM p_entries"]
)
check("group_share", f"SELECT group_name, n_entries, round(n_entries / n * 100, 6) AS percent FROM ({COARSE_ROWS})", "p_entries")
check("legacy_issue_counts", """
AND_WITH all_items AS (
SELECT label AS issue_id, 1 AS n FROM (SELECT doc_id, issue_1 AS label FROM p_entries UNION ALL SELECT doc_id, issue_2 FROM p_entries
  UNION ALL SELECT doc_id, issue_3 FROM p_entries) WHERE label IS NOT NULL AND doc_id % 3 <> 1
UNION ALL SELECT 'memleak', doc_id % 4 FROM p_entries WHERE doc_id % 3 = 1
UNION ALL SELECT 'oldCheck', 2 FROM p_entries WHERE doc_id % 3 = 1)
SELECT issue_id, CAST(sum(n) AS BIGINT) AS n_issues FROM all_items GROUP BY issue_id
""", "p_entries")

# --- store ---------------------------------------------------------------------

ORDER = "ingest_timestamp {0}, commit_hash {0}, repo_url {0}, code_fixed {0}"
for name, turn in (("one_per_hash_first", "ASC"), ("one_per_hash_last", "DESC")):
    check(name, f"""
SELECT entry_id, code_hash FROM (SELECT *, row_number() OVER (PARTITION BY code_hash ORDER BY {ORDER.format(turn)}) AS nth FROM p_entries)
WHERE nth = 1
""", "p_entries")
check("insert_if_new", f"""
SELECT entry_id, code_hash FROM (SELECT *, row_number() OVER (PARTITION BY code_hash ORDER BY {ORDER.format('ASC')}) AS nth FROM p_entries)
WHERE nth = 1 AND code_hash NOT IN (SELECT code_hash FROM p_store_hashes)
""", "p_entries", "p_store_hashes")
OUTCOMES = """
SELECT code_hash, CASE WHEN code_hash IN (SELECT code_hash FROM p_store_hashes) THEN 0 ELSE 1 END AS inserted,
  count(*) - CASE WHEN code_hash IN (SELECT code_hash FROM p_store_hashes) THEN 0 ELSE 1 END AS duplicates
FROM {0} GROUP BY code_hash
"""
check("insert_outcomes", OUTCOMES.format("p_entries"), "p_entries", "p_store_hashes")

CHECKED = r"""
AND_WITH checked AS (
SELECT *, code_hash IS NULL OR NOT regexp_full_match(code_hash, '[a-fA-F0-9]{64}') AS bad_hash,
  TRY_CAST(commit_date AS TIMESTAMPTZ) IS NULL AS bad_date,
  lower(memory_management) NOT IN ('true', 't', 'yes', 'y', 'on', '1', '1.0', 'false', 'f', 'no', 'n', 'off', '0', '0.0') AS bad_flag
FROM p_wire),
reasoned AS (
SELECT *, concat_ws(',', CASE WHEN bad_hash THEN 'code_hash' END, CASE WHEN code_original IS NULL THEN 'code_original' END,
  CASE WHEN clang <> '{}' THEN 'labels.clang' END, CASE WHEN bad_flag THEN 'labels.groups' END,
  CASE WHEN bad_date THEN 'repo.commit_date' END, CASE WHEN repo_url IS NULL THEN 'repo.url' END) AS reasons FROM checked)
"""
check("validate_entries", CHECKED + """
SELECT doc_id, reasons, lower(memory_management) IN ('true', '1') AS memory_management,
  CASE WHEN NOT bad_date THEN CASE WHEN commit_date LIKE '%+02:00' THEN '2024-01-10 10:00:00'
    WHEN commit_date LIKE '%Z' THEN '2024-01-10 12:00:00' ELSE '2024-01-10 00:00:00' END END AS commit_date FROM reasoned
""", "p_wire")
check("import_outcomes", CHECKED + ", good AS (SELECT * FROM reasoned WHERE reasons = ''), per_hash AS (" + OUTCOMES.format("good") + """)
SELECT 'inserted' AS outcome, CAST(coalesce(sum(inserted), 0) AS BIGINT) AS n_documents, false AS is_error FROM per_hash
UNION ALL SELECT 'duplicate', CAST(coalesce(sum(duplicates), 0) AS BIGINT), true FROM per_hash
UNION ALL SELECT 'rejected', count(*), true FROM reasoned WHERE reasons <> ''
UNION ALL SELECT 'unreadable', 0, true
""", "p_wire", "p_store_hashes")

UPDATE = """
AND_WITH latest AS (
SELECT entry_id, path, value FROM (SELECT *, row_number() OVER (PARTITION BY entry_id, path ORDER BY seq DESC) AS nth FROM p_updates) WHERE nth = 1),
wide AS (
SELECT entry_id, bool_or(path = 'code_fixed') AS s1, max(value) FILTER (path = 'code_fixed') AS v1,
  bool_or(path = 'repo.commit_hash') AS s2, max(value) FILTER (path = 'repo.commit_hash') AS v2,
  bool_or(path = 'labels.groups.concurrency') AS s3, max(value) FILTER (path = 'labels.groups.concurrency') AS v3,
  bool_or(path = 'labels.groups.memory_management') AS s4, max(value) FILTER (path = 'labels.groups.memory_management') AS v4
FROM latest GROUP BY entry_id),
judged AS (
SELECT *, concat_ws(',', CASE WHEN s3 AND v3 = 'banana' THEN 'labels.groups.concurrency' END,
  CASE WHEN s2 AND v2 IS NULL THEN 'repo.commit_hash' END) AS refused FROM wide)"""
check("update_entries", UPDATE + """,
now AS (
SELECT e.entry_id, w.entry_id IS NOT NULL AS matched, e.code_fixed, e.commit_hash, e.concurrency, e.memory_management,
  coalesce(refused, '') AS refused, coalesce(refused, '') = '' AS ok,
  CASE WHEN ok AND s1 THEN v1 ELSE code_fixed END AS n1, CASE WHEN ok AND s2 THEN v2 ELSE commit_hash END AS n2,
  CASE WHEN ok AND s3 THEN true ELSE concurrency END AS n3, CASE WHEN ok AND s4 THEN v4 = 'true' ELSE memory_management END AS n4
FROM p_entries e LEFT JOIN judged w ON w.entry_id = e.entry_id)
SELECT entry_id, matched, refused, n1 IS DISTINCT FROM code_fixed OR n2 IS DISTINCT FROM commit_hash OR n3 IS DISTINCT FROM concurrency
  OR n4 IS DISTINCT FROM memory_management AS modified, sha256(n1) AS fixed_hash, n2 AS commit_hash, n3 AS concurrency,
  n4 AS memory_management, '{}' AS clang FROM now
""", "p_entries", "p_updates")
check("delete_entries", "SELECT entry_id FROM p_entries WHERE entry_id NOT IN (SELECT entry_id FROM p_edits)", "p_entries", "p_edits")
check("deleted_entries", "SELECT entry_id FROM p_entries WHERE entry_id IN (SELECT entry_id FROM p_edits)", "p_entries", "p_edits")
check("unmatched_edits", "SELECT entry_id, seq FROM p_edits WHERE entry_id NOT IN (SELECT entry_id FROM p_entries)", "p_entries", "p_edits")
PATCH = ITEMS + """,
steps AS (SELECT entry_id, seq, add_label AS label, false AS removing FROM p_edits
  UNION ALL SELECT entry_id, seq, remove_label, true FROM p_edits WHERE remove_label IS NOT NULL),
named AS (SELECT *, CASE label WHEN 'MemError' THEN 'memory_management' WHEN 'memory_management' THEN 'memory_management'
  WHEN 'Concurrency' THEN 'concurrency' WHEN 'LogicError' THEN 'logic_error' END AS field FROM steps),
flags AS (SELECT entry_id, field, NOT removing AS value FROM (SELECT *, row_number() OVER (PARTITION BY entry_id, field
  ORDER BY seq DESC, removing DESC) AS nth FROM named WHERE field IS NOT NULL) WHERE nth = 1),
removals AS (SELECT entry_id, label, max(seq) AS seq FROM named WHERE field IS NULL AND removing GROUP BY ALL),
additions AS (SELECT n.entry_id, n.label, min(n.seq) AS seq FROM named n LEFT JOIN removals r ON r.entry_id = n.entry_id AND r.label = n.label
  WHERE n.field IS NULL AND NOT n.removing AND (r.seq IS NULL OR n.seq > r.seq) GROUP BY ALL),
old AS (SELECT i.* FROM items i WHERE NOT EXISTS (SELECT 1 FROM removals r WHERE r.entry_id = i.entry_id AND r.label = i.label)),
final AS (SELECT entry_id, 0 AS part, pos, label FROM old UNION ALL SELECT a.entry_id, 1, a.seq, a.label FROM additions a
  WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.entry_id = a.entry_id AND o.label = a.label)),
lists AS (SELECT entry_id, string_agg(label, ',' ORDER BY part, pos) AS cppcheck FROM final GROUP BY entry_id),
wide AS (SELECT entry_id, bool_or(value) FILTER (field = 'memory_management') AS f1, bool_or(value) FILTER (field = 'concurrency') AS f2,
  bool_or(value) FILTER (field = 'logic_error') AS f3 FROM flags GROUP BY entry_id)
"""
PATCHED = """coalesce(l.cppcheck, '') AS cppcheck,
  coalesce(f1, memory_management) AS memory_management, coalesce(f2, concurrency) AS concurrency, coalesce(f3, logic_error) AS logic_error
FROM {} e LEFT JOIN lists l ON l.entry_id = e.entry_id LEFT JOIN wide w ON w.entry_id = e.entry_id
"""
check("patch_labels", PATCH + "SELECT e.entry_id, e.entry_id IN (SELECT entry_id FROM p_edits) AS matched, " + PATCHED.format("p_entries"),
      "p_entries", "p_edits")
check("target_cap", f"""
SELECT entry_id, code_hash FROM (SELECT *, row_number() OVER (PARTITION BY code_hash ORDER BY {ORDER.format('ASC')}) AS nth FROM p_entries)
WHERE nth = 1 ORDER BY {ORDER.format('ASC')} LIMIT 50
""", "p_entries")

# --- the store in place ----------------------------------------------------------

ONCE = f"""
once AS (SELECT * EXCLUDE (nth) FROM
  (SELECT *, row_number() OVER (PARTITION BY code_hash ORDER BY {ORDER.format('ASC')}) AS nth FROM p_entries) WHERE nth = 1)
"""
check("append_to_store", """
AND_WITH total AS (SELECT count(DISTINCT code_hash) AS n, count(DISTINCT CASE WHEN code_hash IN (SELECT code_hash FROM p_store_hashes) THEN code_hash END) AS old
FROM p_entries)
SELECT old AS n_before, n - old AS n_inserted, CAST(0 AS BIGINT) AS n_again, n AS n_entries, n AS n_hashes FROM total
""", "p_entries", "p_store_hashes")
check("update_in_place", UPDATE + "," + ONCE + """,
claims AS (SELECT code_hash, count(DISTINCT entry_id) AS n FROM
  (SELECT entry_id, code_hash FROM once UNION SELECT entry_id, value FROM p_hash_updates) GROUP BY code_hash),
fresh AS (SELECT h.entry_id, h.value, c.n > 1 AS taken FROM p_hash_updates h JOIN claims c ON c.code_hash = h.value),
now AS (SELECT e.*, w.*, f.value, coalesce(w.refused, '') = '' AND NOT coalesce(f.taken, false) AS ok
FROM once e LEFT JOIN (SELECT * RENAME (entry_id AS id) FROM judged) w ON w.id = e.entry_id
LEFT JOIN (SELECT * RENAME (entry_id AS id2) FROM fresh) f ON f.id2 = e.entry_id)
SELECT entry_id, CASE WHEN ok AND value IS NOT NULL THEN value ELSE code_hash END AS code_hash,
  sha256(CASE WHEN ok AND s1 THEN v1 ELSE code_fixed END) AS fixed_hash, CASE WHEN ok AND s2 THEN v2 ELSE commit_hash END AS commit_hash,
  CASE WHEN ok AND s3 THEN true ELSE concurrency END AS concurrency, CASE WHEN ok AND s4 THEN v4 = 'true' ELSE memory_management END AS memory_management,
  '{}' AS clang FROM now
""", "p_entries", "p_updates", "p_hash_updates")
check("patch_in_place", PATCH + "," + ONCE + "SELECT e.entry_id, " + PATCHED.format("once"), "p_entries", "p_edits")
check("delete_in_place", "AND_WITH" + ONCE + """,
gone AS (SELECT count(*) AS n FROM once WHERE entry_id IN (SELECT entry_id FROM p_edits))
SELECT entry_id, code_hash, 'left' AS moment, n AS n_deleted FROM once, gone WHERE entry_id NOT IN (SELECT entry_id FROM p_edits)
UNION ALL SELECT entry_id, code_hash, 'back', n FROM once, gone
""", "p_entries", "p_edits")

# --- queries -------------------------------------------------------------------

check("label_filter", f"SELECT entry_id FROM p_entries WHERE memory_management AND {QUALITY_OR} AND issue_2 = 'nullPointer'", "p_entries")
check("param_filter", f"""
SELECT entry_id FROM p_entries WHERE repo_url = 'https://github.com/o/src6' AND memory_management AND NOT concurrency AND {QUALITY_OR}
""", "p_entries")
check("document_filter", """
SELECT entry_id FROM p_entries
WHERE ((memory_management AND code_fixed IS NOT NULL) OR coalesce(issue_3 = 'cstyleCast', false)
  OR (commit_hash LIKE '9%' AND commit_hash NOT IN ('91', '92')))
AND repo_url >= 'https://github.com/o/src1' AND repo_url NOT LIKE '%src5' AND issue_2 IS NULL
""", "p_entries")
check("point_lookup", "SELECT entry_id, code_hash FROM p_entries WHERE entry_id = '000000000000000000000042'", "p_entries")
check("sorted_page", """
SELECT entry_id, repo_url AS url, code_hash FROM p_entries WHERE invalid_access
ORDER BY repo_url DESC, code_fixed ASC NULLS FIRST, ingest_timestamp DESC NULLS LAST, entry_id LIMIT 25
""", "p_entries")
check("result_count", "SELECT count(*) AS n_entries FROM p_entries WHERE logic_error", "p_entries")
ACTIVE = ", ".join(f"CASE WHEN {g} THEN '{g}' END" for g in GROUPS)
check("active_labels_text", f"""
AND_WITH active AS (SELECT entry_id, [x FOR x IN [{ACTIVE}] IF x IS NOT NULL] AS names FROM p_entries)
SELECT entry_id, array_to_string(names[1:5], ', ') || CASE WHEN len(names) > 5 THEN ' (+' || (len(names) - 5) || ' more)' ELSE '' END AS labels
FROM active
""", "p_entries")

# --- documents and flat rows -----------------------------------------------------

check("export_order", "SELECT entry_id, code_hash, concat_ws(',', issue_1, issue_2, issue_3) AS cppcheck FROM p_entries", "p_entries")
FLAT = ", ".join(f"CASE WHEN {g} THEN 'True' ELSE 'False' END AS labels_{g}" for g in GROUPS)
check("flatten_csv", f"""
SELECT entry_id, code_hash, repo_url, commit_hash AS repo_commit_hash,
  strftime(ingest_timestamp, '%Y-%m-%dT%H:%M:%S.%fZ') AS repo_commit_date,
  strftime(ingest_timestamp, '%Y-%m-%dT%H:%M:%S.%fZ') AS ingest_timestamp,
  '[' || array_to_string(['"' || x || '"' FOR x IN [issue_1, issue_2, issue_3] IF x IS NOT NULL], ',') || ']' AS labels_cppcheck,
  '{{}}' AS labels_clang, {FLAT}, CASE WHEN {QUALITY_OR} THEN 'True' ELSE 'False' END AS labels_code_quality_performance
FROM p_entries
""", "p_entries")
FLAGS = ", ".join(f"CASE WHEN {g} THEN '{g}' END" for g in GROUPS)
STORED = """
SELECT code_hash, sha256({original}) AS original_hash, sha256({fixed}) AS fixed_hash, repo_url AS url, commit_hash,
  strftime(ingest_timestamp, '%Y-%m-%d %H:%M:%S') AS committed, strftime(ingest_timestamp, '%Y-%m-%d %H:%M:%S') AS ingested,
  concat_ws(',', issue_1, issue_2, issue_3) AS cppcheck, '{{}}' AS clang, concat_ws(',', {flags}) AS flags FROM p_entries
"""
AS_IS = STORED.format(original="code_original", fixed="code_fixed", flags=FLAGS)
FROM_CSV = STORED.format(original="code_original", fixed="nullif(code_fixed, '')", flags=FLAGS)


def rejoined(c):
    return f"regexp_replace(regexp_replace({c}, '(?:{BREAKS})$', ''), '{BREAKS}', chr(10), 'g')"


check("unflatten_csv", FROM_CSV, "p_entries")
check("json_documents", STORED.format(original=rejoined("code_original"), fixed=rejoined("code_fixed"), flags=FLAGS), "p_entries")
check("csv_files", FROM_CSV, "p_entries")
check("csv_mixed_headers", FROM_CSV.replace("CASE WHEN code_style THEN", "CASE WHEN code_style AND doc_id % 3 <> 2 THEN"), "p_entries")
check("json_lines_files", AS_IS, "p_entries")
check("json_document_files", AS_IS, "p_entries")
check("query_result_file", AS_IS + "WHERE logic_error AND 'memleak' IN (issue_1, issue_2, issue_3)", "p_entries")
check("readable_json_files", f"""
AND_WITH texts AS (SELECT code_hash, code_original, code_fixed FROM
  (SELECT *, row_number() OVER (PARTITION BY code_hash ORDER BY {ORDER.format('DESC')}) AS nth FROM p_entries) WHERE nth = 1),
lines AS (SELECT *, CASE WHEN code_original = '' THEN [] ELSE string_split_regex(regexp_replace(code_original, '(?:{BREAKS})$', ''), '{BREAKS}') END AS o,
  CASE WHEN code_fixed = '' THEN [] ELSE string_split_regex(regexp_replace(code_fixed, '(?:{BREAKS})$', ''), '{BREAKS}') END AS f FROM texts)
SELECT code_hash || '.json' AS file_name, code_hash, len(o) AS n_lines, sha256(coalesce(array_to_string(o, '|'), '')) AS code_original_lines,
  CASE WHEN code_fixed IS NOT NULL THEN sha256(coalesce(array_to_string(f, '|'), '')) END AS code_fixed_lines FROM lines
""", "p_entries")
IMPORTED = """,
per_hash AS (SELECT code_hash, count(*) AS n, code_hash IN (SELECT code_hash FROM p_store_hashes) AS known FROM good GROUP BY code_hash)
SELECT 'inserted' AS outcome, count(*) FILTER (NOT known) AS n_documents, false AS is_error FROM per_hash
UNION ALL SELECT 'duplicate', CAST(coalesce(sum(n), 0) AS BIGINT) - count(*) FILTER (NOT known), true FROM per_hash
UNION ALL SELECT 'rejected', {rejected}, true FROM p_entries
UNION ALL SELECT 'unreadable', {unreadable}, true FROM p_entries
"""
check("import_folder_csv", "\nAND_WITH good AS (SELECT code_hash FROM p_entries)" + IMPORTED.format(
    rejected="0 * count(*)", unreadable="0 * count(*)"), "p_entries", "p_store_hashes")
check("import_folder_json", "\nAND_WITH good AS (SELECT code_hash FROM p_entries WHERE doc_id % 11 <> 3 AND doc_id % 13 <> 5)" + IMPORTED.format(
    rejected="count(*) FILTER (doc_id % 11 <> 3 AND doc_id % 13 = 5)", unreadable="count(*) FILTER (doc_id % 11 = 3)"),
    "p_entries", "p_store_hashes")
check("document_report", """
SELECT count(*) AS n_entries, count(*) FILTER (doc_id % 5 <> 4) AS n_with_labels, count(*) FILTER (doc_id % 5 = 4) AS n_without_labels,
  CAST(coalesce(sum((issue_1 IS NOT NULL)::INT + (issue_2 IS NOT NULL)::INT + (issue_3 IS NOT NULL)::INT) FILTER (doc_id % 5 NOT IN (3, 4)), 0)
    + 2 * count(*) FILTER (doc_id % 5 = 3) AS BIGINT) AS total_issues, 4 AS issue_types FROM p_entries
""", "p_entries")
check("entry_defaults", """
SELECT entry_id, CASE WHEN doc_id % 2 = 0 THEN concat_ws(',', issue_1, issue_2, issue_3) ELSE '' END AS cppcheck, '{}' AS clang,
  doc_id % 2 = 0 AND memory_management AS memory_management, doc_id % 2 = 0 AND code_style AS code_style FROM p_entries
""", "p_entries")

# --- training and evaluation -------------------------------------------------------

LABEL = "CASE " + " ".join(
    f"WHEN {QUALITY_OR if g == 'code_quality_performance' else g} THEN {text(t)}" for g, t in M.TITLES.items()
) + " ELSE 'Unknown' END"
ROWS = f"""
AND_WITH labelled AS (SELECT *, {LABEL} AS label FROM p_entries WHERE code_original <> ''),
samples AS (SELECT entry_id AS sample_id, code_original, coalesce(nullif(code_fixed, ''), code_original) AS code_fixed, label
FROM labelled WHERE label <> 'Unknown')
"""
check("active_label_titles", f"SELECT entry_id, {LABEL} AS label FROM p_entries", "p_entries")
check("training_rows", ROWS + """
SELECT sample_id, label, sha256(code_original) AS original_hash, sha256(code_fixed) AS fixed_hash FROM samples
""", "p_entries")
PROMPT = " || ".join([text(M.PROMPT_HEAD), strip("code_original"), text(M.PROMPT_MIDDLE), strip("code_fixed"), text(M.PROMPT_TAIL)])
check("prompts", ROWS + f"""
SELECT sample_id, length(t) AS n_chars, sha256(t) AS text_hash FROM (SELECT sample_id, {PROMPT} || label AS t FROM samples)
""", "p_entries")
check("prompts_inference", ROWS + f"""
SELECT sample_id, length(t) AS n_chars, sha256(t) AS text_hash FROM (SELECT sample_id, rtrim({PROMPT}, {BLANKS}) AS t FROM samples)
""", "p_entries")
check("label_distribution", ROWS + "SELECT label, count(*) AS n_samples FROM samples GROUP BY label", "p_entries")
SPLIT = ROWS + """,
counts AS (SELECT label, count(*) AS n FROM samples GROUP BY label),
sized AS (SELECT label, n, sum(n) OVER () AS total, sum(n) OVER () - CAST(ceil(sum(n) OVER () * 0.2) AS BIGINT) AS n_train FROM counts),
based AS (SELECT *, (n_train * n) // total AS base, (n_train * n) % total AS rest FROM sized),
quotas AS (SELECT label, n - base - CASE WHEN row_number() OVER (ORDER BY rest DESC, label) <= n_train - sum(base) OVER () THEN 1 ELSE 0 END AS n_test FROM based),
ranked AS (SELECT sample_id, label, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || sample_id)) AS nth FROM samples),
split AS (SELECT r.sample_id, r.label, CASE WHEN r.nth <= q.n_test THEN 'test' ELSE 'train' END AS split FROM ranked r JOIN quotas q ON q.label = r.label)
"""
check("stratified_split", SPLIT + "SELECT sample_id, label, split FROM split", "p_entries")
check("split_distribution", SPLIT + "SELECT split, label, count(*) AS n_samples FROM split GROUP BY split, label", "p_entries")


def parse(raw):
    answer = f"lower(trim(string_split({strip(raw)}, chr(10))[1], '.,!?;:'))"
    cases = [f"WHEN {answer} = {text(t.lower())} THEN {text(t)}" for t in M.TITLES.values()]
    cases += [f"WHEN contains({answer}, {text(t.lower())}) THEN {text(t)}" for t in M.TITLES.values()]
    cases += [f"WHEN contains({answer}, {text(w)}) THEN {text(t)}" for w, t in M.KEYWORDS.items()]
    return "CASE " + " ".join(cases) + " ELSE 'Unknown' END"


SCORED = f"""
AND_WITH scored AS (SELECT sample_id, true_label, {parse('raw_prediction')} AS predicted_label, {parse('raw_baseline')} AS baseline_label FROM p_predictions)
"""
check("parsed_predictions", SCORED + "SELECT sample_id, predicted_label FROM scored", "p_predictions")
check("scored_samples", SCORED + "SELECT sample_id, true_label, predicted_label FROM scored", "p_predictions")
check("accuracy", SCORED + """
SELECT count(*) FILTER (true_label = predicted_label) AS correct, count(*) AS total,
  round(count(*) FILTER (true_label = predicted_label) / count(*) * 100, 6) AS accuracy FROM scored
""", "p_predictions")
check("confusion_matrix", SCORED + """,
names AS (SELECT true_label AS label FROM scored UNION SELECT predicted_label FROM scored)
SELECT t.label AS true_label, p.label AS predicted_label,
  (SELECT count(*) FROM scored s WHERE s.true_label = t.label AND s.predicted_label = p.label) AS n FROM names t, names p
""", "p_predictions")
TOTALS = SCORED + """,
names AS (SELECT true_label AS label FROM scored UNION SELECT predicted_label FROM scored),
totals AS (SELECT label, (SELECT count(*) FROM scored WHERE true_label = label) AS actual,
  (SELECT count(*) FROM scored WHERE predicted_label = label) AS predicted,
  (SELECT count(*) FROM scored WHERE true_label = label AND predicted_label = label) AS agreed FROM names)
"""
check("actual_vs_predicted", TOTALS + "SELECT label, actual, predicted FROM totals", "p_predictions")
check("classification_report", TOTALS + """,
m AS (SELECT label, agreed, actual AS s, CASE WHEN predicted > 0 THEN agreed / predicted ELSE 0 END AS p,
  CASE WHEN actual > 0 THEN agreed / actual ELSE 0 END AS r,
  CASE WHEN actual + predicted > 0 THEN 2 * agreed / (actual + predicted) ELSE 0 END AS f FROM totals),
rows AS (
SELECT label, p, r, f, s FROM m
UNION ALL SELECT 'accuracy', NULL, NULL, sum(agreed) / sum(s), sum(s) FROM m
UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(s) FROM m
UNION ALL SELECT 'weighted avg', sum(p * s) / sum(s), sum(r * s) / sum(s), sum(f * s) / sum(s), sum(s) FROM m)
SELECT label, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1_score, CAST(s AS BIGINT) AS support FROM rows
""", "p_predictions")
check("per_category_accuracy", SCORED + """
SELECT true_label AS label, count(*) AS baseline_support, count(*) AS tuned_support,
  round(count(*) FILTER (true_label = baseline_label) / count(*) * 100, 6) AS baseline_accuracy,
  round(count(*) FILTER (true_label = predicted_label) / count(*) * 100, 6) AS tuned_accuracy FROM scored GROUP BY true_label
""", "p_predictions")
check("model_comparison", SCORED + """,
c AS (SELECT count(*) FILTER (true_label = baseline_label) AS b, count(*) FILTER (true_label = predicted_label) AS t, count(*) AS n FROM scored),
a AS (SELECT *, b / n * 100 AS ba, t / n * 100 AS ta FROM c)
SELECT b AS baseline_correct, t AS tuned_correct, n AS baseline_total, n AS tuned_total, t - b AS correct_change,
  CASE WHEN ta - ba > 5 THEN 'effective' WHEN ta - ba > 0 THEN 'marginal' WHEN ta = ba THEN 'no change' ELSE 'degraded' END AS verdict,
  round(ba, 6) AS baseline_accuracy, round(ta, 6) AS tuned_accuracy, round(ta - ba, 6) AS accuracy_change,
  round((ta - ba) / greatest(ba, 0.01) * 100, 6) AS relative_change FROM a
""", "p_predictions")

# --- streaming -----------------------------------------------------------------

HITS = """
AND_WITH hits AS (
SELECT DISTINCT code_hash, CASE WHEN before_1 = 'memleak' AND (after_1 <> 'memleak' OR coalesce(code_fixed, '') = '') THEN 'memleak' END AS i1,
  CASE WHEN before_2 = 'nullPointer' THEN 'nullPointer' END AS i2 FROM p_stream)
"""
STREAMED = HITS + """
SELECT substring(code_hash, 1, 24) AS entry_id, code_hash, concat_ws(',', i1, i2) AS cppcheck, i1 IS NOT NULL AS memory_management,
  i2 IS NOT NULL AS invalid_access FROM hits WHERE i1 IS NOT NULL OR i2 IS NOT NULL
"""
for name in ("stream_ingest", "stream_ingest_two_runs", "stream_remembering"):
    check(name, STREAMED, "p_stream")
check("stream_target", HITS + """,
total AS (SELECT count(*) AS n FROM hits WHERE i1 IS NOT NULL OR i2 IS NOT NULL)
SELECT 'at_target' AS moment, least(50, n) AS n_entries FROM total UNION ALL SELECT 'in_the_end', n FROM total
""", "p_stream")
check("stream_from_settings", HITS + """,
chosen AS (SELECT count(DISTINCT s.code_hash) AS n FROM p_stream s JOIN hits h ON h.code_hash = s.code_hash
  WHERE (h.i1 IS NOT NULL OR h.i2 IS NOT NULL) AND s.commit_date >= TIMESTAMP '1990-01-01'
  AND (s.repo_url IN ('https://github.com/o/src1', 'https://github.com/o/src2') AND s.commit_date >= TIMESTAMP '2020-01-01'
    OR s.repo_url = 'https://github.com/o/src3' AND s.commit_date < TIMESTAMP '2024-01-02'))
SELECT 'all' AS run, n AS n_entries, CAST(0 AS BIGINT) AS n_others FROM chosen UNION ALL SELECT 'target', least(40, n), 0 FROM chosen
""", "p_stream")
check("ingest_rate", """
SELECT strftime(time_bucket(INTERVAL 5 SECOND, ingest_timestamp), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n_entries,
  count(*) / 5.0 AS entries_per_second FROM p_predictions GROUP BY 1
""", "p_predictions")
