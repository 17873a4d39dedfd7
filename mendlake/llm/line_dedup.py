"""Removal of repeated passages by overlapping windows of three lines.

Windows of three consecutive lines are hashed to 128 bits. Of the windows with
one hash, the first by (document id, document key, position) stays, and the
lines that later ones cover are removed: covered positions of overlapping
windows merge, so a repeated passage of any length goes as a whole.
"""

from pyspark.sql import functions as F

from mendlake.llm.common import row_key, settle, table

WINDOW = 3


def line_windows(docs):
    """(``_key``, ``doc_id``, ``pos``, ``window``) of every three lines that aren't all blank."""
    lines = docs.select("_key", "doc_id", F.split("text", "\n", -1).alias("lines")).filter(F.size("lines") >= WINDOW)
    places = lines.select("_key", "doc_id", "lines", F.explode(F.sequence(F.lit(0), F.size("lines") - WINDOW)).alias("pos"))
    window = F.array_join(F.slice("lines", F.col("pos") + 1, WINDOW), "\n")
    return places.select("_key", "doc_id", "pos", window.alias("window")).filter(
        F.col("window").rlike(r"[^\x20\x09-\x0D]")
    ).withColumn("window", F.unhex(F.md5("window")))


def remove_repeated_lines(docs, carry=()):
    """``docs(doc_id, text)`` without later occurrences of repeated three-line windows.

    Returns doc_id, text, ``n_lines`` and ``n_removed`` (longs) and the columns
    named in ``carry``. Lines are compared exactly. Texts of fewer than three
    lines have no window and stay; a null text stays null with no lines; a text
    whose lines all go is empty. Rows that agree in id and text are one document
    and get the same result. An empty table gives an empty table.

    Windows are counted with partial sums; only repeated ones are joined back to
    their places, where a hot window is split by Spark's handling of skew.
    """
    keyed = docs.select("doc_id", "text", *carry).withColumn("_key", row_key("doc_id", "text"))
    place = F.struct("doc_id", "_key", "pos")
    windows = settle(line_windows(keyed), "line-windows")
    repeated = windows.groupBy("window").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).filter("n > 1")
    later = windows.join(repeated.select("window", "first"), "window").filter(place > F.col("first"))
    covered = later.groupBy("_key").agg(F.collect_set("pos").alias("starts")).select(
        "_key",
        F.array_distinct(F.flatten(F.transform("starts", lambda p: F.sequence(p, p + (WINDOW - 1))))).alias("covered"),
    )
    lines = F.split("text", "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("covered"))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long")
    return keyed.join(covered, "_key", "left").withColumn("_lines", lines).select(
        "doc_id",
        F.when(F.col("covered").isNull(), F.col("text")).otherwise(
            F.array_join(F.transform(kept, lambda i: F.get("_lines", i)), "\n")
        ).alias("text"),
        n_lines.alias("n_lines"),
        F.coalesce(F.size("covered"), F.lit(0)).cast("long").alias("n_removed"),
        *carry,
    )


def op2_line_windows(spark, sf_dir):
    """All documents after line deduplication; texts as they are left."""
    return remove_repeated_lines(table(spark, sf_dir, "documents"))


SQL = {"op2_line_windows": r"""
WITH lines AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
places AS (SELECT doc_id, l, unnest(range(0, len(l) - 2)) AS pos FROM lines WHERE len(l) >= 3),
windows AS (SELECT doc_id, pos, w FROM (SELECT doc_id, pos, l[pos + 1] || chr(10) || l[pos + 2] || chr(10) || l[pos + 3] AS w
  FROM places) x WHERE regexp_matches(w, '[^\x20\x09-\x0D]')),
later AS (SELECT doc_id, pos FROM (SELECT doc_id, pos, row_number() OVER (PARTITION BY w ORDER BY doc_id, pos) AS k FROM windows) x
  WHERE k > 1),
covered AS (SELECT DISTINCT doc_id, pos + i AS pos FROM later, (SELECT unnest([0, 1, 2]) AS i) o),
each AS (SELECT doc_id, unnest(l) AS line, unnest(range(0, len(l))) AS pos FROM lines),
kept AS (SELECT e.doc_id, string_agg(e.line, chr(10) ORDER BY e.pos) AS text FROM each e
  LEFT JOIN covered c ON c.doc_id = e.doc_id AND c.pos = e.pos WHERE c.doc_id IS NULL GROUP BY e.doc_id),
gone AS (SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text, coalesce(len(d.l), 0)::BIGINT AS n_lines,
  coalesce(g.n, 0)::BIGINT AS n_removed
FROM lines d LEFT JOIN kept k ON k.doc_id = d.doc_id LEFT JOIN gone g ON g.doc_id = d.doc_id"""}
