"""Quality rules: divergence from language references, on DataFrame functions only.

A document's shares of character classes and of its language's commonest words
are compared with those of all documents of the language by Jensen-Shannon
distance. Texts that are too short for a histogram to mean anything are not
compared. Repetition and length have rules of their own.
"""

from functools import reduce

from pyspark.sql import functions as F

from mendlake.llm.common import BLANK, WORD, settle, table

# The commonest function words of each language.
COMMON_WORDS = {
    "en": "the of and to a in is that it for was on with as be by",
    "de": "der die und in den von zu das sich mit des auf für ist im nicht",
    "fr": "de la le et les en des un du une que est pour par dans avec",
    "es": "de la que el en y los las se del un por con no una su",
}
#: Any other language: all of them.
OTHER = sorted({w for words in COMMON_WORDS.values() for w in words.split()})
SYMBOLS = r"[^#*$%&|<>]+"
#: What is left of a text without the rest of these is a character class; the remainder, mostly lower case, is the fifth.
CLASSES = (r"[^A-Z]+", r"[^0-9]+", r"[^\x20\x09-\x0D]+", r"[^!-/:-@\[-`{-~]+")

MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
#: Fewer code points or words than these are not compared.
MIN_CHARS_COMPARED, MIN_WORDS_COMPARED = 200, 100
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.24, 0.255


def _left(text, pattern):
    return F.length(F.regexp_replace(text, F.lit(pattern), F.lit(""))).cast("long")


def _equals(value):
    return lambda x: x == value


def _repeated_words(grams):
    """Words that lie in windows of three found twice or more; equal windows stand side by side once sorted."""
    def alike(p, i):
        before, after = F.get("_sorted", i - 1), F.get("_sorted", i + 1)
        return F.coalesce(p["g"] == before["g"], F.lit(False)) | F.coalesce(p["g"] == after["g"], F.lit(False))

    twice = grams.withColumn("_sorted", F.when(
        F.size(F.array_distinct("_grams")) < F.size("_grams"),
        F.sort_array(F.transform("_grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))),
    ))
    found = twice.withColumn("_at", F.sort_array(F.transform(F.filter("_sorted", alike), lambda p: p["i"])))
    widths = F.transform("_at", lambda p, j: F.least(F.lit(3), F.coalesce(F.get("_at", j + 1) - p, F.lit(3))))
    total = F.aggregate(widths, F.lit(0).cast("long"), lambda a, w: a + w)
    return found.withColumn("n_repeat_words", F.coalesce(total, F.lit(0)).cast("long")).drop("_sorted", "_at", "_grams")


def text_counts(docs, key="doc_id"):
    """Counts per text, a row per document: n_chars, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    and the histograms ``classes`` and ``commons`` (arrays of longs; the last bin takes the rest)."""
    text = F.coalesce("text", F.lit(""))
    split = docs.select(key, "lang", text.alias("text")).select(
        key, "lang", "text", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("_words"),
        F.filter(F.split("text", "\n", -1), lambda x: x.rlike(WORD)).alias("_lines"),
    )
    lists = {k: v.split() for k, v in COMMON_WORDS.items()}
    chosen = reduce(
        lambda rest, item: F.when(F.col("lang") == item[0], F.filter("_words", lambda w: w.isin(item[1]))).otherwise(rest),
        lists.items(), F.filter("_words", lambda w: w.isin(OTHER)),
    )
    counted = split.withColumn("_common", chosen).withColumn("_grams", F.when(
        F.size("_words") >= 3,
        F.transform(F.sequence(F.lit(0), F.greatest(F.size("_words") - 3, F.lit(0))),
                    lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2))),
    )).select(
        key, "lang", F.length("text").cast("long").alias("n_chars"), F.size("_words").cast("long").alias("n_words"),
        _left(F.col("text"), SYMBOLS).alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        *(_left(F.col("text"), p).alias(f"_c{i}") for i, p in enumerate(CLASSES)), "_common", "_grams",
    )
    counted = _repeated_words(counted)

    def bins(words):
        found = [F.size(F.filter("_common", _equals(v))).cast("long") for v in words]
        return F.array(*found, F.col("n_words") - F.size("_common"))

    commons = reduce(
        lambda rest, item: F.when(F.col("lang") == item[0], bins(item[1])).otherwise(rest), lists.items(), bins(OTHER)
    )
    rest = F.col("n_chars") - sum((F.col(f"_c{i}") for i in range(1, len(CLASSES))), F.col("_c0"))
    return counted.select(
        key, "lang", "n_chars", "n_words", (F.col("n_chars") - F.col("_c2")).alias("word_chars"), "n_symbols",
        "n_dup_lines", "n_repeat_words", F.array(*(f"_c{i}" for i in range(len(CLASSES))), rest).alias("classes"),
        commons.alias("commons"),
    )


def language_references(counts):
    """Histograms of each language over all its documents; partial sums before the shuffle."""
    both = F.array(F.struct(F.lit(0).alias("kind"), F.col("classes").alias("bins")),
                   F.struct(F.lit(1).alias("kind"), F.col("commons").alias("bins")))
    cells = counts.select("lang", F.inline(both)).select("lang", "kind", F.posexplode("bins").alias("bin", "n"))
    sums = cells.groupBy("lang", "kind", "bin").agg(F.sum("n").alias("n"))
    listed = F.sort_array(F.collect_list(F.struct("bin", "n")))
    rows = sums.groupBy("lang", "kind").agg(F.transform(listed, lambda x: x["n"]).alias("bins"))
    return rows.groupBy(F.col("lang").alias("_lang")).agg(
        F.first(F.when(F.col("kind") == 0, F.col("bins")), True).alias("ref_classes"),
        F.first(F.when(F.col("kind") == 1, F.col("bins")), True).alias("ref_commons"),
    )


def js_distance(p, q):
    """Jensen-Shannon distance, base 2, of two arrays of counts; null when either has none."""
    def total(x):
        return F.aggregate(x, F.lit(0).cast("long"), lambda a, b: a + b)

    def part(a, b):
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

    terms = F.zip_with(p, q, lambda a, b: part(a / total(p), b / total(q)) + part(b / total(q), a / total(p)))
    divergence = F.aggregate(terms, F.lit(0.0), lambda a, b: a + b) / 2
    return F.when((total(p) > 0) & (total(q) > 0), F.sqrt(F.greatest(divergence, F.lit(0.0))))


def quality_rules(docs, key="doc_id"):
    """A row per row of ``docs(doc_id, text, lang)``: counts, distances and the verdict ``kept``.

    ``base_failed``: fewer than 50 words, or more than half of the words in
    repeated windows. Otherwise a document goes when its character classes are
    farther than 0.24 from its language's (texts of at least 200 code points) or
    its common words farther than 0.255 (at least 100 words). A null text is
    empty and fails; a null language is a language of its own, and languages
    without a word list use all lists. Repeated rows count as often as they
    come; an empty table gives an empty table.
    """
    counts = settle(text_counts(docs, key), "quality-counts")
    compared = counts.join(language_references(counts), F.col("lang").eqNullSafe(F.col("_lang")), "left")
    scored = compared.select(
        *counts.columns,
        js_distance(F.col("classes"), F.col("ref_classes")).alias("char_distance"),
        js_distance(F.col("commons"), F.col("ref_commons")).alias("word_distance"),
        ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")))
        .alias("base_failed"),
    )
    odd_chars = (F.col("n_chars") >= MIN_CHARS_COMPARED) & (F.col("char_distance") > MAX_CHAR_DISTANCE)
    odd_words = (F.col("n_words") >= MIN_WORDS_COMPARED) & (F.col("word_distance") > MAX_WORD_DISTANCE)
    bad = F.col("base_failed") | F.coalesce(odd_chars, F.lit(False)) | F.coalesce(odd_words, F.lit(False))
    return scored.withColumn("kept", ~bad)


def op4_quality_divergence(spark, sf_dir):
    """Counts and verdict of every document."""
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def _sql():
    listed = {k: "[" + ", ".join(f"'{w}'" for w in v.split()) + "]" for k, v in COMMON_WORDS.items()}
    other = "[" + ", ".join(f"'{w}'" for w in OTHER) + "]"
    words = "CASE lang " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in listed.items()) + f" ELSE {other} END"
    left = [f"length(regexp_replace(text, '{p}', '', 'g'))" for p in CLASSES]
    part = "CASE WHEN {a} > 0 THEN {a} * log2(2 * {a} / ({a} + {b})) ELSE 0 END"
    return rf"""
WITH texts AS (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents),
split AS (SELECT doc_id, lang, text, regexp_extract_all(text, '{WORD}') AS w,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS l, {words} AS known FROM texts),
places AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM split WHERE len(w) >= 3),
grams AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM places),
repeated AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM grams, (SELECT unnest([0, 1, 2]) AS o) x WHERE n > 1 GROUP BY doc_id),
counts AS (SELECT s.doc_id, lang, length(text) AS n_chars, len(w) AS n_words, length(regexp_replace(text, '{BLANK}', '', 'g')) AS word_chars,
  length(regexp_replace(text, '{SYMBOLS}', '', 'g')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
  coalesce(r.n, 0) AS n_repeat_words, [{", ".join(left)}] AS c,
  list_transform(known, lambda k: len(list_filter(w, lambda x: x = k))) AS k
  FROM split s LEFT JOIN repeated r ON r.doc_id = s.doc_id),
hist AS (SELECT *, list_append(c, n_chars - list_sum(c)) AS classes, list_append(k, n_words - list_sum(k)) AS commons FROM counts),
cells AS (SELECT doc_id, lang, 0 AS kind, unnest(classes) AS n, unnest(range(len(classes))) AS bin FROM hist
  UNION ALL SELECT doc_id, lang, 1, unnest(commons), unnest(range(len(commons))) FROM hist),
refs AS (SELECT lang, kind, bin, sum(n) AS n FROM cells GROUP BY ALL),
shares AS (SELECT c.doc_id, c.kind, c.n / nullif(sum(c.n) OVER (PARTITION BY c.doc_id, c.kind), 0) AS a,
  r.n / nullif(sum(r.n) OVER (PARTITION BY c.doc_id, c.kind), 0) AS b
  FROM cells c JOIN refs r ON r.lang IS NOT DISTINCT FROM c.lang AND r.kind = c.kind AND r.bin = c.bin),
far AS (SELECT doc_id, kind, sqrt(greatest(sum({part.format(a="a", b="b")} + {part.format(a="b", b="a")}) / 2, 0)) AS d
  FROM shares GROUP BY doc_id, kind),
verdict AS (SELECT h.*, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words AS base_failed,
  coalesce(n_chars >= {MIN_CHARS_COMPARED} AND f0.d > {MAX_CHAR_DISTANCE}, false)
  OR coalesce(n_words >= {MIN_WORDS_COMPARED} AND f1.d > {MAX_WORD_DISTANCE}, false) AS odd
  FROM hist h LEFT JOIN far f0 ON f0.doc_id = h.doc_id AND f0.kind = 0 LEFT JOIN far f1 ON f1.doc_id = h.doc_id AND f1.kind = 1)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed, NOT (base_failed OR odd) AS kept FROM verdict"""


SQL = {"op4_quality_divergence": _sql()}
