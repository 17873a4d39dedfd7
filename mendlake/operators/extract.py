"""From commit history to candidate before/after pairs.

Inputs: ``commits(repo_url, sha, parents, message, author_date)``,
``commit_files(repo_url, sha, ordinal, path, status)``,
``repo_tree(repo_url, sha, ordinal, path)``, ``blobs(repo_url, sha, path, content)``
and ``rules(url, start_date, end_date, fix_regexes)``.

Keys of one commit may be very hot (a mass change of a huge tree), so each step
either reduces rows before its shuffle or joins to a side with unique keys,
where adaptive execution can split a hot partition.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from mendlake.functions import text as X
from mendlake.session import settle
from mendlake.sources.blobs import BlobStore, blob_id

# The start of history when a rule names none.
DEFAULT_START = "2020-01-01 00:00:00"

# Unicode classes and case folding as in Python, "\n" the only line end.
PYTHON_FLAGS = "(?imuUd)"


def java_pattern(pattern):
    """Named groups as Java writes them."""
    return F.regexp_replace(F.regexp_replace(pattern, r"\(\?P<", "(?<"), r"\(\?P=(\w+)\)", r"\\k<$1>")


def compiles(pattern):
    """Whether the pattern is one; the test matches it with an empty text."""
    tried = F.try_reflect(F.lit("java.util.regex.Pattern"), F.lit("matches"), F.concat(F.lit(PYTHON_FLAGS), pattern), F.lit(""))
    return tried.isNotNull()


def broken_rules(rules):
    """``url`` and ``pattern`` of patterns that do not compile."""
    each = rules.select("url", F.explode("fix_regexes").alias("pattern"))
    return each.filter(~compiles(java_pattern(F.col("pattern"))))


def with_patterns(rules):
    """Adds to each rule ``alternation`` and ``alone``, the forms its patterns are tried in.

    All patterns are tried as one alternation, which the regex engine compiles
    once for a run of rows with the same rule. Patterns that refer to their
    groups are tried alone, since joining would renumber the groups. A rule with
    a pattern that does not compile finds nothing; ``broken_rules`` names it.
    """
    refers = F.lit(r"\\[1-9]|\\k<|\(\?<[A-Za-z]")
    patterns = F.transform(F.coalesce("fix_regexes", F.array().cast("array<string>")), java_pattern)
    broken = F.exists(patterns, lambda r: ~compiles(r))
    patterns = F.when(broken, F.array(F.lit("(?!)"))).otherwise(patterns)
    joined = F.filter(patterns, lambda r: ~F.regexp_like(r, refers))
    alternation = F.concat(
        F.lit(PYTHON_FLAGS),
        F.array_join(F.transform(joined, lambda r: F.concat(F.lit("(?:"), r, F.lit(")"))), "|"),
    )
    return rules.withColumn(
        "alone", F.transform(
            F.filter(patterns, lambda r: F.regexp_like(r, refers)), lambda r: F.concat(F.lit(PYTHON_FLAGS), r)
        )
    ).withColumn(
        # A rule without patterns matches every message.
        "alternation", F.when(F.size(patterns) == 0, F.lit("")).when(F.size(joined) > 0, alternation)
    )


def message_matches(message, alternation, alone):
    """Any pattern of ``with_patterns`` is found in the message.

    ``regexp_instr`` keeps the compiled pattern from row to row while it stays
    the same; ``regexp_like`` compiles a pattern from a column on every row.
    """
    return (F.coalesce(F.regexp_instr(message, alternation), F.lit(0)) > 0) | F.exists(
        alone, lambda r: F.regexp_instr(message, r) > 0
    )


def in_date_range(when, start_date, end_date, now):
    """Inclusive range of whole days; open ends are the default start and ``now``."""
    start = F.coalesce(start_date.cast("timestamp"), F.lit(DEFAULT_START).cast("timestamp"))
    end = F.coalesce(
        F.date_add(end_date, 1).cast("timestamp") - F.expr("interval 1 microsecond"),
        now,
    )
    return when.between(start, end)


def fix_commits(commits, rules, now=None):
    """Commits of the listed repositories that look like fixes and have a parent.

    ``rules`` comes from a configuration file; Catalyst broadcasts it while its
    size estimate is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    now = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    own = with_patterns(rules).select(
        X.repo_slug("url").alias("repo_slug"),
        F.col("url").alias("rule_url"), "start_date", "end_date", "alternation", "alone",
    ).filter("repo_slug IS NOT NULL")
    return (
        commits.filter(F.size("parents") > 0)
        .withColumn("repo_slug", X.repo_slug("repo_url"))
        .join(own, "repo_slug")
        .filter(in_date_range(F.col("author_date"), F.col("start_date"), F.col("end_date"), now))
        .filter(message_matches(F.col("message"), F.col("alternation"), F.col("alone")))
        .groupBy("repo_url", "sha")
        # One row per commit also where several rules name its repository.
        .agg(
            F.min(F.struct("rule_url", F.col("parents")[0].alias("parent_sha"), "author_date")).alias("_c")
        )
        .select("repo_url", "sha", "_c.*")
    )


def source_files(files):
    """Changed C++ files that are neither removed nor named like tests."""
    ending = F.lit(False)
    for ext in X.IMPL_EXTENSIONS + X.HEADER_EXTENSIONS:
        ending = ending | F.endswith("path", F.lit(ext))
    return files.filter((F.col("status") != "removed") & ~F.lower("path").contains("test") & ending)


def first_file_per_stem(files, keys=("repo_url", "sha")):
    """The first file, in commit order, of each file stem of a commit.

    The filter on ``row_number`` lets Spark keep only each task's first row per
    group before the shuffle, so a hot stem costs one row per task.
    """
    order = Window.partitionBy(*keys, "stem").orderBy("ordinal")
    return (
        files.withColumn("stem", X.stem("path"))
        .withColumn("_nth", F.row_number().over(order))
        .filter("_nth = 1")
        .drop("_nth")
    )


def header_impl_pairs(files, tree, keys=("repo_url", "sha"), pruned=False):
    """Adds ``header_path`` and ``impl_path``: the file itself and its counterpart.

    The counterpart has the same stem and the other role. One in the same
    directory wins, in extension order; else the first in tree order; else none.
    The tree is read once: rows of wanted commits only, reduced together with what
    is asked for to one per stem, role and directory. The first of a stem and role
    is found among these, so the joins never form pairs within a group. A tree that
    has no commits but those of ``files``, as ``history.tree_at`` gives it, is ``pruned``.
    """
    is_header = X.extension("path").isin(*X.HEADER_EXTENSIONS)
    rank = F.array_position(
        F.array(*[F.lit(e) for e in X.HEADER_EXTENSIONS + X.IMPL_EXTENSIONS]), X.extension("path")
    )
    sources = tree.withColumn("_rank", rank).filter("_rank > 0").select(
        *keys, "ordinal", "_rank",
        F.col("path").alias("_path"),
        X.stem("path").alias("stem"),
        X.dir_name("path").alias("_dir"),
        is_header.alias("_header"),
    )
    if "sha" in keys and not pruned:  # trees of commits that nobody asks about go before anything is grouped
        sources = sources.join(files.select(*keys).distinct(), list(keys), "left_semi")
    wanted = files.withColumn("_is_header", is_header).withColumn("_header", ~F.col("_is_header")).withColumn(
        "_dir", X.dir_name("path"))
    group = [*keys, "stem", "_header"]
    both = sources.unionByName(wanted.select(*group, "_dir"), allowMissingColumns=True)  # a row of ``wanted`` has no path
    there = F.col("_path").isNotNull()
    # Dealt by stem and role once, for the rows of a directory and for the first of all.
    per_dir = both.repartition(*group).groupBy(*group, "_dir").agg(
        F.min(F.when(there, F.struct("_rank", "_path")))["_path"].alias("_sibling"),
        F.min(F.when(there, F.struct("ordinal", "_path"))).alias("_first"))
    found = per_dir.select(*group, "_dir", F.coalesce("_sibling", F.min("_first").over(Window.partitionBy(*group))["_path"]).alias("_found"))
    return (
        wanted.join(found, [*group, "_dir"], "left")
        .withColumn("header_path", F.when(F.col("_is_header"), F.col("path")).otherwise(F.col("_found")))
        .withColumn("impl_path", F.when(F.col("_is_header"), F.col("_found")).otherwise(F.col("path")))
        .drop("_is_header", "_header", "_dir", "_found")
    )


ROLES = (
    ("header_before", "parent_sha", "header_path"),
    ("header_after", "sha", "header_path"),
    ("impl_before", "parent_sha", "impl_path"),
    ("impl_after", "sha", "impl_path"),
)
IDENTITY = ("repo_url", "sha", "stem")

#: Lookups of one content that a task answers; those of a content asked for more often are dealt out.
HOT_LOOKUPS = 10_000


def _asked(pairs):
    """The up to four lookups of a pair as rows: its columns, ``_role``, ``_sha`` and ``_path``."""
    lookups = F.array(*[
        F.struct(F.lit(role).alias("role"), F.col(sha).alias("at_sha"), F.col(path).alias("at_path"))
        for role, sha, path in ROLES
    ])
    asked = pairs.withColumn("_ask", F.explode(F.filter(lookups, lambda x: x["at_path"].isNotNull())))
    return asked.select(
        *pairs.columns, F.col("_ask.role").alias("_role"), F.col("_ask.at_sha").alias("_sha"), F.col("_ask.at_path").alias("_path"))


def _asked_narrow(pairs):
    """As ``_asked``, with the other columns of a pair as ``_pair`` in the first of its rows only."""
    lookups = F.array(*[
        F.struct(F.lit(role).alias("role"), F.col(sha).alias("at_sha"), F.col(path).alias("at_path"))
        for role, sha, path in ROLES
    ])
    carried = F.struct(*[c for c in pairs.columns if c not in IDENTITY])
    asked = pairs.select(
        *IDENTITY, carried.alias("_all"),
        F.posexplode(F.filter(lookups, lambda x: x["at_path"].isNotNull())).alias("_nth", "_ask"))
    return asked.select(
        *IDENTITY, F.when(F.col("_nth") == 0, F.col("_all")).alias("_pair"),
        F.col("_ask.role").alias("_role"), F.col("_ask.at_sha").alias("_sha"), F.col("_ask.at_path").alias("_path"))


def attach_contents(pairs, blobs):
    """Adds the four contents, ``""`` for a file that does not exist at that commit.

    ``pairs`` needs ``repo_url, sha, parent_sha, stem, header_path, impl_path``.
    The up to four lookups of a pair become rows of one join. The keys that are
    asked for meet ``blobs`` first: while Spark can broadcast them, texts travel
    only for files that are asked for, and beyond that both joins share one
    shuffle of ``blobs``. A ``BlobStore`` needs none, see ``attach_changed_contents``.
    """
    found = blobs.select(
        "repo_url", F.col("sha").alias("_sha"), F.col("path").alias("_path"), "content"
    )
    asked, key = _asked(pairs), ["repo_url", "_sha", "_path"]
    found = found.join(asked.select(*key).distinct(), key, "left_semi")
    answered = asked.join(found, key, "left")
    carried = [c for c in pairs.columns if c not in IDENTITY]
    contents = [F.max(F.when(F.col("_role") == role, F.col("content"))).alias(role) for role, _, _ in ROLES]
    # The rows of a pair come from different tasks: combining them before the
    # shuffle would sort all texts for nothing.
    gathered = answered.repartition(*IDENTITY).groupBy(*IDENTITY).agg(F.min(F.struct(*carried)).alias("_pair"), *contents)
    return gathered.select(
        *IDENTITY, "_pair.*", *[F.coalesce(role, F.lit("")).alias(role) for role, _, _ in ROLES]
    )


def attach_identities(pairs, keys):
    """Adds the ``blob_id`` of each role under the role's name, null for a missing or empty file. No text is read."""
    known = keys.select("repo_url", F.col("sha").alias("_sha"), F.col("path").alias("_path"), "blob_id")
    answered = _asked_narrow(pairs).join(known, ["repo_url", "_sha", "_path"], "left")
    filled = F.when(F.col("blob_id") != blob_id(F.lit("")), F.col("blob_id"))
    ids = [F.max(F.when(F.col("_role") == role, filled)).alias(role) for role, _, _ in ROLES]
    gathered = answered.groupBy(*IDENTITY).agg(F.min("_pair").alias("_pair"), *ids)
    return gathered.select(*IDENTITY, "_pair.*", *[role for role, _, _ in ROLES])


def attach_changed_contents(pairs, store):
    """As ``attach_contents``, but only pairs whose contents differ and exist afterwards, from a ``BlobStore``.

    Identities decide first: pairs with the same contents on both sides, or none
    afterwards, go before any text is read, and pairs with the same four contents
    are looked up once. Lookups travel to the buckets of ``contents``; a content
    that very many ask for is copied for groups of them, so no task answers more
    than about ``HOT_LOOKUPS`` rows of it. A text moves once, to its pair.
    """
    roles = [role for role, _, _ in ROLES]
    ids = attach_identities(pairs, store.keys).filter(
        "(header_after IS NOT NULL OR impl_after IS NOT NULL)"
        " AND NOT (header_before <=> header_after AND impl_before <=> impl_after)")
    # Of a fixed length each, so the text of the four is unique.
    fours = F.sha2(F.concat(*[F.coalesce(r, F.lit(b"\0" * 32)) for r in roles]), 256)
    # Read for the lookups and for the pairs; narrow, and cheaper than computing the pairs again.
    ids = settle(ids.withColumn("_four", fours), "identities")
    each = F.array(*[F.struct(F.lit(r).alias("_role"), F.col(r).alias("blob_id")) for r in roles])
    wanted = ids.select("_four", *roles).dropDuplicates(["_four"]).select("_four", F.inline(each)).filter("blob_id IS NOT NULL")
    groups = F.ceil(F.count(F.lit(1)) / F.lit(HOT_LOOKUPS)).cast("int")
    hot = wanted.groupBy("blob_id").agg(groups.alias("_groups")).filter("_groups > 1")
    dealt = wanted.join(hot, "blob_id", "left")
    plain = dealt.filter("_groups IS NULL").drop("_groups").join(store.contents, "blob_id")
    copies = store.contents.join(hot, "blob_id").select(
        "blob_id", "content", F.explode(F.sequence(F.lit(0), F.col("_groups") - 1)).alias("_group"))
    often = dealt.filter("_groups IS NOT NULL").withColumn("_group", F.pmod(F.xxhash64("_four"), "_groups").cast("int"))
    often = often.join(copies, ["blob_id", "_group"]).select("blob_id", "_four", "_role", "content")
    found = plain.select("blob_id", "_four", "_role", "content").union(often)
    contents = [F.max(F.when(F.col("_role") == role, F.col("content"))).alias(role) for role in roles]
    texts = found.repartition("_four").groupBy("_four").agg(*contents)
    return ids.drop(*roles).join(texts, "_four").drop("_four").withColumns({r: F.coalesce(r, F.lit("")) for r in roles})


def changed_code(contents):
    """Before and after code of each pair; pairs without code or without change go."""
    return (
        contents.filter((F.col("header_after") != "") | (F.col("impl_after") != ""))
        .withColumn("code_original", X.code_block("header_before", "impl_before"))
        .withColumn("code_fixed", X.code_block("header_after", "impl_after"))
        .filter(F.col("code_original") != F.col("code_fixed"))
        .drop("header_before", "header_after", "impl_before", "impl_after")
    )


def candidates(commits, commit_files, repo_tree, blobs, rules, now=None, tree_keys=("repo_url", "sha")):
    """Candidate pairs of all repositories, with the keys that later steps use.

    ``blobs`` is a table of contents by key, or a ``BlobStore``.
    """
    # Files are reduced per stem before they meet their commit: a commit with very
    # many files then comes into one join partition only, which can be split.
    files = (
        first_file_per_stem(source_files(commit_files))
        .join(fix_commits(commits, rules, now), ["repo_url", "sha"])
        .drop("ordinal", "status")
    )
    attach = attach_changed_contents if isinstance(blobs, BlobStore) else attach_contents
    code = changed_code(attach(header_impl_pairs(files, repo_tree, tree_keys), blobs))
    return code.select(
        "code_original", "code_fixed",
        F.col("rule_url").alias("repo_url"), "sha",
        F.col("author_date").alias("commit_date"),
        F.col("stem").alias("base_name"),
        X.sha256_hex("code_original").alias("code_hash"),
        X.sha256_hex(F.concat(X.sha256_hex("code_original"), X.sha256_hex("code_fixed"))).alias("pair_id"),
    )
