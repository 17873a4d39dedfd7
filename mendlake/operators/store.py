"""Checks and changes of the stored entries.

The store is a plain Parquet table, so a change returns the new snapshot and
the caller writes it to a new folder. Edits, updates and deletions are reduced
to one row per entry first; Catalyst broadcasts them while they are small and
joins by shuffle beyond that.
"""

import json

from pyspark.sql import Window
from pyspark.sql import functions as F

from mendlake.operators.select import first_rows
from mendlake.schema import EDIT_ALIASES, GROUPS, REPO_TYPE, WIRE_SCHEMA, entry_id, group_flag

# Form of a content hash, and of date texts that are accepted.
HASH_PATTERN = r"\A[a-fA-F0-9]{64}\z"
DATE_PATTERN = r"\A\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?([Zz]|[+-]\d{2}:?\d{2})?)?\z"

# Texts read as booleans.
TRUE_TEXTS = ("true", "t", "yes", "y", "on", "1", "1.0")
FALSE_TEXTS = ("false", "f", "no", "n", "off", "0", "0.0")

# Order of arrival; the last two only make it total.
ARRIVAL = ("ingest_timestamp", "repo.commit_date", "repo.commit_hash", "repo.url", "code_fixed")


def flag_value(text):
    low = F.lower(text)
    return F.when(low.isin(*TRUE_TEXTS), F.lit(True)).when(low.isin(*FALSE_TEXTS), F.lit(False))


def parse_time(text):
    ok = F.regexp_like(text, F.lit(DATE_PATTERN))
    # Offsets without a colon are accepted on input but not by the cast.
    colon = F.regexp_replace(text, r"([+-]\d{2})(\d{2})\z", "$1:$2")
    has_clock = F.length(text) > 10
    return F.when(ok, F.when(has_clock, colon).otherwise(text).try_cast("timestamp"))


def validate(wire):
    """Typed entries with ``reasons``: why an entry is refused, empty when it is accepted.

    Columns that are no part of an entry (such as ``file_name``) stay.
    """
    def reason(broken, text):
        return F.when(F.coalesce(broken, F.lit(False)), F.lit(text))

    groups = F.col("labels.groups")
    unreadable_flag = F.exists(
        F.map_entries(groups),
        lambda e: e["key"].isin(*GROUPS) & flag_value(e["value"]).isNull(),
    )
    clang = F.coalesce(F.col("labels.clang"), F.lit("{}"))
    reasons = F.array(
        reason(F.col("code_original").isNull(), "code_original"),
        reason(F.col("code_hash").isNull() | ~F.regexp_like("code_hash", F.lit(HASH_PATTERN)), "code_hash"),
        reason(F.col("repo.url").isNull(), "repo.url"),
        reason(F.col("repo.commit_hash").isNull(), "repo.commit_hash"),
        reason(parse_time(F.col("repo.commit_date")).isNull(), "repo.commit_date"),
        reason(parse_time(F.col("ingest_timestamp")).isNull(), "ingest_timestamp"),
        reason(groups.isNull() | unreadable_flag, "labels.groups"),
        reason(F.from_json(clang, "map<string,string>").isNull(), "labels.clang"),
        reason(F.exists("labels.cppcheck", lambda i: i.isNull()), "labels.cppcheck"),
    )
    found = F.filter(reasons, lambda r: r.isNotNull())
    if "type_errors" in wire.columns:
        found = F.array_distinct(F.concat(found, F.coalesce("type_errors", F.array().cast("array<string>"))))
    flags = [
        F.coalesce(flag_value(F.element_at(groups, g)), F.lit(False)).alias(g) for g in GROUPS
    ]
    extra = [c for c in wire.columns if c not in WIRE_SCHEMA.names]
    return wire.select(
        *extra,
        entry_id(F.col("code_hash")).alias("entry_id"),
        "code_original", "code_fixed", "code_hash",
        F.struct(
            F.col("repo.url").alias("url"),
            F.col("repo.commit_hash").alias("commit_hash"),
            parse_time(F.col("repo.commit_date")).alias("commit_date"),
        ).alias("repo"),
        parse_time(F.col("ingest_timestamp")).alias("ingest_timestamp"),
        F.struct(
            F.coalesce("labels.cppcheck", F.array().cast("array<string>")).alias("cppcheck"),
            clang.alias("clang"),
            F.struct(*flags).alias("groups"),
        ).alias("labels"),
        F.array_sort(found).alias("reasons"),
    )


def accepted(validated):
    return validated.filter(F.size("reasons") == 0).drop("reasons")


def rejected(validated):
    return validated.filter(F.size("reasons") > 0)


def with_defaults(entries):
    """Missing issue list, clang object and flags get their defaults."""
    flags = [group_flag(g).alias(g) for g in GROUPS]
    return entries.withColumn("labels", F.struct(
        F.coalesce("labels.cppcheck", F.array().cast("array<string>")).alias("cppcheck"),
        F.coalesce("labels.clang", F.lit("{}")).alias("clang"),
        F.struct(*flags).alias("groups"),
    ))


def one_per_hash(entries, keep="first", order=ARRIVAL):
    """The first (or last) arrival of each content hash.

    Spark keeps one row per hash and task before the shuffle, so any number of
    copies of one text costs one row per task.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    turn = F.asc if keep == "first" else F.desc
    window = Window.partitionBy("code_hash").orderBy(*[turn(c) for c in order])
    return entries.withColumn("_nth", F.row_number().over(window)).filter("_nth = 1").drop("_nth")


def insert_if_new(batch, store, order=ARRIVAL):
    """Entries of the batch that a store with unique content hashes takes up."""
    return one_per_hash(batch, "first", order).join(store.select("code_hash"), "code_hash", "left_anti").select(
        *batch.columns
    )


def insert_outcomes(batch, store):
    """Per content hash of the batch: rows taken up (0 or 1) and rows refused as copies."""
    copies = batch.groupBy("code_hash").agg(F.count(F.lit(1)).alias("n_rows"))
    known = store.select("code_hash").distinct().withColumn("_known", F.lit(1))
    return copies.join(known, "code_hash", "left").select(
        "code_hash",
        F.when(F.col("_known").isNull(), 1).otherwise(0).cast("long").alias("inserted"),
        (F.col("n_rows") - F.when(F.col("_known").isNull(), 1).otherwise(0)).alias("duplicates"),
    )


def import_outcomes(validated, store):
    """How many imported documents were inserted, duplicate, rejected or unreadable.

    ``validated`` is read once: its rows are counted per content hash and state,
    and only these counts meet the hashes of the store.
    """
    good = F.size("reasons") == 0
    state = F.when(good, "accepted").otherwise("rejected")
    if "readable" in validated.columns:
        state = F.when(~F.col("readable"), "unreadable").otherwise(state)
    counted = (
        validated.select(state.alias("state"), F.when(good, F.col("code_hash")).alias("code_hash"))
        .groupBy("state", "code_hash").agg(F.count(F.lit(1)).alias("n"))
    )
    known = store.select("code_hash").distinct().withColumn("_known", F.lit(1))
    fresh = (F.col("state") == "accepted") & F.col("_known").isNull()

    def total(condition, n):
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    totals = counted.join(known, "code_hash", "left").agg(
        total(fresh, F.lit(1)).alias("inserted"),
        total(F.col("state") == "accepted", F.col("n") - fresh.cast("long")).alias("duplicate"),
        total(F.col("state") == "rejected", F.col("n")).alias("rejected"),
        total(F.col("state") == "unreadable", F.col("n")).alias("unreadable"),
    )
    return totals.select(F.inline(F.array(*[
        F.struct(F.lit(o).alias("outcome"), F.col(o).alias("n_documents"), F.lit(o != "inserted").alias("is_error"))
        for o in ("inserted", "duplicate", "rejected", "unreadable")
    ])))


# Dotted paths that an update may set, with their types.
UPDATABLE = {
    "code_original": "string",
    "code_fixed": "string",
    "code_hash": "string",
    "repo.url": "string",
    "repo.commit_hash": "string",
    "repo.commit_date": "timestamp",
    "ingest_timestamp": "timestamp",
    "labels.cppcheck": "array<string>",
    "labels.clang": "string",
    **{f"labels.groups.{g}": "boolean" for g in GROUPS},
}


def _with_paths(entries, new_values):
    """Entries with the leaf at each dotted path replaced by a Column.

    Structs are put together anew from their leaves; chained ``withField`` calls
    on nested paths would double the expression with each call.
    """
    def leaf(path, name):
        return new_values.get(path, F.col(path)).alias(name)

    changed = {
        "repo": F.struct(*[leaf(f"repo.{f}", f) for f in REPO_TYPE.names]),
        "labels": F.struct(
            leaf("labels.cppcheck", "cppcheck"), leaf("labels.clang", "clang"),
            F.struct(*[leaf(f"labels.groups.{g}", g) for g in GROUPS]).alias("groups"),
        ),
    }
    changed.update({path: c for path, c in new_values.items() if "." not in path})
    return entries.withColumns(changed)


NOT_NULL = frozenset(UPDATABLE) - {"code_fixed"}

# Parts of an entry that an update may replace as a whole: leaf and default of each field.
REPLACEABLE = {
    "repo": {f: (f"repo.{f}", None) for f in REPO_TYPE.names},
    "labels.groups": {g: (f"labels.groups.{g}", "false") for g in GROUPS},
    "labels": {
        "cppcheck": ("labels.cppcheck", "[]"), "clang": ("labels.clang", "{}"),
        **{f"groups.{g}": (f"labels.groups.{g}", "false") for g in GROUPS},
    },
}


def as_update(spark, entry_id, data, seq=0):
    """One update, of dotted paths to Python values, as a row for ``update_entries``."""
    def as_text(v):
        if v is None or isinstance(v, str):
            return v
        return v.isoformat() if hasattr(v, "isoformat") else json.dumps(v, ensure_ascii=False)

    fields = {path: as_text(v) for path, v in data.items()}
    return spark.createDataFrame([(entry_id, seq, fields)], "entry_id string, seq bigint, fields map<string,string>")


def as_edit(spark, entry_id, add=(), remove=(), seq=0):
    """One label edit as a row for ``patch_labels``."""
    if not add and not remove:
        raise ValueError("a label edit needs labels to add or to remove")
    return spark.createDataFrame(
        [(entry_id, seq, list(add), list(remove))],
        "entry_id string, seq bigint, add array<string>, remove array<string>",
    )


def latest_settings(updates):
    """One row per entry with its last value per path.

    ``updates`` has ``entry_id, seq, fields``; ``fields`` maps a dotted path to
    the new value as text (JSON for lists and for whole parts; null sets null).
    Replacing a whole part sets all its fields. An unknown path stays as it is
    and is refused by ``update_entries``.
    """
    path, value = F.col("path"), F.col("value")
    leaves = F.when(path.isin(*UPDATABLE), F.array(F.struct(path.alias("leaf"), value.alias("text"))))
    for part, fields in REPLACEABLE.items():
        leaves = leaves.when(path == part, F.array(*[
            F.struct(
                F.lit(leaf).alias("leaf"),
                F.coalesce(F.get_json_object(value, f"$.{field}"), F.lit(default).cast("string")).alias("text"),
            )
            for field, (leaf, default) in fields.items()
        ]))
    leaves = leaves.otherwise(F.array(F.struct(path.alias("leaf"), value.alias("text"))))
    return (
        updates.select("entry_id", "seq", F.explode("fields").alias("path", "value"))
        .select("entry_id", "seq", F.inline(leaves))
        .groupBy("entry_id", "leaf")
        .agg(F.max(F.struct("seq", "text"))["text"].alias("text"))
        .groupBy("entry_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("leaf", "text"))).alias("_set"))
    )


def update_entries(store, updates, holders=None):
    """New snapshot after setting fields by entry id; other entries stay as they are.

    Adds ``matched``, ``modified`` and ``refused``: an update that changes nothing
    matches its entry without modifying it. Where a path is unknown, a value is
    of the wrong form, a field that must be there would become null, or a new
    content hash is taken, the entry stays as it is and ``refused`` lists the
    paths. Of several entries that get one hash, none does. ``holders`` (entry_id,
    code_hash) has all entries whose hashes are taken, where ``store`` is a part.
    """
    settings = latest_settings(updates)
    taken = _taken_hashes(store if holders is None else holders, settings)
    joined = store.join(settings, "entry_id", "left").join(taken, "entry_id", "left")
    new_values, changed, wrong = {}, F.lit(False), []
    for path, kind in UPDATABLE.items():
        text = F.element_at("_set", path)
        if kind == "timestamp":
            value = parse_time(text)
        elif kind == "boolean":
            value = flag_value(text)
        elif kind.startswith("array"):
            value = F.from_json(text, kind)
        else:
            value = text
        given = F.coalesce(F.map_contains_key("_set", path), F.lit(False))
        new = F.when(given & (F.size("_refused") == 0), value).otherwise(F.col(path))
        new_values[path] = new
        changed = changed | ~new.eqNullSafe(F.col(path))
        bad = value.isNull() if path in NOT_NULL else text.isNotNull() & value.isNull()
        if path == "code_hash":
            bad = bad | ~F.regexp_like(value, F.lit(HASH_PATTERN)) | F.coalesce("_hash_taken", F.lit(False))
        elif path == "labels.clang":
            bad = bad | F.from_json(value, "map<string,string>").isNull()
        elif path == "labels.cppcheck":
            bad = bad | F.exists(value, lambda i: i.isNull())
        wrong.append(F.when(given & F.coalesce(bad, F.lit(True)), F.lit(path)))
    unknown = F.filter(F.map_keys("_set"), lambda k: ~k.isin(*UPDATABLE))
    refused = F.array_sort(F.concat(F.filter(F.array(*wrong), lambda r: r.isNotNull()), unknown))
    nothing = F.array().cast("array<string>")
    flagged = joined.withColumn("_refused", F.coalesce(refused, nothing)).withColumn("matched", F.col("_set").isNotNull())
    flagged = flagged.withColumn("modified", changed)
    return _with_paths(flagged, new_values).select(
        *store.columns, "matched", "modified", F.col("_refused").alias("refused"))


def _taken_hashes(store, settings):
    """``entry_id, _hash_taken`` of updates whose new hash another entry has or gets."""
    wanted = settings.select("entry_id", F.element_at("_set", "code_hash").alias("code_hash")).filter("code_hash IS NOT NULL")
    holders = store.select(F.col("entry_id").alias("_other"), "code_hash").join(
        wanted.select("code_hash").distinct(), "code_hash", "left_semi").select("_other", "code_hash")
    claims = holders.union(wanted.select("entry_id", "code_hash")).distinct().groupBy("code_hash").agg(
        F.count(F.lit(1)).alias("_n"))
    return wanted.join(claims, "code_hash").select("entry_id", (F.col("_n") > 1).alias("_hash_taken"))


def delete_entries(store, ids):
    """New snapshot without the listed entries."""
    return store.join(ids.select("entry_id"), "entry_id", "left_anti").select(*store.columns)


def deleted_entries(store, ids):
    """The entries that ``delete_entries`` removes."""
    return store.join(ids.select("entry_id"), "entry_id", "left_semi").select(*store.columns)


def label_changes(edits):
    """Net effect of label edits, one row per entry.

    ``edits`` has ``entry_id, seq, add, remove``. An edit adds first and removes
    then; edits of an entry apply in order of ``seq``. Group names and their
    aliases set flags, every other label goes to the issue list. The result has
    ``flags`` (map), ``dropped`` (labels whose old occurrences go) and
    ``appended`` (labels to add at the end, in order).

    Everything is reduced per (entry, label) by aggregates that combine within
    tasks, so an entry with very many edits does not gather in one task.
    """
    aliases = F.create_map(*[F.lit(x) for pair in EDIT_ALIASES.items() for x in pair])

    def step(removing):
        return lambda x, i: F.struct(
            F.coalesce(aliases[x], x).alias("label"), aliases[x].isNotNull().alias("is_flag"),
            F.lit(removing).alias("removing"), i.alias("at"),
        )

    steps = edits.select(
        "entry_id", "seq", F.inline(F.concat(F.transform("add", step(False)), F.transform("remove", step(True))))
    ).filter("label IS NOT NULL")
    per_label = steps.groupBy("entry_id", "label", "is_flag").agg(
        F.max(F.when(F.col("removing"), F.col("seq"))).alias("last_removal"),
        F.max(F.when(~F.col("removing"), F.col("seq"))).alias("last_addition"),
    )
    # Within one edit the removal comes last, so only a later edit adds again.
    present = F.col("last_addition").isNotNull() & (
        F.col("last_removal").isNull() | (F.col("last_addition") > F.col("last_removal"))
    )
    places = (
        steps.filter("NOT removing AND NOT is_flag")
        .join(per_label.filter(~F.col("is_flag") & present).select("entry_id", "label", "last_removal"),
              ["entry_id", "label"])
        .filter("last_removal IS NULL OR seq > last_removal")
        .groupBy("entry_id", "label")
        .agg(F.min(F.struct("seq", "at")).alias("place"))
    )
    is_flag, none = F.col("is_flag"), F.lit(None)
    effects = per_label.select(
        "entry_id",
        F.when(is_flag, F.struct("label", present)).alias("flag"),
        F.when(~is_flag & F.col("last_removal").isNotNull(), F.col("label")).alias("dropped"),
        none.alias("added"),
    ).unionByName(places.select(
        "entry_id", none.alias("flag"), none.alias("dropped"), F.struct("place", "label").alias("added")
    ))
    return effects.groupBy("entry_id").agg(
        F.map_from_entries(F.collect_list("flag")).alias("flags"),
        F.collect_list("dropped").alias("dropped"),
        F.transform(F.array_sort(F.collect_list("added")), lambda x: x["label"]).alias("appended"),
    )


def patch_labels(store, edits):
    """New snapshot after label edits, with ``matched`` for entries that had one."""
    joined = store.join(label_changes(edits).withColumn("matched", F.lit(True)), "entry_id", "left")
    nothing = F.array().cast("array<string>")
    dropped, appended = F.coalesce("dropped", nothing), F.coalesce("appended", nothing)
    kept = F.filter("labels.cppcheck", lambda x: ~F.array_contains(dropped, x))
    new_values = {
        "labels.cppcheck": F.concat(kept, F.filter(appended, lambda x: ~F.array_contains(kept, x))),
        **{
            f"labels.groups.{g}": F.coalesce(F.element_at("flags", g), F.col(f"labels.groups.{g}"))
            for g in GROUPS
        },
    }
    return _with_paths(joined, new_values).select(
        *store.columns, F.coalesce("matched", F.lit(False)).alias("matched")
    )


def unmatched(changes, store):
    """Edits, updates or deletions that name an entry the store does not have."""
    return changes.join(store.select("entry_id"), "entry_id", "left_anti")


def first_entries(entries, target, order=ARRIVAL):
    """The first ``target`` entries in arrival order; content hashes must be unique."""
    return first_rows(entries, map(F.col, order), target, "code_hash")
