"""Filters, sorting and paging over entries."""

import datetime
import json
import re
from functools import reduce

from pyspark.sql import functions as F

from mendlake.operators.select import first_rows
from mendlake.schema import COARSE_GROUPS, FILTER_ALIASES, GROUPS, QUALITY, QUALITY_GROUPS, group_flag

# Texts that set a flag parameter; any other text leaves it open.
YES = ("true", "1", "yes", "y")
NO = ("false", "0", "no", "n")

KINDS = {
    "entry_id": "string", "_id": "string", "code_original": "string", "code_fixed": "string",
    "code_hash": "string", "repo.url": "string", "repo.commit_hash": "string",
    "repo.commit_date": "time", "ingest_timestamp": "time", "labels.cppcheck": "array",
    "labels.clang": "json",
    **{f"labels.groups.{g}": "flag" for g in GROUPS + (QUALITY,)},
}
STRUCTS = {
    "repo": ("url", "commit_hash", "commit_date"),
    "labels": ("cppcheck", "clang", "groups"),
    "labels.groups": GROUPS,
}


def all_of(conditions):
    return reduce(lambda a, b: a & b, conditions) if conditions else F.lit(True)


def any_of(conditions):
    return reduce(lambda a, b: a | b, conditions) if conditions else F.lit(False)


def flag_is(name, value):
    """A flag filter that Parquet row groups can be pruned by; a missing flag is false."""
    names = QUALITY_GROUPS if name == QUALITY else (name,)
    flags = [F.col(f"labels.groups.{g}") for g in names]
    if value:
        return any_of([f == F.lit(True) for f in flags])
    return all_of([f.isNull() | (f == F.lit(False)) for f in flags])


def labels_filter(labels):
    """Entries with all the named labels: groups by name or alias, else issue ids."""
    return all_of([
        flag_is(FILTER_ALIASES[x], True) if x in FILTER_ALIASES else F.array_contains("labels.cppcheck", x)
        for x in labels
    ])


def params_filter(**params):
    """Condition from ``repo_url``, ``commit_hash``, ``code_hash`` and ``has_<group>`` texts."""
    conditions = []
    for name, path in (("repo_url", "repo.url"), ("commit_hash", "repo.commit_hash"), ("code_hash", "code_hash")):
        if params.get(name):
            conditions.append(F.col(path) == params[name])
    for g in COARSE_GROUPS:
        text = str(params.get(f"has_{g}", "")).lower()
        if text in YES:
            conditions.append(flag_is(g, True))
        elif text in NO:
            conditions.append(flag_is(g, False))
    return all_of(conditions)


def _field(path):
    """Column and kind at a dotted path; an unknown path is a missing field."""
    kind = KINDS.get(path)
    if kind == "flag":
        return group_flag(path.rsplit(".", 1)[1]), kind
    if kind:
        return F.col("entry_id" if path == "_id" else path), kind
    if re.fullmatch(r"labels\.cppcheck\.\d+", path):
        return F.get("labels.cppcheck", F.lit(int(path.rsplit(".", 1)[1]))), "string"
    if path.startswith("labels.clang."):
        steps = "".join(f"[{s}]" if s.isdigit() else f"['{s}']" for s in path.split(".")[2:])
        return F.get_json_object("labels.clang", "$" + steps), "jsonvalue"
    return F.lit(None).cast("string"), "missing"


def _same_kind(kind, value):
    """Values compare only with fields of their own type."""
    if kind in ("string", "array"):
        return isinstance(value, str)
    if kind == "flag":
        return isinstance(value, bool)
    if kind == "time":
        return isinstance(value, (datetime.date, datetime.datetime))
    return kind == "jsonvalue" and isinstance(value, (str, bool, int, float))


def _compare(c, kind, value, op):
    if value is None:
        return c.isNull() if op in ("$eq", "$gte", "$lte") else F.lit(False)
    if not _same_kind(kind, value):
        return F.lit(False)
    if kind == "jsonvalue" and isinstance(value, bool):
        c, value = c.try_cast("boolean"), F.lit(value)
    elif kind == "jsonvalue" and not isinstance(value, str):
        c, value = c.try_cast("double"), F.lit(float(value))
    else:
        value = F.lit(value)
    return {"$eq": c == value, "$gt": c > value, "$gte": c >= value, "$lt": c < value, "$lte": c <= value}[op]


def _equals(path, value):
    if value is None:
        return (F.col(path) if path in STRUCTS else _field(path)[0]).isNull()
    if path in STRUCTS:
        fields = STRUCTS[path]
        if not isinstance(value, dict) or tuple(value) != fields:
            return F.lit(False)
        return all_of([_equals(f"{path}.{name}", value[name]) for name in fields])
    c, kind = _field(path)
    if kind == "array":
        if isinstance(value, (list, tuple)):
            return c == F.array(*[F.lit(v) for v in value]).cast("array<string>")
        return F.array_contains(c, value) if isinstance(value, str) else F.lit(False)
    if kind == "json":
        if not isinstance(value, dict):
            return F.lit(False)
        return F.to_json(F.parse_json(c)) == F.to_json(F.parse_json(F.lit(json.dumps(value))))
    if kind == "flag" and isinstance(value, bool):
        return flag_is(path.rsplit(".", 1)[1], value)
    return _compare(c, kind, value, "$eq")


def _matches(c, value, options=""):
    flags = "".join(x for x in options if x in "imsx")
    return F.regexp_like(c, F.lit((f"(?{flags})" if flags else "") + value))


def _operator(path, op, value, siblings):
    c, kind = _field(path)
    each = (lambda test: F.exists(c, test)) if kind == "array" else (lambda test: test(c))
    element = "string" if kind == "array" else kind
    if op == "$eq":
        return _equals(path, value)
    if op == "$ne":
        return ~F.coalesce(_equals(path, value), F.lit(False))
    if op in ("$gt", "$gte", "$lt", "$lte"):
        return each(lambda x: _compare(x, element, value, op))
    if op == "$in":
        return any_of([F.coalesce(_equals(path, v), F.lit(False)) for v in value])
    if op == "$nin":
        return ~any_of([F.coalesce(_equals(path, v), F.lit(False)) for v in value])
    if op == "$exists":
        # Stored documents carry every declared field.
        here = c.isNotNull() if kind == "jsonvalue" or path.startswith("labels.cppcheck.") else F.lit(kind != "missing" or path in STRUCTS)
        return here if value else ~here
    if op == "$regex":
        if element not in ("string", "jsonvalue"):
            return F.lit(False)
        return each(lambda x: _matches(x, value, siblings.get("$options", "")))
    if op == "$options":
        return F.lit(True)
    if op == "$not":
        return ~F.coalesce(_on_path(path, value), F.lit(False))
    if op == "$all":
        return all_of([_equals(path, v) for v in value]) if value else F.lit(False)
    if op == "$size":
        return F.size(c) == value if kind == "array" else F.lit(False)
    if op == "$elemMatch":
        if kind != "array":
            return F.lit(False)
        return F.exists(c, lambda x: all_of([_element_test(x, o, v, value) for o, v in value.items()]))
    raise ValueError(f"unsupported operator {op!r}")


def _element_test(x, op, value, siblings):
    if op in ("$eq", "$gt", "$gte", "$lt", "$lte"):
        return _compare(x, "string", value, op)
    if op == "$ne":
        return ~_compare(x, "string", value, "$eq")
    if op == "$in":
        return any_of([_compare(x, "string", v, "$eq") for v in value])
    if op == "$nin":
        return ~any_of([_compare(x, "string", v, "$eq") for v in value])
    if op == "$regex":
        return _matches(x, value, siblings.get("$options", ""))
    if op == "$options":
        return F.lit(True)
    raise ValueError(f"unsupported operator {op!r} in $elemMatch")


def _on_path(path, value):
    if isinstance(value, dict) and value and all(k.startswith("$") for k in value):
        return all_of([_operator(path, op, v, value) for op, v in value.items()])
    return _equals(path, value)


def document_filter(query):
    """Condition from a filter document: dotted paths, equality and ``$`` operators.

    Equality with an issue id means that the list contains it, ``None`` matches
    null and missing fields, negations match missing fields, and values of
    another type than the field never match. An ``_id`` that is no identifier
    matches nothing.
    """
    conditions = []
    for key, value in query.items():
        if key == "$and":
            conditions.append(all_of([document_filter(q) for q in value]))
        elif key == "$or":
            conditions.append(any_of([document_filter(q) for q in value]))
        elif key == "$nor":
            conditions.append(~any_of([F.coalesce(document_filter(q), F.lit(False)) for q in value]))
        elif key == "_id" and isinstance(value, str) and not re.fullmatch(r"[0-9a-fA-F]{24}", value):
            conditions.append(F.lit(False))
        else:
            conditions.append(_on_path(key, value))
    return all_of(conditions)


def sort_columns(sort):
    """Sort order from ``{dotted path: 1 or -1}``; lists sort by their least or greatest item."""
    columns = []
    for path, direction in sort.items():
        c, kind = _field(path)
        if kind == "array":
            c = F.array_min(c) if direction > 0 else F.array_max(c)
        columns.append(c.asc() if direction > 0 else c.desc())
    return columns


def find(entries, query=None, sort=None, limit=None):
    """Filtered entries in the given order, all of them or the first ``limit``.

    A limit of zero or less means all; without a sort, the first by identifier.
    """
    out = entries.filter(document_filter(query)) if query else entries
    if limit is not None and limit > 0:
        return first_rows(out, sort_columns(sort or {}), limit, "entry_id")
    return out.orderBy(*sort_columns(sort), "entry_id") if sort else out


def get_entry(entries, entry_id):
    """The entry with this identifier, or no row."""
    return entries.filter(document_filter({"_id": entry_id}))


def listing(entries):
    """Identifier and label text of each entry, as a list view shows it."""
    return entries.select("entry_id", label_text().alias("labels"))


def label_text(shown=5):
    """Names of the true flags in order, the first ``shown`` and how many more."""
    active = F.filter(
        F.array(*[F.when(group_flag(g), F.lit(g)) for g in GROUPS]), lambda x: x.isNotNull()
    )
    more = F.size(active) - shown
    return F.concat(
        F.array_join(F.slice(active, 1, shown), ", "),
        F.when(more > 0, F.concat(F.lit(" (+"), more.cast("string"), F.lit(" more)"))).otherwise(F.lit("")),
    )
