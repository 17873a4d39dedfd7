"""Small hand-made rows."""

import datetime as dt
import hashlib

from mendlake.schema import ENTRY_SCHEMA, GROUPS

T0 = dt.datetime(2024, 1, 15, 9, 30)

TAXONOMY = [
    ("memleak", "memory_management", False), ("nullPointer", "invalid_access", False),
    ("uninitvar", "uninitialized", False), ("zerodiv", "logic_error", False),
    ("cstyleCast", "code_style", False), ("unusedVariable", "unused_code", False),
    ("syntaxError", None, True), ("idx", None, True),
]
TAXONOMY_SCHEMA = "issue_id string, category string, ignored boolean"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def entry(n, code=None, fixed="fixed", minutes=0, cppcheck=(), url="https://github.com/o/a", clang="{}", **flags):
    code = f"int x{n};" if code is None else code
    return (
        f"{n:024x}", code, fixed, sha(code),
        (url, f"c{n}", T0 - dt.timedelta(days=1)), T0 + dt.timedelta(minutes=minutes),
        (list(cppcheck), clang, tuple(bool(flags.get(g, False)) for g in GROUPS)),
    )


def entries(spark, *rows):
    return spark.createDataFrame(list(rows), ENTRY_SCHEMA)


def ids(df):
    return sorted(int(r["entry_id"], 16) for r in df.select("entry_id").collect())


__all__ = ["T0", "TAXONOMY", "TAXONOMY_SCHEMA", "entries", "entry", "ids", "sha"]
