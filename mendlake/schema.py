"""Stored shape of an entry, group schemes and label names."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

# Category flags of a stored entry, in document order.
GROUPS = (
    "memory_management",
    "invalid_access",
    "uninitialized",
    "concurrency",
    "logic_error",
    "resource_leak",
    "security_portability",
    "unused_code",
    "const_correctness",
    "redundant_code",
    "stl_misuse",
    "class_design",
    "code_style",
)

# The flags that reports, flat files and training use.
SHARED_GROUPS = GROUPS[:7]
QUALITY_GROUPS = GROUPS[7:]
QUALITY = "code_quality_performance"
COARSE_GROUPS = SHARED_GROUPS + (QUALITY,)

# Names accepted in label edits.
EDIT_ALIASES = {
    "MemError": "memory_management",
    "MemoryManagement": "memory_management",
    "InvalidAccess": "invalid_access",
    "Uninitialized": "uninitialized",
    "Concurrency": "concurrency",
    "LogicError": "logic_error",
    "ResourceLeak": "resource_leak",
    "SecurityPortability": "security_portability",
    "UnusedCode": "unused_code",
    "ConstCorrectness": "const_correctness",
    "RedundantCode": "redundant_code",
    "StlMisuse": "stl_misuse",
    "ClassDesign": "class_design",
    "CodeStyle": "code_style",
    **{g: g for g in GROUPS},
}

# Names accepted in label filters.
FILTER_ALIASES = {
    "MemError": "memory_management",
    "MemoryManagement": "memory_management",
    "InvalidAccess": "invalid_access",
    "Uninitialized": "uninitialized",
    "Concurrency": "concurrency",
    "LogicError": "logic_error",
    "ResourceLeak": "resource_leak",
    "SecurityPortability": "security_portability",
    "CodeQualityPerformance": QUALITY,
    **{g: g for g in COARSE_GROUPS},
}

GROUPS_TYPE = T.StructType([T.StructField(g, T.BooleanType()) for g in GROUPS])

LABELS_TYPE = T.StructType([
    T.StructField("cppcheck", T.ArrayType(T.StringType())),
    T.StructField("clang", T.StringType()),
    T.StructField("groups", GROUPS_TYPE),
])

REPO_TYPE = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("commit_hash", T.StringType()),
    T.StructField("commit_date", T.TimestampType()),
])

ENTRY_SCHEMA = T.StructType([
    T.StructField("entry_id", T.StringType()),
    T.StructField("code_original", T.StringType()),
    T.StructField("code_fixed", T.StringType()),
    T.StructField("code_hash", T.StringType()),
    T.StructField("repo", REPO_TYPE),
    T.StructField("ingest_timestamp", T.TimestampType()),
    T.StructField("labels", LABELS_TYPE),
])

# An entry as it arrives, before its values are checked.
WIRE_SCHEMA = T.StructType([
    T.StructField("code_original", T.StringType()),
    T.StructField("code_fixed", T.StringType()),
    T.StructField("code_hash", T.StringType()),
    T.StructField("repo", T.StructType([
        T.StructField("url", T.StringType()),
        T.StructField("commit_hash", T.StringType()),
        T.StructField("commit_date", T.StringType()),
    ])),
    T.StructField("ingest_timestamp", T.StringType()),
    T.StructField("labels", T.StructType([
        T.StructField("cppcheck", T.ArrayType(T.StringType())),
        T.StructField("clang", T.StringType()),
        T.StructField("groups", T.MapType(T.StringType(), T.StringType())),
    ])),
    T.StructField("type_errors", T.ArrayType(T.StringType())),
])


def group_flag(name, groups="labels.groups"):
    """A category flag as a Column; the coarse quality flag is the OR of the finer six."""
    if name == QUALITY:
        flag = F.lit(False)
        for g in QUALITY_GROUPS:
            flag = flag | group_flag(g, groups)
        return flag
    return F.coalesce(F.col(f"{groups}.{name}"), F.lit(False))


def scheme_groups(scheme):
    """Flag names of a scheme: ``fine13`` as stored, ``coarse8`` as reported."""
    if scheme == "fine13":
        return GROUPS
    if scheme in ("coarse8", "reference8"):
        return COARSE_GROUPS
    raise ValueError(f"unknown group scheme {scheme!r}")


def entry_id(code_hash):
    """Identifier of an entry: 24 hex digits of its content hash."""
    return F.substring(code_hash, 1, 24)
