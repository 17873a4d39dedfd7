"""Issue ids and messages in the text output of static analyzers."""

from pyspark.sql import functions as F

from mendlake.functions.text import py_strip

# Notices of the analyzer about itself.
NOTICES = (
    "missingInclude",
    "missingIncludeSystem",
    "unmatchedSuppression",
    "checkersReport",
    "normalCheckLevelMaxBranches",
)


def cppcheck_id(line):
    """Id in the first ``[word]`` of a line; null when there is none or it is a notice."""
    found = F.regexp_extract(line, r"(?U)\[(\w+)\]", 1)
    return F.when((found != "") & ~found.isin(*NOTICES), found)


def clang_issue(line):
    """``struct(id, message)`` of a clang-tidy line; null for a line without a finding.

    The id stands between the last ``[`` and the last ``]``, the message between
    ``warning:`` or ``error:`` and that bracket.
    """
    absent_file = line.contains("'#include' file not found") | (
        line.contains("fatal error:") & (line.contains("file not found") | line.contains("no such file"))
    )
    begin = F.greatest(F.locate("warning:", line), F.locate("error:", line))
    after_bracket = F.substring_index(line, "[", -1)
    closed = F.length(after_bracket) - F.length(F.substring_index(after_bracket, "]", -1)) - 1
    before_bracket = F.left(line, F.length(line) - F.length(after_bracket) - 1)
    named = F.struct(
        F.left(after_bracket, closed).alias("id"),
        py_strip(F.substr(before_bracket, begin)).alias("message"),
    )
    generic = F.struct(
        F.lit("generic-warning").alias("id"),
        py_strip(F.split(line, "warning:")[1]).alias("message"),
    )
    return (
        F.when(begin == 0, None)
        .when(absent_file, None)
        .when(line.contains("[") & line.contains("]"), named)
        .when(line.contains("warning:"), generic)
    )
