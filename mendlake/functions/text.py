"""Text, path and hash expressions with the results of Python's str and os.path."""

from pyspark.sql import functions as F

# The characters str.strip() removes, and str.splitlines() breaks at.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
LINE_BREAKS = ("\r\n", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x85", "\u2028", "\u2029")

# File endings of C++ headers and implementations, in lookup order.
HEADER_EXTENSIONS = (".h", ".hpp")
IMPL_EXTENSIONS = (".cpp", ".cxx", ".cc")


def py_strip(c):
    return F.btrim(c, F.lit(WHITESPACE))


def py_rstrip(c):
    return F.rtrim(c, F.lit(WHITESPACE))


def py_lines(c):
    """``str.splitlines``: one final line break adds no line, empty text has none.

    Plain replacements and a one-character split are several times faster than
    one regular expression with all the breaks.
    """
    for mark in LINE_BREAKS:
        c = F.replace(c, F.lit(mark), F.lit("\n"))
    lines = F.split(c, "\n")
    return F.when(F.element_at(lines, -1) == "", F.slice(lines, 1, F.size(lines) - 1)).otherwise(lines)


def sha256_hex(c):
    return F.sha2(c, 256)


def repo_slug(url):
    """``owner/name`` of a GitHub address, null for any other address."""
    clean = F.regexp_replace(url, r"\.git\z", "")
    pattern = r"github\.com/([^/]+)/([^/]+)"
    return F.when(
        F.regexp_like(clean, F.lit(pattern)),
        F.concat_ws("/", F.regexp_extract(clean, pattern, 1), F.regexp_extract(clean, pattern, 2)),
    )


def base_name(path):
    return F.substring_index(path, "/", -1)


def dir_name(path):
    head = F.left(path, F.length(path) - F.length(base_name(path)))
    trimmed = F.rtrim(head, F.lit("/"))
    return F.when(trimmed == "", head).otherwise(trimmed)


def join_path(directory, name):
    return F.when((directory == "") | F.endswith(directory, F.lit("/")), F.concat(directory, name)).otherwise(
        F.concat(directory, F.lit("/"), name)
    )


def extension(path):
    """``os.path.splitext``: leading dots of the file name start no extension."""
    name = F.ltrim(base_name(path), F.lit("."))
    return F.when(name.contains("."), F.concat(F.lit("."), F.substring_index(name, ".", -1))).otherwise(F.lit(""))


def stem(path):
    name = base_name(path)
    return F.left(name, F.length(name) - F.length(extension(path)))


def safe_name(c):
    return F.regexp_replace(c, r"[^\p{L}\p{N}._-]", "")


def code_block(header, implementation):
    """Header and implementation, stripped, blank parts left out, header first."""
    return F.concat_ws("\n", F.nullif(py_strip(header), F.lit("")), F.nullif(py_strip(implementation), F.lit("")))
