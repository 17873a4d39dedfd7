import os.path

from pyspark.sql import functions as F

from mendlake.functions import text as X

BLANK_CASES = [
    "", " ", "a", "  a b  ", "\t\r\n x \x1c\x1d\x1e\x1f", "\x85\xa0 y　 ", "​z​", "\x00q\x00",
    "é  ü", "\n\n", "a ", "x" + " " * 5000 + "y" + " " * 5000,
]
PATHS = [
    "a.cpp", "src/a.cpp", "/a.cpp", "//a.h", "src/.hidden", "src/..b.c", "src/x.y.z.hpp", "dir.d/file", "a.", "...", "",
    "a/b/", "src//a.cc", "é/ü.cxx", ".a.b", "x/...c.h",
]


def test_strip(evaluate):
    assert evaluate(X.py_strip, BLANK_CASES) == [c.strip() for c in BLANK_CASES]
    assert evaluate(X.py_rstrip, BLANK_CASES) == [c.rstrip() for c in BLANK_CASES]


def test_lines(evaluate):
    cases = BLANK_CASES + [
        "a\nb", "a\nb\n", "a\r\nb\rc", "a\n\nb\n\n", "\r\n", "\n\r", "a\x0bb\x0cc\x1cd\x1de\x1ef\x85g h i",
        "trailing ", "a\x1fb", "\r\r\n\n",
    ]
    assert evaluate(X.py_lines, cases) == [c.splitlines() for c in cases]
    assert evaluate(X.py_lines, [None]) == [None]


def test_path_parts(evaluate):
    assert evaluate(X.dir_name, PATHS) == [os.path.dirname(p) for p in PATHS]
    assert evaluate(X.base_name, PATHS) == [os.path.basename(p) for p in PATHS]
    assert evaluate(X.extension, PATHS) == [os.path.splitext(os.path.basename(p))[1] for p in PATHS]
    assert evaluate(X.stem, PATHS) == [os.path.splitext(os.path.basename(p))[0] for p in PATHS]


def test_slug(evaluate):
    cases = {
        "https://github.com/o/r": "o/r", "https://github.com/o/r.git": "o/r", "git@github.com/o/r/tree/main": "o/r",
        "https://github.com/o/r.git/": "o/r.git", "https://example.org/o/r": None, "": None,
        "https://github.com/o": None, "https://github.com/o/r.gitx": "o/r.gitx",
    }
    assert evaluate(X.repo_slug, list(cases)) == list(cases.values())


def test_safe_name(evaluate):
    cases = ["a/b c.json", "é-ü_1.x", "<>:", "٣x"]
    want = ["".join(ch for ch in c if ch.isalnum() or ch in "-_.") for c in cases]
    assert evaluate(X.safe_name, cases) == want


def test_code_block(spark):
    rows = [("  h \n", "\n i "), ("", "i"), ("h", " \t"), ("", "")]
    df = spark.createDataFrame(rows, "h string, i string")
    got = [r[0] for r in df.select(X.code_block(F.col("h"), F.col("i"))).collect()]
    assert got == ["h\ni", "i", "h", ""]


def test_hash(evaluate):
    import hashlib

    cases = ["", "é\n", "int x;"]
    assert evaluate(X.sha256_hex, cases) == [hashlib.sha256(c.encode()).hexdigest() for c in cases]
