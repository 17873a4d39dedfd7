"""Word runs, token blocks and centroid clusters against plain versions."""

import random
import zlib

import brute
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from mendlake.llm import bpe, centroids, token_blocks, word_runs

DOCS = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("runs", pa.string()), ("ids", pa.string()),
                  ("part", pa.string()), ("before", pa.string()), ("_turn", pa.string()), ("collapsed", pa.string()), ("start", pa.string())])
VECTORS = pa.schema([("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32())), ("label", pa.int32()), ("vector", pa.string()),
                     ("cluster", pa.string()), ("to_pivots", pa.string()), ("distance", pa.string())])


def write(folder, name, schema, rows):
    rows = [(*r, *["extra"] * (len(schema) - len(r))) for r in rows]
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    pq.write_table(pa.table([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema),
                   f"{folder}/{name}.parquet", row_group_size=20)
    return str(folder)


def texts():
    r = random.Random(11)
    rows = [(i, t, lang) for i, t, lang, *_ in brute.documents()]
    rows += [(1000 + i, " ".join(r.choice("ab") for _ in range(r.randint(0, 300))), None) for i in range(40)]
    rows += [(2000 + i, "\n".join(["x", "y", "z"] * 40 + ["q"] * i), None) for i in range(5)]
    rows += [(3000, "w " * 7000, "en"), (None, "no id " * 10, "en"), (-5, "below zero", None), (None, None, None)]
    return rows + rows[:4]


# --- word runs --------------------------------------------------------------------

def test_every_difference_is_covered():
    assert len({(a - b) % word_runs.CYCLE for a in word_runs.COVER for b in word_runs.COVER}) == word_runs.CYCLE


def test_extensions():
    r = random.Random(4)
    for _ in range(150):
        w = [r.randint(1, r.choice([1, 2, 4])) for _ in range(r.randint(2, 250))]
        if r.random() < 0.5:
            w = w[:9] * 30
        e = word_runs.Extensions(np.array(w, np.int32))
        pairs = [sorted(r.sample(range(len(w) + 1), 2)) for _ in range(60)]
        want = [next((d for d in range(len(w) - j) if w[i + d] != w[j + d]), len(w) - j) for i, j in pairs]
        assert e.of(*np.array(pairs).T).tolist() == want


@pytest.mark.parametrize("shortest", [2, 5, 12])
def test_runs(shortest, monkeypatch):
    r = random.Random(shortest)
    monkeypatch.setattr(word_runs, "BLOCK", 50)  # several parts of the grid
    small = word_runs._grid_part(0, 64)
    order = np.argsort(small[0], kind="stable")
    grid = small[0][order], small[1][order], np.searchsorted(small[0][order], np.arange(64), "right")
    monkeypatch.setattr(word_runs, "_small_grid", lambda: grid)
    for _ in range(250):
        n, k = r.choice([0, 1, 2, 11, 12, 13, 40, 63, 64, 65, 200]), r.choice([1, 2, 3, 30])
        w = [r.randint(1, k) for _ in range(n)]
        if n and r.random() < 0.5:
            a = r.randrange(n)
            w = w[:a] + (w[a:a + 1 + (n - a) // r.randint(2, 9)] * n)[:n - a]
        got = [tuple(map(int, x)) for x in word_runs.runs(np.array(w, np.int32), shortest).T]
        assert got == [(s, n, q) for s, q, n in brute.runs(w, shortest)]


def test_word_runs(spark, tmp_path):
    folder = write(tmp_path, "documents", DOCS, texts())
    plain = brute.with_planted_runs([(i, t) for i, t, _ in texts()])
    want = sorted(((i, *brute.run_row(plain[i, t])) for i, t, _ in texts()), key=repr)
    columns = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    got = word_runs.op13_word_runs(spark, folder).select(*columns).collect()
    assert sorted(map(tuple, got), key=repr) == want
    assert sum(r["n_runs"] > 0 for r in got) > 40


def test_runs_and_what_is_left(spark):
    docs = spark.createDataFrame([("k", "a b c " * 4 + "d"), ("k", None)], "name string, text string")
    rows = {r["n_words"]: r for r in word_runs.find_runs(docs, keys=("name",)).collect()}
    assert [tuple(x) for x in rows[13]["runs"]] == [(0, 12, 3)] and rows[13]["collapsed"] == "a b c d"
    assert rows[0]["runs"] == [] and rows[0]["collapsed"] == "" and rows[0]["name"] == "k"


# --- token blocks -----------------------------------------------------------------

def test_elias_fano():
    r = random.Random(9)
    for _ in range(200):
        n, top = r.choice([0, 1, 63, 64, 65, 400]), r.choice([0, 1, 50, 10**6, 2**40])
        values = sorted(r.randint(0, top) for _ in range(n))
        coded = token_blocks.EliasFano.pack(np.array(values, np.uint64))
        e = token_blocks.EliasFano(coded)
        assert e.all().tolist() == values == [e.select(i) for i in range(n)]
    ends = np.cumsum(np.random.default_rng(1).integers(1, 2000, 20000)).astype(np.uint64)
    assert len(token_blocks.EliasFano.pack(ends)) < 20000 * (2 + 10 + 1) / 8 + 2000  # a seventh of a 64-bit table
    with pytest.raises(IndexError):
        e.select(len(values))


def test_block():
    ids = [np.arange(n, dtype="<u2").tobytes() for n in (3, 0, 5)]
    block = token_blocks.Block(token_blocks.pack_block([None, -2**63, 2**63 - 1], ids, 2))
    assert block.doc_ids() == [None, -2**63, 2**63 - 1] and block.starts().tolist() == [0, 3, 3, 8]
    assert [block.document(i).tolist() for i in range(3)] == [[0, 1, 2], [], [0, 1, 2, 3, 4]]
    assert token_blocks.Block(token_blocks.pack_block([None], ids[:1], 2)).doc_ids() == [None]
    with pytest.raises(ValueError):
        token_blocks.Block(b"\0" * 64)


def awkward():
    r = random.Random(6)
    bits = ["a", "b", " ", "\n", "\t", "'s", "é", "\xa0", "1", "!", " ", "\x1f", "\x85", "漢", " the", "<|endoftext|>", "͸"]
    return ["".join(r.choice(bits) for _ in range(r.randint(0, 12))) for _ in range(5000)]


def test_ids_are_those_of_the_library():
    definition = bpe.read_definition()
    tokenizer = bpe.WordTable(definition).tokenizer
    given = [t or "" for _, t, _ in texts()] + awkward()
    coder = token_blocks.UnitCoder(definition)
    want = [np.array(e.ids, "<u2").tobytes() for e in tokenizer.encode_batch(given, add_special_tokens=False)]
    assert coder.width == token_blocks.id_width(definition) == 2
    assert coder.encode(given) == want
    coder = token_blocks.UnitCoder(definition)
    coder.coded.limit = coder.units.limit = 10  # generations change all the time
    assert coder.encode(given) == want and len(coder.units) <= 10 and len(coder.units.old) <= 10


def test_token_blocks(spark, tmp_path):
    rows = texts()
    folder = write(tmp_path, "documents", DOCS, rows)
    tokenizer = bpe.WordTable(bpe.read_definition()).tokenizer
    coded = [(i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]) for i, t, _ in rows]
    coded.sort(key=lambda x: (x[0] is not None, x[0] or 0))  # rows of one id as they were read
    want, start = [], 0
    for i, ids in coded:
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = token_blocks.op12_token_blocks(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_small_blocks_and_lookup(spark, tmp_path):
    docs = spark.createDataFrame([(i % 40 if i % 7 else None, f"text {i} " * (i % 5)) for i in range(200)], "doc_id long, text string")
    definition, path = bpe.read_definition(), str(tmp_path / "blocks")
    token_blocks.write_documents(docs.repartition(3), path, definition, block_ids=50)
    blocks = token_blocks.read_blocks(spark, path)
    assert blocks.count() > 8 and spark.read.parquet(path).agg(F.sum("n_docs")).first()[0] == 200
    every = token_blocks.read_documents(blocks).collect()
    assert len(every) == 200 and sorted(r["doc_id"] for r in every if r["doc_id"] is not None) == sorted(
        i % 40 for i in range(200) if i % 7)
    ends = sorted((r["start"], r["start"] + len(r["ids"]) // 4) for r in every)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
    wanted = spark.createDataFrame([(3,), (17,), (99,), (None,), (3,)], "doc_id long")
    found = token_blocks.lookup(blocks, wanted).collect()
    assert sorted(map(tuple, found)) == sorted(tuple(r) for r in every if r["doc_id"] in (3, 17))


# --- clusters ----------------------------------------------------------------------

def vectors(n=400):
    rng = np.random.default_rng(8)
    middle = rng.normal(size=(5, 64))
    rows = [(i, (middle[i % 5] + 0.4 * rng.normal(size=64)).astype(np.float32).tolist(), 0) for i in range(n)]
    rows[3], rows[4] = (3, None, 0), (4, [1.0] * 63 + [None], 0)
    rows[5], rows[6] = (5, [float("nan")] * 64, 0), (6, [1.0] * 63 + [float("-inf")], 0)
    rows[7], rows[8], rows[9] = (7, [1.0] * 63, 0), (8, [], 0), (9, [3e38] * 64, 0)
    rows += [rows[20], rows[21], (22, rows[23][1], 0), (None, rows[24][1], 0), (None, [0.0] * 64, 0)]
    rows += [(500 + i, [float(v)] * 64, 0) for i, v in enumerate([0, 0, 1, -1, 0.0005, -0.0005])]
    return rows


def steps(rows):
    keep = [(i, v) for i, v, *_ in rows if v is not None and len(v) == 64 and not any(
        x is None or not np.isfinite(x) or abs(x) * 1024 >= centroids.LIMIT for x in v)]
    return [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in keep]


@pytest.mark.parametrize("rows", [vectors(), vectors()[:5], vectors()[-11:-6], [(1, [0.0] * 64, 0)] * 20], ids=["all", "few", "ties", "same"])
def test_clusters(spark, tmp_path, rows):
    folder = write(tmp_path, "embeddings", VECTORS, rows)
    got = centroids.op11_ptolemaic_clusters(spark, folder).collect()
    assert sorted(map(tuple, got), key=repr) == brute.clusters(steps(rows))


def test_bounds_never_exceed_distances():
    rng = np.random.default_rng(3)
    for size in (1, 1000, centroids.LIMIT - 1):
        points, middle, pivots = (rng.integers(-size, size, (n, 6), endpoint=True) for n in (300, 8, 5))
        middle[0], pivots[1], points[0] = points[1], pivots[0], pivots[2]
        cached = np.sqrt(centroids._between(points, pivots).astype(float))
        exact = centroids._between(points, middle)
        low = centroids.Bounds(middle, pivots).squared(cached)
        assert (low <= exact.astype(float) * (1 + centroids.SLACK)).all()
        cluster, distance, _ = centroids.nearest(points, cached, middle, centroids.Bounds(middle, pivots))
        assert (cluster == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()


def test_bounds_spare_distances(spark):
    """In few dimensions, where clusters are apart, most centroids are left out unmeasured."""
    rng = np.random.default_rng(2)
    rows = [(i, (rng.integers(0, 100, 2) + 10000 * np.array([i % 8, i % 8 * (i % 3)])).tolist()) for i in range(800)]
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>")
    assigned, _, taken = centroids.cluster(df)
    assert assigned.count() == 800 and taken < 0.4 * 800 * 8 * centroids.ROUNDS
