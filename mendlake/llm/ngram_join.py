"""Similarity join on sets of word n-grams with prefix trees.

Two texts link when the Jaccard similarity of their sets of four-word shingles
is 0.85 or more. A join in three steps loses no link:

* Shingles are ordered by hash. A set can miss fewer than ``p`` of its shingles
  in a partner's, so of its first ``2p - 1`` at least ``p`` are among the first
  of the partner's as well. Sets that share fewer with all others together have
  no partner; these are nearly all that aren't near copies.
* Of the shared shingles, the rarest suffice to bring partners together. They
  group sets into coarse components, of which links never lead out.
* In each coarse component, sets are stored in a prefix tree whose paths hold the
  shingles from the most frequent on. A probe walks the tree with the overlap of
  the path so far and leaves subtrees that remaining lengths rule out.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mendlake.llm.common import row_key, settle, table
from mendlake.llm.postings import PACKED, bucket_count, components, pack, shared_tokens

SHINGLE = 4
#: Similarity in percent.
PERCENT = 85
#: Sets of a coarse component that meet in one task; larger components are dealt out in pairs of blocks.
BLOCK_SETS = 2000

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0x27D4EB2F165667C5], np.uint64)


class WordHashes(dict):
    """Hashes of words, kept while they are few enough."""

    def __missing__(self, word):
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingle_set(text, hashes, k=SHINGLE):
    """Sorted distinct 64-bit hashes of the k-word shingles; of fewer words, one of the whole sequence."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # both on ASCII only
    if not words:
        return np.empty(0, np.uint64)
    coded = np.fromiter((hashes[w] for w in words), np.uint64, len(words))
    width = min(k, len(words))
    mixed = np.full(len(words) - width + 1, width if width < k else 0, np.uint64)
    for i in range(width):
        mixed += coded[i:len(words) - width + 1 + i] * _MIX[i]
    mixed ^= mixed >> np.uint64(31)
    mixed *= _MIX[1]
    mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def prefix_length(n, percent=PERCENT):
    """A set of ``n`` misses fewer than so many of its shingles in a partner's set."""
    return n - -(-percent * n // 100) + 1


def _sets(batches, out, k):
    hashes = WordHashes()
    for batch in batches:
        texts = batch.column("text")
        yield out(batch, (shingle_set(t.as_py() or "", hashes, k) for t in texts))


def document_prefixes(docs, k=SHINGLE, percent=PERCENT):
    """(doc_id, ``text_id``, ``text_key``, ``n_shingles``, ``prefix``): the first shingles in hash order, packed.

    ``text_id`` is a 64-bit hash of the text by which shingles are routed; texts
    that chance to share it are still two. Copies agree in the 128-bit key.
    """
    def run(batches):
        def out(batch, sets):
            sizes, prefixes = [], []
            for s in sets:
                sizes.append(len(s))
                prefixes.append(s[:2 * prefix_length(len(s), percent) - 1].astype("<u8").tobytes() if len(s) else b"")
            return pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "text_id", "text_key")), pa.array(sizes, pa.int64()),
                 pa.array(prefixes, pa.binary())],
                names=["doc_id", "text_id", "text_key", "n_shingles", "prefix"])
        return _sets(batches, out, k)

    source = docs.select("doc_id", F.xxhash64("text").alias("text_id"), row_key("text").alias("text_key"), "text")
    return source.mapInArrow(run, "doc_id long, text_id long, text_key binary, n_shingles long, prefix binary")


def coarse_components(prefixes, percent=PERCENT):
    """(``text_id``, ``component``): texts that may link; no link leads out of a component."""
    total = prefixes.agg(F.sum(F.length("prefix"))).first()[0] or 0
    n_buckets = bucket_count(total // 8)

    def packed(batches):
        def columns():
            for b in batches:
                found = b.column("prefix").to_pylist()
                lengths = np.array([len(p) // 8 for p in found], np.int64)
                yield b.column("text_id").to_numpy(), lengths, np.frombuffer(b"".join(found), "<u8")
        return pack(columns(), n_buckets)

    shared = shared_tokens(prefixes.filter("n_shingles > 0").select("text_id", "prefix").mapInArrow(packed, PACKED))
    sizes = prefixes.filter("n_shingles > 0").groupBy(F.col("text_id").alias("owner")).agg(F.max("n_shingles").alias("n"))
    gathered = shared.groupBy("owner").agg(
        F.flatten(F.collect_list(F.arrays_zip("counts", "tokens"))).alias("found")
    ).join(sizes, "owner")
    # The partner may be smaller, down to this share of this set, and then has fewer to share.
    least = F.ceil(F.lit(percent) * F.col("n") / 100)
    needed = (least - F.ceil(F.lit(percent) * least / 100) + 1).cast("int")
    routed = gathered.withColumn("needed", needed).filter(F.size("found") >= F.col("needed")).select(
        "owner", F.explode(F.slice(F.sort_array("found"), 1, F.size("found") - F.col("needed") + 1)).alias("t")
    ).select("owner", F.col("t.tokens").alias("token"))
    routed = settle(routed, "routed")
    hubs = routed.groupBy("token").agg(F.min("owner").alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    links = routed.join(hubs, "token").filter("owner <> hub").select(F.col("owner").alias("a"), F.col("hub").alias("b"))
    return components(links, "coarse").withColumnRenamed("node", "text_id")


class Node:
    """A run of shingle ranks, with the range of set sizes below it."""

    __slots__ = ("run", "children", "here", "low", "high", "one", "alike")

    def __init__(self, run, low, high, one, alike=True):
        self.run, self.children, self.here = run, {}, []
        self.low, self.high, self.one, self.alike = low, high, one, alike


class PrefixTree:
    """Sets of ranks in increasing order; finds links and joins them to groups as sets come in.

    ``sizes`` are the sizes of the whole sets, of which ``ranks`` may leave out
    what no other set has. A subtree whose sets are all in the group of the
    probe is skipped, so a group of copies costs one comparison each.
    """

    def __init__(self, ranks, sizes, n_ranks, percent=PERCENT):
        self.percent = percent
        self.ranks, self.sizes, self.mark = ranks, sizes, np.zeros(n_ranks + 1, bool)
        self.root = Node(np.empty(0, np.int64), 1 << 60, 0, None)
        self.group = list(range(len(ranks)))

    def find(self, i):
        while self.group[i] != i:
            self.group[i] = self.group[self.group[i]]
            i = self.group[i]
        return i

    def add(self, i):
        self._probe(i)
        self._insert(i)

    def _probe(self, i):
        x, size, percent = self.ranks[i], self.sizes[i], self.percent
        self.mark[x] = True
        todo = [(self.root, 0, 0)]
        while todo:
            node, overlap, depth = todo.pop()
            if node.one is None or 100 * node.high < percent * size or percent * node.low > 100 * size:
                continue
            if node.alike and self.find(node.one) == self.find(i):
                continue
            left = len(x)
            if len(node.run):
                overlap += int(np.count_nonzero(self.mark[node.run]))
                depth += len(node.run)
                left -= int(np.searchsorted(x, node.run[-1], "right"))
            # Overlap needed with a set of size s: 185 * overlap >= 85 * (size + s), for 85 percent.
            if (100 + percent) * (node.high - depth + overlap) < percent * (size + node.high):
                continue
            if (100 + percent) * (overlap + left) < percent * (size + node.low):
                continue
            for j in node.here:
                if (100 + percent) * overlap >= percent * (size + self.sizes[j]):
                    a, b = self.find(i), self.find(j)
                    if a != b:
                        self.group[max(a, b)] = min(a, b)
            todo.extend((child, overlap, depth) for child in node.children.values())
        self.mark[x] = False

    def _insert(self, i):
        node, rest, size = self.root, self.ranks[i], self.sizes[i]
        while True:
            node.alike = node.one is None or node.alike and self.find(node.one) == self.find(i)
            node.one = i if node.one is None else node.one
            node.low, node.high = min(node.low, size), max(node.high, size)
            if not len(rest):
                node.here.append(i)
                return
            child = node.children.get(int(rest[0]))
            if child is None:
                node.children[int(rest[0])] = leaf = Node(rest, size, size, i)
                leaf.here.append(i)
                return
            n = min(len(rest), len(child.run))
            differ = np.flatnonzero(rest[:n] != child.run[:n])
            same = int(differ[0]) if len(differ) else n
            if same < len(child.run):
                upper = Node(child.run[:same], child.low, child.high, child.one, child.alike)
                child.run = child.run[same:]
                upper.children[int(child.run[0])] = child
                node.children[int(rest[0])] = child = upper
            node, rest = child, rest[same:]


def tree_links(sets, percent=PERCENT):
    """For each of the linked sets (sorted arrays) a pair of its position and that of the first set of its group."""
    everything = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    tokens, places, counts = np.unique(everything, return_inverse=True, return_counts=True)
    order = np.lexsort((tokens, -counts))
    rank = np.empty(len(tokens), np.int64)
    rank[order] = np.arange(len(tokens))
    n_shared = int(np.count_nonzero(counts > 1))
    ranks = [np.sort(r[r < n_shared]) for r in np.split(rank[places], np.cumsum([len(s) for s in sets])[:-1])]
    tree = PrefixTree(ranks, [len(s) for s in sets], n_shared, percent)
    for i in range(len(sets)):
        tree.add(i)
    return [(i, tree.find(i)) for i in range(len(sets)) if tree.find(i) != i]


def _group_links(group, percent):
    sets = [np.frombuffer(s, "<u8") for s in group.column("shingles").to_pylist()]
    ids = group.column("doc_id").to_numpy()
    pairs = np.array(tree_links(sets, percent), np.int64).reshape(-1, 2)
    return pa.table({"a": pa.array(ids[pairs[:, 0]]), "b": pa.array(ids[pairs[:, 1]])})


def similar_groups(docs, k=SHINGLE, percent=PERCENT):
    """``docs(doc_id, text)`` as doc_id, ``n_shingles`` and ``component_id``.

    Texts link when their sets of ``k``-word shingles are similar to ``percent`` or more.
    A-Z count as a-z; words are runs of anything but ASCII white space. The
    component is the least doc_id that links lead to. A text without words and a
    null text have no shingles and no links. Rows of one doc_id are one document
    with several texts: links of any of them are its links. A row without an id
    has no component and no links. An empty table gives an empty table.

    Copies meet by a hash and take part once. A coarse component of more than
    ``BLOCK_SETS`` sets is dealt out in pairs of blocks, so no task holds more
    than two blocks.
    """
    prefixes = settle(document_prefixes(docs, k, percent), "prefixes")
    known = prefixes.filter("doc_id IS NOT NULL AND n_shingles > 0").select("doc_id", "text_id", "text_key")
    coarse = settle(coarse_components(prefixes, percent), "coarse-components")
    copies = known.groupBy("text_id", "text_key").agg(F.min("doc_id").alias("first"))
    copy_links = known.join(copies, ["text_id", "text_key"]).filter("doc_id <> first").select(
        F.col("doc_id").alias("a"), F.col("first").alias("b"))
    # Of equal texts one takes part.
    chosen = settle(coarse.join(copies, "text_id").select("text_id", "component", F.col("first").alias("doc_id")), "chosen")
    blocks = chosen.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_SETS)).cast("int").alias("n_blocks"))
    chosen = chosen.join(blocks, "component").withColumn(
        "block", F.pmod(F.xxhash64("text_id", F.lit(7)), "n_blocks").cast("int"))
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_id"), "text").join(
        chosen.hint("merge"), ["doc_id", "text_id"])
    fields = [T.StructField(n, T.LongType()) for n in ("component", "doc_id")]
    fields += [T.StructField(n, T.IntegerType()) for n in ("block", "n_blocks")]

    def run(batches):
        def out(batch, sets):
            packed = pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())
            return pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in fields), packed],
                                              names=[*(f.name for f in fields), "shingles"])
        return _sets(batches, out, k)

    schema = T.StructType([*fields, T.StructField("shingles", T.BinaryType())])
    sets = texts.select(*(f.name for f in fields), "text").mapInArrow(run, schema)
    # A set meets its own block and all others: pair (i, j) with i <= j.
    dealt = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))).select(
        "component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "doc_id", "shingles")
    links = dealt.groupBy("component", "i", "j").applyInArrow(
        lambda group: _group_links(group, percent), "a long, b long")
    grouped = components(links.union(copy_links), "links")
    return prefixes.join(grouped, prefixes.doc_id == grouped.node, "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def op5_prefix_tree_join(spark, sf_dir):
    """Components of all documents."""
    return similar_groups(table(spark, sf_dir, "documents"))


SQL = {"op5_prefix_tree_join": r"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0),
sets AS MATERIALIZED (SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 3], ' ')) AS s FROM places),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * o >= 85 * (x.n + y.n - o)),
both_ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a AS node, b AS other FROM both_ways UNION SELECT r.node, e.b FROM reach r JOIN both_ways e ON e.a = r.other)
SELECT w.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(min(r.other), w.doc_id)) AS component_id
FROM words w LEFT JOIN sizes s ON s.doc_id = w.doc_id LEFT JOIN reach r ON r.node = w.doc_id GROUP BY w.doc_id, s.n"""}
