"""Tokens that several documents share, found by packed postings; and connected components of links."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from mendlake.llm.common import settle

#: Tokens that one bucket should hold; a bucket is the most that one task keeps. Few tokens are dealt out as well.
BUCKET_TOKENS, MIN_BUCKETS = 1_500_000, 32
#: Tokens that are packed at a time.
SLICE_TOKENS = 400_000


def bucket_count(n_tokens):
    return int(max(MIN_BUCKETS, -(-n_tokens // BUCKET_TOKENS)))


def coded(tokens, n_buckets):
    """Tokens as bucket and 32 bits of their own. Unlike tokens may share a code; that adds candidates and loses none."""
    bucket = ((tokens * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % n_buckets
    return (bucket << 32) | (tokens & np.uint64(0xFFFFFFFF)).astype(np.int64)


def pack(batches, n_buckets):
    """Deals tokens out to buckets, many to a row.

    ``batches`` yields (owners, lengths, tokens): the ids of documents (int64),
    how many tokens each has, and all tokens (uint64). A bucket depends on the
    token alone.
    """
    for owners, lengths, tokens in batches:
        at = np.repeat(np.arange(len(owners)), lengths)
        codes, start = coded(tokens, n_buckets), 0
        while start < len(codes):
            end = min(start + SLICE_TOKENS, int(np.searchsorted(at, at[start] + 65536)))
            order = np.argsort(codes[start:end] >> 32, kind="stable")
            code, who = codes[start:end][order], at[start:end][order]
            start, cuts = end, np.flatnonzero(np.diff(code >> 32, prepend=-1))
            rows = []
            for a, b in zip(cuts, [*cuts[1:], len(code)]):
                used, local = np.unique(who[a:b], return_inverse=True)
                rows.append((int(code[a] >> 32), (code[a:b] & 0xFFFFFFFF).astype("<u4").tobytes(),
                             local.astype("<u2").tobytes(), owners[used].astype("<i8").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2, 3))],
                names=["bucket", "tokens", "local", "owners"])


PACKED = "bucket int, tokens binary, local binary, owners binary"


def unpack(group):
    """(tokens, owners) of a bucket, each pair once, sorted by token."""
    columns = [group.column(c).to_pylist() for c in ("tokens", "local", "owners")]
    tokens = np.concatenate([np.frombuffer(t, "<u4") for t in columns[0]])
    owners = np.concatenate([np.frombuffer(o, "<i8")[np.frombuffer(i, "<u2")] for _, i, o in zip(*columns)])
    order = np.lexsort((owners, tokens))
    tokens, owners = tokens[order], owners[order]
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (owners[1:] != owners[:-1])
    bucket = group.column("bucket")[0].as_py()
    return (np.int64(bucket) << 32) | tokens[new].astype(np.int64), owners[new]


def shared_by_owner(group):
    """Of one bucket, the tokens that two owners or more have, listed per owner with the number of owners."""
    tokens, owners = unpack(group)
    first = np.flatnonzero(np.diff(tokens, prepend=-1))
    counts = np.diff([*first, len(tokens)])
    n = np.repeat(counts, counts)
    tokens, owners, n = tokens[n > 1], owners[n > 1], n[n > 1]
    order = np.argsort(owners, kind="stable")
    tokens, owners, n = tokens[order], owners[order], n[order]
    cuts = np.flatnonzero(np.diff(owners, prepend=owners[:1] - 1)) if len(owners) else np.empty(0, int)
    offsets = pa.array([*cuts, len(owners)], pa.int32())
    return pa.table({
        "owner": pa.array(owners[cuts] if len(owners) else np.empty(0, np.int64)),
        "tokens": pa.ListArray.from_arrays(offsets, pa.array(tokens)),
        "counts": pa.ListArray.from_arrays(offsets, pa.array(n.astype(np.int64))),
    })


SHARED = "owner long, tokens array<long>, counts array<long>"


def shared_tokens(packed):
    """(owner, tokens, counts): a row per owner and bucket, with what it shares."""
    return packed.groupBy("bucket").applyInArrow(shared_by_owner, SHARED)


def _are_stars(edges):
    """Whether every node has one smaller neighbour, and none of these has a smaller one itself."""
    if edges.groupBy("u").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count():
        return False
    chained = edges.select("v").distinct().join(edges.select(F.col("u").alias("v")), "v", "left_semi")
    return not chained.limit(1).count()


def components(links, name):
    """(``node``, ``component``) of the nodes in ``links(a, b)``: the least node that links lead to.

    Alternates two steps until only stars around least nodes are left: each node's
    larger neighbours link to the least neighbour, then its smaller ones do. Hot nodes are
    pre-aggregated, and the links stay in tables.
    """
    def stars(pairs):
        least = pairs.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"))
        return pairs.join(least, "u")

    edges = settle(links.filter("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    while not _are_stars(edges):
        both = edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e"))
        large = stars(both.select("e.u", "e.v")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Each node gets the least of its smaller neighbours, and so do these.
        starred = stars(settle(large, name)).select(F.explode(F.array(F.col("u"), F.col("v"))).alias("u"), F.col("m").alias("v"))
        edges = settle(starred.filter("u <> v").distinct(), name)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select("v", "v").distinct())
