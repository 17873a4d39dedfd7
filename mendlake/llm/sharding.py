"""Sharding along a Hilbert curve through several metadata dimensions.

Each dimension is quantised to ``2**bits`` cells, rows are sorted by the index
of their cell on the Hilbert curve, and the order is cut into runs of equal
numbers of rows. A run covers a compact region in every dimension, so a reader
prunes files by the ranges of ``shard_ranges``.
"""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from mendlake.llm.common import running_totals, table, text_bytes

BITS = 8


def hilbert_index(cells, bits):
    """Index on the Hilbert curve of each row of ``cells`` (rows x dimensions, values below ``2**bits``)."""
    x = [c.copy() for c in np.asarray(cells, np.int64).T]
    level = 1 << (bits - 1)
    # Undo the rotations and reflections of the sub-cubes, from the largest down.
    while level > 1:
        low = level - 1
        for i in range(len(x)):
            upper = (x[i] & level) != 0
            swap = np.where(upper, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(upper, low, swap)
            if i:
                x[i] ^= swap
        level >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip, level = np.zeros_like(x[0]), 1 << (bits - 1)
    while level > 1:
        flip ^= np.where(x[-1] & level, level - 1, 0)
        level >>= 1
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for c in x:
            index = (index << 1) | (((c ^ flip) >> b) & 1)
    return index


def _prefix_number(text, skip):
    """The six bytes after ``skip`` as a number that orders like the text."""
    digits = F.rpad(F.substring(F.hex(F.encode(text, "UTF-8")), 2 * skip + 1, 12), 12, "0")
    return F.conv(digits, 16, 10).cast("double")


def _common_prefix(a, b):
    a, b = (a or "").encode(), (b or "").encode()
    return next((i for i, (p, q) in enumerate(zip(a, b)) if p != q), min(len(a), len(b)))


def quantise(df, dimensions, bits=BITS):
    """Expressions for the cell of each dimension, equally wide between the least and the greatest value.

    Lengths and other skewed numbers should come as logarithms. Texts count by
    the six bytes after the prefix that all of them share. Nulls are in cell 0.
    One row of extremes passes through the driver.
    """
    kinds = dict(df.select(*dimensions).dtypes)
    bounds = df.agg(*(
        f(F.substring(F.col(c), 1, 256) if kinds[c] == "string" else F.col(c).cast("double")).alias(f"{n}_{i}")
        for i, c in enumerate(dimensions) for n, f in (("lo", F.min), ("hi", F.max))
    )).first()
    cells = []
    for i, c in enumerate(dimensions):
        lo, hi, value = bounds[f"lo_{i}"], bounds[f"hi_{i}"], F.col(c).cast("double")
        if kinds[c] == "string":
            skip = _common_prefix(lo, hi)
            value = _prefix_number(F.col(c), skip)
            lo, hi = (int((v or "").encode()[skip:skip + 6].ljust(6, b"\0").hex(), 16) for v in (lo, hi))
        lo, hi = float(lo or 0), float(hi or 0)
        scaled = (value - F.lit(lo)) * F.lit((2**bits - 1) / (hi - lo) if hi > lo else 0.0)
        cells.append(F.coalesce(F.least(F.greatest(F.floor(scaled), F.lit(0)), F.lit(2**bits - 1)), F.lit(0)).cast("long"))
    return cells


def hilbert_shards(df, dimensions, key, n_shards, bits=BITS):
    """``df`` with ``curve``, ``shard`` and ``slot``: runs of the Hilbert order whose row counts differ by one at most.

    ``dimensions`` are numeric or text columns, ``key`` the columns that order
    rows of one cell. ``slot`` counts from 0 in each shard. Nulls sort first;
    rows that are equal in ``dimensions`` and ``key`` take neighbouring slots in
    any order; an empty table gives an empty table. The input must not have
    columns of these three names or names with a leading underscore.
    """
    if bits * len(dimensions) > 62:
        raise ValueError("the index takes at most 62 bits")

    @F.pandas_udf("long")
    def index(cells: pd.DataFrame) -> pd.Series:
        return pd.Series(hilbert_index(cells.to_numpy(), bits))

    cells = F.struct(*(c.alias(f"c{i}") for i, c in enumerate(quantise(df, dimensions, bits))))
    curved = df.withColumn("curve", index(cells))
    ranked, total = running_totals(curved, ["curve", *key], [], "hilbert")
    small, larger = divmod(total["rows"], n_shards)
    edge, rank = larger * (small + 1), F.col("_rank")
    shard = F.when(rank < edge, F.floor(rank / F.lit(small + 1))).otherwise(
        F.lit(larger) + F.floor((rank - F.lit(edge)) / F.lit(max(small, 1)))
    ).cast("int")
    start = F.when(rank < edge, F.col("shard") * (small + 1)).otherwise(
        F.lit(edge) + (F.col("shard") - F.lit(larger)) * small
    )
    return ranked.withColumn("shard", shard).withColumn("slot", (rank - start).cast("long")).drop("_rank")


def shard_ranges(sharded, dimensions):
    """Least and greatest value of each dimension per shard, for pruning files."""
    return sharded.groupBy("shard").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *(f(c).alias(f"{n}_{c}") for c in dimensions for n, f in (("min", F.min), ("max", F.max))),
    )


def write_shards(sharded, path):
    """One folder per shard; rows of a file are in curve order, so its row groups prune as well."""
    spread = sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    spread.write.partitionBy("shard").parquet(path)


def op1_hilbert_shards(spark, sf_dir):
    """All documents in 8 shards by law ``rows``, ordered by language, source, length and id.

    A null text has no bytes and the checksum of the empty text.
    """
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (text_bytes(F.col("text")) + 1).alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.col("lang").alias("lang"), F.col("source").alias("source"),
    ).withColumn("log_size", F.log2("size"))
    sharded = hilbert_shards(docs, ["lang", "source", "log_size", "doc_id"], ["doc_id", "text_crc32"], 8)
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve",
    )
