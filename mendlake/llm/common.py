"""What the operators of this subpackage share: tables in the shared folder, running totals, word patterns."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mendlake.session import shared_dir

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: ASCII white space.
BLANK = r"[\x20\x09-\x0D]"


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df, name, **options):
    """``df`` written as a table in the shared folder and read back.

    It cuts the lineage: a lost executor costs the running stage only, and
    readers of the table see one and the same result of every row.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path, **options)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(text):
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def row_key(*columns):
    """A 128-bit key of the values of a row; nulls differ from empty texts."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.unhex(F.md5(F.concat_ws("\x1f", *parts)))


def running_totals(df, order, sizes, name):
    """Adds ``_rank`` and ``_before_<size>`` for each size over the whole table in the given order.

    ``_rank`` counts from 0; ``_before_x`` is the sum of ``x`` over all earlier
    rows. ``order`` and ``sizes`` name columns of ``df``; sizes are longs. Rows
    are dealt by ranges of ``order`` and sorted there, each partition keeps its
    own running sums, and one row per partition passes through the driver for
    the offsets. Rows that tie in ``order`` come in any order, so give one that
    ends in a key. Returns the table and its totals as a dict.
    """
    schema = T.StructType(
        df.schema.fields
        + [T.StructField(n, T.LongType()) for n in ("_part", "_row", *(f"_sum_{s}" for s in sizes))]
    )

    def local(batches):
        part, rows, sums = TaskContext.get().partitionId(), 0, dict.fromkeys(sizes, 0)
        for batch in batches:
            n, columns = batch.num_rows, list(batch.columns)
            columns += [pa.array(np.full(n, part, np.int64)), pa.array(np.arange(rows, rows + n, dtype=np.int64))]
            rows += n
            for s in sizes:
                values = batch.column(s).to_numpy(zero_copy_only=False).astype(np.int64)
                after = sums[s] + np.cumsum(values)
                columns.append(pa.array(after - values))
                sums[s] = int(after[-1]) if n else sums[s]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = settle(ordered.mapInArrow(local, schema), name)
    ends = [F.max(F.col("_row") + 1).alias("n"), *(F.sum(s).alias(f"n_{s}") for s in sizes)]
    total = dict.fromkeys(("rows", *sizes), 0)
    offsets = []
    for r in sorted(placed.groupBy("_part").agg(*ends).collect(), key=lambda r: r["_part"]):
        offsets.append((r["_part"], *total.values()))
        total["rows"] += r["n"]
        for s in sizes:
            total[s] += r[f"n_{s}"]
    names = ["_part", "_rows_before", *(f"_sums_{s}" for s in sizes)]
    starts = df.sparkSession.createDataFrame(offsets, ", ".join(f"{n} long" for n in names))
    # One row per partition of the range exchange, whatever the data.
    joined = placed.join(F.broadcast(starts), "_part")
    return joined.select(
        *df.columns,
        (F.col("_row") + F.col("_rows_before")).alias("_rank"),
        *((F.col(f"_sum_{s}") + F.col(f"_sums_{s}")).alias(f"_before_{s}") for s in sizes),
    ), total


def parts_of(batch, size=1_000_000, column="text"):
    """Slices of an Arrow batch with about so many bytes of text each, a longer text by itself."""
    ends, start = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)), 0
    while start < batch.num_rows:
        done = int(ends[start - 1]) if start else 0
        end = max(start + 1, int(np.searchsorted(ends, done + size, "right")))
        yield batch.slice(start, end - start)
        start = end


def texts_in(batch, column="text"):
    """The texts as a list, empty for null."""
    return [t or "" for t in batch.column(column).to_pylist()]
