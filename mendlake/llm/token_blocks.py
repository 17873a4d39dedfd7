"""Token ids in binary blocks with Elias-Fano coded document boundaries.

A block is one byte string: a header, the ids of its documents, the ends of the
documents in the concatenated id array, and the ids themselves. The two rising
sequences are coded after Elias and Fano: of every number the low bits are
stored as they are, the high bits in unary in a bitmap, where the i-th one is
found from a sample of the places of ones. A block needs about two bits and the
logarithm of the mean length per document, and no table of 64-bit offsets.

Blocks are rows of a Parquet table, so that writing survives lost executors and
works on every file system that Spark writes to. Blocks follow each other in
ascending order of document ids.
"""

import functools
import json
import struct

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mendlake.llm import bpe
from mendlake.llm.common import parts_of, settle, table, texts_in
from mendlake.session import shared_dir

#: Ids after which a block ends; a longer document has a block of its own.
BLOCK_IDS = 1 << 20
#: Ones of the bitmap per sampled place.
SAMPLE = 64
#: Distinct units and words in a generation of a worker's tables, some 200 bytes each.
UNIT_ENTRIES, WORD_ENTRIES = 700_000, 200_000

MAGIC = b"EFT1"
_HEADER = struct.Struct("<4sBIIqQII")  # magic, id width, documents, null ids, least id, ids, sizes of both sequences
_SEQUENCE = struct.Struct("<QQB")  # numbers, last number, low bits


class EliasFano:
    """A sequence of numbers that never falls, from its coded form."""

    @staticmethod
    def pack(values):
        """The coded form of an array of unsigned 64-bit integers in ascending order."""
        n, values = len(values), values.astype(np.uint64)
        last = int(values[-1]) if n else 0
        width = max(0, (last // n).bit_length() - 1) if n else 0
        bits = np.arange(width, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> bits) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        places = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        high = np.zeros((last >> width) + n + 1, np.uint8)
        high[places] = 1
        return b"".join([
            _SEQUENCE.pack(n, last, width), low.tobytes(), np.packbits(high, bitorder="little").tobytes(),
            places[::SAMPLE].astype("<u4").tobytes()])

    def __init__(self, data):
        self.n, self.last, self.width = _SEQUENCE.unpack_from(data)
        bits, at = (self.last >> self.width) + self.n + 1, _SEQUENCE.size
        self.low = np.frombuffer(data, np.uint8, -(-self.n * self.width // 8), at)
        at += len(self.low)
        self.high = np.frombuffer(data, np.uint8, -(-bits // 8), at)
        self.samples = np.frombuffer(data, "<u4", -(-self.n // SAMPLE), at + len(self.high))

    def __len__(self):
        return self.n

    def select(self, i):
        """The i-th number, from the bitmap between two samples."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        block = i // SAMPLE
        first = int(self.samples[block])
        end = int(self.samples[block + 1]) + 1 if block + 1 < len(self.samples) else 8 * len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[first // 8:-(-end // 8)], bitorder="little")) + first // 8 * 8
        place = int(ones[np.searchsorted(ones, first) + i % SAMPLE])
        start, stop = i * self.width, (i + 1) * self.width
        low = int.from_bytes(self.low[start // 8:-(-stop // 8)].tobytes(), "little") >> start % 8
        return (place - i << self.width) | (low & (1 << self.width) - 1)

    def all(self):
        """All numbers, unsigned 64-bit."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        values = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.width)
        if self.width:
            bits = np.unpackbits(self.low, count=self.n * self.width, bitorder="little").reshape(self.n, self.width)
            for k in range(self.width):
                values |= bits[:, k].astype(np.uint64) << np.uint64(k)
        return values


def pack_block(doc_ids, parts, width):
    """A block of documents; ``doc_ids`` ascend with None first, ``parts`` are their ids, ``width`` bytes each."""
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    base = int(known[0]) if len(known) else 0
    ends = np.cumsum([len(p) // width for p in parts], dtype=np.uint64)
    docs = EliasFano.pack(known.view(np.uint64) - np.array(base).astype(np.int64).view(np.uint64))
    bounds = EliasFano.pack(ends)
    header = _HEADER.pack(
        MAGIC, width, len(parts), len(parts) - len(known), base, int(ends[-1]) if len(ends) else 0, len(docs), len(bounds))
    return b"".join([header, docs, bounds, *parts])


class Block:
    """A block that ``pack_block`` made."""

    def __init__(self, data):
        magic, self.width, self.n, self.nulls, self.base, self.n_ids, docs, bounds = _HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a block of tokens")
        at = _HEADER.size
        self.docs, self.bounds = EliasFano(data[at:at + docs]), EliasFano(data[at + docs:at + docs + bounds])
        self.ids = np.frombuffer(data, f"<u{self.width}", self.n_ids, at + docs + bounds)

    def document(self, i):
        """The ids of the i-th document, found through two selects."""
        return self.ids[self.bounds.select(i - 1) if i else 0:self.bounds.select(i)]

    def doc_ids(self):
        known = (self.docs.all() + np.array(self.base, np.int64).view(np.uint64)).view(np.int64)
        return [None] * self.nulls + known.tolist()

    def starts(self):
        return np.concatenate([np.zeros(1, np.int64), self.bounds.all().astype(np.int64)])


# --- ids of texts -----------------------------------------------------------------

class Remembered(dict):
    """Values of a function, the latest and those used lately kept; bounded by two generations of ``limit`` entries."""

    def __init__(self, make, limit):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        old = self.old
        value = old[key] if key in old else self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class UnitCoder:
    """Ids of whole texts by a tokenizer, through a table of the units between single spaces.

    A space between two other characters that are no white space begins a word of
    the tokenizer, so what follows up to the next one has the same ids
    everywhere. Distinct units are split into words and distinct words are
    encoded by the tokenizer's model once; texts with other white space beside
    their spaces go by words.
    """

    # White space beyond ASCII, and characters of which libraries differ.
    _ODD = "\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"

    def __init__(self, definition):
        self.words = bpe.WordTable(definition)
        tokenizer = self.words.tokenizer
        self.model = tokenizer.model
        self.special = {s: tokenizer.token_to_id(s) for s in self.words.special}
        size = tokenizer.get_vocab_size(with_added_tokens=True)
        self.width = 2 if size <= 1 << 16 else 4
        self.packed = [i.to_bytes(self.width, "little") for i in range(size)]
        self.letters = {b: c for c, b in bpe.byte_alphabet().items()}
        self.blank = self.letters[32]
        self.coded, self.units = Remembered(self._word, WORD_ENTRIES), Remembered(self._unit, UNIT_ENTRIES)

    def _regular(self, text):
        """Whether spaces stand alone between other characters, and all white space is ASCII."""
        if "  " in text or any(s in text for s in self.special):
            return False
        for c in "\n\t\r\x0b\x0c":  # looking for one character costs next to nothing
            if c in text and (c + " " in text or " " + c in text):
                return False
        return text.isascii() or not any(c in text for c in self._ODD)

    def _word(self, word):
        if word in self.special:
            return self.packed[self.special[word]]
        if word.isascii() and word.isprintable():  # as the vocabulary writes them, but for the space
            shown = word.replace(" ", self.blank)
        else:
            shown = word.encode().decode("latin-1").translate(self.letters)
        packed = self.packed
        return b"".join([packed[t.id] for t in self.model.tokenize(shown)])

    def _unit(self, unit):
        if unit.isalpha():  # one word, and hardly ever one that other units have
            packed = self.packed
            shown = self.blank + (unit if unit.isascii() else unit.encode().decode("latin-1").translate(self.letters))
            return b"".join([packed[t.id] for t in self.model.tokenize(shown)])
        if unit[:-1].isalpha() and unit[-1] in ",.;:!?":
            return self.units[unit[:-1]] + self.coded[unit[-1]]
        words = self.words.ascii.findall(" " + unit) if unit.isascii() else self.words.split(" " + unit)
        return b"".join([self.coded[w] for w in words])

    def encode(self, texts):
        """The ids of each text, little-endian, ``width`` bytes each."""
        out, coded, units = [], self.coded, self.units
        for text in texts:
            if self._regular(text):
                parts = text.split(" ")
                parts[0] = b"".join([coded[w] for w in self.words.split(parts[0])])
                parts[1:] = [units[u] for u in parts[1:]]
                out.append(b"".join(parts))
            else:
                out.append(b"".join([coded[w] for w in self.words.split(text)]))
        return out


@functools.cache
def unit_coder(definition):
    """One table per tokenizer and Python worker, which may serve several tasks."""
    return UnitCoder(definition)


def encode(docs, definition, keys=("doc_id",), end_id=0):
    """``docs(text, *keys)`` as the keys and ``ids``, binary, each document with ``end_id`` at its end.

    An id has two bytes if the vocabulary allows, else four (``id_width``).
    """
    shared = docs.sparkSession.sparkContext.broadcast(definition)  # one vocabulary file
    source = docs.select(*keys, "text")
    schema = T.StructType([*source.select(*keys).schema.fields, T.StructField("ids", T.BinaryType())])

    def run(batches):
        coder = unit_coder(shared.value)
        end = np.array([end_id], f"<u{coder.width}").tobytes()
        for batch in batches:
            for part in parts_of(batch):
                ids = [x + end for x in coder.encode(texts_in(part))]
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keys), pa.array(ids, pa.binary())], names=schema.names)

    return source.mapInArrow(run, schema)


def id_width(definition):
    """Bytes of an id in the blocks of this tokenizer."""
    spec = json.loads(definition)
    n = 1 + max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])
    return 2 if n <= 1 << 16 else 4


# --- blocks -------------------------------------------------------------------------

BLOCKS = "part int, block int, before long, n_docs long, n_ids long, least_id long, greatest_id long, data binary"


def write_blocks(encoded, path, width, block_ids=BLOCK_IDS):
    """Writes ``encoded(doc_id, ids)`` as blocks in ascending order of doc_id, null ids first.

    Rows are dealt by ranges of ids; of rows that share one (also a third of
    all) every range may hold some, in the order they were read. An empty table
    makes no blocks. A task holds one block, so its memory is that of
    ``block_ids`` ids or of the longest document.
    """
    def flush(part, block, before, docs, parts):
        n, known = sum(map(len, parts)) // width, [d for d in docs if d is not None]
        row = {"part": part, "block": block, "before": before, "n_docs": len(docs), "n_ids": n,
               "least_id": min(known, default=None), "greatest_id": max(known, default=None), "data": pack_block(docs, parts, width)}
        return pa.RecordBatch.from_pylist([row], pa.schema([
            ("part", pa.int32()), ("block", pa.int32()), *((c, pa.int64()) for c in ("before", "n_docs", "n_ids", "least_id", "greatest_id")),
            ("data", pa.binary())]))

    def run(batches):
        part, block, before, size, docs, parts = TaskContext.get().partitionId(), 0, 0, 0, [], []
        for batch in batches:
            for doc, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                docs.append(doc)
                parts.append(ids)
                size += len(ids) // width
                if size >= block_ids:
                    yield flush(part, block, before, docs, parts)
                    block, before, size, docs, parts = block + 1, before + size, 0, [], []
        if docs:
            yield flush(part, block, before, docs, parts)

    rows = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids", F.monotonically_increasing_id().alias("_turn"))
    ordered = rows.repartitionByRange("doc_id", "_turn").sortWithinPartitions("doc_id", "_turn")
    ordered.select("doc_id", "ids").mapInArrow(run, BLOCKS).write.option("compression", "zstd").parquet(path)


def read_blocks(spark, path):
    """The blocks with ``start``, the ids of all blocks before each. The driver sees a row per written part."""
    blocks = spark.read.schema(BLOCKS).parquet(path)
    sums, offsets = 0, []
    for r in sorted(blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect(), key=lambda r: r["part"]):
        offsets.append((r["part"], sums))
        sums += r["n"]
    parts = spark.createDataFrame(offsets, "part int, _before long")
    # One row per partition of the range exchange, whatever the data.
    return blocks.join(F.broadcast(parts), "part").withColumn("start", F.col("before") + F.col("_before"))


def read_documents(blocks):
    """``doc_id``, ``start`` (ids of all documents before it) and ``ids`` (unsigned 32-bit, little-endian) of every document."""
    def run(batches):
        for batch in batches:
            for first, data in zip(batch.column("start").to_pylist(), batch.column("data")):
                block = Block(data.as_buffer().to_pybytes())
                starts, ids = block.starts(), block.ids.astype("<u4")
                yield from _documents(block.doc_ids(), first, starts, ids)

    return blocks.select("start", "data").mapInArrow(run, "doc_id long, start long, ids binary")


def _documents(doc_ids, first, starts, ids, step=4096):
    for a in range(0, len(doc_ids), step):
        b = min(len(doc_ids), a + step)
        yield pa.RecordBatch.from_arrays([
            pa.array(doc_ids[a:b], pa.int64()), pa.array(first + starts[a:b]),
            pa.array([ids[starts[i]:starts[i + 1]].tobytes() for i in range(a, b)], pa.binary())], names=["doc_id", "start", "ids"])


def lookup(blocks, wanted):
    """The documents whose ids are in ``wanted(doc_id)``, from the blocks that may hold them.

    Blocks outside the range of the wanted ids are pruned by their bounds; in a
    block the documents are found by their order and cut out through ``select``.
    ``wanted`` meets blocks by range: keep it a short list (it is broadcast
    below Spark's size threshold only).
    """
    asked = wanted.select(F.col("doc_id").alias("_asked")).filter("_asked IS NOT NULL").distinct()
    hit = blocks.join(asked, F.col("_asked").between(F.col("least_id"), F.col("greatest_id")))
    per_block = hit.groupBy("part", "block").agg(
        F.first("start").alias("start"), F.first("data").alias("data"), F.collect_list("_asked").alias("asked"))

    def run(batches):
        for batch in batches:
            for first, data, asked in zip(*(batch.column(c).to_pylist() for c in ("start", "data", "asked"))):
                block = Block(data)
                known = np.array(block.doc_ids()[block.nulls:], np.int64)
                rows = {"doc_id": [], "start": [], "ids": []}
                for doc in asked:
                    for i in range(np.searchsorted(known, doc), np.searchsorted(known, doc, "right")):
                        i += block.nulls
                        rows["doc_id"].append(doc)
                        rows["start"].append(first + (block.bounds.select(int(i) - 1) if i else 0))
                        rows["ids"].append(block.document(int(i)).astype("<u4").tobytes())
                yield pa.RecordBatch.from_pydict(rows, pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())]))

    return per_block.select("start", "data", "asked").mapInArrow(run, "doc_id long, start long, ids binary")


def write_documents(docs, path, definition, end_id=0, block_ids=BLOCK_IDS):
    """Encodes ``docs(doc_id, text)`` and writes their blocks to ``path``.

    A null or empty text has the end id alone; rows that repeat are written as
    often; other columns are left aside whatever their names; an empty table
    makes no blocks.
    """
    encoded = settle(encode(docs, definition, end_id=end_id), "encoded", compression="zstd")
    write_blocks(encoded, path, id_width(definition), block_ids)


def op12_token_blocks(spark, sf_dir, path=None):
    """Place, length and checksum of every document's ids, read back from the written blocks."""
    target = shared_dir(spark, "token-blocks")
    write_documents(table(spark, sf_dir, "documents"), target, bpe.read_definition(path))
    return read_documents(read_blocks(spark, target)).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
