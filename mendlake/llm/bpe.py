"""Byte-level BPE over a table of distinct words.

Texts are split into words as the tokenizer splits them. The distinct words of
each block of rows make a table; every one of them is encoded once, and the ids
go back to the texts by position. Decoding joins ids to a table of pieces in the
same way.
"""

import functools
import json
import re
import sys
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mendlake.llm.common import parts_of, table, texts_in

# Fixed value: the pattern that splits text for byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for texts in ASCII.
ASCII_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
#: Words of a block's table before a new one is begun; bounds a task's memory.
TABLE_WORDS = 200_000


@functools.cache
def unassigned():
    """By code point, whether Unicode had not assigned it when this Python was made; libraries may class it differently."""
    return np.array([unicodedata.category(chr(c)) == "Cn" for c in range(sys.maxunicode + 1)])


def byte_alphabet():
    """The character that stands for each byte in the vocabulary: itself if printable, else one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


def piece_table(spec):
    """The bytes of each id."""
    letters = byte_alphabet()
    pieces = {i: bytes(letters[c] for c in word) for word, i in spec["model"]["vocab"].items()}
    pieces.update({t["id"]: t["content"].encode() for t in spec["added_tokens"]})
    return pieces


class WordTable:
    """Distinct words of a block and their ids; a word is encoded when it first comes."""

    def __init__(self, definition):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = [t["content"] for t in json.loads(definition)["added_tokens"]]
        self.special = set(special)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.pattern, self.ascii = regex.compile(PATTERN), re.compile(ASCII_PATTERN)
        self.ids = {}

    def split(self, text):
        if self.cut is None or not any(s in text for s in self.special):
            return self._words(text)
        words = []
        for part in self.cut.split(text):
            words += [part] if part in self.special else self._words(part)
        return words

    def _words(self, text):
        if text.isascii():
            return self.ascii.findall(text)
        if unassigned()[np.frombuffer(text.encode("utf-32-le"), "<u4")].any():
            return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
        return self.pattern.findall(text)

    def encode(self, texts):
        """The ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.split(t) for t in texts]
        if len(self.ids) > TABLE_WORDS:
            self.ids = {}
        new = list({w for words in split for w in words}.difference(self.ids))
        for word, coded in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False)):
            self.ids[word] = np.array(coded.ids, "<u4").tobytes()
        return [b"".join(map(self.ids.__getitem__, words)) for words in split]


@functools.cache
def word_table(definition):
    """One table per tokenizer and Python worker, which may serve several tasks."""
    return WordTable(definition)


class PieceTable:
    """The bytes of each id."""

    def __init__(self, definition):
        self.pieces = piece_table(json.loads(definition))

    def decode(self, ids):
        """Texts of packed ids; bytes that are no UTF-8 become U+FFFD."""
        return [
            b"".join(map(self.pieces.__getitem__, np.frombuffer(x or b"", "<u4").tolist())).decode("utf-8", "replace")
            for x in ids
        ]


@functools.cache
def piece_reader(definition):
    return PieceTable(definition)


def _mapped(df, keys, columns, make, definition):
    """``keys`` and the columns that ``make(definition)`` derives from each part of a batch."""
    shared = df.sparkSession.sparkContext.broadcast(definition)  # one vocabulary file
    schema = T.StructType([*df.select(*keys).schema.fields, *columns])

    def run(batches):
        work, source = make(shared.value)
        for batch in batches:
            for part in parts_of(batch, column=source):
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keys), *work(part)], names=schema.names)

    return df.mapInArrow(run, schema)


_IDS, _TEXT = T.StructField("ids", T.BinaryType()), T.StructField("text", T.StringType())


def encode(docs, definition, keys=("doc_id",)):
    """``docs(text, *keys)`` as the keys and ``ids``, binary: little-endian unsigned 32-bit integers.

    ``definition`` is the JSON text of a byte-level tokenizer. The strings of its
    added tokens are those tokens. A null text is empty and has no ids; repeated
    rows give repeated results, an empty table an empty one.
    """
    def make(definition):
        words = word_table(definition)
        return lambda part: [pa.array(words.encode(texts_in(part)), pa.binary())], "text"

    return _mapped(docs.select(*keys, "text"), keys, [_IDS], make, definition)


def decode(encoded, definition, keys=("doc_id",)):
    """The keys and ``text`` of what ``encode`` returned; bytes that are no UTF-8 become U+FFFD."""
    def make(definition):
        pieces = piece_reader(definition)
        return lambda part: [pa.array(pieces.decode(part.column("ids").to_pylist()), pa.string())], "ids"

    return _mapped(encoded.select(*keys, "ids"), keys, [_TEXT], make, definition)


def round_trip(docs, definition, keys=("doc_id",)):
    """The keys, ``ids`` as ``encode`` gives them and ``text`` as ``decode`` gives it from these ids, in one pass."""
    def make(definition):
        words, pieces = word_table(definition), piece_reader(definition)

        def work(part):
            ids = words.encode(texts_in(part))
            return [pa.array(ids, pa.binary()), pa.array(pieces.decode(ids), pa.string())]
        return work, "text"

    return _mapped(docs.select(*keys, "text"), keys, [_IDS, _TEXT], make, definition)


def read_definition(path=None):
    """The JSON text of a tokenizer; by default that of the public 50k byte-level vocabulary."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


def op10_bpe_round_trip(spark, sf_dir, path=None):
    """Ids of every document and the text that they decode to, as digests."""
    definition = read_definition(path)
    return round_trip(table(spark, sf_dir, "documents"), definition).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"))
