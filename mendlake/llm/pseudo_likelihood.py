"""Masked pseudo-likelihood scores from a bidirectional window network.

The vocabulary holds the corpus's commonest words, from counts over all texts.
A small network predicts a word from the two words on either side. It is trained
on every text: in each round, all partitions train on masked positions of their
own rows from the same weights, which are then averaged. A text's score is the
sum of the log-probabilities of all its words, each given both its sides. Words
outside the vocabulary are predicted by length; each then has its own share of
its length, from the counts of all words.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mendlake.llm.common import parts_of, settle, table

#: Words of the vocabulary; 0 is the edge of a text, 1 to 16 are other words by length.
UNKNOWN, CLASSES, CLASS_SIZE = 16, 64, 64
VOCABULARY = CLASSES * CLASS_SIZE
CONTEXT = (-2, -1, 1, 2)
HIDDEN = 16
ROUNDS = 2
#: Positions are dealt to so many disjoint masks; each round takes its part of the masks, all rounds together all.
MASKED = 8
MINI_BATCH = 4096
RATE = 0.1
#: Models that are averaged in one task.
FAN_IN = 32
#: Positions that are scored at a time; what a step computes then stays in a core's cache.
CHUNK = 4096
#: Places of words outside the vocabulary that a task gathers before it passes them on.
GATHERED = 500_000
#: Bytes of text whose words are counted at a time, and distinct words that a task counts before it passes them on.
COUNTED, DISTINCT = 8_000_000, 500_000


def words_of(texts):
    """(words of all texts, one after another, number of words per text) of Arrow strings; a null has none."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, bounds = split.flatten().cast(pa.binary()), split.offsets.to_numpy()
    # White space at an end of a text leaves an empty word there.
    real = pc.greater(pc.binary_length(words), 0)
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    return words.filter(real), np.diff(before[bounds - bounds[0]])


class Coder:
    """Words as ids of the vocabulary."""

    def __init__(self, words):
        self.words = pa.array(words, pa.binary())

    def encode(self, texts, outside=None):
        """(ids with two edges around every text, positions of words, number of words per text).

        ``outside`` is a list that gets the words outside the vocabulary and the number of each one's text.
        """
        words, lengths = words_of(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        found = pc.index_in(words, self.words)
        other = found.is_null().to_numpy(zero_copy_only=False)
        by_length = np.minimum(pc.binary_length(words).to_numpy(), UNKNOWN)
        starts = 2 + np.cumsum(lengths + 2) - (lengths + 2)
        at = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        ids = np.zeros(2 + len(words) + 2 * len(lengths), np.int32)
        ids[at] = np.where(other, by_length, found.fill_null(0).to_numpy() + (UNKNOWN + 1))
        if outside is not None:
            outside += [words.filter(pa.array(other)), np.repeat(np.arange(len(lengths)), lengths)[other]]
        return ids, at, lengths


def new_network(counts):
    """Weights whose predictions, before training, are the words' frequencies. ``counts`` by id."""
    rng = np.random.default_rng(7)
    share = np.log((counts + 1.0).reshape(CLASSES, CLASS_SIZE))
    by_class = np.logaddexp.reduce(share, axis=1)
    return {
        "sides": rng.normal(0, 0.1, (len(CONTEXT), VOCABULARY, HIDDEN)).astype(np.float32),
        "hidden_bias": np.zeros(HIDDEN, np.float32),
        "classes": rng.normal(0, 0.1, (CLASSES, HIDDEN)).astype(np.float32),
        "class_bias": by_class.astype(np.float32),
        "words": rng.normal(0, 0.1, (CLASSES, CLASS_SIZE, HIDDEN)).astype(np.float32),
        "word_bias": (share - by_class[:, None]).astype(np.float32),
    }


def _hidden(net, ids, at):
    total = net["hidden_bias"]
    for side, step in zip(net["sides"], CONTEXT):
        near = side.take(ids[at + step], axis=0)
        total = np.add(total, near, out=near)
    return np.tanh(total, out=total)


def _logits(hidden, weights, bias, out=None):
    out = np.matmul(hidden, weights.T, out=out)
    out += bias
    return out


_ONES = np.ones(CLASS_SIZE, np.float32)
#: Logits of at most this size need no shift before their exponentials are summed as float32.
SAFE = 60.0


def _largest(weights, bias):
    """What the size of a logit cannot exceed: hidden values are at most 1 in size."""
    return np.abs(weights).sum(axis=-1).max() + np.abs(bias).max()


def _shifted(x, largest):
    if not largest <= SAFE:
        x -= x.max(axis=1, keepdims=True)
    return x


def _log_shares(x, column, largest):
    """The logarithm of each row's share at ``column`` in the softmax of ``x``, which is overwritten."""
    x = _shifted(x, largest)
    own = x[np.arange(len(x)), column].astype(float)
    return own - np.log(np.exp(x, out=x) @ _ONES)


def _errors(x, column, largest):
    """Softmax of ``x``, in place, less 1 at each row's ``column``."""
    x = _shifted(x, largest)
    np.exp(x, out=x)
    x *= (1 / (x @ _ONES))[:, None]
    x[np.arange(len(x)), column] -= 1
    return x


def _by_class(ids, at):
    """Positions in the order of their words' classes, with that order and [first, last) for each class."""
    group = (ids[at] // CLASS_SIZE).astype(np.uint8)
    order = np.argsort(group, kind="stable")
    return at[order], order, np.searchsorted(group[order], np.arange(CLASSES + 1)).tolist()


def log_probabilities(net, ids, at):
    """Log-probability of the word at each position: of its class, and of itself within the class."""
    out = np.empty(len(at))
    at, order, cuts = _by_class(ids, at)
    outer, inner = _largest(net["classes"], net["class_bias"]), _largest(net["words"], net["word_bias"])
    for g, (first, last) in enumerate(zip(cuts, cuts[1:])):
        for start in range(first, last, CHUNK):
            end = min(start + CHUNK, last)
            h = _hidden(net, ids, at[start:end])
            score = _log_shares(_logits(h, net["classes"], net["class_bias"]), g, outer)
            own = ids[at[start:end]] % CLASS_SIZE
            score += _log_shares(_logits(h, net["words"][g], net["word_bias"][g]), own, inner)
            out[order[start:end]] = score
    return out


class Trainer:
    """Adagrad on mini-batches of masked positions."""

    def __init__(self, net, mini_batch=MINI_BATCH):
        self.net = {k: v.copy() for k, v in net.items()}
        self.squares = {k: np.full_like(v, 1e-3) for k, v in net.items()}
        self.mini_batch, self.seen = mini_batch, 0
        # Every batch's logits go to the same place: fresh memory for each would cost the system's time.
        self.outer, self.inner = np.empty((mini_batch, CLASSES), np.float32), np.empty((mini_batch, CLASS_SIZE), np.float32)

    def _step(self, name, gradient, rows=None):
        squares, values = (x[name].reshape(-1, *gradient.shape[1:]) for x in (self.squares, self.net))
        if rows is None:
            squares += gradient * gradient
            values -= RATE * gradient / np.sqrt(squares)
            return
        total = squares.take(rows, axis=0)
        total += gradient * gradient
        squares[rows] = total
        gradient *= RATE
        gradient /= np.sqrt(total, out=total)
        values[rows] = np.subtract(values.take(rows, axis=0), gradient, out=gradient)

    def train(self, ids, at):
        for start in range(0, len(at), self.mini_batch):
            self._batch(ids, at[start:start + self.mini_batch])
        self.seen += len(at)

    def _batch(self, ids, at):
        net = self.net
        at, _, cuts = _by_class(ids, at)
        group, word = np.divmod(ids[at], CLASS_SIZE)
        spans = [(g, a, b) for g, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
        h = _hidden(net, ids, at)
        outer, inner = self.outer[:len(at)], self.inner[:len(at)]
        _logits(h, net["classes"], net["class_bias"], outer)
        outer = _errors(outer, group, _largest(net["classes"], net["class_bias"]))
        for g, a, b in spans:
            _logits(h[a:b], net["words"][g], net["word_bias"][g], inner[a:b])
        inner = _errors(inner, word, _largest(net["words"], net["word_bias"]))
        back, words, bias = outer @ net["classes"], np.zeros_like(net["words"]), np.zeros_like(net["word_bias"])
        ones = np.ones(len(at), np.float32)
        for g, a, b in spans:
            back[a:b] += inner[a:b] @ net["words"][g]
            np.matmul(inner[a:b].T, h[a:b], out=words[g])
            np.matmul(ones[a:b], inner[a:b], out=bias[g])
        back *= 1 - h * h
        self._step("words", words)
        self._step("word_bias", bias)
        self._step("classes", outer.T @ h)
        self._step("class_bias", ones @ outer)
        self._step("hidden_bias", ones @ back)
        # The rows of all sides in one table; each that occurs gets a slot, in which its gradients are summed.
        near = np.concatenate([ids[at + step] + side * VOCABULARY for side, step in enumerate(CONTEXT)])
        occurs = np.zeros(len(CONTEXT) * VOCABULARY, bool)
        occurs[near] = True
        used, slot = np.flatnonzero(occurs), np.cumsum(occurs) - 1
        slot, sums = slot[near], np.empty((len(used), HIDDEN), np.float32)
        for k, column in enumerate(back.T.astype(float)):
            sums[:, k] = np.bincount(slot, np.tile(column, len(CONTEXT)), len(used))
        self._step("sides", sums, used)


def _flat(net):
    return np.concatenate([net[k].ravel() for k in sorted(net)])


def _shaped(flat, like):
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at:at + like[k].size].reshape(like[k].shape)
        at += like[k].size
    return out


def masks_of(ids, at, lengths, masked):
    """Positions in ``masked`` groups. A position's group depends on its text alone, so every round deals alike."""
    place = np.arange(len(at)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    group = (place * 2654435761 + ids[at] * np.int64(40503) + np.repeat(lengths, lengths) * 2246822519) % 2**32 * masked >> 32
    return [at[group == g] for g in range(masked)]


def word_counts(docs):
    """(``word``, ``n``) over all texts; a task adds up what it reads before it passes it on."""
    def run(batches):
        counts, more = [], 0
        for batch in batches:
            for part in parts_of(batch, COUNTED):
                found = pc.value_counts(words_of(part.column("text"))[0])
                counts.append(pa.table({"word": found.field("values"), "n": found.field("counts")}))
                more += len(found)
                if more > DISTINCT:
                    counts, more = [added(counts)], 0
                    if counts[0].num_rows > DISTINCT:
                        yield from counts.pop().to_batches()
        if counts:
            yield from added(counts).to_batches()

    def added(counts):
        sums = pa.concat_tables(counts).group_by("word", use_threads=False).aggregate([("n", "sum")])
        return sums.rename_columns({"word": "word", "n_sum": "n"})

    return docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _averaged(group):
    n = sum(group.column("n").to_pylist())
    weights = sum(np.frombuffer(w, "<f4").astype(float) * k for w, k in
                  zip(group.column("weights").to_pylist(), group.column("n").to_pylist())) / max(1, n)
    part = min(group.column("part").to_pylist()) // FAN_IN
    return pa.table({"part": pa.array([part], pa.int64()), "n": pa.array([n], pa.int64()),
                     "weights": pa.array([weights.astype("<f4").tobytes()], pa.binary())})


_MODEL = "part long, n long, weights binary"


def train(docs, rounds=ROUNDS, masked=MASKED, mini_batch=MINI_BATCH):
    """(words of the vocabulary, network, table of the other words' counts) from all rows of ``docs(text)``.

    All positions of every text are predicted, in ``masked`` disjoint masks of
    which each round takes every ``rounds``-th. The driver gets the vocabulary and, per round, one averaged model: models are
    averaged ``FAN_IN`` at a time, in three steps, so that 32**3 partitions
    leave one and more leave one for each so many. A corpus without words gives
    the untrained network.
    """
    spark = docs.sparkSession
    counts = settle(word_counts(docs), "word-counts")
    top = counts.orderBy(F.desc("n"), "word").limit(VOCABULARY - UNKNOWN - 1).collect()
    words = [bytes(r["word"]) for r in top]
    by_id = np.zeros(VOCABULARY)
    by_id[UNKNOWN + 1:UNKNOWN + 1 + len(top)] = [r["n"] for r in top]
    cut = top[-1] if len(top) == VOCABULARY - UNKNOWN - 1 else None
    rest = counts.filter("false")
    if cut:
        rest = counts.filter((F.col("n") < cut["n"]) | (F.col("n") == cut["n"]) & (F.col("word") > F.lit(bytes(cut["word"]))))
        for r in rest.groupBy(F.least(F.length("word"), F.lit(UNKNOWN)).alias("k")).agg(F.sum("n").alias("n")).collect():
            by_id[r["k"]] = r["n"]
    net = new_network(by_id)
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast((words, net))  # of fixed size

        def run(batches, turn=turn, shared=shared):
            words, start = shared.value
            coder, trainer = Coder(words), Trainer(start, mini_batch)
            for batch in batches:
                for part in parts_of(batch):
                    ids, at, lengths = coder.encode(part.column("text"))
                    for mask in masks_of(ids, at, lengths, masked)[turn % masked::rounds]:
                        trainer.train(ids, mask)
            if trainer.seen:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([trainer.seen], pa.int64()),
                     pa.array([_flat(trainer.net).astype("<f4").tobytes()], pa.binary())], names=["part", "n", "weights"])

        models = docs.select("text").mapInArrow(run, _MODEL)
        for _ in range(3):
            models = models.groupBy(F.floor(F.col("part") / FAN_IN).alias("to")).applyInArrow(_averaged, _MODEL)
        final = models.select("n", "weights").collect()
        n = sum(r["n"] for r in final)
        if n:
            flat = sum(np.frombuffer(bytes(r["weights"]), "<f4").astype(float) * r["n"] for r in final) / n
            net = _shaped(flat.astype(np.float32), net)
    return words, net, rest


def _length_class():
    return F.least(F.length("word"), F.lit(UNKNOWN))


def _own_shares(found, rest):
    """(``row``, ``own``): the summed log shares of a row's outside words in all words of their lengths.

    A word that the counts don't have stands for all such words of its length, as if seen once more.
    """
    totals = dict.fromkeys(range(UNKNOWN + 1), 0)
    totals |= {r["k"]: r["n"] for r in rest.groupBy(_length_class().alias("k")).agg(F.sum("n").alias("n")).collect()}
    total = F.element_at(F.array(*(F.lit(float(totals[k])) for k in range(UNKNOWN + 1))), _length_class() + 1)
    share = F.when(F.col("n").isNull(), -F.log(total + 1)).otherwise(F.log(F.col("n") / total))
    joined = found.join(rest, "word", "left").select(share.alias("own"), "row", F.explode("places").alias("place"))
    return joined.groupBy((F.col("row") + F.col("place")).alias("row")).agg(F.sum("own").alias("own"))


def score(docs, words, net, rest, keys=("doc_id",)):
    """The keys with ``n_tokens``, ``log_prob`` (natural, summed over the words) and ``mean_log_prob``.

    A null text and a text without words have no tokens, a sum of 0 and no mean.
    """
    shared = docs.sparkSession.sparkContext.broadcast((words, net))
    named = [T.StructField(f"_{i}", docs.schema[k].dataType) for i, k in enumerate(keys)]
    # A row of a text has its keys and sums; a row of a word has its places, counted from ``row``.
    schema = T.StructType([*named, T.StructField("row", T.LongType()), T.StructField("n_tokens", T.LongType()),
                           T.StructField("log_prob", T.DoubleType()), T.StructField("word", T.BinaryType()),
                           T.StructField("places", T.ArrayType(T.IntegerType()))])

    def run(batches):
        words, net = shared.value
        coder, names = Coder(words), schema.names
        row = first = TaskContext.get().partitionId() << 33
        found, places, n_found = [], [], 0

        def gathered():
            coded = pa.concat_arrays(found).dictionary_encode()
            which, n = coded.indices.to_numpy(), len(coded.dictionary)
            ends = np.concatenate([[0], np.cumsum(np.bincount(which, minlength=n))]).astype(np.int32)
            grouped = np.concatenate(places)[np.argsort(which, kind="stable")].astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [*(pa.nulls(n, t) for t in types), pa.array(np.full(n, first)), pa.nulls(n, pa.int64()),
                 pa.nulls(n, pa.float64()), coded.dictionary, pa.ListArray.from_arrays(ends, grouped)], names=names)

        for batch in batches:
            types = [batch.column(k).type for k in keys]
            for part in parts_of(batch):
                outside, n = [], part.num_rows
                ids, at, lengths = coder.encode(part.column("text"), outside)
                total = np.concatenate([[0.0], np.cumsum(log_probabilities(net, ids, at))])
                ends = np.cumsum(lengths)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in keys), pa.array(np.arange(row, row + n)), pa.array(lengths),
                     pa.array(total[ends] - total[ends - lengths]), pa.nulls(n, pa.binary()),
                     pa.nulls(n, pa.list_(pa.int32()))], names=names)
                found.append(outside[0])
                places.append(outside[1] + (row - first))
                n_found += len(outside[0])
                row += n
                if n_found > GATHERED:
                    yield gathered()
                    first, n_found = row, 0
                    found.clear()
                    places.clear()
        if n_found:
            yield gathered()

    both = settle(docs.select(*keys, "text").mapInArrow(run, schema), "scores")
    own = _own_shares(both.filter("word IS NOT NULL").select("word", "row", "places"), rest)
    scored = both.filter("word IS NULL").join(own, "row", "left").select(
        *(F.col(f.name).alias(k) for f, k in zip(named, keys)), "n_tokens",
        (F.col("log_prob") + F.coalesce("own", F.lit(0.0))).alias("log_prob"))
    return scored.withColumn("mean_log_prob", F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens")))


def op6_pseudo_likelihood(spark, sf_dir):
    """Scores of all documents by a network trained on all of them."""
    docs = table(spark, sf_dir, "documents")
    return score(docs, *train(docs))
