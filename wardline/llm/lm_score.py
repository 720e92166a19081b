"""Language-model scoring: a log-bilinear neural model trained by noise-contrastive estimation.

Tokens are lower-cased words and one end per text. The most frequent words are outputs of the
model; all others share one output, within which they divide its probability as the smoothed
unigram does, so the model is normalised over every word there may be. Three words before a
token, each with its own weights, predict it.

Counts cover all texts learned from. Training goes over all of them too: every task takes its
texts through stochastic gradient steps from the same start, and the parameters of all tasks are
averaged after each round, on the next share of the texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.llm.base import pick, stored
from wardline.llm.segments import let_go, range_hashes, slices, utf8_bytes, word_bounds
from wardline.operators.trees import PART, part_row, tree_sum

#: Frequent words whose counts every task holds, words told apart as contexts, outputs of the model.
FREQUENT, CONTEXTS, OUTPUTS = 1 << 18, 4096, 384

#: Words before a token, size of an embedding, tokens of a step, noise words of a step.
ORDER, DEPTH, BATCH, NOISE = 3, 16, 1024, 32

#: Added to every count; the word of an end.
ALPHA, END = 0.1, b""


@dataclass
class Counts:
    """What the texts learned from hold: tokens, distinct tokens, and the frequent ones by hash."""

    total: int
    distinct: int
    hashes: np.ndarray  # of frequent words, ascending
    count: np.ndarray
    order: np.ndarray   # rank by falling count, ties by word
    end: int            # ends

    def base(self, count: np.ndarray | int) -> np.ndarray:
        """Smoothed unigram log10 probability."""
        return np.log10((np.asarray(count, np.float64) + ALPHA) / (self.total + ALPHA * (self.distinct + 1)))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Place among the frequent words, -1 for others."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)


@dataclass
class Model:
    """Parameters; output 0 is every word without an output of its own, output 1 the end."""

    counts: Counts
    output: np.ndarray    # of each frequent word
    context: np.ndarray   # of each frequent word; 0: other words, 1: before the text
    rare: float           # log10 share of output 0 in the smoothed unigram
    log_noise: np.ndarray
    read: np.ndarray      # context embeddings
    weigh: np.ndarray     # ORDER x DEPTH
    write: np.ndarray     # output embeddings
    bias: np.ndarray

    @staticmethod
    def fresh(counts: Counts, seed: int = 3) -> "Model":
        """Predicts the unigram until it is trained."""
        draw = np.random.default_rng(seed)
        output = np.where(counts.order < OUTPUTS - 2, counts.order + 2, 0).astype(np.int16)
        context = np.where(counts.order < CONTEXTS - 2, counts.order + 2, 0).astype(np.int16)
        share = np.zeros(OUTPUTS)
        share[output[output > 0]] = 10 ** counts.base(counts.count[output > 0])
        if counts.end:
            share[1] = 10 ** counts.base(counts.end)
        share[0] = max(1 - share.sum(), 1e-12)
        used = share > 0
        log_noise = np.where(used, np.log(np.where(used, share, 1)), -1e9)  # outputs that no word has
        return Model(counts, output, context, float(np.log10(share[0])), log_noise.astype(np.float32),
                     *[x.astype(np.float32) for x in (
                         draw.normal(0, 0.3, (CONTEXTS, DEPTH)), np.tile(0.6 ** np.arange(ORDER)[:, None], (1, DEPTH)),
                         draw.normal(0, 0.05, (OUTPUTS, DEPTH)), log_noise)])

    def weights(self) -> list[np.ndarray]:
        return [self.read, self.weigh, self.write, self.bias]

    def put(self, flat: np.ndarray) -> None:
        at = 0
        for w in self.weights():
            w[...] = flat[at:at + w.size].reshape(w.shape)
            at += w.size

    def tokens(self, place: np.ndarray, of_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(output of each token, contexts of each token): the words of each text, then its end."""
        texts, words = len(of_text) - 1, len(place)
        ends = of_text[1:] + np.arange(texts)
        is_end = np.zeros(words + texts, bool)
        is_end[ends] = True
        out, seen = np.ones(words + texts, np.int16), np.ones(words + texts + ORDER, np.int16)
        known = place >= 0
        out[:] = self.counts.end > 0  # without a text learned from an end is a word like any other
        out[~is_end] = np.where(known, self.output[place] if len(self.output) else 0, 0)
        seen[ORDER:][~is_end] = np.where(known, self.context[place] if len(self.context) else 0, 0)
        # an end is never a context: before the next text there is nothing
        starts = np.repeat(of_text[:-1] + np.arange(texts), np.diff(of_text) + 1)
        index = np.arange(words + texts)
        contexts = np.stack([np.where(index - k - 1 >= starts, seen[index + ORDER - k - 1], np.int16(1)) for k in range(ORDER)])
        return out, contexts

    def predicted(self, contexts: np.ndarray) -> np.ndarray:
        total = self.read[contexts[0]] * self.weigh[0]
        for k in range(1, ORDER):
            total += self.read[contexts[k]] * self.weigh[k]
        return total

    def log10(self, out: np.ndarray, contexts: np.ndarray) -> np.ndarray:
        """Normalised log10 probability of each output after its contexts."""
        found, ones = np.empty(len(out)), np.ones(OUTPUTS, np.float32)
        # the bias rides in the product, as the weight of an input that is always 1
        right = np.ascontiguousarray(np.column_stack([self.write, self.bias]).T)
        longest = np.sqrt((self.write ** 2).sum(axis=1).max())
        for a in range(0, len(out), BATCH):
            own = out[a:a + BATCH]
            left = np.ones((len(own), DEPTH + 1), np.float32)
            left[:, :-1] = self.predicted(contexts[:, a:a + BATCH])
            scores = left @ right
            if np.sqrt((left ** 2).sum(axis=1).max()) * longest + self.bias.max() > 80:
                scores -= scores.max(axis=1, keepdims=True)  # exp would overflow
            mine = scores[np.arange(len(own)), own].astype(np.float64)
            found[a:a + BATCH] = mine - np.log(np.exp(scores, out=scores) @ ones)
        return found / np.log(10)


class Trainer:
    """Noise-contrastive steps on a copy of a model; step sizes adapt to each parameter."""

    def __init__(self, model: Model, seed: int, rate: float = 0.1):
        self.model, self.rate, self.draw = model, rate, np.random.default_rng(seed)
        self.square = [np.full_like(w, 0.1) for w in model.weights()]
        self.cumulated = np.cumsum(np.exp(model.log_noise.astype(np.float64)))
        self.seen = 0

    def _step(self, at: int, rows, gradient: np.ndarray) -> None:
        square, weights = self.square[at], self.model.weights()[at]
        new = square[rows] + gradient * gradient
        square[rows] = new
        weights[rows] -= self.rate * gradient / np.sqrt(new)

    @staticmethod
    def _by_row(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums of the values of equal rows."""
        order = np.argsort(rows, kind="stable")
        own = rows[order]
        first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        return own[first], np.add.reduceat(values[order], first, axis=0)

    def learn(self, out: np.ndarray, contexts: np.ndarray) -> None:
        order = self.draw.permutation(len(out))
        for a in range(0, len(order), BATCH):
            part = order[a:a + BATCH]
            self.batch(out[part], contexts[:, part])
        self.seen += len(out)

    def batch(self, out: np.ndarray, contexts: np.ndarray) -> None:
        """One step; the noise words, drawn from the unigram, serve all tokens of it."""
        m = self.model
        noise = np.minimum(np.searchsorted(self.cumulated, self.draw.random(NOISE) * self.cumulated[-1]), OUTPUTS - 1)
        q, ln = m.predicted(contexts), np.float32(np.log(NOISE))
        mine, theirs = m.write[out], m.write[noise]
        hit = (q * mine).sum(axis=1) + m.bias[out] - ln - m.log_noise[out]
        miss = q @ theirs.T + (m.bias - m.log_noise)[noise] - ln
        to_hit = (1 / (1 + np.exp(-np.clip(hit, -30, 30))) - 1).astype(np.float32)
        to_miss = 1 / (1 + np.exp(-np.clip(miss, -30, 30)))
        to_q = to_hit[:, None] * mine + to_miss @ theirs
        rows, both = self._by_row(np.append(out, noise), np.concatenate([
            np.column_stack([to_hit[:, None] * q, to_hit]), np.column_stack([to_miss.T @ q, to_miss.sum(axis=0)])]))
        read = [m.read[c] for c in contexts]
        to_read = np.concatenate([to_q * m.weigh[k] for k in range(ORDER)])
        to_weigh = np.stack([(to_q * r).sum(axis=0) for r in read])
        self._step(2, rows, both[:, :-1])
        self._step(3, rows, both[:, -1])
        self._step(0, *self._by_row(contexts.reshape(-1), to_read))
        self._step(1, slice(None), to_weigh)


def _words(texts: pa.Array):
    """(bytes, starts, ends, offsets of the texts among the words, hash of each word)."""
    flat, starts, ends, of_text = word_bounds(texts)
    return flat, starts, ends, of_text, range_hashes(flat, starts, ends)


def _binary(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte ranges as values of a column."""
    sizes = ends - starts
    at = np.append(0, np.cumsum(sizes))
    place = np.arange(at[-1]) + np.repeat(starts - at[:-1], sizes)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [
        None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(flat[place]))]).cast(pa.binary())


def _first_of(coded: np.ndarray, count: int) -> np.ndarray:
    first = np.zeros(count, np.int64)
    first[coded[::-1]] = np.arange(len(coded) - 1, -1, -1)
    return first


def count_tokens(texts: DataFrame) -> DataFrame:
    """``word`` and ``n`` of every token of the texts, a column; the end is the empty word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        ends = 0
        for batch in batches:
            ends += batch.num_rows
            for i, j in slices(batch.column(0), 4 << 20):
                flat, starts, stops, _, hashes = _words(batch.column(0).slice(i, j - i))
                coded, keys = pd.factorize(hashes)
                if len(keys):
                    first = _first_of(coded, len(keys))
                    yield pa.RecordBatch.from_arrays([
                        _binary(flat, starts[first], stops[first]), pa.array(np.bincount(coded).astype(np.int64))], names=["word", "n"])
        if ends:
            yield pa.RecordBatch.from_arrays([pa.array([END], pa.binary()), pa.array([ends], pa.int64())], names=["word", "n"])

    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def read_counts(table: DataFrame) -> tuple[Counts, DataFrame]:
    """The totals with the frequent words, and the table of all other words.

    Frequent are the words of the highest counts, FREQUENT at most, cut between powers of a
    small root so that no sort of all words is needed.
    """
    totals = table.agg(F.sum("n").alias("total"), F.count("*").alias("distinct")).first()
    level = F.floor(F.log2("n") * 32).cast("int")
    sizes = sorted(table.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect(), reverse=True)
    least, held_words = 1 << 20, 0
    for row in sizes:
        held_words += row["n"]
        if held_words > FREQUENT:
            break
        least = row["level"]
    often = table.where((level >= least) & (F.octet_length("word") > 0)).toArrow()
    words, count = often.column("word").combine_chunks().cast(pa.large_binary()), often.column("n").to_numpy().astype(np.int64)
    flat, offsets = utf8_bytes(words.view(pa.large_string()))
    hashes = range_hashes(flat, offsets[:-1], offsets[1:])
    texts = words.to_pylist()
    rank = np.empty(len(count), np.int64)
    rank[sorted(range(len(count)), key=lambda k: (-count[k], texts[k]))] = np.arange(len(count))
    by = np.argsort(hashes)
    ends = table.where(F.octet_length("word") == 0).agg(F.sum("n").alias("n")).first()["n"] or 0
    counts = Counts(totals["total"] or 0, totals["distinct"], hashes[by], count[by], rank[by], ends)
    return counts, table.where((level < least) & (F.octet_length("word") > 0))


def train(texts: DataFrame, model: Model, part: Column, rounds: int, rate: float = 0.1) -> Model:
    """Rounds over the shares of the texts (``part`` numbers them); parameters averaged by tokens."""
    size = sum(w.size for w in model.weights())
    for r in range(rounds):
        shared = texts.sparkSession.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch], r: int = r) -> Iterator[pa.RecordBatch]:
            let_go()
            number = TaskContext.get().partitionId()
            base = shared.value
            own = Model(base.counts, base.output, base.context, base.rare, base.log_noise, *[w.copy() for w in base.weights()])
            trainer = Trainer(own, 1000 * number + r, rate / (1 + r))
            for batch in batches:
                for i, j in slices(batch.column(0), 1 << 20):
                    _, _, _, of_text, hashes = _words(batch.column(0).slice(i, j - i))
                    trainer.learn(*own.tokens(own.counts.find(hashes), of_text))
            if trainer.seen:
                flat = np.concatenate([w.reshape(-1) for w in own.weights()]).astype(np.float64)
                yield part_row(number, np.append(flat * trainer.seen, trainer.seen))

        total = tree_sum(texts.where(part == r).select(texts.columns[0]).mapInArrow(run, PART), size + 1)
        shared.unpersist()
        if total[-1]:
            model.put(total[:-1] / total[-1])
    return model


def fit(docs: DataFrame, use: Column, id_col: str = "doc_id", text_col: str = "text", rounds: int = 3) -> tuple[Model, DataFrame]:
    """A model of the texts whose id fits ``use``, and the table of the words that it does not hold.

    Null texts are empty; a null condition counts as false. Each text is learned from once, in
    one of the rounds.
    """
    rows = pick(docs, id_col, text_col).where(use).select(F.col(text_col).alias("text"))
    table = stored(count_tokens(rows), "words")
    counts, others = read_counts(table)
    model = Model.fresh(counts)
    return (train(rows, model, F.pmod(F.xxhash64("text"), F.lit(rounds)), rounds) if counts.total else model), others


def score(docs: DataFrame, model: Model, others: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    ``base_score`` is the log10 probability of the text by the smoothed unigram, ``score`` by the
    model; both take every token of the whole text. Words outside the model's frequent ones get
    their counts by a join. Null and empty texts are one end. Every row is scored by itself, so
    ties and repeated rows score alike; null ids pass through; other columns are not read; an
    empty table gives an empty one. Without any text learned from every score is 0.
    """
    rows = pick(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rest_type = T.ArrayType(T.StructType([T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType())]))
    schema = T.StructType([rows.schema[0], T.StructField("n_tokens", T.LongType()), T.StructField("_known", T.LongType()),
                           T.StructField("_base", T.DoubleType()), T.StructField("_score", T.DoubleType()), T.StructField("_rest", rest_type)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        m = shared.value
        of_count = m.counts.base(m.counts.count)
        end = float(m.counts.base(m.counts.end))
        for batch in batches:
            for i, j in slices(batch.column(1), 1 << 20):
                flat, starts, ends, of_text, hashes = _words(batch.column(1).slice(i, j - i))
                coded, keys = pd.factorize(hashes)
                place = m.counts.find(keys)
                texts = len(of_text) - 1
                doc = np.repeat(np.arange(texts), np.diff(of_text))
                own = place[coded]
                known = own >= 0
                base = np.bincount(doc[known], of_count[own[known]], texts) + end
                out, contexts = m.tokens(own, of_text)
                token_doc = np.repeat(np.arange(texts), np.diff(of_text) + 1)
                told = np.bincount(token_doc, m.log10(out, contexts), texts) + (0 if m.counts.end else end - m.rare)
                rare = np.flatnonzero(known)[m.output[own[known]] == 0] if len(m.output) else np.zeros(0, np.int64)
                told += np.bincount(doc[rare], of_count[own[rare]] - m.rare, texts)
                unknown = np.flatnonzero(~known)
                told -= m.rare * np.bincount(doc[unknown], minlength=texts)
                # each unknown word of a text once, with its number
                pair, first, times = np.unique(doc[unknown] * np.int64(len(keys) + 1) + coded[unknown],
                                               return_index=True, return_counts=True)
                rest = unknown[first]
                at = np.searchsorted(pair // (len(keys) + 1), np.arange(texts + 1))
                words = pa.StructArray.from_arrays([_binary(flat, starts[rest], ends[rest]), pa.array(times.astype(np.int64))],
                                                   names=["word", "n"])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i), pa.array(np.diff(of_text) + 1),
                    pa.array(np.bincount(doc[known], minlength=texts) + (m.counts.end > 0)), pa.array(base), pa.array(told),
                    pa.ListArray.from_arrays(pa.array(at, pa.int32()), words)], names=schema.names)

    scored = stored(rows.mapInArrow(run, schema).withColumn("_row", F.monotonically_increasing_id()), "scored")
    counts = model.counts
    known = F.coalesce(F.col("c"), F.lit(0))
    each = scored.select("_row", F.explode("_rest").alias("_w")).select("_row", "_w.word", F.col("_w.n").alias("t"))
    joined = each.join(others.select("word", F.col("n").alias("c")), "word", "left")
    bottom = float(counts.total + ALPHA * (counts.distinct + 1))
    found = joined.groupBy("_row").agg(
        F.sum(F.col("t") * F.log10((known + ALPHA) / bottom)).alias("_more"), F.sum(F.when(known > 0, F.col("t"))).alias("_met"))
    more = F.coalesce("_more", F.lit(0.0))
    return scored.drop("_rest").join(found, "_row", "left").select(
        id_col, "n_tokens", (F.col("_known") + F.coalesce("_met", F.lit(0))).alias("n_known"),
        F.lit(counts.total).cast("long").alias("train_tokens"), (F.col("_base") + more).alias("base_score"),
        (F.col("_score") + more).alias("score"))
