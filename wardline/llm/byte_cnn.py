"""Quality classifier: a small convolutional network over the bytes of a text, in numpy.

Learned filters run over every byte position. Their activations are max-pooled within
overlapping chunks that cover the whole document, a hidden layer turns each chunk's maxima into
features, these are max-pooled over the chunks and combined into one probability.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.llm.base import pick
from wardline.llm.segments import let_go, slices, utf8_bytes

#: Bytes of a filter, step from chunk to chunk (a chunk is two steps long), positions per tile.
WIDTH, STEP, TILE = 8, 128, 1 << 15


def _blocks(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of blocks per text, positions per block): STEP each, the last takes the rest."""
    positions = np.maximum(sizes, 1)
    counts = np.maximum(positions // STEP, 1)
    lengths = np.full(int(counts.sum()), STEP, np.int64)
    lengths[np.cumsum(counts) - 1] = positions - (counts - 1) * STEP
    return counts, lengths


def _padded(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text followed by zero bytes, so that a filter starts at each of its bytes; text starts."""
    sizes = np.diff(offsets)
    room = np.maximum(sizes, 1) + WIDTH - 1
    starts = np.cumsum(room) - room
    data = np.zeros(int(room.sum()), np.uint8)
    data[np.arange(len(flat)) + np.repeat(starts - offsets[:-1], sizes)] = flat
    return data, starts


@dataclass
class ByteNet:
    embed: np.ndarray    # 256 x D
    filters: np.ndarray  # WIDTH * D x F
    bias: np.ndarray     # F
    hidden: np.ndarray   # F + 1 x H; the last row weighs the chunk's length
    offset: np.ndarray   # H
    out: np.ndarray      # H
    base: np.ndarray     # 1

    @staticmethod
    def fresh(seed: int = 7, depth: int = 6, filters: int = 32, hidden: int = 16) -> "ByteNet":
        draw = np.random.default_rng(seed)
        return ByteNet(*[x.astype(np.float32) for x in (
            draw.normal(0, 0.5, (256, depth)), draw.normal(0, (WIDTH * depth) ** -0.5, (WIDTH * depth, filters)),
            np.zeros(filters), draw.normal(0, filters ** -0.5, (filters + 1, hidden)), np.full(hidden, 0.1),
            draw.normal(0, hidden ** -0.5, hidden), np.zeros(1))])

    def weights(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.hidden, self.offset, self.out, self.base]

    def _windows(self, data: np.ndarray) -> np.ndarray:
        rows = self.embed[data]
        n, depth = len(rows) - WIDTH + 1, rows.shape[1]
        flat = np.lib.stride_tricks.as_strided(rows, (n, WIDTH * depth), (rows.strides[0], rows.strides[1]))
        return np.ascontiguousarray(flat)

    def _pooled(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Largest activation of each filter in each block."""
        ends, out, at = starts + lengths, np.empty((len(starts), self.filters.shape[1]), np.float32), 0
        while at < len(starts):
            to = max(at + 1, int(np.searchsorted(ends, starts[at] + TILE, side="right")))
            low, high = starts[at], ends[to - 1]
            act = self._windows(data[low:high + WIDTH - 1]) @ self.filters
            # between two texts lie positions that belong to none
            gaps = np.flatnonzero(starts[at + 1:to] > ends[at:to - 1])
            for g in gaps:
                act[ends[at + g] - low:starts[at + g + 1] - low] = -np.inf
            out[at:to] = np.maximum.reduceat(act, starts[at:to] - low)
            at = to
        return out

    def _chunks(self, pooled: np.ndarray, lengths: np.ndarray, counts: np.ndarray):
        """Inputs of the hidden layer for each chunk, and the first chunk of each text."""
        chunks = np.maximum(counts - 1, 1)
        first = np.cumsum(chunks) - chunks
        block = np.arange(int(chunks.sum())) + np.repeat(np.cumsum(counts) - counts - first, chunks)
        second = block + np.repeat(counts > 1, chunks)
        seen = np.maximum(np.maximum(pooled[block], pooled[second]) + self.bias, 0)
        size = np.minimum(lengths[block] + np.where(second > block, lengths[second], 0), 2 * STEP) / (2 * STEP)
        return np.concatenate([seen, size[:, None].astype(np.float32)], axis=1), first, block, second

    def score(self, flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each text."""
        if len(offsets) == 1:
            return np.zeros(0)
        data, text_starts = _padded(flat, offsets)
        counts, lengths = _blocks(np.diff(offsets))
        place = np.arange(len(lengths)) - np.repeat(np.cumsum(counts) - counts, counts)
        starts = np.repeat(text_starts, counts) + place * STEP
        inputs, first, _, _ = self._chunks(self._pooled(data, starts, lengths), lengths, counts)
        active = np.maximum(inputs @ self.hidden + self.offset, 0)
        logits = np.maximum.reduceat(active, first) @ self.out + self.base
        return 1 / (1 + np.exp(-np.clip(logits.astype(np.float64), -30, 30)))

    def gradient(self, text: np.ndarray, label: int) -> list[np.ndarray]:
        """Of the log loss for one text; only the positions that won a maximum take part."""
        data, _ = _padded(text, np.array([0, len(text)]))
        counts, lengths = _blocks(np.array([len(text)]))
        starts = np.arange(len(lengths)) * STEP
        act = self._windows(data) @ self.filters
        won = np.stack([s + act[s:s + n].argmax(axis=0) for s, n in zip(starts.tolist(), lengths.tolist())])
        pooled = act[won, np.arange(act.shape[1])]
        inputs, _, block, second = self._chunks(pooled, lengths, counts)
        before = inputs @ self.hidden + self.offset
        chunk = before.argmax(axis=0)
        units = np.arange(len(chunk))
        best = np.maximum(before[chunk, units], 0)
        error = 1 / (1 + np.exp(-np.clip(float(best @ self.out + self.base[0]), -30, 30))) - label
        to_unit = np.where(best > 0, error * self.out, 0).astype(np.float32)
        seen = inputs[chunk]                                                 # H x F + 1
        to_filter = to_unit[:, None] * self.hidden[:-1].T * (seen[:, :-1] > 0)  # H x F
        a, b = block[chunk], second[chunk]
        places = np.where(pooled[a] >= pooled[b], won[a], won[b])              # H x F
        window = data[places[..., None] + np.arange(WIDTH)]                    # H x F x WIDTH
        rows = self.embed[window].reshape(*places.shape, -1)
        filters = np.einsum("hf,hfk->kf", to_filter, rows)
        embed = np.zeros_like(self.embed)
        back = (to_filter[..., None] * self.filters.T[None]).reshape(-1, self.embed.shape[1])
        np.add.at(embed, window.reshape(-1), back)
        return [embed, filters, to_filter.sum(axis=0), seen.T * to_unit, to_unit, error * best, np.array([error])]


def train(texts: list[bytes], labels: list[int], epochs: int = 6, rate: float = 0.01, batch: int = 16,
          seed: int = 7) -> "ByteNet | None":
    """Adam over small batches, the classes weighed alike by the square root of their counts."""
    if not texts:
        return None
    net, draw = ByteNet.fresh(seed), np.random.default_rng(seed)
    data = [np.frombuffer(t, np.uint8) for t in texts]
    share = np.bincount(labels, minlength=2) / len(labels)
    weigh = np.sqrt(0.5 / np.maximum(share, 0.01))
    mean, square, step = [np.zeros_like(w) for w in net.weights()], [np.zeros_like(w) for w in net.weights()], 0
    total = epochs * -(-len(data) // batch)
    for _ in range(epochs):
        order = draw.permutation(len(data))
        for k in range(0, len(order), batch):
            sums = None
            for i in order[k:k + batch]:
                own = net.gradient(data[i], labels[i])
                scaled = [g * (weigh[labels[i]] / batch) for g in own]
                sums = scaled if sums is None else [s + g for s, g in zip(sums, scaled)]
            step += 1
            now = rate * (1 - 0.9 * step / total)
            for w, g, m, v in zip(net.weights(), sums, mean, square):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= now * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return net


def fit(docs: DataFrame, labels: DataFrame, use: Column | None = None, most_rows: int = 3000,
        most_bytes: int = 200_000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        epochs: int = 6) -> "ByteNet | None":
    """Learn from at most ``most_rows`` labelled texts of at most ``most_bytes`` bytes each.

    ``use``, over the labels' id, says which labels may be learned from. The sample is the rows
    of the smallest id hashes. Null ids, labels and texts are left out. Without any row there is
    no network and every score is 0.5.
    """
    known = pick(labels, id_col, label_col).dropna()
    known = known.where(use) if use is not None else known
    few = known.dropDuplicates([id_col]).orderBy(F.xxhash64(id_col), id_col).limit(most_rows)
    rows = (pick(docs, id_col, text_col).where(F.octet_length(text_col) <= most_bytes)
            .join(F.broadcast(few), id_col).select(id_col, text_col, label_col).collect())
    rows = sorted(rows, key=lambda r: (r[0], r[1]))
    return train([r[1].encode() for r in rows], [int(r[2]) for r in rows], epochs)


def _scores(net: ByteNet | None, batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Scores of batches of texts; the worker, which idles beside later steps, holds no memory before and after."""
    let_go()
    try:
        for texts in batches:
            if net is None:
                yield pa.array(np.full(len(texts), 0.5))
            else:
                parts = [net.score(*utf8_bytes(texts.slice(a, b - a))) for a, b in slices(texts, 1 << 20)]
                yield pa.array(np.concatenate(parts) if parts else np.zeros(0))
    finally:
        texts = parts = None
        let_go()


def add_score(docs: DataFrame, net: ByteNet | None, id_col: str = "doc_id", text_col: str = "text",
              score_col: str = "score") -> DataFrame:
    """All columns and ``score``, the probability of label 1; a column of that name is replaced.

    Null and empty texts are scored as one chunk in which no filter fires on a letter. Rows stay
    where they are; repeated rows get equal scores; an empty table stays empty.
    """
    flat = docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])
    at = docs.columns.index(text_col)

    @F.arrow_udf(T.DoubleType())
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from _scores(net, batches)

    kept, seen = [], {score_col.lower()}
    for i, c in enumerate(docs.columns):
        if c.lower() not in seen:
            seen.add(c.lower())
            kept.append(F.col(f"_c{i}").alias(c))
    return flat.select(*kept, score(F.col(f"_c{at}")).alias(score_col))
