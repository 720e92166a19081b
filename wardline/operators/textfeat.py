"""TF-IDF over character or word n-grams of whole texts, kept sparse."""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions import text as tx
from wardline.session import spread

# Vectoriser settings.
NGRAM_RANGE = (1, 4)
MAX_FEATURES = 5000
MIN_DF = 3
# Terms that a task counts before it hands them over.
MAX_TERMS = 400_000
# Words, and cells of rows x terms, that are worked on at a time; a longer row is taken alone.
MAX_WORDS, MAX_CELLS = 1 << 18, 1 << 22


def grams(text: Column, analyzer: str = "char_wb", ngram_range=NGRAM_RANGE) -> Column:
    make = {"char_wb": tx.char_wb_ngrams, "word": tx.word_ngrams}[analyzer]
    return make(text, *ngram_range)


def words_of(text: Column, analyzer: str = "char_wb") -> Column:
    """The words whose n-grams, of their characters or of themselves, are the terms."""
    return {"char_wb": tx.words_by_space, "word": tx.word_tokens}[analyzer](text)


def _ngrams(codes: np.ndarray, rows: np.ndarray, high: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(n, where each n-gram starts, its number, a start of each number) for n from 1 to high, none across rows."""
    width = int(codes.max(initial=0)) + 1
    _, first, gram = np.unique(codes, return_index=True, return_inverse=True)
    at = np.arange(len(codes))
    yield 1, at, gram, first
    for n in range(2, high + 1):
        inside = at + n - 1 < len(codes)
        inside[inside] = rows[at[inside] + n - 1] == rows[at[inside]]
        at = at[inside]
        _, first, gram = np.unique(gram[inside] * width + codes[at + n - 1], return_index=True, return_inverse=True)
        yield n, at, gram, at[first]


class _Terms:
    """Numbers of the terms of rows of words: those of a vocabulary, or new ones as terms are met."""

    def __init__(self, analyzer: str, ngram_range, vocabulary: dict[str, int] | None = None):
        self.of_characters, (self.low, self.high) = analyzer == "char_wb", ngram_range
        self.grows, self.ids = vocabulary is None, {} if vocabulary is None else vocabulary

    def _numbers(self, terms: Iterable[str]) -> np.ndarray:
        """-1 for what the vocabulary does not have."""
        ids = self.ids
        if self.grows:
            return np.fromiter((ids.setdefault(t, len(ids)) for t in terms), np.int64)
        return np.fromiter((ids.get(t, -1) for t in terms), np.int64)

    def _of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Every character n-gram of the blank-padded words, word after word, and how many a word has.

        A padded word shorter than ``low`` gives itself once.
        """
        padded = [f" {w} " for w in words]
        joined = "".join(padded)
        size = np.array([len(w) for w in padded])
        start, word = np.cumsum(size) - size, np.repeat(np.arange(len(size)), size)
        sizes = [np.maximum(size - n + 1, size < n if n == self.low else 0) for n in range(self.low, self.high + 1)]
        many = np.sum(sizes, axis=0)
        found, place = np.empty(many.sum(), np.int64), np.cumsum(many) - many
        for n, at, gram, first in _ngrams(np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int64), word, self.high):
            if n < self.low:
                continue
            of = word[at]
            found[place[of] + at - start[of]] = self._numbers(joined[i:i + n] for i in first.tolist())[gram]
            if n == self.low:
                short = np.flatnonzero(size < n)
                found[place[short]] = self._numbers(padded[i] for i in short)
            place = place + sizes[n - self.low]
        return found, many

    def hits(self, lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, term, times) of the terms; a pair may come more than once."""
        encoded = lists.flatten().dictionary_encode()
        codes, words = encoded.indices.to_numpy().astype(np.int64), encoded.dictionary.to_pylist()
        rows = np.repeat(np.arange(len(lists)), _sizes(lists))
        if not len(codes):
            return rows, codes, codes
        if self.of_characters:
            # each word of a row once; a word fixes its n-grams
            pair, times = np.unique(rows * len(words) + codes, return_counts=True)
            rows, codes = pair // len(words), pair % len(words)
            ids, size = self._of_words(words)
            many = size[codes]
            place = np.arange(many.sum()) + np.repeat((np.cumsum(size) - size)[codes] - (np.cumsum(many) - many), many)
            rows, ids, times = np.repeat(rows, many), ids[place], np.repeat(times, many)
        else:
            found = [(rows[at], self._numbers(" ".join([words[c] for c in codes[i:i + n]]) for i in first.tolist())[gram])
                     for n, at, gram, first in _ngrams(codes, rows, self.high) if n >= self.low]
            rows, ids = (np.concatenate(x) for x in zip(*found))
            times = np.ones(len(ids), np.int64)
        if self.grows:
            return rows, ids, times
        own = ids >= 0
        return rows[own], ids[own], times[own]


def _sizes(lists: pa.Array) -> np.ndarray:
    return lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _pieces(lists: pa.Array, most_rows: int | None = None) -> Iterator[pa.Array]:
    """The rows in pieces of MAX_WORDS words at most, or of one row."""
    ends, at = np.cumsum(_sizes(lists)), 0
    while at < len(lists):
        to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + MAX_WORDS, "right"))
        to = max(min(to, at + (most_rows or len(lists))), at + 1)
        yield lists.slice(at, to - at)
        at = to


def term_statistics(df: DataFrame, text_col: str, analyzer: str = "char_wb", ngram_range=NGRAM_RANGE) -> DataFrame:
    """(term, tf, df): occurrences and rows containing the term.

    One pass over the texts. A task counts its own rows, a bounded number of terms at a time, so
    neither a (row, term) table nor an occurrence leaves it, only terms with their two sums.
    """
    lists = spread(df.select(text_col)).select(words_of(F.col(text_col), analyzer).alias("words"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, counts = _Terms(analyzer, ngram_range), np.zeros((2, 0), np.int64)

        def told() -> Iterator[pa.RecordBatch]:
            names = list(terms.ids)
            for a in range(0, len(names), 50_000):
                yield pa.RecordBatch.from_arrays([
                    pa.array(names[a:a + 50_000], pa.string()), *(pa.array(c[a:a + 50_000]) for c in counts)], names=["term", "tf", "df"])

        for batch in batches:
            for piece in _pieces(batch.column(0)):
                rows, ids, times = terms.hits(piece)
                size = len(terms.ids)
                if not len(ids):
                    continue
                counts = np.pad(counts, ((0, 0), (0, size - counts.shape[1])))
                counts[0] += np.bincount(ids, times, size).astype(np.int64)
                cells = np.sort(rows * size + ids)
                counts[1] += np.bincount(cells[np.append(True, cells[1:] != cells[:-1])] % size, minlength=size)
                if size > MAX_TERMS:
                    yield from told()
                    terms.ids = {}
                    counts = np.zeros((2, 0), np.int64)
        yield from told()

    parts = lists.mapInArrow(run, "term string, tf long, df long")
    return parts.groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def has_text(df: DataFrame, text_col: str | None) -> bool:
    """False without a text column or when every text is empty."""
    if text_col is None or text_col not in df.columns:
        return False
    return df.where(F.length(text_col) > 0).limit(1).count() > 0


def fit_vocabulary(df: DataFrame, text_col: str, analyzer: str = "char_wb", ngram_range=NGRAM_RANGE,
                   min_df: int = MIN_DF, max_features: int = MAX_FEATURES) -> DataFrame:
    """(term, term_id, tf, df, idf) of the most frequent terms; ids in term order, at most ``max_features`` rows."""
    n_rows = df.count()
    kept = (
        term_statistics(df, text_col, analyzer, ngram_range).where(F.col("df") >= min_df)
        .orderBy(F.desc("tf"), "term").limit(max_features)
    )
    rows = sorted(kept.collect(), key=lambda r: r["term"].encode("utf-8"))
    table = df.sparkSession.createDataFrame(
        [(r["term"], i, r["tf"], r["df"]) for i, r in enumerate(rows)], "term string, term_id int, tf bigint, df bigint"
    )
    idf = F.log((1.0 + F.lit(float(n_rows))) / (1.0 + F.col("df"))) + 1.0
    return table.withColumn("idf", idf)


def _lists(ends: list[np.ndarray], values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """Lists of the values, cut where each of them ends."""
    sizes = np.concatenate([np.zeros(1, np.int64), *ends])
    return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), pa.array(np.concatenate(values or [np.zeros(0)]), kind))


def _row_weights(vocabulary: dict[str, int], idf: np.ndarray, analyzer: str, ngram_range):
    """Arrow function: array of words -> sorted ids and weights of the row's terms."""
    terms, width = _Terms(analyzer, ngram_range, vocabulary), max(len(idf), 1)

    @F.arrow_udf("indices array<int>, weights array<double>")
    def weigh(lists: pa.Array) -> pa.Array:
        sizes, indices, weights = [], [], []
        for piece in _pieces(lists, max(1, MAX_CELLS // width)):
            rows, ids, times = terms.hits(piece)
            times = np.bincount(rows * width + ids, times, len(piece) * width)
            cells = np.flatnonzero(times)
            rows, ids = cells // width, cells % width
            w = (np.log(times[cells]) + 1.0) * idf[ids]
            sizes.append(np.bincount(rows, minlength=len(piece)))
            indices.append(ids)
            weights.append(w / np.sqrt(np.bincount(rows, w * w, len(piece)))[rows])
        return pa.StructArray.from_arrays(
            [_lists(sizes, [i.astype(np.int32) for i in indices], pa.int32()), _lists(sizes, weights, pa.float64())], names=["indices", "weights"])

    return weigh


def tfidf_column(vocabulary: DataFrame, text: Column, analyzer: str = "char_wb", ngram_range=NGRAM_RANGE) -> Column:
    """(indices, weights) of a text: sublinear tf times smooth idf, each row of length 1.

    All that a row needs is in the row and the vocabulary of at most ``max_features`` terms, so
    nothing is shuffled or joined and repeated ids do not matter; it works on a stream too.
    """
    rows = vocabulary.select("term", "term_id", "idf").collect()
    idf = np.zeros(len(rows))
    for r in rows:
        idf[r["term_id"]] = r["idf"]
    weigh = _row_weights({r["term"]: r["term_id"] for r in rows}, idf, analyzer, ngram_range)
    return weigh(words_of(text, analyzer))


def tfidf(df: DataFrame, vocabulary: DataFrame, id_col: str, text_col: str, analyzer: str = "char_wb",
          ngram_range=NGRAM_RANGE) -> DataFrame:
    """(id, indices, weights) of every row."""
    column = tfidf_column(vocabulary, F.col(text_col), analyzer, ngram_range)
    rows = spread(df.select(id_col, text_col))
    return rows.select(id_col, column.alias("__tfidf")).select(id_col, "__tfidf.indices", "__tfidf.weights")


def tfidf_long(sparse: DataFrame, id_col: str) -> DataFrame:
    pairs = F.explode(F.arrays_zip("indices", "weights")).alias("p")
    return sparse.select(id_col, pairs).select(id_col, F.col("p.indices").alias("term_id"), F.col("p.weights").alias("weight"))
