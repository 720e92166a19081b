"""Byte-level BPE by recursive queries of an in-process DuckDB in each Spark task.

Token-position rows join the merge table; every round contracts the minimum-rank pair of each
word, leftmost first, until no pair of any word can merge. Decoding joins ids with their pieces
and aggregates the pieces in order.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from wardline.llm.base import pick
from wardline.llm.segments import Memo, held, slices, utf8_bytes

#: Words in one recursive query.
WORDS = 30_000

#: What rank-file libraries take for white space, written out because engines differ.
_SPACES = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"

# A round: the neighbours of each token, the rank of the pair with either one, the lowest rank
# of the word. A token whose pair to the right has that rank becomes the merged token, the one
# to the right of it goes (-1). In runs of one token (a word where some pair has equal halves)
# pairs overlap: the odd places of a run, counted from the left, are the pairs taken. The table
# is kept by word and position, so it holds one state of each, not one per round; the round
# makes every row of a word that still changes new, so that the next round sees all of it.
_ENCODE = """
WITH RECURSIVE steps(round, word, pos, tok) USING KEY (word, pos) AS (
  SELECT 0, word, pos, tok FROM words
  UNION (
  WITH beside AS (
      SELECT round, word, pos, tok, lead(tok) OVER w AS after, lag(tok) OVER w AS before
      FROM steps WHERE tok >= 0 WINDOW w AS (PARTITION BY word ORDER BY pos)),
    ranked AS (
      SELECT b.*, m.rank, n.rank AS back FROM beside b
      LEFT JOIN merges m ON tok = m.l AND after = m.r LEFT JOIN merges n ON before = n.l AND tok = n.r),
    lowest AS (
      SELECT word, min(rank) AS low, bool_or(tok = after) AS twin FROM ranked WHERE rank IS NOT NULL GROUP BY word),
    live AS (SELECT r.*, low, twin FROM ranked r JOIN lowest USING (word))
  SELECT round + 1, word, pos, CASE WHEN back IS NOT DISTINCT FROM low THEN -1 WHEN rank = low THEN low ELSE tok END
  FROM live WHERE NOT twin
  UNION ALL
  SELECT round + 1, word, pos, CASE WHEN back IS NOT DISTINCT FROM low AND (before <> tok OR place % 2 = 0) THEN -1
    WHEN rank = low AND (place % 2 = 1 OR tok <> after) THEN low ELSE tok END
  FROM (SELECT *, row_number() OVER (PARTITION BY word, run ORDER BY pos) AS place FROM (
    SELECT *, sum(CASE WHEN before = tok THEN 0 ELSE 1 END) OVER (PARTITION BY word ORDER BY pos) AS run
    FROM live WHERE twin))))
SELECT word, tok FROM steps WHERE tok >= 0 ORDER BY word, pos
"""

_DECODE = "SELECT string_agg(piece, '' ORDER BY run, pos) AS text FROM ids JOIN vocabulary USING (tok)"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class DuckBpe:
    """Encoder and decoder of one rank file, with memos of the segments met by this worker."""

    def __init__(self, path: str, pattern: str, most_words: int = 1_000_000, most_segments: int = 800_000):
        import duckdb
        import regex

        ranks = read_ranks(path)
        inside = pattern.replace("[^\\s", "[^" + _SPACES).replace("\\s", f"[{_SPACES}]").replace("\\S", f"[^{_SPACES}]")
        self.pattern, self.words = regex.compile(inside), Memo(self.encode_words, most_words)
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), merged.append(rank)
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "200MB", "temp_directory": ""})
        self._table("given", l=left, r=right, rank=merged)
        self.con.execute("CREATE TABLE merges AS SELECT * FROM given")
        # a piece is text with one character per byte: any bytes are valid there
        pieces = pa.table({"tok": pa.array(list(ranks.values()), pa.int32()),
                           "piece": [t.decode("latin-1") for t in ranks]})
        self.con.register("pieces", pieces)
        self.con.execute("CREATE TABLE vocabulary AS SELECT * FROM pieces")
        # an id run starts at a token that starts with white space: such runs recur as words do
        self.leads = np.zeros(max(ranks.values()) + 1, bool)
        self.lengths = np.zeros(len(self.leads), np.int64)
        for token, rank in ranks.items():
            self.leads[rank], self.lengths[rank] = token[:1] in b" \n", len(token)
        self.encoded, self.decoded = Memo(self._segments, most_segments), Memo(self._runs, most_segments, np.uint8)

    def _table(self, name: str, **columns) -> None:
        self.con.register(name, pa.table({k: pa.array(v, pa.int32()) for k, v in columns.items()}))

    @staticmethod
    def _numbered(parts: list) -> tuple[np.ndarray, np.ndarray]:
        """(number of the part, place in it) for each element."""
        sizes = np.array([len(p) for p in parts], np.int64)
        ends = np.cumsum(sizes)
        return np.repeat(np.arange(len(parts)), sizes), np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the words end to end, number of ids of each)."""
        ids, sizes = [], []
        for k in range(0, len(words), WORDS):
            part = words[k:k + WORDS]
            number, place = self._numbered(part)
            self._table("words", word=number, pos=place, tok=self.single[np.frombuffer(b"".join(part), np.uint8)])
            rows = self.con.execute(_ENCODE).fetchnumpy()
            ids.append(np.asarray(rows["tok"], np.int32))
            sizes.append(np.bincount(rows["word"], minlength=len(part)))
        return np.concatenate(ids), np.concatenate(sizes)

    def decode_runs(self, runs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of the id runs end to end, number of bytes of each)."""
        out: list[bytes] = []
        sizes: list[np.ndarray] = []
        for k in range(0, len(runs), WORDS):
            part = runs[k:k + WORDS]
            number, place = self._numbered(part)
            self._table("ids", run=number, pos=place, tok=np.concatenate(part))
            rows = self.con.execute(_DECODE).fetchnumpy()
            out.append(rows["text"][0].encode("latin-1"))
            sizes.append(np.bincount(number, self.lengths[np.concatenate(part)], len(part)).astype(np.int64))
        return np.frombuffer(b"".join(out), np.uint8), np.concatenate(sizes)

    def _segments(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        cut = [self.pattern.findall(s.decode()) for s in segments]
        sizes = np.array([len(w.encode()) for words in cut for w in words], np.int64)
        text_ends = np.cumsum([len(s) for s in segments])
        ids, at = self.words(np.frombuffer(b"".join(segments), np.uint8), np.append(0, text_ends), np.cumsum(sizes) - sizes)
        return ids, np.diff(at)

    def _runs(self, runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return self.decode_runs([np.frombuffer(r, np.int32) for r in runs])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, offsets of the texts)."""
        return self.encoded(*utf8_bytes(texts))

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes end to end, offsets of the texts)."""
        ids = np.ascontiguousarray(ids, np.int32)
        start = np.append(self.leads[ids], False)
        start[offsets[:-1]] = True
        starts = np.flatnonzero(start[:len(ids)])
        return self.decoded(ids.view(np.uint8), offsets * 4, starts * 4)


def worker_bpe(path: str, pattern: str) -> DuckBpe:
    """One per worker process and rank file."""
    return held(("bpe", path, pattern), lambda: DuckBpe(path, pattern))


def encode_decode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                  extra: tuple[str, ...] = ()) -> DataFrame:
    """Id, ``extra`` columns, ``ids`` of the text and ``decoded``: the bytes that these ids stand for.

    Texts are encoded whole, each match of the pattern by itself, without special tokens. Null
    and empty texts have no ids and decode to no bytes. Each row is on its own: null and repeated
    document ids pass through, an empty table gives an empty one, other columns are not read.
    """
    rows = pick(docs, id_col, *extra, text_col)
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker_bpe(path, pattern)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for a, b in slices(texts, 4 << 20):
                ids, at = bpe.encode(texts.slice(a, b - a))
                data, ends = bpe.decode(ids, at)
                yield pa.RecordBatch.from_arrays([
                    *[batch.column(i).slice(a, b - a) for i in range(batch.num_columns - 1)],
                    pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32())),
                    pa.Array.from_buffers(pa.binary(), b - a, [
                        None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]),
                ], names=schema.names)

    return rows.mapInArrow(run, schema)
