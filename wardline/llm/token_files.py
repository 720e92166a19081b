"""Token ids of whole texts in a binary table of byte planes (Token-ID / binary output)."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.llm.base import pick
from wardline.llm.segments import Memo, held, slices, utf8_bytes
from wardline.session import scratch_path

#: Ids of one transposed block, and ids after which a chunk ends at the next document.
BLOCK_IDS, CHUNK_IDS, PLANES = 1 << 16, 1 << 20, 4

_FILE = T.StructType([
    T.StructField("shard", T.IntegerType()), T.StructField("chunk", T.IntegerType()),
    T.StructField("shard_start", T.LongType()), T.StructField("n_ids", T.LongType()),
    T.StructField("doc_ids", T.ArrayType(T.LongType())), T.StructField("doc_tokens", T.ArrayType(T.LongType())),
    T.StructField("index", T.ArrayType(T.LongType())), T.StructField("payload", T.BinaryType()),
])


def _byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shifted = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(shifted)) for b in range(256)]


class WordEncoder:
    """Ids of segments by the tokenizers library.

    Segments of printable ASCII and Latin-1 letters, which normalisation only turns to lower
    case, are cut by the file's own pattern and given to the library's model word by word; any
    other segment goes through the whole library pipeline.
    """

    _PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]*")
    _WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")

    def __init__(self, path: str, most: int = 300_000):
        from tokenizers import Tokenizer

        self.library, self.most = Tokenizer.from_file(path), most
        self.model, self.letters, self.words = self.library.model, _byte_letters(), {}

    def word(self, word: str) -> list[int]:
        ids = self.words.get(word)
        if ids is None:
            as_letters = word if word.isascii() else "".join(map(self.letters.__getitem__, word.encode()))
            ids = self.words[word] = [t.id for t in self.model.tokenize(as_letters)]
        return ids

    def __call__(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.words) > self.most:
            self.words.clear()
        out = []
        for segment in segments:
            text = segment.decode().strip(" \t\n\r\v\f")
            if self._PLAIN.fullmatch(text) and "<|" not in text:
                found = self._WORDS.findall(text.lower())
                out.append(self.word(found[0]) if len(found) == 1 else [i for w in found for i in self.word(w)])
            else:
                out.append(self.library.encode(text, add_special_tokens=False).ids)
        return np.fromiter(chain.from_iterable(out), np.int32), np.array([len(x) for x in out], np.int64)


def word_memo(path: str) -> Memo:
    """One per worker process and file."""
    return held(("words", path), lambda: Memo(WordEncoder(path), 700_000))


def pack(ids: np.ndarray) -> tuple[list[int], bytes]:
    """Blocks of ids turned into byte planes, each compressed; index: end of each plane."""
    press, parts, index, at = zstandard.ZstdCompressor(level=3), [], [], 0
    for k in range(0, len(ids), BLOCK_IDS):
        planes = ids[k:k + BLOCK_IDS].astype("<u4").view(np.uint8).reshape(-1, PLANES)
        for p in range(PLANES):
            parts.append(press.compress(planes[:, p].tobytes()))
            at += len(parts[-1])
            index.append(at)
    return index, b"".join(parts)


def unpack(index: list[int], payload: bytes, n_ids: int, first: int = 0, count: int | None = None) -> np.ndarray:
    """Ids ``first`` to ``first + count`` of a chunk; only the blocks that hold them are read."""
    count = n_ids - first if count is None else count
    if count <= 0:
        return np.zeros(0, "<u4")
    raw, bounds, blocks = zstandard.ZstdDecompressor(), [0, *index], []
    low, high = first // BLOCK_IDS, (first + count - 1) // BLOCK_IDS
    for k in range(low, high + 1):
        size = min(BLOCK_IDS, n_ids - k * BLOCK_IDS)
        planes = [np.frombuffer(raw.decompress(payload[bounds[i]:bounds[i + 1]], size), np.uint8)
                  for i in range(k * PLANES, (k + 1) * PLANES)]
        blocks.append(np.stack(planes, axis=1).reshape(-1).view("<u4"))
    skip = first - low * BLOCK_IDS
    return np.concatenate(blocks)[skip:skip + count]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode whole texts and write their ids, document after document in ascending id.

    The table at ``path`` holds one row per chunk: its shard (ascending ranges of document ids),
    number, position within the shard, the documents and their token counts, and the blocks as
    compressed byte planes with the index of their ends. A chunk holds whole documents, so it is
    read alone.

    Null texts count as empty and have the end id only. Null document ids come first; repeated
    ids stay together, ordered by text. An empty table gives an empty table. Other columns are
    not read.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, shard = word_memo(tokenizer), TaskContext.get().partitionId()
        number = start = held = 0
        doc_ids: list[int | None] = []
        counts: list[int] = []
        parts: list[np.ndarray] = []

        def chunk() -> pa.RecordBatch:
            ids = np.concatenate(parts)
            index, payload = pack(ids)
            row = {"shard": shard, "chunk": number, "shard_start": start, "n_ids": len(ids), "doc_ids": doc_ids,
                   "doc_tokens": counts, "index": index, "payload": payload}
            return pa.RecordBatch.from_pylist([row], arrow_file)

        for batch in batches:
            texts, keys = batch.column(1), batch.column(0).to_pylist()
            for a, b in slices(texts, 2 << 20):
                ids, offsets = memo(*utf8_bytes(texts.slice(a, b - a)))
                for k in range(b - a):
                    own = np.append(ids[offsets[k]:offsets[k + 1]], end_id).astype(np.uint32)
                    parts.append(own)
                    doc_ids.append(keys[a + k])
                    counts.append(len(own))
                    held += len(own)
                    if held >= CHUNK_IDS:
                        yield chunk()
                        number, start, held = number + 1, start + held, 0
                        doc_ids, counts, parts = [], [], []
        if parts:
            yield chunk()

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow_file = to_arrow_schema(_FILE)
    rows = pick(docs, id_col, text_col)
    ordered = rows.repartitionByRange(F.col(id_col)).sortWithinPartitions(id_col, text_col)
    ordered.mapInArrow(encode, _FILE).write.option("compression", "none").mode("overwrite").parquet(path)


def read_tokens(spark, path: str, digest: bool = False, id_col: str = "doc_id") -> DataFrame:
    """Documents read back: id, ``start`` (ids before it), ``n_tokens`` and ``ids``.

    With ``digest`` the ids are replaced by their checksum ``ids_crc32``.
    """
    table = spark.read.schema(_FILE).parquet(path)
    last = T.StructField("ids_crc32", T.LongType()) if digest else T.StructField("ids", T.ArrayType(T.LongType()))
    schema = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField(id_col, T.LongType()),
                           T.StructField("shard_start", T.LongType()), T.StructField("n_tokens", T.LongType()), last])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["index"], row["payload"], row["n_ids"])
                counts = np.array(row["doc_tokens"], np.int64)
                ends = np.cumsum(counts)
                own = [ids[e - n:e] for e, n in zip(ends.tolist(), counts.tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["shard"]] * len(own), pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                    pa.array(row["shard_start"] + ends - counts, pa.int64()), pa.array(counts, pa.int64()),
                    pa.array([zlib.crc32(x.tobytes()) for x in own], pa.int64()) if digest
                    else pa.array([x.astype(np.int64) for x in own], pa.list_(pa.int64()))], names=schema.names)

    # one row per shard: as many as there were write tasks
    totals = table.groupBy("shard").agg(F.sum("n_ids").alias("_ids"))
    from pyspark.sql import Window

    before = F.coalesce(F.sum("_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards = totals.select("shard", before.alias("_before"))
    docs = table.mapInArrow(decode, schema).join(shards, "shard")
    return docs.select(id_col, (F.col("_before") + F.col("shard_start")).alias("start"), "n_tokens", last.name)


def token_table(docs: DataFrame, tokenizer: str, path: str | None = None, end_id: int = 1) -> DataFrame:
    """Write the ids of all documents and return what the files say: id, start, count, checksum."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    write_tokens(docs, path, tokenizer, end_id)
    return read_tokens(spark, path, digest=True)
