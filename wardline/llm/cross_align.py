"""Cross-tokenizer alignment: which tokens of one tokenizer cover the bytes of which of another.

Both tokenizers cut a text at the same spaces, so distinct segments between such spaces are
encoded and aligned once per task. A first pass over the documents keeps the distinct pairs of
each. The distinct pairs of the corpus get a minimal perfect hash, built in buckets, and dense
vectors indexed by that hash, summed over all tasks, count how many documents hold each pair. A
second pass aligns the documents again and looks the counts up.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.base import pick, settings, stored
from wardline.llm.segments import Memo, held, mixed, ragged, segment_starts, slices, utf8_bytes
from wardline.operators.trees import PART, part_row, tree_sum

#: Bits of a hash level per key, keys of a bucket, segments and link bytes remembered by a worker.
GAMMA, BUCKET_KEYS, MOST_SEGMENTS, MOST_BYTES = 2, 4096, 300_000, 48 << 20


#: How byte-level pre-tokenizers cut a text (fixed value).
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


# --- minimal perfect hash ---------------------------------------------------------------

def _level(keys: np.ndarray, level: int) -> np.ndarray:
    return mixed(keys.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15 * (level + 1) & (1 << 64) - 1), level + 1)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each pair, whole numbers below ``buckets``."""
    return ((mixed(keys.astype(np.uint64)) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def build(keys: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(bits of each level, the bits in words, the keys in the order of their hash) of distinct keys.

    A level marks the places met by exactly one key; the others try the next level. The hash of
    a key is the number of marks before its own.
    """
    sizes, marks, rest, base = [], [], keys, 0
    place = np.zeros(len(keys), np.int64)
    open_at = np.arange(len(keys))
    while len(rest):
        size = -(-max(GAMMA * len(rest), 1) // 64) * 64
        at = (_level(rest, len(sizes)) % np.uint64(size)).astype(np.int64)
        single = np.bincount(at, minlength=size) == 1
        alone = single[at]
        place[open_at[alone]] = base + at[alone]
        sizes.append(size)
        marks.append(single)
        rest, open_at, base = rest[~alone], open_at[~alone], base + size
        if len(sizes) > 200:
            raise ValueError("equal keys have no perfect hash")
    words = np.packbits(np.concatenate(marks), bitorder="little").view("<u8") if marks else np.zeros(0, "<u8")
    return sizes, words, keys[np.argsort(place)]


@dataclass
class PairIndex:
    """Minimal perfect hash of the pairs in buckets ``low`` up to ``high``, with the keys to verify."""

    buckets: int
    low: int
    high: int
    start: np.ndarray  # first word of each (bucket, level)
    size: np.ndarray   # bits of each (bucket, level), 0 where there is none
    words: np.ndarray
    before: np.ndarray  # marks before each word
    keys: np.ndarray

    @staticmethod
    def of(rows: list, buckets: int, low: int, high: int) -> "PairIndex":
        """From the rows of the buckets in ascending order; a bucket without a row is empty."""
        depth = max([len(r["sizes"]) for r in rows], default=1)
        size, first = np.zeros((high - low, depth), np.int64), np.zeros(high - low, np.int64)
        words, keys, at = [], [], 0
        for r in rows:
            size[r["bucket"] - low, :len(r["sizes"])] = r["sizes"]
            first[r["bucket"] - low] = at
            words.append(np.frombuffer(r["words"], "<u8"))
            keys.append(np.frombuffer(r["keys"], "<i8"))
            at += len(words[-1])
        flat = np.concatenate([*words, np.zeros(1, "<u8")])
        before = np.cumsum(np.append(0, np.bitwise_count(flat[:-1]).astype(np.int64)))
        start = first[:, None] + (np.cumsum(size, axis=1) - size) // 64
        return PairIndex(buckets, low, high, start, size, flat, before, np.concatenate([*keys, np.zeros(0, "<i8")]))

    def find(self, pairs: np.ndarray) -> np.ndarray:
        """Hash of each pair, verified by its key; -1 for a pair that is not in these buckets."""
        out = np.full(len(pairs), -1, np.int64)
        bucket = bucket_of(pairs, self.buckets) - self.low
        todo = np.flatnonzero((bucket >= 0) & (bucket < self.high - self.low))
        for level in range(self.size.shape[1]):
            todo = todo[self.size[bucket[todo], level] > 0]
            if not len(todo):
                break
            own = bucket[todo]
            bit = (_level(pairs[todo], level) % self.size[own, level].astype(np.uint64)).astype(np.int64)
            word, shift = self.start[own, level] + (bit >> 6), (bit & 63).astype(np.uint64)
            held_bits = self.words[word]
            hit = (held_bits >> shift) & np.uint64(1) == 1
            under = held_bits & ((np.uint64(1) << shift) - np.uint64(1))
            out[todo[hit]] = (self.before[word] + np.bitwise_count(under))[hit]
            todo = todo[~hit]
        known = np.flatnonzero(out >= 0)
        out[known[self.keys[out[known]] != pairs[known]]] = -1
        return out


# --- alignment in a task ----------------------------------------------------------------

def _letters() -> dict[str, int]:
    """The byte for which byte-level vocabularies write each printable letter."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Vocabulary:
    """Bytes of all ids end to end."""

    def __init__(self, tokens: list[bytes]):
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.offsets = np.append(0, np.cumsum(self.lengths))
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return ragged(self.offsets, self.data, ids)[0]


def _a_encoder(path: str):
    """(ids of a list of texts, bytes of each id) of a byte-level BPE file.

    Where the ids of the file count its merges in order, as byte-level vocabularies do, they are
    ranks, and a rank encoder gives the same ids several times faster; any other file goes
    through its own library.
    """
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True  # their strings are plain text
    letter, entries = _letters(), library.get_vocab(with_added_tokens=True)
    names: list[str] = [""] * (max(entries.values()) + 1)
    for token, i in entries.items():
        names[i] = token
    tokens = [bytes(letter.get(c, 0) for c in t) for t in names]
    with open(path, encoding="utf-8") as lines:
        whole = json.load(lines)
    model, cut = whole["model"], whole["pre_tokenizer"] or {}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    vocabulary = model["vocab"]
    ranked = (
        model["type"] == "BPE" and whole["normalizer"] is None and whole["post_processor"] is None and not model.get("dropout")
        and not model.get("ignore_merges") and cut.get("type") == "ByteLevel" and cut.get("use_regex", True)
        and not cut["add_prefix_space"] and len(vocabulary) == 256 + len(merges)
        and all(vocabulary.get(x + y) == 256 + i for i, (x, y) in enumerate(merges)))
    if not ranked:
        return lambda texts: [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)], tokens
    import tiktoken

    core = tiktoken.Encoding("own", pat_str=BYTE_LEVEL, mergeable_ranks={tokens[i]: i for i in vocabulary.values()}, special_tokens={})
    return lambda texts: list(map(core._core_bpe.encode_ordinary, texts)), tokens


class Aligner:
    """Both tokenizers, and what is known of the segments met since the last reset.

    Per segment, in the order in which they were met: the numbers of ids, groups and links, whether
    its bytes come back from both tokenizers, its links as pair codes (A id << 32 | B id), and
    its groups as text.
    """

    def __init__(self, a_path: str, b_path: str, texts: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece

        self.b, self.texts = sentencepiece.SentencePieceProcessor(model_file=b_path), texts
        self.a_ids, a_tokens = _a_encoder(a_path)
        self.a_bytes = _Vocabulary(a_tokens)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = _Vocabulary([
            bytes([int(re.fullmatch("<0x(..)>", p)[1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)])
        self.space = self.b.piece_to_id("▁")
        self.reset()

    def reset(self) -> None:
        """Forget all segments; row numbers given before are void."""
        self.memo = Memo(self._learn, 1 << 60, np.int64, 1 << 60)
        self.met = 0
        self.parts: dict[str, list] = {k: [] for k in ("n_a", "n_b", "n_groups", "n_links", "good", "links", "text", "text_size")}

    @property
    def full(self) -> bool:
        return self.met > MOST_SEGMENTS or sum(x.nbytes for k in ("links", "text") for x in self.parts[k]) > MOST_BYTES

    def column(self, name: str) -> np.ndarray:
        parts = self.parts[name]
        if len(parts) != 1:
            empty = {"good": bool, "text": np.uint8}.get(name, np.int64)
            self.parts[name] = parts = [np.concatenate([*parts, np.zeros(0, empty)])]
        return parts[0]

    def offsets(self, sizes: str) -> np.ndarray:
        return np.append(0, np.cumsum(self.column(sizes)))

    def _b_ids(self, texts: list[str]) -> list[list[int]]:
        # the tokenizer puts the first space itself; a lone space would be an empty text
        found = self.b.encode([t[1:] for t in texts], num_threads=1)
        return [x if t != " " else [self.space] for t, x in zip(texts, found)]

    def _learn(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        texts, n = [s.decode() for s in segments], len(segments)
        a_ids, b_ids = self.a_ids(texts), self._b_ids(texts)
        n_a, n_b = (np.fromiter(map(len, x), np.int64, n) for x in (a_ids, b_ids))
        a, b = (np.fromiter(chain.from_iterable(x), np.int64, int(m.sum())) for x, m in ((a_ids, n_a), (b_ids, n_b)))
        good, flat = np.ones(n, bool), np.frombuffer(b"".join(segments), np.uint8)
        if not (np.array_equal(self.a_bytes.joined(a), flat) and np.array_equal(self.b_bytes.joined(b), flat)):
            a_at, b_at = np.append(0, np.cumsum(n_a)), np.append(0, np.cumsum(n_b))
            good = np.array([self.a_bytes.joined(a[a_at[k]:a_at[k + 1]]).tobytes() == s
                             and self.b_bytes.joined(b[b_at[k]:b_at[k + 1]]).tobytes() == s for k, s in enumerate(segments)])
            a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
            n_a, n_b = np.where(good, n_a, 0), np.where(good, n_b, 0)
        ends = np.cumsum([len(s) if g else 0 for s, g in zip(segments, good.tolist())])
        a_ends, b_ends = np.cumsum(self.a_bytes.lengths[a]), np.cumsum(self.b_bytes.lengths[b])
        cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
        a_group, b_group = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
        in_a, in_b = np.bincount(a_group, minlength=len(cuts)), np.bincount(b_group, minlength=len(cuts))
        n_groups = np.diff(np.append(0, np.searchsorted(cuts, ends, side="right")))
        # every A token of a group with every B token of it, in order
        times = in_b[a_group]
        b_first = (np.cumsum(in_b) - in_b)[a_group]
        place = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        links = np.repeat(a, times) << 32 | b[np.repeat(b_first, times) + place]
        of_segment = np.searchsorted(np.cumsum(n_groups), np.arange(len(cuts)), side="right")
        found = {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "good": good, "links": links,
                 "n_links": np.bincount(of_segment, in_a * in_b, n).astype(np.int64)}
        if self.texts:
            text = self._texts(a, b, in_a, in_b, n_groups)
            found |= {"text": np.frombuffer(b"".join(text), np.uint8), "text_size": np.array([len(t) for t in text], np.int64)}
        for k, x in found.items():
            self.parts[k].append(x)
        self.met += n
        return np.arange(self.met - n, self.met), np.ones(n, np.int64)

    @staticmethod
    def _texts(a: np.ndarray, b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray, n_groups: np.ndarray) -> list[bytes]:
        """Groups of each segment as ``a1,a2|b1;a3|b2``, each with a semicolon at its end."""
        left, right, groups, i, j = list(map(str, a.tolist())), list(map(str, b.tolist())), [], 0, 0
        for m, k in zip(in_a.tolist(), in_b.tolist()):
            groups.append(f"{left[i]}|{right[j]};" if m == k == 1 else f"{','.join(left[i:i + m])}|{','.join(right[j:j + k])};")
            i, j = i + m, j + k
        out, at = [], 0
        for m in n_groups.tolist():
            out.append("".join(groups[at:at + m]).encode())
            at += m
        return out

    def rows(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(rows of the segments of all texts end to end, offsets of the texts); no segment for null and empty texts."""
        texts = texts.cast(pa.large_string()).fill_null("")
        spaced = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise(
            pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string())))
        flat, offsets = utf8_bytes(spaced)
        starts = segment_starts(flat, offsets)
        return self.memo(flat, offsets, starts[flat[starts] == 32])


def _aligner(a_path: str, b_path: str, texts: bool) -> Aligner:
    return held(("align", a_path, b_path, texts), lambda: Aligner(a_path, b_path, texts))


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(values))
    return total[offsets[1:]] - total[offsets[:-1]]


def _whole(good: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts that have segments, all of which come back from both tokenizers."""
    return (np.diff(offsets) > 0) & (_sums(~good, offsets) == 0)


# --- passes over the documents ----------------------------------------------------------

def document_pairs(rows: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``pairs``: the distinct linked (A id << 32 | B id) of each document that both tokenizers keep.

    ``rows``: text in the last column.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = _aligner(a_path, b_path, False)
        align.reset()
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for i, j in slices(texts, 2 << 20):
                if align.full:
                    align.reset()
                found, at = align.rows(texts.slice(i, j - i))
                links = align.column("links")
                codes, numbers = np.unique(links, return_inverse=True)
                whole = np.repeat(_whole(align.column("good")[found], at), np.diff(at))
                doc = np.repeat(np.arange(len(at) - 1), np.diff(at))[whole]
                # each distinct segment of a document once, then each distinct pair of it
                once = np.unique(doc * np.int64(align.met + 1) + found[whole])
                doc, segment = once // (align.met + 1), once % (align.met + 1)
                own, ends = ragged(align.offsets("n_links"), numbers, segment)
                own = np.unique(np.repeat(doc, np.diff(ends)) * np.int64(len(codes) + 1) + own)
                ends = np.searchsorted(own // (len(codes) + 1), np.arange(len(at)))
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), pa.array(codes[own % (len(codes) + 1)], pa.int64()))], names=["pairs"])
        align.reset()

    return rows.mapInArrow(run, "pairs array<long>")


def _flat(batch: pa.RecordBatch) -> np.ndarray:
    return pa.concat_arrays([batch.column(0)]).flatten().to_numpy(zero_copy_only=False)


def distinct_pairs(lists: DataFrame) -> DataFrame:
    """``pair``: each pair of the corpus once; those of a batch meet before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(_flat(batch)), pa.int64())], names=["pair"])

    return lists.mapInArrow(run, "pair long").distinct()


_BUCKET = "bucket long, n long, sizes array<long>, words binary, keys binary"


def hash_table(pairs: DataFrame, buckets: int) -> DataFrame:
    """One row per bucket: its levels, marks and keys in hash order."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = bucket_of(batch.column(0).to_numpy(), buckets)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own)], names=["pair", "bucket"])

    def make(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = np.sort(np.concatenate([b.column("pair").to_numpy() for b in batches]))
        sizes, words, ordered = build(keys)
        yield pa.RecordBatch.from_pylist([{"bucket": key[0].as_py(), "n": len(keys), "sizes": sizes, "words": words.tobytes(),
                                          "keys": ordered.astype("<i8").tobytes()}], schema)

    schema = pa.schema([("bucket", pa.int64()), ("n", pa.int64()), ("sizes", pa.list_(pa.int64())),
                        ("words", pa.binary()), ("keys", pa.binary())])
    return pairs.mapInArrow(deal, "pair long, bucket long").groupBy("bucket").applyInArrow(make, _BUCKET)


def _counts(lists: DataFrame, index, length: int) -> np.ndarray:
    """In how many documents each pair of the index is linked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = index.value, np.zeros(length, np.int64)
        for batch in batches:
            flat = _flat(batch)
            for a in range(0, len(flat), 1 << 20):
                place = known.find(flat[a:a + (1 << 20)])
                total += np.bincount(place[place >= 0], minlength=length)
        yield part_row(TaskContext.get().partitionId(), total)

    return tree_sum(lists.mapInArrow(run, PART), length, "i8")


_OUT = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def _told(rows: DataFrame, index, counts, best, a_path: str, b_path: str, first: bool) -> DataFrame:
    """Documents aligned again, with the counts of those links whose pairs are in the index.

    All columns of ``rows`` but the text; ``first`` adds the numbers that no index has part in,
    and the groups.
    """
    keep = rows.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align, known, count, most = _aligner(a_path, b_path, first), index.value, counts.value, best.value
        align.reset()
        by_segment = np.zeros((2, 0), np.int64)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for i, j in slices(texts, 2 << 20):
                if align.full:
                    align.reset()
                    by_segment = np.zeros((2, 0), np.int64)
                found, at = align.rows(texts.slice(i, j - i))
                new = slice(by_segment.shape[1], align.met)
                link_ends = align.offsets("n_links")
                links = align.column("links")[link_ends[new.start]:]
                place = known.find(links)
                inside = place >= 0
                own = np.zeros(len(links), np.int64)
                own[inside] = count[place[inside]]
                top = inside & (own == most[links >> 32])
                ends = link_ends[new.start:] - link_ends[new.start]
                by_segment = np.concatenate([by_segment, [_sums(top, ends), _sums(own, ends)]], axis=1)
                whole = _whole(align.column("good")[found], at)
                numbers = {k: align.column(k)[found] for k in ("n_a", "n_b", "n_groups", "n_links")} if first else {}
                numbers |= {"n_best": by_segment[0][found], "count_sum": by_segment[1][found]}
                out = [batch.column(c).slice(i, j - i) for c in range(len(keep))]
                out += [pa.array(np.where(whole, _sums(v, at), 0)) for v in numbers.values()]
                if first:
                    text, ends = ragged(align.offsets("text_size"), align.column("text"), found)
                    ends, data = ends[at], text.tobytes()
                    out.append(pa.array([data[x:y - 1].decode() if w else "" for x, y, w in zip(
                        ends[:-1].tolist(), ends[1:].tolist(), whole.tolist())], pa.string()))
                yield pa.RecordBatch.from_arrays(out, names=names)
        align.reset()

    added = _OUT if first else _OUT[4:]
    names = [*keep, *added, *["groups"] * first]
    schema = ", ".join(f"{c} long" for c in [*keep, *added]) + ", groups string" * first
    return rows.mapInArrow(run, schema)


@dataclass
class Counted:
    """Blocks of the pair table: buckets, and document counts in hash order, in a stored table."""

    table: DataFrame
    counts: DataFrame
    buckets: int
    blocks: list[tuple[int, int, int]]  # first bucket, bucket after the last, pairs
    best: np.ndarray                    # highest count of each A id


def _index(spark: SparkSession, table: DataFrame, buckets: int, block: tuple[int, int, int]):
    low, high, _ = block
    rows = table.where(F.col("bucket").between(low, high - 1)).orderBy("bucket").collect()
    return PairIndex.of(rows, buckets, low, high)


def count_pairs(rows: DataFrame, a_path: str, b_path: str, block_pairs: int = 4_000_000) -> Counted:
    """Distinct pairs hashed in buckets, and counted block by block.

    One pass over the pairs of the documents serves ``block_pairs`` of them, so that what is
    broadcast and what a task adds up stays of one size; more pairs take more passes.
    """
    spark = rows.sparkSession
    with settings(spark, spark__sql__parquet__compression__codec="zstd"):
        lists = stored(document_pairs(rows, a_path, b_path), "lists")
    pairs = stored(distinct_pairs(lists), "pairs")
    buckets = max(1, -(-pairs.count() // BUCKET_KEYS))
    table = stored(hash_table(pairs, buckets), "hash")
    sizes = {r["bucket"]: r["n"] for r in table.select("bucket", "n").collect()}  # one number per 4,096 pairs
    blocks, low, held_pairs = [], 0, 0
    for bucket in range(buckets):
        n = sizes.get(bucket, 0)
        if held_pairs and held_pairs + n > block_pairs:
            blocks.append((low, bucket, held_pairs))
            low, held_pairs = bucket, 0
        held_pairs += n
    blocks.append((low, buckets, held_pairs))

    path, best = None, np.zeros(0, np.int64)
    for k, block in enumerate(blocks):
        index = _index(spark, table, buckets, block)
        shared = spark.sparkContext.broadcast(index)
        total = _counts(lists, shared, block[2])
        shared.unpersist()
        ids = index.keys >> 32
        if len(ids):
            best = np.concatenate([best, np.zeros(max(int(ids.max()) + 1 - len(best), 0), np.int64)])
            np.maximum.at(best, ids, total)
        part = spark.createDataFrame([(k, total.tobytes())], "block int, counts binary")
        path = part if path is None else path.union(part)
    return Counted(table, stored(path, "counts"), buckets, blocks, best)


def pair_table(counted: Counted) -> DataFrame:
    """(a, b, documents): every linked pair of ids with the number of documents that hold it."""
    spark, parts = counted.table.sparkSession, []
    for k, block in enumerate(counted.blocks):
        index = _index(spark, counted.table, counted.buckets, block)
        total = np.frombuffer(bytes(counted.counts.where(F.col("block") == k).first()["counts"]), np.int64)
        parts.append(spark.createDataFrame(pa.table({
            "a": index.keys >> 32, "b": index.keys & 0xFFFFFFFF, "documents": total}), "a long, b long, documents long"))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out.where("documents > 0")


def align_documents(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
                    block_pairs: int = 4_000_000) -> DataFrame:
    """Per document: id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups``.

    Tokenizer A (a tokenizers file of byte-level BPE) encodes a space and the text, B (a
    sentencepiece model with byte fallback) the text, to which it adds that space. Offsets where
    tokens of both end cut them into groups, written as ``a1,a2|b1;a3|b2``; all A and B tokens of a
    group are linked. ``count_sum`` adds, over links, the number of documents that hold the pair;
    ``n_best`` counts links whose pair has the highest such number of its A id, ties included.

    Null and empty texts, and texts that either tokenizer changes (such as U+2581 in them), have
    zeros and no groups, and count for no pair. Every row is a document of its own, whatever its
    id; null ids pass through. Texts are aligned whole, long ones in parts at spaces, where both
    tokenizers cut. Other columns are not read; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    rows = pick(docs, id_col, text_col)
    counted = count_pairs(rows.select(text_col), a_path, b_path, block_pairs)
    keyed = rows.select(F.col(id_col).cast("long").alias(id_col), F.xxhash64(F.lit(1), id_col, text_col).alias("_a"),
                        F.xxhash64(F.lit(2), id_col, text_col).alias("_b"), text_col)
    if len(counted.blocks) == 1:
        keyed = keyed.drop("_a", "_b")
    best = spark.sparkContext.broadcast(counted.best)
    out = None
    more = []
    for k, block in enumerate(counted.blocks):
        total = np.frombuffer(bytes(counted.counts.where(F.col("block") == k).first()["counts"]), np.int64)
        index = spark.sparkContext.broadcast(_index(spark, counted.table, counted.buckets, block))
        part = _told(keyed, index, spark.sparkContext.broadcast(total), best, a_path, b_path, k == 0)
        if k == 0:
            out = part
        else:  # rows of equal id and text have equal numbers
            more.append(part.groupBy("_a", "_b").agg(F.max("n_best").alias("n"), F.max("count_sum").alias("s")))
    if more:
        rest = more[0]
        for part in more[1:]:
            rest = rest.union(part)
        rest = rest.groupBy("_a", "_b").agg(F.sum("n").alias("_n"), F.sum("s").alias("_s"))
        out = out.join(rest, ["_a", "_b"]).withColumn("n_best", F.col("n_best") + F.col("_n")).withColumn(
            "count_sum", F.col("count_sum") + F.col("_s"))
    return out.select(id_col, *_OUT, "groups")
