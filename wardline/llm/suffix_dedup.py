"""Suffix-array dedup: bytes of strings that an earlier document holds too are removed.

Only suffixes that start at anchors are sorted. The anchor of a string of ``LENGTH`` bytes is
the place of its smallest hash of LEAD bytes, leftmost of equals, so equal strings have equal
anchors at equal places, and all strings of one anchor start within REACH bytes before it.

1. Documents are dealt into batches by a hash of their id. Each batch sends the distinct hashes
   of its anchors; a hash seen for one document only marks strings that are found nowhere else.
2. For the other anchors a batch sends the distinct surroundings (the bytes of all their
   strings) with the smallest document id, range-partitioned by their leading bytes at sampled
   splitters. A bucket sorts them by multikey quicksort, to the right of the anchor and,
   reversed, to the left; common prefixes of neighbours say for each offset which strings are
   equal and which document comes first.
3. Each batch gets a bit per surrounding and offset, and cuts its texts.

Splitters are whole leading strings and equal strings have equal leading bytes, so suffixes on
the two sides of a boundary never share a string: the comparison across it is that of leading
bytes, made when the splitters are chosen.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.base import pick, stored
from wardline.llm.segments import inverse_powers, mixed, prefix_sums, utf8_bytes

LENGTH, LEAD = 50, 24
REACH = LENGTH - LEAD                 # strings of an anchor start up to so many bytes before it
FIELD = REACH + LENGTH                # bytes around an anchor that its strings can hold
#: String starts handled at a time within a batch.
PART = 1 << 20
_NULL_ID = -(1 << 63)


def _least(hashes: np.ndarray) -> np.ndarray:
    """Place of the smallest hash, leftmost of equals, in each run of REACH + 1."""
    value, place, width = hashes, np.arange(len(hashes), dtype=np.int32), 1

    def join(value, place, shift):
        left, right = value[:-shift], value[shift:]
        second = right < left
        return np.where(second, right, left), np.where(second, place[shift:], place[:-shift])

    while 2 * width <= REACH + 1:
        value, place = join(value, place, width)
        width *= 2
    if width < REACH + 1:
        value, place = join(value, place, REACH + 1 - width)
    return place


class Batch:
    """Anchors of the texts of one batch, in the order of their place."""

    def __init__(self, table: pa.Table):
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        self.ids = np.array([_NULL_ID if i is None else i for i in table["doc_id"].to_pylist()], np.int64)
        self.flat, self.offsets = utf8_bytes(table["text"].combine_chunks())
        owner = np.repeat(np.arange(len(self.ids)), np.diff(self.offsets))
        parts = []
        for low in range(0, max(len(self.flat) - LENGTH + 1, 0), PART):
            high = min(low + PART, len(self.flat) - LENGTH + 1)
            data = self.flat[low:high + LENGTH - 1]
            sums = prefix_sums(data)
            hashes = mixed((sums[LEAD:] - sums[:-LEAD]) * inverse_powers(len(sums))[:len(sums) - LEAD])
            place = _least(hashes)
            inside = np.flatnonzero(owner[low:high] == owner[low + LENGTH - 1:high + LENGTH - 1])
            at = place[inside]
            new = np.ones(len(at), bool)
            new[1:] = (at[1:] != at[:-1]) | (np.diff(inside) > 1)
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(at)) - 1
            parts.append((at[first] + low, inside[first] + low, inside[last] + low, hashes[at[first]], owner[inside[first] + low]))
        names = ("place", "first", "last", "hash", "owner")
        kinds = (np.int64, np.int64, np.int64, np.uint64, np.int64)
        for k, (name, kind) in enumerate(zip(names, kinds)):
            setattr(self, name, np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, kind))

    def hashes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ascending distinct hashes, whether two documents here have it, hash number of each anchor)."""
        distinct, number = np.unique(self.hash, return_inverse=True)
        low = np.full(len(distinct), np.iinfo(np.int64).max)
        high = np.full(len(distinct), np.iinfo(np.int64).min)
        np.minimum.at(low, number, self.ids[self.owner])
        np.maximum.at(high, number, self.ids[self.owner])
        return distinct, low < high, number

    def surroundings(self, picked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct surroundings of the picked anchors as rows of FIELD + 2 bytes, in byte order.

        A row has the bytes from the anchor on, those before it reversed, and how many of each
        its strings reach. Also the smallest id of each, and the row number of each anchor.
        """
        left, right = self.place[picked] - self.first[picked], self.last[picked] + LENGTH - self.place[picked]
        steps = np.concatenate([np.arange(LENGTH), -1 - np.arange(REACH)])
        reach = np.concatenate([np.tile(right[:, None], LENGTH) > np.arange(LENGTH),
                                np.tile(left[:, None], REACH) > np.arange(REACH)], axis=1)
        where = np.clip(self.place[picked][:, None] + steps, 0, max(len(self.flat) - 1, 0))
        rows = np.zeros((len(picked), FIELD + 2), np.uint8)
        rows[:, :FIELD] = np.where(reach, self.flat[where], 0)
        rows[:, FIELD], rows[:, FIELD + 1] = left, right
        order, same = multikey_order(words_of(rows))
        group = np.zeros(len(picked), np.int64)
        group[order] = np.cumsum(~same) - 1
        ids = np.full(int((~same).sum()), np.iinfo(np.int64).max)
        np.minimum.at(ids, group, self.ids[self.owner[picked]])
        return rows[order[~same]], ids, group


def words_of(rows: np.ndarray) -> list[np.ndarray]:
    """Columns of 8 bytes each as numbers that compare like the bytes."""
    wide = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    wide[:, :rows.shape[1]] = rows
    return list(wide.view(">u8").astype(np.uint64).T)


def multikey_order(words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(order of the rows, whether a row equals the one before it in that order).

    Multikey quicksort with characters of 8 bytes: rows are sorted by one character, and only
    groups that are still equal go on to the next.
    """
    n = len(words[0])
    order = np.argsort(words[0], kind="stable")
    same = np.zeros(n, bool)
    same[1:] = words[0][order][1:] == words[0][order][:-1]
    for word in words[1:]:
        grouped = same.copy()
        grouped[:-1] |= same[1:]
        at = np.flatnonzero(grouped)
        if not len(at):
            break
        group = np.cumsum(~same[at])
        rows = order[at]
        inner = np.lexsort((word[rows], group))
        order[at] = rows[inner]
        value = word[order[at]]
        still = np.zeros(len(at), bool)
        still[1:] = same[at][1:] & (value[1:] == value[:-1])
        same[at] = still
    return order, same


def _common(rows: np.ndarray) -> np.ndarray:
    """Length of the prefix that each row shares with the one before it."""
    out = np.zeros(len(rows), np.int64)
    if len(rows) > 1:
        differ = rows[1:] != rows[:-1]
        out[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return out


def first_seen(rows: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Bit per offset of each surrounding: a smaller document has the string that starts there."""
    n = len(rows)
    by_right, _ = multikey_order(words_of(rows[:, :LENGTH]))
    by_left, _ = multikey_order(words_of(rows[:, LENGTH:FIELD]))
    common_right, common_left = _common(rows[by_right, :LENGTH]), _common(rows[by_left, LENGTH:FIELD])
    left, right = rows[:, FIELD].astype(np.int64), rows[:, FIELD + 1].astype(np.int64)
    mask = np.zeros(n, np.uint32)
    right_class, left_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for offset in range(REACH + 1):
        right_class[by_right] = np.cumsum(common_right < LENGTH - offset)
        left_class[by_left] = np.cumsum(common_left < offset)
        # strings at this offset reach from ``offset`` before the anchor to LENGTH - offset after it
        some = np.flatnonzero((left >= offset) & (right >= LENGTH - offset))
        if not len(some):
            continue
        both = right_class[some] * (n + 1) + left_class[some]
        order = np.lexsort((ids[some], both))
        both, own = both[order], ids[some][order]
        head = np.ones(len(some), bool)
        head[1:] = both[1:] != both[:-1]
        least = own[np.flatnonzero(head)][np.cumsum(head) - 1]
        mask[some[order[own > least]]] |= np.uint32(1 << offset)
    return mask


def _pack(*arrays: np.ndarray) -> bytes:
    press = zstandard.ZstdCompressor(level=3)
    parts = [press.compress(np.ascontiguousarray(a).tobytes()) for a in arrays]
    return np.array([len(p) for p in parts], np.int64).tobytes() + b"".join(parts)


def _unpack(data: bytes, *kinds) -> list[np.ndarray]:
    sizes, at, out = np.frombuffer(data, np.int64, len(kinds)).tolist(), 8 * len(kinds), []
    for size, kind in zip(sizes, kinds):
        raw = zstandard.decompress(data[at:at + size]) if size else b""
        out.append(np.frombuffer(raw, kind))
        at += size
    return out


def _planes(values: np.ndarray) -> np.ndarray:
    """Differences of ascending numbers, one byte plane after another: the high planes are nearly empty."""
    return np.diff(values, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T


def _from_planes(planes: np.ndarray) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(planes.reshape(8, -1).T).reshape(-1).view(np.uint64), dtype=np.uint64)


_SENT = "bucket int, batch int, data binary"


def _sent(batch: int, buckets: np.ndarray, cuts: np.ndarray, payload) -> pa.Table:
    """Rows for the buckets that have something; ``cuts``: bounds of each bucket's elements."""
    found = [(int(b), batch, payload(cuts[b], cuts[b + 1])) for b in buckets if cuts[b + 1] > cuts[b]]
    return pa.table({"bucket": pa.array([f[0] for f in found], pa.int32()),
                     "batch": pa.array([f[1] for f in found], pa.int32()),
                     "data": pa.array([f[2] for f in found], pa.binary())})


def _hash_cuts(distinct: np.ndarray, buckets: int) -> np.ndarray:
    edges = np.array([(k << 64) // buckets for k in range(1, buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(distinct, edges), [len(distinct)]]).astype(np.int64)


def _send_hashes(buckets: int):
    def run(key, table):
        distinct, twice, _ = Batch(table).hashes()
        return _sent(key[0].as_py(), np.arange(buckets), _hash_cuts(distinct, buckets),
                     lambda a, b: _pack(_planes(distinct[a:b]), np.packbits(twice[a:b])))
    return run


def _shared_hashes(table):
    """For each batch, a bit per hash it sent: a second document has it too."""
    every, twice, sizes = [], [], []
    for data in table["data"].to_pylist():
        planes, bits = _unpack(data, np.uint8, np.uint8)
        every.append(_from_planes(planes))
        twice.append(np.unpackbits(bits, count=len(every[-1])).astype(bool))
        sizes.append(len(every[-1]))
    hashes, both = np.concatenate(every), np.concatenate(twice)
    _, number, count = np.unique(hashes, return_inverse=True, return_counts=True)
    shared = count > 1
    np.logical_or.at(shared, number, both)
    bits = np.split(shared[number], np.cumsum(sizes)[:-1])
    return pa.table({"bucket": table["bucket"], "batch": table["batch"],
                     "data": pa.array([_pack(np.packbits(b)) for b in bits], pa.binary())})


def _picked(batch: Batch, shared: pa.Table, buckets: int) -> np.ndarray:
    """Anchors whose hash two documents have."""
    distinct, _, number = batch.hashes()
    cuts, keep = _hash_cuts(distinct, buckets), np.zeros(len(distinct), bool)
    for bucket, data in zip(shared["bucket"].to_pylist(), shared["data"].to_pylist()):
        a, b = cuts[bucket], cuts[bucket + 1]
        keep[a:b] = np.unpackbits(_unpack(data, np.uint8)[0], count=b - a).astype(bool)
    return np.flatnonzero(keep[number])


class _Leads:
    """The leading bytes of ordered surroundings, for bisection."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows

    def __len__(self) -> int:
        return len(self.rows)

    def __getitem__(self, k: int) -> bytes:
        return self.rows[k, :LEAD].tobytes()


def _lead_cuts(rows: np.ndarray, splitters: list[bytes]) -> np.ndarray:
    leads = _Leads(rows)
    return np.array([0, *[bisect_left(leads, s) for s in splitters], len(rows)], np.int64)


def _send_surroundings(buckets: int, splitters: list[bytes]):
    def run(key, docs, shared):
        batch = Batch(docs)
        rows, ids, _ = batch.surroundings(_picked(batch, shared, buckets))
        cuts = _lead_cuts(rows, splitters)
        own, number = np.unique(ids, return_inverse=True)
        return _sent(key[0].as_py(), np.arange(len(cuts) - 1), cuts, lambda a, b: _pack(
            rows[a:b], own[(used := np.unique(number[a:b]))], np.searchsorted(used, number[a:b]).astype(np.uint32)))
    return run


def _first_documents(table):
    rows, ids, sizes = [], [], []
    for data in table["data"].to_pylist():
        own, known, number = _unpack(data, np.uint8, np.int64, np.uint32)
        rows.append(own.reshape(-1, FIELD + 2))
        ids.append(known[number])
        sizes.append(len(number))
    mask = first_seen(np.concatenate(rows), np.concatenate(ids))
    return pa.table({"bucket": table["bucket"], "batch": table["batch"], "data": pa.array(
        [_pack(m) for m in np.split(mask, np.cumsum(sizes)[:-1])], pa.binary())})


_CUT = "doc_id long, text_hash long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"


def _cut(buckets: int):
    import pyarrow.compute as pc

    def run(key, docs, answers):
        batch = Batch(docs)
        shared = answers.filter(pc.equal(answers["kind"], 0))
        masks = answers.filter(pc.equal(answers["kind"], 1)).sort_by("bucket")
        picked = _picked(batch, shared, buckets)
        rows, ids, group = batch.surroundings(picked)
        mask = np.concatenate([np.zeros(0, np.uint32), *[_unpack(d, np.uint32)[0] for d in masks["data"].to_pylist()]])
        # a later document of a surrounding repeats all its strings, the first one those in the mask
        bits = np.where(batch.ids[batch.owner[picked]] > ids[group], np.uint32(0xFFFFFFFF), mask[group]) if len(picked) else mask
        edges = np.zeros(len(batch.flat) + 1, np.int32)
        for offset in range(REACH + 1):
            some = picked[(bits >> np.uint32(offset)) & np.uint32(1) == 1]
            start = batch.place[some] - offset
            start = start[(start >= batch.first[some]) & (start <= batch.last[some])]
            edges += np.bincount(start, minlength=len(edges)).astype(np.int32)
            edges -= np.bincount(start + LENGTH, minlength=len(edges)).astype(np.int32)
        gone = np.cumsum(edges[:-1]) > 0
        n = len(batch.ids)
        out_ids, spans, kept = docs.sort_by([("doc_id", "ascending"), ("text", "ascending")]), [], []
        for k in range(n):
            a, b = int(batch.offsets[k]), int(batch.offsets[k + 1])
            own = gone[a:b]
            if not own.any():
                spans.append([])
                kept.append(batch.flat[a:b].tobytes())
                continue
            change = np.flatnonzero(np.diff(own.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
            spans.append([{"start": int(s), "end": int(e)} for s, e in change])
            kept.append(batch.flat[a:b][~own].tobytes())
        return pa.table({
            "doc_id": out_ids["doc_id"], "text_hash": out_ids["text_hash"], "n_bytes": pa.array(np.diff(batch.offsets), pa.int64()),
            "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            "kept": pa.array(kept, pa.binary())})
    return run


def remove_repeats(docs: DataFrame, batch_bytes: int = 4 << 20, most_buckets: int = 100_000, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_bytes``, ``spans`` removed (start and end byte, maximal) and ``kept`` bytes.

    A byte goes when it lies in a string of 50 bytes that also starts in a document of smaller
    id; matches never cross documents and all strings are judged on the input. Null texts are
    empty; texts shorter than a string stay whole. Null ids come before all others. Rows of
    one id do not count against each other. Other columns are not read; an empty table gives an
    empty one.

    A batch is about ``batch_bytes`` of texts; a longer text is a batch of its own size. Buckets
    of suffixes grow with the batches up to ``most_buckets``, which bounds the splitters that the
    driver holds.
    """
    spark = docs.sparkSession
    rows = pick(docs, id_col, text_col).select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(
        F.col(text_col), F.lit("")).alias("text"))
    total, count = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    batches = max(1, -(-total // batch_bytes))
    buckets = min(batches, most_buckets)
    # 64-bit remainders: the batch of an id is the same in every pass
    texts = rows.withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int"))
    sent = texts.groupBy("batch").applyInArrow(_send_hashes(buckets), _SENT)
    shared = stored(sent.groupBy("bucket").applyInArrow(_shared_hashes, _SENT), "shared")

    splitters = _splitters(texts, buckets, count)
    around = texts.groupBy("batch").cogroup(shared.groupBy("batch")).applyInArrow(_send_surroundings(buckets, splitters), _SENT)
    masks = stored(around.groupBy("bucket").applyInArrow(_first_documents, _SENT), "masks")

    answers = shared.withColumn("kind", F.lit(0)).union(masks.withColumn("kind", F.lit(1)))
    marked = texts.withColumn("text_hash", F.xxhash64("text"))
    cut = marked.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(_cut(buckets), _CUT)
    return cut.select(F.col("doc_id").alias(id_col), "n_bytes", "spans", "kept")


def _splitters(texts: DataFrame, buckets: int, count: int, per_bucket: int = 8, per_text: int = 4) -> list[bytes]:
    """Leading strings that cut the suffixes of a sample of texts into equal shares.

    The sample is about ``per_bucket`` texts for each bucket, drawn by a hash of the id where the
    texts lie; the ``per_text`` anchors of the smallest hashes of each give their leading bytes.
    What the driver gets is bounded by the number of buckets.
    """
    if buckets < 2:
        return []

    def leads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[bytes] = []
            for text in batch.column(0).to_pylist():
                own = Batch(pa.table({"doc_id": pa.array([0], pa.int64()), "text": [text]}))
                for at in own.place[np.argsort(own.hash)[:per_text]].tolist():
                    found.append(own.flat[at:at + LEAD].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["lead"])

    one_of = max(1, count // (buckets * per_bucket))
    some = texts.where(F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(one_of)) == 0).select("text")
    ordered = sorted({r[0] for r in some.mapInArrow(leads, "lead binary").collect()})
    ordered = [bytes(x) for x in ordered]
    return [ordered[k * len(ordered) // buckets] for k in range(1, buckets)] if len(ordered) >= buckets else ordered
