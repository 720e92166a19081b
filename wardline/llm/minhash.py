"""MinHash near-dedup of texts: banded minima propose, full shingle sets decide."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.base import pick, stored
from wardline.llm.components import components
from wardline.llm.segments import let_go, mixed, range_hashes, ragged, slices, word_bounds


@dataclass(frozen=True)
class Plan:
    """Shingle length, similarity in percent, bands of minima, and how many rows a task compares.

    With 40 bands of 6 a pair at a similarity of 0.8 is missed once in 190,000; signatures
    agree in less than ``least_match`` of their minima once in some ten million such pairs.
    """

    words: int = 5
    percent: int = 80
    bands: int = 40
    rows: int = 6
    least_match: float = 0.66
    block_docs: int = 1024
    block_shingles: int = 2_000_000
    seed: int = 5


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(ascending distinct shingle hashes end to end, offsets of the texts among them)."""
    flat, starts, ends, of_text = word_bounds(texts)
    own = range_hashes(flat, starts, ends)
    counts = np.diff(of_text)
    full = np.maximum(counts - words + 1, np.minimum(counts, 1))  # shingles with repeats
    first = of_text[:-1]
    text = np.repeat(np.arange(len(counts)), full)
    at = np.arange(int(full.sum())) - np.repeat(np.cumsum(full) - full, full) + first[text]
    size = np.minimum(counts, words)[text]
    padded = np.append(own, np.zeros(words, np.uint64))
    value = np.zeros(len(at), np.uint64)
    for k in range(words):
        part = padded[at + k] * np.uint64(2 * k + 1) + np.uint64(k)
        value = np.where(k < size, mixed(value ^ part), value)
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    value, text = value[new], text[new]
    return value, np.searchsorted(text, np.arange(len(counts) + 1))


def minima(values: np.ndarray, offsets: np.ndarray, count: int, seed: int) -> np.ndarray:
    """Least value of ``count`` universal hashes (a x + b) over each non-empty set."""
    draw = np.random.default_rng(seed)
    a = draw.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = draw.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2)
    out = np.empty((len(offsets) - 1, count), np.uint64)
    for k in range(count):
        out[:, k] = np.minimum.reduceat(values * a[k] + b[k], offsets[:-1])
    return out


_SIGNED = "doc_id long, n_shingles long, fp_a long, fp_b long, bands array<long>, signature binary"


def _signatures(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for i, j in slices(texts, 1 << 20):
                values, at = shingle_sets(texts.slice(i, j - i), plan.words)
                sizes = np.diff(at)
                some = np.flatnonzero(sizes)
                cuts = np.append(at[:-1][some], len(values))
                low = minima(values, cuts, plan.bands * plan.rows, plan.seed) if len(some) else np.zeros(
                    (0, plan.bands * plan.rows), np.uint64)
                keys = np.tile(np.arange(plan.bands, dtype=np.uint64), (len(some), 1))
                for r in range(plan.rows):
                    keys = mixed(keys ^ low[:, r::plan.rows], 1)
                prints = np.zeros((2, len(sizes)), np.uint64)
                for p in range(2):
                    if len(some):
                        prints[p, some] = np.add.reduceat(mixed(values, p + 2), cuts[:-1])
                row = np.full(len(sizes), -1)
                row[some] = np.arange(len(some))
                marks = mixed(low).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(i, j - i), pa.array(sizes, pa.int64()), pa.array(prints[0].view(np.int64)),
                    pa.array(prints[1].view(np.int64)),
                    pa.array([keys[r].view(np.int64) if r >= 0 else None for r in row], pa.list_(pa.int64())),
                    pa.array([marks[r].tobytes() if r >= 0 else None for r in row], pa.binary())],
                    names=["doc_id", "n_shingles", "fp_a", "fp_b", "bands", "signature"])
    return run


def _sets(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            texts = batch.column(0)
            for i, j in slices(texts, 1 << 20):
                values, at = shingle_sets(texts.slice(i, j - i), plan.words)
                prints = [np.array([mixed(values[a:b], p).sum(dtype=np.uint64) for a, b in zip(at, at[1:])],
                                   np.uint64).view(np.int64) for p in (2, 3)]
                same = (prints[0] == batch.column(1).slice(i, j - i).to_numpy()) & (
                    prints[1] == batch.column(2).slice(i, j - i).to_numpy())
                rows = np.flatnonzero(same)
                keep = pa.array(rows + i, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).take(keep) for c in range(3, batch.num_columns)],
                     pa.array([values[at[r]:at[r + 1]].tobytes() for r in rows], pa.binary())],
                    names=["rep", "cluster", "blocks", "signature", "shingles"])
    return run


def _links(plan: Plan):
    """Links that span each component of a block, or of what lies between two blocks."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("rep", ignore_index=True)
        reps, sides = frame["rep"].to_numpy(), frame["block"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in frame["shingles"]]
        sizes = np.array([len(s) for s in sets])
        offsets, values = np.append(0, np.cumsum(sizes)), np.concatenate(sets)
        marks = np.frombuffer(b"".join(frame["signature"]), np.uint8).reshape(len(frame), -1)
        crossing = len(np.unique(sides)) > 1
        found, open_rows = [], np.ones(len(frame), bool)
        for start in range(len(frame)):
            if not open_rows[start]:
                continue
            open_rows[start] = False
            stack = [start]
            while stack:
                q = stack.pop()
                others = np.flatnonzero(open_rows & (sides != sides[q]) if crossing else open_rows)
                low, high = np.minimum(sizes[others], sizes[q]), np.maximum(sizes[others], sizes[q])
                others = others[100 * low >= plan.percent * high]
                if len(others):
                    others = others[(marks[others] == marks[q]).mean(axis=1) >= plan.least_match]
                for k in range(0, len(others), 1024):
                    part = others[k:k + 1024]
                    flat, at = ragged(offsets, values, part)
                    place = np.minimum(np.searchsorted(sets[q], flat), sizes[q] - 1)
                    common = np.add.reduceat((sets[q][place] == flat).astype(np.int64), at[:-1])
                    linked = part[100 * common >= plan.percent * (sizes[part] + sizes[q] - common)]
                    open_rows[linked] = False
                    stack += linked.tolist()
                    found += [(reps[q], reps[y]) for y in linked]
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)
    return run


def near_duplicates(docs: DataFrame, plan: Plan = Plan(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_shingles``, ``component_id`` and ``kept`` (the smallest id of its component).

    Texts link when the Jaccard similarity of their sets of word shingles (A to Z lower-cased)
    is at least ``percent``. A text of fewer words is one shingle; null and empty texts, and rows
    of null id, link with nothing, and a row of null id is kept. Equal sets are compared once. Rows
    of one id share its component by their own text. Other columns are not read; an empty table
    gives an empty one.

    Candidates are gathered as stars around the smallest id of each band bucket, never as pairs. A
    set of candidates larger than a block is compared block against block.
    """
    rows = pick(docs, id_col, text_col).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = stored(rows.mapInArrow(_signatures(plan), _SIGNED), "signatures")
    linkable = signed.where("doc_id IS NOT NULL AND n_shingles > 0")
    # equal sets have equal fingerprints; the group of a hot text combines before the shuffle
    reps = stored(linkable.groupBy("fp_a", "fp_b").agg(F.min(F.struct("doc_id", "bands", "signature", "n_shingles")).alias(
        "r")).select("fp_a", "fp_b", F.col("r.doc_id").alias("rep"), "r.n_shingles", "r.bands", "r.signature"), "sets")

    keyed = reps.select("rep", F.explode("bands").alias("key"))
    heads = stored(keyed.groupBy("key").agg(F.min("rep").alias("head"), F.count("*").alias("n")).where("n > 1").drop("n"),
                   "buckets")
    stars = keyed.join(heads, "key").where("rep <> head").select("rep", "head").distinct()
    clusters = components(stars)
    weights = clusters.join(reps.select("rep", "n_shingles"), F.col("node") == F.col("rep")).groupBy("component").agg(
        F.greatest(F.ceil(F.count("*") / plan.block_docs), F.ceil(F.sum("n_shingles") / plan.block_shingles)).alias("blocks"))
    members = stored(clusters.join(weights, "component").join(reps, F.col("node") == F.col("rep")).select(
        F.col("fp_a").alias("_a"), F.col("fp_b").alias("_b"), "rep", F.col("component").alias("cluster"),
        F.col("blocks").cast("int").alias("blocks"), "signature"), "members")

    # a row of an equal id and another text has another fingerprint and is dropped after hashing
    texts = rows.join(members, F.col("doc_id") == F.col("rep")).select(
        "text", "_a", "_b", "rep", "cluster", "blocks", "signature")
    sets = texts.mapInArrow(
        _sets(plan), "rep long, cluster long, blocks int, signature binary, shingles binary")
    block = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    dealt = sets.withColumn("block", block).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tasks = dealt.withColumn("low", F.least("block", "_other")).withColumn("high", F.greatest("block", "_other"))
    links = tasks.drop("_other", "blocks").groupBy("cluster", "low", "high").applyInPandas(_links(plan), "a long, b long")
    joined = components(links)

    classes = reps.join(joined, F.col("rep") == F.col("node"), "left").select(
        F.col("fp_a").alias("_a"), F.col("fp_b").alias("_b"), F.coalesce("component", "rep").alias("component_id"))
    classes = stored(classes, "classes")
    told = linkable.join(classes, (F.col("fp_a") == F.col("_a")) & (F.col("fp_b") == F.col("_b"))).select(
        "doc_id", "n_shingles", "component_id")
    alone = signed.where("doc_id IS NULL OR n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return told.union(alone).select(F.col("doc_id").alias(id_col), "n_shingles", "component_id", F.coalesce(
        F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
