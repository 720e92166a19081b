"""Whitening, language-model scoring and cross-tokenizer alignment against plain versions."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from wardline.llm import cross_align, lm_score, queries, whitening
from wardline.llm.cross_align import PairIndex, align_documents, build, count_pairs, pair_table
from wardline.llm.whitening import components_of, whiten


@pytest.mark.parametrize("size", [1, 2, 3, 17, 64])
def test_components_are_eigenvectors(size):
    draw = np.random.default_rng(size)
    rows = draw.normal(size=(200, size)) * draw.uniform(0.01, 3, size)
    for matrix in (rows.T @ rows / 200, np.eye(size) * 3, np.ones((size, size)), np.diag(np.arange(size) // 3 * 1.0)):
        values, vectors = components_of(matrix, 16)
        known = np.linalg.eigvalsh(matrix)[::-1][:16]
        scale = max(np.abs(known).max(), 1e-300)
        assert np.abs(values - known).max() <= 1e-13 * scale
        assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
        assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-12 * scale


def plain_whitening(rows):
    kept = [(i, np.floor(64 * np.array(v, np.float64)).astype(np.int64) + 1_000_000) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x.tolist()) for _, x in kept}))
    n, sums = len(fit), fit.sum(axis=0)
    values, axes = np.linalg.eigh(np.cov(fit.T, bias=True))
    values, axes = values[::-1][:16], axes[:, ::-1][:, :16]
    out = {}
    for i, x in kept:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x.tolist(), sums.tolist()))
        out.setdefault(i, []).append((n, deviation, ((x - sums / n) @ axes) / np.sqrt(values)))
    return out, values / np.cov(fit.T, bias=True).trace()


@pytest.mark.parametrize("odd", [False, True])
def test_whitening_of_embeddings(spark, odd):
    frame = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    if odd:
        vectors = [(i, [float(x) for x in np.random.default_rng(i % 40).normal(size=5) * [1, 2, 3, 4, 5]]) for i in range(60)]
        vectors += [(None, vectors[3][1]), (7, vectors[9][1]), (90, None), (91, [1.0, None, 1.0, 1.0, 1.0]), (92, [math.nan] * 5),
                    (93, [math.inf, 0.0, 0.0, 0.0, 0.0])]
        frame = spark.createDataFrame([(i, v, "x") for i, v in vectors], "vec_id long, embedding array<double>, Embedding_2 string")
        frame = frame.withColumn("N", F.lit(1)).withColumn("VEC", F.lit(1))
        got = whiten(frame).collect()
    else:
        got = queries.QUERIES["op13_whitening"](spark, "/root/testdata/sf0.001").collect()
    known, explained = plain_whitening([(r[0], r[1]) for r in frame.collect()])
    k = min(16, len(explained))
    assert len(got) == k * sum(map(len, known.values()))
    assert {r.component for r in got} == set(range(1, k + 1)) and max(r.identity_error for r in got) < 1e-8
    sign = {}
    for r in got:
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9
        fits = [x for x in known[r.vec_id] if x[0] == r.n and x[1] == r.deviation]
        assert fits and any(abs(abs(r.whitened) - abs(x[2][r.component - 1])) < 1e-6 for x in fits)
        if len(fits) == 1 and abs(r.whitened) > 1e-3:
            same = r.whitened * fits[0][2][r.component - 1] > 0
            assert sign.setdefault(r.component, same) == same


def test_whitening_of_odd_tables(spark):
    kind = "vec_id long, embedding array<float>"
    assert whiten(spark.createDataFrame([], kind)).count() == 0
    assert whiten(spark.createDataFrame([(1, None), (2, []), (3, [math.nan])], kind)).count() == 0
    assert whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3, kind)).count() == 0  # one distinct vector varies in nothing
    mixed = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 1.0]), (3, [5.0]), (4, [6.0]), (5, [6.0])], kind)
    got = {(r.vec_id, r.component): (r.n, round(abs(r.whitened), 9)) for r in whiten(mixed).collect()}
    assert got == {(1, 1): (2, 1.0), (2, 1): (2, 1.0), (3, 1): (2, 1.0), (4, 1): (2, 1.0), (5, 1): (2, 1.0)}
    far = spark.createDataFrame([(1, [0.0]), (2, [1e13])], "vec_id long, embedding array<double>")
    assert {r.deviation for r in whiten(far).collect()} == {None}
    assert whitening.LEAST_SHARE < 1e-9


A_FILE, B_FILE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", None, " ", "   ", "x ", " lead", "a  b   c\n\n d\t e", "one\n two \n three", "Straße İstanbul <|endoftext|> <s> </s> <unk> <0x41>",
       "你好世界 한글 😀😀 \u00a0 x\u3000 y", "has \u2581 inside", "\u2581", "a\x00b \x7f \x0b z", "12345 67,890 it's we'll", "z" * 4000,
       "word " * 3000, "the cat the cat", "the cat", "the cat", "\r\n \r\n", "e\u0301 \u0085 q", "\ufeffbom \ufffd"]


def plain_alignment(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A_FILE), sentencepiece.SentencePieceProcessor(model_file=B_FILE)
    a.encode_special_tokens = True
    letter = cross_align._letters()
    out, holders = [], Counter()
    for text in texts:
        if not text:
            out.append(([], [], []))
            continue
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        ends = []
        for parts in ([bytes(letter[c] for c in a.id_to_token(i)) for i in x],
                      [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("\u2581", " ").encode()
                       for i in y]):
            if b"".join(parts) != (" " + text).encode():
                ends = None
                break
            at, own = 0, []
            for p in parts:
                at += len(p)
                own.append(at)
            ends.append(own)
        if ends is None:
            out.append(([], [], []))
            continue
        groups, i, j = [], 0, 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            m, k = i, j
            while m < len(x) and ends[0][m] <= cut:
                m += 1
            while k < len(y) and ends[1][k] <= cut:
                k += 1
            groups.append((x[i:m], y[j:k]))
            i, j = m, k
        links = [(p, q) for g in groups for p in g[0] for q in g[1]]
        holders.update(set(links))
        out.append((x, y, groups, links))
    best = {}
    for (p, _), n in holders.items():
        best[p] = max(best.get(p, 0), n)
    rows = []
    for own in out:
        if not own[0]:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        x, y, groups, links = own
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        rows.append((len(x), len(y), len(groups), len(links), sum(holders[k] == best[k[0]] for k in links),
                     sum(holders[k] for k in links), text))
    return rows, holders


@pytest.mark.parametrize("block", [4_000_000, 40])
def test_alignment_of_odd_texts(spark, block, monkeypatch):
    monkeypatch.setattr(cross_align, "BUCKET_KEYS", 16)
    texts = ODD + ["the cat"]
    docs = spark.createDataFrame([(i if i != 3 else None, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs = docs.withColumn("Groups", F.lit("x")).withColumn("_a", F.lit(1)).repartition(3)
    rows, holders = plain_alignment(texts)
    got = align_documents(docs, A_FILE, B_FILE, block_pairs=block).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, *tuple(r)[1:]) for r in got) == sorted(
        (i == 3, i if i != 3 else 0, *r) for i, r in enumerate(rows))
    if block == 40:
        counted = count_pairs(docs.select("text"), A_FILE, B_FILE, block)
        assert len(counted.blocks) > 1
        assert {(r.a, r.b): r.documents for r in pair_table(counted).collect()} == dict(holders)


def test_alignment_of_empty_tables(spark):
    assert align_documents(spark.createDataFrame([], "doc_id long, text string"), A_FILE, B_FILE).count() == 0
    none = spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string")
    assert {tuple(r)[1:] for r in align_documents(none, A_FILE, B_FILE).collect()} == {(0, 0, 0, 0, 0, 0, "")}


def test_alignment_query_on_documents(spark):
    folder = "/root/testdata/sf0.001"
    texts = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    rows, _ = plain_alignment([r.text for r in texts])
    got = {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op11_cross_align"](spark, folder).collect()}
    for doc, row in zip(texts, rows, strict=True):
        assert got[doc.doc_id] == (*row[:6], hashlib.sha256(row[6].encode()).hexdigest() if row[6] else "")


def test_perfect_hash_is_minimal_and_verified():
    draw = np.random.default_rng(2)
    keys = np.unique(draw.integers(0, 1 << 50, 20_000))
    buckets = 7
    own = cross_align.bucket_of(keys, buckets)
    rows = []
    for k in range(buckets):
        sizes, words, ordered = build(keys[own == k])
        rows.append({"bucket": k, "sizes": sizes, "words": words.tobytes(), "keys": ordered.astype("<i8").tobytes()})
    index = PairIndex.of(rows[1:6], buckets, 1, 6)
    found = index.find(keys)
    inside = (own >= 1) & (own < 6)
    assert (found[~inside] == -1).all() and sorted(found[inside]) == list(range(int(inside.sum())))
    assert (index.find(keys[inside] + 1)[~np.isin(keys[inside] + 1, keys)] == -1).all()
    with pytest.raises(ValueError):
        build(np.array([5, 5]))


def plain_tokens(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


def plain_scores(rows, learned):
    counts = Counter(t for i, text in rows if learned(i) for t in plain_tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for i, text in rows:
        own = plain_tokens(text)
        base = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in own)
        out.append((i, not learned(i), len(own), sum(counts[t] > 0 for t in own), total, base))
    return out


def not_tenth(i):
    return i is not None and zlib.crc32(str(i).encode()) % 10 != 0


@pytest.mark.parametrize("frequent", [1 << 18, 3000])
def test_lm_scores_of_documents(spark, frequent, monkeypatch):
    monkeypatch.setattr(lm_score, "FREQUENT", frequent)  # with few of them most words get their counts by the join
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    known = {r[0]: r for r in plain_scores(rows, not_tenth)}
    got = queries.QUERIES["op12_lm_score"](spark, folder).collect()
    assert len(got) == len(known)
    for r in got:
        assert tuple(r)[:5] == known[r.doc_id][:5] and abs(r.base_score - known[r.doc_id][5]) < 1e-9 * max(1, abs(r.base_score))
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > 0.995 * sum(r.base_score for r in held)  # a greater log: better than the unigram
    assert all(r.score < 0 for r in got)


def test_lm_scores_of_odd_rows(spark):
    texts = [None, "", "  \n\t ", "One one ONE", "one two", "\u00a0 \u0130 i", "é É", "x" * 50_000, "w " * 30_000, "one two", "two\x0bthree"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "one two"), (3, "other text"), (3, "One one ONE")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, TEXT string, N_tokens int").withColumn("score", F.lit(1)).repartition(2)
    for learned, use in ((not_tenth, F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 != 0, F.lit(False))),
                         (lambda i: False, F.lit(False))):
        model, others = lm_score.fit(docs, use, text_col="TEXT")
        got = lm_score.score(docs, model, others, text_col="TEXT").collect()
        order = lambda r: (r[0] is None, r[0] or 0, *r[1:4], round(r[4], 6))
        assert [order(x) for x in sorted((tuple(r)[:5] for r in got), key=order)] == [
            order(x) for x in sorted(((a, *x) for a, _, *x in plain_scores(rows, learned)), key=order)]
        if not learned(1):
            assert all(abs(r.score) < 1e-6 * r.n_tokens and r.base_score == 0 for r in got)
    empty = docs.limit(0)
    assert lm_score.score(empty, *lm_score.fit(empty, F.lit(True), text_col="TEXT"), text_col="TEXT").count() == 0


def test_lm_is_normalised_and_learns():
    """Probabilities after any context add up to 1 over all words; a fixed order of words is learned."""
    words = [f"w{i % 7}" for i in range(4000)]
    hashes = np.arange(7, dtype=np.uint64)
    count = np.array(sorted(Counter(words).values(), reverse=True), np.int64)
    counts = lm_score.Counts(4001, 8, hashes, count, np.arange(7), 1)
    model = lm_score.Model.fresh(counts)
    out, contexts = model.tokens(np.array([i % 7 for i in range(4000)]), np.array([0, 4000]))
    assert (contexts[:, 0] == 1).all() and contexts[0, 5] == out[4] and contexts[2, 5] == out[2] and out[-1] == 1
    before = model.log10(out, contexts).sum()
    assert abs(before - sum(np.append(counts.base(count)[np.arange(4000) % 7], counts.base(1)))) < 0.02 * abs(before)
    trainer = lm_score.Trainer(model, 1)
    for _ in range(20):
        trainer.learn(out, contexts)
    assert model.log10(out, contexts).sum() > 0.3 * before
    some = contexts[:, [0, 1, 50]]
    for k in range(3):
        every = model.log10(np.arange(lm_score.OUTPUTS), np.repeat(some[:, k:k + 1], lm_score.OUTPUTS, axis=1))
        assert abs((10.0 ** every).sum() - 1) < 1e-5
    # the words that share output 0 divide its probability: seen ones by their counts, the last share is for new ones
    assert abs(sum(10 ** counts.base(count)) + 10 ** counts.base(1) + 10 ** counts.base(0) - 1) < 1e-12
    assert abs(10 ** model.rare - 10 ** counts.base(0)) < 1e-9


def test_scoring_gives_memory_back_when_it_ends(monkeypatch):
    """Batches stay Arrow arrays, and the worker frees what they took after the last one too."""
    import pyarrow as pa

    from wardline.llm import byte_cnn

    freed = []
    monkeypatch.setattr(byte_cnn, "let_go", lambda: freed.append(1))
    net, texts = byte_cnn.ByteNet.fresh(), ["some text", None, "", "more " * 300]
    found = list(byte_cnn._scores(net, iter([pa.array(texts), pa.array([], pa.string())])))
    assert [len(x) for x in found] == [4, 0] and all(isinstance(x, pa.Array) for x in found)
    assert found[0].to_pylist() == pytest.approx([float(byte_cnn._scores(net, iter([pa.array([t], pa.string())])).__next__()[0].as_py()) for t in texts])
    freed.clear()
    list(byte_cnn._scores(None, iter([pa.array(texts)])))
    assert len(freed) == 2
