"""Repeats, near-duplicates, line windows, mixes and the pipeline against brute force."""

import hashlib
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardline.llm import embed_dedup, minhash, suffix_dedup
from wardline.llm.components import components
from wardline.llm.line_dedup import dedup_lines
from wardline.llm.minhash import near_duplicates
from wardline.llm.source_mix import mix_sources, one_period, plan, schedule, shares_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", f"s{k % 3}", len(t or "")) for k, (i, t) in enumerate(zip(ids, texts))], SCHEMA)


def prose(draw, n):
    return " ".join("".join(draw.choice("etaoinshrdlu") for _ in range(draw.randint(2, 9))) for _ in range(n))


class Groups(dict):
    def root(self, x):
        self.setdefault(x, x)
        while self[x] != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self[max(a, b)] = min(a, b)


def cut_by_force(docs):
    first, out = {}, {}
    for i, text in sorted(docs):
        data = text.encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 49):
            if first.setdefault(data[p:p + 50], i) < i:
                gone[p:p + 50] = b"\1" * 50
        spans = [m.span() for m in re.finditer(b"\1+", gone)]
        out[i, text] = (len(data), spans, bytes(c for c, g in zip(data, gone) if not g))
    return out


@pytest.mark.parametrize("batch_bytes", [4 << 20, 3000])
def test_suffix_dedup(spark, batch_bytes):
    draw = random.Random(4)
    passage, texts = prose(draw, 30), [None, "", "short", "é" * 60, "é" * 60, "ab" * 400, "ba" * 300, "a" * 49, "a" * 50, "a" * 51]
    for k in range(30):
        own = prose(draw, draw.randint(5, 80))
        texts += [own, own] if k % 9 == 0 else [own + passage[:draw.randint(40, len(passage))] + prose(draw, 4) + passage[50:]]
    ids = [*range(len(texts)), 3, 5, 5]
    texts += [texts[3], texts[5], "other text of an id " * 9]
    docs = frame(spark, texts, ids).withColumn("TEXT2", F.lit("x"))
    got = suffix_dedup.remove_repeats(docs, batch_bytes=batch_bytes).collect()
    want = cut_by_force([(i, t or "") for i, t in zip(ids, texts)])
    assert len(got) == len(texts)
    left = Counter((i, *map(str, want[i, t or ""])) for i, t in zip(ids, texts))
    assert left == Counter((r.doc_id, str(r.n_bytes), str([tuple(s) for s in r.spans]), str(bytes(r.kept))) for r in got)
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0
    alone = suffix_dedup.remove_repeats(frame(spark, [passage, passage], [None, 7])).orderBy("doc_id").collect()
    assert [len(r.kept) for r in alone] == [len(passage.encode()), 0]


def test_suffix_sort_compares_like_bytes():
    rows = np.random.default_rng(2).integers(0, 2, (500, 19)).astype(np.uint8)
    order, same = suffix_dedup.multikey_order(suffix_dedup.words_of(rows))
    text = [rows[k].tobytes() for k in order]
    assert text == sorted(text) and same.tolist() == [False, *[a == b for a, b in zip(text, text[1:])]]


def near_by_force(docs, words, percent=80):
    sets, groups = {}, Groups()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for i, text in docs:
        w = WORD.findall((text or "").translate(lower))
        sets[i] = {tuple(w[k:k + words]) for k in range(len(w) - words + 1)} or ({tuple(w)} if w else set())
        groups.root(i)
    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                groups.join(a, b)
    return {i: (len(sets[i]), groups.root(i), groups.root(i) == i) for i in sets}


@pytest.mark.parametrize("block_docs", [4096, 8])
def test_minhash(spark, block_docs):
    draw = random.Random(9)
    texts = [None, "", " \n", "One two", "one TWO", "É one", "é one", "a b c d", "x"]
    base = prose(draw, 60).split()
    for k in range(45):
        near = list(base)
        for _ in range(draw.randint(0, 3)):
            near[draw.randrange(len(near))] = f"w{k}"
        texts.append(" ".join(near))
    texts += [prose(draw, 40) for _ in range(12)]
    texts += texts[-3:]
    docs = frame(spark, texts).withColumn("Doc_Id2", F.lit(1))
    plan = minhash.Plan(words=4, block_docs=block_docs)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs, plan).collect()}
    assert got == near_by_force(list(enumerate(texts)), 4)
    assert minhash.near_duplicates(docs.limit(0)).count() == 0
    repeated = minhash.near_duplicates(frame(spark, ["p q r s t u", "p q r s t u", "p q r s t u", "other"], [None, 4, 4, 4])).collect()
    assert Counter((r.doc_id, r.component_id, r.kept) for r in repeated) == {(None, None, True): 1, (4, 4, True): 3}


def test_components_of_paths_and_stars(spark):
    links = [(i + 1, i) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (300, 301), (301, 300), (None, 2)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(41)} | {100: 100} | {k: 100 for k in range(101, 160)} | {300: 300, 301: 300}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("block_rows", [4096, 16])
def test_embedding_links(spark, block_rows):
    draw = np.random.default_rng(3)
    base = draw.normal(size=(30, 8))
    vectors = [*base, *(base[:10] + draw.normal(size=(10, 8)) * 0.12), *(base[0] + draw.normal(size=(25, 8)) * 0.15), base[3], base[3] * 2]
    rows = [(i, [float(x) for x in v], i % 2 if i < 40 else 0) for i, v in enumerate(vectors)]
    n = len(rows)
    rows += [(n, None, 0), (n + 1, [0.0] * 8, 0), (n + 2, [float("nan")] * 8, 0), (n + 3, [1.0, None], 0), (n + 4, rows[0][1], None),
             (n + 5, rows[0][1][:4], 0), (n + 6, [float("inf")] * 8, 0), (n + 7, [], 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept)
           for r in embed_dedup.link_embeddings(table.withColumn("Label2", F.lit(1)), block_rows=block_rows).collect()}
    links, groups = Counter(), Groups()
    for i, a, la in rows[:n]:
        for j, b, lb in rows[:n]:
            if i < j and la == lb and np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b) >= 0.98:
                links[i] += 1
                links[j] += 1
                groups.join(i, j)
    assert sum(links.values()) > 60
    assert got == {r[0]: (links[r[0]], groups.root(r[0]), groups.root(r[0]) == r[0]) for r in rows}
    assert embed_dedup.link_embeddings(table.limit(0)).count() == 0


def test_code_estimates_are_unbiased_and_bounded():
    draw = np.random.default_rng(5)
    unit = draw.normal(size=(400, 64))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    turned, packed, factor = embed_dedup.encode(unit, embed_dedup.rotation(64))
    codes = np.unpackbits(packed, axis=1, count=64) * 2.0 - 1
    estimate, true = turned @ codes.T / 8 / factor, unit @ unit.T
    apart = ~np.eye(400, dtype=bool)
    assert abs((estimate - true)[apart].mean()) < 2e-3
    for threshold in (0.3, 0.5):  # none above a threshold is estimated below it by more than the certain bound
        slack = embed_dedup.bounds(factor, threshold, 64, None)
        assert (estimate >= threshold - slack - 1e-9)[true >= threshold].all()


def lines_by_force(docs):
    first, out = {}, []
    windows = {}
    for i, text in docs:
        lines = (text or "").split("\n")
        windows[i, text] = [(k, tuple(lines[k:k + 3])) for k in range(len(lines) - 2) if WORD.search("".join(lines[k:k + 3]))]
    key = lambda i: (i is not None, i or 0)
    for (i, text), own in windows.items():
        for k, w in own:
            first[w] = min(first.get(w, ((True, 1 << 60), 0)), (key(i), k))
    for i, text in docs:
        gone = {k + d for k, w in windows[i, text] if (key(i), k) > first[w] for d in range(3)}
        kept = None if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone)
        out.append((i, kept, len(gone)))
    return Counter(out)


def test_line_dedup(spark):
    draw = random.Random(6)
    block = [prose(draw, 4) for _ in range(6)]
    texts = [None, "", "one", "a\nb", "\n\n\n\n", "\n\n\n\n", "r\nr\nr\nr\nr", "\n".join(block), "\n".join(block), "\n".join(block[:4] + ["x"] + block[3:])]
    texts += ["\n".join(prose(draw, 2) if draw.random() < 0.3 else draw.choice(block) for _ in range(9)) for _ in range(20)]
    ids = [*range(len(texts)), 7, 9, None]
    texts += [texts[7], "y\n" + texts[7], texts[7]]
    docs = frame(spark, texts, ids).withColumn("N_Removed", F.lit("x"))
    got = dedup_lines(docs, removed_col="n_removed")
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_removed"]
    assert Counter((r.doc_id, r.text, r.n_removed) for r in got.collect()) == lines_by_force(list(zip(ids, texts)))
    assert dedup_lines(docs.limit(0)).count() == 0 and dedup_lines(docs).columns == docs.columns


def test_pfair_deviation_is_below_one_block():
    draw = random.Random(8)
    for _ in range(20):
        weights = {s: draw.choice([1, 1, 2, 5, 40]) for s in range(draw.randint(1, 12))}
        shares = shares_of(weights)
        slots, done = one_period(shares), Counter()
        owner = {t: s for s, own in slots.items() for t in own}
        assert len(owner) == sum(shares.values())
        for t in range(len(owner)):
            done[owner[t]] += 1
            assert all(abs(done[s] * len(owner) - shares[s] * (t + 1)) < len(owner) for s in shares)
        blocks = {s: draw.randint(0, 3000) for s in weights}
        assert sum(sum(p.last[s] - p.first[s] for s in p.first) for p in plan(blocks, weights)) == sum(blocks.values())


def test_mix_follows_exact_weights_over_many_slots():
    """Whole, decimal and uneven weights, and sources that run out, against the fluid mix."""
    cases = [([4000] * 3, [1] * 3), ([500] * 20, [1] * 20), ([30000, 30], [0.999, 0.001]),
             ([9000, 700, 2500, 1, 40], [0.3, 0.1, 5, 1, 0.017])]
    for blocks, weights in cases:
        exact, left = [Fraction(str(w)) for w in weights], [Fraction(b) for b in blocks]
        done, fluid = [0] * len(blocks), [Fraction(0)] * len(blocks)
        for s, j in schedule(dict(enumerate(blocks)), dict(enumerate(weights))):
            assert j == done[s]
            done[s] += 1
            time = Fraction(1)
            while time and any(left):
                total = sum(w for w, x in zip(exact, left) if x)
                step = min(time, *[x * total / w for w, x in zip(exact, left) if x])
                for q in range(len(blocks)):
                    if left[q]:
                        fluid[q] += step * exact[q] / total
                        left[q] = blocks[q] - fluid[q]
                time -= step
            assert all(abs(d - f) < 1 for d, f in zip(done, fluid))
        assert done == blocks


def test_source_mix_has_exact_weights(spark):
    docs = spark.range(9000).selectExpr("id AS doc_id", "concat('s', id % 3) AS source")
    got = mix_sources(docs, block_rows=1).select("position", "source").collect()
    done = Counter()
    for t, r in enumerate(sorted(got)):
        assert r.position == t
        done[r.source] += 1
        assert all(abs(3 * done[f"s{q}"] - t - 1) < 3 for q in range(3))


def test_every_source_has_its_own_share(spark):
    docs = spark.range(400 * 20).selectExpr("id AS doc_id", "concat('s', id % 400) AS source")
    docs = docs.union(spark.range(15).selectExpr("id AS doc_id", "'heavy' AS source"))
    got = mix_sources(docs, {"heavy": 100}, block_rows=1).select("position", "source").collect()
    first = [r.source for r in sorted(got)][:75]
    assert sum(s == "heavy" for s in first) == 15
    done = Counter()
    for r in [r for r in sorted(got) if r.source != "heavy"]:
        done[r.source] += 1
        assert max(done.values()) - min(done.values() if len(done) == 400 else [0]) <= 2


def test_source_mix(spark):
    ids = list(range(5000))
    rows = [(i, f"t{i}", "en", None if i % 50 == 0 else "big" if i % 3 else f"s{i % 4}", 1) for i in ids] + [(None, "n", "en", "s1", 1)] * 2
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("Position", F.lit("x"))
    got = mix_sources(docs, {"big": 3.0, "s0": 1.0}, block_rows=16)
    assert got.columns == [*docs.columns[:-1], "block", "phase", "position", "place"]
    rows_out = got.collect()
    assert Counter((r.doc_id, r.source) for r in rows_out) == Counter((r[0], r[3]) for r in rows)
    blocks = {}
    for r in rows_out:
        blocks.setdefault(r.position, []).append(r)
    assert sorted(blocks) == list(range(len(blocks)))
    assert all(len({r.source for r in b}) == 1 and sorted(r.place for r in b) == list(range(len(b))) for b in blocks.values())
    last = {s: max(r.position for r in rows_out if r.source == s) for s in {r.source for r in rows_out}}
    assert all(len(b) == 16 or p == last[b[0].source] for p, b in blocks.items())
    weights, done = {"big": 3, "s0": 1, "s1": 1, "s2": 1, "s3": 1, None: 1}, Counter()
    for t in range(min(last.values()) + 1):
        done[blocks[t][0].source] += 1
        assert all(abs(done[s] - (t + 1) * w / 8) < 1.1 for s, w in weights.items())
    assert mix_sources(docs.limit(0)).count() == 0
    many = spark.createDataFrame([(i, f"s{i % 400}") for i in range(2000)], "doc_id long, source string")
    assert mix_sources(many).count() == 2000


def test_pipeline_stages_against_brute_force(spark):
    import corpus_pipeline
    from wardline.session import cut_lineage

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        docs = cut_lineage(stage(spark, docs, folder))
        seen.append(name)
        if "ids" in docs.columns:
            break
        assert docs.columns == corpus_pipeline.COLUMNS
        after = [(r.doc_id, r.text) for r in docs.collect()]
        if name == "quality classifier":
            kept = {i for i, _ in after}
            good = [i for i, q in labels.items() if q == 1]
            assert set(after) <= set(before) and sum(i in kept for i in good) >= 0.98 * len(good)
        elif name == "line dedup":
            whole = dict(before)
            want = {(i, t) for i, t, _ in lines_by_force(before) if t or not whole[i]}
            assert set(after) == want
        elif name == "MinHash near-dedup":
            assert {i for i, _ in after} == {i for i, x in near_by_force(before, 5).items() if x[2]}
        else:
            assert sorted(after) == sorted(before)
    assert len(seen) == 5
    final = docs.collect()
    assert sorted(r.doc_id for r in final) == sorted(i for i, _ in before)
    assert all(r.lossless and r.n_tokens == len(r.ids) for r in final)


def test_mixed_order_reaches_the_result_of_the_pipeline(spark):
    import corpus_pipeline
    from wardline.session import cut_lineage

    rows = [(i, f"text number {i}", "en", "big" if i % 4 else f"s{i % 3}", 9) for i in range(6000)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    mixed = cut_lineage(corpus_pipeline.mix(spark, docs, ""))
    final = corpus_pipeline.encode(spark, mixed, "").select("position", "doc_id", "source").collect()
    order = [r.source for r in sorted(final)]
    assert [r.position for r in sorted(final)] == list(range(6000))
    place = {r.doc_id: (r.position, r.place) for r in mix_sources(docs).collect()}
    assert [r.doc_id for r in sorted(final)] == sorted(place, key=place.get)
    done, end = Counter(), min(max(k for k, x in enumerate(order) if x == s) for s in set(order))
    for t, s in enumerate(order[:end]):
        done[s] += 1
        assert all(abs(done[x] - (t + 1) / 4) < 2 * 64 for x in set(order))
    run = corpus_pipeline.run(spark, "/root/testdata/sf0.001").select("position").collect()
    assert sorted(r.position for r in run) == list(range(len(run)))


def test_sql_of_queries(spark):
    from conformance import connect, rows_of
    from wardline.llm import queries

    con = connect("/root/testdata/sf0.001")
    for name, sql in queries.ORACLES.items():
        ours, theirs = queries.QUERIES[name](spark, "/root/testdata/sf0.001").toPandas(), con.execute(sql).df()
        assert rows_of(ours) == rows_of(theirs), name


def test_query_digests_by_force(spark):
    from wardline.llm import queries

    folder = "/root/testdata/sf0.001"
    texts = {r[0]: r[1] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    want = cut_by_force(list(texts.items()))
    for r in queries.QUERIES["op1_suffix_dedup"](spark, folder).collect():
        n, spans, kept = want[r.doc_id, texts[r.doc_id]]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (n, n - len(kept), len(spans))
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()
    near = near_by_force(list(texts.items()), 4)
    got = queries.QUERIES["op9_minhash"](spark, folder).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == near


def test_partitions_without_a_word_pass_every_text_operator(spark):
    """Fresh workers whose first texts are all null or empty, as in a null-only partition."""
    import public_tokenizers

    from wardline.llm import segments
    from wardline.llm.byte_bpe import encode_decode

    segments.let_go()
    assert segments.prefix_sums(np.zeros(0, np.uint8)).tolist() == [0]
    docs = spark.createDataFrame([(i, None if i % 2 else "", "en", "s", 0) for i in range(8)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    assert [tuple(r) for r in near_duplicates(docs).orderBy("doc_id").collect()] == [(i, 0, i, True) for i in range(8)]
    coded = encode_decode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    assert {(len(r.ids), bytes(r.decoded)) for r in coded.collect()} == {(0, b"")}


def test_memo_keeps_what_recurs_within_its_bounds():
    from wardline.llm.segments import Memo, utf8_bytes

    import pyarrow as pa

    seen = []

    def encode(parts):
        seen.extend(parts)
        return np.concatenate([np.frombuffer(p, np.uint8).astype(np.int32) for p in parts]), np.array([len(p) for p in parts])

    memo = Memo(encode, most=50, most_bytes=4000)
    for k in range(200):
        text = f"often met {k} a{k} b{k} c{k}"
        values, at = memo(*utf8_bytes(pa.array([text, None, ""])))
        assert bytes(values.astype(np.uint8)) == text.encode() and at.tolist() == [0, len(text), len(text), len(text)]
        assert len(memo.keys) <= 60
    assert seen.count(b" met") < 5


def test_lines_of_a_long_text_take_linear_work(spark):
    """40,000 lines of which most go; a quadratic search took 13 s here."""
    import time

    lines = [f"line {i} of the first text" for i in range(40_000)]
    docs = spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join(["own start", *lines[:-1], "own end"]))], "doc_id long, text string")
    dedup_lines(docs.limit(1), removed_col="n").collect()
    start = time.monotonic()
    got = {r.doc_id: r for r in dedup_lines(docs, removed_col="n").collect()}
    assert time.monotonic() - start < 10
    assert (got[1].n, got[2].n, got[2].text) == (0, 39_999, "own start\nown end")


def test_cosines_of_very_large_and_small_components(spark):
    for size in (1e200, 1e-200, 1.0):
        rows = [(1, [size, 0.0], 3), (2, [size * 2, 1e-3 * size], 3), (3, [0.0, size], 3)]
        got = embed_dedup.link_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
        assert {r.vec_id: (r.n_links, r.component_id) for r in got.collect()} == {1: (1, 1), 2: (1, 1), 3: (0, 3)}


def test_weights_must_be_positive(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, source string")
    for weight in (0, -1, float("nan"), float("inf")):
        with pytest.raises(ValueError):
            mix_sources(docs, {"a": weight})


def test_stages_take_a_table_with_clashing_columns(spark, tmp_path):
    """A TEXT column, repeated rows, and texts that are null or empty pass every stage."""
    import corpus_pipeline as pipeline

    rows = [(i, None if i % 7 == 0 else "" if i % 7 == 1 else f"words of text {i % 5} " * 9 + f"\nand {i}", "en", f"s{i % 2}", 9) for i in range(21)]
    docs = spark.createDataFrame(rows + rows[:3], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumn("TEXT_", F.lit("other")).toDF("doc_id", "text", "lang", "source", "n_chars", "TEXT")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(21)], "doc_id int, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for _, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == pipeline.COLUMNS and out.count() <= 24
    # the last stage reads files, in which names cannot clash
    docs.toDF(*pipeline.COLUMNS, "other").write.parquet(str(tmp_path / "in"))
    out = pipeline.encode(spark, spark.read.parquet(str(tmp_path / "in")), str(tmp_path))
    assert out.where("lossless").count() == out.count() == 24
