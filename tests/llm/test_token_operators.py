"""Token files and byte-level BPE against the libraries; url rules and quality models."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wardline.llm import byte_cnn, quality_rules, queries
from wardline.llm.byte_bpe import encode_decode, read_ranks
from wardline.llm.token_files import BLOCK_IDS, pack, read_tokens, token_table, unpack, write_tokens
from wardline.llm.url_filter import judge_urls

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD_FILE, RANKS = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = ["", None, "   ", "Ab c's  WE'LL 12,5 \n\n x\ty", "Straße İstanbul ΣΣ <|endoftext|> café", "你好世界 한글 😀😀",
       "a\x1cb \u00a0 c\u3000d\u2003\u2003e\u0085f", "z" * 3000 + " " + "ab" * 700, "a\x00b \x7f", "é\u0301 e\u0301 \u0301"]


def rows_of(spark, texts, extra=None):
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + (extra or []), SCHEMA)


def test_token_files_round_trip(spark, tmp_path):
    library = Tokenizer.from_file(WORD_FILE)
    docs = rows_of(spark, ODD, [(2, "twice", "en", "s", 5), (2, "again", "en", "s", 5), (None, "no id", "en", "s", 5)])
    got = token_table(docs.withColumn("TEXT2", F.lit(1)), WORD_FILE).orderBy("start").collect()
    order = sorted(docs.collect(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start = 0
    for row, doc in zip(got, order, strict=True):
        ids = library.encode(doc[1] or "", add_special_tokens=False).ids + [1]
        assert (row.doc_id, row.start, row.n_tokens) == (doc[0], start, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    write_tokens(docs.limit(0), str(tmp_path / "none"), WORD_FILE)
    assert read_tokens(spark, str(tmp_path / "none")).count() == 0


def test_planes_of_blocks():
    ids = np.random.default_rng(1).integers(0, 1 << 32, 2 * BLOCK_IDS + 17, dtype=np.uint32)
    index, payload = pack(ids)
    assert (unpack(index, payload, len(ids)) == ids).all()
    assert (unpack(index, payload, len(ids), BLOCK_IDS - 3, 10) == ids[BLOCK_IDS - 3:BLOCK_IDS + 7]).all()
    assert len(unpack(*pack(ids[:0]), 0)) == 0


def test_byte_bpe_is_the_library(spark):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})
    docs = rows_of(spark, ODD, [(0, "", "en", "s", 0), (None, "no id", "en", "s", 5)]).withColumn("IDS", F.lit(1))
    got = encode_decode(docs, RANKS, public_tokenizers.PATTERN, extra=("lang",)).collect()
    for row, doc in zip(got, docs.collect(), strict=True):
        assert list(row.ids) == library.encode_ordinary(doc[1] or "")
        assert bytes(row.decoded) == (doc[1] or "").encode()
    assert encode_decode(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_byte_bpe_query_on_documents(spark):
    folder = "/root/testdata/sf0.001"
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})
    texts = {r[0]: r[1] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    for row in queries.QUERIES["op8_byte_bpe"](spark, folder).collect():
        ids = library.encode_ordinary(texts.pop(row.doc_id))
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode_bytes(ids)).hexdigest()
    assert not texts


def test_url_rules(spark):
    urls = [None, "", "no scheme", "http://COM/x", "https://a.example.com/en/1", "https://www.example.com/en/",
            "https://x.www.example.com/en/a?b", "https://example.com/en", "https://example.com", "http://q.net/es/x",
            "http://net/fr/?x", "http://notnet/fr/", "http://example.com/a://b.net/fr/", "x://h?p/q", "http://a.COM#/y"]
    frame = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)] + [(0, "http://q.net/es/", "y")],
                                  "page_id int, url string, Host string")
    got = judge_urls(frame, queries.URL_RULES, default="block").collect()
    assert frame.count() == len(got) and got[0].asDict().keys() == {"page_id", "url", "host", "path", "rule", "verdict"}
    for row in got:
        rest = row.url.partition("://")[2] if row.url and "://" in row.url else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        tail = rest[cut:]
        path = tail[:min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
        fit = [(len(h), len(p), h + p, v) for v, h, p in queries.URL_RULES
               if (host == h or host.endswith("." + h)) and path.startswith(p)]
        _, _, rule, verdict = max(fit, default=(0, 0, None, "block"))
        assert (row.host, row.path, row.rule, row.verdict) == (host, path, rule, verdict), row.url
    assert judge_urls(frame.limit(0), queries.URL_RULES).count() == 0
    ends = judge_urls(frame.select("url"), [("block", "com", "/a"), ("allow", "com", "/a:/")]).where("rule IS NOT NULL").collect()
    assert [(r.path, r.verdict) for r in ends] == [("/a://b.net/fr/", "allow")]


def test_base_statistics(spark):
    import re
    from collections import Counter

    texts = ODD + ["a b c a b c a b", "x x x x x x", "l1\nl1\n \n \nl2", "# $ %% &|<> *", "w " * 49, "p q r " * 20,
                   "\x0b\x0c one\u00a0two \x1f"]
    got = quality_rules.statistics(rows_of(spark, texts)).orderBy("doc_id").collect()
    word = re.compile(r"[^\x20\x09-\x0D]+")
    for row, text in zip(got, texts, strict=True):
        words = word.findall(text or "")
        windows = Counter(zip(words, words[1:], words[2:]))
        covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
        lines = [x for x in (text or "").split("\n") if word.search(x)]
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            len(covered)), text
    # a condition on the counts may be moved below them
    assert quality_rules.statistics(rows_of(spark, texts)).where(~quality_rules.base_failed()).count() == 0


def test_decision_list_learns_and_prunes(spark):
    rows = []
    for i in range(900):
        bad = i % 5 == 0
        rows.append({n: 0.0 for n in quality_rules.FEATURES} | {
            "symbol_share": 0.5 + i % 7 / 10 if bad and i % 10 else 0.0, "echo_share": 0.4 if bad and not i % 10 else 0.01 * (i % 3),
            "mean_word": 4 + (i * 37 % 100) / 50, "_label": not bad, "_part": i // 5 % 3})
    learned = quality_rules.learn(rows)
    assert 1 <= len(learned.rules) <= 4 and all(len(r.tests) <= 2 for r in learned.rules)
    verdicts = [next((r.verdict for r in learned.rules if r.meets(x)), learned.default) for x in rows]
    assert verdicts == [x["_label"] for x in rows]
    frame = spark.createDataFrame([tuple(x[n] for n in quality_rules.FEATURES) for x in rows], quality_rules.FEATURES)
    assert [r[0] for r in frame.select(learned.column()).collect()] == verdicts
    assert quality_rules.learn([]).column() is not None and quality_rules.learn(rows[1:5]).rules == []


@pytest.mark.parametrize("name, column", [("op2_quality_rules", "kept"), ("op5_byte_cnn", "predicted")])
def test_quality_on_labelled_documents(spark, name, column):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = queries.QUERIES[name](spark, folder)
    assert got.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    judged = got.join(labels, "doc_id")
    judged = judged.where("NOT base_failed") if name.startswith("op2") else judged.where("held_out")
    right = judged.select(F.avg((F.col(column).cast("int") == F.col("quality")).cast("int"))).first()[0]
    lost = judged.where("quality = 1").select(F.avg(1 - F.col(column).cast("int"))).first()[0]
    assert right >= 0.95 and lost <= 0.02


def test_network_on_odd_texts(spark):
    net = byte_cnn.train([b"clean words here " * 9, b"%%% $$$ %%% " * 9] * 30, [1, 0] * 30, epochs=4)
    docs = rows_of(spark, [*ODD, "%%% $$$ " * 40, "clean words here " * 40, "clean words here " * 40]).withColumn("Score", F.lit("x"))
    got = byte_cnn.add_score(docs, net).orderBy("doc_id").collect()
    scores = [r.score for r in got]
    assert len(scores) == len(ODD) + 3 and all(0 <= s <= 1 for s in scores)
    assert scores[-3] < 0.5 <= scores[-2] and scores[-1] == scores[-2] and scores[0] == scores[1]
    # a text is scored alike alone and among others, and as a whole: its end counts
    clean = b"clean words here " * 900
    flat = np.frombuffer(clean + clean + b"%%% $$$ %%% $$$ " * 40, np.uint8)
    both = net.score(flat, np.array([0, len(clean), len(flat)]))
    assert both[1] < both[0] - 0.01
    assert np.allclose(both[1], net.score(flat[len(clean):], np.array([0, len(flat) - len(clean)])), atol=1e-6)
    assert byte_cnn.add_score(docs.limit(0), net).count() == 0
    assert {r.score for r in byte_cnn.add_score(docs, None).collect()} == {0.5}
    nothing = spark.createDataFrame([], "doc_id long, quality int")
    assert byte_cnn.fit(docs, nothing) is None and quality_rules.fit(docs, nothing).rules == []


def test_gradient_is_the_slope():
    net = byte_cnn.ByteNet.fresh(seed=2)
    for k, w in enumerate(net.weights()):  # double precision for finite differences
        setattr(net, ["embed", "filters", "bias", "hidden", "offset", "out", "base"][k], w.astype(np.float64))
    text = np.frombuffer(("some text 12 " * 40).encode(), np.uint8)

    def loss():
        p = net.score(text, np.array([0, len(text)]))[0]
        return -np.log(p)

    for weights, slope in zip(net.weights(), net.gradient(text, 1)):
        at = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        old, step = weights[at], 1e-4
        weights[at] = old + step
        high = loss()
        weights[at] = old - step
        low = loss()
        weights[at] = old
        assert abs((high - low) / (2 * step) - slope[at]) <= 2e-3 + 0.05 * abs(slope[at])


def test_arrow_slices_cover_every_row():
    from wardline.llm.segments import slices

    texts = pa.array(["a" * 10, None, "b" * 5000, "", "c"])
    assert [x for a, b in slices(texts, 100) for x in range(a, b)] == list(range(5))
