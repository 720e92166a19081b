"""The branches for large data, forced by small limits, against brute force."""

import ipaddress
import math
import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wardline.functions import ip as ipx
from wardline.functions.hashing import hash_hex
from wardline.operators import explain, features, hashsearch, ipfeat, metrics, neighbors, ordering, resample, sampling, textfeat
from wardline.operators.joins import lookup
from wardline.operators.neighbors import knn


def numbers(spark, n=3000, seed=1):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["a", "a", "a", "b"]), 7.0 if i % 3 == 0 else rng.gauss(0, 10), None if i % 11 == 0 else float(rng.randrange(50)))
            for i in range(n)]
    return spark.createDataFrame(rows, "id bigint, c string, x double, y double").repartition(5), rows


def test_exact_quantiles_by_selection(spark):
    df, rows = numbers(spark)
    probs = [0.0, 0.25, 0.5, 0.999]
    found = ordering.exact_quantiles(df, ["x", "y"], probs, small_rows=20, accuracy=50)
    for c, i in (("x", 2), ("y", 3)):
        values = np.array([r[i] for r in rows if r[i] is not None])
        assert found[c] == pytest.approx(np.quantile(values, probs).tolist(), abs=1e-12)
    assert found == ordering.exact_quantiles(df, ["x", "y"], probs)


def test_exact_quantiles_of_an_empty_column(spark):
    df = spark.createDataFrame([(None, float("nan"))], "a double, b double")
    assert ordering.medians(df, ["a", "b"]) == {"a": None, "b": None}


def _order(rows, c):
    import hashlib

    part = [r[0] for r in rows if r[1] == c]
    return sorted(part, key=lambda i: (hashlib.md5(f"42|{i}".encode()).hexdigest(), i))


@pytest.mark.parametrize("bucket_rows", [3, 100, 500_000])
def test_split_folds_and_ranks_in_hash_order(spark, bucket_rows):
    df, rows = numbers(spark)
    split = {r["id"]: r["split"] for r in sampling.stratified_split(df, "c", "id", 0.15, bucket_rows=bucket_rows).collect()}
    folds = {r["id"]: r["fold"] for r in sampling.stratified_kfold(df, "c", "id", 5, bucket_rows=bucket_rows).collect()}
    ranks = {r["id"]: r["rank"] for r in ordering.hash_rank(df, ["c"], "id", bucket_rows=bucket_rows).collect()}
    assert len(split) == len(folds) == len(ranks) == len(rows)
    for c in "ab":
        order = _order(rows, c)
        n = len(order)
        quota = math.floor(n * 0.15 + 0.5)
        assert {i for i in order if split[i] == "val"} == set(order[:quota])
        assert [folds[i] for i in order] == [r * 5 // n for r in range(n)]
        assert [ranks[i] for i in order] == list(range(1, n + 1))


def test_running_sums_over_ranges(spark):
    df, rows = numbers(spark)
    table = df.groupBy("c", "x").agg(F.count("*").alias("n"))
    small = ordering.running_sums(table, ["c"], ["x"], {"n": "s"}).collect()
    large = ordering.running_sums(table, ["c"], ["x"], {"n": "s"}, small_rows=10, partitions=7).collect()
    assert sorted(map(tuple, small)) == sorted(map(tuple, large))


def test_auc_over_ranges(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(3), *rng.choices(range(40), k=3)) for _ in range(900)]
    df = spark.createDataFrame([(y, a / 40, b / 40, c / 40) for y, a, b, c in rows], "y int, p0 double, p1 double, p2 double")
    found = metrics.auc_ovr(df, ["p0", "p1", "p2"], small_rows=5).first()["auc_ovr"]
    expected = []
    for c in range(3):
        pos = [r[1 + c] for r in rows if r[0] == c]
        neg = [r[1 + c] for r in rows if r[0] != c]
        expected.append(sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / len(pos) / len(neg))
    assert found == pytest.approx(sum(expected) / 3)
    missing = df.where("y <> 2")
    assert metrics.auc_ovr(missing, ["p0", "p1", "p2"]).first()["auc_ovr"] is None


def test_ordinal_codes_over_ranges(spark):
    df = spark.createDataFrame([(f"v{i % 97}",) for i in range(500)], "v string")
    codes = {r["value"]: r["code"] for r in features.fit_ordinal(df, "v", small_rows=10).collect()}
    assert codes == {v: float(i) for i, v in enumerate(sorted(codes))}


def test_lookup_keeps_rows_without_a_key(spark):
    df = spark.createDataFrame([(i, None if i % 3 else "hot") for i in range(300)], "id int, k string")
    table = spark.createDataFrame([("hot", 1.0), (None, 9.0)], "k string, v double")
    out = lookup(df, table, "k", {"v": -1.0}).groupBy("v").count().collect()
    assert {r["v"]: r["count"] for r in out} == {1.0: 100, -1.0: 200}


def vectors(spark, n=240, dims=4, seed=5):
    """A third of the rows are copies of one vector; coordinates on a grid give many ties."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        v = [1.0] * dims if i % 3 == 0 else [float(rng.randrange(6)) / 4 for _ in range(dims)]
        rows.append((i, 0 if i % 3 == 0 else rng.choice([0, 1, 1, 2]), v))
    return spark.createDataFrame(rows, "event_id bigint, label_idx int, features array<double>").repartition(4), rows


def brute(rows, k, same):
    out = {}
    for i, c, v in rows:
        near = sorted((round(sum((a - b) ** 2 for a, b in zip(v, w)), 9), j) for j, d, w in rows if j != i and (not same or c == d))
        out[i] = near[:k]
    return out


@pytest.mark.parametrize("same", [True, False])
@pytest.mark.parametrize("block_rows", [5, 40, 16_384])
def test_knn_is_exact(spark, same, block_rows):
    df, rows = vectors(spark)
    found = knn(df, "event_id", "features", 4, "label_idx" if same else None, block_rows).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r["id"], r["rank"])):
        got.setdefault(r["id"], []).append((r["dist2"], r["neighbor"]))
    assert got == brute(rows, 4, same)


def test_rows_do_not_meet_ever_more_blocks():
    """A vector is sent to each block at most: their number stays, and no block outgrows a task."""
    for total in (20_000, 300_000, 1_200_000, 2_000_000):
        size = neighbors._block_size(total, neighbors.BLOCK_ROWS)
        assert math.ceil(total / size) <= neighbors.ENOUGH_BLOCKS and size <= 131_072


@pytest.mark.parametrize("k", [1, 4, 30])
def test_candidates_beyond_the_bound_are_left_out(k):
    rng = np.random.default_rng(0)
    data, asked = rng.integers(0, 4, (300, 3)).astype(float), rng.integers(0, 4, (40, 3)).astype(float)
    ids = [[i, i + 1000] for i in range(300)]
    bound = rng.integers(0, 9, 40).astype(float)
    bound[::4] = np.inf
    for q, b, (dists, found) in zip(asked, bound, neighbors._best(asked, data, ids, k, bound)):
        wanted = sorted((float(((x - q) ** 2).sum()), i) for x, own in zip(data, ids) for i in own)[:k]
        assert [p for p in zip(dists, found) if p[0] <= b] == [p for p in wanted if p[0] <= b]


def test_cleaning_and_synthesis_do_not_depend_on_blocks(spark):
    df, rows = vectors(spark, 150)
    near1, near3 = brute(rows, 1, False), brute(rows, 3, False)
    label = {i: c for i, c, _ in rows}
    links = {(i, n[0][1]) for i, n in near1.items() if near1[n[0][1]][0][1] == i and label[i] != label[n[0][1]]}
    found = {tuple(r) for r in resample.tomek_links(df, "label_idx", "event_id", "features", 16).collect()}
    assert found == links
    clean = {i for i, n in near3.items() if all(label[j] == label[i] for _, j in n)}
    assert {r["event_id"] for r in resample.enn_clean(df, "label_idx", "event_id", "features", block_rows=16).collect()} == clean
    a = resample.smote(df, "label_idx", "event_id", "features", block_rows=16).collect()
    b = resample.smote(df, "label_idx", "event_id", "features").collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_adasyn_shares(spark):
    df, rows = vectors(spark, 150)
    near = brute(rows, 5, False)
    label = {i: c for i, c, _ in rows}
    counts = {c: sum(1 for r in rows if r[1] == c) for c in range(3)}
    out = resample.adasyn(df, "label_idx", "event_id", "features", block_rows=32)
    got = {r["label_idx"]: r["n"] for r in out.where("event_id < 0").groupBy("label_idx").agg(F.count_distinct("event_id").alias("n")).collect()}
    for c, n in counts.items():
        others = sum(label[j] != c for i, near_i in near.items() if label[i] == c for _, j in near_i)
        assert got.get(c, 0) == (max(counts.values()) - n if others else 0)


def test_smote_is_skipped_when_it_cannot_be_met(spark):
    df, rows = vectors(spark, 60)
    assert resample.smote(df, "label_idx", "event_id", "features", {1: 1}).count() == len(rows)
    assert resample.hybrid_resample(df, "label_idx", "event_id", "features").count() > 0
    assert resample.resample(df, "label_idx", "event_id", "features", "unheard_of").count() == len(rows)


ADDRESSES = [
    "10.1.2.3", "172.16.0.1", "172.32.0.1", "192.168.255.255", "192.169.0.0", "100.64.0.0", "100.127.255.255", "100.128.0.0",
    "8.8.8.8", "255.255.255.255", "0.0.0.0", "256.1.1.1", "1.2.3", "1.2.3.4.5", "01.2.3.4", "1.2.3.4 ", "", "not-an-ip", None,
    "::", "::1", "1::", "2001:db8::1", "2001:db8:0:0:0:0:0:1", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "1:2:3:4:5:6:7:8:9", "1::2::3",
    "::ffff:1.2.3.4", "::1.2.3.4", "1:2:3:4:5:6:1.2.3.4", "1:2:3:4:5:6:7:1.2.3.4", "fe80::1%eth0", "fe80::1%", "12345::", "g::1", ":::", "1:",
    "::2:3:4:5:6:7:8", "1::3:4:5:6:7:8",
]


def parse(text):
    try:
        return ipaddress.ip_address(text)
    except ValueError:
        return None


def test_addresses_follow_the_standard_parser(spark):
    df = spark.createDataFrame([(a,) for a in ADDRESSES], "a string")
    out = ipfeat.private_columns(df.select("a", ipx.ip_prefix(F.col("a"), 16).alias("p")), a="a").collect()
    ranges = [ipaddress.ip_network(f"{n}/{b}") for n, b in ipx.PRIVATE_RANGES]
    for r in out:
        ip = parse(r["a"])
        private = -1 if ip is None else int(ip.version == 4 and any(ip in n for n in ranges))
        prefix = -2 if ip is None else -1 if ip.version == 6 else int(ipaddress.ip_network(f"{ip}/16", strict=False).network_address)
        assert (r["is_private_a"], r["p"]) == (private, prefix), r["a"]


def test_strict_subnets(spark):
    df = spark.createDataFrame([("x", "y"), ("10.0.0.1", "10.0.0.2"), ("::1", "::2")], "src_ip string, dst_ip string")
    loose = [r["is_same_subnet_24"] for r in ipfeat.ip_topology(df).collect()]
    strict = [r["is_same_subnet_24"] for r in ipfeat.ip_topology(df, strict=True).collect()]
    assert (loose, strict) == ([1, 1, 1], [0, 1, 0])


def test_host_column_disables_source_statistics(spark):
    df = spark.createDataFrame([("1.1.1.1", "2.2.2.2", "h")], "src_ip string, dst_ip string, src_host string")
    assert ipfeat.src_ip_behavior(df) is None
    assert ipfeat.src_ip_behavior(df, skip_if_src_host=False).columns == ["src_ip", "src_dst_ip_count", "src_total_events"]


TEXTS = ["Alpha beta a", "alpha ALPHA gamma", "", None, "x", "alpha beta  beta\tbéta 中文", "beta beta beta gamma"]


def test_tfidf_against_plain_python(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id bigint, t string")

    def grams(text):
        out = []
        for w in (text or "").lower().split():
            w = f" {w} "
            for n in range(1, 5):
                out += [w[i:i + n] for i in range(len(w) - n + 1)]
        return out

    docs = [grams(t) for t in TEXTS]
    df_count = {g: sum(g in d for d in docs) for d in docs for g in d}
    kept = sorted(g for g, n in df_count.items() if n >= 3)
    table = {r["term"]: r for r in textfeat.fit_vocabulary(df, "t", min_df=3).collect()}
    assert sorted(table) == kept
    assert all(table[g]["tf"] == sum(d.count(g) for d in docs) and table[g]["df"] == df_count[g] for g in kept)
    vocabulary = textfeat.fit_vocabulary(df, "t", min_df=3)
    for r in textfeat.tfidf(df, vocabulary, "id", "t").collect():
        raw = {i: (1 + math.log(docs[r["id"]].count(g))) * (math.log((1 + len(docs)) / (1 + df_count[g])) + 1)
               for i, g in enumerate(kept) if g in docs[r["id"]]}
        norm = math.sqrt(sum(v * v for v in raw.values())) or 1.0
        assert r["indices"] == sorted(raw)
        assert r["weights"] == pytest.approx([raw[i] / norm for i in sorted(raw)])


@pytest.mark.parametrize("analyzer, low, high", [("char_wb", 1, 4), ("char_wb", 4, 5), ("word", 1, 2), ("word", 2, 3)])
def test_terms_leave_a_task_counted(spark, monkeypatch, analyzer, low, high):
    """Occurrences are added up in the tasks, none is shuffled, also when a task must hand over its terms early."""
    monkeypatch.setattr(textfeat, "MAX_TERMS", 3)
    texts = TEXTS * 3 + ["\U0001f600 a\U0001f600b beta", "beta" * 50]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, t string").repartition(3)
    out = textfeat.term_statistics(df, "t", analyzer, (low, high))
    assert "Generate" not in out._jdf.queryExecution().toString()

    def grams(text):
        if analyzer == "word":
            words = re.findall(r"\w{2,}", (text or "").lower())
            return [" ".join(words[i:i + n]) for n in range(low, high + 1) for i in range(len(words) - n + 1)]
        words = [f" {w} " for w in (text or "").lower().split()]
        return [w[i:i + n] for w in words for n in range(low, max(low, min(high, len(w))) + 1) for i in range(max(len(w) - n, 0) + 1)]

    docs = [grams(t) for t in texts]
    wanted = {g: (sum(d.count(g) for d in docs), sum(g in d for d in docs)) for d in docs for g in d}
    assert {r["term"]: (r["tf"], r["df"]) for r in out.collect()} == wanted


def test_rows_of_words_in_pieces(monkeypatch):
    monkeypatch.setattr(textfeat, "MAX_WORDS", 4)
    rows = pa.array([["a", "b"], None, ["c"] * 9, [], ["d"], ["e"] * 4, ["f"]], pa.list_(pa.string())).slice(1)
    assert [len(x) for x in textfeat._pieces(rows)] == [1, 1, 2, 1, 1]
    assert sum((x.to_pylist() for x in textfeat._pieces(rows, 2)), []) == rows.to_pylist()


def test_tree_contributions_are_shapley_values(spark):
    """Against the defining sum over coalitions, with expectations by cover."""
    from wardline.operators.models import forest

    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 3))
    y = (x[:, 0] + x[:, 1] * x[:, 2] > 0).astype(int)
    df = spark.createDataFrame([(i, float(c), *map(float, v)) for i, (v, c) in enumerate(zip(x, y))], "event_id bigint, y double, a double, b double, c double")
    df = features.assemble(df, ["a", "b", "c"])
    model = forest("y", num_trees=3, max_depth=4, min_leaf=2).fit(df)
    phi, base = explain.shap_tree(model, df, "event_id", ["a", "b", "c"], max_rows=None, leaves_per_pass=5)
    got = {}
    for r in phi.collect():
        got.setdefault(r["event_id"], {})[r["feature"]] = r["phi"]
    leaves = explain._leaves(spark, model, 1, [])

    def value(v, known):
        total = 0.0
        for leaf in leaves:
            part = leaf["value"]
            for f, (low, high, share) in leaf["path"].items():
                part *= float(low < v[f] <= high) if f in known else share
            total += part
        return total

    weight = {0: 1 / 3, 1: 1 / 6, 2: 1 / 3}
    for i in range(0, 200, 23):
        for f, name in enumerate("abc"):
            rest = [j for j in range(3) if j != f]
            exact = sum(weight[len(s)] * (value(x[i], {*s, f}) - value(x[i], set(s))) for n in range(3) for s in combinations(rest, n))
            assert got[i][name] == pytest.approx(exact, abs=1e-9)
    assert base == pytest.approx(value(x[0], set()))


def test_interactions_skip_missing_factors_at_any_width(spark):
    df, _ = numbers(spark, 200)
    names = [f"c{i}" for i in range(24)]
    wide = df.select("id", *[F.when(F.col("id") % (i + 3) != 0, F.col("x") * (i + 1)).alias(c) for i, c in enumerate(names)])
    table = wide.toPandas()
    got = {(a, b): v for a, b, v in features.interaction_top_k(wide, names, 400)}
    assert len(got) == 24 * 23 // 2
    for (a, b), v in got.items():
        assert v == pytest.approx((table[a] * table[b]).var(), nan_ok=True)


@pytest.mark.parametrize("labels", [["a", "b", None], [0, 1, None]])
def test_missing_labels_are_a_class(spark, labels):
    kind = "string" if isinstance(labels[0], str) else "int"
    rows = [(i, labels[i % 3] if i % 2 else None) for i in range(600)]
    df = spark.createDataFrame(rows, f"id long, label {kind}")
    split = sampling.stratified_split(df, "label", "id", bucket_rows=50)
    got = {(r["label"], r["split"]): r["n"] for r in split.groupBy("label", "split").agg(F.count("*").alias("n")).collect()}
    assert got == {(labels[0], "val"): 15, (labels[0], "train"): 85, (labels[1], "val"): 15, (labels[1], "train"): 85,
                   (None, "val"): 60, (None, "train"): 340}
    folds = sampling.stratified_kfold(df, "label", "id", 5, bucket_rows=50).where("label IS NULL").groupBy("fold").count()
    assert {r["fold"]: r["count"] for r in folds.collect()} == dict.fromkeys(range(5), 80)
    under = resample.random_under(df, "label", "id").groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in under} == dict.fromkeys(labels, 100)
    assert resample.random_under(df, "label", "id", {labels[0]: 7}).where("label IS NULL").count() == 400


def test_sample_is_the_smallest_hashes(spark):
    df, rows = numbers(spark, 300)
    sample = sampling.sample_without_replacement(df, "id", 20)
    assert {r["id"] for r in sample.collect()} == {r["id"] for r in df.orderBy(hash_hex(42, F.col("id"))).limit(20).collect()}


def test_rows_without_an_id_are_numbered_under_its_name(spark):
    from wardline.operators import prep
    from wardline.plans import lifecycle

    df = spark.createDataFrame([(f"t{i}", float(i % 7), ["x", "y", None][i % 3]) for i in range(300)], "text string, v double, label string")
    path, model = lifecycle.prepare(df.dropDuplicates(), ["evt_id"], ["text"], "label")
    rows = spark.read.parquet(path)
    assert sorted(r["evt_id"] for r in rows.select("evt_id").collect()) == list(range(300))
    assert rows.where("split = 'val' AND label_idx = -1").count() == 15
    alone = model.transform(df.drop("label"), has_label=False)
    assert alone.columns[0] == "evt_id" and alone.select("evt_id").distinct().count() == 300
    assert prep.fit_prep(df, [], ["text"], "label").transform(df).columns[0] == "event_id"


def test_a_value_of_most_rows_is_spread(spark):
    """One value with 90 % of the rows: no partition holds twice the median, without adaptive execution."""
    from wardline.operators import features

    rows = spark.range(40_000).select(
        F.col("id"), F.when(F.col("id") % 10 != 0, "hot").when(F.col("id") % 20 == 0, F.concat(F.lit("v"), F.col("id"))).alias("c"),
        (F.col("id") % 7).cast("double").alias("y"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(old, ("false", "8", "-1")):
            spark.conf.set(k, v)
        for table, default in (features.fit_target(rows, "c", "y"), (features.fit_ordinal(rows, "c"), -1.0)):
            assert {r.value for r in table.where("heavy").collect()} == {"hot", "UNKNOWN"}
            out = features.encode_values(rows, "c", table, default)
            sizes = sorted(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
            assert sum(sizes) == 40_000 and sizes[-1] <= 2 * sizes[len(sizes) // 2] and len(sizes) == 8
            plain = rows.withColumn("value", F.coalesce("c", F.lit("UNKNOWN"))).join(table, "value").select("id", F.col("code").alias("c"), "y")
            assert out.select("id", "c", "y").exceptAll(plain).count() == 0
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_tabulated_contributions_equal_the_row_by_row_sum(monkeypatch):
    """Bits of the cuts, infinite bounds, NaN and infinite values, leaves without a path, long paths."""
    rng = np.random.default_rng(5)
    leaves = [{"value": 0.3, "path": {}}]
    for n in (1, 2, 3, 8, 9, 9):
        bounds = lambda: sorted(rng.choice([-np.inf, -1.0, 0.0, 0.5, 1.0, np.inf], 2, replace=False))
        feats = rng.permutation(10)[:n].tolist()
        leaves += [{"value": float(rng.normal()), "path": {f: (*bounds(), float(rng.uniform(0.1, 1))) for f in feats}} for _ in range(4)]
    x = rng.choice([-np.inf, -2.0, -1.0, 0.0, 0.25, 0.5, 1.0, 3.0, np.inf, np.nan], (700, 10))
    made = explain._Contributions(leaves, 10)
    assert made.count == 16 and len(made.long) == 8
    monkeypatch.setattr(explain, "TABLE_BITS", 0)
    plain = explain._Contributions(leaves, 10)
    assert plain.count == 0
    np.testing.assert_allclose(made(x), plain(x), atol=1e-12)
    on = lambda leaf, row: {f: float(lo < row[f] <= hi) for f, (lo, hi, _) in leaf["path"].items()}
    for row, phi in zip(x[:30], made(x[:30])):
        expected = np.zeros(10)
        for leaf in leaves[:13]:  # by the definition over all coalitions
            agrees, feats = on(leaf, row), list(leaf["path"])
            reach = lambda s: leaf["value"] * math.prod(agrees[f] if f in s else leaf["path"][f][2] for f in feats)
            for f in feats:
                rest = [g for g in feats if g != f]
                for size in range(len(rest) + 1):
                    for s in combinations(rest, size):
                        share = math.factorial(size) * math.factorial(len(feats) - size - 1) / math.factorial(len(feats))
                        expected[f] += share * (reach({*s, f}) - reach(set(s)))
        short = explain._Contributions(leaves[:13], 10)(row[None])[0]
        assert short == pytest.approx(expected, abs=1e-9)


def test_contribution_leaves_are_tabulated_within_the_cells(monkeypatch):
    monkeypatch.setattr(explain, "TABLE_CELLS", 20)
    leaves = [{"value": 1.0, "path": {f: (-np.inf, 0.5, 0.5) for f in range(3)}}, {"value": 1.0, "path": {0: (0.5, np.inf, 0.5)}}]
    made = explain._Contributions(leaves, 3)
    assert made.count == 1 and len(made.long) == 1
    assert made(np.zeros((50, 3))).shape == (50, 3)


def test_permuted_values_travel_without_hash_text(spark):
    """Ranks by an expression as by a column; the window's exchange carries neither hash nor key."""
    df = spark.createDataFrame([(i % 3, i, float(i)) for i in range(500)] + [(0, None, 1.0)], "f int, id bigint, value double")
    by_text = ordering.hash_rank(df.withColumn("key", F.concat_ws("|", "f", "id")), ["f"], "key", "rank", "s", bucket_rows=20)
    found = ordering.hash_rank(df, ["f"], "id", "rank", "s", bucket_rows=20, key=F.concat_ws("|", "f", "id"))
    assert sorted(map(str, found.collect())) == sorted(map(str, by_text.select("f", "id", "value", "rank").collect()))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    moved = plan[plan.index("RepartitionByExpression"):]
    assert "__hash" not in moved.split("Join")[0] and "__hash" in plan


def test_stream_batches_have_a_file_for_every_core(spark):
    from wardline.plans.modelling import _stream_of

    stream = _stream_of(spark, spark.range(1000), 2)
    sizes = []
    stream.writeStream.foreachBatch(lambda b, i: sizes.append((b.count(), len(b.inputFiles())))).option(
        "checkpointLocation", spark.conf.get("spark.checkpoint.dir") + "/batches").trigger(availableNow=True).start().awaitTermination()
    assert len(sizes) == 2 and sum(n for n, _ in sizes) == 1000


def test_sparse_vectors_from_arrow_lists(spark):
    from pyspark.ml.linalg import Vectors

    rows = spark.createDataFrame([([0, 3], [1.0, 2.0]), ([], []), ([4], [0.5])], "i array<int>, v array<double>")
    found = [r["x"] for r in rows.select(features.sparse_vector(5)("i", "v").alias("x")).collect()]
    assert found == [Vectors.sparse(5, [0, 3], [1.0, 2.0]), Vectors.sparse(5, [], []), Vectors.sparse(5, [4], [0.5])]


def test_event_vectors_scan_the_events_once(spark, monkeypatch, tmp_path):
    """The fits pass over the stored frame, not over the view of the source table."""
    from wardline.plans import modelling

    events = [(i, i % 7, ["view", "error", "signup"][i % 3], float(i % 5), f'{{"k": {i}}}') for i in range(60)]
    table = spark.createDataFrame(events, "event_id bigint, user_id bigint, event_type string, value double, props string")
    table.withColumn("ts", F.timestamp_seconds("event_id")).write.parquet(f"{tmp_path}/events.parquet")
    seen, real = [], modelling.features.fit_standard
    monkeypatch.setattr(modelling.features, "fit_standard", lambda df, cols: (seen.append(df.inputFiles()), real(df, cols))[1])
    rows = modelling.event_vectors(spark, str(tmp_path))
    assert seen and not any("events.parquet" in f for f in seen[0])
    assert not any("events.parquet" in f for f in rows.inputFiles())


def test_permutation_query_repeats_in_full(spark, monkeypatch, tmp_path):
    """Every feature is permuted as often as the operator says, over all events."""
    from wardline.plans import catalog

    events = [(i, i % 7, ["view", "error", "signup"][i % 3], float(i % 5), f'{{"k": {i}}}') for i in range(60)]
    table = spark.createDataFrame(events, "event_id bigint, user_id bigint, event_type string, value double, props string")
    table.withColumn("ts", F.timestamp_seconds("event_id")).write.parquet(f"{tmp_path}/events.parquet")
    seen, real = [], explain._macro_f1
    monkeypatch.setattr(explain, "_macro_f1", lambda cells, keys, k: (seen.append(cells), real(cells, keys, k))[1])
    out = catalog.queries()["permutation_importance"](spark, str(tmp_path)).first()
    scored = seen[0].groupBy("f").agg(F.count_distinct("r").alias("repeats"), F.sum("n").alias("n")).collect()
    assert explain.REPEATS == 5 and {(r["repeats"], r["n"]) for r in scored} == {(5, 300)}
    assert (len(scored), out["n_rows"], out["n_violations"]) == (6, 6, 0)


@pytest.mark.parametrize("scale, centre", [(1.0, 0.0), (1e-3, 1e3), (1e20, 0.0)])
def test_distances_are_made_in_tiles(scale, centre):
    """No matrix of queries x rows is held, and rough distances lose no neighbour, whatever the numbers are."""
    import tracemalloc

    rng = np.random.default_rng(3)
    data, asked = (centre + scale * rng.normal(size=(n, 8)) for n in (4000, 400))
    tracemalloc.start()
    found = neighbors._best(asked, data, [[i] for i in range(4000)], 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400 * 4000 * 8
    for q, (dists, ids) in list(zip(asked, found))[:40]:
        exact = np.round(((data - q) ** 2).sum(axis=1), neighbors.DIGITS)
        wanted = sorted(zip(exact.tolist(), range(4000)))[:5]
        assert list(zip(dists, ids)) == wanted


@pytest.mark.parametrize("group_rows, ask_rows, block_rows", [(60, 10**6, 4096), (8, 30, 4096), (30, 50, 20)])
def test_hashed_search_in_groups(spark, monkeypatch, group_rows, ask_rows, block_rows):
    """Groups in one piece, dealt into a grid, and with buckets that are split: same distances, nobody goes short."""
    monkeypatch.setattr(hashsearch, "GROUP_ROWS", group_rows)
    monkeypatch.setattr(hashsearch, "ASK_ROWS", ask_rows)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 8)).astype(np.float32).astype(float)
    x[100:220] = 0.3 + 1e-3 * rng.normal(size=(120, 8))  # no single precision, one full bucket
    x[390:] = x[0]
    rows = [(i, int(i % 5 == 0), v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "event_id bigint, label_idx int, features array<double>").repartition(4)
    found = hashsearch.knn_lsh(df, "event_id", "features", 4, "label_idx", tables=6, leaf=10, block_rows=block_rows).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r["id"], r["rank"])):
        got.setdefault(r["id"], []).append((r["dist2"], r["neighbor"]))
    exact = brute(rows, 4, True)
    assert {i: len(near) for i, near in got.items()} == {i: 4 for i in range(400)}
    for i, near in got.items():
        assert near == sorted(near) and len({j for _, j in near}) == 4
        assert all(rows[j][1] == rows[i][1] and d == pytest.approx(((x[i] - x[j]) ** 2).sum(), abs=1e-8) for d, j in near)
    assert sum(len(set(near) & set(exact[i])) for i, near in got.items()) > 0.9 * 1600


def test_a_vector_travels_once_to_each_group(spark, monkeypatch):
    monkeypatch.setattr(hashsearch, "GROUP_ROWS", 100)
    rng = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(400, 8)).astype(np.float32).astype(float))]
    vectors, sizes, means = hashsearch._fitted(
        spark.createDataFrame(rows, "event_id bigint, features array<double>"), "event_id", "features", 4, None)
    hashed = hashsearch._Tables(means, sizes, 3, 8, 4, 42)
    sent = hashsearch._grouped(vectors, hashed, {}, {}, {}).collect()
    assert sum(r["data"] for r in sent) == 3 * 400 and sum(len(r["asks"]) // 8 for r in sent) == 3 * 9 * 400
    assert len({(r["t"], r["g"], r["vid"]) for r in sent}) == len(sent) < 3 * 9 * 400 / 2
    assert {len(r["vec"]) for r in sent} == {8 * 4}
