"""Diagnosis of label purity and drift, and the rule layers built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions import ip as ipx
from wardline.functions.text import flow_token_count

# Products whose events carry one label.
PURE_PRODUCTS = ("Precinct", "Falcon", "AWS VPC Security", "ASA Firewall")
PURITY_SHARE = 0.99
PURITY_MIN_ROWS = 30
SCORE_CUT = 0.5


def label_purity(df: DataFrame, value_col: str, label_col: str, share: float = PURITY_SHARE,
                 min_rows: int = PURITY_MIN_ROWS) -> DataFrame:
    """Per value: rows, most frequent label, its share, and whether the value is pure."""
    counts = df.groupBy(value_col, label_col).agg(F.count("*").alias("n"))
    best = F.min(F.struct(-F.col("n"), F.col(label_col)))
    per_value = counts.groupBy(value_col).agg(F.sum("n").alias("n_rows"), best.alias("b"))
    purity = -F.col("b.col1") / F.col("n_rows")
    return per_value.select(
        value_col, "n_rows", F.col(f"b.{label_col}").alias("top_label"), purity.alias("purity"),
        ((purity >= share) & (F.col("n_rows") >= min_rows)).cast("int").alias("is_pure"),
    )


def is_pure_product(product: Column, products=PURE_PRODUCTS) -> Column:
    return F.coalesce(product.isin(*products), F.lit(False))


def is_empty_product(product: Column) -> Column:
    return F.coalesce(product, F.lit("")) == ""


def purity_rule(df: DataFrame, label_col: str, product_col: str = "product_name", out: str = "rule_label") -> DataFrame:
    return df.withColumn(out, F.when(is_pure_product(F.col(product_col)), "suspicious").otherwise(F.col(label_col)))


def hard_features(df: DataFrame, text_col: str = "message_sanitized") -> DataFrame:
    """Content signals that hold on hosts never seen in training."""
    src = F.col("src_ip")
    return df.withColumns({
        "is_sus_product": is_pure_product(F.col("product_name")).cast("int"),
        "is_empty_product": is_empty_product(F.col("product_name")).cast("int"),
        "username_is_dash": F.coalesce(F.col("username") == "-", F.lit(False)).cast("int"),
        "has_src_ip": (F.coalesce(src, F.lit("")) != "").cast("int"),
        "src_ip_cgnat": ipx.in_ranges(ipx.ip_long(src), [ipx.CGNAT_RANGE]).cast("int"),
        "msg_flow_tokens": flow_token_count(F.col(text_col)),
    })


def two_stage(df: DataFrame, score_col: str, product_col: str = "product_name", out: str = "stage_label",
              cut: float = SCORE_CUT) -> DataFrame:
    product = F.col(product_col)
    label = (
        F.when(is_empty_product(product), F.when(F.col(score_col) >= cut, "malicious").otherwise("benign"))
        .when(is_pure_product(product), "suspicious").otherwise("benign")
    )
    return df.withColumn(out, label)


def oov_rate(train: DataFrame, test: DataFrame, cols: list[str]) -> DataFrame:
    """Per column: test rows with a value, and the share whose value never occurs in train.

    Both sides shrink to one row per (column, value) before they meet.
    """
    def values(df: DataFrame) -> DataFrame:
        texts = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
        return texts.unpivot([], cols, "column", "value").where(F.col("value").isNotNull())

    seen = values(train).distinct().withColumn("seen", F.lit(1))
    counts = values(test).groupBy("column", "value").agg(F.count("*").alias("n"))
    return (
        counts.join(seen, ["column", "value"], "left").groupBy("column")
        .agg(F.sum("n").alias("n_rows"),
             F.sum(F.when(F.col("seen").isNull(), F.col("n")).otherwise(0)).alias("n_oov"))
        .select("column", "n_rows", "n_oov", (F.col("n_oov") / F.col("n_rows")).alias("oov_rate"))
    )


def distribution_shift(train: DataFrame, test: DataFrame, col: str) -> DataFrame:
    """Per value its share in train and test and half the absolute difference; the halves sum to the total difference."""
    sides = train.select(F.col(col), F.lit(1).alias("tr")).unionByName(test.select(F.col(col), F.lit(0).alias("tr")))
    counts = sides.groupBy(col).agg(F.sum("tr").alias("a"), F.sum(1 - F.col("tr")).alias("b"))
    totals = counts.agg(F.sum("a").alias("ta"), F.sum("b").alias("tb"))
    # One row of totals.
    joined = counts.join(F.broadcast(totals))
    p = F.coalesce(F.try_divide(F.col("a"), F.col("ta")), F.lit(0.0))
    q = F.coalesce(F.try_divide(F.col("b"), F.col("tb")), F.lit(0.0))
    return joined.select(
        F.col(col).alias("value"), p.alias("p_train"), q.alias("p_test"), (F.abs(p - q) / 2).alias("half_diff")
    )


def prediction_jaccard(left: DataFrame, right: DataFrame, id_col: str = "event_id") -> DataFrame:
    """Jaccard of two sets of flagged events."""
    both = (
        left.select(id_col, F.lit(1).alias("l"), F.lit(0).alias("r"))
        .unionByName(right.select(id_col, F.lit(0).alias("l"), F.lit(1).alias("r")))
        .groupBy(id_col).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    )
    return both.agg(
        F.count(F.when((F.col("l") == 1) & (F.col("r") == 1), 1)).alias("n_both"), F.count("*").alias("n_any"),
    ).select("n_both", "n_any", F.coalesce(F.try_divide("n_both", "n_any"), F.lit(0.0)).alias("jaccard"))


def slice_recall(df: DataFrame, slice_cols: list[str], y: str, pred: str, positive: int = 1) -> DataFrame:
    """Rows, accuracy and recall of one class per slice; recall is 0 where the class is absent."""
    truth, hit = F.col(y) == positive, F.col(y) == F.col(pred)
    return (
        df.groupBy(*slice_cols)
        .agg(F.count("*").alias("n_rows"), F.count(F.when(hit, 1)).alias("n_hit"),
             F.count(F.when(truth, 1)).alias("n_pos"), F.count(F.when(truth & hit, 1)).alias("n_tp"))
        .select(*slice_cols, "n_rows", (F.col("n_hit") / F.col("n_rows")).alias("accuracy"), "n_pos",
                F.coalesce(F.try_divide("n_tp", "n_pos"), F.lit(0.0)).alias("recall"))
    )
