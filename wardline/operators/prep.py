"""Loading-time preparation: roles, missing values, codes and column alignment."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.operators import ordering
from wardline.session import cut_lineage
from wardline.sources.state import load_state, save_state

MISSING_THRESHOLD = 0.6
HIGH_CARD_THRESHOLD = 300
UNKNOWN = "UNKNOWN"
FALLBACK_LABEL = "benign"
STATE_VERSION = 1


def is_numeric(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.NumericType, T.BooleanType))


def numeric_columns(df: DataFrame, cols: list[str] | None = None) -> list[str]:
    names = df.columns if cols is None else cols
    return [c for c in names if is_numeric(df.schema[c].dataType)]


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN is a value to Spark's aggregates but a missing one to this pipeline."""
    exprs = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c).alias(f.name)
        exprs.append(c)
    return df.select(*exprs)


def split_roles(df: DataFrame, id_cols: list[str], text_cols: list[str], label_col: str | None) -> DataFrame:
    """One row per event with structs ``ids``, ``texts``, ``features`` and the label."""
    taken = {*id_cols, *text_cols, label_col}
    features = [c for c in df.columns if c not in taken]
    parts = [F.struct(*id_cols).alias("ids"), F.struct(*text_cols).alias("texts")]
    if label_col:
        parts.append(F.col(label_col))
    return df.select(*parts, F.struct(*features).alias("features"))


def feature_columns(df: DataFrame, id_cols, text_cols, label_col) -> list[str]:
    taken = {*id_cols, *text_cols, label_col}
    return [c for c in df.columns if c not in taken]


def _unpivot(row: DataFrame, cols: list[str], name: str, value: str) -> DataFrame:
    return row.unpivot([], cols, name, value)


def missing_rate(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, missing_rate) in one pass over all columns."""
    one = nan_to_null(df.select(*cols)).agg(
        *[(F.count(F.when(F.col(c).isNull(), 1)) / F.count("*")).alias(c) for c in cols]
    )
    return _unpivot(one, cols, "column", "missing_rate")


def sparse_columns(df: DataFrame, cols: list[str], threshold: float = MISSING_THRESHOLD) -> list[str]:
    rates = missing_rate(df, cols).where(F.col("missing_rate") > threshold)
    return [r["column"] for r in rates.collect()]


def drop_sparse_cols(df: DataFrame, cols: list[str], threshold: float = MISSING_THRESHOLD) -> DataFrame:
    return df.drop(*sparse_columns(df, cols, threshold))


def numeric_medians(df: DataFrame, cols: list[str]) -> dict[str, float]:
    return {c: 0.0 if v is None else float(v) for c, v in ordering.medians(df, cols).items()}


def categorical_modes(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value): the most frequent value, the smallest one on a tie.

    Counting by (column, value) lets a column of any cardinality spread over tasks;
    ``mode`` would hold all its values in one buffer.
    """
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, value string")
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
    counts = (
        texts.unpivot([], cols, "column", "value").where(F.col("value").isNotNull())
        .groupBy("column", "value").agg(F.count("*").alias("n"))
    )
    best = counts.groupBy("column").agg(F.min(F.struct(-F.col("n"), F.col("value"))).alias("m"))
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    return names.join(F.broadcast(best), "column", "left").select(
        "column", F.coalesce(F.col("m.value"), F.lit(UNKNOWN)).alias("value")
    )


def fit_labels(df: DataFrame, label_col: str) -> list[str]:
    counts = ordering.class_counts(df.select(F.col(label_col).cast("string").alias("v")), "v")
    return sorted((v for v in counts if v is not None), key=lambda v: v.encode("utf-8"))


def label_table(spark: SparkSession, labels: list[str]) -> DataFrame:
    return spark.createDataFrame(list(zip(labels, range(len(labels)))), "label string, idx int")


def encode_label(label: Column, labels: list[str]) -> Column:
    """Index of the label; unknown or missing gives -1."""
    out = F.lit(-1)
    for i, name in reversed(list(enumerate(labels))):
        out = F.when(label == name, i).otherwise(out)
    return out.cast("int")


def decode_label(index: Column, labels: list[str], fallback: str = FALLBACK_LABEL) -> Column:
    out = F.lit(fallback)
    for i, name in reversed(list(enumerate(labels))):
        out = F.when(index == i, name).otherwise(out)
    return out


def align_schema(df: DataFrame, columns: list[str], keep: list[str] | None = None) -> DataFrame:
    """Fit-time columns in fit-time order: absent ones are 0, extra ones go."""
    kept = [F.col(c) for c in keep or [] if c in df.columns]
    return df.select(*kept, *[F.col(c) if c in df.columns else F.lit(0).alias(c) for c in columns])


def coerce_numeric(c: Column) -> Column:
    return F.coalesce(F.nanvl(c.cast("string").try_cast("double"), F.lit(0.0)), F.lit(0.0))


def profile_columns(df: DataFrame, cols: list[str], threshold: int = HIGH_CARD_THRESHOLD) -> dict[str, str]:
    """column -> numeric | low_card | high_card (more than ``threshold`` distinct values).

    One sketch pass decides the clear cases; only columns near the threshold are
    counted exactly, each by a distinct that combines on the map side.
    """
    roles = {c: "numeric" for c in numeric_columns(df, cols)}
    rest = [c for c in cols if c not in roles]
    if not rest:
        return roles
    rough = df.agg(*[F.approx_count_distinct(F.col(c).cast("string"), 0.02).alias(c) for c in rest]).first()
    for c in rest:
        n = rough[c]
        if 0.8 * threshold <= n <= 1.2 * threshold:
            n = df.select(F.col(c).cast("string")).dropna().distinct().count()
        roles[c] = "high_card" if n > threshold else "low_card"
    return {c: roles[c] for c in cols}


@dataclass
class PrepModel:
    """Fitted preparation: everything needed to turn raw events into aligned columns."""

    id_cols: list[str]
    text_cols: list[str]
    label_col: str | None
    numeric: list[str]
    categorical: list[str]
    feature_order: list[str]
    dropped: list[str]
    medians: dict[str, float] = field(default_factory=dict)
    modes: dict[str, str] = field(default_factory=dict)
    labels: list[str] = field(default_factory=list)

    def transform(self, df: DataFrame, has_label: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
        """ids, texts, ``label_idx`` (with a label) and the features: one projection, no shuffle.

        Texts stay in the row, so text features can still be built later.
        """
        present = set(df.columns)
        out = [F.col(c) for c in [*self.id_cols, *self.text_cols, *keep] if c in present]
        if not any(c in present for c in self.id_cols):
            # Numbers follow the scan, so the rows are pinned first: a retried task must not renumber them.
            name = self.id_cols[0] if self.id_cols else "event_id"
            df = ordering.dense_index(cut_lineage(df), name)
            out.insert(0, F.col(name))
        if has_label and self.label_col in present:
            out.append(encode_label(F.col(self.label_col).cast("string"), self.labels).alias("label_idx"))
        for name in self.feature_order:
            if name not in present:
                value = F.lit(0.0) if name in self.medians else F.lit("0")
            elif name in self.medians:
                number = F.col(name).try_cast("double")
                value = F.coalesce(F.when(~F.isnan(number), number), F.lit(self.medians[name]))
            else:
                value = F.coalesce(F.col(name).cast("string"), F.lit(self.modes[name]))
            out.append(value.alias(name))
        return df.select(*out)

    def save(self, spark: SparkSession, path: str) -> None:
        save_state(spark, path, "prep", STATE_VERSION, dict(self.__dict__))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "PrepModel":
        return cls(**load_state(spark, path, "prep", STATE_VERSION))


def fit_prep(df: DataFrame, id_cols: list[str], text_cols: list[str], label_col: str | None,
             missing_threshold: float = MISSING_THRESHOLD) -> PrepModel:
    features = feature_columns(df, id_cols, text_cols, label_col)
    dropped = sparse_columns(df, features, missing_threshold)
    kept = [c for c in features if c not in dropped]
    numeric = numeric_columns(df, kept)
    categorical = [c for c in kept if c not in numeric]
    modes = {r["column"]: r["value"] for r in categorical_modes(df, categorical).collect()}
    return PrepModel(
        id_cols=list(id_cols), text_cols=list(text_cols), label_col=label_col,
        numeric=numeric, categorical=categorical, feature_order=kept, dropped=sorted(dropped),
        medians=numeric_medians(df, numeric), modes=modes,
        labels=fit_labels(df, label_col) if label_col else [],
    )
