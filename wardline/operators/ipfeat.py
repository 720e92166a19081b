"""IP behaviour statistics, topology columns and activity windows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.functions import ip as ipx
from wardline.operators import ordering
from wardline.operators.joins import lookup, with_heavy
from wardline.session import cut_lineage

# Output names of the statistics.
SRC_STATS = {
    "dst_ip": "src_dst_ip_count", "src_port": "src_port_count",
    "product_name": "src_product_count", "pipeline": "src_pipeline_count",
}
SRC_SPAN, SRC_TOTAL = "src_time_span", "src_total_events"
DST_STATS = {"src_ip": "dst_src_ip_count", "src_port": "dst_port_count"}
DST_TOTAL = "dst_total_events"


def _span_seconds(df: DataFrame, c: str):
    if isinstance(df.schema[c].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        micros = F.timestamp_diff("MICROSECOND", F.min(c), F.max(c))
        return micros / F.lit(1e6)
    return (F.max(c) - F.min(c)).cast("double")


def _distinct_counts(df: DataFrame, key: str, measured: dict[str, str], extra: list) -> DataFrame:
    """Distinct values per key and column plus plain aggregates.

    Rows are first reduced to one per (key, column, value): a hot address is spread by
    its values before the second, small aggregation.
    """
    if not measured:
        return df.where(F.col(key).isNotNull()).groupBy(key).agg(*extra)
    named = df.where(F.col(key).isNotNull())
    totals = named.groupBy(key).agg(*extra)
    pairs = (
        named.select(key, *[F.col(c).cast("string").alias(o) for c, o in measured.items()])
        .unpivot([key], list(measured.values()), "stat", "value").where(F.col("value").isNotNull())
        .distinct()
    )
    counted = pairs.groupBy(key).agg(
        *[F.count(F.when(F.col("stat") == o, 1)).alias(o) for o in measured.values()]
    )
    return totals.join(counted, key, "left").select(
        key, *[F.coalesce(F.col(o), F.lit(0)).alias(o) for o in measured.values()],
        *[c for c in totals.columns if c != key],
    )


def src_ip_behavior(df: DataFrame, ts_col: str = "timestamp", skip_if_src_host: bool = True) -> DataFrame | None:
    """Statistics per src_ip over the columns that exist; none when src_host is present."""
    if "src_ip" not in df.columns or (skip_if_src_host and "src_host" in df.columns):
        return None
    measured = {c: o for c, o in SRC_STATS.items() if c in df.columns}
    extra = [F.count("*").alias(SRC_TOTAL)]
    if ts_col in df.columns:
        extra.insert(0, _span_seconds(df, ts_col).alias(SRC_SPAN))
    return _distinct_counts(df, "src_ip", measured, extra)


def dst_ip_behavior(df: DataFrame) -> DataFrame | None:
    """Statistics per dst_ip; ``dst_port_count`` counts source ports."""
    if "dst_ip" not in df.columns:
        return None
    measured = {c: o for c, o in DST_STATS.items() if c in df.columns}
    return _distinct_counts(df, "dst_ip", measured, [F.count("*").alias(DST_TOTAL)])


@dataclass
class IpBehaviorModel:
    """Statistics per address and the medians used for addresses never seen."""

    src: DataFrame | None
    dst: DataFrame | None
    src_defaults: dict[str, float] = field(default_factory=dict)
    dst_defaults: dict[str, float] = field(default_factory=dict)

    def default_stats(self) -> dict[str, float]:
        return {**self.src_defaults, **self.dst_defaults}

    def transform(self, df: DataFrame) -> DataFrame:
        """Left joins on the addresses; sizes and skew are left to adaptive execution."""
        out = df
        for key, table, defaults in (("src_ip", self.src, self.src_defaults), ("dst_ip", self.dst, self.dst_defaults)):
            if table is None:
                continue
            out = lookup(out, table, key, defaults)
        return out

    def feature_names(self) -> list[str]:
        return [*self.src_defaults, *self.dst_defaults]


def ip_default_stats(stats: DataFrame, key: str) -> dict[str, float]:
    cols = [c for c in stats.columns if c != key]
    found = ordering.medians(stats, cols)
    return {c: 1.0 if found[c] is None else float(found[c]) for c in cols}


def fit_ip_behavior(df: DataFrame, ts_col: str = "timestamp", skip_if_src_host: bool = True) -> IpBehaviorModel:
    src, dst = src_ip_behavior(df, ts_col, skip_if_src_host), dst_ip_behavior(df)
    as_double = lambda t, key: t.select(key, *[F.col(c).cast("double").alias(c) for c in t.columns if c != key])
    # Written once: the medians and every later lookup read the small tables, not the events.
    src = cut_lineage(as_double(src, "src_ip")) if src is not None else None
    dst = cut_lineage(as_double(dst, "dst_ip")) if dst is not None else None
    marked = lambda t, count: with_heavy(t, count) if t is not None else None
    return IpBehaviorModel(
        marked(src, SRC_TOTAL), marked(dst, DST_TOTAL),
        ip_default_stats(src, "src_ip") if src is not None else {},
        ip_default_stats(dst, "dst_ip") if dst is not None else {},
    )


def with_addresses(df: DataFrame, derive, **addresses: str) -> DataFrame:
    """Parse each address once, then add the columns ``derive`` makes from {name: (number, v6)}."""
    parsed, pairs = {}, {}
    for name, c in addresses.items():
        parsed[f"__{name}_number"], parsed[f"__{name}_v6"] = ipx.ip_long(F.col(c)), ipx.is_ipv6(F.col(c))
        pairs[name] = (F.col(f"__{name}_number"), F.col(f"__{name}_v6"))
    return df.withColumns(parsed).withColumns(derive(pairs)).drop(*parsed)


def private_columns(df: DataFrame, **addresses: str) -> DataFrame:
    return with_addresses(df, lambda a: {f"is_private_{n}": ipx.private_flag(*p) for n, p in a.items()}, **addresses)


def prefix_columns(df: DataFrame, bits=(16, 24), **addresses: str) -> DataFrame:
    return with_addresses(
        df, lambda a: {f"{n}_prefix_{b}": ipx.network(*p, b) for n, p in a.items() for b in bits}, **addresses)


def _same_subnet(pairs, bits: int, strict: bool):
    """1 if both lie in one /bits network.

    Two invalid addresses (or two IPv6 ones) share the marker value and count as equal
    unless ``strict`` asks for valid IPv4 on both sides.
    """
    equal = ipx.network(*pairs["src"], bits) == ipx.network(*pairs["dst"], bits)
    if strict:
        equal = equal & pairs["src"][0].isNotNull() & pairs["dst"][0].isNotNull()
    return equal.cast("int")


def same_subnet(df: DataFrame, src: str = "src_ip", dst: str = "dst_ip", bits=(24, 16), strict: bool = False) -> DataFrame:
    return with_addresses(df, lambda a: {f"is_same_subnet_{b}": _same_subnet(a, b, strict) for b in bits}, src=src, dst=dst)


def ip_topology(df: DataFrame, src: str = "src_ip", dst: str = "dst_ip", strict: bool = False) -> DataFrame:
    def derive(a):
        return {
            **{f"is_private_{n}": ipx.private_flag(*p) for n, p in a.items()},
            **{f"is_same_subnet_{b}": _same_subnet(a, b, strict) for b in (24, 16)},
        }

    return with_addresses(df, derive, src=src, dst=dst)


def ip_prefix_columns(df: DataFrame, src: str = "src_ip", dst: str = "dst_ip") -> DataFrame:
    return prefix_columns(df, src=src, dst=dst)


def ip_octets(df: DataFrame, c: str = "src_ip") -> DataFrame:
    out = {f"octet_{i}": ipx.octet(F.col(c), i) for i in range(1, 5)}
    out["ip_class"] = ipx.address_class(F.col(c))
    return df.withColumns(out)


def ip_entropy(df: DataFrame, key: str = "src_ip", value: str = "dst_ip", out: str = "dst_entropy") -> DataFrame:
    """Shannon entropy in bits of ``value`` per ``key``.

    H = log2(N) - (1/N) * sum(n * log2(n)): two plain aggregations, no join or window.
    """
    counts = (
        df.where(F.col(key).isNotNull() & F.col(value).isNotNull())
        .groupBy(key, value).agg(F.count("*").cast("double").alias("n"))
    )
    entropy = F.log2(F.sum("n")) - F.sum(F.col("n") * F.log2("n")) / F.sum("n")
    return counts.groupBy(key).agg(entropy.alias(out))


def ip_activity_windows(df: DataFrame, ts_col: str, width: str = "1 hour", slide: str | None = None,
                        approximate: bool = False) -> DataFrame:
    """Events and distinct targets per address and time window."""
    span = F.window(F.col(ts_col), width, slide) if slide else F.window(F.col(ts_col), width)
    targets = F.approx_count_distinct("dst_ip") if approximate else F.count_distinct("dst_ip")
    return (
        df.where(F.col("src_ip").isNotNull()).groupBy("src_ip", span.alias("w"))
        .agg(F.count("*").alias("events"), targets.alias("dst_ips"))
        .select("src_ip", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                "events", "dst_ips")
    )
