"""Line dedup: windows of three lines that occurred before are removed, in DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.base import pick, stored

#: Lines of a window.
WINDOW = 3


def _row_key(id_col: str, text_col: str) -> list[Column]:
    """Rows of equal id and text are interchangeable; of equal id alone they are not."""
    return [F.col(id_col), F.xxhash64(text_col).alias("_text")]


def _windows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per window that holds a word: its 128-bit hash, its document and its first line."""
    lines = docs.where(F.instr(text_col, "\n") > 0).select(
        *_row_key(id_col, text_col), F.split(text_col, "\n").alias("_lines"))

    def window(lines: Column) -> Column:
        def hashes(i: Column) -> Column:
            own = [F.get(lines, i + k) for k in range(WINDOW)]
            worded = F.concat(*own).rlike(r"[^\x20\x09-\x0D]")
            return F.struct(F.when(worded, F.xxhash64(F.lit(1), *own)).alias("a"),
                            F.xxhash64(F.lit(2), *own).alias("b"), i.alias("line"))
        return F.transform(F.sequence(F.lit(0), F.size(lines) - WINDOW), hashes)

    made = F.when(F.size("_lines") >= WINDOW, F.transform(F.array("_lines"), window).getItem(0))
    return lines.select(id_col, "_text", F.explode(made).alias("_w")).select(
        F.col("_w.a").alias("_a"), F.col("_w.b").alias("_b"), id_col, "_text", F.col("_w.line").alias("_line")
    ).where(F.col("_a").isNotNull())


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                removed_col: str | None = None) -> DataFrame:
    """The documents without lines that belong to a window seen before.

    A window is three consecutive lines of one text, as they stand; windows of blank lines alone
    do not count. The occurrence of the smallest (document id, line) stays; of every later one
    all three lines go, and overlapping windows are merged. Other lines stay in their order.

    All columns are kept. ``removed_col``, if given, counts the lines removed and replaces a
    column of that name. Null texts stay null; texts of fewer than three lines stay as they are; a
    text all of whose lines go is empty. Null ids come before all others. Rows of equal id and
    equal text are treated alike: neither is later than the other. An empty table stays empty. The
    work in a text grows with its lines; a very long text is one row, as it is in the table.
    """
    at = (docs.columns.index(id_col), docs.columns.index(text_col))
    every = docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])
    narrow = pick(docs, id_col, text_col)
    windows = _windows(narrow, id_col, text_col)
    # partial counts combine before the shuffle, so a window in a third of all texts is a few rows
    first = stored(windows.groupBy("_a", "_b").agg(
        F.count("*").alias("_n"), F.min(F.struct(id_col, "_line")).alias("_first")).where("_n > 1").drop("_n"), "windows")
    # both sides are plain exchanges: a hot window is a skewed join, which is split while it runs
    later = windows.join(first, ["_a", "_b"]).where(F.struct(id_col, "_line") > F.col("_first"))
    covered = later.groupBy(id_col, "_text").agg(F.collect_set("_line").alias("_starts"))

    text, key = F.col(f"_c{at[1]}"), F.col(f"_c{at[0]}")
    covered = covered.select(F.col(id_col).alias("_id"), F.col("_text").alias("_hash"), "_starts")
    joined = every.join(covered, key.eqNullSafe(F.col("_id")) & (F.xxhash64(text) == F.col("_hash")), "left")
    lines = F.split(text, "\n")
    gone = F.array_distinct(F.flatten(F.transform("_starts", lambda s: F.array(*[s + k for k in range(WINDOW)]))))

    def rest(row: Column) -> Column:
        # a set difference of line numbers: work grows with the lines, however many of them go
        kept = F.array_except(F.sequence(F.lit(0), F.size(row["lines"]) - 1), row["gone"])
        return F.struct(F.array_join(F.transform(kept, lambda i: F.get(row["lines"], i)), "\n").alias("text"),
                        F.size(row["gone"]).cast("long").alias("n"))

    row = F.struct(lines.alias("lines"), gone.alias("gone"))
    result = F.when(F.col("_starts").isNotNull(), F.transform(F.array(row), rest).getItem(0))
    joined = joined.withColumn("_rest", result)
    out = [F.when(F.col("_rest").isNull(), text).otherwise(F.col("_rest.text")).alias(c) if i == at[1]
           else F.col(f"_c{i}").alias(c) for i, c in enumerate(docs.columns)
           if removed_col is None or c.lower() != removed_col.lower()]
    if removed_col:
        out.append(F.coalesce(F.col("_rest.n"), F.lit(0)).cast("long").alias(removed_col))
    return joined.select(*out)
