"""Quality rules: text statistics and learned decision lists, in DataFrame functions alone."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.base import pick

WORD = r"[^\x20\x09-\x0D]+"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Statistics that rules may test; each is a share, a mean or a count of the row's own text.
FEATURES = ["mean_word", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "bang_share", "echo_share"]

_PLACE = 0x7FFFFFFF


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` refers to it."""
    return F.transform(F.array(value), use).getItem(0)


def repeat_words(words: Column) -> Column:
    """Words in windows of three that occur twice or more in the array.

    Windows are first sorted by 33 bits of their hash, with their place in the low 31 bits of the
    same number. Neighbours of equal hash are candidates; only these are compared as text.
    """
    def key(i: Column) -> Column:
        return F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).bitwiseAND(
            F.lit(~_PLACE)).bitwiseOR(i.cast("long"))

    def twins(sorted_keys: Column) -> Column:
        def alike(x: Column, j: Column) -> Column:
            return F.coalesce(F.shiftright(x.bitwiseXOR(F.get(sorted_keys, j - 1)), 31) == 0, F.lit(False)) | F.coalesce(
                F.shiftright(x.bitwiseXOR(F.get(sorted_keys, j + 1)), 31) == 0, F.lit(False))
        return F.transform(F.filter(sorted_keys, alike), lambda x: x.bitwiseAND(F.lit(_PLACE)).cast("int"))

    def gram(i: Column) -> Column:
        return F.struct(F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("gram"),
                        i.alias("place"))

    def repeated(grams: Column) -> Column:
        def alike(x: Column, j: Column) -> Column:
            same = [F.coalesce(x["gram"] == F.get(grams, j + d)["gram"], F.lit(False)) for d in (-1, 1)]
            return same[0] | same[1]
        return F.sort_array(F.transform(F.filter(grams, alike), lambda x: x["place"]))

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(places, j + 1) - p, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, n: total + n)

    keys = F.sort_array(F.transform(F.sequence(F.lit(0), F.size(words) - 3), key))
    compared = bound(keys, twins)

    def count(places: Column) -> Column:
        grams = F.sort_array(F.transform(places, gram))
        return F.when(F.size(places) > 0, bound(bound(grams, repeated), covered))

    return F.when(F.size(words) >= 3, F.coalesce(bound(compared, count), F.lit(0))).otherwise(F.lit(0)).cast("long")


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", extra: tuple[str, ...] = ()) -> DataFrame:
    """Id, ``extra`` columns, BASE counts and FEATURES of every whole text, without moving a row.

    Null and empty texts have no words: every count and feature is 0. Each row is on its own, so
    null and repeated ids pass through; other columns are not read.
    """
    rows = pick(docs, id_col, *extra, text_col).withColumn("_t", F.coalesce(F.col(text_col), F.lit("")))

    def of_words(w: Column) -> Column:
        echo = F.filter(F.sequence(F.lit(0), F.size(w) - 2), lambda i: F.get(w, i) == F.get(w, i + 1))
        return F.struct(
            F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeat_words(w).alias("n_repeat_words"),
            F.when(F.size(w) >= 2, F.size(echo)).otherwise(0).alias("echo"))

    def of_lines(lines: Column) -> Column:
        return F.struct(F.size(lines).alias("n"), (F.size(lines) - F.size(F.array_distinct(lines))).alias("dup"))

    # words and lines are bound inside one expression, so that a filter moved below computes them once too
    worded = F.filter(F.split("_t", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    counted = rows.select(
        id_col, *extra, bound(F.regexp_extract_all("_t", F.lit(WORD), F.lit(0)), of_words).alias("_w"),
        bound(worded, of_lines).alias("_l"), F.regexp_count("_t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("_t", F.lit(r"\p{Lu}")).alias("_upper"), F.regexp_count("_t", F.lit("!")).alias("_bangs"))
    counted = counted.select(
        id_col, *extra, "_w.n_words", "_w.word_chars", "n_symbols", F.col("_l.dup").cast("long").alias("n_dup_lines"),
        "_w.n_repeat_words", F.col("_l.n").alias("_lines"), "_upper", "_bangs", F.col("_w.echo").alias("_echo"))

    def share(part: str, whole: str) -> Column:
        return F.col(part) / F.greatest(F.col(whole), F.lit(1))

    return counted.select(
        id_col, *extra, *BASE, share("word_chars", "n_words").alias("mean_word"),
        share("n_symbols", "n_words").alias("symbol_share"), share("n_dup_lines", "_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"), share("_upper", "word_chars").alias("upper_share"),
        share("_bangs", "n_words").alias("bang_share"), share("_echo", "n_words").alias("echo_share"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass
class Rule:
    """Rows that meet every test (feature, is at least, threshold) get the verdict."""

    verdict: bool
    tests: list[tuple[str, bool, float]] = field(default_factory=list)

    def condition(self) -> Column:
        met = F.lit(True)
        for name, at_least, limit in self.tests:
            met = met & (F.col(name) >= limit if at_least else F.col(name) < limit)
        return met

    def meets(self, row) -> bool:
        return all((row[n] >= t) == up for n, up, t in self.tests)


@dataclass
class DecisionList:
    rules: list[Rule]
    default: bool = True

    def column(self) -> Column:
        """The ordered rules as one conditional expression."""
        verdict = None
        for rule in self.rules:
            verdict = (F.when if verdict is None else verdict.when)(rule.condition(), F.lit(rule.verdict))
        return F.lit(self.default) if verdict is None else verdict.otherwise(F.lit(self.default))


def _grow(rows: list, target: bool, cuts: dict[str, list[float]]) -> Rule:
    """Add the test of the largest information gain until only target rows are covered."""
    rule, covered = Rule(target), rows
    while True:
        good = sum(1 for r in covered if r["_label"] == target)
        if good in (0, len(covered)):
            return rule
        before, best = math.log2(good / len(covered)), (1e-9, None)
        for name, limits in cuts.items():
            ordered = sorted((r[name], r["_label"] == target) for r in covered)
            at = hits = 0
            for limit in limits:
                while at < len(ordered) and ordered[at][0] < limit:
                    hits += ordered[at][1]
                    at += 1
                for up, n, p in ((False, at, hits), (True, len(ordered) - at, good - hits)):
                    if p and n < len(ordered) and (gain := p * (math.log2(p / n) - before)) > best[0]:
                        best = (gain, (name, up, limit))
        if best[1] is None:
            return rule
        rule.tests.append(best[1])
        covered = [r for r in covered if (r[best[1][0]] >= best[1][2]) == best[1][1]]


def _worth(rule: Rule, rows: list) -> tuple[float, int]:
    """(share of target rows, smoothed, number of rows) among the rows that the rule covers."""
    met = [r for r in rows if rule.meets(r)]
    good = sum(1 for r in met if r["_label"] == rule.verdict)
    return (good + 1) / (len(met) + 2), len(met)


def _prune(rule: Rule, rows: list) -> Rule:
    """Drop last tests while that does not lower the rule's worth on rows it was not grown on."""
    best = rule
    for n in range(len(rule.tests) - 1, 0, -1):
        shorter = Rule(rule.verdict, rule.tests[:n])
        if _worth(shorter, rows)[0] >= _worth(best, rows)[0]:
            best = shorter
    return best


def learn(rows: list, target: bool = False, cuts_per_feature: int = 64, least_worth: float = 0.9,
          most_rules: int = 16) -> DecisionList:
    """Sequential covering: grow a rule on two thirds of the open rows, prune it on the rest.

    ``rows``: mappings with FEATURES, ``_label`` (bool) and ``_part`` (0, 1 or 2; 2 prunes). Rules
    reject (``target``); the list ends before a rule that is right in less than ``least_worth`` of the
    pruning rows or, smoothed, clearly less of all open rows. All else is kept.
    """
    rules, left = [], list(rows)
    while len(rules) < most_rules:
        grow, prune = [r for r in left if r["_part"] != 2], [r for r in left if r["_part"] == 2]
        cuts = {}
        for name in FEATURES:
            values = sorted({r[name] for r in grow})
            step = max(1, len(values) // cuts_per_feature)
            cuts[name] = [(a + b) / 2 for a, b in zip(values[::step], values[1::step])]
        rule = _grow(grow, target, cuts)
        if not rule.tests:
            break
        rule = _prune(rule, prune)
        met = [r for r in prune if rule.meets(r)]
        right = sum(1 for r in met if r["_label"] == target)
        if not met or right < least_worth * len(met) or _worth(rule, left)[0] < least_worth - 0.05:
            break
        rules.append(rule)
        left = [r for r in left if not rule.meets(r)]
    return DecisionList(rules, not target)


def fit(docs: DataFrame, labels: DataFrame, use: Column | None = None, most_rows: int = 6000, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "quality") -> DecisionList:
    """Learn from the statistics of at most ``most_rows`` labelled texts, those of the smallest id hashes.

    Texts that fail the base limits are left out, as are null ids and labels; ``use`` says which
    labels may be learned from. Without rows there are no rules and everything is kept.
    """
    known = pick(labels, id_col, label_col).dropna()
    known = known.where(use) if use is not None else known
    few = known.dropDuplicates([id_col]).orderBy(F.xxhash64(id_col), id_col).limit(most_rows)
    some = pick(docs, id_col, text_col).join(F.broadcast(few), id_col)
    # the base limits are applied to the collected rows: as a filter they would move below the
    # join and be computed for every document
    counted = statistics(some, id_col, text_col, (label_col,)).withColumn("_failed", base_failed())
    rows = counted.select(
        id_col, F.pmod(F.xxhash64(F.lit(1), id_col), F.lit(3)).alias("_part"), "_failed",
        (F.col(label_col) == 1).alias("_label"), *FEATURES).collect()
    return learn(sorted((r.asDict() for r in rows if not r["_failed"]), key=lambda r: [r[c] for c in (id_col, *FEATURES)]))


def judge(docs: DataFrame, rules: DecisionList, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, BASE counts, ``base_failed`` and ``kept``: false if the base fails, else the list's verdict."""
    return statistics(docs, id_col, text_col).withColumn("base_failed", base_failed()).select(
        id_col, *BASE, "base_failed", (~F.col("base_failed") & rules.column()).alias("kept"))
