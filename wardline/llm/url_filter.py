"""Allow and block rules for urls as a trie over reversed host labels and path segments (URL filters)."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rules in one trie at most, so that its broadcast stays below some hundred MB.
MAX_RULES = 1_000_000


class UrlTrie:
    """A node is [labels below, path trie]; a path node is [segments below, open ends].

    A rule's path is cut at slashes. Its whole segments are edges; what follows the last slash is
    an open end: a prefix of the url's next segment, empty for a path that ends with a slash.
    """

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        """``rules``: (verdict, host, path); of equal host and path the last verdict holds."""
        self.root, self.size = [{}, None], 0
        for verdict, host, path in rules:
            self.size += 1
            if self.size > MAX_RULES:
                raise ValueError(f"more than {MAX_RULES} rules: split them over several passes")
            node = self.root
            for label in reversed(host.lower().split(".")):
                node = node[0].setdefault(label, [{}, None])
            node[1] = paths = node[1] or [{}, {}]
            *whole, last = path.split("/")
            for segment in whole:
                paths = paths[0].setdefault(segment, [{}, {}])
            paths[1][last] = (host.lower() + path, verdict)

    def match(self, host: str, path: str) -> tuple[str | None, str | None]:
        """(rule, verdict) of the longest host, and for it of the longest path, that fit."""
        node, chain = self.root, []
        for label in reversed(host.split(".")):
            node = node[0].get(label)
            if node is None:
                break
            if node[1] is not None:
                chain.append(node[1])
        segments = path.split("/") if chain else []
        for paths in reversed(chain):
            best, at, node = None, 0, paths
            while node is not None and at < len(segments):
                ends, here = node[1], segments[at]
                if ends:
                    best = self._longest(ends, here) or best
                node = node[0].get(here) if at + 1 < len(segments) else None
                at += 1
            if best:
                return best
        return None, None

    @staticmethod
    def _longest(ends: dict, segment: str):
        for n in range(len(segment), -1, -1):
            if segment[:n] in ends:
                return ends[segment[:n]]
        return None


def url_parts(url):
    """(host, path) columns: both empty for a null url or one without ``://``."""
    url = F.coalesce(url, F.lit(""))
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def judge_urls(df: DataFrame, rules: Iterable[tuple[str, str, str]], url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to each row.

    The most specific rule decides, whether it allows or blocks; a row that no rule fits has a
    null rule and the ``default`` verdict. Null urls and urls without ``://`` have an empty host
    and path, which only a rule of an empty host fits. Input columns named like an added one, in
    any case, are replaced. Rows are neither moved nor merged; an empty table stays empty.
    """
    trie = df.sparkSession.sparkContext.broadcast(UrlTrie(rules))

    @F.pandas_udf("rule string, verdict string")
    def judge(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        found = [trie.value.match(h, p) for h, p in zip(hosts, paths)]
        return pd.DataFrame({"rule": [r for r, _ in found], "verdict": [v or default for _, v in found]}, dtype=object)

    added = ["host", "path", "rule", "verdict"]
    at = df.columns.index(url_col)
    flat = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    host, path = url_parts(F.col(f"_c{at}"))
    kept, seen = [], set(added)
    for i, c in enumerate(df.columns):
        if c.lower() not in seen:
            seen.add(c.lower())
            kept.append(F.col(f"_c{i}").alias(c))
    judged = flat.withColumn("host", host).withColumn("path", path).withColumn("_verdict", judge("host", "path"))
    return judged.select(*kept, "host", "path", "_verdict.rule", "_verdict.verdict")
