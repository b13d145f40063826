"""URL filter: allow and block rules in a trie of reversed host labels and path segments.

A rule is a host and a path.  It fits a URL when the URL's host is the rule's host
or below it and the URL's path starts with the rule's path.  Of the rules that fit,
the one with most host labels wins, then the one with the longest path; where allow
and block hold the same rule, block wins.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from instructspark.llm.common import lower_ascii, replacing

ALLOW, BLOCK = "allow", "block"

# Rules up to this number are broadcast as a trie; more are joined by host.
MOST_BROADCAST_RULES = 100_000


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


class UrlTrie:
    """Rules by reversed host label, then by path segment.

    The last part of a rule's path may be the beginning of a segment, so a node
    keeps such beginnings by text and the lengths they have.
    """

    def __init__(self, rules: Sequence[Rule]):
        self.root: dict = {"below": {}, "paths": None}
        # Block rules last: they replace an allow rule of the same host and path.
        for rule in sorted(rules, key=lambda r: r.verdict):
            self._add(rule)

    def _add(self, rule: Rule) -> None:
        node = self.root
        for label in reversed(rule.host.split(".")) if rule.host else ():
            node = node["below"].setdefault(label, {"below": {}, "paths": None})
        if node["paths"] is None:
            node["paths"] = {"below": {}, "starts": {}, "lengths": []}
        place = node["paths"]
        *segments, start = rule.path.split("/")
        for segment in segments:
            place = place["below"].setdefault(segment, {"below": {}, "starts": {}, "lengths": []})
        place["starts"][start] = rule
        place["lengths"] = sorted({len(s) for s in place["starts"]}, reverse=True)

    @staticmethod
    def _longest_path(place: dict, path: str) -> Rule | None:
        best = None
        for segment in path.split("/"):
            for length in place["lengths"]:
                if length <= len(segment) and segment[:length] in place["starts"]:
                    best = place["starts"][segment[:length]]
                    break
            place = place["below"].get(segment)
            if place is None:
                break
        return best

    def match(self, host: str, path: str) -> Rule | None:
        """The rule that decides, or None."""
        node, best = self.root, None
        labels = reversed(host.split(".")) if host else iter(())
        while node is not None:
            if node["paths"] is not None:
                best = self._longest_path(node["paths"], path) or best
            label = next(labels, None)
            node = node["below"].get(label) if label is not None else None
        return best


def url_host(url: Column) -> Column:
    """From behind the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return lower_ascii(F.coalesce(host, F.lit("")))


def url_path(url: Column) -> Column:
    """From behind the host to ``?``, ``#`` or the end."""
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(path, F.lit(""))


def _by_trie(df: DataFrame, rules: Sequence[Rule], default: str) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(UrlTrie(rules))

    @F.pandas_udf("rule string, verdict string")
    def judge(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        trie = shared.value
        found = [trie.match(h, p) for h, p in zip(host, path, strict=True)]
        return pd.DataFrame(
            {
                "rule": [r.name if r else None for r in found],
                "verdict": [r.verdict if r else default for r in found],
            }
        )

    judged = df.withColumn("_judged", judge("host", "path"))
    return judged.select("*", "_judged.rule", "_judged.verdict").drop("_judged")


def _by_join(df: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """The same without a trie: URLs meet rules on each parent domain of their host."""
    asked = df.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    parents = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))),
    )
    parents = F.array_distinct(F.concat(parents, F.array(F.lit(""))))
    lines = asked.select("host", "path", F.explode(parents).alias("_host"))
    known = rules.select(
        F.col("host").alias("_host"), F.col("path").alias("_path"), F.col("verdict").alias("_verdict")
    )
    depth = F.when(F.col("_host") == "", F.lit(0)).otherwise(F.size(F.split("_host", r"\.")))
    met = lines.join(known, "_host").where(F.col("path").startswith(F.col("_path")))
    best = met.groupBy("host", "path").agg(
        F.max(
            F.struct(
                depth.alias("depth"),
                F.length("_path").alias("length"),
                F.col("_verdict").alias("verdict"),
                F.concat("_host", "_path").alias("rule"),
            )
        ).alias("_best")
    )
    verdict = F.coalesce(F.col("_best.verdict"), F.lit(default))
    joined = df.join(best, ["host", "path"], "left")
    columns = [F.col(f"`{c}`") for c in df.columns]
    return joined.select(*columns, F.col("_best.rule").alias("rule"), verdict.alias("verdict"))


def filter_urls(
    df: DataFrame,
    rules: Sequence[Rule] | DataFrame,
    url: str = "url",
    default: str = ALLOW,
    most_broadcast: int = MOST_BROADCAST_RULES,
) -> DataFrame:
    """Adds ``host, path, rule, verdict`` to each row.

    ``rules`` are Rules, or a table with ``host, path, verdict``; host labels are
    compared in lower case.  Up to ``most_broadcast`` rules are broadcast as a trie;
    beyond that the URLs are joined to the rules table by parent domain.

    A NULL URL or one without ``://`` has an empty host and path and gets the default
    verdict unless a rule has an empty host and path.  ``rule`` is NULL where none
    fits.  Repeated rows are judged alike, an empty table gives an empty one, and
    input columns named like a result are replaced by it.
    """
    spark = df.sparkSession
    if df.columns.count(url) != 1:
        raise ValueError(f"no single column {url}")
    df = df.withColumn("_url", F.col(f"`{url}`"))
    keep = replacing(df, ["host", "path", "rule", "verdict"])
    parsed = keep.withColumns({"host": url_host(F.col("_url")), "path": url_path(F.col("_url"))})
    parsed = parsed.drop("_url")
    if isinstance(rules, DataFrame):
        rules = rules.select(lower_ascii(F.col("host")).alias("host"), "path", "verdict")
        rules = rules.where(F.col("host").isNotNull() & F.col("path").isNotNull())
        taken = rules.limit(most_broadcast + 1).count()
        if taken > most_broadcast:
            return _by_join(parsed, rules, default)
        listed = [Rule(r["host"], r["path"], r["verdict"]) for r in rules.collect()]
    else:
        listed = [Rule(r.host.lower(), r.path, r.verdict) for r in rules]
        if len(listed) > most_broadcast:
            table = spark.createDataFrame(
                [(r.host, r.path, r.verdict) for r in listed],
                "host string, path string, verdict string",
            )
            return _by_join(parsed, table, default)
    return _by_trie(parsed, listed, default)
