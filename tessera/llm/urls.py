"""URL filter: a broadcast trie over reversed host labels and path segments.

A rule ``(verdict, host, path)`` fits a URL whose host is the rule's host or
any subdomain of it and whose path starts with the rule's path.  The most
specific fitting rule decides: more host labels first, then the longer path;
an allow and a block rule on the same host and path resolve to block.

Rules are a list on the driver.  They are cut into blocks of at most
``RULES_PER_BLOCK`` rules; each block is one broadcast trie, and the best
match so far is carried from block to block, so the broadcast size is
bounded whatever the number of rules.

Defined cases: a null URL or one without ``://`` has an empty host and path;
an empty path starts with no rule path but the empty one; a URL without a
fitting rule gets ``default``.  Repeated rows are judged one by one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ascii_lower, received, send, ship

RULES_PER_BLOCK = 200_000
MATCH = "depth int, plen int, rule string, verdict string"


def parse_rule(verdict: str, entry: str) -> tuple[str, str, str]:
    """``("block", "example.org/es/")`` -> (verdict, host, path)."""
    host, slash, path = entry.partition("/")
    return verdict, host, slash + path


class Trie:
    """Nested dicts: host labels from the right, then whole path segments.

    The last segment of a rule path is a prefix of the URL's segment at that
    place, kept in ``"ends"`` by text; ``"sizes"`` lists the lengths in use.
    """

    def __init__(self, rules: Sequence[tuple[str, str, str]]):
        self.root: dict = {}
        for verdict, host, path in rules:
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault("labels", {}).setdefault(label, {})
            node = node.setdefault("paths", {})
            *whole, last = path.split("/")
            for seg in whole:
                node = node.setdefault("segments", {}).setdefault(seg, {})
            ends = node.setdefault("ends", {})
            if ends.get(last, (verdict,))[0] != "block":
                ends[last] = (verdict, host + path, len(path))
            elif last not in ends:
                ends[last] = (verdict, host + path, len(path))
            node["sizes"] = sorted({len(e) for e in ends}, reverse=True)

    def find(self, host: str, path: str):
        """(host labels, path length, rule, verdict) of the best rule, or None."""
        node, best, depth = self.root, None, 0
        segs = path.split("/")
        for label in reversed(host.split(".")):
            node = node.get("labels", {}).get(label)
            if node is None:
                break
            depth += 1
            hit = self._path(node.get("paths"), segs)
            if hit:
                best = (depth, hit[2], hit[1], hit[0])  # deeper host wins
        return best

    @staticmethod
    def _path(node, segs):
        best = None
        for seg in segs:
            if node is None:
                break
            for n in node.get("sizes", ()):
                hit = node["ends"].get(seg[:n]) if n <= len(seg) else None
                if hit:
                    best = hit  # deeper segments overwrite: longer path wins
                    break
            node = node.get("segments", {}).get(seg)
        return best


def _matcher(bc):

    def match(frames: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        find = received(bc).find
        for hosts, paths in frames:
            hits = [find(h, p) or (None,) * 4 for h, p in zip(hosts, paths, strict=True)]
            yield pd.DataFrame(hits, columns=["depth", "plen", "rule", "verdict"]).astype(
                {"depth": "Int32", "plen": "Int32"})
    return F.pandas_udf(match, MATCH)


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]], key: str = "page_id",
               url: str = "url", default: str = "allow",
               block: int = RULES_PER_BLOCK) -> DataFrame:
    """One row per input row: ``key, host, path, rule, verdict``.

    ``rules`` are ``(verdict, entry)`` pairs such as ``("block",
    "example.org/es/")``; ``rule`` is the deciding entry or null.
    """
    ship()
    sc = pages.sparkSession.sparkContext
    out = pages.select(
        F.col(key),
        ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))).alias("host"),
        F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit("")).alias("path"))
    best = F.lit(None).cast(f"struct<{MATCH.replace(' ', ':').replace(',:', ',')}>")
    out = out.withColumn("_best", best)
    parsed = [parse_rule(v, e) for v, e in rules]
    for i in range(0, len(parsed), block):
        bc = send(sc, Trie(parsed[i:i + block]))
        hit = _matcher(bc)(F.col("host"), F.col("path"))
        out = out.withColumn("_hit", hit).withColumn("_best", F.when(
            F.col("_hit.rule").isNotNull() & (
                F.col("_best.rule").isNull()
                | (F.struct("_hit.depth", "_hit.plen") > F.struct("_best.depth", "_best.plen"))
                | ((F.struct("_hit.depth", "_hit.plen") == F.struct("_best.depth", "_best.plen"))
                   & (F.col("_hit.verdict") == "block"))),
            F.col("_hit")).otherwise(F.col("_best"))).drop("_hit")
    return out.select(key, "host", "path", F.col("_best.rule").alias("rule"),
                      F.coalesce("_best.verdict", F.lit(default)).alias("verdict"))
