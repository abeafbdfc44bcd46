"""URL filtering with a broadcast trie of allow and block rules.

The trie descends the host's labels from the right, then the path's segments.
The rule that matches most host labels wins; among those, the one that matches
most of the path; a rule given as both allow and block blocks. A URL that no
rule fits gets ``default``.

Defined cases: a null URL, or one without ``://``, has an empty host and path
and only meets rules for every host. Letters A-Z of the host are lower-cased,
the path is taken as it is. Repeated rows are judged one by one. Result columns
replace input columns of the same name; all other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import ascii_lower, ship, unused

MAX_RULE_BYTES = 32 * 1024 * 1024


class Rule(NamedTuple):
    verdict: str  # "allow" or "block"
    host: str  # "" stands for every host
    path: str  # what the URL's path has to start with


class Node:
    """A trie node: its children, and what ends here."""

    __slots__ = ("children", "ends")

    def __init__(self):
        self.children: dict[str, Node] = {}
        self.ends = None

    def descend(self, parts: Iterable[str]) -> Node:
        node = self
        for part in parts:
            node = node.children.setdefault(part, Node())
        return node


def build_trie(rules: Iterable[Rule]) -> Node:
    """Host trie whose nodes hold a path trie in ``ends``.

    A path node's ``ends`` maps the start of the next segment that a rule asks
    for to that rule's text and verdict.
    """
    root, size = Node(), 0
    for rule in rules:
        if rule.verdict not in ("allow", "block"):
            raise ValueError(f"unknown verdict {rule.verdict!r}")
        size += len(rule.host.encode()) + len(rule.path.encode()) + 64
        if size > MAX_RULE_BYTES:
            raise ValueError(f"the rules exceed {MAX_RULE_BYTES} bytes, too many to broadcast")
        labels = rule.host.lower().split(".")[::-1] if rule.host else []
        host = root.descend(labels)
        if host.ends is None:
            host.ends = Node()
        *whole, start = rule.path.split("/")
        path = host.ends.descend(whole)
        if path.ends is None:
            path.ends = {}
        if path.ends.get(start, ("", ""))[1] != "block":
            path.ends[start] = (rule.host + rule.path, rule.verdict)
    return root


def match_path(node: Node, segments: list[str]) -> tuple[str, str] | None:
    best = None
    for depth, segment in enumerate(segments):
        if node.ends:
            for size in range(len(segment), -1, -1):
                if segment[:size] in node.ends:
                    best = node.ends[segment[:size]]
                    break
        if depth + 1 == len(segments):  # the last segment isn't followed by a slash
            break
        node = node.children.get(segment)
        if node is None:
            break
    return best


def match(trie: Node, host: str, path: str) -> tuple[str, str] | None:
    """The text and verdict of the longest rule that fits, or None."""
    met = [trie.ends] if trie.ends else []
    node = trie
    for label in reversed(host.split(".")) if host else ():
        node = node.children.get(label)
        if node is None:
            break
        if node.ends:
            met.append(node.ends)
    segments = path.split("/")
    for paths in reversed(met):
        found = match_path(paths, segments)
        if found:
            return found
    return None


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL, both empty where there is no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    host = ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def judge(
    df: DataFrame, rules: Iterable[Rule], url: str = "url", default: str = "allow"
) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to every row."""
    spark = df.sparkSession
    ship(spark)
    trie = spark.sparkContext.broadcast(build_trie(rules))

    @F.pandas_udf("rule string, verdict string")
    def judged(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        found = [match(trie.value, h, p) or (None, default) for h, p in zip(host, path)]
        return pd.DataFrame(found, columns=["rule", "verdict"])

    host, path = url_parts(F.col(url))
    kept = [c for c in df.columns if c not in ("host", "path", "rule", "verdict")]
    parts = df.select(*kept, host.alias("host"), path.alias("path"))
    both = unused(parts, "judged")
    return parts.withColumn(both, judged("host", "path")).select(
        *kept, "host", "path", f"{both}.rule", f"{both}.verdict"
    )
