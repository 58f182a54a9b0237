"""Allow and block lists for urls, as a trie.

Each rule is a host and the start of a path. The trie goes down the host's labels from
the last to the first, and from a host node down the path's segments. A rule fits its
host and all hosts below it, if the url's path starts with the rule's path. Of several
rules that fit, the one with the longest text wins, and block wins between equals.

The rules are broadcast; ``MAX_RULES`` bounds them, and a longer list is refused.
Null urls and urls without ``://`` have an empty host and path and fit no rule.
Repeated rows are judged one by one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

MAX_RULES = 5_000_000

Rule = tuple[str, str, str]  # verdict, host, path


class Trie:
    """Rules by reversed host labels, then by path segments."""

    def __init__(self, rules: Iterable[Rule]):
        self.root: dict = {}
        for verdict, host, path in rules:
            if verdict not in ("allow", "block"):
                raise ValueError(f"verdict must be 'allow' or 'block', not {verdict!r}")
            node = self.root
            for label in reversed(host.lower().split(".")):
                node = node.setdefault(label, {})
            # Paths hang below "/", which no host label contains. The last segment of a
            # rule may be the start of a longer one, so it is kept apart from whole ones.
            node = node.setdefault("/", {})
            *whole, tail = path.split("/")
            for segment in whole:
                node = node.setdefault(segment + "/", {})
            ends = node.setdefault("", {})
            if ends.get(tail, "") != "block":
                ends[tail] = verdict

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """Text of the best rule and its verdict."""
        best: tuple[int, bool, str, str] | None = None
        node, labels = self.root, host.split(".")
        segments = path.split("/")
        for depth in range(len(labels) - 1, -1, -1):
            node = node.get(labels[depth])
            if node is None:
                break
            below = node.get("/")
            if below is None:
                continue
            rule_host, at = ".".join(labels[depth:]), ""
            for i, segment in enumerate(segments):
                for tail, verdict in below.get("", {}).items():
                    if segment.startswith(tail):
                        rule = rule_host + at + tail
                        found = (len(rule), verdict == "block", rule, verdict)
                        if best is None or found > best:
                            best = found
                if i == len(segments) - 1:
                    break
                at += segment + "/"
                below = below.get(segment + "/")
                if below is None:
                    break
        return best and (best[2], best[3])


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host with A to Z lower-cased, and path, both without query and fragment."""
    whole = F.coalesce(F.col(url).cast("string"), F.lit(""))
    rest = F.when(F.instr(whole, "://") > 0, F.substring_index(F.expr(f"substring({_q(url)}, instr({_q(url)}, '://') + 3)"), "#", 1)).otherwise("")
    rest = F.substring_index(rest, "?", 1)
    host = F.substring_index(rest, "/", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, F.substring(rest, F.length(host) + 1, F.length(rest))


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def judge_urls(pages: DataFrame, rules: Sequence[Rule], url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict; columns of these names are replaced."""
    rules = list(rules)
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} are broadcast")
    shared = pages.sparkSession.sparkContext.broadcast(rules)

    @pandas_udf("rule string, verdict string")
    def fit(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        trie = Trie(shared.value)
        for hosts, paths in batches:
            found = [trie.find(h, p) or (None, default) for h, p in zip(hosts, paths)]
            yield pd.DataFrame(found, columns=["rule", "verdict"])

    host, path = host_and_path(url)
    others = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    split = pages.select(*[F.col(_q(c)) for c in others], host.alias("host"), path.alias("path"))
    found = split.withColumn("_fit", fit("host", "path"))
    return found.select(*[_q(c) for c in others], "host", "path", "_fit.rule", "_fit.verdict")
