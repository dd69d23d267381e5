"""URL filter: a trie over reversed host labels, then path segments.

A rule is a host and a path. It fits its host and all subdomains, if the url's path starts
with the rule's. The longest fitting rule (characters of host and path together, then of
the host) decides; of an allow and a block entry for the same host and path, block wins.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coinstrata.llm.common import carried

#: A trie is broadcast up to this many rules; longer lists are split into several tries,
#: which are looked up one after the other.
RULES_PER_TRIE = 200_000

RESULT = "struct<host: string, path: string, rule: string, verdict: string>"


@dataclass(frozen=True)
class Rule:
    """``text`` is the host, then the path from its first slash."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return lower(self.text.partition("/")[0])

    @property
    def path(self) -> str:
        _, slash, rest = self.text.partition("/")
        return slash + rest


#: A-Z only, as in host names.
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def lower(host: str) -> str:
    return host.lower() if host.isascii() else host.translate(_LOWER)


def host_and_path(url: str | None) -> tuple[str, str]:
    """The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end,
    the path what follows up to ``?``, ``#`` or the end. Null, or no ``://``: both empty."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    rest = rest.partition("#")[0].partition("?")[0]
    host, slash, path = rest.partition("/")
    return lower(host), slash + path


#: A node is a list of three: the next nodes by host label or path segment, the node of the
#: empty path below a host, and the rules that end here by their last path segment.
NEXT, PATH, ENDS = range(3)


def _node() -> list:
    return [{}, None, {}]


class UrlTrie:
    """By host label from the right, and from there by whole path segment. The last segment
    of a rule's path need only be a prefix."""

    def __init__(self, rules: list[Rule] = (), root: list | None = None):
        self.root: list = _node() if root is None else root
        for rule in sorted(set(rules), key=lambda r: (r.verdict == "block", r.text)):
            node = self.root
            for label in reversed(rule.host.split(".")):
                node = node[NEXT].setdefault(label, _node())
            if node[PATH] is None:
                node[PATH] = _node()
            node = node[PATH]
            *whole, last = rule.path.split("/")
            for segment in whole:
                node = node[NEXT].setdefault(segment, _node())
            node[ENDS][last] = (
                (len(rule.host) + len(rule.path), len(rule.host)),
                rule.text,
                rule.verdict,
            )

    def longest(self, host: str, path: str) -> tuple | None:
        """((length, host length), rule text, verdict) of the rule that decides."""
        best, node = None, self.root
        for label in reversed(host.split(".")):
            node = node[NEXT].get(label)
            if node is None:
                break
            found = self._in_path(node[PATH], path)
            if found and (best is None or found[0] > best[0]):
                best = found
        return best

    @staticmethod
    def _in_path(node: list | None, path: str) -> tuple | None:
        best = None
        for segment in path.split("/"):
            if node is None:
                break
            for last, found in node[ENDS].items():
                if segment.startswith(last) and (best is None or found[0] > best[0]):
                    best = found
            node = node[NEXT].get(segment)
        return best


def judged(url: Column, rules: list[Rule], spark, default: str = "allow") -> Column:
    """Struct (host, path, rule, verdict) of a url column.

    Null, empty and malformed urls have an empty host and path, fit no rule and get the
    ``default`` verdict with a null rule; so does every url if there are no rules. Very
    long urls are handled whole.
    """
    tries = [
        spark.sparkContext.broadcast(UrlTrie(rules[i : i + RULES_PER_TRIE]).root)
        for i in range(0, len(rules), RULES_PER_TRIE)
    ]

    @F.pandas_udf(RESULT)
    def judge(urls: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        loaded = [UrlTrie(root=t.value) for t in tries]
        for batch in urls:
            out = []
            for url in batch:
                host, path = host_and_path(url)
                found = [m for t in loaded if (m := t.longest(host, path))]
                best = max(found, key=lambda m: (m[0], m[2] == "block"), default=None)
                out.append((host, path, best and best[1], best[2] if best else default))
            yield pd.DataFrame(out, columns=["host", "path", "rule", "verdict"])

    return judge(url)


def judge_urls(
    pages: DataFrame, rules: list[Rule], url: str = "url", default: str = "allow"
) -> DataFrame:
    """``pages`` with the columns host, path, rule and verdict, which replace columns of
    these names. One row out for each row in; repeated rows stay repeated."""
    judgement = judged(pages[url], rules, pages.sparkSession, default)
    row = carried(pages, ["host", "path", "rule", "verdict"])
    return pages.select(row.alias("row"), judgement.alias("judgement")).select("row.*", "judgement.*")
