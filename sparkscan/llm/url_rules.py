"""URL filter: a trie over reversed host labels and path segments, sent to all workers.

A rule names a host, its subdomains included, and the beginning of a path. Of the
rules that fit, the one with the most host labels wins, and among those the one
with the longest path; of two equal rules, ``block`` wins.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

MAX_RULE_BYTES = 64 << 20


class UrlRule(NamedTuple):
    verdict: str
    host: str
    path: str


# The rules of the registered query.
RULES = (
    UrlRule("allow", "org", "/"), UrlRule("block", "example.org", "/es/"), UrlRule("block", "example.org", "/en/1"),
    UrlRule("allow", "com", "/fr/"), UrlRule("block", "com", "/de/"),
)


def ascii_lower(text: str) -> str:
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host between the first ``://`` and ``/``, ``?``, ``#``; path from there up to ``?``, ``#``. Else both are empty."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    for mark in "?#":
        rest = rest.partition(mark)[0]
    host, slash, path = rest.partition("/")
    return ascii_lower(host), slash + path


class Trie:
    """Nodes are ``[children by label or segment, path trie or rule ends]``."""

    def __init__(self, rules: Iterable[UrlRule]) -> None:
        self.root: dict = {"next": {}}
        for rule in rules:
            node = self.root
            for label in reversed(rule.host.split(".")):
                node = node["next"].setdefault(label, {"next": {}})
            *segments, end = rule.path.split("/")
            at = node.setdefault("paths", {"next": {}})
            for segment in segments:
                at = at["next"].setdefault(segment, {"next": {}})
            ends = at.setdefault("ends", {})  # beginnings of the next segment
            if end not in ends or rule.verdict == "block":
                ends[end] = rule

    def find(self, host: str, path: str) -> UrlRule | None:
        """The rule with the most host labels, then the longest path, that fits."""
        node, tries = self.root, []
        for label in reversed(host.split(".")):
            node = node["next"].get(label)
            if node is None:
                break
            if "paths" in node:
                tries.append(node["paths"])
        segments = path.split("/")
        for at in reversed(tries):
            best = None
            for segment in segments:
                fits = [e for e in at.get("ends", ()) if segment.startswith(e)]
                if fits:
                    best = at["ends"][max(fits, key=len)]
                at = at["next"].get(segment)
                if at is None:
                    break
            if best is not None:
                return best
        return None


def url_verdicts(df: DataFrame, rules: Iterable[UrlRule] = RULES, key: str = "page_id", url: str = "url", *,
                 default: str = "allow") -> DataFrame:
    """Judge every URL: ``(key, host, path, rule, verdict)``; ``rule`` is host and path of the rule that won, else null.

    A null URL, or one without ``://``, has an empty host and path, which no rule
    fits. Repeated rows give repeated results; other columns are left out.
    Rule sets over 64 MB are refused, as each worker holds the trie.
    """
    rules = list(rules)
    if sum(len(r.host) + len(r.path) for r in rules) > MAX_RULE_BYTES:
        raise ValueError("the rules are too large to be sent to every worker")
    if any(not r.host or not r.path.startswith("/") for r in rules):
        raise ValueError("a rule needs a host, and a path that begins with /")
    shared = df.sparkSession.sparkContext.broadcast([tuple(r) for r in rules])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(UrlRule(*r) for r in shared.value)
        for batch in batches:
            split = [host_and_path(u) for u in batch.column(1).to_pylist()]
            found = [trie.find(*s) for s in split]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([h for h, _ in split], pa.string()), pa.array([p for _, p in split], pa.string()),
                pa.array([r and r.host + r.path for r in found], pa.string()),
                pa.array([r.verdict if r else default for r in found], pa.string())],
                [key, "host", "path", "rule", "verdict"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, url).mapInArrow(run, f"`{key}` {kind}, host string, path string, rule string, verdict string")
