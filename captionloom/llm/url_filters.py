"""URL allow and block lists by a trie over reversed host labels and path segments.

The rules are compiled once on the driver into nested dictionaries keyed by host labels from the right and
then by path segments from the left, and broadcast: an executor holds them once. A lookup walks at most as
many levels as the url has labels and segments, whatever the number of rules. The rule list is an argument
of the caller and is refused above MAX_RULES, beyond which it would have to be a table joined on its keys.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
MAX_RULES = 1_000_000
RULES = ((BLOCK, "net/"), (ALLOW, "example.net/en/"), (BLOCK, "example.com/de/"), (ALLOW, "org/fr/"))


class Node:
    """hosts: deeper host labels; paths: deeper path segments; ends: (rest of path, rule, verdict) of rules that end here."""

    __slots__ = ("ends", "hosts", "paths")

    def __init__(self):
        self.hosts: dict[str, Node] = {}
        self.paths: dict[str, Node] = {}
        self.ends: list[tuple[str, str, str]] = []


def build_trie(rules: Iterable[tuple[str, str]]) -> Node:
    """rules: (verdict, host followed by a path that starts with a slash). Of equal rules the later one counts."""
    root = Node()
    for n, (verdict, rule) in enumerate(rules):
        if n >= MAX_RULES:
            raise ValueError(f"more than {MAX_RULES} rules")
        if verdict not in (ALLOW, BLOCK):
            raise ValueError(f"unknown verdict {verdict!r}")
        host, slash, rest = rule.partition("/")
        node = root
        for label in reversed(host.lower().split(".")):
            node = node.hosts.setdefault(label, Node())
        *full, last = rest.split("/") if slash else [""]
        if slash:
            node = node.paths.setdefault("", Node())  # the empty segment before the first slash
        for segment in full:
            node = node.paths.setdefault(segment, Node())
        node.ends = [e for e in node.ends if e[0] != last] + [(last, rule, verdict)]
        node.ends.sort(key=lambda e: -len(e[0]))
    return root


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a url; both empty where there is no url or no '://'."""
    _, there, rest = (url or "").partition("://")
    if not there:
        return "", ""
    cut = min((k for k in map(rest.find, "?#") if k >= 0), default=len(rest))
    host, slash, path = rest[:cut].partition("/")
    return host.translate(LOWER), slash + path


LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def longest(root: Node, host: str, path: str) -> tuple[str, str] | None:
    """Rule and verdict of the longest rule that fits: most host labels, then the longest path."""
    found, node = None, root
    segments = path.split("/")
    for label in reversed(host.split(".")):
        node = node.hosts.get(label)
        if node is None:
            break
        at, depth, here = node, 0, None
        while at is not None:  # deeper nodes are longer paths
            rest = segments[depth] if depth < len(segments) else None
            for last, rule, verdict in at.ends:
                if last == "" or (rest is not None and rest.startswith(last)):
                    here = (rule, verdict)
                    break
            # a full segment of a rule needs the slash that follows it in the url
            at = at.paths.get(rest) if rest is not None and depth < len(segments) - 1 else None
            depth += 1
        found = here or found
    return found


SCHEMA = "page_id long, host string, path string, rule string, verdict string"


def filter_urls(pages: DataFrame, rules: Iterable[tuple[str, str]] = RULES, default: str = ALLOW) -> DataFrame:
    """Judges each row of pages(page_id, url): page_id, host, path, rule, verdict.

    A rule fits its host and all its subdomains if the url's path starts with the rule's path. Of the rules
    that fit, the one with the most host labels counts, then the one with the longest path, whether it
    allows or blocks. Where none fits, rule is null and the verdict is default.

    A null url, or one without '://', has an empty host and path and gets the default. A null page_id and
    repeated rows are kept as they are. Other columns are ignored. An empty table gives no rows.
    """
    trie = pages.sparkSession.sparkContext.broadcast(build_trie(rules))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root = trie.value
        for batch in batches:
            hosts, paths, names, verdicts = [], [], [], []
            for url in batch.column(1).to_pylist():
                host, path = split_url(url)
                rule, verdict = longest(root, host, path) or (None, default)
                hosts.append(host)
                paths.append(path)
                names.append(rule)
                verdicts.append(verdict)
            columns = [batch.column(0), *(pa.array(x, pa.string()) for x in (hosts, paths, names, verdicts))]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "host", "path", "rule", "verdict"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string")).mapInArrow(judge, SCHEMA)


URL_FILTERS_SQL = """
WITH p AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), q AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p
), h AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM q
), r AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM h
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""
