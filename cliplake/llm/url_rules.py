"""Allow and block rules for urls: a trie over reversed host labels, then path segments.

A rule ``host/path`` fits its host and all subdomains when the url's path starts with the rule's
path.  The deepest rule wins: the longer host, then the longer path; of two equal ones the block.
Where none fits, the verdict is ``allow``, or what the caller names.

The trie is broadcast in blocks of at most ``BLOCK_RULES`` rules; a larger list gives more blocks,
each looked up in the same pass, and the best of the blocks' answers wins.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_RULES = 500_000
HOST = r"(?s)^.*?://([^/?#]*)"
PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Trie:
    """Nodes are dicts by label or segment; key None holds the path tree, key "" the rules."""

    def __init__(self, rules: Iterable[tuple[str, str, str]]) -> None:
        self.root: dict = {}
        for host, path, verdict in rules:
            node = self.root
            for label in reversed(host.split(".")) if host else ():
                node = node.setdefault(label, {})
            node = node.setdefault(None, {})
            *segments, tail = path.split("/")
            for segment in segments:
                node = node.setdefault(("segment", segment), {})
            # What follows the last slash may be the beginning of a segment.
            tails = node.setdefault("rules", {})
            tails[tail] = "block" if "block" in (verdict, tails.get(tail)) else verdict

    def find(self, host: str, path: str) -> tuple[str, str, str] | None:
        """(rule host, rule path, verdict) of the deepest rule that fits."""
        labels = host.split(".") if host else []
        node, depth, found = self.root, 0, None
        while True:
            hit = self._in_paths(node[None], path) if None in node else None
            if hit:
                found = (".".join(labels[len(labels) - depth :]), *hit)
            if depth == len(labels) or (node := node.get(labels[-1 - depth])) is None:
                return found
            depth += 1

    @staticmethod
    def _in_paths(node: dict, path: str) -> tuple[str, str] | None:
        segments, done, found = path.split("/"), "", None
        for i, segment in enumerate(segments):
            for tail in sorted(node.get("rules", ()), key=len, reverse=True):
                # A tail has no slash, so it fits where this segment starts with it.
                if segment.startswith(tail):
                    found = (done + tail, node["rules"][tail])
                    break
            if i == len(segments) - 1 or (node := node.get(("segment", segment))) is None:
                break
            done += segment + "/"
        return found


FOUND = T.StructType([T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())])


def url_parts(df: DataFrame, url: str = "url", host: str = "host", path: str = "path") -> DataFrame:
    """Add host (A-Z lower-cased) and path; both empty for a null url or one without ``://``."""
    text = F.coalesce(F.col(f"`{url}`"), F.lit(""))
    return df.withColumns(
        {
            host: F.translate(F.regexp_extract(text, HOST, 1), UPPER, LOWER),
            path: F.regexp_extract(text, PATH, 1),
        }
    )


def judged(
    df: DataFrame,
    rules: list[tuple[str, str, str]],
    url: str = "url",
    default: str = "allow",
    keep: list[str] | None = None,
) -> DataFrame:
    """``keep`` columns (all by default, as struct ``row``), host, path, rule and verdict per url.

    ``rules`` are (host, path, verdict); rule is ``host`` + ``path`` or null.  A null, empty or broken
    url has an empty host, which only rules without a host fit.  Repeated rows are judged each.
    """
    blocks = [rules[i : i + BLOCK_RULES] for i in range(0, len(rules), BLOCK_RULES)] or [[]]
    tries = [df.sparkSession.sparkContext.broadcast(Trie(block)) for block in blocks]
    names = df.columns if keep is None else keep
    parts = url_parts(
        df.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"), F.col(f"`{url}`").alias("url"))
    ).select("row", "host", "path")
    schema = T.StructType([*parts.schema.fields, *FOUND.fields])

    def best(host: str, path: str) -> tuple[str | None, str]:
        hits = [hit for trie in tries if (hit := trie.value.find(host, path))]
        if not hits:
            return None, default
        rule_host, rule_path, verdict = max(hits, key=lambda h: (len(h[0]), len(h[1]), h[2] == "block"))
        return rule_host + rule_path, verdict

    def run(batches):
        for batch in batches:
            out = [
                best(host, path)
                for host, path in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([r for r, _ in out], pa.string()), pa.array([v for _, v in out], pa.string())],
                schema.fieldNames(),
            )

    return parts.mapInArrow(run, schema)
