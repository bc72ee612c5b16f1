"""Allow and block rules for URLs in a trie of reversed host labels and path segments.

A rule is a host and the start of a path. Its host labels, from the last one
back, lead to a node; whole path segments lead on from there; what follows the
last slash of the rule may be part of a segment and is kept at the node where
it begins. A URL walks down its own labels and segments once, and the longest
rule met on the way decides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import arrow_map, letters_lower, stage

#: Rules that are broadcast at once; more are applied in blocks, one pass each.
BLOCK_RULES = 100_000


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): the host from behind the first ``://`` to ``/``, ``?``, ``#``
    or the end, A-Z lowered; the path from there to ``?``, ``#`` or the end."""
    rest = (url or "").partition("://")[2]
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host, rest = rest[:end], rest[end:]
    end = min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))
    return host.encode("utf-8", "surrogatepass").translate(letters_lower).decode("utf-8", "surrogatepass"), rest[:end]


class Trie:
    """Nodes are [labels, segments, starts]; starts maps the open end of a path to (rule, action)."""

    def __init__(self, rules):
        self.root = [{}, {}, {}]
        for host, path, action in rules:
            node = self.root
            for label in reversed(host.split(".")):
                node = node[0].setdefault(label, [{}, {}, {}])
            whole, _, start = path.rpartition("/")
            for segment in whole.split("/") if "/" in path else ():
                node = node[1].setdefault(segment, [{}, {}, {}])
            rule = (host + path, action)
            # of an allow and a block rule for the same place, the block rule counts
            node[2][start] = max(node[2].get(start, rule), rule, key=lambda r: r[1])

    def longest(self, host: str, path: str) -> tuple[str, str] | None:
        """The longest (rule, action) that fits, or None."""
        if not host:
            return None
        best, node = None, self.root
        segments = path.split("/")
        for label in reversed(host.split(".")):
            node = node[0].get(label)
            if node is None:
                break
            at = node
            for k, segment in enumerate(segments):
                # the rest of the path starts with this segment; an open end is
                # shorter than its segment or equal to it
                starts = at[2]
                if starts:
                    for n in {len(s) for s in starts}:
                        found = starts.get(segment[:n]) if n <= len(segment) else None
                        if found and (best is None or (len(found[0]), found[1]) > (len(best[0]), best[1])):
                            best = found
                at = at[1].get(segment) if k + 1 < len(segments) else None
                if at is None:
                    break
        return best


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", key: str = "page_id",
          url: str = "url", block_rules: int = BLOCK_RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict), one row per row of ``pages``.

    ``rules`` has columns host, path and action (allow or block); rules with a
    null host or action are ignored and a null path is empty. A rule fits its
    host and all subdomains if the URL's path starts with the rule's path; the
    longest rule wins, and a block rule over an allow rule for the same place.
    Without a fitting rule the verdict is ``default`` and rule is null. A null
    URL, or one without ``://``, has empty host and path. Repeated and null
    keys keep one row each; other columns are not read.
    """
    rules = stage(rules.where("host IS NOT NULL AND action IS NOT NULL").select(
        "host", F.coalesce("path", F.lit("")).alias("path"), "action").distinct(), "rules")
    blocks = max(1, -(-rules.count() // block_rules))
    found = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"),
                         F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    kind = dict(found.dtypes)["page_id"]
    for b in range(blocks):
        part = rules.where(F.pmod(F.xxhash64("host", "path"), F.lit(blocks)) == b).collect()
        trie = pages.sparkSession.sparkContext.broadcast(Trie(map(tuple, part)))

        def walk(rows, trie=trie):
            for page, address, rule, verdict in rows:
                best = trie.value.longest(*split_url(address))
                if best and (rule is None or (len(best[0]), best[1]) > (len(rule), verdict)):
                    rule, verdict = best
                yield page, address, rule, verdict

        found = arrow_map(found, walk, f"page_id {kind}, url string, rule string, verdict string")
        if b + 1 < blocks:
            found = stage(found, "judged")

    def parts(rows):
        for page, address, rule, verdict in rows:
            yield page, *split_url(address), rule, verdict or default

    return arrow_map(found, parts, f"page_id {kind}, host string, path string, rule string, verdict string")
