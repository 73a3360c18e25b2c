"""URL allow and block rules by a sort-merge range join.

A host's canonical key is its labels in reverse order, each closed by a separator below any label character,
so that a rule's host and all its subdomains are one interval of keys. Pages are range-partitioned and
sorted by (key, path, id): a hot host, or one url on many pages, spans several partitions. Each task sweeps
its sorted pages and the sorted rule hosts together and keeps a stack of the rule hosts whose interval is
open; on each level the rules' paths are nested prefixes, found by bisection.

A rule fits its host and all subdomains if the url's path starts with the rule's path. The longest rule
(host and path together) wins, the longer host among equals, then block. No rule fits: the default verdict.
Rules are broadcast in groups of about ``GROUP_RULES``, dealt by host and path, so that a host of many rules is spread over
them; a task prepares each group once, and one sorted pass serves all.

Null urls and urls without ``://`` have an empty host and path; rules without host are ignored, a null rule
path is empty (any path). Repeated pages keep their rows.
"""

from __future__ import annotations

from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapflow.llm.common import partitions

GROUP_RULES = 200_000
NONE = ((-1, -1), None, None)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """The text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """The text after the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels in reverse order, each followed by the separator; empty for an empty host."""
    return F.when(host == "", F.lit("")).otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "\x01"), F.lit("\x01")))


class _Level:
    """The rules of one host: sorted paths, each with its longest proper prefix among them."""

    def __init__(self, key: str, host: str, rules: dict[str, str]) -> None:
        self.key, self.size, self.host = key, len(host), host
        self.paths = sorted(rules)
        self.verdicts = [rules[p] for p in self.paths]
        self.up, stack = [], []
        for i, p in enumerate(self.paths):
            while stack and not p.startswith(self.paths[stack[-1]]):
                stack.pop()
            self.up.append(stack[-1] if stack else -1)
            stack.append(i)

    def longest(self, path: str) -> int:
        i = bisect_right(self.paths, path) - 1
        while i >= 0 and not path.startswith(self.paths[i]):
            i = self.up[i]
        return i


def _levels(rows: list[tuple]) -> list[_Level]:
    by: dict[tuple[str, str], dict[str, str]] = {}
    for key, host, path, verdict in rows:
        rules = by.setdefault((key, host), {})
        if rules.get(path) != "block":
            rules[path] = verdict
    return [_Level(key, host, rules) for (key, host), rules in sorted(by.items())]


class _Sweep:
    """Walks sorted keys and rule hosts together; ``stack`` holds the rule hosts open at the current key."""

    def __init__(self, rows: list[tuple]) -> None:
        self.levels, self.at, self.stack, self.key = _levels(rows), 0, [], None

    def best(self, key: str, path: str) -> tuple[tuple[int, int], str | None, str | None]:
        """((rule's length, its host's length), rule, verdict) of the longest rule that fits."""
        stack = self.stack
        if key != self.key:
            self.key = key
            while stack and not key.startswith(stack[-1].key):
                stack.pop()
            while self.at < len(self.levels) and self.levels[self.at].key <= key:
                if key.startswith(self.levels[self.at].key):
                    stack.append(self.levels[self.at])
                self.at += 1
        found = NONE
        for level in stack:
            i = level.longest(path)
            if i >= 0:
                prefix = level.paths[i]
                found = max(found, ((level.size + len(prefix), level.size), level.host + prefix, level.verdicts[i]),
                            key=lambda x: x[0])
        return found


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """Per page: id, ``host``, ``path``, ``rule`` (host and path of the winning rule, else null), ``verdict``.

    ``rules`` has the columns host, path, verdict (allow or block).
    """
    spark = pages.sparkSession
    known = rules.select(F.translate("host", _UPPER, _LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"),
                         "verdict").where("host is not null")
    known = known.select(host_key(F.col("host")).alias("key"), "host", "path", "verdict")
    groups = max(1, -(-known.count() // GROUP_RULES))
    parts = []
    for g in range(groups):
        part = known.where(F.pmod(F.xxhash64("key", "path"), F.lit(groups)) == g)
        parts.append(spark.sparkContext.broadcast([tuple(r) for r in part.collect()]))
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).cast("long").alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.select(host_key(F.col("host")).alias("key"), "path", "host", "id")
    rows = rows.repartitionByRange(partitions(pages), "key", "path", "id").sortWithinPartitions("key")

    def run(batches):
        sweeps = [_Sweep(part.value) for part in parts]
        for batch in batches:
            where = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            best = [NONE] * batch.num_rows
            for sweep in sweeps:
                best = [max(old, sweep.best(*w), key=lambda x: x[0]) for old, w in zip(best, where, strict=True)]
            yield pa.record_batch([
                batch.column(3), batch.column(2), batch.column(1), pa.array([b[1] for b in best], pa.string()),
                pa.array([b[2] or default for b in best], pa.string())],
                names=[id_col, "host", "path", "rule", "verdict"])

    return rows.mapInArrow(run, f"`{id_col}` long, host string, path string, rule string, verdict string")
