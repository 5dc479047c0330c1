"""URL rules by a sort-merge range join.

A host reversed label by label and closed by a separator is a key whose
prefixes are the keys of its parent domains. A rule's host and all its
subdomains are then one interval of keys. URLs are dealt by ranges of (key,
path, id) and sorted; each task sweeps its sorted rows together with the sorted
rules and keeps a stack of the rules whose intervals are open. Intervals are
nested or apart, so the stack holds just the rules of the current host's
domains; of these, those whose path starts the URL's path fit, and the longest
rule (host and path together; then the longer host) wins. A host may hold the
separator itself; hosts are compared as written before a rule fits.

The range deal includes a hash of the path and the id: a host with a third of
all rows spreads over many tasks, each of which opens the stack anew at its
first row, and no path, however long, is part of Spark's sample of the keys.
Rules are a list of at most ``MAX_RULES``, which bounds the broadcast.

A null url or one without ``://`` has empty host and path and no rule. Without
a fitting rule the verdict is ``default``. Null ids, repeated ids and repeated
rows are judged like any others. Columns other than id and url are not read.
"""
from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltaic.llm.common import ship

MAX_RULES = 1_000_000
#: Sorts before every character of a host label.
SEPARATOR = "\x01"


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def key_of(host: Column) -> Column:
    """Labels in reverse order, each closed by the separator."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), SEPARATOR), F.lit(SEPARATOR))


def rule_key(host: str) -> str:
    return SEPARATOR.join(reversed(host.split("."))) + SEPARATOR


class Sweep:
    """Stack of open rule intervals over keys that come in ascending order."""

    def __init__(self, rules: Sequence[tuple[str, str, str]]):
        by_key: dict[str, list] = {}
        for verdict, host, path in rules:
            own = (len(host) + len(path), len(host), path, host + path, verdict, host)
            by_key.setdefault(rule_key(host), []).append(own)
        # UTF-8 byte order, as Spark sorts strings.
        self.rules = sorted((key.encode("utf-8"), sorted(own, reverse=True)) for key, own in by_key.items())
        self.next = 0
        self.stack: list[tuple[bytes, list]] = []

    def judge(self, key: str, host: str, path: str) -> tuple[str | None, str | None]:
        """Rule and verdict of a host and path, the host's key not below the one before."""
        raw = key.encode("utf-8")
        while self.next < len(self.rules) and self.rules[self.next][0] <= raw:
            own = self.rules[self.next]
            while self.stack and not own[0].startswith(self.stack[-1][0]):
                self.stack.pop()
            self.stack.append(own)
            self.next += 1
        while self.stack and not raw.startswith(self.stack[-1][0]):
            self.stack.pop()
        best = None
        for _, own in self.stack:
            for rule in own:
                if path.startswith(rule[2]) and (host == rule[5] or host.endswith("." + rule[5])):
                    best = rule if best is None or rule[:2] > best[:2] else best
                    break
        return (best[3], best[4]) if best else (None, None)


def _sweep(rules, names: list[str], batches) -> Iterator[pa.RecordBatch]:
    """Rows ``(id, host, path, key)`` in order of their keys, with rule and verdict."""
    sweep = Sweep(rules.value)
    last: tuple = ()
    for batch in batches:
        rule, verdict = [], []
        hosts, paths, keys = (batch.column(i).to_pylist() for i in (1, 2, 3))
        for host, path, key in zip(hosts, paths, keys, strict=True):
            if (host, path) != last[:2]:
                last = (host, path, sweep.judge(key, host, path))
            rule.append(last[2][0])
            verdict.append(last[2][1])
        columns = [*batch.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=[*names, "rule", "verdict"])


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]],
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
) -> DataFrame:
    """``id, host, path, rule, verdict`` per row; ``rules`` are ``(verdict, host, path)``."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    ship(pages.sparkSession)
    rows = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    rows = rows.withColumn("key", key_of(F.col("host")))
    dealt = rows.repartitionByRange("key", F.xxhash64("path"), id_col).sortWithinPartitions("key", "path")
    shared = pages.sparkSession.sparkContext.broadcast(list(rules))
    schema = T.StructType(dealt.schema.fields + [T.StructField(n, T.StringType()) for n in ("rule", "verdict")])
    run = functools.partial(_sweep, shared, dealt.columns)
    out = dealt.mapInArrow(run, schema).drop("key")
    return out.withColumn("verdict", F.coalesce("verdict", F.lit(default)))
