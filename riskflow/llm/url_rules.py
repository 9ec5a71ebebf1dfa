"""URL filters by a sort-merge range join.

A host's labels are reversed into a canonical key, so that a rule's host becomes an interval of keys
that holds the host and all its subdomains, and intervals are nested or apart. URLs and rules are
dealt out by key range (a rule goes to each range that its interval touches), sorted, and swept once
per range with a stack of the rules that are active at the current key.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.llm.common import ascii_lower, column, shuffle_partitions

#: (host, path, verdict)
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_END = "\x01"  # ends a label; its successor ends the interval of a key


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.concat_ws(_END, F.reverse(F.split(host, r"\."))), F.lit(_END))


_EVENT = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("key", T.StringType()),
        T.StructField("is_url", T.BooleanType()),
        T.StructField("id", T.LongType()),
        T.StructField("host", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("rule", T.StringType()),
        T.StructField("verdict", T.StringType()),
    ]
)
_OUT = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("host", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("rule", T.StringType()),
        T.StructField("verdict", T.StringType()),
    ]
)


class _Sweep:
    """The stack of active nested hosts; each has its rules' paths in sorted order."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, str, list[str], dict]] = []

    def rule(self, key: str, host: str, path: str, rule: str, verdict: str) -> None:
        self.leave(key)
        if not self.stack or self.stack[-1][0] != key:
            self.stack.append((key, host, [], {}))
        _, _, paths, found = self.stack[-1]
        if path not in found:
            paths.insert(bisect_left(paths, path), path)
        # Of rules with one host and path the smallest verdict holds ("allow" before "block").
        found[path] = min(found.get(path, (rule, verdict)), (rule, verdict))

    def leave(self, key: str) -> None:
        while self.stack and not key.startswith(self.stack[-1][0]):
            self.stack.pop()

    def find(self, key: str, path: str) -> tuple[str | None, str | None]:
        self.leave(key)
        best: tuple[int, str | None, str | None] = (-1, None, None)
        for _, host, paths, found in reversed(self.stack):
            at = bisect_right(paths, path) - 1
            # Sorted prefixes of ``path`` nest: step back to the longest common prefix until one fits.
            while at >= 0:
                p = paths[at]
                if path.startswith(p):
                    if len(host) + len(p) > best[0]:
                        best = (len(host) + len(p), *found[p])
                    break
                common = 0
                for a, b in zip(p, path, strict=False):
                    if a != b:
                        break
                    common += 1
                at = min(bisect_right(paths, path[:common]) - 1, at - 1)
        return best[1], best[2]


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow", parts: int | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict), a row for each row of ``pages``.

    ``rules`` has host, path, verdict. The rule with the longest ``host + path`` that fits wins; without
    one, ``rule`` is null and ``verdict`` is ``default``. Null urls and urls without ``://`` have an empty
    host and path and fit no rule; repeated rows are judged one by one; rules with a null or empty host
    are left out, a null path counts as ``/``; of rules with one host and path the smallest verdict holds.
    """
    spark = pages.sparkSession
    parts = parts or shuffle_partitions(spark)
    urls = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url")).select(
        "id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    urls = urls.withColumn("key", F.concat(host_key(F.col("host")), F.col("path")))
    # Range borders only balance the work: a bounded sample (50 keys a range) picked by hash.
    sample = [r[0] for r in urls.select("key").orderBy(F.xxhash64("key", "id")).limit(50 * parts).collect()]
    sample.sort(key=str.encode)
    borders = [sample[i * len(sample) // parts].encode() for i in range(1, parts)] if sample else []

    @F.pandas_udf(T.IntegerType())
    def part_of(key: pd.Series, i: pd.Series) -> pd.Series:
        # A key that fills several ranges (one url a third of all rows) is spread over them by id.
        out = []
        for k, n in zip(key, i.fillna(0).astype("int64"), strict=True):
            b = k.encode()
            lo, hi = bisect_left(borders, b), bisect_right(borders, b)
            out.append(lo + int(n) % (hi - lo + 1))
        return pd.Series(out, dtype="int32")

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def parts_of(key: pd.Series) -> pd.Series:
        return pd.Series([list(range(bisect_left(borders, k.encode()), bisect_left(borders, k[:-1].encode() + b"\x02") + 1)) for k in key])

    null = F.lit(None).cast("string")
    url_rows = urls.select(part_of("key", "id").alias("part"), "key", F.lit(True).alias("is_url"), "id", "host", "path", null.alias("rule"), null.alias("verdict"))
    rule_rows = (
        rules.select(ascii_lower(F.col("host")).alias("host"), F.coalesce("path", F.lit("/")).alias("path"), "verdict")
        .filter(F.col("host") != "")
        .select(host_key(F.col("host")).alias("key"), "host", "path", "verdict")
        .select(F.explode(parts_of("key")).alias("part"), "key", F.lit(False).alias("is_url"), F.lit(None).cast("long").alias("id"), "host", "path", F.concat("host", "path").alias("rule"), "verdict")
    )

    def sweep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, at = _Sweep(), None
        for b in batches:
            out: list[tuple] = []
            for part, key, is_url, i, host, path, rule, verdict in zip(*(column(b, f.name).to_pylist() for f in _EVENT), strict=True):
                if part != at:
                    state, at = _Sweep(), part
                if is_url:
                    hit, said = state.find(key, path)
                    out.append((i, host, path, hit, said or default))
                else:
                    state.rule(key, host, path, rule, verdict)
            cols = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), *(pa.array(c, pa.string()) for c in cols[1:])], [f.name for f in _OUT])

    events = url_rows.unionByName(rule_rows).repartition(parts, "part").sortWithinPartitions("part", "key", "is_url")
    return events.mapInArrow(sweep, _OUT)
