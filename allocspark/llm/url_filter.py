"""Allow and block entries for URLs, matched in a trie.

A trie over reversed host labels (``com``, ``example``, ``www``) holds at each node a trie over path
segments; an entry is a leaf of the second. One walk along the host and, at every node on the way,
along the path finds all entries that fit, and the longest of them gives the verdict.
The trie goes to every task as a broadcast of checked size: entries beyond that size are dealt by
their hash to several tries, applied one after the other, each keeping the longer match.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from allocspark.llm.common import cut_lineage, free_name, replace_columns, schema_with

#: Bytes of hosts and paths in one broadcast trie, at most (but for one entry larger than that).
TRIE_BYTES = 8_000_000
VERDICTS = ("allow", "block")
RESULTS = ["host", "path", "rule", "verdict"]
#: A match; greater ones are longer.
MATCH = "struct<labels: int, length: int, rule: string, verdict: string>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """(host, path): what lies behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased, and from there up to ``?``, ``#`` or the end. Both empty for null or without ``://``."""
    host = F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


class Trie:
    """Entries (host, path, verdict); of entries with equal host and path, block wins."""

    def __init__(self, entries: Iterable[tuple[str, str, str]] = ()) -> None:
        self.root = [{}, None]
        for host, path, verdict in entries:
            self.add(host, path, verdict)

    def add(self, host: str, path: str, verdict: str) -> None:
        # A host node: [nodes by label, path node or None]. A path node: [nodes by segment, entries by
        # the beginning of the next segment, lengths of such beginnings with the longest first].
        node = self.root
        for label in reversed(host.split(".")) if host else ():
            node = node[0].setdefault(label, [{}, None])
        if node[1] is None:
            node[1] = [{}, {}, []]
        here = node[1]
        *whole, last = path.split("/")
        for segment in whole:
            here = here[0].setdefault(segment, [{}, {}, []])
        if here[1].get(last, ("",))[0] != "block":
            here[1][last] = (verdict, host + path, len(path))
        if len(last) not in here[2]:
            here[2] = sorted([*here[2], len(last)], reverse=True)

    def find(self, host: str, path: str) -> tuple[int, int, str, str] | None:
        """(number of host labels, length of the path, entry, verdict) of the longest entry that fits:
        most host labels first, then the longest path."""
        best, node, segments = None, self.root, path.split("/")
        labels = host.split(".") if host else []
        for depth in range(len(labels) + 1):
            if depth:
                node = node[0].get(labels[-depth])
                if node is None:
                    break
            if node[1] is not None and (found := self._along(node[1], segments)):
                best = (depth, found[2], found[1], found[0])
        return best

    @staticmethod
    def _along(node: list, segments: list[str]) -> tuple[str, str, int] | None:
        best, last = None, len(segments) - 1
        for place, segment in enumerate(segments):
            for length in node[2]:
                if length <= len(segment) and (found := node[1].get(segment[:length])):
                    best = found
                    break
            if place == last or (node := node[0].get(segment)) is None:
                break
        return best


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """Entries given as (verdict, host, path)."""
    return spark.createDataFrame([tuple(r) for r in rules], "verdict string, host string, path string")


def _clean(rules: DataFrame) -> DataFrame:
    host = F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER)
    checked = F.when(F.col("verdict").isin(*VERDICTS), F.col("verdict")).otherwise(
        F.raise_error(F.concat(F.lit("neither allow nor block: "), F.coalesce("verdict", F.lit("null")))))
    return rules.select(host.alias("host"), F.coalesce("path", F.lit("")).alias("path"), checked.alias("verdict")).groupBy(
        "host", "path").agg(F.max("verdict").alias("verdict"))


def judge_urls(df: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow",
               trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """Every row of ``df`` with host, path, rule and verdict.

    ``rules`` has columns verdict (allow or block), host and path. An entry fits its host and all
    subdomains (an empty or null host: every host) where the path begins with its path. Of those that
    fit, that with most host labels and then the longest path gives the verdict; of entries with equal
    host and path, block wins. A url that none fits, also a null, empty or malformed one, has a null
    rule and the verdict ``default``: what nobody blocks is allowed. Rows are judged one by one, so
    repeated rows and ties are alike and an empty table stays empty; without rules all get
    ``default``. Input columns named like a result column are replaced, unless it is ``url_col``,
    which then gives way to the result.
    """
    entries = cut_lineage(_clean(rules))
    size = entries.agg(F.sum(F.octet_length("host") + F.octet_length("path"))).first()[0] or 0
    blocks = max(1, -(-int(size) // trie_bytes))
    block = F.pmod(F.xxhash64("host", "path"), F.lit(blocks))
    url, best, found = (free_name(df, name) for name in ("_url", "_best", "_found"))
    host, path = host_and_path(F.col(url))
    kept = replace_columns(df.withColumn(url, F.col(f"`{url_col}`").cast("string")), RESULTS)
    judged = kept.withColumns({"host": host, "path": path, best: F.lit(None).cast(MATCH)})
    for number in range(blocks):
        if number:
            judged = cut_lineage(judged)  # one trie at a time in memory
        judged = _matched(judged, entries.where(block == number), found)
        judged = judged.withColumn(best, F.greatest(best, found)).drop(found)
    return judged.withColumns({
        "rule": F.col(f"{best}.rule"), "verdict": F.coalesce(f"{best}.verdict", F.lit(default))}).drop(url, best)


def _matched(df: DataFrame, entries: DataFrame, found: str) -> DataFrame:
    """``df`` with the longest match among ``entries``, a part of at most about ``trie_bytes``."""
    trie = df.sparkSession.sparkContext.broadcast(Trie((e.host, e.path, e.verdict) for e in entries.toLocalIterator()))
    kind = pa.struct([("labels", pa.int32()), ("length", pa.int32()), ("rule", pa.string()), ("verdict", pa.string())])
    host_at, path_at = df.columns.index("host"), df.columns.index("path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matches = [trie.value.find(h, p) for h, p in zip(batch.column(host_at).to_pylist(), batch.column(path_at).to_pylist())]
            rows = [None if m is None else dict(zip(kind.names, m)) for m in matches]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, kind)], names=[*batch.schema.names, found])

    return df.mapInArrow(run, schema_with(df, **{found: MATCH}))


#: The entries of the registered query.
RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
ORACLE_SQL = """
with rules(verdict, host, path) as (values """ + ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES) + """),
cut as (
    select *, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
parts as (
    select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
    from cut)
select page_id, coalesce(p.host, '') as host, coalesce(p.path, '') as path,
    (select r.host || r.path from rules r where (p.host = r.host or p.host like '%.' || r.host) and starts_with(p.path, r.path)
     order by length(r.host) desc, length(r.path) desc limit 1) as rule,
    coalesce((select r.verdict from rules r where (p.host = r.host or p.host like '%.' || r.host) and starts_with(p.path, r.path)
     order by length(r.host) desc, length(r.path) desc limit 1), 'allow') as verdict
from parts p
"""
