"""URL rules by a sort-merge range join on reversed hosts.

With its labels reversed (``com.example.www.``), a host and all its subdomains
are one interval of keys, and the intervals of rules are nested. Rules and pages are
sorted together by key in range partitions; a sweep over each partition keeps the
stack of rule hosts whose interval is open and takes, among their rules whose path starts the page's path, the longest.
Rules that are open where a partition begins come from an equality join on the few hosts above its first key.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featloom.workspace import materialise

_RESULT = "id long, host string, path string, rule string, verdict string"


def parsed(url: Column) -> tuple[Column, Column]:
    """Host and path of a url: the host follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, ASCII letters in
    lower case; the path follows up to ``?``, ``#`` or the end. Both are empty if the url is null or has no ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    capitals, small = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    part = lambda k: F.coalesce(F.regexp_extract(url, pattern, k), F.lit(""))
    return F.translate(part(1), capitals, small), part(2)


def key_of(host: Column) -> Column:
    """Labels in reverse order, each followed by \\x01; where a host holds that character itself it is written in two others."""
    plain = F.replace(F.replace(host, F.lit("\x02"), F.lit("\x02b")), F.lit("\x01"), F.lit("\x02a"))
    return F.concat(F.array_join(F.reverse(F.split(plain, r"\.", -1)), "\x01"), F.lit("\x01"))


def _sweep(default: str) -> Callable[[pa.Table], pa.Table]:
    def sweep(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table[c].to_pylist() for c in ("key", "page", "rule_path", "rule", "verdict", "id", "host", "path"))), key=lambda r: (r[0], r[1]))
        stack: list[tuple[str, dict[str, tuple[str, str]], list[int]]] = []
        out = []
        for key, page, rule_path, rule, verdict, id_, host, path in rows:
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if not page:
                if not stack or stack[-1][0] != key:
                    stack.append((key, {}, []))
                known = stack[-1][1]
                # Of equal rules the blocking one counts.
                known[rule_path] = max(known.get(rule_path, (rule, "")), (rule, verdict), key=lambda r: (r[1] == "block", r[1]))
                if len(rule_path) not in stack[-1][2]:
                    stack[-1][2].append(len(rule_path))
                continue
            best = None
            for _, known, lengths in stack:
                hits = [known[path[:n]] for n in lengths if n <= len(path) and path[:n] in known]
                for hit in hits:
                    if best is None or (len(hit[0]), hit[0]) > (len(best[0]), best[0]):
                        best = hit
            out.append((id_, host, path, best[0] if best else None, best[1] if best else default))
        columns = list(zip(*out)) if out else [[]] * 5
        kinds = [pa.int64(), *[pa.string()] * 4]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["id", "host", "path", "rule", "verdict"])

    return sweep


def url_filter(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow", parts: int | None = None) -> DataFrame:
    """One row per page: id, ``host``, ``path``, ``rule`` (host and path of the rule, else null), ``verdict``.

    ``rules`` has columns ``host``, ``path`` and ``verdict``. A rule fits its host and all subdomains if the
    page's path starts with the rule's; the longest rule text wins, of equal ones ``block``. Pages without a fitting rule, a url or a ``://`` get
    ``default``. Rules with a null part fit nothing. Repeated pages are judged each, null ids are kept. Other columns are not
    read. An empty rule table gives every page ``default``. Pages of one host are spread over as many ranges as they need.
    """
    parts = parts or int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    host, path = parsed(F.col(url_col))
    page_rows = pages.select(F.col(id_col).cast("long").alias("id"), host.alias("host"), path.alias("path")).select(
        key_of(F.col("host")).alias("key"), F.lit(True).alias("page"), *(F.lit(None).cast("string").alias(c) for c in ("rule_path", "rule", "verdict")), "id", "host", "path"
    )
    rule_rows = rules.where("host is not null and path is not null and verdict is not null").select(
        key_of(F.col("host")).alias("key"),
        F.lit(False).alias("page"),
        F.col("path").alias("rule_path"),
        F.concat("host", "path").alias("rule"),
        "verdict",
        F.lit(None).cast("long").alias("id"),
        "host",
        F.lit(None).cast("string").alias("path"),
    )
    ranged = page_rows.unionByName(rule_rows).repartitionByRange(parts, "key", "page", "path", "id", "rule_path").withColumn("part", F.spark_partition_id())
    ranged = materialise(ranged, "ranged")
    # The hosts above a part's first key; rules of theirs that lie in an earlier part are open there.
    firsts = ranged.groupBy("part").agg(F.min("key").alias("first"))
    labels = F.split("first", "\x01", -1)
    above = firsts.select(F.col("part").alias("into"), F.explode(F.transform(F.sequence(F.lit(1), F.size(labels) - 1), lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "\x01"), F.lit("\x01")))).alias("key"))
    carried = ranged.where(~F.col("page")).join(above, "key").where(F.col("part") < F.col("into")).drop("part").withColumnRenamed("into", "part")
    judged = ranged.unionByName(carried).groupBy("part").applyInArrow(_sweep(default), _RESULT)
    return judged.withColumnRenamed("id", id_col)
