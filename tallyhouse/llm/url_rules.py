"""Host and path rules over URLs by a sorted sweep, in DataFrame functions only.

Reversed host labels, each closed by a full stop (``com.example.``), turn "this host and its subdomains"
into a prefix, and a prefix is an interval of the sort order. A sweep walks URLs and interval borders in
one order and keeps a stack of the rules that are open:

* the depth of the stack is a running sum of openings and closings;
* the rule on top at depth ``d`` is the last one that was opened at depth ``d``, which is a second
  running value, taken per depth.

Paths are swept first, which gives each URL the longest rule path that fits; the shorter ones that also
fit are that path's own chain of prefixes. Each URL then joins the host sweep once for each path of its
chain, among the rules with that path, and the longest rule wins (by characters of host and path; at a
tie the smaller text, and block before allow).

URLs are dealt to slots by a hash of the whole row and every slot gets all borders. So a host, or a URL,
that holds a third of all rows spreads evenly, and no rule table is broadcast. ``slots`` times the rules
is what a sweep adds to the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_VERDICT = "allow"
# Greater than every character that can follow a prefix: closes an interval.
_END = "\U0010ffff"


def _lower(value: Column) -> Column:
    return F.translate(value, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: str) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    return _lower(F.coalesce(F.regexp_extract(F.col(url), r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: str) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without a ``://``."""
    return F.coalesce(F.regexp_extract(F.col(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: str) -> Column:
    """Labels from the last to the first, each closed by a full stop."""
    return F.when(F.col(host) == "", F.lit("")).otherwise(
        F.concat(F.array_join(F.reverse(F.split(F.col(host), r"\.")), "."), F.lit(".")))


def _prefixes(path: str) -> Column:
    """All prefixes of a path, shortest first, itself last."""
    return F.transform(F.sequence(F.lit(0), F.length(path)), lambda n: F.substring(F.col(path), F.lit(1), n))


def _sweep(points: DataFrame, borders: DataFrame, scope: list[str]) -> DataFrame:
    """Each point (``key``) with ``top``, what lies on the stack of open intervals there, or null.

    ``borders`` holds the columns of ``scope``, ``key`` (a prefix) and ``value``; the intervals of a
    scope are distinct prefixes, hence nested or apart.
    """
    kept = [c for c in points.columns if c not in (*scope, "key")]
    blank = [F.lit(None).cast(points.schema[c].dataType).alias(c) for c in kept]
    opened = borders.select(*scope, "key", F.lit(1).alias("step"), "value", *blank)
    closed = borders.select(*scope, F.concat("key", F.lit(_END)).alias("key"), F.lit(-1).alias("step"),
                            F.lit(None).cast(borders.schema["value"].dataType).alias("value"), *blank)
    at = points.select(*scope, "key", F.lit(0).alias("step"),
                       F.lit(None).cast(borders.schema["value"].dataType).alias("value"), *kept)
    # At one key a rule opens before its URLs; of two closings the order makes no difference.
    order = ["key", F.col("step").desc()]
    in_scope = Window.partitionBy(*scope).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    in_depth = Window.partitionBy(*scope, "depth").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        at.unionByName(opened).unionByName(closed)
        .withColumn("depth", F.sum("step").over(in_scope))
        .withColumn("top", F.last(F.when(F.col("step") == 1, F.col("value")), ignorenulls=True).over(in_depth))
        .filter("step = 0")
        .select(*scope, *kept, F.when(F.col("depth") > 0, F.col("top")).alias("top"))
    )


def judge_urls(pages: DataFrame, rules: DataFrame, id_column: str = "page_id", url_column: str = "url",
               default: str = DEFAULT_VERDICT, slots: int | None = None) -> DataFrame:
    """One row per row of ``pages``: id, ``host``, ``path``, the fitting ``rule`` and the ``verdict``.

    ``rules`` has ``host``, ``path`` and ``verdict`` (allow or block). Rules with a null in any of them are
    ignored; of equal rules a blocking one holds. A null URL, or one without ``://``, has an empty host
    and path and meets no rule with a host. Repeated rows come back as often; other columns are left out.
    """
    spark = pages.sparkSession
    slots = slots or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rules = (
        rules.select(_lower(F.col("host")).alias("host"), "path", "verdict").dropna()
        .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
        .select("path", host_key("host").alias("key"),
                F.struct(F.length(F.concat("host", "path")).alias("size"),
                         F.concat("host", "path").alias("rule"), "verdict").alias("value"))
    )
    every_slot = F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot")
    # The rule paths that are prefixes of a rule path: found on the rules alone.
    paths = rules.select("path").distinct()
    chains = (
        paths.select(F.col("path").alias("whole"), F.explode(_prefixes("path")).alias("path"))
        .join(paths, "path").groupBy("whole").agg(F.sort_array(F.collect_list("path")).alias("value"))
        .select(every_slot, F.col("whole").alias("key"), "value")
    )
    urls = (
        pages.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{url_column}`").alias("url"))
        .groupBy("id", "url").agg(F.count(F.lit(1)).alias("copies"))
        .select("id", "url", "copies", url_host("url").alias("host"), url_path("url").alias("path"),
                F.pmod(F.xxhash64("id", "url"), F.lit(slots)).cast("int").alias("slot"))
    )
    by_path = _sweep(urls.withColumn("key", F.col("path")), chains, ["slot"])
    probes = by_path.select("slot", "id", "url", "copies", "host", F.col("path").alias("url_path"),
                            host_key("host").alias("key"), F.explode_outer("top").alias("path"))
    by_host = _sweep(probes, rules.select(every_slot, "path", "key", "value"), ["slot", "path"])
    rank = F.struct(F.col("top.size"), F.col("top.verdict"), F.col("top.rule"))
    best = by_host.groupBy("slot", "id", "url").agg(
        F.first("copies").alias("copies"), F.first("host").alias("host"), F.first("url_path").alias("path"),
        F.max(F.when(F.col("top").isNotNull(), rank)).alias("best"))
    return best.select(
        F.col("id").alias(id_column), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")).drop("_copy")
