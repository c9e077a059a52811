"""URL filters by a temporal list join (DataFrame functions only).

List entries are dated: (list, mode, kind, pattern, day, action). Kinds are ``host`` (that host),
``domain`` (it and its subdomains) and ``prefix`` (host and path start at a ``/``). Each entry
holds from its day until the same list's next entry for the same pattern, which makes validity
intervals; a capture is judged by the interval that contains its fetch day (an as-of join).
Captures and intervals meet on (kind, pattern, month), so a capture is only compared with the
entries of one pattern and month. The interval table is broadcast only if its measured size is
small; beyond it the join shuffles, and Spark splits the partitions of a hot host.

A capture is blocked if an active ``block`` entry matches and no active ``allow`` entry does.

Edge cases: of several entries of one list, pattern and day ``remove`` wins over ``add``; entries
with a null list, kind, pattern, day or action are ignored, an unknown action too; a null mode is
``block``; a null or unparsable URL and a null fetch day match nothing and are kept; repeated rows
are rows of their own; an empty table gives an empty result, an empty list blocks nothing; further
columns are carried in ``row``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.common import packed_row
from tidepool.plans.joins import sized_lookup

#: Scheme, user info, host, port, path of an absolute or scheme-less ``//`` URL.
URL_PATTERN = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:@]+)(?::[0-9]*)?([^?#]*)"
FOREVER = "9999-12-31"


def url_host(url: Column) -> Column:
    """Lower-case host without a final dot ('' if the URL has none)."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, URL_PATTERN, 1)), r"\.$", "")


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, URL_PATTERN, 2)


def intervals(entries: DataFrame) -> DataFrame:
    """(list, mode, kind, pattern, valid_from, valid_to) of the times an entry is active.

    After the entries of a day are one, a pattern has at most one row per calendar day."""
    known = entries.where(F.col("list").isNotNull() & F.col("kind").isNotNull() & F.col("pattern").isNotNull()
                          & F.col("day").isNotNull() & F.col("action").isin("add", "remove"))
    keys = ["list", "mode", "kind", "pattern"]
    daily = known.withColumn("mode", F.coalesce("mode", F.lit("block"))) \
        .groupBy(*keys, "day").agg(F.max("action").alias("action"))
    later = Window.partitionBy(*keys).orderBy("day")
    return daily.withColumn("valid_to", F.coalesce(F.lead("day").over(later), F.lit(FOREVER).cast("date"))) \
        .where(F.col("action") == "add").withColumnRenamed("day", "valid_from").drop("action")


def _month(day: Column) -> Column:
    return (F.year(day) * 12 + F.month(day)).cast("int")


def candidates(host: Column, path: Column, depth: Column) -> Column:
    """(kind, pattern) pairs an URL can match; prefixes go no deeper than the list's deepest."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.struct(
        F.lit("domain").alias("kind"),
        F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("pattern")))
    parts = F.split(path, "/")
    cuts = F.least(F.size(parts) - 1, depth)
    # path 'a prefix of i segments' is '/s1/../si/'; the last one may be a file and has no '/'
    prefixes = F.when(cuts >= 1, F.transform(F.sequence(F.lit(1), cuts), lambda i: F.struct(
        F.lit("prefix").alias("kind"),
        F.concat(host, F.array_join(F.slice(parts, 1, i), "/"), F.lit("/")).alias("pattern")))) \
        .otherwise(F.array().cast("array<struct<kind:string,pattern:string>>"))
    own = F.array(F.struct(F.lit("host").alias("kind"), host.alias("pattern")))
    return F.when(host != "", F.concat(own, suffixes, prefixes))


def filter_urls(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched_on",
                carry: Sequence[str] = ()) -> DataFrame:
    """One row per capture: ``url, fetched_on, host, blocked, n_matches`` (active entries that
    match), ``lists`` (their lists, sorted) and ``row``, a struct of the ``carry`` columns."""
    spans = intervals(entries)
    limit = captures.agg(F.max(_month(F.col(fetched).cast("date"))).alias("m"))
    deepest = spans.where(F.col("kind") == "prefix").agg(
        F.coalesce(F.max(F.size(F.split("pattern", "/")) - 1), F.lit(0)).alias("d"))
    last, depth = limit.first()["m"], deepest.first()["d"]
    first = _month(F.col("valid_from"))
    until = F.least(_month(F.date_sub("valid_to", 1)), F.lit(last if last is not None else 0))
    monthly = spans.where(first <= until).withColumn("month", F.explode(F.sequence(first, until)))
    monthly = sized_lookup(monthly)
    seen = captures.select(F.monotonically_increasing_id().alias("_uid"), F.col(url).alias("url"),
                           F.col(fetched).cast("date").alias("fetched_on"), packed_row(carry)) \
        .withColumn("host", url_host(F.coalesce("url", F.lit("")))) \
        .withColumn("path", url_path(F.coalesce("url", F.lit("")))) \
        .withColumn("month", _month(F.col("fetched_on")))
    each = seen.withColumn("c", F.explode_outer(candidates(F.col("host"), F.col("path"), F.lit(depth)))) \
        .drop("path").select("*", F.col("c.kind").alias("kind"), F.col("c.pattern").alias("pattern")).drop("c")
    met = each.join(monthly, ["kind", "pattern", "month"], "left") \
        .withColumn("hit", F.coalesce((F.col("fetched_on") >= F.col("valid_from"))
                                      & (F.col("fetched_on") < F.col("valid_to")), F.lit(False)))
    hit = lambda mode: F.coalesce(F.max(F.col("hit") & (F.col("mode") == mode)), F.lit(False))
    judged = met.groupBy("_uid").agg(
        *[F.first(c).alias(c) for c in ("url", "fetched_on", "host", "_row")],
        (hit("block") & ~hit("allow")).alias("blocked"),
        F.count_if("hit").alias("n_matches"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("hit"), F.col("list")))), ",").alias("lists"))
    return judged.select("url", "fetched_on", F.when(F.col("host") != "", F.col("host")).alias("host"),
                         "blocked", "n_matches", "lists", F.col("_row").alias("row"))
