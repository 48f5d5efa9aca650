"""URL filter with dated lists: entries become validity intervals, and captures are joined as of their fetch day.

A list changes; a capture has to be judged by the entries that were active when it was fetched. Additions and
removals of an entry are paired into intervals [from, to), and a capture meets an interval when one of its keys
(the URL, the host, or a domain the host lies in) is the entry's value and the fetch day lies in the interval.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# fixed values: a DNS name has at most 253 characters, so at most 127 labels
_NAME, _LABELS = 253, 127
_ADDRESS = r"^(?i)[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*)(:[0-9]*)?([^#]*)"


def host_of(url: Column) -> Column:
    """Lower-case host without a closing dot; '' if there is none."""
    return F.coalesce(F.lower(F.regexp_replace(F.regexp_extract(url, _ADDRESS, 1), r"\.$", "")), F.lit(""))


def url_key(url: Column) -> Column:
    """Host, then path and query as they are: without scheme, user, port and fragment; '' if there is no host."""
    path = F.coalesce(F.regexp_extract(url, _ADDRESS, 3), F.lit(""))
    path = F.when(path == "", F.lit("/")).otherwise(path)
    return F.when(host_of(url) != "", F.concat(host_of(url), path)).otherwise("")


def domains_of(host: Column) -> Column:
    """The host and all domains above it; names longer than DNS allows cannot be listed and are left out."""
    labels = F.split(host, r"\.")
    count = F.size(labels)
    start = F.greatest(F.lit(1), count - (_LABELS - 1))
    names = F.transform(F.sequence(start, count), lambda k: F.array_join(F.slice(labels, k, count), "."))
    known = F.filter(names, lambda n: (n != "") & (F.length(n) <= _NAME))
    # an address of numbers lies in no domain
    return F.when(host.rlike(r"^[0-9.]*$"), F.array().cast("array<string>")).otherwise(known)


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(list, verdict, kind, value, valid_from, valid_to) from dated (…, day, action) entries.

    action is 'add' or 'remove'. An addition holds from its day until the day before the next change of
    the same entry; valid_to is that change's day, null if there is none. Repeated changes of a day count once, and
    a removal outweighs an addition on the same day. Entries with a null or empty field and other
    actions or kinds are void. Changes are combined per day before rows of one entry meet.
    """
    entry = ["list", "verdict", "kind", "value"]
    days = (
        entries.where("list is not null and verdict in ('block', 'allow') and kind in ('url', 'host', 'domain')")
        .where("value <> '' and day is not null and action in ('add', 'remove')")
        .withColumn("value", F.when(F.col("kind") == "url", F.col("value")).otherwise(F.lower("value")))
        .groupBy(*entry, "day")
        .agg((F.max(F.col("action")) == "add").alias("on"))
    )
    line = Window.partitionBy(*entry).orderBy("day")
    return (
        days.withColumn("valid_to", F.lead("day").over(line))
        .where("on")
        .select(*entry, F.col("day").alias("valid_from"), "valid_to")
    )


def filter_urls(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", day_col: str = "day") -> DataFrame:
    """One row per capture: page_id, url, day, verdict, list, kind, value, valid_from, valid_to.

    entries has (list, verdict, kind, value, day, action); see validity_intervals. Kind 'url' is compared with
    url_key, 'host' with the whole host, 'domain' with the host and every domain above it. Of several
    active entries the most specific decides (url, host, longer domain, shorter domain), then 'block' before
    'allow', then the list's name. verdict is 'block', 'allow' or 'none'; the other columns are null for 'none'.

    A capture without URL, host or day meets no entry. Repeated captures each get their row. Empty tables are
    allowed on both sides; other columns are ignored. Domains are looked up once per distinct host, and
    every distinct (url, day) is decided once; all joins are on equal keys, so adaptive execution can
    split a host that holds a large share of the captures.
    """
    rows = captures.select(
        F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(day_col).cast("date").alias("day")
    )
    spans = validity_intervals(entries)
    found = F.struct(
        "rank", (F.col("verdict") == "block").alias("blocks"), "list", "verdict", "kind", "value", "valid_from", "valid_to"
    )
    seen = rows.where("url is not null and day is not null").select("url", "day").distinct()
    seen = seen.select("url", "day", host_of(F.col("url")).alias("host"), url_key(F.col("url")).alias("key")).where("host <> ''")
    hosts = seen.select("host").distinct()
    names = hosts.select("host", F.explode(domains_of(F.col("host"))).alias("value")).select(
        "host", "value", F.lit("domain").alias("kind"), F.length("value").alias("rank")
    )
    names = names.union(
        hosts.select("host", F.col("host").alias("value"), F.lit("host").alias("kind"), F.lit(_NAME + 1).alias("rank"))
    )
    by_host = names.join(spans, ["kind", "value"]).select("host", "valid_from", "valid_to", found.alias("hit"))
    by_url = spans.where("kind = 'url'").withColumn("rank", F.lit(_NAME + 2)).select(
        F.col("value").alias("key"), "valid_from", "valid_to", found.alias("hit")
    )
    active = (F.col("day") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("day") < F.col("valid_to")))
    hits = seen.join(by_host, "host").where(active).select("url", "day", "hit")
    hits = hits.union(seen.join(by_url, "key").where(active).select("url", "day", "hit"))
    # the earlier list name wins, so it is compared apart from the maximum of rank and verdict
    top = hits.groupBy("url", "day").agg(
        F.min_by("hit", F.struct(-F.col("hit.rank"), ~F.col("hit.blocks"), F.col("hit.list"))).alias("hit")
    )
    return rows.join(top, ["url", "day"], "left").select(
        "page_id",
        "url",
        "day",
        F.coalesce("hit.verdict", F.lit("none")).alias("verdict"),
        *(F.col(f"hit.{c}").alias(c) for c in ("list", "kind", "value", "valid_from", "valid_to")),
    )
