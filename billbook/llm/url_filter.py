"""URL filters as a temporal list join.

A list is a log of dated entries (list_key, listed_at, action). The entries of a key
become validity intervals: each holds from its date until the next entry of the same
key. An as-of join gives every capture the entry of each of its keys that was active
when the page was fetched; the most specific key with an active entry decides.

DataFrame functions only. The join is linear: entries and captures of a key are merged
by time in one window, never paired. Windows go by key and time slice, and the entry
that is active when a slice begins comes from a second, slice-level window, so a host
with a third of all captures is spread over its slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_ACTION = "allow"
REMOVED = "remove"
SLICE = "day"


def url_host(url: Column) -> Column:
    """Lower-case host without user and port; empty if the URL has none."""
    authority = F.regexp_extract(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":\d*$|\.$", ""))


def url_keys(url: Column) -> Column:
    """The list keys of a URL, most specific first: host/segment, host, parent domains.

    A top-level label is no key unless it is the whole host. NULL and malformed URLs have none.
    """
    host = url_host(url)
    segment = F.regexp_extract(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^/?#]+)", 1)
    labels = F.split(host, F.lit(r"\."), -1)
    parents = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    keys = F.concat(
        F.when(segment != "", F.array(F.concat_ws("/", host, segment))).otherwise(
            F.array().cast("array<string>")
        ),
        parents,
    )
    return F.when(F.coalesce(host, F.lit("")) != "", keys).otherwise(F.array().cast("array<string>"))


def intervals(entries: DataFrame) -> DataFrame:
    """(list_key, action, valid_from, valid_to) of dated entries; the last interval has no end.

    Of several entries of a key at one time the greatest action in text order holds. Entries without
    key, date or action are void.
    """
    one = (
        entries.where("list_key is not null and listed_at is not null and action is not null")
        .groupBy("list_key", F.col("listed_at").alias("valid_from"))
        .agg(F.max("action").alias("action"))
    )
    by_time = Window.partitionBy("list_key").orderBy("valid_from")
    return one.withColumn("valid_to", F.lead("valid_from").over(by_time))


def active_entries(captures: DataFrame, entries: DataFrame, slice_by: str = SLICE) -> DataFrame:
    """As-of join: rows (capture, list_key, rank, fetched_at) get the interval active at fetched_at.

    `captures` has further columns of other names than action, valid_from and valid_to. Captures
    without an active interval, or without a fetch time, are left out.
    """
    own = [c for c in captures.columns if c != "list_key"]
    slice_of = lambda at: F.date_trunc(slice_by, at)
    interval = F.struct("valid_from", "valid_to", "action")
    listed = intervals(entries).select(
        "list_key", F.col("valid_from").alias("_at"), interval.alias("_entry"),
        F.lit(None).cast(captures.select(F.struct(*own).alias("c")).schema["c"].dataType).alias("_capture"),
    )
    asked = captures.where(F.col("list_key").isNotNull() & F.col("fetched_at").isNotNull()).select(
        "list_key", F.col("fetched_at").alias("_at"),
        F.lit(None).cast(listed.schema["_entry"].dataType).alias("_entry"),
        F.struct(*own).alias("_capture"),
    )
    merged = listed.unionByName(asked).withColumn("_slice", slice_of(F.col("_at")))

    # Which entry is active when a slice begins: the last one of an earlier slice.
    by_slice = Window.partitionBy("list_key").orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    begun = (
        merged.groupBy("list_key", "_slice")
        .agg(F.max("_entry").alias("_latest"))
        .select("list_key", "_slice", F.last("_latest", ignorenulls=True).over(by_slice).alias("_begun"))
    )
    # An entry of the same instant is active: it sorts before the captures.
    in_slice = (
        Window.partitionBy("list_key", "_slice")
        .orderBy("_at", F.col("_capture").isNotNull())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    latest = F.last("_entry", ignorenulls=True).over(in_slice)
    return (
        merged.withColumn("_in", latest)
        .where(F.col("_capture").isNotNull())
        .join(begun, ["list_key", "_slice"])
        .withColumn("_active", F.coalesce("_in", "_begun"))
        .where(F.col("_active").isNotNull())
        .select("list_key", "_capture.*", "_active.*")
    )


def filter_urls(captures: DataFrame, entries: DataFrame, slice_by: str = SLICE) -> DataFrame:
    """(page_id, url, fetched_at, host, action, matched_key, listed_since), one row per capture.

    Every capture stays, repeated rows and NULLs included. Without an active entry, host or fetch
    time the action is `allow` and matched_key is NULL. An active `remove` says that the key is off
    the list: a less specific key decides then. Other columns of either frame are left out.
    """
    keys = ["page_id", "url", "fetched_at"]
    own = captures.select(*keys)
    asked = own.distinct().select(
        *keys, F.posexplode(url_keys(F.col("url"))).alias("rank", "list_key")
    )
    decided = (
        active_entries(asked, entries, slice_by)
        .where(F.col("action") != REMOVED)
        .groupBy(*keys)
        .agg(F.min(F.struct("rank", "action", "list_key", "valid_from")).alias("_best"))
        .select(F.struct(*keys).alias("_key"), "_best")
    )
    return own.join(decided, F.struct(*[own[k] for k in keys]) == decided["_key"], "left").select(
        *keys,
        url_host(F.col("url")).alias("host"),
        F.coalesce("_best.action", F.lit(DEFAULT_ACTION)).alias("action"),
        F.col("_best.list_key").alias("matched_key"),
        F.col("_best.valid_from").alias("listed_since"),
    )
