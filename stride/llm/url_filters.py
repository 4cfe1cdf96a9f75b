"""URL filters by a temporal list join.

Dated list entries (``add`` / ``remove`` of a host, a domain suffix, a path
prefix or an exact URL) become validity intervals: an ``add`` is valid until
the key's next entry.  Every capture is expanded to the keys it could be listed
under and looks up, by an as-of join at its fetch time, the interval that
covers it.

Neither step orders all entries of a key in one task.  Rows are dealt by (key,
time bucket); the next entry of a bucket's last row, and the entry in force
when a bucket begins, come from one summary row per key and non-empty bucket,
ordered inside a day, and one row per key and day.
The as-of join itself is a running last value over entries and captures of one
(key, bucket) -- no pairs are formed.

Cases: a null, empty or host-less URL has no keys and is never blocked; entries
without key, time or a known action are ignored; entries of one key at the same
time apply in the order of entry_id, the last one counts; a capture at the very
time of an entry sees it; a capture without fetch time matches nothing;
repeated captures give one row each; repeated entries change nothing; very long
addresses have one key per host label and path segment; an empty list blocks
nothing, no captures give no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Entries and captures of one key are dealt over tasks by this much time; a summary row stands for each key and non-empty bucket.
BUCKET_SECONDS = 900
#: Buckets of a key are ordered in groups of this many, the groups once more: no task orders all buckets of a hot key.
GROUP_BUCKETS = 96


def _address(url: Column) -> tuple[Column, Column]:
    """(host in lower case without port, userinfo and final dot; path without query and fragment)"""
    authority = F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://([^/?#\s]*)", 1)
    host = F.regexp_replace(F.lower(F.regexp_replace(authority, r"^.*@|:[0-9]*$", "")), r"\.+$", "")
    path = F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://[^/?#\s]*(/[^?#\s]*)", 1)
    return host, F.regexp_replace(path, "/+$", "")


def host_of(url: Column) -> Column:
    return _address(url)[0]


def path_of(url: Column) -> Column:
    return _address(url)[1]


def _keys(host: Column, path: Column) -> Column:
    """Every key a capture can be listed under: host, domain suffixes, path prefixes, exact address."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))), lambda i: F.concat(
        F.lit("domain:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    parts = F.split(path, "/")  # the first part is empty
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.concat(
        F.lit("prefix:"), host, F.array_join(F.slice(parts, 1, i), "/")))
    keys = F.concat(F.array(F.concat(F.lit("host:"), host)), suffixes, prefixes, F.array(F.concat(F.lit("url:"), host, path)))
    return F.when(F.length(host) > 0, F.array_distinct(keys)).otherwise(F.array().cast("array<string>"))


def _bucket(ts: Column) -> Column:
    return F.floor(F.unix_seconds(ts) / BUCKET_SECONDS)


def _group() -> Column:
    return F.floor(F.col("bucket") / GROUP_BUCKETS)


def validity_intervals(entries: DataFrame) -> DataFrame:
    """entries (entry_id, key, action, ts) -> (key, valid_from, valid_to or null, entry_id), one per effective ``add``."""
    known = entries.where(F.col("key").isNotNull() & F.col("ts").isNotNull() & F.col("action").isin("add", "remove"))
    # of a key's entries at one time the last counts
    at = known.groupBy("key", "ts").agg(F.max(F.struct("entry_id", "action")).alias("e"))
    rows = at.select("key", "ts", "e.entry_id", "e.action", _bucket(F.col("ts")).alias("bucket"))
    inside = Window.partitionBy("key", "bucket").orderBy("ts")
    begins = rows.groupBy("key", "bucket").agg(F.min("ts").alias("first_ts")).withColumn("group", _group())
    days = begins.groupBy("key", "group").agg(F.min("first_ts").alias("first_ts"))
    days = days.select("key", "group", F.lead("first_ts").over(Window.partitionBy("key").orderBy("group")).alias("_later"))
    following = begins.select("key", "group", "bucket", F.lead("first_ts").over(Window.partitionBy("key", "group").orderBy("bucket")).alias("_next"))
    following = following.join(days, ["key", "group"]).select("key", "bucket", F.coalesce("_next", "_later").alias("_next"))
    nexts = rows.withColumn("_in", F.lead("ts").over(inside)).join(following, ["key", "bucket"])
    return nexts.where(F.col("action") == "add").select(
        "key", F.col("ts").alias("valid_from"), F.coalesce("_in", "_next").alias("valid_to"), "entry_id")


def as_of(captures: DataFrame, intervals: DataFrame) -> DataFrame:
    """captures (capture, key, ts) -> (capture, key, entry_id) for those inside an interval of their key."""
    entry = F.struct("valid_from", "valid_to", "entry_id")
    starts = intervals.select("key", _bucket(F.col("valid_from")).alias("bucket"), F.col("valid_from").alias("ts"),
                              F.lit(0).alias("kind"), F.lit(None).cast(captures.schema["capture"].dataType).alias("capture"),
                              entry.alias("entry"))
    asks = captures.where(F.col("ts").isNotNull()).select(
        "key", _bucket(F.col("ts")).alias("bucket"), "ts", F.lit(1).alias("kind"), "capture",
        F.lit(None).cast(starts.schema["entry"].dataType).alias("entry"))
    running = Window.partitionBy("key", "bucket").orderBy("ts", "kind").rowsBetween(Window.unboundedPreceding, 0)
    inside = starts.unionByName(asks).withColumn("_in", F.last("entry", ignorenulls=True).over(running)).where("kind = 1")
    # one row per key and bucket: the last entry before the bucket
    summary = starts.groupBy("key", "bucket").agg(F.max("entry").alias("_last")).unionByName(
        asks.select("key", "bucket", F.lit(None).cast(starts.schema["entry"].dataType).alias("_last")).distinct())
    summary = summary.groupBy("key", "bucket").agg(F.max("_last").alias("_last"))
    summary = summary.withColumn("group", _group())
    last = F.last("_last", ignorenulls=True)
    day = Window.partitionBy("key", "group").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("key").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    days = summary.groupBy("key", "group").agg(F.max("_last").alias("_last")).select("key", "group", last.over(earlier).alias("_before"))
    carry = summary.select("key", "group", "bucket", last.over(day).alias("_in_day")).join(days, ["key", "group"]).select(
        "key", "bucket", F.coalesce("_in_day", "_before").alias("_carry"))
    carry = carry.where(F.col("_carry").isNotNull())
    found = inside.join(carry, ["key", "bucket"], "left").withColumn("_entry", F.coalesce("_in", "_carry"))
    active = F.col("_entry").isNotNull() & (F.col("_entry.valid_to").isNull() | (F.col("ts") < F.col("_entry.valid_to")))
    return found.where(active).select("capture", "key", F.col("_entry.entry_id").alias("entry_id"))


def filter_captures(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """captures (page_id, url, fetch_ts) -> page_id, fetch_ts, host, blocked, n_active, entries (keys, sorted, comma-joined)."""
    url = F.col("url").cast("string")
    rows = captures.select("page_id", "fetch_ts", url.alias("url")).withColumn("host", F.coalesce(host_of(F.col("url")), F.lit("")))
    rows = rows.withColumn("path", F.coalesce(path_of(F.col("url")), F.lit(""))).drop("url")
    # equal captures share their answer; it is given back once per row
    ident = F.struct("page_id", "fetch_ts", "host", "path")
    once = rows.groupBy("page_id", "fetch_ts", "host", "path").agg(F.count(F.lit(1)).alias("times"))
    asked = once.select(ident.alias("capture"), F.explode(_keys(F.col("host"), F.col("path"))).alias("key"), F.col("fetch_ts").alias("ts"))
    hits = as_of(asked, validity_intervals(entries)).select("capture", "key")
    mark = once.select(ident.alias("capture"), F.lit(None).cast("string").alias("key"), "times")
    found = hits.withColumn("times", F.lit(None).cast("bigint")).unionByName(mark)
    answer = found.groupBy("capture").agg(F.max("times").alias("times"), F.sort_array(F.collect_list("key")).alias("keys"))
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times")))
    return answer.withColumn("_copy", copies).select(
        "capture.page_id", "capture.fetch_ts", "capture.host", (F.size("keys") > 0).alias("blocked"),
        F.size("keys").cast("bigint").alias("n_active"), F.array_join("keys", ",").alias("entries"))
