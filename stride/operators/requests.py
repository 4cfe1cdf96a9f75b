"""Range requests: parse ``user,start,finish[,ignored...]`` and score the range.

A message that is empty, has fewer than three fields or a non-integer time
goes to the dead-letter output (the original lost its consumer thread on
these).  A parsed request whose identifier is malformed, or whose range holds
no reading (including reversed ranges), keeps its row with NULL features and
is later given the prediction -1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import config as C
from ..functions.scalar import floor_div, is_long_text, is_uuid
from ..session import materialize
from . import blocks, series
from . import features as feat
from .ranges import explode_range

# Hex digits of the five identifier groups.
UUID_GROUP_WIDTHS = (8, 4, 4, 4, 12)
CANONICAL_UUID = r"\A" + "-".join(f"[0-9a-f]{{{w}}}" for w in UUID_GROUP_WIDTHS) + r"\z"
# the lowest digits of each group, once twelve zeros stand in front of it
LOWEST_DIGITS = r"\A" + "-".join(f"[^-]*([^-]{{{w}}})" for w in UUID_GROUP_WIDTHS) + r"\z"
REQUEST_BUCKET_NS = 3_600_000_000_000  # one hour
# Readings per request, on average, up to which requests are joined with their
# readings; beyond it they read shared blocks.  Rows are the same either way.
DIRECT_READINGS = 500


def _body(value: F.Column) -> F.Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def classify(msgs: DataFrame) -> DataFrame:
    """Adds the split fields, ``start_ts`` and ``finish_ts`` (NULL where no long) and a ``dead_reason`` (NULL for a parsed message)."""
    body = _body(F.col("value"))
    parts = F.split(body, C.REQUEST_SEPARATOR, -1)
    m = msgs.withColumn("_body", body).withColumn("_parts", parts)
    m = m.withColumns({"start_ts": F.get(F.col("_parts"), 1).try_cast("bigint"), "finish_ts": F.get(F.col("_parts"), 2).try_cast("bigint")})
    start_txt = F.get(F.col("_parts"), 1)
    finish_txt = F.get(F.col("_parts"), 2)
    reason = (
        F.when(F.length("_body") == 0, F.lit("empty"))
        .when(F.size("_parts") <= 2, F.lit("too_few_fields"))
        .when(~(is_long_text(start_txt) & is_long_text(finish_txt)), F.lit("bad_number"))
        # in pattern but beyond the long range
        .when(F.col("start_ts").isNull() | F.col("finish_ts").isNull(), F.lit("bad_number"))
    )
    return m.withColumn("dead_reason", reason)


def canonical_uuid(txt: F.Column) -> F.Column:
    """Lower-case 8-4-4-4-12 form; like a UUID parser, a group is its lowest digits, zeros in front."""
    # most texts are in this form already; two replacements for the others, since a split per group
    # makes the generated method too long for the JVM to compile
    padded = F.regexp_replace(txt, r"(\A|-)", "$1" + "0" * max(UUID_GROUP_WIDTHS))
    return F.when(txt.rlike(CANONICAL_UUID), txt).otherwise(F.lower(F.regexp_replace(padded, LOWEST_DIGITS, "$1-$2-$3-$4-$5")))


PARSED = ("request_id", "request_ts", "user_text", "valid_user", "user_id", "start_ts", "finish_ts")


def request_fields(msgs: DataFrame) -> DataFrame:
    """Every message (``request_id, request_ts, value``) with its fields and ``dead_reason`` (NULL for a parsed message)."""
    user_txt = F.get(F.col("_parts"), 0)
    return classify(msgs).select(
        "request_id",
        "request_ts",
        F.col("_body").alias("value"),
        "dead_reason",
        user_txt.alias("user_text"),
        is_uuid(user_txt).alias("valid_user"),
        F.when(is_uuid(user_txt), canonical_uuid(user_txt)).alias("user_id"),
        "start_ts",
        "finish_ts",
    )


def split_requests(fields: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(parsed, dead) for the messages of ``request_fields``."""
    parsed = fields.filter(F.col("dead_reason").isNull()).select(*PARSED)
    return parsed, fields.filter(F.col("dead_reason").isNotNull()).select("request_id", "request_ts", "value", "dead_reason")


def parse_requests(msgs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(parsed, dead) for a DataFrame of ``request_id, request_ts, value``."""
    return split_requests(request_fields(msgs))


def live_spans(live: DataFrame) -> DataFrame:
    """First and last reading time and number of readings per (canonical) user.

    Readings are grouped by the stored text; only the groups' texts are matched and made canonical.
    """
    user = F.col("user_id")
    stored = live.groupBy("user_id").agg(
        F.min("timestamp").alias("_first"), F.max("timestamp").alias("_last"), F.count("timestamp").alias("_n"))
    return stored.filter(is_uuid(user)).groupBy(canonical_uuid(user).alias("_live_user")).agg(
        F.min("_first").alias("_first"), F.max("_last").alias("_last"), F.sum("_n").alias("_n"))


def clamped(parsed: DataFrame, live) -> DataFrame:
    """Distinct request spans cut to the time their user has readings for.

    ``live``: the live table, or a store that knows its users' spans.

    Adds ``_from`` and ``_to``, and ``_about``, the readings expected from the
    user's number; spans of users without readings, and spans
    beyond all readings, disappear.  However long a request's range is, it
    then covers no more buckets than the user's readings do.
    """
    spans = parsed.filter(F.col("valid_user") & (F.col("start_ts") <= F.col("finish_ts"))).select(
        "user_id", "start_ts", "finish_ts").distinct()
    known = live_spans(live) if isinstance(live, DataFrame) else live.spans()
    cut = spans.join(known, F.col("user_id") == F.col("_live_user")).select(
        "user_id", "start_ts", "finish_ts", F.greatest("start_ts", "_first").alias("_from"),
        F.least("finish_ts", "_last").alias("_to"), (F.col("_n") / (F.col("_last").cast("double") - F.col("_first") + 1)).alias("_rate"))
    return cut.filter(F.col("_from") <= F.col("_to")).select(
        "user_id", "start_ts", "finish_ts", "_from", "_to", (F.col("_rate") * (F.col("_to").cast("double") - F.col("_from") + 1)).alias("_about"))


def direct_bucket(spans: DataFrame, bucket_ns: int) -> int | None:
    """Bucket for joining spans with their readings, or None where they cover so many that shared blocks are better.

    The widest of bucket_ns, 2 bucket_ns, 4 bucket_ns ... that is no longer
    than the spans and holds no more readings than they do, on average.
    """
    readings, length = spans.agg(F.avg("_about"), F.avg(F.col("_to").cast("double") - F.col("_from") + 1)).first()
    if readings is None or readings > DIRECT_READINGS:
        return None if readings is not None else bucket_ns
    wide = bucket_ns
    while 2 * wide <= length:
        wide *= 2
    return wide


def live_readings(live: DataFrame, bucket_ns: int = REQUEST_BUCKET_NS, spans: DataFrame | None = None,
                  counted: Observation | None = None, shared: bool = True) -> DataFrame:
    """Live table -> bucketed readings keyed by user.

    The range is filtered on ``timestamp``, peaks are timed on
    ``timestamp_long`` (``timestamp`` where it is missing), which may be finer.  ``counted``
    receives ``n_read`` and ``n_rejected`` of the live rows read (no
    identifier, time or axis) with the first action on the result.  ``shared``:
    the spans' buckets are found through shared blocks, for spans of many buckets.
    """
    user = F.col("user_id")
    usable = is_uuid(user) & F.col("timestamp").isNotNull() & F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("z").isNotNull()
    if counted is not None:
        live = live.observe(counted, F.count(F.lit(1)).alias("n_read"), F.count_if(~usable).alias("n_rejected"))
    r = live.select(
        F.when(is_uuid(user), canonical_uuid(user)).alias("user_id"),
        F.col("timestamp").alias("ts_ns"),
        F.coalesce("timestamp_long", "timestamp").alias("peak_ns"),
        F.col("x").alias("acc_x"),
        F.col("y").alias("acc_y"),
        F.col("z").alias("acc_z"),
    ).filter(F.col("user_id").isNotNull() & F.col("ts_ns").isNotNull() & F.col("acc_x").isNotNull()
             & F.col("acc_y").isNotNull() & F.col("acc_z").isNotNull())
    if spans is not None:
        # only (user, bucket) pairs that a request asks about are shuffled and ordered
        if shared:
            asked = blocks.touched(spans, ["user_id"], "_from", "_to", blocks.Blocks(bucket_ns))
        else:
            asked = explode_range(spans.select("user_id", "_from", "_to"), floor_div("_from", bucket_ns), floor_div("_to", bucket_ns),
                                  series.BUCKET).select("user_id", series.BUCKET).distinct()
        asked = asked.select(F.col("user_id").alias("_user"), F.col(series.BUCKET).alias("_asked"))
        r = r.join(asked, (F.col("user_id") == F.col("_user")) & (floor_div("ts_ns", bucket_ns) == F.col("_asked")), "left_semi")
    local = series.local_order(r, ["user_id"], "ts_ns", bucket_ns, 0, tie_desc="acc_y", tie_asc="peak_ns")
    return local.select("user_id", series.BUCKET, "ts_ns", "peak_ns", "acc_x", "acc_y", "acc_z", "first_of_ts", "first_of_tie")


def request_features(parsed: DataFrame, live, bucket_ns: int = REQUEST_BUCKET_NS,
                     peak_fraction: float = C.PEAK_FRACTION, counted: Observation | None = None) -> DataFrame:
    """Every parsed request with the eleven features of its closed range (NULL when empty).

    ``live`` is the live table, or a store of it (``sources.live_store``) that
    is asked for the spans' readings only; it is bucketed here with the same
    ``bucket_ns`` as the request spans.  A span is cut into its two edge buckets
    and whole blocks that all spans share (``operators.blocks``), so long and
    overlapping ranges cost a few blocks each, not their readings; spans of few
    readings (``DIRECT_READINGS``) are joined with them.  Equal ranges
    of a user are computed once and joined back to every request that asks for
    them, so repeated request ids change nothing.
    """
    spans = materialize(clamped(parsed, live), "request-spans")
    rows = live if isinstance(live, DataFrame) else live.readings(spans)
    gcols = ["user_id", "start_ts", "finish_ts", "_from", "_to"]
    direct = direct_bucket(spans, bucket_ns)
    readings = live_readings(rows, direct or bucket_ns, spans, counted, shared=direct is None)
    peak = ("peak_ns", "first_of_tie")
    if direct:
        f = feat.span_features(spans.select(*gcols), readings, ["user_id"], gcols, "ts_ns", "_from", "_to", True, direct, peak_fraction, peak)
    else:
        f = blocks.span_features(spans, readings, ["user_id"], gcols, "ts_ns", "_from", "_to", blocks.Blocks(bucket_ns), peak_fraction, peak)
    ren = {"user_id": "_u", "start_ts": "_s", "finish_ts": "_f"}
    f = f.drop("_from", "_to").withColumnsRenamed(ren)
    same = (F.col("user_id") == F.col("_u")) & (F.col("start_ts") == F.col("_s")) & (F.col("finish_ts") == F.col("_f"))
    out = parsed.join(f, same, "left").drop(*ren.values())
    out = out.withColumn("n_distinct_ts", F.coalesce(F.col("n_distinct_ts"), F.lit(0).cast("bigint")))
    return out.withColumn("n_rows", F.coalesce(F.col("n_rows"), F.lit(0).cast("bigint"))).withColumn(
        "scored", F.col("n_rows") > 0
    )
