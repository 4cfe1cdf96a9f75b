"""Features of long, overlapping time spans from shared blocks.

``features.span_features`` joins every span with each of its readings, twice;
a thousand spans over the same year would read that year two thousand times.
Here a closed span [lo, hi] is cut into its two edge buckets and a cover of whole
blocks: buckets, groups of ``2**step`` buckets, groups of those, up to
``levels``.  That is O(log span) blocks up to the widest level and one block per
widest level's width beyond it; readings are touched only in the edge buckets.

Pass 1 (count, distinct times, means, sample variances, maxima, mean
resultant): the blocks' partial moments are aggregated once, whoever asks, and
merged per span: a span's mean first, then the squares around it.

Pass 2 needs each span's own mean and maximum, which no stored moment knows.
Inside a block it is a question of order: the sum of |x - m| is
2 (m C - S) + sum (x - m), with C and S the count and sum of the readings
below m, and a block's peaks are its readings with trunc(y) above a threshold.
So the block's readings and the spans' questions are sorted together by value,
and running aggregates answer every question: readings and questions are read
once per block, never paired.  Sum (x - m) over a whole span is zero, so over
its blocks it is what the edges lack.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions.scalar import java_long
from ..session import materialize
from . import features as feat
from .ranges import explode_range, range_members
from .series import BUCKET

LEVEL, BLOCK = "_level", "_block"
AXES = (("x", feat.X), ("y", feat.Y), ("z", feat.Z))
#: A block is asked by at most this many questions per task; more are dealt over copies of its readings.
ASKED_PER_TASK = 200_000


@dataclass(frozen=True)
class Blocks:
    """Blocks of ``2 ** (step * level)`` buckets, levels 0 .. levels - 1.

    The widest block is what one task sorts: at 20 readings a second, one-hour
    buckets and the defaults (64 hours) it holds 4.6 million readings of a user.
    """

    bucket_ns: int
    step: int = 2
    levels: int = 4


def _floor(c: str, n: int) -> str:
    return f"(({c}) - pmod({c}, {n}L)) div {n}L"


def edges(spans: DataFrame, lo: str, hi: str, b: Blocks) -> DataFrame:
    """The parts ``_part_lo`` .. ``_part_hi`` (closed) of each span in its first and last bucket; one row where they are the same."""
    n = b.bucket_ns
    first, last = _floor(f"`{lo}`", n), _floor(f"`{hi}`", n)
    parts = F.expr(f"""filter(array(
        struct(`{lo}` AS _part_lo, least(`{hi}`, (({first}) + 1) * {n}L - 1) AS _part_hi, true AS keep),
        struct(({last}) * {n}L AS _part_lo, `{hi}` AS _part_hi, ({last}) > ({first}) AS keep)), p -> p.keep)""")
    return spans.select("*", F.explode(parts).alias("_part")).select(*spans.columns, "_part._part_lo", "_part._part_hi")


def cover(spans: DataFrame, lo: str, hi: str, b: Blocks) -> DataFrame:
    """The whole blocks (``_level``, ``_block``) between each span's edge buckets: disjoint, none missing."""
    n, top = b.bucket_ns, b.levels - 1
    cols = spans.columns
    inner = spans.select("*", F.expr(f"{_floor(f'`{lo}`', n)} + 1").alias("_a"), F.expr(_floor(f"`{hi}`", n)).alias("_b"))
    low = []
    for level in range(top):
        s, r = b.step * level, 1 << b.step
        a, e = f"shiftright(_a + {(1 << s) - 1}L, {s})", f"shiftright(_b, {s})"
        left = f"least({e}, shiftright({a} + {r - 1}L, {b.step}) * {r}L)"  # up to the next wider block
        right = f"greatest({left}, shiftright({e}, {b.step}) * {r}L)"
        low.append(f"""transform(IF({a} < {left}, sequence({a}, {left} - 1), array()), k -> struct({level} AS {LEVEL}, k AS {BLOCK}))""")
        low.append(f"""transform(IF({right} < {e} AND {a} < {e}, sequence({right}, {e} - 1), array()), k -> struct({level} AS {LEVEL}, k AS {BLOCK}))""")
    s = b.step * top
    wide = explode_range(inner, F.expr(f"shiftright(_a + {(1 << s) - 1}L, {s})"), F.expr(f"shiftright(_b, {s}) - 1"), BLOCK)
    out = wide.select(*cols, F.lit(top).alias(LEVEL), BLOCK)
    if low:
        narrow = inner.select(*cols, F.explode(F.expr(f"concat({', '.join(low)})")).alias("_p")).select(*cols, f"_p.{LEVEL}", f"_p.{BLOCK}")
        out = out.unionByName(narrow)
    return out


def touched(spans: DataFrame, keys: list[str], lo: str, hi: str, b: Blocks) -> DataFrame:
    """Distinct (keys, bucket) that any span reads: equal blocks of overlapping spans count once before they are spread."""
    at = F.expr(_floor("_part_lo", b.bucket_ns)).alias(BUCKET)
    whole = cover(spans.select(*keys, lo, hi), lo, hi, b).select(*keys, LEVEL, BLOCK).distinct()
    inside = F.expr(f"""sequence(shiftleft({BLOCK}, {b.step} * {LEVEL}), shiftleft({BLOCK} + 1, {b.step} * {LEVEL}) - 1)""")
    return edges(spans.select(*keys, lo, hi), lo, hi, b).select(*keys, at).unionByName(
        whole.select(*keys, F.explode(inside).alias(BUCKET))).distinct()


def on_levels(readings: DataFrame, b: Blocks) -> DataFrame:
    """Every reading once per level, with its block there."""
    rows = readings.select("*", F.explode(F.sequence(F.lit(0), F.lit(b.levels - 1))).alias(LEVEL))
    return rows.select("*", F.expr(f"shiftright({BUCKET}, {b.step} * {LEVEL})").alias(BLOCK))


def _partials() -> list:
    """Mergeable statistics of a group of readings: the squares are sums around the group's own mean."""
    stats = feat.statistics()
    return [
        stats["n_rows"][0].alias("n_rows"),
        *[stats[f"mean_{a}"][0].alias(f"mean_{a}") for a, _ in AXES],
        *[(F.var_pop(F.col(c)) * F.count(F.lit(1))).alias(f"m2_{a}") for a, c in AXES],
        *[stats[f"max_{a}"][0].alias(f"max_{a}") for a, _ in AXES],
        stats["resultant"][0].alias("resultant"),
        stats["n_distinct_ts"][0].alias("n_distinct_ts"),
    ]


PARTIALS = ("n_rows", *[f"{s}_{a}" for s in ("mean", "m2", "max") for a, _ in AXES], "resultant", "n_distinct_ts")


def merged(parts: DataFrame, group_cols: list[str]) -> DataFrame:
    """Partials of disjoint groups of readings -> the statistics of ``features.span_moments`` per span."""
    w = Window.partitionBy(*group_cols)
    n = F.sum("n_rows").over(w)
    means = {c: F.sum(F.col(c) * F.col("n_rows")).over(w) / n for c in [*[f"mean_{a}" for a, _ in AXES], "resultant"]}
    rows = parts.select(*group_cols, *PARTIALS, *[m.alias(f"_{c}") for c, m in means.items()])
    total = F.sum("n_rows")
    out = [total.alias("n_rows")]
    out += [F.any_value(f"_mean_{a}").alias(f"mean_{a}") for a, _ in AXES]
    for a, _ in AXES:
        apart = F.col(f"mean_{a}") - F.col(f"_mean_{a}")
        squares = F.sum(F.col(f"m2_{a}") + F.col("n_rows") * apart * apart)
        out.append(F.when(total > 1, squares / (total - 1)).otherwise(0.0).alias(f"variance_{a}"))
    out += [F.max(f"max_{a}").alias(f"max_{a}") for a, _ in AXES]
    out += [F.any_value("_resultant").alias("resultant"), F.sum("n_distinct_ts").alias("n_distinct_ts")]
    return rows.groupBy(*group_cols).agg(*out)


def span_moments(spans: DataFrame, readings: DataFrame, keys: list[str], group_cols: list[str], ts: str, lo: str, hi: str,
                 b: Blocks) -> DataFrame:
    """Pass 1 per non-empty span."""
    at_edges = range_members(edges(spans.select(*group_cols), lo, hi, b), readings, keys, ts, "_part_lo", "_part_hi", True, b.bucket_ns)
    block_keys = [*keys, LEVEL, BLOCK]
    stored = on_levels(readings, b).groupBy(*block_keys).agg(*_partials()).withColumnsRenamed({k: f"_r{k}" for k in block_keys})
    asked = cover(spans.select(*group_cols), lo, hi, b)
    whole = asked.join(stored, _equal(block_keys, "_r")).select(*group_cols, *PARTIALS)
    return merged(at_edges.groupBy(*group_cols).agg(*_partials()).select(*group_cols, *PARTIALS).unionByName(whole), group_cols)


def _equal(names: list[str], prefix: str) -> F.Column:
    out = F.lit(True)
    for k in names:
        out = out & (F.col(k) == F.col(f"{prefix}{k}"))
    return out


def _questions(stats: DataFrame, group_cols: list[str], peak_fraction: float, lo: str, hi: str, b: Blocks) -> DataFrame:
    """Four rows per span and whole block: below which value? (dimension 3: the peaks' negated threshold)"""
    values = [F.col(f"mean_{a}") for a, _ in AXES] + [-(F.lit(float(peak_fraction)) * F.col("max_y"))]
    asked = cover(stats.select(*group_cols, F.array(*values).alias("_values")), lo, hi, b)
    return asked.select(*group_cols, LEVEL, BLOCK, F.posexplode("_values").alias("_dim", "_value"))


def _below(stats: DataFrame, readings: DataFrame, keys: list[str], group_cols: list[str], peak: tuple[str, str], peak_fraction: float, lo: str, hi: str,
           b: Blocks, copies: bool) -> DataFrame:
    """Per question: count, sum, first times, earliest and latest time of the block's readings below its value."""
    ask = _questions(stats, group_cols, peak_fraction, lo, hi, b)
    block_keys = [*keys, LEVEL, BLOCK]
    wanted = cover(stats.select(*group_cols), lo, hi, b).groupBy(*block_keys).agg(F.count(F.lit(1)).alias("_asked"))
    wanted = wanted.withColumn("_copies", F.ceil(F.col("_asked") / ASKED_PER_TASK).cast("int")).drop("_asked").withColumnsRenamed(
        {k: f"_r{k}" for k in block_keys})
    given = on_levels(readings, b).join(wanted, _equal(block_keys, "_r"))
    values = F.array(*[F.col(c) for _, c in AXES], -java_long(F.col(feat.Y)).cast("double"))
    copy = F.lit(0)
    if copies:  # a block that very many ask about: its readings go to several tasks, each question to one
        given = given.select("*", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)).alias("_copy"))
        ask = ask.join(wanted, _equal(block_keys, "_r")).drop(*[f"_r{k}" for k in block_keys])
        ask = ask.withColumn("_copy", F.pmod(F.hash(*group_cols), F.col("_copies"))).drop("_copies")
        copy = F.col("_copy")
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in stats.schema if f.name in group_cols and f.name not in keys]
    data = given.select(*keys, *none, LEVEL, BLOCK, copy.alias("_copy"), F.col(peak[0]).alias("_at"), F.col(peak[1]).alias("_first"),
                        F.posexplode(values).alias("_dim", "_value"))
    ask = ask.select(*keys, *[c for c in group_cols if c not in keys], LEVEL, BLOCK, copy.alias("_copy"),
                     F.lit(None).cast("bigint").alias("_at"), F.lit(None).cast("boolean").alias("_first"), "_dim", "_value")
    # a question stands before the readings of its own value
    w = Window.partitionBy(*block_keys, "_copy", "_dim").orderBy("_value", F.col("_at").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    rows = data.unionByName(ask).select(
        *group_cols, "_dim", "_value", "_at",
        F.count("_at").over(w).alias("_c"),
        F.sum(F.when(F.col("_at").isNotNull(), F.col("_value"))).over(w).alias("_s"),
        F.count(F.when(F.col("_first"), 1)).over(w).alias("_f"),
        F.min("_at").over(w).alias("_min"), F.max("_at").over(w).alias("_max"))
    return rows.where(F.col("_at").isNull() & (F.col("_c") > 0))


def span_features(spans: DataFrame, readings: DataFrame, keys: list[str], group_cols: list[str], ts: str, lo: str, hi: str,
                  b: Blocks, peak_fraction: float = C.PEAK_FRACTION, peak: tuple[str, str] | None = None) -> DataFrame:
    """All eleven features (plus n_rows, n_distinct_ts) per non-empty closed span; ``group_cols`` hold keys, lo and hi.

    ``readings`` as for ``features.span_features``; ``peak`` names the column
    that times peaks and the flag of its distinct values, by default ts and
    first_of_ts.  Pass 1's rows are written
    once in the shared folder: pass 2 asks with them three times.
    """
    at, first = peak or (ts, "first_of_ts")
    stats = materialize(span_moments(spans, readings, keys, group_cols, ts, lo, hi, b), "span-moments")
    carried = [f"mean_{a}" for a, _ in AXES] + ["max_y"]
    near = range_members(edges(stats.select(*group_cols, *carried), lo, hi, b), readings, keys, ts, "_part_lo", "_part_hi", True, b.bucket_ns)
    high = java_long(F.col(feat.Y)) > F.lit(float(peak_fraction)) * F.col("max_y")
    zero = F.lit(0.0)
    at_edges = near.groupBy(*group_cols).agg(
        # |x - m| - (x - m): the blocks' own sum of x - m is minus the edges'
        *[F.sum(F.abs(F.col(c) - F.col(f"mean_{a}")) - (F.col(c) - F.col(f"mean_{a}"))).alias(f"_d{a}") for a, c in AXES],
        F.min(F.when(high, F.col(at))).alias("_pk_first"), F.max(F.when(high, F.col(at))).alias("_pk_last"),
        F.count(F.when(high & F.col(first), 1)).alias("_pk_n"))
    found = _below(stats, readings, keys, group_cols, (at, first), peak_fraction, lo, hi, b, copies=stats.count() > ASKED_PER_TASK)
    dim = F.col("_dim")
    below = [F.when(dim == k, 2 * (F.col("_value") * F.col("_c") - F.col("_s"))).otherwise(zero).alias(f"_d{a}") for k, (a, _) in enumerate(AXES)]
    in_blocks = found.select(
        *group_cols, *below, F.when(dim == 3, F.col("_min")).alias("_pk_first"), F.when(dim == 3, F.col("_max")).alias("_pk_last"),
        F.when(dim == 3, F.col("_f")).otherwise(F.lit(0)).cast("bigint").alias("_pk_n"))
    none = F.lit(None).cast("bigint")
    itself = stats.select(*group_cols, *[zero.alias(f"_d{a}") for a, _ in AXES], none.alias("_pk_first"), none.alias("_pk_last"),
                          F.lit(0).cast("bigint").alias("_pk_n"), F.struct(*[c for c in stats.columns if c not in group_cols]).alias("_stats"))
    no_stats = F.lit(None).cast(itself.schema["_stats"].dataType).alias("_stats")
    both = at_edges.unionByName(in_blocks).select("*", no_stats).unionByName(itself)
    done = both.groupBy(*group_cols).agg(
        *[F.sum(f"_d{a}").alias(f"_d{a}") for a, _ in AXES], F.min("_pk_first").alias("_pk_first"), F.max("_pk_last").alias("_pk_last"),
        F.sum("_pk_n").alias("_pk_n"), F.any_value("_stats", ignoreNulls=True).alias("_stats")).select("*", "_stats.*")
    return done.select(
        *group_cols, "n_rows", "n_distinct_ts", *[c for c in C.FEATURE_COLUMNS if c in stats.columns and not c.startswith("avg")],
        *[(F.col(f"_d{a}") / F.col("n_rows")).alias(f"avg_abs_diff_{a}") for a, _ in AXES], feat.peak_gap().alias("avg_time_peak_y")).select(
        *group_cols, "n_rows", "n_distinct_ts", *C.FEATURE_COLUMNS)
