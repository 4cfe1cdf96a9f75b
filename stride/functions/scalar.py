"""Column expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_long(c: str | Column) -> Column:
    """double -> long the way a Java narrowing cast does it.

    Truncates toward zero, NaN -> 0, NULL stays NULL, values beyond the long range saturate.
    (Spark's ANSI ``cast`` raises on NaN / overflow, so use ``try_cast``.)
    """
    c = col(c)
    sat = F.when(c > 0, F.lit(C.LONG_MAX)).otherwise(F.lit(C.LONG_MIN))
    return (
        F.when(c.isNull(), F.lit(None).cast("bigint"))
        .when(F.isnan(c), F.lit(0).cast("bigint"))
        .otherwise(F.coalesce(c.try_cast("bigint"), sat))
    )


def floor_div(name: str, n: int) -> Column:
    """Exact floor division of a BIGINT column by a positive constant.

    ``(c - pmod(c, n)) div n`` stays in integer arithmetic (a double round
    trip loses precision for nanosecond epochs) and floors negative values.
    """
    q = f"`{name}`"
    return F.expr(f"({q} - pmod({q}, {int(n)}L)) div {int(n)}L")


def activity_label(activity: str | Column, strict: bool = False, labels: dict[str, float] | None = None) -> Column:
    """Activity name -> class label; unknown names get the default label, or NULL where ``strict``."""
    labels = labels or C.ACTIVITY_LABELS
    m = F.create_map(*[x for k, v in labels.items() for x in (F.lit(k), F.lit(float(v)))])
    known = m[col(activity)]
    return known if strict else F.coalesce(known, F.lit(C.DEFAULT_LABEL))


def feature_sum(cols=C.FEATURE_COLUMNS) -> Column:
    return reduce(lambda a, b: a + b, [F.col(c) for c in cols])


def perfect_number(cols=C.FEATURE_COLUMNS, divisor: float = C.SCORE_DIVISOR) -> Column:
    """Score of one feature vector: sum of the features over a fixed divisor."""
    return feature_sum(cols) / F.lit(float(divisor))


def is_uuid(c: str | Column) -> Column:
    return F.coalesce(col(c).rlike(C.UUID_PATTERN), F.lit(False))


def is_long_text(c: str | Column) -> Column:
    return F.coalesce(col(c).rlike(C.LONG_PATTERN), F.lit(False))

