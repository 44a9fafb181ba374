"""Banding, thresholds and guarded arithmetic as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import DELAY_BANDS


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def delay_band(ratio, bands=DELAY_BANDS) -> Column:
    """Right-closed bins (lo, hi]; ratio <= first lower bound or NULL → NULL."""
    r = _col(ratio)
    expr = None
    for lo, hi, label in bands:
        cond = (r > lo) if math.isinf(hi) else ((r > lo) & (r <= hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(None).cast("string"))


def severity_band(score, high: float, medium: float,
                  labels=("High", "Medium", "Low")) -> Column:
    """score > high → labels[0]; > medium → labels[1]; else labels[2]."""
    s = _col(score)
    return F.when(s > high, F.lit(labels[0])).when(s > medium, F.lit(labels[1])).otherwise(F.lit(labels[2]))


def estimated_sla(score) -> Column:
    """max(45, 100 - 0.45 * score)."""
    return F.greatest(F.lit(45.0), F.lit(100.0) - F.lit(0.45) * _col(score))


def rule_route_recommendation(distance_km, ftl_above: float = 200.0,
                              carting_below: float = 100.0) -> Column:
    d = _col(distance_km)
    return (F.when(d > ftl_above, F.lit("FTL")).when(d < carting_below, F.lit("Carting"))
            .otherwise(F.lit("Model decides")))


def safe_div(num, den, default=None) -> Column:
    """num / den, ``default`` when den is 0 or NULL (ANSI-safe)."""
    n, d = _col(num), _col(den)
    fill = F.lit(default) if default is not None else F.lit(None).cast("double")
    return F.when(d.isNull() | (d == 0), fill).otherwise(n.cast("double") / d.cast("double"))


def late_flag(factor, threshold: float) -> Column:
    """1.0 when factor > threshold, 0.0 otherwise (missing counts as not late)."""
    return F.coalesce(_col(factor) > threshold, F.lit(False)).cast("double")


def null_safe_equal_int(a, b) -> Column:
    """1 when both present and equal, else 0 (NULL never equals NULL)."""
    return F.coalesce(_col(a) == _col(b), F.lit(False)).cast("int")


def finite_or_zero(c) -> Column:
    """NULL, NaN and ±inf → 0.0."""
    x = _col(c).cast("double")
    return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), F.lit(0.0)).otherwise(x)
