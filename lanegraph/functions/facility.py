"""Facility-name parsing as built-in column expressions (no Python UDF).

Names look like ``City_Area_TYPE (State)``.  Every rule below is a pure
Catalyst expression, so it runs inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Facility type suffixes, in the order they are tested.
TYPE_PATTERNS = ["HB", "H", "DC", "DPP", "D", "CP", "BO", "BM", "GW"]

# Second (aggregate-level) type rule, tested in this order; each
# token matches when contained in the name or when the name ends with it
# (tokens are stripped for the ends-with test); the reported type is the token
# without underscore and parenthesis.
NAME_TYPE_TOKENS = ["HB", "DC", "DPP", "CP", "BO", "_H ", "_H(", "_D ", "_D("]

STATE_PATTERN = r"\(([^)]+)\)"
PAREN_PATTERN = r"\s*\([^)]+\)\s*"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _blank(name: Column) -> Column:
    return name.isNull() | (name == "")


def facility_state(name) -> Column:
    """Text inside the first pair of parentheses, trimmed; NULL if none."""
    name = _col(name)
    st = F.trim(F.regexp_extract(name, STATE_PATTERN, 1))
    has = F.regexp_extract(name, STATE_PATTERN, 0) != ""
    return F.when(_blank(name), F.lit(None).cast("string")).when(has, st).otherwise(F.lit(None).cast("string"))


def _name_parts(name: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(name, PAREN_PATTERN, "")), "_")


def facility_city(name) -> Column:
    """Part before the first underscore once parenthesised text is removed."""
    name = _col(name)
    return F.when(_blank(name), F.lit(None).cast("string")).otherwise(F.element_at(_name_parts(name), 1))


def facility_type(name) -> Column:
    """Type by suffix of the last ``_`` part, then by ``_TYPE`` anywhere, else Unknown."""
    name = _col(name)
    parts = _name_parts(name)
    last = F.upper(F.element_at(parts, -1))
    upper_name = F.upper(name)
    by_suffix = None
    for tp in TYPE_PATTERNS:
        cond = (F.size(parts) >= 2) & last.endswith(tp)
        by_suffix = F.when(cond, F.lit(tp)) if by_suffix is None else by_suffix.when(cond, F.lit(tp))
    fallback = None
    for tp in TYPE_PATTERNS:
        cond = upper_name.contains("_" + tp)
        fallback = F.when(cond, F.lit(tp)) if fallback is None else fallback.when(cond, F.lit(tp))
    fallback = fallback.otherwise(F.lit("Unknown"))
    return F.when(_blank(name), F.lit(None).cast("string")).otherwise(by_suffix.otherwise(fallback))


def parse_facility(name, prefix: str) -> dict[str, Column]:
    """``{prefix}city``, ``{prefix}state``, ``{prefix}facility_type`` columns."""
    return {f"{prefix}city": facility_city(name), f"{prefix}state": facility_state(name),
            f"{prefix}facility_type": facility_type(name)}


def facility_type_from_name(name) -> Column:
    """Aggregate-level type rule (case sensitive; NULL name → Unknown)."""
    name = _col(name)
    expr = F.when(name.isNull(), F.lit("Unknown"))
    for tok in NAME_TYPE_TOKENS:
        label = tok.strip().replace("(", "").replace("_", "")
        expr = expr.when(name.contains(tok) | name.endswith(tok.strip()), F.lit(label))
    return expr.otherwise(F.lit("Unknown"))


def state_from_last_paren(name) -> Column:
    """Audit rule: text after the last ``(`` with ``)`` removed, trimmed."""
    name = _col(name)
    last = F.element_at(F.split(name, r"\("), -1)
    return F.when(name.isNull() | ~name.contains("(") | ~name.contains(")"), F.lit(None).cast("string")) \
        .otherwise(F.trim(F.replace(last, F.lit(")"), F.lit(""))))
