"""Segment cleaning: repairs, name parsing, name back-fill, intrastate flag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bands import null_safe_equal_int
from ..functions.facility import parse_facility

ROW_ORDER = ("trip_uuid", "seg_no")


def row_order_columns(df: DataFrame) -> list[str]:
    return [c for c in ROW_ORDER if c in df.columns]


def row_order(df: DataFrame):
    """Explicit total order of segment rows (stands in for file order)."""
    return F.struct(*[F.col(c) for c in row_order_columns(df)])


def clean_negative_time(df: DataFrame, col: str = "segment_actual_time") -> DataFrame:
    return df.withColumn(col, F.when(F.col(col) < 0, F.lit(0.0)).otherwise(F.col(col)))


def clean_zero_to_null(df: DataFrame, cols=("segment_osrm_time", "segment_osrm_distance")) -> DataFrame:
    return df.withColumns({c: F.nullif(F.col(c), F.lit(0.0)) for c in cols})


#: Most rows of a name table that are broadcast; it is counted first.
BROADCAST_NAMES = 200_000
ROLES = (("source_center", "source_name"), ("destination_center", "destination_name"))
PREFIXES = ("source_", "dest_")


def names_seen(df: DataFrame) -> DataFrame:
    """(role, center, name, first): every non-null name of every center with
    its first row, for both roles from one pass.  A map task keeps one row per
    center and name, so a hub holding a third of all rows costs no more."""
    both = F.array(*[F.struct(F.lit(i).alias("role"), F.col(c).alias("center"), F.col(n).alias("name")) for i, (c, n) in enumerate(ROLES)])
    pairs = df.groupBy(*[c for role in ROLES for c in role]).agg(F.min(row_order(df)).alias("_at"))      # rows meet once, not once a role
    return (pairs.select("_at", F.explode(both).alias("x")).where("x.name is not null")
            .groupBy("x.role", "x.center", "x.name").agg(F.min("_at").alias("first")))


def first_known_names(df: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """(role, center) → first non-null name in row order."""
    seen = names_seen(df) if seen is None else seen
    return seen.where("center is not null").groupBy("role", "center").agg(F.min_by("name", F.struct("first", "name")).alias("known"))


def backfill_names(df: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """NULL source/destination names ← first known name of the same center.

    Below a counted limit the names are broadcast and no row of ``df`` is
    shuffled.  Beyond it only rows with a null name are joined by a shuffle
    (the runtime splits a hot center); all others pass by untouched.
    """
    from .graph.core import cut
    known = cut(first_known_names(df, seen))
    small = known.count() <= BROADCAST_NAMES
    out = df
    for i, (center, name) in enumerate(ROLES):
        own = known.where(F.col("role") == i).select(F.col("center").alias(center), F.col("known").alias("_known"))
        if small:
            out = out.join(F.broadcast(own), center, "left").withColumn(name, F.coalesce(F.col(name), F.col("_known"))).drop("_known")
            out = out.select(*df.columns)
        else:
            filled = (out.where(F.col(name).isNull()).join(own, center, "left")
                      .withColumn(name, F.col("_known")).drop("_known").select(*df.columns))
            out = out.where(F.col(name).isNotNull()).unionByName(filled)
    return out


def parse_names(df: DataFrame, seen: DataFrame | None = None, limit: int = BROADCAST_NAMES) -> DataFrame:
    """``df`` plus city, state and facility type of both names.

    Each distinct name is parsed once, and the counted table is broadcast;
    beyond ``limit`` names every row evaluates the same expressions itself.
    """
    from .graph.core import cut
    seen = names_seen(df) if seen is None else seen
    table = cut(seen.select("name").distinct().withColumns(parse_facility("name", "")))
    if table.count() > limit:
        parsed: dict = {}
        for (_, name), pre in zip(ROLES, PREFIXES):
            parsed |= parse_facility(name, pre)
        return df.withColumns(parsed)
    out = df
    for (_, name), pre in zip(ROLES, PREFIXES):
        own = F.broadcast(table.select(F.col("name").alias("_name"), *[F.col(c).alias(pre + c) for c in table.columns[1:]]))
        out = out.join(own, F.col(name) == F.col("_name"), "left").drop("_name")
    return out


def clean_data(df: DataFrame) -> DataFrame:
    """Repairs, parsed names (before back-fill, as the source analysis does),
    back-filled names, then the intrastate flag from the parsed states.  One
    written table of the names per center serves parsing and back-fill."""
    from .graph.core import cut
    out = clean_zero_to_null(clean_negative_time(df))
    seen = cut(names_seen(out))
    out = backfill_names(parse_names(out, seen), seen)
    return out.withColumn("is_intrastate", null_safe_equal_int("source_state", "dest_state"))


def clean_repair_counts(df: DataFrame) -> DataFrame:
    """How many rows each cleaning rule touches (one row)."""
    return df.agg(
        F.count_if(F.col("segment_actual_time") < 0).alias("negative_segment_actual_time"),
        F.count_if(F.col("segment_osrm_time") == 0).alias("zero_segment_osrm_time"),
        F.count_if(F.col("segment_osrm_distance") == 0).alias("zero_segment_osrm_distance"),
        F.count_if(F.col("source_name").isNull()).alias("missing_source_name"),
        F.count_if(F.col("destination_name").isNull()).alias("missing_destination_name"),
    )


def backfill_counts(raw: DataFrame) -> DataFrame:
    """Missing names before and after back-fill (one row, one pass)."""
    flagged = raw.withColumns({"_src_was_null": F.col("source_name").isNull(),
                               "_dst_was_null": F.col("destination_name").isNull()})
    filled = backfill_names(flagged)
    return filled.agg(
        F.count_if("_src_was_null").alias("src_missing"),
        F.count_if(F.col("_src_was_null") & F.col("source_name").isNotNull()).alias("src_filled"),
        F.count_if("_dst_was_null").alias("dst_missing"),
        F.count_if(F.col("_dst_was_null") & F.col("destination_name").isNotNull()).alias("dst_filled"))
