"""Segment (leg) sources.

Two ways to obtain the segment table:

* ``scan_segments`` reads the raw CSV/Parquet export of segment observations
  (24 columns) and turns NaN into NULL so that Spark aggregates skip missing
  values the way the source analysis expects.
* ``legs_from_tables`` derives the same columns from the shared star-schema
  tables (lineitem/orders/supplier/customer): an order is a trip, a line is a
  segment, supplier and customer nations name the facilities.  Cumulative
  columns are running sums in segment order.  The derivation is deterministic
  and integer based so the SQL oracle reproduces it exactly.

Scale notes: lineitem joins orders on the trip's name, and the running-sum
window is partitioned by it too, so the window reuses the join's hash
partitioning (one shuffle for both).  So do later groupings by trip and
distinct counts of trips, as the name is a column of the result.  Large tables are
dealt into more parts the more rows they have (``ROWS_PER_TASK``), as a task's
sorts and hash tables hold a part.  Supplier and customer are dimension
joins; the physical strategy (broadcast vs. sort-merge) is left to AQE,
which only broadcasts a side whose measured runtime size is under
``spark.sql.adaptive.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schema import DOUBLE_COLUMNS, RAW_SEGMENT, TEST_VALUE, TIMESTAMP_COLUMNS, TRAIN_VALUE
from .tables import read_table

# Fixed values of the leg derivation: name suffix per (key % 5), which makes
# the facility-type parser see HB, H, DPP/D, DC and an unknown suffix.
NAME_SUFFIX = {0: "_HB", 1: "_H", 2: "DPP_D", 3: "_DC"}
NAME_SUFFIX_OTHER = "_X"


def _suffix(k: Column) -> Column:
    expr = F.when(k == 0, F.lit(NAME_SUFFIX[0]))
    for key in (1, 2, 3):
        expr = expr.when(k == key, F.lit(NAME_SUFFIX[key]))
    return expr.otherwise(F.lit(NAME_SUFFIX_OTHER))


def _facility_name(nation: Column, k: Column) -> Column:
    return F.concat(F.lit("City"), nation.cast("string"), F.lit("_Area"), k.cast("string"),
                    _suffix(k), F.lit(" (State"), (nation % 5).cast("string"), F.lit(")"))


def _plus_minutes(ts: Column, minutes: Column) -> Column:
    return F.timestamp_add("MINUTE", minutes.cast("int"), ts)


#: Lines of a part of the join of lines and orders, about.
ROWS_PER_TASK = 400_000


def _dealt_by_trip(li: DataFrame, orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides by trip, in as many parts as the lines need; a table that
    the session's number of parts holds is left to the join.  A part of the
    orders is small, so it is hashed and the lines are sorted once only, for
    the window (by the number first, which compares faster than the name)."""
    spark = li.sparkSession
    parts = -(-li.count() // ROWS_PER_TASK)
    if parts <= 2 or parts <= spark.sparkContext.defaultParallelism // 2:
        return li, orders
    return li.repartition(parts, "trip_uuid"), orders.repartition(parts, "_trip").hint("shuffle_hash")


def legs_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment table derived from the shared tables (one row per lineitem)."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_linestatus", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    supp = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")

    trip = lambda key: F.concat(F.lit("trip-"), F.col(key).cast("string"))
    li, orders = _dealt_by_trip(li.withColumn("trip_uuid", trip("l_orderkey")), orders.withColumn("_trip", trip("o_orderkey")))
    order_win = Window.partitionBy("l_orderkey", "trip_uuid").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    running = order_win.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    q = F.col("l_quantity").cast("bigint")
    d100 = F.round(F.col("l_discount") * 100).cast("bigint")
    act100 = q * (F.lit(60) + 12 * d100 + 50 * ((F.col("l_suppkey") + F.col("o_custkey")) % 5))

    j = (li.join(orders, li.trip_uuid == orders["_trip"])
         .withColumn("seg_no", F.row_number().over(order_win).cast("bigint"))
         .withColumn("q", q)
         .withColumn("act100", act100)
         .withColumn("cum_q", F.sum("q").over(running))
         .withColumn("cum_act100", F.sum("act100").over(running)))
    j = (j.join(supp, j.l_suppkey == supp.s_suppkey)
         .join(cust, j.o_custkey == cust.c_custkey))

    pk = F.col("l_partkey")
    qd = F.col("q").cast("double")
    creation_offset = F.col("l_orderkey") % 1440
    start_offset = creation_offset + F.col("seg_no") * 15 - F.when(pk % 50 == 0, 60).otherwise(0)
    seg_actual = F.when(pk % 89 == 0, -qd).otherwise(F.col("act100").cast("double") / 100)
    seg_osrm = F.when(pk % 61 == 0, F.lit(0.0)).otherwise(qd)

    return j.select(
        F.when(F.col("l_orderkey") % 10 < 7, F.lit(TRAIN_VALUE)).otherwise(F.lit(TEST_VALUE)).alias("data"),
        _plus_minutes(F.col("o_orderdate"), creation_offset).alias("trip_creation_time"),
        F.concat(F.lit("sched-"), (F.col("o_custkey") % 50).cast("string")).alias("route_schedule_uuid"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit("FTL"))
         .otherwise(F.lit("Carting")).alias("route_type"),
        F.col("trip_uuid"),
        F.col("seg_no"),
        F.concat(F.lit("F"), F.col("s_nationkey").cast("string"), F.lit("_"),
                 (F.col("l_suppkey") % 5).cast("string")).alias("source_center"),
        F.when(pk % 97 == 0, F.lit(None).cast("string"))
         .otherwise(_facility_name(F.col("s_nationkey"), F.col("l_suppkey") % 5)).alias("source_name"),
        F.concat(F.lit("F"), F.col("c_nationkey").cast("string"), F.lit("_"),
                 (F.col("o_custkey") % 5).cast("string")).alias("destination_center"),
        F.when(pk % 101 == 0, F.lit(None).cast("string"))
         .otherwise(_facility_name(F.col("c_nationkey"), F.col("o_custkey") % 5)).alias("destination_name"),
        _plus_minutes(F.col("o_orderdate"), start_offset).alias("od_start_time"),
        _plus_minutes(F.col("o_orderdate"), start_offset + F.col("q") * 3).alias("od_end_time"),
        (F.col("cum_act100").cast("double") / 100 + 30).alias("start_scan_to_end_scan"),
        (F.col("l_linestatus") == "O").alias("is_cutoff"),
        F.col("cum_q").cast("int").alias("cutoff_factor"),
        _plus_minutes(F.col("o_orderdate"), creation_offset + F.col("seg_no") * 20).alias("cutoff_timestamp"),
        ((F.col("cum_q") * 13).cast("double") / 10).alias("actual_distance_to_destination"),
        F.col("cum_q").cast("double").alias("osrm_time"),
        ((F.col("cum_q") * 12).cast("double") / 10).alias("osrm_distance"),
        (F.col("cum_act100").cast("double") / 100).alias("actual_time"),
        (F.col("cum_act100").cast("double") / 100 / F.col("cum_q").cast("double")).alias("factor"),
        seg_actual.alias("segment_actual_time"),
        seg_osrm.alias("segment_osrm_time"),
        F.when(pk % 71 == 0, F.lit(0.0)).otherwise((F.col("q") * 12).cast("double") / 10)
         .alias("segment_osrm_distance"),
        F.when(pk % 61 == 0, F.lit(None).cast("double")).otherwise(seg_actual / qd).alias("segment_factor"),
    )


def nan_to_null(df: DataFrame, columns=None) -> DataFrame:
    """NaN → NULL on double columns so aggregates skip missing values."""
    cols = [c for c in (columns or DOUBLE_COLUMNS) if c in df.columns]
    return df.withColumns({c: F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(F.col(c))
                           for c in cols})


def scan_segments(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Read the raw segment export with an explicit schema (no inference)."""
    reader = spark.read.schema(RAW_SEGMENT)
    if fmt == "csv":
        df = reader.option("header", True).option("mode", "PERMISSIVE").csv(path)
    else:
        df = reader.format(fmt).load(path)
    return nan_to_null(df)


def parse_datetimes(df: DataFrame, columns=TIMESTAMP_COLUMNS) -> DataFrame:
    """String columns → timestamp_ntz; unparseable values become NULL."""
    out = {}
    for c in columns:
        if c in df.columns and dict(df.dtypes)[c] == "string":
            out[c] = F.try_to_timestamp(F.col(c)).cast("timestamp_ntz")
    return df.withColumns(out) if out else df


def as_text(df: DataFrame, columns=TIMESTAMP_COLUMNS) -> DataFrame:
    """Timestamps rendered as a text export would hold them: fractional seconds
    on end times, and a text that is no time in every fifth segment's cutoff."""
    out = {c: F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss") for c in columns if c in df.columns}
    out["od_end_time"] = F.concat(out["od_end_time"], F.lit(".250000"))
    out["cutoff_timestamp"] = F.when(F.col("seg_no") % 5 == 0, F.lit("no time")).otherwise(out["cutoff_timestamp"])
    return df.withColumns(out)


def profile_datetimes(raw: DataFrame, columns=TIMESTAMP_COLUMNS) -> DataFrame:
    """Per text column: rows, parsed rows, their share, first and last time."""
    cols = [c for c in columns if c in raw.columns]
    df = parse_datetimes(raw, cols)
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("at")) for c in cols])).alias("x")).select("x.*")
    return long.groupBy("column").agg(F.count("*").alias("rows"), F.count("at").alias("parsed"),
                                      (F.count("at") * 100.0 / F.count("*")).alias("pct_valid"),
                                      F.min("at").alias("first"), F.max("at").alias("last"))


def load_and_prepare(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return parse_datetimes(scan_segments(spark, path, fmt))


def split_train_test(df: DataFrame, split_col: str = "data", train_value: str = TRAIN_VALUE,
                     test_value: str = TEST_VALUE) -> tuple[DataFrame, DataFrame]:
    """Two filters on one parent; persist the parent upstream when reused."""
    return df.filter(F.col(split_col) == train_value), df.filter(F.col(split_col) == test_value)
