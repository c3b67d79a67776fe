"""School-shaped tables derived from the driver's TPC-H-like tables.

The published school data is not available here, so every analysis also runs
on frames Spark derives from the driver tables. The dictionary (fixed values
of the analog, stated together):

    school (ENTITY_CD, ENTITY_NAME)  supplier: 12-digit zero-padded s_suppkey, s_name
    district name filter '% SD'      names matching 'supplier#%7' (case-insensitive)
    school year; current year        year(l_shipdate); 2000
    assessment rows                  lineitem rows: TOTAL_COUNT = NUM_TESTED = l_quantity,
                                     NUM_PROF = l_quantity of returned items (l_returnflag 'R'),
                                     ASSESSMENT_NAME = 'MATH' || l_linenumber
    'All Students' rows              every lineitem row
    stored row order (ROW_ID)        l_orderkey * 8 + l_linenumber
    subgroups                        c_mktsegment via orders and customer
    demographic percent PER_<seg>    percent of quantity by segment per (school, year)
    attendance rate                  100 - quantity-weighted mean of 100*l_discount
    per-pupil expenditure            s_acctbal, one school year (2000)
    expenditure reported flags       DATA_REPORTED_EXP 'Y' for s_nationkey < 20,
                                     DATA_REPORTED_ENR 'Y' for s_nationkey >= 2
    suspensions                      count of returned items per (school, year)
    run log                          events: launch = (event_type, user_id), name = event_type,
                                     version = user_id % 3, time = min(ts), key = min(event_id),
                                     result = event, size = 10000 * (1 + event_id % 5),
                                     run_index = event_id div 5, elapsed = value

Every frame is lazy; a ``year`` argument adds a range predicate on
``l_shipdate`` that reaches the Parquet scan (row-group skipping).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edulens import schemas
from edulens.operators.rates import guarded_ratio, weighted_mean
from edulens.session import file_state, scratch_folder

# Fixed values of the analog
CURRENT_YEAR = 2000
DISTRICT_PATTERN = "supplier#%7"
ALL_STUDENTS = "All Students"
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
FACTORS = [f"per_{s.lower()}" for s in SEGMENTS]
SIZE_STEP = 10_000


def read(spark: SparkSession, sf_dir: str, name: str, *cols: str | Column) -> DataFrame:
    """A driver table with its explicit schema, listed anew at each call."""
    df = spark.read.schema(schemas.DRIVER_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def entity_code(c) -> Column:
    """Zero-padded text code, kept as text (leading zeros matter)."""
    return F.lpad(F.col(c).cast("string"), 12, "0")


def _year_range(df: DataFrame, year: int | Column | None) -> DataFrame:
    if year is None:
        return df
    if isinstance(year, Column):  # a scalar subquery: its dates reach the scan at run time
        lo, hi = (F.make_date(y, F.lit(1), F.lit(1)) for y in (year, year + 1))
    else:
        lo, hi = (F.lit(_dt.datetime(y, 1, 1)) for y in (year, year + 1))
    return df.where((F.col("l_shipdate") >= lo.cast("timestamp_ntz")) & (F.col("l_shipdate") < hi.cast("timestamp_ntz")))


def latest_year(spark: SparkSession, sf_dir: str) -> Column:
    """The newest year of the lineitems, a maximum over the date column alone."""
    newest = read(spark, sf_dir, "lineitem", "l_shipdate").agg(F.max("l_shipdate").alias("d"))
    return newest.select(F.year("d").alias("y")).scalar()


def read_lineitem(spark, sf_dir, year, *cols) -> DataFrame:
    """Lineitems with their date, of one year when it is given."""
    return _year_range(read(spark, sf_dir, "lineitem", "l_shipdate", *cols), year)


def _with_segment(spark: SparkSession, sf_dir: str, li: DataFrame) -> DataFrame:
    orders = read(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    cust = read(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
    return (li.join(orders, li.l_orderkey == orders.o_orderkey)
              .join(cust, orders.o_custkey == cust.c_custkey))


#: The written lines of a folder, and the state of the files they were built from.
_LINES: dict[tuple, tuple[tuple, DataFrame]] = {}


def segment_lines(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """Lineitems with the segment of their order's customer, for jobs that need
    them more than once: l_suppkey, l_linenumber, l_quantity, l_returnflag,
    c_mktsegment, has_customer, ``cols`` and year. A line without an order or
    customer stays, without a segment.

    Joined once a session (anew when a file has changed) and written with a
    folder a year. Customers meet the orders first, so a lineitem is shuffled by
    its order only; the written rows of a school and year lie together, so sums
    by school and year shrink before their shuffle however many schools there are."""
    key = (spark.sparkContext.applicationId, sf_dir, cols)
    state = file_state(spark, *[f"{sf_dir}/{name}.parquet" for name in ("lineitem", "orders", "customer")])
    if _LINES.get(key, (None,))[0] != state:
        orders = read(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
        cust = read(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
        segments = orders.join(cust, orders.o_custkey == cust.c_custkey, "left").select(
            "o_orderkey", "c_mktsegment", F.col("c_custkey").isNotNull().alias("has_customer"))
        li = read(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", *cols,
                  F.year("l_shipdate").alias("year"))
        rows = li.join(segments, li.l_orderkey == segments.o_orderkey, "left").select(
            "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "c_mktsegment",
            F.coalesce("has_customer", F.lit(False)).alias("has_customer"), *cols, "year")
        path = scratch_folder(spark, "lines") + "/lines"
        (rows.hint("rebalance", "year", "l_suppkey").sortWithinPartitions("year", "l_suppkey")
         .write.partitionBy("year").parquet(path))
        _LINES[key] = state, spark.read.schema(rows.schema).parquet(path)
    return _LINES[key][1]


def subgroup_assessment(lines: DataFrame) -> DataFrame:
    """The rows that :func:`math_assessment` has under the customers' segments,
    without ROW_ID, from :func:`segment_lines`."""
    return lines.where("has_customer").select(
        entity_code("l_suppkey").alias("ENTITY_CD"), F.col("year").cast("double").alias("YEAR"),
        F.concat(F.lit("MATH"), F.col("l_linenumber").cast("string")).alias("ASSESSMENT_NAME"),
        F.col("c_mktsegment").alias("SUBGROUP_NAME"), F.col("l_quantity").alias("TOTAL_COUNT"),
        F.col("l_quantity").alias("NUM_TESTED"),
        F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(F.lit(0.0)).alias("NUM_PROF"))


def math_assessment(spark: SparkSession, sf_dir: str, year: int | None = None,
                    with_subgroups: bool = False) -> DataFrame:
    """'Annual EM MATH' analog: one 'All Students' row per lineitem, plus one
    row per lineitem under its customer's segment when ``with_subgroups``."""
    li = read_lineitem(spark, sf_dir, year, "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag")

    def shape(df: DataFrame, subgroup: Column) -> DataFrame:
        return df.select(
            entity_code("l_suppkey").alias("ENTITY_CD"),
            F.year("l_shipdate").cast("double").alias("YEAR"),
            F.concat(F.lit("MATH"), F.col("l_linenumber").cast("string")).alias("ASSESSMENT_NAME"),
            subgroup.alias("SUBGROUP_NAME"),
            F.col("l_quantity").alias("TOTAL_COUNT"),
            F.col("l_quantity").alias("NUM_TESTED"),
            F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(F.lit(0.0)).alias("NUM_PROF"),
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("ROW_ID"),
        )

    out = shape(li, F.lit(ALL_STUDENTS))
    if with_subgroups:
        out = out.unionByName(shape(_with_segment(spark, sf_dir, li), F.col("c_mktsegment")))
    return out


#: The part type whose lines are mathematics; the other types are subjects of their own.
MATH_TYPE = "STANDARD"


def subject_assessment(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Assessment rows of several subjects (the part's type), of all students and
    of each segment; ``lines``: :func:`segment_lines` with l_partkey, if written already."""
    if lines is None:
        li = read_lineitem(spark, sf_dir, None, "l_orderkey", "l_suppkey", "l_partkey", "l_quantity", "l_returnflag")
        lines = _with_segment(spark, sf_dir, li).withColumn("year", F.year("l_shipdate"))
    else:
        lines = lines.where("has_customer")
    part = read(spark, sf_dir, "part", "p_partkey", "p_type")
    math = F.col("p_type") == MATH_TYPE
    rows = lines.join(part, F.col("l_partkey") == part.p_partkey)
    return rows.select(
        entity_code("l_suppkey").alias("ENTITY_CD"), F.col("year").cast("double").alias("YEAR"),
        F.when(math, "Math").otherwise(F.col("p_type")).alias("SUBJECT_ID"),
        F.when(math, "Mathematics").otherwise(F.initcap("p_type")).alias("SUBJECT_NAME"),
        F.explode(F.array(F.lit(ALL_STUDENTS), F.col("c_mktsegment"))).alias("SUBGROUP_NAME"),
        F.col("l_quantity").alias("NUM_TESTED"),
        F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(F.lit(0.0)).alias("NUM_PROF"))


def demographic_factors(spark: SparkSession, sf_dir: str, year: int | None = None, lines: DataFrame | None = None) -> DataFrame:
    """'Demographic Factors' analog per (school, year): NUM_<SEGMENT> = quantity
    bought by customers of the segment, PER_<SEGMENT> = its percent of the
    school's quantity (one pass of conditional sums). ``lines``: the rows of
    :func:`segment_lines`, if written already."""
    if lines is None:
        li = read_lineitem(spark, sf_dir, year, "l_orderkey", "l_suppkey", "l_quantity")
        lines = _with_segment(spark, sf_dir, li).withColumn("year", F.year("l_shipdate"))
    else:
        lines = lines.where("has_customer" if year is None else f"has_customer AND year = {int(year)}")
    rows = lines.select(entity_code("l_suppkey").alias("ENTITY_CD"), F.col("year").cast("double").alias("YEAR"),
                        "c_mktsegment", "l_quantity")
    seg, q = F.col("c_mktsegment"), F.col("l_quantity")
    g = rows.groupBy("ENTITY_CD", "YEAR").agg(
        F.sum(q).alias("_total"),
        *[F.coalesce(F.sum(F.when(seg == s, q)), F.lit(0.0)).alias(f"NUM_{s}") for s in SEGMENTS])
    return g.select("ENTITY_CD", "YEAR",
                    *[c for s in SEGMENTS for c in (F.col(f"NUM_{s}"),
                                                    guarded_ratio(f"NUM_{s}", "_total", 100.0).alias(f"PER_{s}"))])


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "supplier", "s_suppkey", "s_name")


def attendance(spark: SparkSession, sf_dir: str, year: int | None = None) -> DataFrame:
    """'Attendance' analog per (school, year)."""
    li = read_lineitem(spark, sf_dir, year, "l_suppkey", "l_quantity", "l_discount")
    li = li.select("l_suppkey", F.year("l_shipdate").alias("y"), "l_quantity",
                   (F.col("l_discount") * 100).alias("absence"))
    att = weighted_mean(li, ["l_suppkey", "y"], "absence", "l_quantity", name="absence_rate",
                        complement=100.0, complement_name="ATTENDANCE_RATE")
    names = _names(spark, sf_dir)
    return att.join(names, att.l_suppkey == names.s_suppkey).select(
        entity_code("l_suppkey").alias("ENTITY_CD"), F.col("s_name").alias("ENTITY_NAME"),
        F.col("y").cast("double").alias("YEAR"), "ATTENDANCE_RATE", F.lit("Y").alias("DATA_REPORTED"))


def expenditures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """'Expenditures per Pupil' analog (one school year)."""
    s = read(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    return s.select(
        entity_code("s_suppkey").alias("ENTITY_CD"), F.col("s_name").alias("ENTITY_NAME"),
        F.lit(CURRENT_YEAR).cast("int").alias("YEAR"),
        F.col("s_acctbal").alias("PER_FED_STATE_LOCAL_EXP"),
        F.when(F.col("s_nationkey") >= 2, "Y").otherwise("N").alias("DATA_REPORTED_ENR"),
        F.when(F.col("s_nationkey") < 20, "Y").otherwise("N").alias("DATA_REPORTED_EXP"),
    )


def suspensions(spark: SparkSession, sf_dir: str, year: int | None = None) -> DataFrame:
    """'Suspensions' analog: returned items per (school, year)."""
    li = read_lineitem(spark, sf_dir, year, "l_suppkey", "l_returnflag")
    agg = (li.groupBy("l_suppkey", F.year("l_shipdate").alias("y"))
             .agg(F.count(F.when(F.col("l_returnflag") == "R", F.lit(1))).alias("k"), F.count(F.lit(1)).alias("m")))
    names = _names(spark, sf_dir)
    return agg.join(names, agg.l_suppkey == names.s_suppkey).select(
        entity_code("l_suppkey").alias("ENTITY_CD"), F.col("s_name").alias("ENTITY_NAME"),
        F.col("y").cast("double").alias("YEAR"), F.col("k").cast("double").alias("NUM_SUSPENSIONS"),
        (F.lit(100.0) * F.col("k") / F.col("m")).alias("PER_SUSPENSIONS"), F.lit("Y").alias("DATA_REPORTED"))


def school_year_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """What the other published databases know of a (school, year), each summed
    up by itself (fixed values of the analog): participation, the percent of
    quantity on finished lines ('F'); absenteeism, the percent of lines with a
    discount of 8 % or more; lunch, the percent of quantity bought by HOUSEHOLD;
    class size, the mean quantity; staffing, lines taxed under 2 % and their
    ratio to all; suspensions, returned lines."""
    def by(*aggs: Column, cols: tuple[str, ...]) -> DataFrame:
        li = read_lineitem(spark, sf_dir, None, "l_suppkey", *cols)
        return li.groupBy(entity_code("l_suppkey").alias("entity_cd"), F.year("l_shipdate").alias("year")).agg(*aggs)

    share = lambda part, whole: F.lit(100.0) * F.try_divide(F.sum(part), F.sum(whole))
    one, zero = F.lit(1.0), F.lit(0.0)
    q = F.col("l_quantity")
    return {
        "participation": by(share(F.when(F.col("l_linestatus") == "F", q).otherwise(zero), q).alias("participation_rate"),
                            cols=("l_quantity", "l_linestatus")),
        "absenteeism": by(share(F.when(F.col("l_discount") >= 0.08, one).otherwise(zero), one).alias("chronic_absence_rate"), cols=("l_discount",)),
        "lunch": demographic_factors(spark, sf_dir).select(F.col("ENTITY_CD").alias("entity_cd"), F.col("YEAR").cast("int").alias("year"),
                                                           F.col("PER_HOUSEHOLD").alias("free_lunch_rate")),
        "class_size": by(F.avg(q).alias("class_size"), cols=("l_quantity",)),
        "staffing": by(F.count_if(F.col("l_tax") < 0.02).alias("n_teachers"),
                       F.try_divide(F.count(F.lit(1)), F.count_if(F.col("l_tax") < 0.02)).alias("students_per_teacher"), cols=("l_tax",)),
        "suspension": by(F.count_if(F.col("l_returnflag") == "R").alias("n_suspensions"), cols=("l_returnflag",)),
        "spending": expenditures(spark, sf_dir).select(F.col("ENTITY_CD").alias("entity_cd"), F.col("YEAR").alias("year"),
                                                       F.col("PER_FED_STATE_LOCAL_EXP").alias("per_pupil_expenditure")),
    }


# --- run log ----------------------------------------------------------------------

def run_log(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(query_launch, query_result) analog from ``events``. A launch's key is
    its first event id (unique, like a key handed out at its first insert)."""
    ev = read(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    launch = (ev.groupBy("event_type", "user_id")
                .agg(F.min("event_id").alias("launch_id"), F.min("ts").alias("timestamp")))
    result = (ev.join(launch.select("launch_id", "event_type", "user_id"), ["event_type", "user_id"])
                .select(F.col("event_id").alias("result_id"), "launch_id",
                        (F.lit(SIZE_STEP) * (1 + F.col("event_id") % 5)).cast("long").alias("dataset_size"),
                        F.floor(F.col("event_id") / 5).cast("int").alias("run_index"),
                        F.col("value").alias("elapsed_seconds")))
    launch = launch.select("launch_id", "timestamp", F.col("event_type").alias("query_name"),
                           (F.col("user_id") % 3).cast("string").alias("query_version"))
    return launch, result
