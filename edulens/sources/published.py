"""The published school tables, two releases of them, derived from the driver's
tables with everything that the cleaning and the filters are there for.

A release is a set of databases whose names end in its school year; it holds two
years, so one year is in both and its counts differ. The dictionary (fixed
values, stated together; schools, names and rates as in
:mod:`edulens.sources.driver_tables`):

    tested t               40 times l_quantity in the newer release, 39 times in the older
    NUM_TESTED             t as text with thousands commas; TOTAL_COUNT: t + l_linenumber, likewise
    NUM_PROF               returned items: t, half of it in the rows of a subgroup; accepted ('A'): a blank, t div 4 and '.7 '; others: 's', or '' on even lines
    ASSESSMENT_NAME        lines 3, 6: ELA; 1, 4, 7: Math; others: MATH; then the line
    SUBGROUP_NAME          line 1: ' all students (K-8) ', others 'All Students'; and once more the subgroup of
                           the customer's segment
    demographics           NUM_x, PER_x of the segment's column, PER_WHITE = 100 - PER_ELL, others unknown
    expenditures           the newer year of the release; the older release has 90 % of the balance
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from edulens import schemas
from edulens.session import file_state, scratch_folder
from edulens.sources import driver_tables as dt
from edulens.sources.registry import DATABASES, Database, TableSource, table_name

#: release -> its years and the factor of its counts (fixed values)
RELEASES = {"23_24": ((1999, 2000), 40), "22_23": ((1998, 1999), 39)}
#: segment -> published subgroup and column
SUBGROUPS = {
    "AUTOMOBILE": ("English Language Learner", "ELL"),
    "BUILDING": ("Students with Disabilities", "SWD"),
    "FURNITURE": ("Economically Disadvantaged", "ECDIS"),
    "HOUSEHOLD": ("Black or African American", "BLACK"),
    "MACHINERY": ("Hispanic or Latino", "HISP"),
}
SOURCES = ("lineitem", "orders", "customer", "supplier")


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the columns of ``schema``; those that ``df`` lacks are NULL."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def _in_years(df: DataFrame, years: tuple[int, int]) -> DataFrame:
    return df.where((F.col("YEAR") >= years[0]) & (F.col("YEAR") <= years[1]))


def _commas(n: Column) -> Column:
    return F.format_number(n, 0)


def annual_em_math(spark: SparkSession, d: str, release: str) -> DataFrame:
    years, factor = RELEASES[release]
    names = dt.read(spark, d, "supplier", "s_suppkey", "s_name")
    lines = dt.segment_lines(spark, d)

    def of_year(y: int) -> DataFrame:
        li = lines.where(F.col("year") == y)
        return li.join(names, li.l_suppkey == names.s_suppkey, "left")

    li = reduce(DataFrame.unionByName, map(of_year, years))  # no task has rows of two years
    line, flag = F.col("l_linenumber"), F.col("l_returnflag")
    t = F.col("l_quantity").cast("long") * factor
    segment = F.element_at(F.create_map(*[F.lit(x) for s, (name, _) in SUBGROUPS.items() for x in (s, name)]), F.col("c_mktsegment"))
    subgroups = F.array(F.when(line == 1, " all students (K-8) ").otherwise("All Students"), segment)
    rows = li.select("*", F.posexplode(subgroups).alias("one_group", "SUBGROUP_NAME")).select(
        dt.entity_code("l_suppkey").alias("ENTITY_CD"), F.col("s_name").alias("ENTITY_NAME"), F.col("year").alias("YEAR"),
        F.concat(F.when(line % 3 == 0, "ELA").when(line % 3 == 1, "Math").otherwise("MATH"), line.cast("string")).alias("ASSESSMENT_NAME"),
        "SUBGROUP_NAME", _commas(t + line).alias("TOTAL_COUNT"), _commas(t).alias("NUM_TESTED"),
        F.when(flag == "R", _commas(F.when(F.col("one_group") == 1, F.floor(t / 2)).otherwise(t))).when(flag == "A", F.concat(F.lit(" "), F.floor(t / 4).cast("string"), F.lit(".7 ")))
        .when(line % 2 == 1, "s").otherwise("").alias("NUM_PROF"))
    return conform(rows, schemas.ANNUAL_EM_MATH)


def demographic_factors(spark: SparkSession, d: str, release: str) -> DataFrame:
    df = _in_years(dt.demographic_factors(spark, d, lines=dt.segment_lines(spark, d)), RELEASES[release][0])
    columns = [F.col(f"{p}_{s}").alias(f"{p}_{c}") for s, (_, c) in SUBGROUPS.items() for p in ("NUM", "PER")]
    return conform(df.select("ENTITY_CD", "YEAR", *columns, (100 - F.col("PER_AUTOMOBILE")).alias("PER_WHITE")), schemas.DEMOGRAPHIC_FACTORS)


def expenditures(spark: SparkSession, d: str, release: str) -> DataFrame:
    years, _ = RELEASES[release]
    share = 1.0 if release == "23_24" else 0.9
    df = dt.expenditures(spark, d)
    return conform(df.withColumn("YEAR", F.lit(years[1])).withColumn("PER_FED_STATE_LOCAL_EXP", F.col("PER_FED_STATE_LOCAL_EXP") * share),
                   schemas.EXPENDITURES_PER_PUPIL)


def attendance(spark: SparkSession, d: str, release: str) -> DataFrame:
    return conform(_in_years(dt.attendance(spark, d), RELEASES[release][0]), schemas.ATTENDANCE)


def suspensions(spark: SparkSession, d: str, release: str) -> DataFrame:
    return conform(_in_years(dt.suspensions(spark, d), RELEASES[release][0]), schemas.SUSPENSIONS)


FRAMES = {
    ("reportcard", "Annual EM MATH"): annual_em_math,
    ("reportcard", "Expenditures per Pupil"): expenditures,
    ("enrollment", "Demographic Factors"): demographic_factors,
    ("student_educator", "Attendance"): attendance,
    ("student_educator", "Suspensions"): suspensions,
}


#: Tables whose rows come by year and school already, with their texts made after the last shuffle.
LAID_OUT = {"Annual EM MATH"}


def databases(root: str) -> list[Database]:
    """The databases under ``root``: those of both releases with the tables that
    are published there, and the others of the catalog without any yet."""
    found = []
    for name in DATABASES:
        tables = [TableSource(t, f"{root}/{name}/{table_name(t)}", schemas.RAW_TABLES[t])
                  for (topic, t) in FRAMES for release in RELEASES if name == f"{topic}_database_{release}"]
        found.append(Database(name, tuple(tables)))
    return found


def publish(spark: SparkSession, d: str, root: str, parallel: int = 4) -> list[Database]:
    """Write the tables of both releases under ``root`` (a shared folder), as
    concurrent jobs, rows of a year together so that a year's filter skips files."""
    dt.segment_lines(spark, d)  # several tables need them

    def write(topic: str, table: str, release: str) -> None:
        frame = FRAMES[topic, table](spark, d, release)
        if table not in LAID_OUT:
            frame = frame.hint("rebalance", "YEAR").sortWithinPartitions("YEAR", "ENTITY_CD")
        (frame.write.mode("overwrite").parquet(f"{root}/{topic}_database_{release}/{table_name(table)}"))

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        for job in [pool.submit(write, topic, table, release) for topic, table in FRAMES for release in RELEASES]:
            job.result()
    return databases(root)


_PUBLISHED: dict[tuple[str, str], tuple[tuple, list[Database]]] = {}


def published(spark: SparkSession, d: str) -> list[Database]:
    """The published databases of ``d``, written once a session; anew when a file of ``d`` has changed."""
    key, state = (spark.sparkContext.applicationId, d), file_state(spark, *[f"{d}/{s}.parquet" for s in SOURCES])
    if _PUBLISHED.get(key, (None,))[0] != state:
        _PUBLISHED[key] = state, publish(spark, d, scratch_folder(spark, "published"))
    return _PUBLISHED[key][1]


__all__ = ["RELEASES", "SUBGROUPS", "conform", "databases", "publish", "published"]
