"""Incremental load of the star: keys stay, changed years are replaced.

Dimensions grow by appending. A member that is known keeps its key, new ones
follow in order of their codes, and a later name is a further row of the same
key, of which the reader takes the last. Facts have a folder a year; a load
replaces the years that it declares and leaves the files of others as they are.

A load that was cut off can be run again: the members it had appended are known
then, and its years are overwritten once more. One load runs at a time.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edulens.functions import to_number, year_of
from edulens.operators.ranking import global_row_number
from edulens.plans.star import StarTables
from edulens.session import hadoop_fs, scratch_folder

#: dimension -> its key, code and label columns
DIMENSIONS = {
    "dim_school": ("school_key", "long", "school_id", "school_name"),
    "dim_subject": ("subject_key", "int", "subject_id", "subject_name"),
    "dim_subgroup": ("subgroup_key", "int", "subgroup_id", "subgroup_name"),
}
FACTS = {
    "fact_assessment": "school_key long, subject_key int, subgroup_key int, tested long, n_qual long, year_key int",
    "fact_enrollment": "school_key long, subgroup_key int, n_students long, year_key int",
    "fact_attendance": "school_key long, subgroup_key int, absence_rate double, enrollment long, year_key int",
}


@dataclass(frozen=True)
class Batch:
    """Raw frames of the years that a load replaces. ``math_rows``: ENTITY_CD, YEAR,
    SUBJECT_ID, SUBJECT_NAME, SUBGROUP_NAME, NUM_TESTED, NUM_PROF. ``demo_counts``:
    ENTITY_CD, YEAR and a count column for each subgroup of ``count_columns``.
    ``attendance``: ENTITY_CD, YEAR, ATTENDANCE_RATE. ``schools``: ENTITY_CD,
    ENTITY_NAME. Rows without a code, subject or subgroup have no place in the star."""

    years: tuple[int, ...]
    math_rows: DataFrame
    demo_counts: DataFrame
    attendance: DataFrame
    schools: DataFrame
    count_columns: Mapping[str, str]
    all_label: str = "All Students"
    all_id: str = "All"
    #: Its rows of all students say how many are enrolled.
    main_subject: str = "Math"


def _exists(spark: SparkSession, path: str) -> bool:
    fs, where = hadoop_fs(spark, path)
    return fs.exists(where)


def read_dimension(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One row a member, with its last name that is not null."""
    key, kind, code, label = DIMENSIONS[name]
    schema = f"{key} {kind}, {code} string, {label} string, load long"
    if not _exists(spark, f"{root}/{name}"):
        return spark.createDataFrame([], schema).drop("load")
    rows = spark.read.schema(schema).parquet(f"{root}/{name}")
    last = F.max(F.when(F.col(label).isNotNull(), F.struct("load", label)))
    return rows.groupBy(key, code).agg(last.alias("_last")).select(key, code, F.col(f"_last.{label}").alias(label))


def read_star(spark: SparkSession, root: str) -> StarTables:
    dims = {n: read_dimension(spark, root, n) for n in DIMENSIONS}
    facts = {n: spark.read.schema(s).parquet(f"{root}/{n}") if _exists(spark, f"{root}/{n}") else spark.createDataFrame([], s)
             for n, s in FACTS.items()}
    years = facts["fact_assessment"].select("year_key")
    for name in ("fact_enrollment", "fact_attendance"):
        years = years.unionByName(facts[name].select("year_key"))
    dim_year = years.dropDuplicates().select("year_key", F.col("year_key").cast("string").alias("school_year_label"))
    return StarTables(dim_year=dim_year, **dims, **facts)


def _grow(spark: SparkSession, root: str, name: str, offered: DataFrame, load: int) -> DataFrame:
    """Append the members of ``offered`` (code, label) that are new, or have
    another name than before; the dimension as it is then."""
    key, kind, code, label = DIMENSIONS[name]
    offered = offered.where(F.col(code).isNotNull()).groupBy(code).agg(F.max(label).alias(label))
    known = read_dimension(spark, root, name).withColumnRenamed(label, "_old")
    both = offered.join(known, code, "left")
    last = known.agg(F.coalesce(F.max(key), F.lit(0)).alias("k")).scalar()
    fresh = global_row_number(both.where(F.col(key).isNull()).select(code, label), [code], name="_rank")
    rows = (fresh.select((last + F.col("_rank")).cast(kind).alias(key), code, label)
            .unionByName(both.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~F.col(label).eqNullSafe(F.col("_old")))
                         .select(key, code, label)).withColumn("load", F.lit(load).cast("long")))
    rows.write.mode("append").parquet(f"{root}/{name}")
    return read_dimension(spark, root, name)


def _replace(spark: SparkSession, root: str, name: str, fact: DataFrame, held: DataFrame, years: Iterable[int]) -> None:
    """Overwrite the folders of ``years``; a year without rows any more loses its
    folder. ``held``: the year_key of the fact's rows, without the joins that drop none."""
    columns = [f.split(" ") for f in FACTS[name].split(", ")]
    (fact.select(*[F.col(c).cast(kind).alias(c) for c, kind in columns]).hint("rebalance", "year_key")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year_key").parquet(f"{root}/{name}"))
    left = {r["year_key"] for r in held.select("year_key").distinct().collect()}
    for year in set(years) - left:
        fs, where = hadoop_fs(spark, f"{root}/{name}/year_key={year}")
        fs.delete(where, True)


def load_star(spark: SparkSession, root: str, batch: Batch, load: int) -> StarTables:
    """Load the years of ``batch`` into the star under ``root``; ``load`` numbers
    the loads. Returns the star as it is then."""
    scratch = scratch_folder(spark, "load")
    in_years = F.col("year_key").isin(list(batch.years))

    def staged(name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{scratch}/{name}")
        return spark.read.schema(df.schema).parquet(f"{scratch}/{name}")

    m, a = batch.math_rows, batch.attendance
    # the name is a key here: a maximum of texts would sort every raw row
    by_name = staged("assessment", m.groupBy("ENTITY_CD", year_of(m, "YEAR").alias("year_key"), "SUBJECT_ID", "SUBJECT_NAME", "SUBGROUP_NAME").agg(
        F.sum(to_number(m, "NUM_TESTED", integral=True)).alias("tested"),
        F.sum(to_number(m, "NUM_PROF", integral=True)).alias("n_qual")).where(in_years))
    # by school alone, as the join with the schools needs them too
    natural = by_name.repartition("ENTITY_CD").groupBy("ENTITY_CD", "year_key", "SUBJECT_ID", "SUBGROUP_NAME").agg(
        F.sum("tested").alias("tested"), F.sum("n_qual").alias("n_qual"))
    stack = F.array(*[F.struct(F.lit(name).alias("SUBGROUP_NAME"), to_number(batch.demo_counts, col, integral=True).alias("n_students"))
                      for col, name in batch.count_columns.items()])
    enrolled = staged("enrollment", batch.demo_counts.select(
        "ENTITY_CD", year_of(batch.demo_counts, "YEAR").alias("year_key"), F.inline(stack)).where(in_years))
    absent = staged("attendance", a.select("ENTITY_CD", year_of(a, "YEAR").alias("year_key"),
                                           (100.0 - to_number(a, "ATTENDANCE_RATE")).alias("absence_rate")).where(in_years))

    codes = batch.schools.select(F.col("ENTITY_CD").alias("school_id"), F.col("ENTITY_NAME").alias("school_name"))
    for df in (by_name, enrolled, absent):
        codes = codes.unionByName(df.select(F.col("ENTITY_CD").alias("school_id")).distinct()
                                  .withColumn("school_name", F.lit(None).cast("string")))
    schools = _grow(spark, root, "dim_school", staged("schools", codes.groupBy("school_id").agg(F.max("school_name").alias("school_name"))), load)
    subjects = _grow(spark, root, "dim_subject", by_name.select(F.col("SUBJECT_ID").alias("subject_id"), F.col("SUBJECT_NAME").alias("subject_name")).distinct(), load)
    names = by_name.select("SUBGROUP_NAME").unionByName(enrolled.select("SUBGROUP_NAME")).distinct()
    group_id = F.when(F.col("SUBGROUP_NAME") == batch.all_label, batch.all_id).otherwise(F.col("SUBGROUP_NAME"))
    subgroups = _grow(spark, root, "dim_subgroup", names.select(group_id.alias("subgroup_id"), F.col("SUBGROUP_NAME").alias("subgroup_name")), load)

    school = schools.select(F.col("school_id").alias("ENTITY_CD"), "school_key")
    subject = subjects.select(F.col("subject_id").alias("SUBJECT_ID"), "subject_key")
    group = subgroups.select(F.col("subgroup_name").alias("SUBGROUP_NAME"), "subgroup_key")
    # every code that is not null has a school by now
    coded = F.col("ENTITY_CD").isNotNull()
    _replace(spark, root, "fact_assessment", natural.join(school, "ENTITY_CD").join(subject, "SUBJECT_ID").join(group, "SUBGROUP_NAME"),
             by_name.where(coded).join(subject, "SUBJECT_ID").join(group, "SUBGROUP_NAME"), batch.years)
    _replace(spark, root, "fact_enrollment", enrolled.join(school, "ENTITY_CD").join(group, "SUBGROUP_NAME"),
             enrolled.where(coded).join(group, "SUBGROUP_NAME"), batch.years)
    totals = natural.where((F.col("SUBGROUP_NAME") == batch.all_label) & (F.col("SUBJECT_ID") == batch.main_subject)).select(
        "ENTITY_CD", "year_key", F.col("tested").alias("enrollment"))
    everyone = subgroups.where(F.col("subgroup_id") == batch.all_id).select("subgroup_key").scalar()
    _replace(spark, root, "fact_attendance", absent.join(totals, ["ENTITY_CD", "year_key"], "left").join(school, "ENTITY_CD")
             .withColumn("subgroup_key", everyone), absent.where(coded), batch.years)
    return read_star(spark, root)


def by_codes(star: StarTables) -> DataFrame:
    """All facts by their members' codes, which do not depend on the order of the
    loads: fact, school, year, subject, subgroup, m1, m2."""
    school = star.dim_school.select("school_key", F.col("school_id").alias("school"))
    group = star.dim_subgroup.select("subgroup_key", F.col("subgroup_id").alias("subgroup"))
    subject = star.dim_subject.select("subject_key", F.col("subject_id").alias("subject"))
    none = F.lit(None)

    def coded(name, df, m1, m2):
        df = df.join(school, "school_key").join(group, "subgroup_key")
        df = df.join(subject, "subject_key") if "subject_key" in df.columns else df.withColumn("subject", none.cast("string"))
        return df.select(F.lit(name).alias("fact"), "school", F.col("year_key").alias("year"), "subject", "subgroup",
                         m1.cast("double").alias("m1"), m2.cast("double").alias("m2"))

    return (coded("fact_assessment", star.fact_assessment, F.col("tested"), F.col("n_qual"))
            .unionByName(coded("fact_enrollment", star.fact_enrollment, F.col("n_students"), none))
            .unionByName(coded("fact_attendance", star.fact_attendance, F.col("absence_rate"), F.col("enrollment"))))
