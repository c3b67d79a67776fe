"""Star schema: build it from the raw tables, then the star-schema analyses.

Dimensions: dim_school (surrogate key over the sorted school codes), dim_year
(natural key), dim_subject, dim_subgroup (surrogate key over sorted names).
Facts: fact_assessment (tested, n_qual per year x school x subject x
subgroup), fact_enrollment (students per year x school x subgroup),
fact_attendance (absence rate and enrollment per year x school x subgroup).

No join is hinted: the planner broadcasts a dimension only when its size
estimate (file sizes of a written table) is under the broadcast threshold,
and AQE re-checks actual sizes at run time. dim_school grows with the data
and so stays a shuffled join once it is large.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edulens.functions import label_startswith, not_like_ci, positive, flag_is, to_number, year_equals, year_of
from edulens.operators.rates import grouped_rate, guarded_ratio, share_of_group, weighted_mean
from edulens.operators.ranking import dense_keys, global_row_number
from edulens.operators.stats import factor_table, pair_count_expr, pearson, pearson_expr

ALL_PREFIX = "ALL STUDENTS"


@dataclass(frozen=True)
class StarTables:
    dim_school: DataFrame
    dim_year: DataFrame
    dim_subject: DataFrame
    dim_subgroup: DataFrame
    fact_assessment: DataFrame
    fact_enrollment: DataFrame
    fact_attendance: DataFrame
    #: fact, rows_in, rows_rejected: natural rows offered, and those without a school code or subgroup
    intake: DataFrame | None = None

    def as_dict(self) -> dict[str, DataFrame]:
        return {n: df for n, df in self.__dict__.items() if df is not None}


def build_star(spark: SparkSession, math_rows: DataFrame, demo_counts: DataFrame, attendance: DataFrame,
               schools: DataFrame, count_columns: Mapping[str, str], all_label: str = "All Students",
               all_id: str = "All", subgroup_ids: Mapping[str, str] | None = None,
               subject: tuple[str, str] = ("Math", "Mathematics"),
               stage=None) -> StarTables:
    """Star tables from raw frames.

    math_rows:   ENTITY_CD, YEAR, SUBGROUP_NAME, NUM_TESTED, NUM_PROF (all
                 subgroups, the 'All Students' rows included)
    demo_counts: ENTITY_CD, YEAR and one count column per subgroup;
                 ``count_columns`` maps column -> subgroup name
    attendance:  ENTITY_CD, YEAR, ATTENDANCE_RATE ('All Students' level)
    schools:     ENTITY_CD, ENTITY_NAME (any number of rows per code)

    A code that only the measures know gets a school without a name, so its
    rows stay. Rows without a code or a subgroup belong to no member of a
    dimension; ``intake`` counts them for each fact.

    The large inputs are aggregated once to their natural keys (school code,
    year, subgroup name); the dimensions are derived from those aggregates,
    and the facts are keyed by joining them with the dimensions.
    ``stage(name, df) -> df`` is applied to every intermediate and final table
    (e.g. write to the shared folder and read back, which computes each once
    and cuts the lineage); by default the build stays lazy.
    """
    stage = stage or (lambda name, df: df)

    def wave(tables: dict) -> dict:
        """Stage tables that do not depend on each other (concurrently when
        the stage function offers ``many``)."""
        many = getattr(stage, "many", None)
        return many(tables) if many else {n: stage(n, df) for n, df in tables.items()}

    ids = dict(subgroup_ids or {})
    ids.setdefault(all_label, all_id)

    # 1. natural-key aggregates of the big inputs (one pass each)
    fa_nat = math_rows.groupBy(
        "ENTITY_CD", year_of(math_rows, "YEAR").alias("year_key"), "SUBGROUP_NAME").agg(
        F.sum(to_number(math_rows, "NUM_TESTED", integral=True)).cast("long").alias("tested"),
        F.sum(to_number(math_rows, "NUM_PROF", integral=True)).cast("long").alias("n_qual"))
    stack = F.array(*[F.struct(F.lit(name).alias("SUBGROUP_NAME"),
                               to_number(demo_counts, col, integral=True).alias("n_students"))
                      for col, name in count_columns.items()])
    enr_nat = demo_counts.select("ENTITY_CD", year_of(demo_counts, "YEAR").alias("year_key"), F.inline(stack))
    att_nat = attendance.select("ENTITY_CD", year_of(attendance, "YEAR").alias("year_key"),
                                (F.lit(100.0) - to_number(attendance, "ATTENDANCE_RATE")).alias("absence_rate"))
    nat = wave({"_fa_natural": fa_nat, "_enrollment_natural": enr_nat, "_attendance_natural": att_nat})
    fa_nat, enr_nat, att_nat = nat["_fa_natural"], nat["_enrollment_natural"], nat["_attendance_natural"]

    # 2. dimensions
    codes = schools.select("ENTITY_CD", "ENTITY_NAME")
    for natural in (fa_nat, enr_nat, att_nat):
        # distinct first: a maximum of texts sorts the rows it is taken over
        codes = codes.unionByName(natural.select("ENTITY_CD").distinct().withColumn("ENTITY_NAME", F.lit(None).cast("string")))
    names = stage("_school_names", codes.where(F.col("ENTITY_CD").isNotNull())
                  .groupBy("ENTITY_CD").agg(F.max("ENTITY_NAME").alias("school_name")))
    dim_school = (global_row_number(names, ["ENTITY_CD"], name="school_key")
                  .select(F.col("school_key").cast("long"), F.col("ENTITY_CD").alias("school_id"), "school_name"))

    sub_names = fa_nat.select("SUBGROUP_NAME").unionByName(enr_nat.select("SUBGROUP_NAME"))
    dim_subgroup = dense_keys(sub_names.where(F.col("SUBGROUP_NAME").isNotNull()), ["SUBGROUP_NAME"], "subgroup_key")
    id_expr = F.col("SUBGROUP_NAME")
    for name, sid in ids.items():
        id_expr = F.when(F.col("SUBGROUP_NAME") == F.lit(name), F.lit(sid)).otherwise(id_expr)
    dim_subgroup = dim_subgroup.select(F.col("subgroup_key").cast("int"), id_expr.alias("subgroup_id"),
                                       F.col("SUBGROUP_NAME").alias("subgroup_name"))

    dim_year = (fa_nat.select("year_key").unionByName(enr_nat.select("year_key"))
                     .unionByName(att_nat.select("year_key")).dropDuplicates()
                     .select("year_key", F.col("year_key").cast("string").alias("school_year_label")))
    dim_subject = spark.createDataFrame([(1, subject[0], subject[1])],
                                        "subject_key int, subject_id string, subject_name string")
    dims = wave({"dim_school": dim_school, "dim_subgroup": dim_subgroup, "dim_year": dim_year,
                 "dim_subject": dim_subject})
    dim_school, dim_subgroup, dim_year, dim_subject = (dims[n] for n in ("dim_school", "dim_subgroup", "dim_year",
                                                                         "dim_subject"))

    # 3. facts keyed by the dimensions; join strategies are left to the
    #    planner and AQE, which broadcast a side only when its (estimated,
    #    then actual) size is under the broadcast threshold
    school_key = dim_school.select(F.col("school_id").alias("ENTITY_CD"), "school_key")
    sg_key = dim_subgroup.select(F.col("subgroup_name").alias("SUBGROUP_NAME"), "subgroup_key")
    fact_assessment = (fa_nat.join(school_key, "ENTITY_CD").join(sg_key, "SUBGROUP_NAME")
                       .select("year_key", "school_key", F.lit(1).alias("subject_key"), "subgroup_key",
                                    "tested", "n_qual"))
    fact_enrollment = (enr_nat.join(school_key, "ENTITY_CD").join(sg_key, "SUBGROUP_NAME")
                       .select("year_key", "school_key", "subgroup_key", F.col("n_students").cast("long")))
    totals = fa_nat.where(F.col("SUBGROUP_NAME") == F.lit(all_label)).select(
        "ENTITY_CD", "year_key", F.col("tested").alias("enrollment"))
    all_key = sg_key.where(F.col("SUBGROUP_NAME") == F.lit(all_label)).select("subgroup_key")
    fact_attendance = (att_nat.join(totals, ["ENTITY_CD", "year_key"], "left")
                       .join(school_key, "ENTITY_CD")
                            .select("year_key", "school_key", all_key.scalar().cast("int").alias("subgroup_key"),
                                    "absence_rate", F.col("enrollment").cast("long")))
    no_school, no_subgroup = F.col("ENTITY_CD").isNull(), F.col("SUBGROUP_NAME").isNull()
    intake = None
    for name, natural, lost in (("fact_assessment", fa_nat, no_school | no_subgroup),
                                ("fact_enrollment", enr_nat, no_school | no_subgroup),
                                ("fact_attendance", att_nat, no_school)):
        row = natural.agg(F.count(F.lit(1)).alias("rows_in"), F.count_if(lost).alias("rows_rejected")).select(
            F.lit(name).alias("fact"), "rows_in", "rows_rejected")
        intake = row if intake is None else intake.unionByName(row)
    facts = wave({"fact_assessment": fact_assessment, "fact_enrollment": fact_enrollment,
                  "fact_attendance": fact_attendance, "intake": intake})
    return StarTables(dim_school, dim_year, dim_subject, dim_subgroup, facts["fact_assessment"],
                      facts["fact_enrollment"], facts["fact_attendance"], facts["intake"])


def reconciliation(star: StarTables) -> DataFrame:
    """fact, rows_in, rows_in_fact, rows_rejected: no row is lost unseen when
    the first is the sum of the others."""
    held = None
    for name in ("fact_assessment", "fact_enrollment", "fact_attendance"):
        n = getattr(star, name).agg(F.count(F.lit(1)).alias("rows_in_fact")).select(F.lit(name).alias("fact"), "rows_in_fact")
        held = n if held is None else held.unionByName(n)
    return star.intake.join(held, "fact").select("fact", "rows_in", "rows_in_fact", "rows_rejected")


def materialize(build, root: str, parallel: int = 4) -> StarTables:
    """Run ``build(stage)`` (a :func:`build_star` call) writing every
    intermediate and star table as Parquet under ``root`` (a shared folder)
    and reading it back, so each is computed once and later steps start from
    written data. Tables of one step that do not depend on each other are
    written as concurrent Spark jobs. Returns the star tables read from
    ``root``."""
    from concurrent.futures import ThreadPoolExecutor

    def stage(name: str, df: DataFrame) -> DataFrame:
        if name.startswith("fact_"):  # one folder a year; large years are split over several files
            df.hint("rebalance", "year_key").write.mode("overwrite").partitionBy("year_key").parquet(f"{root}/{name}")
        else:
            df.write.mode("overwrite").parquet(f"{root}/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{root}/{name}")

    def many(tables: dict) -> dict:
        with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
            futures = {n: pool.submit(stage, n, df) for n, df in tables.items()}
            return {n: f.result() for n, f in futures.items()}

    stage.many = many
    return build(stage)


def _dims(star: StarTables):
    """Small dimensions. No hint: the planner broadcasts a dimension when its
    size estimate (file sizes for written tables) is under
    ``spark.sql.autoBroadcastJoinThreshold``, and AQE re-checks the actual
    size at run time; a large dimension stays a shuffled join."""
    return star.dim_subject, star.dim_subgroup, star.dim_year


def _year_key(years: DataFrame, label: str):
    """The key of a year label as a scalar subquery, which can prune the year folders of a fact."""
    return years.where(F.col("school_year_label") == F.lit(label)).select("year_key").scalar()


# --- Q1b: factor table with composition computed from the fact ------------------

def q1_factor_corr_star(star: StarTables, factor_ids: Mapping[str, str], all_prefix: str = ALL_PREFIX,
                        subject_id: str = "Math") -> DataFrame:
    """var, n, r, slope; demographics are percent of tested students per
    subgroup id, computed from fact_assessment.

    Outcome (math, all-students rows) and composition (all-students total and
    per-subgroup tested, any subject) are conditional sums of one
    aggregation of the latest year's fact rows per (school_key, year_key);
    that year is a plain maximum over the outcome's rows, and a filter of the
    fact's year folders. The school code and year label
    would only be carried along, and the builder guarantees every fact key
    has its dimension row, so dim_school and dim_year are not joined."""
    subj, sg, _ = _dims(star)
    math_keys = subj.where(F.col("subject_id") == F.lit(subject_id)).select(
        "subject_key", F.lit(True).alias("_is_math"))
    facts = (star.fact_assessment
             .join(sg.select("subgroup_key", "subgroup_id", "subgroup_name"), "subgroup_key")
             .join(math_keys, "subject_key", "left"))
    all_rows = label_startswith("subgroup_name", all_prefix)
    math_all = all_rows & F.coalesce(F.col("_is_math"), F.lit(False))
    cat = F.col("subgroup_id")
    keys = ["school_key", "year_key"]
    latest = facts.where(math_all).agg(F.max("year_key").alias("y")).select("y").scalar()
    agg = facts.where(F.col("year_key") == latest).groupBy(*keys).agg(
        F.count(F.when(math_all, F.lit(1))).alias("_n_math"),
        F.sum(F.when(math_all, F.col("n_qual"))).alias("_prof"),
        F.sum(F.when(math_all, F.col("tested"))).alias("_tested"),
        F.sum(F.when(all_rows, F.col("tested"))).alias("_tot"),
        *[F.sum(F.when(cat == F.lit(sid), F.col("tested"))).alias(f"_c_{name}") for sid, name in factor_ids.items()])
    outcome = agg.where(F.col("_n_math") > 0)
    pairs = outcome.select(
        *keys, guarded_ratio("_prof", "_tested", 1.0).alias("math_prof_rate"),
        *[guarded_ratio(F.coalesce(F.col(f"_c_{name}"), F.lit(0)), "_tot", 100.0).alias(name)
          for name in factor_ids.values()])
    base = pairs.where(positive("math_prof_rate"))
    return factor_table(base, "math_prof_rate", list(factor_ids.values()))


# --- Q1c: subgroup share vs math, long form ----------------------------------------

def math_school_star(star: StarTables, year: int | None = None, year_label: str | None = None,
                     subject_name: str = "Mathematics", all_name: str = "All Students") -> DataFrame:
    """school_key, total_prof, total_tested, math_prof_rate (percent)."""
    subj, sg, yr = _dims(star)
    fa = (star.fact_assessment
          .join(subj.where(F.col("subject_name") == F.lit(subject_name)).select("subject_key"), "subject_key")
          .join(sg.where(F.col("subgroup_name") == F.lit(all_name)).select("subgroup_key"), "subgroup_key"))
    if year_label is not None:
        fa = fa.where(F.col("year_key") == _year_key(yr, year_label))
    if year is not None:
        fa = fa.where(F.col("year_key") == F.lit(year))
    return grouped_rate(fa, ["school_key"], "n_qual", "tested", 100.0, "math_prof_rate", "total_prof",
                        "total_tested")


def q1_share_corr_star(star: StarTables, year_label: str, subject_name: str = "Mathematics",
                       all_name: str = "All Students") -> DataFrame:
    """subgroup_name, correlation of the subgroup's enrollment share with the
    school's math rate; subgroups with one pair dropped; by correlation desc."""
    _, sg, yr = _dims(star)
    math = math_school_star(star, year_label=year_label, subject_name=subject_name, all_name=all_name)
    enroll = (star.fact_enrollment
              .where(F.col("year_key") == _year_key(yr, year_label))
              .join(sg.select("subgroup_key", "subgroup_name"), "subgroup_key")
              .select("school_key", "subgroup_name", "n_students"))
    comp = share_of_group(enroll, ["school_key"], "n_students", "subgroup_share")
    pairs = (comp.join(math, "school_key")
                 .where(F.col("subgroup_share").isNotNull() & F.col("math_prof_rate").isNotNull()))
    return (pairs.groupBy("subgroup_name")
                 .agg(F.count(F.lit(1)).alias("_n"), pearson_expr("subgroup_share", "math_prof_rate").alias("correlation"))
                 .where(F.col("_n") > 1).drop("_n")
                 .orderBy(F.col("correlation").desc_nulls_last()))


# --- Q2c / Q2d: attendance vs math on the star ---------------------------------

def att_school_star(star: StarTables, year: int, all_name: str = "All Students") -> DataFrame:
    """Enrollment-weighted absence and attendance (100 - absence) per school."""
    _, sg, _ = _dims(star)
    fa = (star.fact_attendance.where(F.col("year_key") == F.lit(year))
          .join(sg.where(F.col("subgroup_name") == F.lit(all_name)).select("subgroup_key"), "subgroup_key"))
    return weighted_mean(fa, ["school_key"], "absence_rate", "enrollment", name="absence_rate",
                         complement=100.0, complement_name="attendance_rate")


def q2_pairs_star(star: StarTables, year: int, all_name: str = "All Students") -> DataFrame:
    att = att_school_star(star, year, all_name)
    math = math_school_star(star, year=year, all_name=all_name)
    return (att.join(math, "school_key")
               .where(positive("attendance_rate") & positive("math_prof_rate"))
               .select("school_key", "attendance_rate", "math_prof_rate"))


def q2_points_star(star: StarTables, year: int, all_name: str = "All Students") -> DataFrame:
    """school_id, school_name, attendance_rate, math_prof_rate ordered by school_id."""
    pairs = q2_pairs_star(star, year, all_name)
    out = (pairs.join(star.dim_school, "school_key")
                .select("school_id", "school_name", "attendance_rate", "math_prof_rate"))
    return out.orderBy("school_id")


def q2_corr_star(star: StarTables, year: int, all_name: str = "All Students") -> DataFrame:
    return pearson(q2_pairs_star(star, year, all_name), "attendance_rate", "math_prof_rate", r_name="correlation")


# --- Q3c: raw expenditures joined to star math through the school code ------------

def q3_corr_star(star: StarTables, expenditures: DataFrame, year: int, district: str = "% SD",
                 all_name: str = "All Students") -> DataFrame:
    """Correlation of per-pupil expenditure with the star math rate; the raw
    table reaches the fact through dim_school's natural code. Only the
    expenditure flag is required (no enrollment flag)."""
    e = expenditures.where(year_equals(expenditures, "YEAR", year) & flag_is("DATA_REPORTED_EXP"))
    e = e.select(F.col("ENTITY_CD"), "ENTITY_NAME", to_number(e, "PER_FED_STATE_LOCAL_EXP").alias("x"))
    math = math_school_star(star, year=year, all_name=all_name)
    pairs = (e.join(star.dim_school.select(F.col("school_id").alias("ENTITY_CD"), "school_key"), "ENTITY_CD")
              .join(math, "school_key")
              .where(not_like_ci("ENTITY_NAME", district) & positive("x") & positive("math_prof_rate")))
    return pairs.agg(pearson_expr("x", "math_prof_rate").alias("correlation"))


def star_counts(star: StarTables) -> DataFrame:
    """Row count per star table (a build summary)."""
    parts = [df.agg(F.count(F.lit(1)).cast("long").alias("rows")).select(F.lit(n).alias("table_name"), "rows")
             for n, df in star.as_dict().items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
