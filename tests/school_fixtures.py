"""School-shaped inline fixtures (published-table layout, numbers as text)."""

import random

from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from edulens import schemas

SUBGROUPS = {  # subgroup name -> (id, demographic column)
    "English Language Learner": ("ELL", "PER_ELL"),
    "Students with Disabilities": ("SWD", "PER_SWD"),
    "Economically Disadvantaged": ("ED", "PER_ECDIS"),
    "Black or African American": ("Black", "PER_BLACK"),
    "Hispanic or Latino": ("Hispanic", "PER_HISP"),
    "Asian or Native Hawaiian/Other Pacific Islander": ("Asian_NHPI", "PER_ASIAN"),
    "White": ("White", "PER_WHITE"),
}
FACTOR_IDS = {sid: col.lower() for sid, col in SUBGROUPS.values()}


def text_count(n: int) -> str:
    return f"{n:,}"


def frame(spark, schema, records):
    """Rows given as dicts; missing columns are NULL."""
    names = [f.name for f in schema.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], schema)


def consistent_school_data(spark, n_schools=40, years=(2023, 2024), seed=1):
    """Raw tables whose demographic percentages equal the subgroup shares of
    tested students, so raw and star analyses must agree."""
    rnd = random.Random(seed)
    math, demo, att, names = [], [], [], []
    for s in range(n_schools):
        code = f"{s + 1:012d}"
        name = f"School {s + 1}"
        names.append({"ENTITY_CD": code, "ENTITY_NAME": name})
        for y in years:
            total = rnd.randint(200, 3000)
            prof = rnd.randint(1, total)
            math.append({"ENTITY_CD": code, "ENTITY_NAME": name, "YEAR": float(y), "ASSESSMENT_NAME": "MATH3",
                         "SUBGROUP_NAME": "All Students", "TOTAL_COUNT": text_count(total),
                         "NUM_TESTED": text_count(total), "NUM_PROF": text_count(prof)})
            d = {"ENTITY_CD": code, "ENTITY_NAME": name, "YEAR": float(y)}
            for sg, (sid, col) in SUBGROUPS.items():
                k = rnd.randint(0, total // 2)
                math.append({"ENTITY_CD": code, "ENTITY_NAME": name, "YEAR": float(y), "ASSESSMENT_NAME": "MATH3",
                             "SUBGROUP_NAME": sg, "TOTAL_COUNT": str(k), "NUM_TESTED": str(k),
                             "NUM_PROF": str(rnd.randint(0, k))})
                d[col] = 100.0 * k / total
                d["NUM_" + col[4:]] = float(k)
            demo.append(d)
            att.append({"ENTITY_CD": code, "ENTITY_NAME": name, "YEAR": float(y),
                        "ATTENDANCE_RATE": round(rnd.uniform(80, 99), 3), "DATA_REPORTED": "Y"})
    demo_schema = StructType([StructField("ENTITY_CD", StringType()), StructField("ENTITY_NAME", StringType()),
                              StructField("YEAR", DoubleType())]
                             + [StructField(c, DoubleType()) for _, col in SUBGROUPS.values()
                                for c in (col, "NUM_" + col[4:])])
    return (frame(spark, schemas.ANNUAL_EM_MATH, math), frame(spark, demo_schema, demo),
            frame(spark, schemas.ATTENDANCE, att), spark.createDataFrame(names))
