"""Source registry: named tables with an explicit schema and a location,
grouped into databases, registered as (lazy) temp views for SQL.

A query declares the databases it depends on; ``register_dependencies``
makes every table of those databases addressable by its published name,
spaces included (``spark.table("`Annual EM MATH`")``).
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from edulens import schemas
from edulens.session import checkpoint_root, hadoop_fs


@dataclass(frozen=True)
class TableSource:
    name: str                 # published name, may contain spaces
    path: str                 # parquet location (file or folder)
    schema: StructType | None = None
    fmt: str = "parquet"
    partitions: tuple[str, ...] = ()  # columns that are folders


@dataclass(frozen=True)
class Database:
    name: str
    tables: tuple[TableSource, ...] = field(default_factory=tuple)


def read_source(spark: SparkSession, src: TableSource) -> DataFrame:
    reader = spark.read.format(src.fmt)
    if src.schema is not None:
        reader = reader.schema(src.schema)
    if src.fmt == "csv":
        reader = reader.option("header", True)
    return reader.load(src.path)


def quoted(name: str) -> str:
    """Backtick-quote a table or column name (spaces, ``%`` and the like)."""
    return "`" + name.replace("`", "``") + "`"


def register_dependencies(spark: SparkSession, databases: Iterable[Database]) -> dict[str, DataFrame]:
    """Register every table of the given databases as a temp view under its
    published name; returns name -> DataFrame (views stay lazy)."""
    out: dict[str, DataFrame] = {}
    for db in databases:
        for t in db.tables:
            df = read_source(spark, t)
            df.createOrReplaceTempView(quoted(t.name))
            out[t.name] = df
    return out


def drop_views(spark: SparkSession, names: Iterable[str]) -> list[str]:
    """``DROP VIEW IF EXISTS`` for each name; returns the names that existed."""
    return [n for n in names if spark.catalog.dropTempView(n)]


def school_databases(root: str) -> list[Database]:
    """The raw school tables under ``root/<database>/<table>`` with their
    published schemas (numbers kept as text, cleaned by the analyses)."""
    rc = Database("reportcard_database_23_24", (
        TableSource("Annual EM MATH", f"{root}/reportcard_database_23_24/annual_em_math",
                    schemas.ANNUAL_EM_MATH),
        TableSource("Expenditures per Pupil", f"{root}/reportcard_database_23_24/expenditures_per_pupil",
                    schemas.EXPENDITURES_PER_PUPIL),
    ))
    enr = Database("enrollment_database_23_24", (
        TableSource("Demographic Factors", f"{root}/enrollment_database_23_24/demographic_factors",
                    schemas.DEMOGRAPHIC_FACTORS),
    ))
    stu = Database("student_educator_database_23_24", (
        TableSource("Attendance", f"{root}/student_educator_database_23_24/attendance", schemas.ATTENDANCE),
        TableSource("Suspensions", f"{root}/student_educator_database_23_24/suspensions", schemas.SUSPENSIONS),
    ))
    return [rc, enr, stu]


def star_database(root: str) -> Database:
    return Database("star_schema", tuple(TableSource(n, f"{root}/{n}", s, partitions=("year_key",) if n.startswith("fact_") else ())
                                         for n, s in schemas.STAR_TABLES.items()))


# --- namespaces of the session catalog -----------------------------------------------

#: Topics of the published databases and the school years of their releases (fixed values).
TOPICS = ["student_educator", "reportcard", "grad_rate", "pathways", "enrollment", "digital_resources", "ap_ib_course",
          "ap_ib_assessment", "ell"]
#: Table property with the columns that the declared schema has as NOT NULL.
NOT_NULL = "edulens.not_null"
DATABASES = [f"{topic}_database_{release}" for release in ("23_24", "22_23") for topic in TOPICS]


def table_name(published: str) -> str:
    """The catalog name of a published table: the session catalog takes letters,
    digits and underscores only ('Annual EM MATH' -> annual_em_math)."""
    return re.sub(r"\W+", "_", published.strip()).strip("_").lower()


def register_database(spark: SparkSession, db: Database, prefix: str = "") -> str:
    """Make ``db`` a namespace of the session catalog with one external table of
    declared schema for each source, so that queries of any session name them
    ``database.table`` and equal table names of two releases never meet. A source
    without a schema gets that of its files. Tables that are already registered
    are registered anew; their files are never touched. Returns the name."""
    name = prefix + db.name
    home = f"{checkpoint_root(spark).rstrip('/')}/edulens/namespaces/{name}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(name)} LOCATION '{home}'")
    for t in db.tables:
        full = f"{quoted(name)}.{quoted(table_name(t.name))}"
        spark.sql(f"DROP TABLE IF EXISTS {full}")
        schema = t.schema or spark.read.format(t.fmt).load(t.path).schema
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
        # tables over files take NULL in every column; what the schema declares is kept beside it
        declared = json.dumps([f.name for f in schema.fields if not f.nullable]).replace("'", "''")
        folders = f" PARTITIONED BY ({', '.join(map(quoted, t.partitions))})" if t.partitions else ""
        spark.sql(f"CREATE TABLE {full} ({columns}) USING {t.fmt}{folders} LOCATION '{t.path}' TBLPROPERTIES ('{NOT_NULL}' = '{declared}')")
        if t.partitions:
            spark.catalog.recoverPartitions(full)
    return name


def discover(spark: SparkSession, name: str, path: str) -> Database:
    """A database from the folders of ``path``, one table each, e.g. what a catalog copy has written."""
    fs, where = hadoop_fs(spark, path)
    folders = sorted(s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()) if fs.exists(where) else []
    return Database(name, tuple(TableSource(f, f"{path}/{f}") for f in folders if not f.startswith(("_", "."))))


def drop_database(spark: SparkSession, name: str) -> None:
    """Drop the namespace and its table entries; the files of external tables stay."""
    spark.sql(f"DROP DATABASE IF EXISTS {quoted(name)} CASCADE")


def schema_report(spark: SparkSession, names: Iterable[str], primary_keys: Mapping[str, str] | None = None) -> DataFrame:
    """database, table, position, column, type, pk and not_null of every column
    of the registered tables, from their declared schemas (files say 'nullable'
    of every column)."""
    pks, rows = dict(primary_keys or {}), []
    for name in names:
        for t in spark.catalog.listTables(name):
            if t.isTemporary:
                continue
            full = f"{quoted(name)}.{quoted(t.name)}"
            properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {full}").collect()}
            required = json.loads(properties.get(NOT_NULL, "[]"))
            for i, c in enumerate(spark.catalog.listColumns(full)):
                rows.append((name, t.name, i + 1, c.name, c.dataType, pks.get(t.name) == c.name, c.name in required))
    return spark.createDataFrame(rows, "database_name string, table_name string, position int, column_name string, "
                                       "data_type string, pk boolean, not_null boolean")


def materialize_view(df: DataFrame, name: str) -> DataFrame:
    """A temp table: the frame persisted (memory, spilling to disk) and
    registered under ``name``. Use only for a frame read by several actions."""
    kept = df.persist()
    kept.createOrReplaceTempView(quoted(name))
    return kept


def release_view(spark: SparkSession, name: str, df: DataFrame | None = None) -> bool:
    """Drop a temp view/table and free its cached data if any."""
    if df is not None:
        df.unpersist()
    return spark.catalog.dropTempView(name)


def run_sql(spark: SparkSession, text: str, **params) -> DataFrame:
    """SQL text with named parameters (``:name``) bound by Spark, e.g.
    ``LIMIT CAST(:n_limit AS INT)``; values are never pasted into the text."""
    return spark.sql(text, args=params)


def preview(df: DataFrame, k: int = 5) -> list:
    """First ``k`` rows for display (a LIMIT, not a full result)."""
    return df.limit(k).collect()
