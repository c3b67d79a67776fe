"""Ordered steps over registered databases.

A spec names the databases and tables it depends on and lists its steps: SQL
text with named parameters (a table is ``IDENTIFIER(:reportcard || '.attendance')``)
or a function of the session. Each step's result is a temp view of the step's
name, a written temp table, or a reset that drops what a former run left.

A run checks the dependencies first, then works in a session of its own, so the
views of runs that go on at the same time never meet; databases, which all
sessions see, are read only. The last step's result is written to the shared
folder and handed back in the caller's session.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from edulens.session import scratch_folder
from edulens.sources.registry import quoted

Build = Callable[["Run"], DataFrame]


@dataclass(frozen=True)
class Step:
    name: str
    build: str | Build | tuple[str, ...]
    kind: str = "view"  # view, table, or reset (``build``: the names that are dropped)


@dataclass(frozen=True)
class StepSpec:
    name: str
    version: str
    depends: Mapping[str, Sequence[str]]  # database -> tables
    steps: Sequence[Step]
    params: Mapping[str, object] = field(default_factory=dict)


class MissingDependency(LookupError):
    """Databases or tables that a spec needs and the catalog has not."""


@dataclass(frozen=True)
class Run:
    """What a step sees: its session, the catalog names of its databases, the parameters."""

    session: SparkSession
    databases: Mapping[str, str]
    params: Mapping[str, object]

    def table(self, database: str, table: str) -> DataFrame:
        return self.session.table(f"{quoted(self.databases[database])}.{quoted(table)}")

    def view(self, step: str) -> DataFrame:
        return self.session.table(quoted(step))


def missing(spark: SparkSession, spec: StepSpec, databases: Mapping[str, str]) -> list[str]:
    """The databases and tables of ``spec`` that are not registered."""
    lost = []
    for db, tables in spec.depends.items():
        name = databases.get(db)
        if name is None or not spark.catalog.databaseExists(name):
            lost.append(db)
        else:
            lost += [f"{db}.{t}" for t in tables if not spark.catalog.tableExists(f"{quoted(name)}.{quoted(t)}")]
    return lost


def isolated(spark: SparkSession) -> SparkSession:
    """A session with its own views and the caller's SQL settings."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key) and own.conf.get(key, None) != value:
            own.conf.set(key, value)
    return own


def run_steps(spark: SparkSession, spec: StepSpec, databases: Mapping[str, str], session: SparkSession | None = None, **params
              ) -> DataFrame:
    """Run ``spec`` over ``databases`` (name in the spec -> name in the catalog);
    ``params`` go before the spec's own. The result of the last step."""
    if lost := missing(spark, spec, databases):
        raise MissingDependency(f"{spec.name} {spec.version} needs {', '.join(lost)}")
    run = Run(session or isolated(spark), databases, {**spec.params, **params})
    folder = scratch_folder(spark, "steps", spec.name)
    args = {**{db: quoted(name) for db, name in databases.items()}, **run.params}
    made, result = [], None
    try:
        for step in spec.steps:
            if step.kind == "reset":
                for name in step.build:
                    run.session.catalog.dropTempView(name)
                continue
            if isinstance(step.build, str):
                used = {k: v for k, v in args.items() if f":{k}" in step.build}
                result = run.session.sql(step.build, args=used)
            else:
                result = step.build(run)
            if step.kind == "table":
                result.write.parquet(f"{folder}/{step.name}")
                result = run.session.read.schema(result.schema).parquet(f"{folder}/{step.name}")
            result.createOrReplaceTempView(quoted(step.name))
            made.append(step.name)
        result.write.parquet(f"{folder}/result-of-{spec.version}")
    finally:
        for name in made:
            run.session.catalog.dropTempView(name)
    return spark.read.schema(result.schema).parquet(f"{folder}/result-of-{spec.version}")


def run_together(spark: SparkSession, specs: Sequence[StepSpec], databases: Mapping[str, str], parallel: int = 4, **params
                 ) -> list[DataFrame]:
    """The results of ``specs``, which run at the same time, in their order."""
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return list(pool.map(lambda s: run_steps(spark, s, databases, **params), specs))
