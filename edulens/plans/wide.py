"""One wide row for each school and year over all sources.

Every source is first summed up to its (school, year) rows and written as a
table bucketed and sorted by that key, all with the same number of buckets. The
spine holds every (school, year) that any source knows, so a school that only
spends money is there too. The many joins then read bucket by bucket and move no
row.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edulens.session import scratch_folder
from edulens.sources.registry import quoted

KEYS = ["entity_cd", "year"]


def write_bucketed(spark: SparkSession, frames: Mapping[str, DataFrame], buckets: int, parallel: int = 4) -> dict[str, DataFrame]:
    """Each frame (one row a key; rows without a key are left out) as a table
    bucketed by the key, written as concurrent jobs."""
    root = scratch_folder(spark, "wide")
    space = "wide_" + root.rstrip("/").rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {quoted(space)} LOCATION '{root}/catalog'")

    def write(name: str) -> None:
        df = frames[name].where(" AND ".join(f"{k} IS NOT NULL" for k in KEYS))
        (df.repartition(buckets, *KEYS).write.bucketBy(buckets, *KEYS).sortBy(*KEYS).option("path", f"{root}/{name}")
         .saveAsTable(f"{quoted(space)}.{quoted(name)}"))

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        list(pool.map(write, frames))
    return {name: spark.table(f"{quoted(space)}.{quoted(name)}") for name in frames}


def wide_rows(spark: SparkSession, sources: Mapping[str, DataFrame], buckets: int | None = None) -> DataFrame:
    """``entity_cd, year`` of every source and the other columns of each, NULL
    where a source does not know the school in that year. A source has at most
    one row a key, and columns of its own."""
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tables = write_bucketed(spark, sources, buckets)
    keys = reduce(DataFrame.unionByName, [t.select(*KEYS) for t in tables.values()]).dropDuplicates()
    spine = write_bucketed(spark, {"spine": keys}, buckets)["spine"]
    return reduce(lambda wide, t: wide.join(t, KEYS, "left"), tables.values(), spine)
