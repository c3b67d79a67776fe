"""edulens: school-outcome analytics as lazy Spark DataFrame operators.

Layout
------
functions/  column expressions (cleaning, predicates, formatting)
operators/  DataFrame -> DataFrame building blocks (rates, statistics,
            exact distributed quantiles and ranks, relational helpers,
            run-log record maintenance)
sources/    table registry, driver-table adapters, copy jobs, CSV I/O
plans/      composed analyses (raw schema, star schema, run-log reports)
streaming/  incremental ingestion of run-log records
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Python helpers run inside tasks (mapInPandas, pandas UDFs). Pickle
    this package by value so executors need no installed copy of it."""
    import sys

    try:
        from pyspark import cloudpickle
    except ImportError:  # pragma: no cover
        return
    try:
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except (ValueError, TypeError):
        pass


_ship_by_value()
