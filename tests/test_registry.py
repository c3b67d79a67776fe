"""Query registry (name, version) and the remaining scalar helpers."""

import datetime as dt

from edulens.functions import now_text
from edulens.plans.catalog import QUERIES, QuerySpec, QueryRegistry, reference_registry


def test_registry_lookup_and_listing():
    reg = QueryRegistry()
    a = reg.register(QuerySpec("q", "1.0", lambda s, d: None))
    b = reg.register(QuerySpec("q", "2.0", lambda s, d: None))
    reg.register(QuerySpec("a", "0.1", lambda s, d: None))
    assert reg.by_name("q") is b and reg.get("q", "1.0") is a
    assert reg.listing() == [("a", "0.1"), ("q", "1.0"), ("q", "2.0")]


def test_reference_registry_maps_to_registered_queries():
    reg = reference_registry()
    assert reg.by_name("baseline_query2").version == "2.2"
    assert reg.by_name("star_query1").version == "2.0"
    fns = set(QUERIES.values())
    assert all(reg.get(n, v).fn in fns for n, v in reg.listing())


def test_now_text(spark):
    txt = spark.range(1).select(now_text()).collect()[0][0]
    parsed = dt.datetime.strptime(txt, "%Y-%m-%d %H:%M:%S")
    assert abs((parsed - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).total_seconds()) < 3600 * 24
