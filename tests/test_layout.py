"""Registered queries give the same rows whatever the shuffle layout."""

import math

import pytest

QUERIES = ["hourly_stats", "dashboard_grouping_sets", "distance_map", "route_distance", "label_index",
           "scenario_prices", "train_test_split", "distance_price_sample", "top_services",
           "quote_requests_checked"]


def _rows(df):
    out = []
    for r in df.collect():
        out.append(tuple(round(v, 9) if isinstance(v, float) and not math.isnan(v) else v for v in r))
    return sorted(out, key=repr)


@pytest.mark.parametrize("key", QUERIES)
def test_query_is_layout_independent(spark, sf_small, key):
    import __spark_entry__ as E

    q = E.queries()[key]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for n in ("1", "4", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            results.append(_rows(q(spark, sf_small)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] == results[1] == results[2]
