"""Every catalogue query against its SQL oracle on the driver's tables."""

from __future__ import annotations

from pathlib import Path

import __spark_entry__ as contract
import compare
import pytest
from kerbside.plans import catalogue, oracle

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables not there")


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert catalogue.queries().keys() == oracle.oracle_sql().keys()


def test_contract_holds_the_catalogue():
    assert catalogue.queries().keys() <= contract.queries().keys()
    assert oracle.oracle_sql().items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", catalogue.queries())
def test_query_equals_oracle(spark, duck, name):
    got = contract.queries()[name](spark, SF_DIR).toPandas()
    expected = duck.sql(contract.oracle_sql()[name]).df()
    assert len(got) > 0
    assert compare.difference(got, expected) is None


def test_entry(spark):
    assert contract.entry(spark).columns == ["service", "hour_of_day", "total_amount_payed"]


def test_range_rewrite_serves_the_same(spark):
    """Filtering raw pick-ups or stored hours gives one answer."""
    from kerbside.operators import serving
    from kerbside.plans import catalogue

    span = (catalogue.START, catalogue.END)
    for answer in (
        lambda h: serving.card_num_trips(h, *span),
        lambda h: serving.trend(h, "num_trips", "month", *span),
    ):
        cut = answer(catalogue.served(spark, SF_DIR)).collect()
        assert cut == answer(catalogue.hourly(spark, SF_DIR)).collect()
    cards = sum(r.num_trips for r in serving.card_num_trips(catalogue.served(spark, SF_DIR), *span).collect())
    for unit in ("hour_of_day", "day_of_week", "day_of_month", "month"):
        trend = serving.trend(catalogue.served(spark, SF_DIR), "num_trips", unit, *span)
        assert sum(r.num_trips for r in trend.collect()) == cards
