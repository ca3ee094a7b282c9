"""Every query against its SQL on the smallest tables."""

import pytest

from oracle import check
from textweir.plans import catalogue


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_matches_sql(spark, sf, name):
    check(catalogue.QUERIES[name](spark, sf), catalogue.ORACLE_SQL[name], sf)


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL)))
def test_gives_rows(spark, sf, name):
    assert catalogue.QUERIES[name](spark, sf).count()


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
