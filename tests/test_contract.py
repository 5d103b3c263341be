"""The driver's contract: entry, names, and a few queries against their SQL."""

import pytest

import __spark_entry__ as contract
from checks import compare

NAMES = ["transition_matrix", "hpi_enrich", "transition_table", "calibration_quantile", "matrix_power_k6", "path_shares"]


def test_entry(spark):
    assert contract.entry(spark).count() == 81


def test_every_sql_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert len(contract.oracle_sql()) > 80


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, sf, name):
    con = compare.connect(sf)
    assert compare.compare(spark, con, name, contract.queries()[name], contract.oracle_sql()[name], sf) == ""
