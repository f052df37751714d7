"""Every registered query against its DuckDB twin, on whole tables."""

import os

import pytest
from oracle import compare

import __spark_entry__ as contract
from jobmetrics.plans import oracles, registry

SCALES = os.environ.get("ORACLE_SF", "0.001").split(",")


def test_each_query_has_a_twin():
    assert set(registry.queries()) == set(oracles.oracle_sql())
    assert set(registry.queries()) <= set(contract.queries())


@pytest.mark.parametrize("scale", SCALES)
@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_oracle(spark, sf_dir, name, scale):
    path = sf_dir.replace("sf0.001", f"sf{scale}")
    assert compare(spark, path, registry.queries()[name], oracles.oracle_sql()[name]) == []


def test_entry(spark, sf_dir):
    fact = contract.entry(spark)
    # Fixed value: cells of the hourly fact at the smallest scale.
    assert fact.count() == 799
