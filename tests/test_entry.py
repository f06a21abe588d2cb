import os

import pytest

import __spark_entry__ as entry
from lexloom.plans import registry


def test_contract(spark):
    assert entry.entry(spark).columns == ["ref_table", "side", "month", "status", "n"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(registry.queries()) <= set(entry.queries())


def test_apart():
    """Nothing outside of the subpackage imports it, but for the entry, which does so where it can."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for folder, _, files in os.walk(os.path.join(root, "lexloom")):
        if os.sep + "llm" not in folder:
            for f in files:
                if f.endswith(".py"):
                    assert "lexloom.llm" not in open(os.path.join(folder, f), encoding="utf-8").read(), f


COLUMNS = {
    "p2_found": [("edge_id", "bigint"), ("side", "string")],
    "p5_found": [("rec_table", "string"), ("rec_id", "string"), ("zone", "string"), ("pos", "int"), ("value", "string")],
    "p6_found": [("src", "string"), ("dst", "string"), ("finding", "string")],
}


@pytest.mark.parametrize("name", COLUMNS)
def test_columns(spark, sf, name):
    df = registry.queries()[name](spark, sf)
    assert df.dtypes == COLUMNS[name] and df.count() > 0
