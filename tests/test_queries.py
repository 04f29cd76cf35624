"""Every registered query against its SQL counterpart on the given tables."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_points
from strandweave.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for name in os.listdir(FOLDER):
        connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{name}'")
    return connection


def test_every_query_has_a_counterpart():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, engine, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    found = Counter(tuple(row) for row in df.select(*columns).collect())
    relation = engine.sql(f"SELECT {', '.join(f'"{c}"' for c in columns)} FROM ({ORACLES[name]})")
    assert found == Counter(relation.fetchall())
    assert len(engine.sql(ORACLES[name]).columns) == len(columns)
    assert [TYPES[dict(df.dtypes)[c]] for c in columns] == [str(t) for t in relation.types]


def test_known_counts(spark):
    """Counts known for this scale beforehand."""
    counts = {
        "dim_cost": 261, "cost_pips": 99, "dim_pip": 14, "dim_artist": 51, "dim_set": 7, "dim_power": 17,
        "dim_toughness": 12, "bridge_type": 2230, "bridge_subtype": 1857, "bridge_ability": 3165, "name_set_bridge": 760,
    }
    assert {name: QUERIES[name](spark, FOLDER).count() for name in counts} == counts


def test_flagship(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["card_id", "card_name", "mana", "cmc", "types", "subtypes", "supertypes"]
    rows = df.collect()
    assert len(rows) == 1350 and sum(row.cmc for row in rows) == 5700 and sum(row.mana is None for row in rows) == 194
