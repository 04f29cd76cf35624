"""The registered queries, on a whole given table, and against SQL where there is some."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_points
from strandweave.llm.oracles import ORACLES
from strandweave.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for name in os.listdir(FOLDER):
        connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{name}'")
    return connection


def test_all_are_registered():
    assert QUERIES.keys() | {"pipeline"} <= entry_points.queries().keys()
    assert ORACLES.keys() <= entry_points.oracle_sql().keys()
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, engine, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    relation = engine.sql(f"SELECT {', '.join(f'"{c}"' for c in columns)} FROM ({ORACLES[name]})")
    assert Counter(tuple(row) for row in df.select(*columns).collect()) == Counter(relation.fetchall())


@pytest.mark.parametrize("name, columns, table", [
    ("op1_html", ["page_id", "url", "text"], "pages"),
    ("op2_pii", ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"], "documents"),
    ("op3_simhash", ["doc_id", "fingerprint", "component_id"], "documents"),
    ("op6_quality", ["doc_id", "held_out", "score", "predicted"], "documents"),
    ("op11_alignment", ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"], "documents"),
    ("op13_token_counts", ["doc_id", "n_bytes", "n_tokens", "over_limit"], "documents"),
    ("op8_secrets", ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"], "documents"),
])
def test_a_row_for_each_row(spark, name, columns, table):
    df = QUERIES[name](spark, FOLDER)
    assert df.columns[:len(columns)] == columns
    assert df.count() == spark.read.parquet(f"{FOLDER}/{table}.parquet").count()


def test_pieces_and_neighbours(spark):
    pieces = QUERIES["op5_packing"](spark, FOLDER)
    assert pieces.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert {kind for _, kind in pieces.dtypes} == {"bigint"}
    near = QUERIES["op7_nn_descent"](spark, FOLDER)
    assert near.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    assert near.count() == 25 * 20
