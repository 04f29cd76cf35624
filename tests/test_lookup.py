import hashlib
import random

from pyspark.sql import functions as F

from strandweave.operators.lookup import Lookup, attach, heavy_keys, not_stored
from strandweave.tables import Table


def facts(spark, kind):
    """A third of the rows share one key, some have none or an unknown one."""
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        number = None if i % 50 == 0 else 7 if i % 3 == 0 else rng.randint(0, 2500)
        rows.append((i, number if kind == "long" or number is None else f"k{number}"))
    return spark.createDataFrame(rows, f"row long, key {kind}")


def dim(spark, kind):
    rows = [(n if kind == "long" else f"k{n}", n * 10) for n in range(2000)]
    return spark.createDataFrame(rows, f"name {kind}, value long")


def test_both_ways_agree(spark):
    for kind in ("string", "long"):
        base = facts(spark, kind)
        small = Lookup(Table(dim(spark, kind)), "key", "name", {"v": "value"})
        large = Lookup(Table(dim(spark, kind), max_rows=0), "key", "name", {"v": "value"})
        expected = {row.row: row.v for row in attach(base, [small], "row").collect()}
        found = attach(base, [large], "row").collect()
        assert len(found) == 3000 and {row.row: row.v for row in found} == expected
        assert sum(value is None for value in expected.values()) > 60


def test_fillers_spread_heavy_keys(spark):
    """With the heavy key answered by the broadcast, no value dominates the shuffled join."""
    spread = attach(facts(spark, "string"), [Lookup(Table(dim(spark, "string"), max_rows=0), "key", "name", {"v": "value"})], "row")
    plan = spread._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftOuter" in plan and "xxhash64" in plan
    physical = spread._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in physical and "NestedLoop" not in physical


def test_filler_equal_to_a_key_does_no_harm(spark):
    """Negative keys meet the numeric filler, texts starting with NUL the other."""
    keys = [(-1 - n, n) for n in range(70000)]
    lookup = Lookup(Table(spark.createDataFrame(keys, "name long, value long"), max_rows=0), "key", "name", {"v": "value"})
    rows = spark.createDataFrame([(1, None), (2, -5), (3, 5)], "row long, key long")
    assert {row.row: row.v for row in attach(rows, [lookup], "row").collect()} == {1: None, 2: 4, 3: None}


def test_heavy_keys_are_bounded(spark):
    base = facts(spark, "string")
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    keys = [row.key for row in heavy_keys(base, "key", 5).collect()]
    assert len(keys) == 5 and digest("k7") in keys
    long_keys = spark.createDataFrame([("x" * 2000,)] * 10 + [("y",)], "key string")
    assert [row.key for row in heavy_keys(long_keys, "key").collect()] == [digest("x" * 2000), digest("y")]


def test_long_heavy_keys_and_values(spark):
    """A long key that a third of the rows share is answered by its digest; long values are never sent."""
    key, value = "k" * 3000, "v" * 100_000
    base = spark.createDataFrame([(i, key if i % 3 == 0 else f"k{i % 50}") for i in range(900)], "row long, key string")
    dim = spark.createDataFrame([(key, "short"), *[(f"k{n}", value if n == 1 else str(n)) for n in range(50)]], "name string, value string")
    found = attach(base, [Lookup(Table(dim, max_rows=0), "key", "name", {"v": "value"})], "row")
    for row in found.collect():
        assert row.v == ("short" if row.row % 3 == 0 else value if row.row % 50 == 1 else str(row.row % 50))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "sha2" in plan and "octet_length" in plan


def test_not_stored(spark):
    stored = spark.range(0, 100, 3).withColumnRenamed("id", "key")
    for limit in (1000, 0):
        rows = Table(spark.range(50).withColumnRenamed("id", "key"), max_rows=limit)
        assert sorted(r.key for r in not_stored(rows, stored, ["key"]).collect()) == [n for n in range(50) if n % 3]


def test_sizes(spark, workspace):
    table = workspace.save(spark.range(10).select("id", F.lit("abcd").alias("t")), "sizes")
    assert table.size == (10, 10 * (8 + 4))
    assert Table(table.df).size == table.size
    assert table.fits_broadcast() and not Table(table.df, max_bytes=100).fits_broadcast()
