import re

import pytest
from emulator import pip_value, split, stat
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from strandweave.functions import (
    brace_tokens, first_seen_id, integer, list_tokens, pip_cost, pip_symbol, stat_flags, stat_value, total_cost,
)
from strandweave.functions.sql import register_sql_functions


def column(spark, values, expression):
    """The expression over many values in one job."""
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v string")
    return [row[0] for row in rows.orderBy("i").select(expression.alias("r")).collect()]


lists = st.lists(st.text(alphabet="aB,. \t\n{}*", max_size=12), min_size=30, max_size=60)
slow = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@slow
@given(lists)
def test_list_tokens(spark, texts):
    assert column(spark, texts, list_tokens(F.col("v"))) == [split(text) for text in texts]


@slow
@given(lists)
def test_brace_tokens(spark, texts):
    expected = [re.findall(r"\{([^}]+)\}", text) for text in texts]
    assert column(spark, texts, brace_tokens(F.col("v"))) == expected


@pytest.mark.parametrize(
    "text, items",
    [("", [""]), ("a,,b,", ["a", "", "b", ""]), ("\ta", ["\ta"]), (" a , b\t,\tc ", ["a", "b", "c"]), (" ", [""]), (None, None)],
)
def test_list_edges(spark, text, items):
    assert column(spark, [text], list_tokens(F.col("v"))) == [items]


def test_pip_costs(spark):
    symbols = ["X", "0", "7", "007", "W", "W/U", "2/W", "", "5\n", "-1", "1 2"]
    assert column(spark, symbols, pip_cost(F.col("v"))) == [0 if s == "X" else pip_value(s) for s in symbols]
    assert column(spark, [" x ", " u", "g/p"], pip_symbol(F.col("v"))) == ["X", "U", "G/P"]


def test_total_costs(spark):
    texts = ["{X}{X}{G}", "{2/W}", "{ }", "{}{W}", "{{W}", "{1}{W} // {2}{U}", "", "none"]
    assert column(spark, texts, total_cost(F.col("v"))) == [1, 1, 1, 1, 1, 5, 0, 0]


def test_stats(spark):
    texts = ["X", "x", "*", "3", "-1", "007", "-0", "1+*", " 3", "", "5\n", "-9999", "--1"]
    assert column(spark, texts, stat_value(F.col("v"))) == [stat(text)[0] for text in texts]
    for star in (False, True):
        bits = [2 * variable + flag for _, variable, flag in (stat(text, star) for text in texts)]
        assert column(spark, texts, stat_flags(F.col("v"), star)) == bits
    assert column(spark, [None], stat_value(F.col("v"))) == [None]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_large_numbers_fail(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert column(spark, ["2147483647", "-2147483648"], integer(F.col("v"))) == [2**31 - 1, -(2**31)]
        for expression, text in (
            (integer(F.col("v")), "99999999999"),
            (total_cost(F.col("v")), "{2147483647}{1}"),
            (stat_value(F.col("v")), "99999999999"),
        ):
            with pytest.raises(Exception, match="integer out of range"):
                column(spark, [text], expression)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_ids_follow_first_appearance(spark):
    places = [(0, 0), (0, 1), (1, 0), (1, 2**20 - 1), (2, 0), (2**43 - 1, 2**20 - 1)]
    rows = spark.createDataFrame(places, "o long, p int")
    ids = [row[0] for row in rows.select(first_seen_id(F.col("o"), F.col("p"))).collect()]
    assert ids == sorted(set(ids))
    for ordinal, position in ((0, 2**20), (2**43, 0), (-1, 0)):
        bad = spark.createDataFrame([(ordinal, position)], "o long, p int")
        with pytest.raises(Exception, match="out of range"):
            bad.select(first_seen_id(F.col("o"), F.col("p"))).collect()


def test_sql_functions(spark):
    register_sql_functions(spark)
    assert spark.sql("SELECT pip_symbol(' u '), rarity_key(' RARE ')").head()[:] == ("U", "rare")
    rows = spark.sql("SELECT i.pos, i.item FROM VALUES ('b ,a,,') AS t(v), LATERAL list_items(t.v) i ORDER BY pos").collect()
    assert [tuple(row) for row in rows] == [(0, "b"), (1, "a"), (2, ""), (3, "")]
    rows = spark.sql("SELECT c.token FROM VALUES ('{1}{}{ u }') AS t(v), LATERAL cost_tokens(t.v) c ORDER BY pos").collect()
    assert [row.token for row in rows] == ["1", " u "]
