"""The key rules and tokenisers as SQL functions, for users who write SQL.

They are SQL-bodied, so Catalyst inlines them; no Python runs.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

FUNCTIONS = (
    "pip_symbol(token STRING) RETURNS STRING RETURN upper(trim(token))",
    "rarity_key(name STRING) RETURNS STRING RETURN lower(trim(name))",
    "list_items(list STRING) RETURNS TABLE(pos INT, item STRING) "
    r"RETURN SELECT pos, trim(col) FROM posexplode(split(list_items.list, '\\s*,\\s*'))",
    "cost_tokens(cost STRING) RETURNS TABLE(pos INT, token STRING) "
    r"RETURN SELECT pos, col FROM posexplode(regexp_extract_all(cost_tokens.cost, '\\{([^}]+)\\}', 1))",
)


def register_sql_functions(spark: SparkSession) -> None:
    for function in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {function}")
