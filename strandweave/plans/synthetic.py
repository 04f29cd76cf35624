"""Staging records derived from an ``orders`` table, for checks and the benchmark."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Every expression means the same in Spark SQL and in ANSI SQL engines.
STAGING_EXPRESSIONS = {
    "row_ord": "o_orderkey",
    "uuid": "concat('u', o_orderkey - case when o_orderkey % 10 = 9 then 9 else 0 end)",
    "name": "concat('Card ', o_custkey)",
    "manaCost": "case when o_orderkey % 7 = 0 then null when o_orderkey % 31 = 0 then '' "
    "else concat('{', o_orderkey % 9, '}', case o_orderkey % 5 when 0 then '{W}{W}' when 1 then '{X}{ u }' "
    "when 2 then '{B/G}' when 3 then '{r}' else '' end) end",
    "types": "case o_orderstatus when 'F' then 'Artifact, Creature' when 'O' then 'Creature' "
    "else 'Land ,Creature,Land' end",
    "subtypes": "case when o_orderkey % 4 = 0 then null when o_orderkey % 29 = 0 then '' "
    "else concat('Sub', o_custkey % 17, ', Sub', o_orderkey % 11) end",
    "supertypes": "case when o_orderkey % 3 = 0 then 'Legendary' when o_orderkey % 3 = 1 then 'Basic, Snow' end",
    "keywords": "case when o_orderkey % 6 = 0 then null "
    "else concat('Ability', o_orderkey % 8, ',,Ability', o_custkey % 5) end",
    "text": "case when o_orderkey % 17 = 0 then null else concat('Text ', o_custkey) end",
    "artist": "case when o_orderkey % 13 = 0 then null else concat('Artist ', o_custkey % 50) end",
    "setCode": "concat('S', year(o_orderdate))",
    "availability": "case o_orderkey % 3 when 0 then 'paper' when 1 then 'online, paper' else 'arena,online , paper' end",
    "rarity": "case o_orderkey % 4 when 0 then 'common' when 1 then ' Common ' when 2 then 'RARE' else 'mythic' end",
    "power": "case o_orderkey % 11 when 0 then null when 1 then 'X' when 2 then 'x' when 3 then '*' "
    "when 4 then '1+*' when 5 then '-1' when 6 then '007' when 7 then '' "
    "else cast(o_orderkey % 13 as varchar(5)) end",
    "toughness": "case o_orderkey % 12 when 0 then null when 1 then 'X' when 2 then '*' when 3 then ' 3' "
    "when 4 then '-0' else cast(o_custkey % 9 as varchar(5)) end",
    "colorIdentity": "case o_orderkey % 6 when 0 then null when 1 then 'W' when 2 then 'W, U' when 3 then 'B,R ,G' "
    "when 4 then 'U' else 'W, U, B, R, G' end",
}


def staging_from_orders(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(*[f'{expression} AS `{name}`' for name, expression in STAGING_EXPRESSIONS.items()])


def staging_sql(orders: str = "orders") -> str:
    """The same projection as ANSI SQL text."""
    columns = ", ".join(f'{expression} AS "{name}"' for name, expression in STAGING_EXPRESSIONS.items())
    return f"SELECT {columns} FROM {orders}"
