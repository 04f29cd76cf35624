"""Tokenisers and key rules, all as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from strandweave import fixed


def list_tokens(text: Column) -> Column:
    """Items of a delimited text without surrounding blanks, empty items kept; null stays null.

    The separator takes the white space around it, so only the ends of the text need a trim.
    """
    return F.split(F.trim(text), fixed.LIST_SEPARATOR)


def brace_tokens(text: Column, pattern: str = fixed.COST_TOKEN) -> Column:
    """Contents of every match of ``pattern``'s first group, repeats kept."""
    return F.regexp_extract_all(text, F.lit(pattern), 1)


def integer(text: Column) -> Column:
    """Non-null text as int; a number out of range fails whatever the session's ANSI setting."""
    problem = F.concat(F.lit("integer out of range: "), text)
    return F.coalesce(text.try_cast("int"), F.raise_error(problem).cast("int"))


def pip_symbol(token: Column) -> Column:
    return F.upper(F.trim(token))


def pip_cost(symbol: Column) -> Column:
    """X counts nothing, a number counts itself, any other symbol counts one."""
    return (
        F.when(symbol == "X", F.lit(0))
        .when(symbol.rlike(fixed.UNSIGNED_INTEGER), integer(symbol))
        .otherwise(F.lit(1))
    )


def total_cost(text: Column) -> Column:
    """Sum of the pip costs of one cost text, within the row; 0 when there are none."""
    total = F.aggregate(
        brace_tokens(text),
        F.lit(0).cast("long"),
        lambda total, token: total + pip_cost(pip_symbol(token)),
    )
    return integer(F.coalesce(total, F.lit(0).cast("long")).cast("string"))


def stat_problem(text: Column) -> Column:
    """True for a printed number that is no integer of the stored kind."""
    return text.rlike(fixed.SIGNED_INTEGER) & text.try_cast("int").isNull()


def cost_problem(text: Column) -> Column:
    """True for a cost text of which a pip, or the total, is out of range."""
    symbols = F.transform(brace_tokens(text), pip_symbol)
    large = F.exists(symbols, lambda s: s.rlike(fixed.UNSIGNED_INTEGER) & s.try_cast("int").isNull())
    values = F.transform(symbols, lambda s: F.when(s == "X", 0).otherwise(F.coalesce(
        F.when(s.rlike(fixed.UNSIGNED_INTEGER), s.try_cast("int")), F.lit(1))).cast("long"))
    total = F.aggregate(values, F.lit(0).cast("long"), lambda sum_, v: sum_ + v)
    return large | (total > 2147483647)


def _is_variable(text: Column) -> Column:
    return text.isin("X", "x")


def stat_value(text: Column) -> Column:
    """Stored integer of a printed power or toughness; null stays null."""
    return (
        F.when(_is_variable(text), F.lit(fixed.STAT_VARIABLE))
        .when(text == "*", F.lit(fixed.STAT_STAR))
        .when(text.rlike(fixed.SIGNED_INTEGER), integer(text))
        .when(text.isNotNull(), F.lit(fixed.STAT_REVIEW))
    )


def stat_flags(text: Column, numeric_star: bool = False) -> Column:
    """Two bits, (variable, star). ``numeric_star`` marks plain numbers as star too."""
    numeric = F.lit(1 if numeric_star else 0)
    return (
        F.when(_is_variable(text), F.lit(2))
        .when(text == "*", F.lit(1))
        .when(text.rlike(fixed.SIGNED_INTEGER), numeric)
        .otherwise(F.lit(0))
    )
