"""Which owners hold an item, as bitmaps, and filters by what owners hold.

An owner's id is a bit of a word: the ids 64w to 64w + 63 share word w.  The index has a row for
every item and word with a holder, so an item that most owners hold takes a 64th of its bridge
rows and a rare one no more rows than it has.  "All of", "none of" and "only" are bitwise
operations on words of one number: one aggregation by word, and no join over the bridge.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

WORD_SHIFT = 6
WORD_BITS = 1 << WORD_SHIFT


def owner_words(rows: DataFrame, owner: str, *by: str) -> DataFrame:
    """(by, word, bits): the owners of each group.  Rows without an owner take no part; repeats change nothing."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.col(owner), F.lit(WORD_BITS)).cast("int"))
    word = F.shiftright(owner, WORD_SHIFT).alias("word")
    return rows.where(F.col(owner).isNotNull()).groupBy(*by, word).agg(F.bit_or(bit).alias("bits"))


def _owners(word: Column, bits: Column) -> Column:
    places = F.sequence(F.lit(0), F.lit(WORD_BITS - 1))
    held = F.filter(places, lambda place: F.call_function("shiftright", bits, place).bitwiseAND(1) == 1)
    return F.transform(held, lambda place: word * WORD_BITS + place)


def owners_with(everyone: DataFrame, index: DataFrame, owner: str, all_of: Sequence[int | None] = (),
                none_of: Sequence[int] = (), only: Sequence[int] | None = None) -> DataFrame:
    """Owners, once each, that hold every item of ``all_of``, none of ``none_of``, and nothing beside ``only``.

    ``everyone`` holds (word, bits) of all owners, ``index`` (item_id, word, bits).  An item that
    does not exist, None, is held by nobody.  An owner without items passes "none of" and "only".
    """
    item = F.col("item_id")
    unwanted = item.isin(list(none_of)) if none_of else F.lit(False)
    if only is not None:
        unwanted = unwanted | (~item.isin(list(only)) if only else F.lit(True))
    wanted = [i for i in all_of if i is not None]
    needed = index.where(item.isin(wanted) | unwanted) if wanted else index.where(unwanted)
    words = everyone.select(F.lit(True).alias("all"), F.lit(None).cast("long").alias("item_id"), "word", "bits").unionByName(
        needed.select(F.lit(False).alias("all"), "item_id", "word", "bits"))
    named = [F.bit_or(F.when(item == i, F.col("bits"))).alias(f"_{n}") for n, i in enumerate(wanted)]
    met = words.groupBy("word").agg(
        F.bit_or(F.when(F.col("all"), F.col("bits"))).alias("everyone"), F.bit_or(F.when(~F.col("all") & unwanted, F.col("bits"))).alias("unwanted"), *named)
    bits = F.col("everyone").bitwiseAND(F.bitwise_not(F.coalesce("unwanted", F.lit(0).cast("long"))))
    for n in range(len(wanted)):
        bits = bits.bitwiseAND(F.col(f"_{n}"))
    if len(wanted) < len(all_of):
        bits = F.lit(0).cast("long")
    return met.select("word", bits.alias("bits")).where("bits <> 0").select(F.explode(_owners(F.col("word"), F.col("bits"))).alias(owner))
