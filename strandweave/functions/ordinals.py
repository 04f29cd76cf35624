"""Ids that follow first appearance without a global sort.

Only the order of surrogate ids is visible to queries, so an id is the place where its
key was first seen: the record's ordinal, with the token position in the low bits.  It
is unique and monotone, ``min`` over it stays a hash aggregate, no rank over all keys is
needed, and a later batch continues it because its ordinals are larger.  A load takes as
many bits for positions as its longest cell needs, and no fewer than the loads before it.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

POSITION_BITS = 20


def bits_for(longest: int, least: int = POSITION_BITS) -> int:
    """Position bits for cells of up to ``longest`` items."""
    return max(least, int(longest).bit_length())


def ordinal_limit(bits: int = POSITION_BITS) -> int:
    return 1 << (63 - bits)


def first_seen_id(row_ord: Column, position: Column | int, bits: int = POSITION_BITS) -> Column:
    """Pack (record ordinal, token position) into one bigint; fails rather than wrap."""
    position = position if isinstance(position, Column) else F.lit(position)
    packed = F.shiftleft(row_ord, bits).bitwiseOR(position.cast("long"))
    outside = (position.cast("long") >= 1 << bits) | (row_ord >= ordinal_limit(bits)) | (row_ord < 0)
    return F.when(outside, F.raise_error(F.lit("record ordinal or token position out of range"))).otherwise(packed)
