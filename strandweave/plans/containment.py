"""Cards by what their lists hold, answered from bitmaps that are stored with each segment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from strandweave.operators.bitmaps import owner_words, owners_with
from strandweave.plans.schema import STORED, ListColumn
from strandweave.sources.store import SegmentStore

WORDS = "item_words"
WORDS_SCHEMA = "item_id long, word long, bits long, table string"
CARDS = "card"


def _without_words(store: SegmentStore, manifest: dict) -> list[str]:
    return [segment for segment in manifest["segments"] if not store.complete(segment, WORDS)]


def index_lists(store: SegmentStore) -> None:
    """Store the bitmaps of every published segment that has none yet; one caller at a time.

    A batch's bitmaps hold only its own cards, so nothing stored is rewritten; a word whose cards
    came in two batches stands in both segments.  A compacted segment is indexed anew.
    """
    manifest = store.manifest()
    if manifest is None:
        return
    for segment in _without_words(store, manifest):
        store.drop(segment, WORDS)  # what an attempt that failed left behind
        alone = {"segments": [segment]}
        items = store.read(alone, "items", STORED["items"]).where("item_id IS NOT NULL").select("table", "item_id", "card_id")
        cards = store.read(alone, "card", STORED["card"]).select(F.lit(CARDS).alias("table"), F.lit(None).cast("long").alias("item_id"), "card_id")
        words = owner_words(items.unionByName(cards), "card_id", "table", "item_id")
        ordered = words.hint("rebalance", "table").sortWithinPartitions("table", "item_id", "word")
        store.write(segment, WORDS, ordered.select("item_id", "word", "bits", "table"), ["table"])


def cards_with(store: SegmentStore, column: ListColumn, all_of: Sequence[str] = (), none_of: Sequence[str] = (),
               only: Sequence[str] | None = None) -> DataFrame:
    """card_id of published cards whose list holds all of, none of, or only the named items.

    The conditions may be combined.  An unknown name is held by no card.  A card with an empty
    list passes "none of" and "only".  Segments must have been indexed by ``index_lists``.
    """
    manifest = store.manifest()
    if manifest is None:
        raise ValueError(f"nothing has been published in {store.root}")
    if _without_words(store, manifest):
        raise ValueError("some segments have no bitmaps yet; call index_lists first")
    names = sorted({*all_of, *none_of, *(only or ())})
    keys = store.read(manifest, "keys", STORED["keys"]).where((F.col("table") == column.table) & F.col("key").isin(names))
    ids = {row.key: row.id for row in keys.collect()} if names else {}  # at most a row per name asked for
    words = store.read(manifest, WORDS, WORDS_SCHEMA)
    return owners_with(
        words.where(F.col("table") == CARDS), words.where(F.col("table") == column.table), "card_id", [ids.get(name) for name in all_of],
        [ids[name] for name in none_of if name in ids], None if only is None else [ids[name] for name in only if name in ids])
