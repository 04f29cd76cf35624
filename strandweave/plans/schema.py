"""The relational model: which staging column feeds which table, and under what names.

Names are neutral. ``table_name`` and ``column_name`` give those of an existing database
that puts a prefix on its record, set and format tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from strandweave.fixed import UNKNOWN_ARTIST


@dataclass(frozen=True)
class KeyColumn:
    """A single-valued column with its own dimension, filled from every record."""

    column: str
    table: str
    id_name: str
    key: str

    def value(self) -> Column:
        if self.table == "artist":
            return F.coalesce(F.col(self.column), F.lit(UNKNOWN_ARTIST))
        if self.table == "rarity":
            return F.lower(F.trim(self.column))
        return F.col(self.column)


@dataclass(frozen=True)
class ListColumn:
    """A delimited column with a dimension and a bridge, filled from kept records."""

    column: str
    table: str
    id_name: str
    key: str
    bridge: str


ARTIST = KeyColumn("artist", "artist", "artist_id", "artist_name")
SET = KeyColumn("setCode", "set", "set_id", "set_name")
RARITY = KeyColumn("rarity", "rarity", "rarity_id", "rarity_name")
KEY_COLUMNS = {column.table: column for column in (ARTIST, SET, RARITY)}

TYPE = ListColumn("types", "card_type", "card_type_id", "card_type_name", "card_type_bridge")
SUBTYPE = ListColumn("subtypes", "card_subtype", "card_subtype_id", "card_subtype_name", "card_subtype_bridge")
SUPERTYPE = ListColumn(
    "supertypes", "card_supertype", "card_supertype_id", "card_supertype_name", "card_supertype_bridge"
)
FORMAT = ListColumn("availability", "format", "format_id", "format_name", "card_format_bridge")
ABILITY = ListColumn("keywords", "card_ability", "card_ability_id", "card_ability_name", "card_ability_bridge")
COLOR = ListColumn(
    "colorIdentity", "color_identity", "color_identity_id", "color_identity_symbol", "card_color_identity_bridge"
)
LIST_COLUMNS = {column.table: column for column in (TYPE, SUBTYPE, SUPERTYPE, FORMAT, ABILITY, COLOR)}

# Single-valued columns with sentinel values.
STAT_COLUMNS = {"card_power": "power", "card_toughness": "toughness"}

# Fixed names and types: the stored tables.
TABLES = {
    "mana_pip": "mana_pip_id long, mana_pip_symbol string, mana_pip_cost int",
    "mana_cost": "mana_cost_id long, mana_cost_text string, mana_cost_total int",
    "mana_cost_mana_pip": "mana_cost_mana_pip_id long, mana_cost_id long, mana_pip_id long",
    "oracle_text": "oracle_text_id long, oracle_text string",
    "original_text": "original_text_id long, original_text string",
    "card_power": "card_power_id long, card_power_value int, is_x_card_power boolean, is_star_card_power boolean",
    "card_toughness": "card_toughness_id long, card_toughness_value int, is_x_card_toughness boolean, "
    "is_star_card_toughness boolean",
    "artist": "artist_id long, artist_name string",
    "set": "set_id long, set_name string",
    "rarity": "rarity_id long, rarity_name string",
    "format": "format_id long, format_name string",
    "card_type": "card_type_id long, card_type_name string",
    "card_subtype": "card_subtype_id long, card_subtype_name string",
    "card_supertype": "card_supertype_id long, card_supertype_name string",
    "card_ability": "card_ability_id long, card_ability_name string",
    "color_identity": "color_identity_id long, color_identity_symbol string",
    "card": "card_id long, card_uuid string, card_name string, mana_cost_id long, oracle_text_id long, "
    "card_power_id long, card_toughness_id long, artist_id long, set_id long, rarity_id long, loyalty int, "
    "is_reprint boolean",
    "card_type_bridge": "card_id long, card_type_id long",
    "card_subtype_bridge": "card_id long, card_subtype_id long",
    "card_supertype_bridge": "card_id long, card_supertype_id long",
    "card_format_bridge": "card_id long, format_id long",
    "card_name_set_bridge": "card_name string, set_id long",
    "card_ability_bridge": "card_id long, card_ability_id long",
    "card_color_identity_bridge": "card_id long, color_identity_id long",
}

# Stored form. Keys of the plain dimensions share one table, and so do the bridges of the
# delimited columns; each is partitioned by the dimension, so reading one reads only its files.
KEY_TABLES = (*KEY_COLUMNS, *LIST_COLUMNS)
STORED = {
    "keys": "id long, key string, table string",
    "items": "card_id long, item_id long, table string",
    **{
        table: TABLES[table]
        for table in (
            "mana_pip",
            "mana_cost",
            "mana_cost_mana_pip",
            "oracle_text",
            "card_power",
            "card_toughness",
            "card",
            "card_name_set_bridge",
        )
    },
}
STORED_PARTITION = {"keys": ("table",), "items": ("table",)}

# Fixed rules: columns that may not be null, keys that may not repeat, references.
REQUIRED = {
    "mana_pip": ("mana_pip_symbol", "mana_pip_cost"),
    "mana_cost_mana_pip": ("mana_cost_id", "mana_pip_id"),
    "artist": ("artist_name",),
    "set": ("set_name",),
    "rarity": ("rarity_name",),
    "format": ("format_name",),
    "card_type": ("card_type_name",),
    "card_subtype": ("card_subtype_name",),
    "card_supertype": ("card_supertype_name",),
    "card_ability": ("card_ability_name",),
    "color_identity": ("color_identity_symbol",),
    "card": ("card_uuid", "mana_cost_id", "oracle_text_id", "artist_id", "set_id", "rarity_id"),
    "card_type_bridge": ("card_id", "card_type_id"),
    "card_subtype_bridge": ("card_id", "card_subtype_id"),
    "card_supertype_bridge": ("card_id", "card_supertype_id"),
    "card_format_bridge": ("card_id", "format_id"),
    "card_name_set_bridge": ("card_name", "set_id"),
    "card_ability_bridge": ("card_id", "card_ability_id"),
    "card_color_identity_bridge": ("card_id", "color_identity_id"),
}
UNIQUE = {
    "mana_pip": "mana_pip_symbol",
    "mana_cost": "mana_cost_text",
    "card_power": "card_power_value",
    "card_toughness": "card_toughness_value",
    "artist": "artist_name",
    "set": "set_name",
    "rarity": "rarity_name",
    "format": "format_name",
    "card_type": "card_type_name",
    "card_subtype": "card_subtype_name",
    "card_supertype": "card_supertype_name",
    "card_ability": "card_ability_name",
    "color_identity": "color_identity_symbol",
    "card": "card_uuid",
}
UNIQUE_PAIRS = {
    "card_type_bridge": ("card_id", "card_type_id"),
    "card_subtype_bridge": ("card_id", "card_subtype_id"),
    "card_supertype_bridge": ("card_id", "card_supertype_id"),
    "card_format_bridge": ("card_id", "format_id"),
    "card_name_set_bridge": ("card_name", "set_id"),
    "card_ability_bridge": ("card_id", "card_ability_id"),
    "card_color_identity_bridge": ("card_id", "color_identity_id"),
}
# (child table, column, parent table); the parent column has the same name.
REFERENCES = (
    ("mana_cost_mana_pip", "mana_cost_id", "mana_cost"),
    ("mana_cost_mana_pip", "mana_pip_id", "mana_pip"),
    ("card", "mana_cost_id", "mana_cost"),
    ("card", "oracle_text_id", "oracle_text"),
    ("card", "artist_id", "artist"),
    ("card", "set_id", "set"),
    ("card", "rarity_id", "rarity"),
    ("card_type_bridge", "card_id", "card"),
    ("card_type_bridge", "card_type_id", "card_type"),
    ("card_subtype_bridge", "card_id", "card"),
    ("card_subtype_bridge", "card_subtype_id", "card_subtype"),
    ("card_supertype_bridge", "card_id", "card"),
    ("card_supertype_bridge", "card_supertype_id", "card_supertype"),
    ("card_format_bridge", "card_id", "card"),
    ("card_format_bridge", "format_id", "format"),
    ("card_name_set_bridge", "set_id", "set"),
    ("card_ability_bridge", "card_id", "card"),
    ("card_ability_bridge", "card_ability_id", "card_ability"),
    ("card_color_identity_bridge", "card_id", "card"),
    ("card_color_identity_bridge", "color_identity_id", "color_identity"),
)

# Tables and columns that carry the prefix in a prefixed database.
PREFIXED_TABLES = ("card", "set", "format")
PREFIXED_COLUMNS = ("card_id", "card_uuid", "card_name", "set_id", "set_name", "format_id", "format_name")


def table_name(table: str, prefix: str = "") -> str:
    if table in PREFIXED_TABLES:
        return prefix + table
    return table.replace("_set_", f"_{prefix}set_")


def column_name(column: str, prefix: str = "") -> str:
    return prefix + column if column in PREFIXED_COLUMNS else column
