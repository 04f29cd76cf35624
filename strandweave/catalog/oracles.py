"""The same results in ANSI-style SQL, runnable by an in-process SQL engine on the same tables."""

from __future__ import annotations

from strandweave.plans.schema import REFERENCES, REQUIRED, UNIQUE, UNIQUE_PAIRS
from strandweave.plans.synthetic import staging_sql

SPLIT = r"\s*,\s*"
BRACES = r"\{([^}]+)\}"

STAGING = f"stg AS ({staging_sql()})"
KEPT = "kept AS (SELECT * FROM stg QUALIFY row_number() OVER (PARTITION BY uuid ORDER BY row_ord) = 1)"


def items(name: str, column: str, source: str = "kept") -> str:
    """CTE (row_ord, pos, item)."""
    return f"""{name} AS (
        SELECT row_ord, unnest(range(len(l))) AS pos, trim(unnest(l), ' ') AS item
        FROM (SELECT row_ord, string_split_regex("{column}", '{SPLIT}') AS l FROM {source} WHERE "{column}" IS NOT NULL))"""


def item_dimension(name: str, rows: str) -> str:
    """CTE (id, item)."""
    return f"{name} AS (SELECT min(row_ord * 1048576 + pos) AS id, item FROM {rows} GROUP BY item)"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


COSTS = f"""costs AS (
        SELECT min(row_ord) AS mana_cost_id, upper("manaCost") AS mana_cost_text
        FROM stg WHERE "manaCost" IS NOT NULL GROUP BY upper("manaCost")),
    pips AS (
        SELECT mana_cost_id, unnest(range(len(l))) AS pos, upper(trim(unnest(l), ' ')) AS symbol
        FROM (SELECT mana_cost_id, regexp_extract_all(mana_cost_text, '{BRACES}', 1) AS l FROM costs)),
    pip_dim AS (
        SELECT min(mana_cost_id * 1048576 + pos) AS mana_pip_id, symbol AS mana_pip_symbol,
               CASE WHEN symbol = 'X' THEN 0 WHEN regexp_full_match(symbol, '[0-9]+') THEN CAST(symbol AS integer)
                    ELSE 1 END AS mana_pip_cost
        FROM pips GROUP BY symbol),
    totals AS (
        SELECT mana_cost_id, sum(mana_pip_cost) AS total
        FROM pips JOIN pip_dim ON symbol = mana_pip_symbol GROUP BY mana_cost_id),
    cost_dim AS (
        SELECT c.mana_cost_id, c.mana_cost_text, CAST(coalesce(t.total, 0) AS integer) AS mana_cost_total
        FROM costs c LEFT JOIN totals t ON t.mana_cost_id = c.mana_cost_id
        UNION ALL
        SELECT row_ord, NULL, 0 FROM stg WHERE "manaCost" IS NULL)"""


def stat_value(column: str) -> str:
    return f"""CASE WHEN "{column}" IN ('X', 'x') THEN -9999 WHEN "{column}" = '*' THEN -9998
        WHEN regexp_full_match("{column}", '-?[0-9]+') THEN CAST("{column}" AS integer)
        WHEN "{column}" IS NOT NULL THEN -5000 END"""


def stat_dimension(column: str, table: str, numeric_star: bool = False) -> str:
    star = f"""printed = '*'{" OR regexp_full_match(printed, '-?[0-9]+')" if numeric_star else ""}"""
    return (
        with_(STAGING)
        + f"""SELECT row_ord AS {table}_id, CAST(value AS integer) AS {table}_value,
            printed IN ('X', 'x') AS is_x_{table}, ({star}) AS is_star_{table}
        FROM (SELECT row_ord, "{column}" AS printed, {stat_value(column)} AS value FROM stg WHERE "{column}" IS NOT NULL)
        QUALIFY row_number() OVER (PARTITION BY value ORDER BY row_ord) = 1"""
    )


def key_dimension(value: str, id_name: str, key: str) -> str:
    return with_(STAGING) + f"SELECT min(row_ord) AS {id_name}, {value} AS {key} FROM stg GROUP BY {value}"


SET_DIM = """set_dim AS (
        SELECT min(place) AS set_id, set_name FROM (
            SELECT "setCode" AS set_name, row_ord * 1048576 AS place FROM stg
            UNION ALL SELECT item, row_ord * 1048576 + pos + 1 FROM set_items)
        GROUP BY set_name)"""
SETS = ",\n".join((items("set_items", "setCode"), SET_DIM))

ORACLES: dict[str, str] = {
    "staging_projection": staging_sql(),
    "csv_roundtrip": with_(STAGING) + "SELECT * REPLACE (row_number() OVER (ORDER BY row_ord) - 1 AS row_ord) FROM stg",
    "first_wins_cards": with_(STAGING, KEPT) + "SELECT row_ord, uuid, name FROM kept",
    "load_status": with_(STAGING)
    + """SELECT row_ord, CASE WHEN row_number() OVER (PARTITION BY uuid ORDER BY row_ord) = 1
        THEN row_ord ELSE -1 END AS result FROM stg""",
    "text_rows": with_(STAGING) + 'SELECT row_ord AS oracle_text_id, "text" AS oracle_text FROM stg',
    "dim_artist": key_dimension("coalesce(artist, 'UNKNOWN')", "artist_id", "artist_name"),
    "dim_rarity": key_dimension("lower(trim(rarity, ' '))", "rarity_id", "rarity_name"),
    "dim_set": with_(STAGING, KEPT, SETS) + "SELECT set_id, set_name FROM set_dim",
    "dim_power": stat_dimension("power", "card_power"),
    "dim_power_numeric_star": stat_dimension("power", "card_power", numeric_star=True),
    "dim_toughness": stat_dimension("toughness", "card_toughness"),
    "dim_cost": with_(STAGING, COSTS) + "SELECT * FROM cost_dim",
    "cost_totals": with_(STAGING, COSTS) + "SELECT * FROM cost_dim",
    "dim_pip": with_(STAGING, COSTS) + "SELECT * FROM pip_dim",
    "cost_pips": with_(STAGING, COSTS)
    + """SELECT mana_cost_id * 1048576 + pos AS mana_cost_mana_pip_id, mana_cost_id, mana_pip_id
        FROM pips JOIN pip_dim ON symbol = mana_pip_symbol""",
    "name_set_bridge": with_(STAGING, KEPT, SETS)
    + """SELECT DISTINCT k.name AS card_name, d.set_id
        FROM kept k JOIN set_items i ON i.row_ord = k.row_ord JOIN set_dim d ON d.set_name = i.item
        WHERE k.name IS NOT NULL""",
    "identity_within": with_(STAGING, KEPT, items("colors", "colorIdentity"))
    + """SELECT row_ord AS card_id, uuid FROM kept k WHERE NOT EXISTS (
        SELECT 1 FROM colors c WHERE c.row_ord = k.row_ord AND c.item NOT IN ('W', 'U'))""",
    "fact_cards": with_(STAGING, KEPT, COSTS, SETS)
    + f""", artists AS (SELECT min(row_ord) AS id, coalesce(artist, 'UNKNOWN') AS v FROM stg GROUP BY v),
    rarities AS (SELECT min(row_ord) AS id, lower(trim(rarity, ' ')) AS v FROM stg GROUP BY v),
    powers AS (SELECT min(row_ord) AS id, {stat_value("power")} AS v FROM stg WHERE power IS NOT NULL GROUP BY v),
    toughnesses AS (SELECT min(row_ord) AS id, {stat_value("toughness")} AS v FROM stg WHERE toughness IS NOT NULL GROUP BY v)
    SELECT k.row_ord AS card_id, k.uuid AS card_uuid, k.name AS card_name,
        coalesce(c.mana_cost_id, k.row_ord) AS mana_cost_id, k.row_ord AS oracle_text_id,
        p.id AS card_power_id, t.id AS card_toughness_id, a.id AS artist_id, s.set_id, r.id AS rarity_id,
        CAST(NULL AS integer) AS loyalty, CAST(NULL AS boolean) AS is_reprint
    FROM kept k
    LEFT JOIN costs c ON c.mana_cost_text = upper(k."manaCost")
    LEFT JOIN powers p ON p.v = ({stat_value("power")})
    LEFT JOIN toughnesses t ON t.v = ({stat_value("toughness")})
    JOIN artists a ON a.v = coalesce(k.artist, 'UNKNOWN')
    JOIN rarities r ON r.v = lower(trim(k.rarity, ' '))
    JOIN set_dim s ON s.set_name = k."setCode\"""",
}

# short name -> staging column, id, key
LISTS = {
    "type": ("types", "card_type_id", "card_type_name"),
    "subtype": ("subtypes", "card_subtype_id", "card_subtype_name"),
    "supertype": ("supertypes", "card_supertype_id", "card_supertype_name"),
    "format": ("availability", "format_id", "format_name"),
    "ability": ("keywords", "card_ability_id", "card_ability_name"),
    "color": ("colorIdentity", "color_identity_id", "color_identity_symbol"),
}
for _short, (_column, _id, _key) in LISTS.items():
    _ctes = with_(STAGING, KEPT, items("i", _column), item_dimension("d", "i"))
    ORACLES[f"dim_{_short}"] = _ctes + f"SELECT id AS {_id}, item AS {_key} FROM d"
    ORACLES[f"bridge_{_short}"] = (
        _ctes + f"SELECT DISTINCT i.row_ord AS card_id, d.id AS {_id} FROM i JOIN d ON d.item = i.item"
    )


def names(result: str) -> str:
    """CTEs ending in (card_id, <result>)."""
    return ",\n".join((
        items(f"{result}_i", result),
        item_dimension(f"{result}_d", f"{result}_i"),
        f"""{result}_agg AS (
        SELECT card_id, string_agg(item, ' ' ORDER BY id) AS {result}
        FROM (SELECT DISTINCT i.row_ord AS card_id, d.id, d.item FROM {result}_i i JOIN {result}_d d ON d.item = i.item)
        GROUP BY card_id)""",
    ))


for _result in ("types", "subtypes", "supertypes"):
    ORACLES[f"agg_{_result}"] = with_(STAGING, KEPT, names(_result)) + f"SELECT * FROM {_result}_agg"

PROFILE = ",\n".join((
    STAGING, KEPT, COSTS, names("types"), names("subtypes"), names("supertypes"),
    """profile AS (
        SELECT k.row_ord AS card_id, k.name AS card_name, c.mana_cost_text AS mana,
               coalesce(c.mana_cost_total, 0) AS cmc, t.types, s.subtypes, u.supertypes
        FROM kept k
        LEFT JOIN cost_dim c ON c.mana_cost_text = upper(k."manaCost")
        LEFT JOIN types_agg t ON t.card_id = k.row_ord
        LEFT JOIN subtypes_agg s ON s.card_id = k.row_ord
        LEFT JOIN supertypes_agg u ON u.card_id = k.row_ord)""",
))
ORACLES["card_profile"] = with_(PROFILE) + "SELECT * FROM profile"
ORACLES["incremental_load"] = ORACLES["card_profile"]
ORACLES["stream_incremental_load"] = ORACLES["card_profile"]
ORACLES["compacted_profile"] = ORACLES["card_profile"]
ORACLES["profile_by_id"] = with_(PROFILE) + "SELECT * FROM profile WHERE card_id = 1"
ORACLES["profile_by_cost"] = with_(PROFILE) + "SELECT * FROM profile WHERE cmc >= 8"
ORACLES["profile_view"] = (
    with_(PROFILE)
    + """SELECT k."setCode" AS set_name, p.types, count(*) AS cards, CAST(sum(p.cmc) AS bigint) AS total_cmc
    FROM profile p JOIN kept k ON k.row_ord = p.card_id GROUP BY k."setCode", p.types"""
)

_STAGING_NULLS = (
    "uuid", "name", "manaCost", "types", "subtypes", "supertypes", "keywords", "text", "artist", "setCode",
    "availability", "rarity", "power", "toughness", "colorIdentity",
)
ORACLES["dq_unique"] = with_(STAGING) + """
    SELECT 'staging.uuid' AS rule, count(*) AS violations FROM (SELECT uuid FROM stg GROUP BY uuid HAVING count(*) > 1)
    UNION ALL SELECT 'artist.artist_name', count(*) FROM (
        SELECT artist_name FROM (SELECT DISTINCT coalesce(artist, 'UNKNOWN') AS artist_name FROM stg) GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'mana_cost.mana_cost_text', count(*) FROM (
        SELECT t FROM (SELECT DISTINCT upper("manaCost") AS t FROM stg WHERE "manaCost" IS NOT NULL) GROUP BY 1 HAVING count(*) > 1)"""
ORACLES["dq_not_null"] = with_(STAGING) + " UNION ALL ".join(
    f"""SELECT 'not null staging.{c}' AS rule, count(*) AS violations FROM stg WHERE "{c}" IS NULL"""
    for c in _STAGING_NULLS
)
_REFERENCES = (
    ("labels", "doc_id", "documents", "doc_id"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("events", "user_id", "customer", "c_custkey"),
)
ORACLES["dq_fk"] = with_(STAGING, KEPT) + " UNION ALL ".join([
    *[
        f"""SELECT '{child}.{column}' AS rule, count(DISTINCT {column}) AS violations FROM {child}
        WHERE {column} NOT IN (SELECT {key} FROM {parent} WHERE {key} IS NOT NULL)"""
        for child, column, parent, key in _REFERENCES
    ],
    "SELECT 'staging.name', count(DISTINCT name) FROM stg WHERE name NOT IN (SELECT name FROM kept WHERE name IS NOT NULL)",
])
ORACLES["dq_pairs"] = """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""
ORACLES["dq_review"] = with_(STAGING) + " UNION ALL ".join(
    f"""SELECT '{c}' AS stat, row_ord, "{c}" AS printed FROM stg WHERE ({stat_value(c)}) = -5000"""
    for c in ("power", "toughness")
)
ORACLES["dq_orphans"] = with_(STAGING, KEPT, COSTS) + """
    SELECT 'oracle_text' AS table_name, row_ord AS id FROM stg WHERE row_ord NOT IN (SELECT row_ord FROM kept)
    UNION ALL
    SELECT 'mana_cost', mana_cost_id FROM cost_dim WHERE mana_cost_id NOT IN (
        SELECT coalesce(c.mana_cost_id, k.row_ord)
        FROM kept k LEFT JOIN costs c ON c.mana_cost_text = upper(k."manaCost"))"""

# Every rule of the stored model, none of them broken.
_RULES = [
    *[f"not null {table}.{column}" for table, columns in REQUIRED.items() for column in columns],
    *[f"unique {table}.{column}" for table, column in UNIQUE.items()],
    *[f"unique {table}" for table in UNIQUE_PAIRS],
    *[f"reference {child}.{column}" for child, column, _ in REFERENCES],
]
_LISTS = "lists AS (SELECT k.row_ord AS card_id, coalesce(list(i.item) FILTER (WHERE i.item IS NOT NULL), []) AS held FROM kept k LEFT JOIN i ON i.row_ord = k.row_ord GROUP BY k.row_ord)"


def held(column: str, condition: str) -> str:
    return with_(STAGING, KEPT, items("i", column), _LISTS) + f"SELECT card_id FROM lists WHERE {condition}"


ORACLES["cards_with_all"] = held("types", "list_has_all(held, ['Artifact', 'Creature'])")
ORACLES["cards_with_none"] = held("keywords", "NOT list_has_any(held, ['Ability1', 'Ability4'])")
ORACLES["cards_with_only"] = held("colorIdentity", "list_contains(held, 'W') AND list_has_all(['W', 'U'], held)")
ORACLES["stream_item_bridge"] = ORACLES["bridge_type"]
ORACLES["ordinals_assigned"] = """SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_ord FROM orders"""
ORACLES["load_rejected"] = with_(STAGING) + """
    SELECT row_ord, CASE WHEN row_ord % 97 = 0 THEN 'no uuid' WHEN row_ord % 89 = 0 THEN 'power out of range'
        ELSE 'manaCost out of range' END AS reason
    FROM stg WHERE row_ord % 97 = 0 OR row_ord % 89 = 0 OR row_ord % 83 = 0"""
ORACLES["model_integrity"] = "SELECT unnest([{}]) AS rule, CAST(0 AS bigint) AS violations".format(
    ", ".join(f"'{rule}'" for rule in _RULES)
)
ORACLES["stream_running_total"] = """SELECT event_type,
    round(CAST(sum(CAST(value AS decimal(18,4))) AS double), 4) AS total FROM events GROUP BY event_type"""
ORACLES["stream_total_updates"] = """SELECT event_type, sum(units) / 10000.0::double AS total, count(*) AS users
    FROM (SELECT event_type, CAST(round(coalesce(value, 0) * 10000) AS bigint) AS units FROM events WHERE user_id IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
    GROUP BY event_type"""
ORACLES["stream_get_or_insert"] = "SELECT DISTINCT user_id FROM events WHERE user_id IS NOT NULL"
ORACLES["stream_tokens"] = f"""SELECT DISTINCT trim(item, ' ') AS item
    FROM (SELECT unnest(string_split_regex(props, '{SPLIT}')) AS item FROM events)"""
ORACLES["html_tag_pips"] = """SELECT token, count(*) AS uses, min({'o': page_id, 'p': pos}).o AS first_owner,
        CAST(min({'o': page_id, 'p': pos}).p AS integer) AS first_pos
    FROM (SELECT page_id, unnest(range(len(l))) AS pos, unnest(l) AS token
          FROM (SELECT page_id, regexp_extract_all(html, '<([^>]+)>', 1) AS l FROM pages))
    GROUP BY token"""
ORACLES["doc_tokens"] = f"""SELECT token, count(*) AS uses, min({{'o': doc_id, 'p': pos}}).o AS first_owner,
        CAST(min({{'o': doc_id, 'p': pos}}).p AS integer) AS first_pos
    FROM (SELECT doc_id, unnest(range(len(l))) AS pos, trim(unnest(l), ' ') AS token
          FROM (SELECT doc_id, string_split_regex("text", '{SPLIT}') AS l FROM documents))
    GROUP BY token"""
ORACLES["sql_functions"] = with_(STAGING, items("i", "types", "stg")) + """
    SELECT lower(trim(s.rarity, ' ')) AS rarity, i.item, count(*) AS uses
    FROM stg s JOIN i ON i.row_ord = s.row_ord GROUP BY 1, 2"""
ORACLES["sql_cost_tokens"] = with_(STAGING) + f"""
    SELECT row_ord, CAST(unnest(range(len(l))) AS integer) AS pos, upper(trim(unnest(l), ' ')) AS symbol
    FROM (SELECT row_ord, regexp_extract_all("manaCost", '{BRACES}', 1) AS l FROM stg)"""
