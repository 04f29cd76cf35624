"""Values the results depend on, and the names of the input columns."""

# Stored in place of a printed power or toughness.
STAT_VARIABLE = -9999  # printed as X or x
STAT_STAR = -9998  # printed as *
STAT_REVIEW = -5000  # any other text that is not an integer

# Key used when the artist is missing, result for a repeated record.
UNKNOWN_ARTIST = "UNKNOWN"
DUPLICATE = -1

# Fixed patterns: list separator, cost token, integers. \A and \z because $ would
# also accept a text that ends in a line feed.
LIST_SEPARATOR = r"\s*,\s*"
COST_TOKEN = r"\{([^}]+)\}"
UNSIGNED_INTEGER = r"\A\d+\z"
SIGNED_INTEGER = r"\A-?\d+\z"

# Fixed names: the fifteen staging columns, all text, in load order.
STAGING_COLUMNS = (
    "uuid",
    "name",
    "manaCost",
    "types",
    "subtypes",
    "supertypes",
    "keywords",
    "text",
    "artist",
    "setCode",
    "availability",
    "rarity",
    "power",
    "toughness",
    "colorIdentity",
)

# Position of a record in the load; ours, it makes "first" explicit.
ROW_ORD = "row_ord"
