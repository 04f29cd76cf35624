from strandweave.functions.ordinals import first_seen_id
from strandweave.functions.text import (
    brace_tokens,
    integer,
    list_tokens,
    pip_cost,
    pip_symbol,
    stat_flags,
    stat_value,
    total_cost,
)

__all__ = [
    "brace_tokens",
    "first_seen_id",
    "integer",
    "list_tokens",
    "pip_cost",
    "pip_symbol",
    "stat_flags",
    "stat_value",
    "total_cost",
]
