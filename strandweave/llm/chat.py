"""Chat formatting: layouts are recognised by a hash of their nested field paths.

Every known layout is declared once: its fields, and where the turns' roles and texts lie.  The
paths of a table's schema, or those of each JSON record, are hashed; the hash selects the layout,
and the layout's expressions give canonical turns (conv_id, turn, role, text).  Turns are then
written with a template and a loss mask, and can be read back from that output alone.

The template is ``<s>[role]``, a line feed, the text, ``</s>`` for each turn.  In roles and texts
``~ < [ ]`` become ``~0 ~1 ~2 ~3``, so a text can hold no control string, and reading back undoes it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

ESCAPES = (("~", "~0"), ("<", "~1"), ("[", "~2"), ("]", "~3"))
TURN_START, HEAD_END, TURN_END = "<s>[", "]\n", "</s>"
LEARNED_ROLE = "assistant"
ROLE_NAMES = {"human": "user", "gpt": "assistant", "model": "assistant", "bot": "assistant"}


@dataclass(frozen=True)
class Layout:
    """``fields`` maps a field to None (a value) or to the fields of the objects it lists.

    ``turns`` lists what becomes turns: (role, field) for a value; for a list (role field, text
    field) of ``listed``.  ``by_row`` layouts hold one turn per row already.
    """

    name: str
    fields: Mapping[str, Mapping[str, None] | None]
    turns: tuple[tuple[str, str], ...] = ()
    listed: str | None = None
    by_row: bool = False
    optional: frozenset[str] = field(default_factory=frozenset)


LAYOUTS = (
    Layout("turn rows", {"conv_id": None, "turn": None, "role": None, "text": None}, by_row=True),
    Layout("messages", {"messages": {"role": None, "content": None}}, (("role", "content"),), "messages"),
    Layout("conversations", {"conversations": {"from": None, "value": None}}, (("from", "value"),), "conversations"),
    Layout("system and messages", {"system": None, "messages": {"role": None, "content": None}}, (("role", "content"),), "messages"),
    Layout("instruction with input", {"instruction": None, "input": None, "output": None}, (("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Layout("instruction", {"instruction": None, "output": None}, (("user", "instruction"), ("assistant", "output"))),
    Layout("instruction and response", {"instruction": None, "response": None}, (("user", "instruction"), ("assistant", "response"))),
    Layout("prompt and completion", {"prompt": None, "completion": None}, (("user", "prompt"), ("assistant", "completion"))),
    Layout("prompt and response", {"prompt": None, "response": None}, (("user", "prompt"), ("assistant", "response"))),
    Layout("question and answer", {"question": None, "answer": None}, (("user", "question"), ("assistant", "answer"))),
)
KNOWN_FIELDS = frozenset(name for layout in LAYOUTS for name in layout.fields)
ID_FIELDS = frozenset({"conv_id", "id"})
_RECORD_LAYOUTS = tuple(layout for layout in LAYOUTS if not layout.by_row)


def _paths(fields: Mapping[str, Mapping[str, None] | None]) -> str:
    """The nested paths as one text, names sorted at each level."""
    parts = [f"{name}: ARRAY<OBJECT<{', '.join(sorted(inner))}>>" if inner else name for name, inner in sorted(fields.items())]
    return f"OBJECT<{', '.join(parts)}>"


def _digest(paths: str) -> str:
    return hashlib.sha256(paths.encode()).hexdigest()


def fingerprint_of(paths: Column) -> Column:
    return F.sha2(paths, 256)


def schema_paths(schema: T.StructType) -> dict[str, Mapping[str, None] | None]:
    """Known fields of a table and the fields of the objects they list; other columns do not count."""
    found: dict[str, Mapping[str, None] | None] = {}
    for column in schema.fields:
        if column.name in KNOWN_FIELDS:
            kind = column.dataType
            listed = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType)
            found[column.name] = {name: None for name in kind.elementType.names} if listed else None
    return found


def layout_of(schema: T.StructType) -> Layout:
    """The layout whose hash equals that of the table's known paths, else the richest one inside it."""
    found = schema_paths(schema)
    by_paths = {_digest(_paths(layout.fields)): layout for layout in LAYOUTS}
    for names in (found, {k: v for k, v in found.items() if k not in ID_FIELDS}):
        if _digest(_paths(names)) in by_paths:
            return by_paths[_digest(_paths(names))]
    inside = [
        layout for layout in LAYOUTS
        if all(name in found and (inner is None) == (found[name] is None) and set(inner or ()) <= set(found[name] or ()) for name, inner in layout.fields.items())
    ]
    if not inside:
        raise ValueError(f"no known layout in {_paths(found)}")
    return max(inside, key=lambda layout: (layout.by_row, len(layout.fields)))


def _role(role: Column) -> Column:
    """Other names of the canonical roles."""
    named = F.coalesce(role, F.lit(""))
    for old, new in ROLE_NAMES.items():
        named = F.when(role == old, new).otherwise(named)
    return named


def _turns(layout: Layout, value) -> Column:
    """Turns of a record as an array of (role, text); ``value`` gives a field's column."""
    if layout.listed:
        (role, text), = layout.turns
        turns = F.transform(value(layout.listed), lambda m: F.struct(_role(m[role].cast("string")).alias("role"), m[text].cast("string").alias("text")))
        if "system" in layout.fields:
            system = F.array(F.struct(F.lit("system").alias("role"), value("system").cast("string").alias("text")))
            turns = F.concat(F.filter(system, lambda m: m["text"].isNotNull()), turns)
        return turns
    turns = F.array(*[F.struct(F.lit(role).alias("role"), value(name).cast("string").alias("text")) for role, name in layout.turns])
    if "input" in layout.fields:  # an empty input is no turn
        return F.filter(turns, lambda t, i: (i != 1) | (F.coalesce(t["text"], F.lit("")) != ""))
    return turns


def _exploded(records: DataFrame) -> DataFrame:
    turns = records.select("conv_id", F.posexplode("turns").alias("turn", "t"))
    return turns.select("conv_id", F.col("turn").cast("long").alias("turn"), "t.role", "t.text")


def canonical_turns(df: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of a table in any known layout; ``id`` or ``conv_id`` names the record."""
    layout = layout_of(df.schema)
    if layout.by_row:
        return df.select("conv_id", "turn", "role", "text")
    names = [name for name in ("conv_id", "id") if name in df.columns]
    key = F.col(names[0]) if names else F.monotonically_increasing_id()
    return _exploded(df.select(key.alias("conv_id"), _turns(layout, lambda name: F.col(f"`{name}`")).alias("turns")))


def _json_type(layout: Layout) -> str:
    parts = [f"`{name}` array<struct<{','.join(f'`{x}`:string' for x in inner)}>>" if inner else f"`{name}` string" for name, inner in layout.fields.items()]
    return ", ".join(parts)


def _known_paths(record: Column) -> tuple[Column, dict[str, Column]]:
    """The known paths of a JSON record as one text like ``_paths``, and its known fields.

    A field that lists objects gives the names they hold; of a plain one only its presence counts.
    """
    names: dict[str, set[str]] = {}
    for layout in _RECORD_LAYOUTS:
        for name, inner in layout.fields.items():
            names.setdefault(name, set()).update(inner or ())
    keys = F.coalesce(F.json_object_keys(record), F.array().cast("array<string>"))
    fields = {}
    for name, inner in sorted(names.items()):
        held = F.lit(name)
        if inner:
            listed = F.from_json(record, f"`{name}` array<map<string,string>>")[name]
            of_objects = F.array_distinct(F.flatten(F.transform(listed, F.map_keys)))
            objects = F.array_sort(F.array_intersect(of_objects, F.array(*[F.lit(x) for x in sorted(inner)])))
            kind = F.concat(F.lit(f"{name}: ARRAY<OBJECT<"), F.array_join(objects, ", "), F.lit(">>"))
            held = F.coalesce(F.when(F.size(objects) > 0, kind), held)
        fields[name] = F.when(F.array_contains(keys, name), held)
    return F.concat(F.lit("OBJECT<"), F.concat_ws(", ", *fields.values()), F.lit(">")), fields


def _marked(df: DataFrame, record: str, conv_id: str) -> DataFrame:
    """conv_id, record, fingerprint of its known paths, and the number of its layout, null if none.

    A layout whose hash is equal is taken, else the richest one inside the known paths.
    """
    paths, fields = _known_paths(F.col(record))
    marked = df.select(F.col(conv_id).alias("conv_id"), F.col(record).alias("record"), fingerprint_of(paths).alias("fingerprint"), F.struct(
        *[held.alias(name) for name, held in fields.items()]).alias("held"))
    chosen = F.lit(None).cast("int")
    for number, layout in sorted(enumerate(_RECORD_LAYOUTS), key=lambda x: (len(x[1].fields), -x[0])):
        inside = F.lit(True)
        for name, inner in layout.fields.items():
            wanted = f"{name}: ARRAY<OBJECT<{', '.join(sorted(inner))}>>" if inner else name
            inside = inside & F.coalesce(F.col("held")[name] == wanted, F.lit(False))
        chosen = F.when(inside, F.lit(number)).otherwise(chosen)
    for number, layout in enumerate(_RECORD_LAYOUTS):
        chosen = F.when(F.col("fingerprint") == _digest(_paths(layout.fields)), F.lit(number)).otherwise(chosen)
    return marked.withColumn("layout", chosen).drop("held")


def canonical_json(df: DataFrame, record: str, conv_id: str) -> DataFrame:
    """Turns of JSON records, each in a layout of its own; ``unmatched_json`` gives those of no known layout.

    Only known paths count: ids and fields that no layout names may come along.  A record whose
    list is empty or null has no turns.
    """
    turns = F.array().cast("array<struct<role:string,text:string>>")
    for number, layout in enumerate(_RECORD_LAYOUTS):
        parsed = F.from_json("record", _json_type(layout))
        turns = F.when(F.col("layout") == number, _turns(layout, lambda name, p=parsed: p[name])).otherwise(turns)
    return _exploded(_marked(df, record, conv_id).select("conv_id", turns.alias("turns")))


def unmatched_json(df: DataFrame, record: str, conv_id: str) -> DataFrame:
    """conv_id, fingerprint, paths and record of all records without a known layout.

    ``paths`` holds every path of the record, for declaring a layout; null where it is not JSON.
    """
    paths = F.expr("schema_of_variant(try_parse_json(record))").alias("paths")
    return _marked(df, record, conv_id).where("layout IS NULL").select("conv_id", "fingerprint", paths, "record")


def escape(text: Column) -> Column:
    for plain, escaped in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def unescape(text: Column) -> Column:
    """The opposite order: ``~0`` last, as it gives back the sign the others begin with."""
    for plain, escaped in reversed(ESCAPES):
        text = F.replace(text, F.lit(escaped), F.lit(plain))
    return text


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans (start and length in code points).

    Rows are taken by turn, ties by role and text; a null text or role is empty, rows without a
    conversation make up one conversation, repeated rows are turns too, and an empty table gives
    no rows.  A conversation is one value, so it must fit Spark's limit for a value.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(TURN_START), escape(role), F.lit(HEAD_END))
    parts = turns.select("conv_id", "turn", "role", "text", head.alias("head"), escape(text).alias("body"), (role == LEARNED_ROLE).alias("learned"))
    parts = parts.withColumn("block", F.concat("head", "body", F.lit(TURN_END)))
    before = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.select(
        "conv_id", F.coalesce(F.sum(F.char_length("block")).over(before), F.lit(0)).alias("start"), "block", "learned",
        F.char_length("head").alias("head_chars"), F.char_length("body").alias("body_chars"))
    blocks = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("start", "block", "learned", "head_chars", "body_chars"))).alias("blocks"))
    spans = F.transform(
        F.filter("blocks", lambda b: b["learned"]),
        lambda b: F.struct((b["start"] + b["head_chars"]).cast("int").alias("start"), b["body_chars"].alias("length")))
    return blocks.select("conv_id", F.array_join(F.transform("blocks", lambda b: b["block"]), "").alias("formatted"), spans.alias("loss_spans"))


def read_chats(chats: DataFrame) -> DataFrame:
    """conv_id, turns (role, text) and the text under the loss mask, from the formatted output alone."""
    blocks = F.filter(F.split("formatted", TURN_END, -1), lambda block: block != "")
    turns = F.transform(blocks, lambda block: F.struct(
        unescape(F.substr(F.substring_index(block, HEAD_END, 1), F.lit(len(TURN_START) + 1))).alias("role"),
        unescape(F.substr(block, F.char_length(F.substring_index(block, HEAD_END, 1)) + len(HEAD_END) + 1)).alias("text")))
    learned = F.array_join(F.transform("loss_spans", lambda s: unescape(F.substr("formatted", s["start"] + 1, s["length"]))), "")
    return chats.select("conv_id", turns.alias("turns"), learned.alias("loss_text"), F.char_length("formatted").cast("long").alias("formatted_chars"))


def chat_digests(chats: DataFrame) -> DataFrame:
    """What the formatted output holds: turns and learned text as counts and digests."""
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_chats(chats).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")
