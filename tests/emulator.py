"""The rules of the load, one record at a time in plain Python. Tests only."""

from __future__ import annotations

import re

SPLIT = re.compile(r"[ \t\n\x0b\f\r]*,[ \t\n\x0b\f\r]*")
LISTS = {
    "types": "card_type",
    "subtypes": "card_subtype",
    "supertypes": "card_supertype",
    "availability": "format",
    "keywords": "card_ability",
    "colorIdentity": "color_identity",
}


def split(text):
    return [item.strip(" ") for item in SPLIT.split(text)]


def pip_value(symbol):
    if symbol == "X":
        return 0
    return int(symbol) if re.fullmatch(r"[0-9]+", symbol) else 1


def stat(text, numeric_star=False):
    if text in ("X", "x"):
        return -9999, True, False
    if text == "*":
        return -9998, False, True
    if re.fullmatch(r"-?[0-9]+", text):
        return int(text), False, numeric_star
    return -5000, False, False


class Emulator:
    """Dimensions are insertion-ordered dicts, so their order is the order of first appearance."""

    def __init__(self):
        self.dims = {name: {} for name in ("artist", "set", "rarity", "card_power", "card_toughness", *LISTS.values())}
        self.costs = {}  # text -> total
        self.null_costs = 0
        self.pips = {}  # symbol -> cost
        self.cost_pips = []  # (cost text, symbol), repeats kept
        self.texts = []
        self.cards = {}  # uuid -> dict
        self.items = {name: set() for name in LISTS.values()}
        self.name_sets = set()
        self.status = []

    def load(self, records):
        for record in records:
            self.insert(record)
        return self

    def insert(self, r):
        cost = None if r["manaCost"] is None else r["manaCost"].upper()
        if cost is None:
            self.null_costs += 1
        elif cost not in self.costs:
            symbols = [token.strip(" ").upper() for token in re.findall(r"\{([^}]+)\}", cost)]
            for symbol in symbols:
                self.pips.setdefault(symbol, pip_value(symbol))
                self.cost_pips.append((cost, symbol))
            self.costs[cost] = sum(self.pips[symbol] for symbol in symbols)
        artist = "UNKNOWN" if r["artist"] is None else r["artist"]
        rarity = r["rarity"].strip(" ").lower()
        self.dims["artist"].setdefault(artist)
        self.dims["rarity"].setdefault(rarity)
        self.dims["set"].setdefault(r["setCode"])
        self.texts.append(r["text"])
        stats = {}
        for name in ("power", "toughness"):
            if r[name] is not None:
                value, *flags = stat(r[name])
                self.dims[f"card_{name}"].setdefault(value, tuple(flags))
                stats[name] = value
        if r["uuid"] in self.cards:
            self.status.append(False)
            return
        self.status.append(True)
        self.cards[r["uuid"]] = {
            "name": r["name"], "cost": cost, "artist": artist, "set": r["setCode"], "rarity": rarity,
            "power": stats.get("power"), "toughness": stats.get("toughness"), "text": r["text"],
        }
        for column, dim in LISTS.items():
            if r[column] is not None:
                for item in split(r[column]):
                    self.dims[dim].setdefault(item)
                    self.items[dim].add((r["uuid"], item))
        for item in split(r["setCode"]):
            self.dims["set"].setdefault(item)
            if r["name"] is not None:
                self.name_sets.add((r["name"], item))

    def names(self, dim, uuid):
        """Item names of a card in order of first appearance in the whole load."""
        found = [item for item in self.dims[dim] if (uuid, item) in self.items[dim]]
        return " ".join(found) if found else None

    def profile(self):
        return {
            uuid: (
                card["name"], card["cost"], self.costs.get(card["cost"], 0),
                self.names("card_type", uuid), self.names("card_subtype", uuid), self.names("card_supertype", uuid),
            )
            for uuid, card in self.cards.items()
        }
