"""Staging records for tests."""

from __future__ import annotations

import random

from strandweave.fixed import ROW_ORD, STAGING_COLUMNS

SCHEMA = f"{ROW_ORD} long, " + ", ".join(f"`{name}` string" for name in STAGING_COLUMNS)
DEFAULTS = {"types": "Creature", "setCode": "S1", "availability": "paper", "rarity": "common"}


def record(uuid, **values):
    return {**dict.fromkeys(STAGING_COLUMNS), **DEFAULTS, "uuid": uuid, **values}


def frame(spark, records, start=0, partitions=3):
    rows = [(start + i, *[r[name] for name in STAGING_COLUMNS]) for i, r in enumerate(records)]
    random.Random(1).shuffle(rows)  # only row_ord may matter
    return spark.createDataFrame(rows, SCHEMA).repartition(partitions)


def some(rng, *choices):
    return rng.choice(choices)


def random_records(count, seed=7):
    """Records full of edge cases; a third share one uuid, artist and cost."""
    rng = random.Random(seed)
    items = ["a", "b", "", "Artifact", "Land", "x y", "\ta", "UP", "up"]

    def listing():
        if rng.random() < 0.2:
            return None
        joiner = some(rng, ",", ", ", " ,", " , ", ",\t")
        return joiner.join(rng.choice(items) for _ in range(rng.randint(1, 4)))

    records = []
    for i in range(count):
        hot = rng.random() < 0.34
        pips = "".join("{" + some(rng, "W", "w", " u ", "X", "x", "2", "10", "2/W", " ", "007") + "}" for _ in range(rng.randint(0, 3)))
        records.append(record(
            "hot" if hot else f"u{rng.randint(0, count)}",
            name=some(rng, None, "n1", "n2", f"n{i}"),
            manaCost="{1}{G}" if hot else some(rng, None, "", pips, pips, pips + " // {R}"),
            types=listing(), subtypes=listing(), supertypes=listing(), keywords=listing(),
            availability=listing(), colorIdentity=some(rng, None, "W", "W, U", "B,R ,G"),
            text=some(rng, None, "", f"text {i}"),
            artist=None if hot else some(rng, None, "UNKNOWN", f"artist {rng.randint(0, 30)}", "Artist 1 "),
            setCode=some(rng, "S1", "S2", "S3,S4", "S3", " S5"),
            rarity=some(rng, "common", " Common ", "RARE", "mythic"),
            power=some(rng, None, "X", "x", "*", "1", "-1", "007", "7", "1+*", "", "-9999", "-9998", "-5000"),
            toughness=some(rng, None, "X", "*", " 3", "-0", "0", "5\n", "-9999"),
        ))
    return records
