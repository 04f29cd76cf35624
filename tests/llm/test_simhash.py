import random
import re

import xxhash

from strandweave.llm import simhash
from strandweave.tables import Workspace


def by_hand(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints):
    """Smallest id reachable over links of two bits, by comparing all pairs."""
    parent = {p: p for p in prints}

    def find(p):
        while parent[p] != p:
            p = parent[p]
        return p

    prints = list(prints)
    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= 2:
                parent[find(a)] = find(b)
    return {p: find(p) for p in prints}


def check(spark, docs, **options):
    rows = docs.select("doc_id", "text").collect()
    prints = [(r.doc_id, by_hand(r.text)) for r in rows]
    root = classes({p for _, p in prints})
    least = {}
    for i, p in prints:
        if i is not None:
            least[root[p]] = min(i, least.get(root[p], i))
    wanted = sorted((str(i), f"{p:016x}", str(least.get(root[p]))) for i, p in prints)
    got = simhash.fingerprint_components(docs, Workspace(spark), **options).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == wanted


def test_edge_documents(spark, edge_documents, no_documents):
    check(spark, edge_documents)
    assert simhash.fingerprint_components(no_documents, Workspace(spark)).collect() == []
    left = simhash.drop_near_duplicates(edge_documents, Workspace(spark))
    assert left.columns == edge_documents.columns
    prints = {by_hand(r.text) for r in edge_documents.collect()}
    assert left.count() == len(set(classes(prints).values()))


def test_given_table(spark):
    check(spark, spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


def cloud(spark):
    """Fingerprints a few bits from each other: crowded cells, chains and outliers."""
    draw = random.Random(9)
    centres = [draw.getrandbits(64) for _ in range(6)]
    found = set(centres)
    for centre in centres[:3]:
        for _ in range(150):
            point = centre
            for _ in range(draw.randrange(1, 5)):
                point ^= 1 << draw.randrange(64)
            found.add(point)
    chain = centres[5]
    for bit in range(0, 64, 2):
        chain ^= 3 << bit
        found.add(chain)
    return found, spark.createDataFrame([(simhash._signed(p),) for p in found], "bits bigint")


def test_all_classes_whatever_cells_count_as_crowded(spark):
    points, prints = cloud(spark)
    wanted = classes(points)
    for crowded in (1, 24, 10_000):
        ties = simhash.links(prints, Workspace(spark), crowded).collect()
        assert all(((t.u ^ t.v) & (1 << 64) - 1).bit_count() <= 2 for t in ties)
        roots = {r.node: r.root for r in simhash.components(simhash.links(prints, Workspace(spark), crowded), Workspace(spark)).collect()}
        group = {p: roots.get(simhash._signed(p), simhash._signed(p)) for p in points}
        assert len(set(group.values())) == len(set(wanted.values()))
        assert all((group[a] == group[b]) == (wanted[a] == wanted[b]) for a in list(points)[::9] for b in list(points)[::7])


def test_long_text_is_hashed_whole():
    text = "a b c " * 40_000 + "d e f"
    assert simhash.fingerprint(text) & (1 << 64) - 1 == by_hand(text)
