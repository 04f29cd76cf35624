import numpy as np
import pytest

from strandweave.llm import ann
from strandweave.tables import Workspace


def by_hand(rows, every, count, length=4):
    usable = {}
    for vec_id, vector in rows:
        if vec_id is not None and vector is not None and len(vector) == length and None not in vector and np.isfinite(vector).all() and any(vector):
            usable[vec_id] = np.array(vector, dtype=np.float64)
    for i in sorted(usable):
        if i % every == 0:
            near = sorted((-float(usable[i] @ v), j) for j, v in usable.items() if j != i)[:count]
            yield from ((i, rank, j, round(-s, 9)) for rank, (s, j) in enumerate(near, 1))


VECTORS = [
    (0, [1, 0, 0, 0]), (1, [1, 0, 0, 0]), (2, [0.5, 0.5, 0, 0]), (3, None), (4, [0, 0, 0, 0]), (5, [1, None, 0, 0]), (20, [float("nan"), 1, 0, 0]),
    (40, [float("inf"), 0, 0, 0]), (60, [-1, 2, 0, 1]), (80, [1, 0, 0, 0]), (7, [3, 4]), (8, [9, 9, 9, 9]), (None, [1, 1, 1, 1]), (0, [1, 0, 0, 0]), (-20, [0, 0, 1, 0]), (9, [1e-30, 0, 0, 0]),
]


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "x") for i, v in rows], "vec_id bigint, embedding array<float>, label int, node string")


@pytest.mark.parametrize("count", [3, 20])
def test_edge_vectors(spark, count):
    got = ann.nearest(table(spark, VECTORS), Workspace(spark), count=count).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in got) == sorted([*by_hand(VECTORS, 20, count), *by_hand(VECTORS, 20, count, 2)])


def test_vectors_of_several_lengths(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-9, 9, size=2 + i % 3).tolist()) for i in range(150)] + [(1000, [1.0])]
    got = ann.nearest(table(spark, rows), Workspace(spark), every=5).collect()
    wanted = [x for length in (1, 2, 3, 4) for x in by_hand(rows, 5, 20, length)]
    assert sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in got) == sorted(wanted)


def test_a_vector_that_many_rows_share(spark):
    rows = [(i, [1, 0, 0, 0]) for i in range(400)] + [(1000 + i, [0.9, 0.1 + i / 1000, 0, 0]) for i in range(30)]
    got = ann.nearest(table(spark, rows), Workspace(spark)).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, round(r.score, 6)) for r in got) == sorted((*x[:3], round(float(np.float64(x[3])), 6)) for x in by_hand_float(rows))


def by_hand_float(rows):
    return by_hand([(i, [float(np.float32(x)) for x in v]) for i, v in rows], 20, 20)


def test_no_vectors(spark):
    assert ann.nearest(table(spark, VECTORS[:1]).where("false"), Workspace(spark)).collect() == []
    assert ann.nearest(table(spark, VECTORS[3:5]), Workspace(spark)).collect() == []


def test_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = sorted((r.vec_id, r.embedding) for r in df.collect())
    ids, points = np.array([i for i, _ in rows]), np.array([v for _, v in rows], dtype=np.float64)
    got = {}
    for r in ann.nearest(df, Workspace(spark)).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = total = 0
    for k in np.flatnonzero(ids % 20 == 0):
        scores = points @ points[k]
        scores[k] = -np.inf
        best = set(ids[np.argsort(-scores)[:20]].tolist())
        hits, total = hits + len(best & got[ids[k]]), total + 20
    assert hits / total >= 0.95


class Counted(Workspace):
    """Counts the tables that are written."""

    written = 0

    def folder(self, name):
        self.written += 1
        return super().folder(name)


def test_tables_do_not_grow_with_rounds_and_hops(spark):
    """Each round and each hop used to join and write tables of edges."""
    workspace = Counted(spark)
    found = ann.nearest(spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet"), workspace)
    assert found.count() == 25 * 20 and workspace.written <= 6


@pytest.mark.parametrize("kind", ["float", "double"])
def test_parts_and_slices(spark, monkeypatch, kind):
    monkeypatch.setattr(ann, "PART", 60)
    monkeypatch.setattr(ann, "SLICE", 7)
    monkeypatch.setattr(ann, "TASKS", 9 if kind == "double" else 2000)
    rng = np.random.default_rng(5)
    rows = [(i, np.float32(rng.normal(size=6) * 10.0 ** rng.integers(-3, 4)).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[i % 3][1]) for i in range(80)]  # copies: one node, many ids
    frame = spark.createDataFrame([(i, v) for i, v in rows], f"vec_id bigint, embedding array<{kind}>")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in ann.nearest(frame, Workspace(spark), every=10).collect())
    wanted = sorted(by_hand(rows, 10, 20, 6))
    assert [x[:3] for x in got] == [x[:3] for x in wanted]
    assert np.allclose([x[3] for x in got], [x[3] for x in wanted], rtol=1e-12, atol=1e-8)


def test_graph_and_walk_of_a_part():
    points = np.random.default_rng(8).normal(size=(7000, 24)).astype(np.float32)
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    graph = ann.descend(points)
    begin, to = ann.ways(graph)
    assert (graph.to >= 0).all() and (np.diff(begin) <= ann.DEGREE + ann.INCOMING).all()
    asked = np.arange(0, 7000, 70)
    beam = ann.walk(points, begin, to, points[asked], asked)
    edges = reached = 0
    for k, node in enumerate(asked):
        scores = points @ points[node]
        scores[node] = -np.inf
        order = np.argsort(-scores)
        edges += len(set(order[:ann.DEGREE].tolist()) & set(graph.to[node].tolist()))
        reached += len(set(order[:20].tolist()) & set(beam[k].tolist()))
        assert node in beam[k] and len(set(beam[k].tolist())) == ann.BEAM
    assert edges >= 0.9 * 100 * ann.DEGREE and reached >= 0.98 * 100 * 20
