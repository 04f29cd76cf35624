"""Nearest neighbours by inner product: NN-descent builds a graph, queries walk it greedily.

Equal vectors are one node, so repeats neither crowd the graph nor hide each other.  Nodes are
dealt to parts of bounded size, and a task holds a part's vectors as one array.  A part's graph
starts from blocks of vectors that hash planes and a projection put side by side.  In each round
every node brings together its neighbours and the nodes that have it as a neighbour; among these
neighbours of neighbours better edges are found and merged.  Every query walks every part, and
the best of all parts are its answers, so a task's memory does not grow with the table and no
node is left out.  A walk keeps the best ``BEAM`` nodes of each query and follows the edges of
those not yet followed, some queries at once, until no query finds anything better.  Building and
walking work in single precision; a beam is ranked, and all scores are reported, from the
original vectors in double precision.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from strandweave.tables import Workspace

DEGREE = 32
REVERSE = 24
BLOCK = 2048
TREES = 6
ROUNDS = 7
SETTLED = 0.02
BEAM = 256
FOLLOWED = 48
INCOMING = 64
ENTRIES = 1024
LOCKSTEP = 32
# Nodes of a part and bytes of its vectors, at most; up to PARTS parts of SMALL nodes, so that tasks share small tables too.
PART = 65_536
PART_BYTES = 64 * 1024 * 1024
PARTS = 12
SMALL = 8192
# Queries that meet a part in one task.
SLICE = 131_072
# Tasks, at most; very many lengths share them.
TASKS = 2000
# Components gathered, and edges found, before they are worked off.
GATHERED = 2 ** 22
FOUND = 1_000_000


def usable(vector: str) -> Column:
    """Not null, not zero, every component a finite number."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))


def _vectors(column: pa.ChunkedArray, n: int) -> np.ndarray:
    """A row per vector, in single precision only if they were stored so."""
    values = pa.concat_arrays([chunk.flatten() for chunk in column.chunks]).to_numpy(zero_copy_only=False)
    return (values if values.dtype == np.float32 else values.astype(np.float64)).reshape(n, -1)


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """In single precision, divided by a power of two that no component exceeds."""
    return np.ldexp(vectors.astype(np.float64), -int(np.frexp(np.abs(vectors).max(initial=0))[1])).astype(np.float32)


def _largest(scores: np.ndarray, most: int) -> np.ndarray:
    """Of each row the places of its ``most`` largest, in no order."""
    return np.argpartition(scores, scores.shape[1] - most, axis=1)[:, scores.shape[1] - most:]


def _ranked(nodes: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """A number per edge that sorts by node, best scores first."""
    bits = (scores.astype(np.float32) + np.float32(0)).view(np.int32).astype(np.int64)
    return (nodes.astype(np.int64) << 32) + 2 ** 31 - np.where(bits < 0, -(bits & 0x7FFFFFFF), bits)


class Graph:
    """``degree`` neighbours of each node: to whom, score, and whether the edge is fresh; -1 stands for none."""

    def __init__(self, n: int, degree: int):
        self.to, self.scores = np.full((n, degree), -1, dtype=np.int32), np.full((n, degree), -np.inf, dtype=np.float32)
        self.fresh = np.zeros((n, degree), dtype=bool)

    def add(self, nodes: np.ndarray, to: np.ndarray, scores: np.ndarray) -> None:
        """A row of further edges for each of the nodes, none twice; the best stay, and an edge that is there stays as it is."""
        degree = self.to.shape[1]
        for at in range(0, len(nodes), BLOCK):
            some = nodes[at:at + BLOCK]
            known = (to[at:at + BLOCK, :, None] == self.to[some][:, None, :]).any(axis=2)
            all_to = np.concatenate((self.to[some], to[at:at + BLOCK]), axis=1)
            all_scores = np.concatenate((self.scores[some], np.where(known, -np.inf, scores[at:at + BLOCK])), axis=1)
            fresh = np.concatenate((self.fresh[some], ~known), axis=1)
            best = _largest(all_scores, degree)
            all_to, all_scores, fresh = (np.take_along_axis(x, best, axis=1) for x in (all_to, all_scores, fresh))
            all_to[all_scores == -np.inf] = -1
            self.to[some], self.scores[some], self.fresh[some] = all_to, all_scores, fresh

    def merge(self, u: np.ndarray, v: np.ndarray, scores: np.ndarray) -> None:
        """Further edges, in any order and perhaps more than once."""
        n, degree = self.to.shape
        key = u.astype(np.int64) * n + v
        order = np.argsort(key)
        key = key[order]
        order = order[np.append(True, key[1:] != key[:-1])]
        order = order[np.argsort(_ranked(u[order], scores[order]))]
        u, v, scores = u[order], v[order], scores[order]
        changes = np.append(True, u[1:] != u[:-1])
        begin, slot = np.flatnonzero(changes), np.cumsum(changes) - 1
        rank = np.arange(len(u)) - begin[slot]
        few = rank < degree
        to = np.full((len(begin), int(rank[few].max()) + 1), -1, dtype=np.int32)
        best = np.full(to.shape, -np.inf, dtype=np.float32)
        to[slot[few], rank[few]], best[slot[few], rank[few]] = v[few], scores[few]
        self.add(u[begin], to, best)


def _start(points: np.ndarray, graph: Graph, draw: np.random.Generator) -> None:
    """Best edges inside blocks of points that signs to random planes, then a projection, put side by side."""
    n, dimension = points.shape
    degree, bits = graph.to.shape[1], max(0, int(np.ceil(np.log2(n / BLOCK))))
    for _ in range(TREES if n > BLOCK else 1):
        sides = points @ draw.normal(size=(dimension, bits + 1)).astype(np.float32)
        order = np.lexsort((sides[:, bits], (sides[:, :bits] > 0) @ (1 << np.arange(bits))))
        for at in range(0, n, BLOCK):
            begin = max(0, min(at, n - BLOCK))  # a last short block reaches back
            nodes = order[begin:begin + BLOCK]
            scores = points[nodes[at - begin:]] @ points[nodes].T
            np.fill_diagonal(scores[:, at - begin:], -np.inf)
            best = _largest(scores, degree)
            graph.add(nodes[at - begin:], nodes[best].astype(np.int32), np.take_along_axis(scores, best, axis=1))


def _met(graph: Graph, draw: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """What each node brings together, and which of these edges are fresh: its neighbours and up to REVERSE nodes that have it as one."""
    n = len(graph.to)
    u, place = np.nonzero(graph.to >= 0)
    v, fresh = graph.to[u, place].astype(np.int64), graph.fresh[u, place]
    order = np.argsort((v << 33) | ((~fresh).astype(np.int64) << 32) | draw.integers(0, 2 ** 32, len(v)))  # fresh ones first
    u, v, fresh = u[order], v[order], fresh[order]
    rank = np.arange(len(v)) - np.searchsorted(v, np.arange(n))[v]
    few = rank < REVERSE
    back, back_fresh = np.full((n, REVERSE), -1, dtype=np.int32), np.zeros((n, REVERSE), dtype=bool)
    back[v[few], rank[few]], back_fresh[v[few], rank[few]] = u[few], fresh[few]
    return np.concatenate((graph.to, back), axis=1), np.concatenate((graph.fresh, back_fresh), axis=1)


def _round(points: np.ndarray, graph: Graph, draw: np.random.Generator) -> None:
    """Better edges between the nodes that a centre brings together, where one of the two edges to them is fresh."""
    members, fresh = _met(graph, draw)
    fresh &= members >= 0
    graph.fresh[:] = False
    centres, width, found = np.flatnonzero(fresh.any(axis=1)), members.shape[1], []
    step = max(1, GATHERED // (width * points.shape[1]))
    for at in range(0, len(centres), step):
        m, f = members[centres[at:at + step]], fresh[centres[at:at + step]]
        met = points.take(m, axis=0)
        scores = met @ met.transpose(0, 2, 1)
        least = np.where(m >= 0, graph.scores.min(axis=1)[m], np.inf)
        better = scores > least[:, :, None]
        better &= f[:, :, None] | f[:, None, :]
        better &= (m >= 0)[:, None, :]
        place = np.flatnonzero(better)
        centre, pair = np.divmod(place, width * width)
        u, v = m[centre, pair // width], m[centre, pair % width]
        two = u != v
        found.append((u[two], v[two], scores.ravel()[place[two]]))
        if sum(len(x[0]) for x in found) >= FOUND or at + step >= len(centres):
            edges = [np.concatenate(x) for x in zip(*found)]
            found = []
            if len(edges[0]):
                graph.merge(*edges)


def descend(points: np.ndarray) -> Graph:
    """The neighbours NN-descent finds for every point."""
    n, draw = len(points), np.random.default_rng(11)
    graph = Graph(n, min(DEGREE, n - 1))
    if n > 1:
        _start(points, graph, draw)
        for _ in range(ROUNDS):
            _round(points, graph, draw)
            if graph.fresh.sum() <= SETTLED * graph.fresh.size:
                break
    return graph


def ways(graph: Graph) -> tuple[np.ndarray, np.ndarray]:
    """Edges a walk may follow: all that leave a node, and the best that come in, so no node has very many.

    Where each node's edges begin, and to whom they lead.
    """
    n = len(graph.to)
    u, place = np.nonzero(graph.to >= 0)
    v = graph.to[u, place].astype(np.int64)
    order = np.argsort(_ranked(v, graph.scores[u, place]), kind="stable")
    come, away = v[order], u[order]
    few = np.arange(len(come)) - np.searchsorted(come, np.arange(n))[come] < INCOMING
    key = np.sort(np.concatenate((u * n + v, come[few] * n + away[few])))
    node, to = np.divmod(key[np.append(True, key[1:] != key[:-1])[:len(key)]], n)
    return np.searchsorted(node, np.arange(n + 1)).astype(np.int64), to.astype(np.int32)


def walk(points: np.ndarray, begin: np.ndarray, to: np.ndarray, wanted: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The beam of each query as nodes, -1 where it is not full; ``own``: the query's own node or -1."""
    n, asked = len(points), len(wanted)
    width, lengths = min(BEAM, n), np.diff(begin)
    # A walk enters at the best of some nodes, and at the query's own.
    entries = np.sort(np.random.default_rng(3).permutation(n)[:ENTRIES])
    first = min(width, len(entries))
    scores = wanted @ points[entries].T
    best = _largest(scores, first)
    nodes, held = np.full((asked, width), -1, dtype=np.int32), np.full((asked, width), -np.inf, dtype=np.float32)
    nodes[:, :first], held[:, :first] = entries[best], np.take_along_axis(scores, best, axis=1)
    for query in np.flatnonzero((own >= 0) & ~(nodes == own[:, None]).any(axis=1)).tolist():
        last = int(np.argmin(held[query]))
        nodes[query, last], held[query, last] = own[query], points[own[query]] @ wanted[query]
    done, seen = np.zeros((asked, width), dtype=bool), np.zeros(asked * n, dtype=bool)
    query, place = np.nonzero(nodes >= 0)
    seen[query * n + nodes[query, place]] = True
    # The last place of a beam only rises, so a node that left it stays out and the walk ends.
    while True:
        waiting = np.where(done | (nodes < 0), -np.inf, held)
        most = min(FOLLOWED, width)
        chosen = _largest(waiting, most)
        query, which = np.nonzero(np.take_along_axis(waiting, chosen, axis=1) > -np.inf)
        if not len(query):
            return nodes
        place = chosen[query, which]
        done[query, place] = True
        followed = nodes[query, place]
        many = lengths[followed]
        ends = np.cumsum(many)
        key = to.take(np.repeat(begin[followed] - ends + many, many) + np.arange(ends[-1])) + np.repeat(query * n, many)
        key = np.sort(key[~seen.take(key)].astype(np.int32))
        key = key[np.append(True, key[1:] != key[:-1])[:len(key)]]
        seen[key] = True
        cuts, least, reached = np.searchsorted(key, np.arange(asked + 1) * n), held.min(axis=1), []
        for at in range(asked):
            node = key[cuts[at]:cuts[at + 1]] - at * n
            score = points.take(node, axis=0) @ wanted[at]
            enters = np.flatnonzero(score > least[at])
            reached.append((node[enters], score[enters]))
        wide = width + max(len(node) for node, _ in reached)
        all_nodes, all_held, all_done = np.full((asked, wide), -1, dtype=np.int32), np.full((asked, wide), -np.inf, dtype=np.float32), np.zeros((asked, wide), dtype=bool)
        all_nodes[:, :width], all_held[:, :width], all_done[:, :width] = nodes, held, done
        for at, (node, score) in enumerate(reached):
            all_nodes[at, width:width + len(node)], all_held[at, width:width + len(node)] = node, score
        best = _largest(all_held, width)
        nodes, held, done = (np.take_along_axis(x, best, axis=1) for x in (all_nodes, all_held, all_done))


def inner_products(vectors: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """(queries, nodes, components) by (queries, components) in double precision, component by component."""
    total = np.zeros(vectors.shape[:2])
    for vector, want in zip(np.ascontiguousarray(vectors.transpose(2, 0, 1)), wanted.T):
        total += vector.astype(np.float64) * want.astype(np.float64)[:, None]
    return total


GRAPH = "group bigint, nodes binary, vectors binary, single boolean, begin binary, to binary, id_counts binary, ids binary"
ANSWER = "query bigint, vec_id bigint, score double"


def _built(table: pa.Table) -> pa.Table:
    """The nodes of a part to its graph, in one row."""
    vectors = _vectors(table["vector"], len(table))
    begin, to = ways(descend(_scaled(vectors)))
    ids = pa.concat_arrays([chunk.flatten() for chunk in table["ids"].chunks]).to_numpy()
    counts = np.concatenate([np.diff(chunk.offsets.to_numpy()) for chunk in table["ids"].chunks]).astype(np.int32)
    nodes = table["node"].to_numpy().astype(np.int64)
    return pa.table({
        "group": table["group"][:1], "nodes": [nodes.tobytes()], "vectors": [vectors.tobytes()], "single": [vectors.dtype == np.float32],
        "begin": [begin.tobytes()], "to": [to.tobytes()], "id_counts": [counts.tobytes()], "ids": [ids.astype(np.int64).tobytes()]})


def _answered(count: int):
    """A part's graph and queries to each query's ``count`` best rows of the part."""

    def run(graph: pa.Table, queries: pa.Table) -> pa.Table:
        parts: list[tuple[np.ndarray, ...]] = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0))]
        if len(graph) and len(queries):
            row = {name: graph[name][0].as_py() for name in graph.column_names}
            nodes, begin, to = (np.frombuffer(row[name], kind) for name, kind in (("nodes", np.int64), ("begin", np.int64), ("to", np.int32)))
            vectors = np.frombuffer(row["vectors"], np.float32 if row["single"] else np.float64).reshape(len(nodes), -1)
            counts, ids = np.frombuffer(row["id_counts"], np.int32).astype(np.int64), np.frombuffer(row["ids"], np.int64)
            ends, points = np.cumsum(counts), _scaled(vectors)
            wanted, asked = _vectors(queries["vector"], len(queries)), queries["query"].to_numpy()
            by_node = np.argsort(nodes)
            own = by_node[np.minimum(np.searchsorted(nodes, asked, sorter=by_node), len(nodes) - 1)]
            own = np.where(nodes[own] == asked, own, -1)
            for at in range(0, len(asked), LOCKSTEP):
                some = slice(at, at + LOCKSTEP)
                beam = walk(points, begin, to, np.stack([_scaled(x) for x in wanted[some]]), own[some])
                scores = np.where(beam >= 0, inner_products(vectors[beam], wanted[some]), -np.inf)
                least = np.partition(scores, -count, axis=1)[:, -count] if scores.shape[1] > count else np.full(len(scores), -np.inf)
                query, place = np.nonzero((scores >= least[:, None]) & (beam >= 0))
                node, score = beam[query, place], scores[query, place]
                many = counts[node]
                offset = np.repeat(ends[node] - np.cumsum(many), many) + np.arange(many.sum())
                query, score, vec_id = np.repeat(query, many), np.repeat(score, many), ids[offset]
                order = np.lexsort((vec_id, -score, query))
                query, score, vec_id = query[order], score[order], vec_id[order]
                few = np.arange(len(query)) - np.searchsorted(query, query) < count
                parts.append((asked[some][query[few]], vec_id[few], score[few]))
        query, vec_id, score = (np.concatenate(x) for x in zip(*parts))
        return pa.table({"query": query, "vec_id": vec_id, "score": score})

    return run


def _nodes(rows: DataFrame, workspace: Workspace, keep: int) -> DataFrame:
    """Distinct vectors as nodes with their first ``keep`` ids; sorted by a hash, which is faster than by vectors alone."""
    first = Window.partitionBy("code", "vector").orderBy("vec_id")
    few = rows.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= keep)
    classes = few.groupBy("code", "vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    return workspace.write(classes.select(F.monotonically_increasing_id().alias("node"), "code", "vector", "ids"), "nodes")


def _dealt(spark: SparkSession, count: int) -> list[int]:
    """Numbers that Spark deals to as many different ones of ``count`` partitions."""
    tried = spark.range(count * 64).select("id", F.pmod(F.hash("id"), F.lit(count)).alias("at"))
    taken = [row.id for row in tried.groupBy("at").agg(F.min("id").alias("id")).collect()]
    return taken + list(range(count * 64, count * 65 - len(taken)))


def _parts(nodes: int, dimension: int) -> int:
    """Parts of bounded size; a small table has some as well, for as many tasks."""
    bounded = max(-(-nodes // PART), -(-nodes * dimension * 8 // PART_BYTES))
    return max(bounded, min(PARTS, -(-nodes // SMALL)), 1)


def nearest(embeddings: DataFrame, workspace: Workspace, every: int = 20, count: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: of each row whose id ``every`` divides, its ``count`` nearest rows.

    Vectors that are null, zero, or hold a null or a component that is not finite take no part,
    nor do rows without an id.  Vectors are compared with those of their own length.  A row that
    repeats entirely counts once.  Ties go to the smaller id.  An empty table gives no rows.
    """
    spark = embeddings.sparkSession
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable("vector")).distinct().withColumn("code", F.xxhash64("vector"))
    rows = workspace.write(rows, "vectors")
    # Per vector one more than is asked for: the asking row itself may be among them.
    nodes = _nodes(rows, workspace, count + 1)
    asking = rows.where(F.col("vec_id") % every == 0).join(nodes.select("node", "code", "vector"), ["code", "vector"])
    asking = workspace.save(asking.select(F.col("vec_id").alias("query_id"), F.col("node").alias("query"), "vector"), "asking")
    lengths = nodes.groupBy(F.size("vector").alias("dimension")).count().collect()
    slices = max(1, -(-asking.rows // SLICE))
    parts = {row.dimension: _parts(row["count"], row.dimension) for row in lengths}
    wanted = slices * sum(parts.values())
    tasks = max(1, min(TASKS, wanted))
    keys = iter(_dealt(spark, tasks) if wanted <= TASKS else range(wanted))
    # Of each length the groups: a part and a slice of the queries; a part is built under its first group.
    groups = spark.createDataFrame(
        [(dimension, number, [[next(keys) for _ in range(slices)] for _ in range(number)]) for dimension, number in parts.items()],
        "dimension int, parts int, keys array<array<bigint>>")
    groups = F.broadcast(groups)  # a row per length
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    placed = nodes.join(groups, F.size("vector") == F.col("dimension")).select(F.get(F.get("keys", part), F.lit(0)).alias("group"), "node", "vector", "ids")
    built = workspace.write(placed.repartition(tasks, "group").groupBy("group").applyInArrow(_built, GRAPH), "graphs")
    named = groups.select(F.explode("keys").alias("of")).select(F.get("of", F.lit(0)).alias("group"), F.explode("of").alias("key"))
    sent = built.join(F.broadcast(named), "group").withColumn("group", F.col("key")).drop("key")
    queries = asking.df.select("query", "vector").dropDuplicates(["query"]).join(groups, F.size("vector") == F.col("dimension"))
    queries = queries.withColumn("of", F.explode("keys")).select(F.get("of", F.pmod(F.xxhash64("query"), F.lit(slices)).cast("int")).alias("group"), "query", "vector")
    met = [table.repartition(tasks, "group").groupBy("group") for table in (sent, queries)]
    found = met[0].cogroup(met[1]).applyInArrow(_answered(count + 1), ANSWER)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    found = workspace.write(found, "found")
    answers = workspace.write(found.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= count + 1).drop("_n"), "answers")
    both = asking.df.select("query_id", "query").join(answers, "query").where(F.col("vec_id") != F.col("query_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).alias("rank")
    return both.select("query_id", rank, "vec_id", "score").where(F.col("rank") <= count)
