"""Approximate nearest neighbours by NN-descent and greedy graph search.

The graph is over distinct vectors. It starts from blocks of neighbours in a
few random orders (sign bits of random directions, then a projection). A round
of NN-descent then brings the neighbours of each node together, those it names
and a sample of those that name it, and every two of them learn of each other
where that betters the worse of what either has: neighbours of neighbours, by
joins. Rounds go on until few edges change. A query walks the graph greedily:
it holds the nearest nodes seen, and each round opens the nearest unopened ones.

Vectors travel with the edges, at most ``degree + reverse`` to a node, as unit
vectors in half precision: they steer the descent and the walk. What a walk
ends with is measured again on the original vectors, in double precision.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import numbered, stored

DEGREE, REVERSE, ORDERS, BLOCK, ROUNDS, SETTLED = 32, 24, 6, 1024, 8, 0.06
BEAM, OPENED, STARTS, HOPS, BACK = 128, 32, 8, 16, 16
SIGNS = 32
EDGES = "u bigint, w bigint, sim double"


def fit_rows(vectors: DataFrame) -> DataFrame:
    """vec_id and v of the rows that take part: a vec_id, and a vector that is
    not null, empty or zero, only finite, of the commonest length (of equally
    common: the longest)."""
    kind = vectors.select("embedding").dtypes[0][1]
    kind = kind if kind == "array<float>" else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast(kind).alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & (F.abs(c) < F.lit(float("inf"))))
    rows = rows.where(F.col("vec_id").isNotNull() & (F.size("v") > 0) & finite & F.exists("v", lambda c: c != 0))
    # -0.0 and 0.0 are one number
    rows = rows.select("vec_id", F.transform("v", lambda c: F.when(c == 0, 0).otherwise(c)).cast(kind).alias("v"))
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"))
    top = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    return rows.where(F.size("v") == F.lit(top["d"] if top else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1) if len(column) else np.empty((0, 1))


def _units(m: np.ndarray) -> np.ndarray:
    """Rows at length 1; scaled first, so that squares neither overflow nor vanish."""
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt(np.einsum("ij,ij->i", m, m))[:, None]


def _half(column: pa.Array) -> pa.Array:
    """Unit vectors in half precision, as bytes."""
    return pa.array([r.tobytes() for r in _units(_matrix(column)).astype(np.float16)], pa.binary())


def _steering(column) -> np.ndarray:
    """Rows of a column of half-precision vectors."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]]
    return data.view(np.float16).reshape(len(column), -1).astype(np.float32)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with the row of ``b``."""
    a, b = (m / np.abs(m).max(axis=1, keepdims=True) for m in (a, b))
    dot, aa, bb = (np.einsum("ij,ij->i", x, y) for x, y in ((a, b), (a, a), (b, b)))
    return np.clip(dot / (np.sqrt(aa) * np.sqrt(bb)), -1.0, 1.0)


def _grouped(batches, key: str, most: int = 1 << 13):
    """Arrow tables of whole groups of ``key``, rows of a group in a sequence."""
    held: list = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < most:
            continue
        whole = pa.Table.from_batches(held).combine_chunks()
        keys = np.asarray(whole[key])
        cut = int(np.argmax(keys == keys[-1]))  # the last group may go on
        if cut:
            yield whole.slice(0, cut)
        held, rows = whole.slice(cut).to_batches(), len(keys) - cut
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def _starts(keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))


def _edges(u, w, sim, names=("u", "w", "sim")) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(w, pa.int64()), pa.array(sim, pa.float64())], names=list(names))


def _block_edges(batches, degree: int):
    """The nearest of each node among its block."""
    for table in _grouped(batches, "block"):
        block, node, m = np.asarray(table["block"]), np.asarray(table["node"]), _steering(table["h"])
        cuts = _starts(block)
        for s, e in zip(cuts, [*cuts[1:], len(block)], strict=True):
            if e - s > 1:
                sim = m[s:e] @ m[s:e].T
                np.fill_diagonal(sim, -np.inf)
                k = min(degree, e - s - 1)
                near = np.argpartition(-sim, k - 1, axis=1)[:, :k]
                yield _edges(np.repeat(node[s:e], k), node[s:e][near].ravel(), np.take_along_axis(sim, near, axis=1).ravel())


def _best(edges: DataFrame, degree: int) -> DataFrame:
    """The ``degree`` nearest distinct neighbours of each node; an edge found
    anew is fresh. Ranked before the exchange too, so a hub's offers shrink in
    the tasks that made them."""
    once = edges.groupBy("u", "w").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    rank = Window.partitionBy("u").orderBy(F.desc("sim"), "w")
    return once.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= degree)


def first_graph(nodes: DataFrame, degree: int, orders: int, block: int, d: int, seed: int) -> DataFrame:
    """Edges from blocks of ``block`` nodes that follow each other in each of
    ``orders`` random orders."""
    rng = np.random.default_rng(seed)
    found = None
    for k in range(orders):
        planes = rng.normal(size=(d, SIGNS + 1))

        def place(batches, planes=planes):
            for batch in batches:
                if batch.num_rows:
                    at = _steering(batch.column("h")) @ planes
                    code = (at[:, :SIGNS] > 0) @ (1 << np.arange(SIGNS)[::-1])
                    yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("h"), pa.array(code), pa.array(at[:, SIGNS])],
                                                     names=["node", "h", "code", "along"])

        placed = nodes.select("node", "h").mapInArrow(place, "node bigint, h binary, code bigint, along double")
        dealt = numbered(placed, ["code", "along", "node"], f"order-{k}").withColumn("block", F.floor(F.col("ordinal") / block))
        dealt = dealt.select("block", "node", "h").repartition("block").sortWithinPartitions("block")
        own = dealt.mapInArrow(lambda it: _block_edges(it, degree), EDGES)
        found = own if found is None else found.unionByName(own)
    return stored(_best(found.withColumn("fresh", F.lit(True)), degree), "graph")


def _introduced(batches):
    """Every two members of a group of which one is fresh, to each of the two
    for whom the other is nearer than the worst it has."""
    for table in _grouped(batches, "at"):
        at, node, floor = (np.asarray(table[c]) for c in ("at", "node", "floor"))
        fresh = np.asarray(table["fresh"].combine_chunks().cast(pa.int8())).astype(bool)
        m = _steering(table["h"])
        cuts = _starts(at)
        n = np.diff(np.append(cuts, len(at)))
        for size in np.unique(n[n > 1]).tolist():  # groups of one size together
            rows = cuts[n == size][:, None] + np.arange(size)
            for part in np.array_split(rows, max(1, rows.size * size // (1 << 18))):
                x, who, new = m[part], node[part], fresh[part]
                sim = x @ x.transpose(0, 2, 1)
                new = (new[:, :, None] | new[:, None, :]) & (who[:, :, None] != who[:, None, :])
                g, i, j = np.nonzero(new & (sim > floor[part][:, :, None]))
                if len(g):
                    yield _edges(who[g, i], who[g, j], sim[g, i, j])


def descended(graph: DataFrame, nodes: DataFrame, degree: int, reverse: int) -> tuple[DataFrame, int]:
    """One round: the graph after it, and how many edges are new."""
    # named and, by a hash that differs by node, a sample of the naming ones
    sample = Window.partitionBy("at").orderBy(F.xxhash64("at", "node"))
    naming = (graph.select(F.col("w").alias("at"), F.col("u").alias("node"), "fresh")
              .withColumn("rank", F.row_number().over(sample)).where(F.col("rank") <= reverse).drop("rank"))
    members = graph.select(F.col("u").alias("at"), F.col("w").alias("node"), "fresh").unionByName(naming)
    members = members.groupBy("at", "node").agg(F.max("fresh").alias("fresh"))
    worst = graph.groupBy("u").agg(F.count("*").alias("n"), F.min("sim").alias("least"))
    floor = F.when(F.col("n") < degree, F.lit(-2.0)).otherwise(F.col("least")).alias("floor")
    known = nodes.join(worst, nodes["node"] == worst["u"], "left").select("node", "h", F.coalesce(floor, F.lit(-2.0)).alias("floor"))
    groups = members.join(known, "node").select("at", "node", "fresh", "floor", "h")
    met = groups.repartition("at").sortWithinPartitions("at").mapInArrow(_introduced, EDGES)
    old = graph.select("u", "w", "sim", F.lit(False).alias("fresh"))
    now = stored(_best(old.unionByName(met.withColumn("fresh", F.lit(True))), degree), "graph")
    return now, now.where("fresh").count()


@dataclass
class Graph:
    """The index: ``nodes`` (node, v: distinct vectors, and h: those that
    steer) and ``edges`` (u, w, sim)."""

    nodes: DataFrame
    edges: DataFrame
    rounds: int


def build(nodes: DataFrame, degree: int = DEGREE, reverse: int = REVERSE, orders: int = ORDERS, block: int = BLOCK,
          rounds: int = ROUNDS, settled: float = SETTLED, seed: int = 11) -> Graph:
    """NN-descent over ``nodes`` (node, v) until less than ``settled`` of the
    edges are new, or for ``rounds`` rounds. One order alone would leave its
    blocks without a link between them."""
    if orders < 2:
        raise ValueError("blocks of at least two orders are linked")

    def steer(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("v"), _half(batch.column("v"))], schema=schema)

    schema = pa.schema([("node", pa.int64()), ("v", pa.list_(pa.float32() if "float" in dict(nodes.dtypes)["v"] else pa.float64())),
                        ("h", pa.binary())])
    nodes = stored(nodes.select("node", "v").mapInArrow(steer, f"node bigint, v {dict(nodes.dtypes)['v']}, h binary"), "steering")
    first = nodes.first()
    graph = first_graph(nodes, degree, orders, block, len(first["v"]) if first else 1, seed)
    total, k = graph.count(), 0
    for k in range(1, rounds + 1):
        graph, new = descended(graph, nodes, degree, reverse)
        if new <= settled * total:
            break
    return Graph(nodes, graph.select("u", "w", "sim"), k)


def _scored(pairs: DataFrame, queries: DataFrame, nodes: DataFrame, by: str = "h") -> DataFrame:
    """q, node and sim of the pairs (q, node), by the steering vectors or (v)
    exactly."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                a, b = batch.column("a"), batch.column("b")
                sim = cosines(_matrix(a), _matrix(b)) if by == "v" else np.einsum("ij,ij->i", _steering(a), _steering(b))
                yield _edges(np.asarray(batch.column("q")), np.asarray(batch.column("node")), sim, ("q", "node", "sim"))

    both = (pairs.join(nodes.select("node", F.col(by).alias("b")), "node")
            .join(queries.select("q", F.col(by).alias("a")), "q").select("q", "node", "a", "b"))
    return both.mapInArrow(run, "q bigint, node bigint, sim double")


def search(graph: Graph, queries: DataFrame, beam: int = BEAM, opened: int = OPENED, starts: int = STARTS, hops: int = HOPS) -> DataFrame:
    """(q, node, sim): the ``beam`` nearest nodes found for each query (q, v
    and h, and start: a node to begin at, or null). A walk also begins at
    ``starts`` nodes of the least hashes. It ends when its beam is all opened,
    or after ``hops`` rounds."""
    # also the nearest of those that name a node, so that nodes no other names are reached; a hub's links stay bounded
    naming = Window.partitionBy("w").orderBy(F.desc("sim"), "u")
    back = graph.edges.withColumn("rank", F.row_number().over(naming)).where(F.col("rank") <= BACK)
    links = stored(graph.edges.select("u", "w").union(back.select(F.col("w").alias("u"), F.col("u").alias("w"))).distinct(), "links")
    some = graph.nodes.select("node").orderBy(F.xxhash64("node"), "node").limit(starts)
    few = [r["node"] for r in some.collect()]
    begin = queries.select("q", F.explode(F.array_union(F.lit(few).cast("array<bigint>"), F.array("start"))).alias("node"))
    seen = stored(_scored(begin.where("node IS NOT NULL"), queries, graph.nodes).withColumn("open", F.lit(False)), "beam")
    order = Window.partitionBy("q").orderBy(F.desc("sim"), "node")
    for _ in range(hops):
        waiting = (seen.where("NOT open").withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= opened)
                   .select("q", "node"))
        # nodes that fell out of the beam are met again at most when a neighbour opens
        reached = waiting.join(links, F.col("node") == F.col("u")).select("q", F.col("w").alias("node")).distinct()
        reached = reached.join(seen.select("q", "node"), ["q", "node"], "left_anti")
        found = _scored(reached, queries, graph.nodes).withColumn("open", F.lit(False))
        held = seen.join(waiting.withColumn("now", F.lit(True)), ["q", "node"], "left").select(
            "q", "node", "sim", (F.col("open") | F.coalesce("now", F.lit(False))).alias("open"))
        seen = stored(held.unionByName(found).withColumn("at", F.row_number().over(order)).where(F.col("at") <= beam).drop("at"), "beam")
        if seen.where("NOT open").isEmpty():
            break
    return seen.select("q", "node", "sim")


def nearest(vectors: DataFrame, k: int = 5, every: int = 50, beam: int = BEAM, **options) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest rows found for
    each row whose vec_id is divisible by ``every``, the row itself apart:
    largest cosine first, ties to the smaller vec_id. ``options`` are those of
    ``build``. Equal vectors share a node.

    Rows without vec_id, and rows whose vector is null, empty, zero or not
    finite throughout, or of another length than the commonest, take no part.
    Rows repeated with one vec_id and vector are rows each: a query leaves out
    one of them, itself, and repeated queries are answered once. A vec_id with
    several vectors is answered for one of them. Equal vectors share score
    and order by vec_id. Fewer candidates than ``k``: all that were found. An
    empty table gives no rows. Other columns are not read.
    """
    rows = stored(fit_rows(vectors), "vectors")
    nodes = stored(rows.groupBy("v").agg(F.min("vec_id").alias("node"))
                   .withColumn("twin", F.row_number().over(Window.partitionBy("node").orderBy("v")))
                   # two vectors may have one least vec_id: the others get names below all vec_ids' own
                   .withColumn("node", F.when(F.col("twin") == 1, F.col("node")).otherwise(F.xxhash64("v", "node")))
                   .select("node", "v"), "nodes")
    graph = build(nodes, **options)
    named = nodes.select("node", F.col("v").alias("__v"))
    placed = rows.join(named, F.col("v") == F.col("__v")).select("vec_id", "node")
    # the k + 1 least vec_ids of a node hold all that any query can take of it
    least = Window.partitionBy("node").orderBy("vec_id")
    members = stored(placed.withColumn("nth", F.row_number().over(least)).where(F.col("nth") <= k + 1).drop("nth"), "members")
    asked = placed.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("node").alias("start"))
    queries = stored(asked.join(graph.nodes, F.col("start") == F.col("node")).select(F.col("vec_id").alias("q"), "v", "h", "start"), "queries")
    best = Window.partitionBy("q").orderBy(F.desc("sim"), "node")
    # exact nearness of the first few, with room for what half precision misplaces
    few = search(graph, queries, beam=beam).withColumn("at", F.row_number().over(best)).where(F.col("at") <= 4 * (k + 1))
    found = _scored(few.select("q", "node"), queries, graph.nodes, by="v")
    own = queries.select(F.col("q").alias("__q"), "start")
    hits = found.join(members, "node").join(own, F.col("q") == F.col("__q"))
    # of the query's own node one row with its vec_id is the query itself
    self_ = (F.col("vec_id") == F.col("q")) & (F.col("node") == F.col("start"))
    hits = hits.withColumn("copy", F.when(self_, F.row_number().over(Window.partitionBy("q", "node", "vec_id").orderBy("sim"))))
    hits = hits.where(F.col("copy").isNull() | (F.col("copy") > 1))
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("sim"), "vec_id"))
    return (hits.withColumn("rank", rank).where(F.col("rank") <= k)
            .select(F.col("q").alias("query_id"), "rank", "vec_id", F.col("sim").alias("score")))


def op13_nearest(spark, sf_dir: str) -> DataFrame:
    """The five nearest of every fiftieth vector among all embeddings."""
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
