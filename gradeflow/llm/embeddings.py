"""Near-duplicate embeddings: small-world graphs per shard, every shard queried.

Vectors are compared within their label (and length). Equal vectors are one class from
the start, so copies, however many, are one point of a graph. The classes of a label are
dealt over shards of bounded size; each shard gets a hierarchical navigable small-world
graph, built once and stored, and is queried by every class of the label, the classes of
a few shards at a time. A query follows its beam to the nearest nodes and then every node
within reach of the threshold. In each task an audit compares queries with brute force,
drawing more until LINKED of them have links to others; if too few of these found all
their links, or too many links are missing, the beams are widened and the block is searched
again, until the audit passes or the beam is the whole shard. Links are verified by cosine in double
precision and never listed: a task returns each query's number of links and a spanning
forest of what it found.

Vectors that are null, zero, of another length than their peers, or hold null or
non-finite components link with nothing, nor do vectors without label or vec_id. Rows
that repeat a vector are other vectors. Vectors that share a vec_id count their links apart
and belong to one component, as do rows of that vec_id that link with nothing themselves.
Other columns are dropped.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, StructField, StructType

from gradeflow.llm.annindex import BREADTH, Graph
from gradeflow.llm.common import components, stored

LEAST = 0.98
#: Vectors of a shard, and their components altogether (16 MB in double precision).
SHARD_ROWS = 32_768
SHARD_VALUES = 1 << 21
#: Shards whose classes query a graph in one task.
GATHER = 4
#: Queries of an audit's draw, how many with links are wanted, and when to stop looking for them.
AUDIT = 200
LINKED = 100
AUDIT_MOST = 2_000
#: Shares of the audit's linked queries that find all their links, and of these links found.
WHOLE = 0.99
RECALL = 0.999
MARGIN = 0.005
BLOCK = 256

FOUND = "rep long, kind long, links long, other long"


def usable() -> Column:
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.expr("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL") & finite & F.exists("vector", lambda x: x != 0)


def unit(rows: pa.ChunkedArray) -> np.ndarray:
    """Unit vectors in double precision."""
    flat = rows.combine_chunks()
    wide = flat.flatten().to_numpy().astype(np.float64).reshape(len(flat), -1)
    wide = wide / np.abs(wide).max(axis=1, keepdims=True)  # no square over- or underflows
    return wide / np.linalg.norm(wide, axis=1, keepdims=True)


def linked(graph: Graph, vectors: np.ndarray, queries: np.ndarray, own: np.ndarray, least: float, breadth: int, margin: float) -> list[np.ndarray]:
    """For each query, the nodes of cosine ``least`` or more that were found."""
    out = []
    for at in range(0, len(queries), BLOCK):
        part = queries[at : at + BLOCK].astype(np.float32)
        seeds, _ = graph.search(part, min(breadth, len(vectors)))
        for i, start in enumerate(seeds):
            near = graph.within(part[i], np.unique(np.append(start, own[at + i])), least - margin)
            out.append(near[vectors[near] @ queries[at + i] >= least])
    return out


def audit(vectors: np.ndarray, queries: np.ndarray, own: np.ndarray, least: float) -> dict[int, np.ndarray]:
    """Queries drawn in any order that have links to others, and all these links."""
    drawn = np.random.default_rng(11).permutation(len(queries))[:AUDIT_MOST]
    linked_to: dict[int, np.ndarray] = {}
    for at in range(0, len(drawn), AUDIT):
        part = drawn[at : at + AUDIT]
        near = vectors @ queries[part].T >= least
        for column, i in enumerate(part.tolist()):
            others = np.flatnonzero(near[:, column])
            others = others[others != own[i]]
            if len(others):
                linked_to[i] = others
        if len(linked_to) >= LINKED:
            break
    return linked_to


def recall(found: list[np.ndarray], truth: dict[int, np.ndarray]) -> tuple[float, float]:
    """Share of the audited queries that found all their links, and of the links found."""
    met = [(np.isin(t, found[i]).sum(), len(t)) for i, t in truth.items()]
    if not met:
        return 1.0, 1.0
    return sum(a == b for a, b in met) / len(met), sum(a for a, _ in met) / sum(b for _, b in met)


def audited(vectors: np.ndarray, queries: np.ndarray, own: np.ndarray, least: float, graph: Graph | None = None) -> list[np.ndarray]:
    """``linked`` with beams wide enough for the audit."""
    graph, breadth, margin = graph or Graph(vectors), BREADTH, MARGIN
    truth = audit(vectors, queries, own, least)
    while True:
        found = linked(graph, vectors, queries, own, least, breadth, margin)
        whole, links = recall(found, truth)
        if whole >= WHOLE and links >= RECALL:
            return found
        if breadth >= len(vectors):
            return [np.flatnonzero(vectors @ q >= least) for q in queries]
        breadth, margin = 4 * breadth, 2 * margin


def forest(pairs: list[tuple[int, np.ndarray]]) -> list[tuple[int, int]]:
    """Edges that connect what the pairs connect."""
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    edges = []
    for a, others in pairs:
        for b in others.tolist():
            x, y = top(a), top(b)
            if x != y:
                root[max(x, y)] = min(x, y)
                edges.append((a, b))
    return edges


def build(group: pa.Table) -> pa.Table:
    """The graph of one shard with its classes, as one row."""
    vectors = unit(group["vector"])
    classes = {x: group[x].to_numpy() for x in ("rep", "n", "kind")}
    saved = Graph(vectors).saved(exact=vectors, **classes)
    return group.select(["label", "dim", "shard", "shards"]).slice(0, 1).append_column("graph", pa.array([saved], pa.binary()))


def compare(least: float):
    """Search one shard with some blocks of queries."""

    def of(graphs: pa.Table, group: pa.Table) -> pa.Table:
        with np.load(io.BytesIO(graphs["graph"][0].as_py())) as stored_arrays:
            saved = dict(stored_arrays)
        vectors, queries = saved["exact"], unit(group["vector"])
        rep, kind = group["rep"].to_numpy(), group["kind"].to_numpy()
        order = np.argsort(saved["kind"])
        place = order[np.minimum(np.searchsorted(saved["kind"], kind, sorter=order), len(order) - 1)]
        own = np.where(saved["kind"][place] == kind, place, -1)
        found = audited(vectors, queries, own, least, Graph.loaded(vectors, saved))
        links = [int(saved["n"][x[x != o]].sum()) for x, o in zip(found, own, strict=True)]
        edges = forest([(int(r), saved["rep"][x]) for r, x in zip(rep, found, strict=True)])
        return pa.table(
            {
                "rep": pa.array([*rep.tolist(), *(a for a, _ in edges)], pa.int64()),
                "kind": pa.array([*kind.tolist(), *[None] * len(edges)], pa.int64()),
                "links": pa.array([*links, *[0] * len(edges)], pa.int64()),
                "other": pa.array([*[None] * len(links), *(b for _, b in edges)], pa.int64()),
            }
        )

    return of


def near_duplicates(vectors: DataFrame, least: float = LEAST, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``vectors`` (vec_id, embedding, label)."""
    rows = stored(
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").alias("vector"))
        .withColumn("ok", F.coalesce(usable(), F.lit(False)))
        .withColumn("key", F.when(F.col("ok"), F.sha2(F.to_json(F.struct("label", "vector")), 256))),
        "vectors",
    )
    classes = stored(
        rows.where("ok")
        .groupBy("key")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("vector").alias("vector"))
        .withColumn("kind", F.xxhash64("key")),
        "vector-classes",
    )
    classes = classes.withColumn("dim", F.size("vector"))
    room = F.greatest(F.lit(1), F.least(F.lit(shard_rows), F.floor(F.lit(SHARD_VALUES) / F.col("dim"))))
    kinds = classes.groupBy("label", "dim").agg(F.ceil(F.count("*") / F.first(room)).cast("int").alias("shards"))
    dealt = classes.join(kinds, ["label", "dim"]).withColumn("shard", F.pmod(F.xxhash64("key"), F.col("shards")).cast("int"))
    numbers = [StructField(x, IntegerType()) for x in ("dim", "shard", "shards")]
    built = StructType([classes.schema["label"], *numbers, StructField("graph", BinaryType())])
    graphs = stored(
        dealt.select("label", "dim", "shard", "shards", "rep", "n", "kind", "vector")
        .groupBy("label", "dim", "shard")
        .applyInArrow(build, built),
        "graphs",
    )
    part = ["label", "dim", "shard", "block"]
    blocks = F.explode(F.expr(f"sequence(0, CAST((shards - 1) div {GATHER} AS int))"))
    shards = F.explode(F.sequence(F.lit(0), F.col("shards") - 1))
    asked = graphs.select("label", "dim", "shard", blocks.alias("block"), "graph")
    queries = dealt.select("label", "dim", shards.alias("shard"), F.expr(f"CAST(shard div {GATHER} AS int)").alias("block"), "rep", "kind", "vector")
    found = stored(asked.groupBy(*part).cogroup(queries.groupBy(*part)).applyInArrow(compare(least), FOUND), "links")
    several = rows.groupBy("vec_id").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low < high").select("vec_id")
    clashing = rows.where("ok").join(several, "vec_id").select("vec_id", "key").distinct().join(classes.select("key", "rep"), "key")
    edges = found.where("other IS NOT NULL").select(F.col("rep").alias("a"), F.col("other").alias("b"))
    linked_to = components(edges.unionByName(clashing.select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))))
    degree = found.where("other IS NULL").groupBy("kind").agg(F.sum("links").alias("links"))
    named = stored(
        classes.select("key", "kind", "rep", "n")
        .join(degree, "kind")
        .join(linked_to, F.col("rep") == F.col("node"), "left")
        .select("key", (F.col("links") + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")),
        "vector-components",
    )
    both = rows.join(named, "key", "left")
    others = rows.where("NOT ok").select("vec_id").distinct()
    namesakes = rows.where("ok").join(others, "vec_id", "left_semi").join(named, "key").groupBy("vec_id").agg(F.min("component_id").alias("shared"))
    both = both.join(namesakes, "vec_id", "left")
    component = F.coalesce("component_id", "shared", "vec_id")
    return both.select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept")
    )
