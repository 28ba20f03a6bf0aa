"""A navigable small-world graph over the unit vectors of one shard, in array operations.

Many queries are searched side by side: each step expands the best open candidate of
every query at once. Vectors are inserted in batches the same way; vectors of a batch
see each other by direct comparison.
"""

from __future__ import annotations

import io

import numpy as np

from gradeflow.llm.common import ranges

LINKS = 16
BREADTH = 48
BATCH = 512


def normalised(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


class Layer:
    """Neighbour lists of the nodes of one level; ``rows`` maps a node to its list."""

    def __init__(self, n: int, width: int) -> None:
        self.rows = np.full(n, -1, dtype=np.int64)
        self.lists = np.full((0, width), -1, dtype=np.int64)
        self.width = width

    def add(self, nodes: np.ndarray) -> None:
        self.rows[nodes] = len(self.lists) + np.arange(len(nodes))
        self.lists = np.vstack([self.lists, np.full((len(nodes), self.width), -1, dtype=np.int64)])

    def of(self, nodes: np.ndarray) -> np.ndarray:
        return self.lists[self.rows[nodes]]


def diverse(vectors: np.ndarray, queries: np.ndarray, ids: np.ndarray, keep: int) -> np.ndarray:
    """Of each row of candidates (nearest first, -1 for none), those nearer to the query
    than to any candidate chosen before; filled up with the nearest others."""
    valid = ids >= 0
    found = vectors[np.maximum(ids, 0)]
    near = np.where(valid, (found @ queries[:, :, None])[:, :, 0], -np.inf)
    order = np.argsort(-near, axis=1, kind="stable")
    ids, near = np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)
    repeat = np.zeros_like(valid)
    found = vectors[np.maximum(ids, 0)]
    between = found @ found.transpose(0, 2, 1)
    chosen = np.zeros(ids.shape, dtype=bool)
    blocked = np.full(ids.shape, -np.inf)  # likeness to the nearest one chosen
    for c in range(ids.shape[1]):
        seen = ((ids[:, :c] == ids[:, c : c + 1]) & (ids[:, :c] >= 0)).any(axis=1)
        repeat[:, c] = seen
        take = (ids[:, c] >= 0) & ~seen & (near[:, c] > blocked[:, c]) & (chosen.sum(axis=1) < keep)
        chosen[:, c] = take
        blocked = np.where(take[:, None], np.maximum(blocked, between[:, c, :]), blocked)
    rank = np.where(chosen, 0, np.where((ids >= 0) & ~repeat, 1, 2)) * ids.shape[1] + np.arange(ids.shape[1])
    best = np.argsort(rank, axis=1, kind="stable")[:, :keep]
    out = np.take_along_axis(np.where((ids >= 0) & ~repeat, ids, -1), best, 1)
    if out.shape[1] < keep:
        out = np.hstack([out, np.full((len(out), keep - out.shape[1]), -1, dtype=np.int64)])
    return out


class Graph:
    def __init__(self, vectors: np.ndarray, seed: int = 7) -> None:
        """``vectors``: unit vectors, single precision."""
        self.vectors = np.ascontiguousarray(vectors, dtype=np.float32)
        n = len(vectors)
        rng = np.random.default_rng(seed)
        levels = np.minimum((-np.log(rng.random(n)) / np.log(LINKS)).astype(int), 8)
        self.layers: list[Layer] = []
        self.entry = -1
        at = 0
        while at < n:
            nodes = np.arange(at, min(n, at + max(16, min(BATCH, at))))
            self.insert(nodes, levels[nodes])
            at = int(nodes[-1]) + 1
        self.connect()

    def saved(self, **more: np.ndarray) -> bytes:
        """The graph without its vectors, and ``more`` arrays."""
        layers = {f"{part}{k}": getattr(layer, part).astype(np.int32) for k, layer in enumerate(self.layers) for part in ("rows", "lists")}
        out = io.BytesIO()
        np.savez(out, entry=self.entry, targets=self.targets.astype(np.int32), bounds=self.bounds, **layers, **more)
        return out.getvalue()

    @classmethod
    def loaded(cls, vectors: np.ndarray, saved: dict[str, np.ndarray]) -> Graph:
        graph = cls.__new__(cls)
        graph.vectors = np.ascontiguousarray(vectors, dtype=np.float32)
        graph.entry, graph.targets, graph.bounds = int(saved["entry"]), saved["targets"], saved["bounds"]
        graph.layers = []
        while (rows := saved.get(f"rows{len(graph.layers)}")) is not None:
            lists = saved[f"lists{len(graph.layers)}"].astype(np.int64)
            layer = Layer(0, lists.shape[1])
            layer.rows, layer.lists = rows.astype(np.int64), lists
            graph.layers.append(layer)
        return graph

    def connect(self) -> None:
        """Both ends of every link of the lowest layer, also those pruned on one side."""
        lists = self.layers[0].of(np.arange(len(self.vectors)))
        a, column = np.nonzero(lists >= 0)
        b = lists[a, column]
        source, target = np.concatenate([a, b]), np.concatenate([b, a])
        order = np.argsort(source, kind="stable")
        self.targets = target[order]
        self.bounds = np.searchsorted(source[order], np.arange(len(self.vectors) + 1))

    def insert(self, nodes: np.ndarray, levels: np.ndarray) -> None:
        queries = self.vectors[nodes]
        start = np.full((len(nodes), 1), self.entry, dtype=np.int64)
        top = int(levels.max())
        fresh = [Layer(len(self.vectors), LINKS if k else 2 * LINKS) for k in range(len(self.layers), top + 1)]
        old = len(self.layers)
        self.layers += fresh
        among = queries @ queries.T
        np.fill_diagonal(among, -np.inf)
        for level in range(len(self.layers) - 1, -1, -1):
            own = levels >= level
            layer = self.layers[level]
            seen = start
            if self.entry >= 0 and level < old:
                seen, _ = self.beam(queries, start, level, BREADTH if own.any() else 1)
                start = seen[:, :8]
            if own.any():
                mates = np.where(own[None, :], among[own], -np.inf)
                width = min(2 * LINKS, mates.shape[1])
                nearest = np.argpartition(-mates, width - 1, axis=1)[:, :width]
                other = np.where(np.take_along_axis(mates, nearest, 1) > -np.inf, nodes[nearest], -1)
                past = seen[own] if self.entry >= 0 and level < old else np.full((int(own.sum()), 1), -1, dtype=np.int64)
                links = diverse(self.vectors, queries[own], np.hstack([past, other]), LINKS)
                layer.add(nodes[own])
                layer.lists[layer.rows[nodes[own]], :LINKS] = links
                self.backlinks(layer, np.repeat(nodes[own], LINKS), links.ravel())
        if top >= old or self.entry < 0:
            self.entry = int(nodes[np.argmax(levels)])

    def backlinks(self, layer: Layer, source: np.ndarray, target: np.ndarray) -> None:
        """Add the sources to the lists of their targets, and prune lists that overflow."""
        real = target >= 0
        source, target = source[real], target[real]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        nodes, first, n = np.unique(target, return_index=True, return_counts=True)
        for at in range(0, len(nodes), 256):
            own, width = nodes[at : at + 256], int(n[at : at + 256].max())
            column = np.arange(width)
            index = np.minimum(first[at : at + 256, None] + column, len(source) - 1)
            new = np.where(column < n[at : at + 256, None], source[index], -1)
            if width > 4 * layer.width:  # a hub of this batch: its nearest new neighbours
                near = np.where(new >= 0, (self.vectors[np.maximum(new, 0)] @ self.vectors[own][:, :, None])[:, :, 0], -np.inf)
                best = np.argpartition(-near, 4 * layer.width, axis=1)[:, : 4 * layer.width]
                new = np.take_along_axis(new, best, 1)
            layer.lists[layer.rows[own]] = diverse(self.vectors, self.vectors[own], np.hstack([layer.of(own), new]), layer.width)

    def beam(self, queries: np.ndarray, start: np.ndarray, level: int, breadth: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest ``breadth`` nodes found for each query, nearest first, and their likeness."""
        layer, rows = self.layers[level], np.arange(len(queries))
        seen = np.zeros((len(queries), len(self.vectors)), dtype=bool)
        ids = np.full((len(queries), breadth), -1, dtype=np.int64)
        near = np.full((len(queries), breadth), -np.inf, dtype=np.float32)
        done = np.ones((len(queries), breadth), dtype=bool)
        new = start
        live = rows
        while len(live):
            ok = new >= 0
            ok &= ~seen[live[:, None], np.maximum(new, 0)]
            new = np.where(ok, new, -1)
            a, b = np.nonzero(ok)
            seen[live[a], new[a, b]] = True
            like = np.full(new.shape, -np.inf, dtype=np.float32)
            like[a, b] = np.einsum("nd,nd->n", queries[live[a]], self.vectors[new[a, b]])
            all_ids = np.hstack([ids[live], new])
            all_near = np.hstack([near[live], like])
            all_done = np.hstack([done[live], ~ok])
            best = np.argpartition(-all_near, breadth - 1, axis=1)[:, :breadth]
            ids[live], near[live] = np.take_along_axis(all_ids, best, 1), np.take_along_axis(all_near, best, 1)
            done[live] = np.take_along_axis(all_done, best, 1)
            open_near = np.where(done[live], -np.inf, near[live])
            pick = np.argmax(open_near, axis=1)
            going = open_near[np.arange(len(live)), pick] > -np.inf
            live, pick = live[going], pick[going]
            done[live, pick] = True
            new = layer.of(ids[live, pick])
        order = np.argsort(-near, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)

    def search(self, queries: np.ndarray, breadth: int) -> tuple[np.ndarray, np.ndarray]:
        start = np.full((len(queries), 1), self.entry, dtype=np.int64)
        for level in range(len(self.layers) - 1, 0, -1):
            start = self.beam(queries, start, level, 4)[0]
        return self.beam(queries, start, 0, breadth)

    def within(self, query: np.ndarray, start: np.ndarray, least: float) -> np.ndarray:
        """All nodes of likeness ``least`` or more that lead to each other from the start."""
        seen = np.zeros(len(self.vectors), dtype=bool)
        front = start[start >= 0]
        seen[front] = True
        found = []
        while len(front):
            front = front[self.vectors[front] @ query >= least]
            found.append(front)
            links = np.unique(self.targets[ranges(self.bounds[front], self.bounds[front + 1])])
            front = links[~seen[links]]
            seen[front] = True
        return np.concatenate(found) if found else np.empty(0, dtype=np.int64)
