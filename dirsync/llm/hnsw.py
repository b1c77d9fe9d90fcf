"""Near-duplicate vectors by hierarchical navigable small-world graphs, one per shard.

Equal vectors are one member.  Each two shards meet once: a shard's task lets its own
members and those of half of the others stream by as queries.  An upper bound of the
cosine, from a few directions of each vector and the length of what is left of it,
leaves out queries and members that cannot have a link; no link is lost by that.  The
task builds a graph of the members that are left, asks it for the queries that are
left, and verifies what it finds by the cosine in double precision.  A query whose
beam is full of links is asked again with a wider one; and if an audit of some
queries against the whole graph misses links, all are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dirsync.operators.lookups import lookup
from dirsync.session import materialise

from .components import components

THRESHOLD = 0.95
#: Shards at least, and vectors of a shard at most, on average.
SHARDS, SHARD_VECTORS = 12, 20_000
#: Links of a node, width of the beam while building and at first in a search.
LINKS, BUILD_BEAM, BEAM = 12, 40, 48
#: Queries that go through a graph together, and those of them that are audited.
TOGETHER, AUDITED, MIN_RECALL = 192, 6, 0.99
#: Directions that bound a cosine, pairs that are bounded at once, bytes of queries that wait for a graph.
DIRECTIONS, BOUNDED, HELD = 24, 8_000_000, 32_000_000


class Graph:
    """A navigable graph over unit vectors (rows of ``v``, single precision)."""

    def __init__(self, v: np.ndarray, seed: int = 0):
        self.v, self.n = v, len(v)
        rng = np.random.default_rng(seed)
        self.level = np.minimum((-np.log(1 - rng.random(self.n)) / np.log(LINKS)).astype(int), 12)
        top = int(self.level.max()) if self.n else 0
        self.width = [2 * LINKS] + [LINKS] * top
        # half as much room again, so that a node is thinned out now and then, not at each new link
        self.links = [np.full((self.n, w + w // 2), -1, np.int32) for w in self.width]
        self.degree = [np.zeros(self.n, np.int32) for _ in self.width]
        self.entry, done = 0, 1
        while done < self.n:
            upto = min(self.n, 2 * done, done + TOGETHER)
            self._insert(np.arange(done, upto))
            done = upto

    def _choose(self, near: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """Neighbours in different directions: nearer to the node than to one already chosen; then the nearest."""
        order = np.argsort(-sims, kind="stable")
        near, sims = near[order], sims[order]
        if len(near) <= most:
            return near
        between = self.v[near] @ self.v[near].T
        chosen: list[int] = []
        best = np.full(len(near), -np.inf, np.float32)
        for i in range(len(near)):
            if best[i] < sims[i]:
                chosen.append(i)
                np.maximum(best, between[i], out=best)
                if len(chosen) == most:
                    break
        if len(chosen) < most:
            rest = np.setdiff1d(np.arange(len(near)), chosen)
            chosen += rest[: most - len(chosen)].tolist()
        return near[chosen]

    def _link(self, layer: int, a: int, b: int) -> None:
        links, degree = self.links[layer], self.degree[layer]
        if degree[a] == links.shape[1]:
            near = np.append(links[a], b)
            kept = self._choose(near, self.v[near] @ self.v[a], self.width[layer])
            links[a] = -1
            links[a, : len(kept)] = kept
            degree[a] = len(kept)
        else:
            links[a, degree[a]] = b
            degree[a] += 1

    def _insert(self, new: np.ndarray) -> None:
        q = self.v[new]
        among = q @ q.T
        np.fill_diagonal(among, -np.inf)
        at = np.full(len(new), self.entry)
        for layer in range(int(self.level[self.entry]), -1, -1):
            joins = self.level[new] >= layer
            ids = np.full((len(new), BUILD_BEAM), -1)
            if joins.any():
                ids[joins] = self._beam(q[joins], at[joins], BUILD_BEAM, layer)[0]
            if (~joins).any():
                ids[~joins, :1] = self._beam(q[~joins], at[~joins], 1, layer)[0]
            at = ids[:, 0]
            self._connect(new, joins, ids, among, layer)
        for layer in range(int(self.level[self.entry]) + 1, int(self.level[new].max()) + 1):
            self._connect(new, self.level[new] >= layer, np.full((len(new), 1), -1), among, layer)
        highest = new[int(np.argmax(self.level[new]))]
        if self.level[highest] > self.level[self.entry]:
            self.entry = int(highest)

    def _connect(self, new, joins, ids, among, layer) -> None:
        own = np.flatnonzero(joins)
        for i in own:
            near = ids[i][ids[i] >= 0]
            fellows = own[np.argsort(-among[i, own])[:LINKS]]
            near = np.concatenate([near, new[fellows[fellows != i]]])
            for b in self._choose(near, self.v[near] @ self.v[new[i]], LINKS).tolist():
                a = int(new[i])
                if b not in self.links[layer][a]:
                    self._link(layer, a, b)
                if a not in self.links[layer][b]:
                    self._link(layer, b, a)

    def _beam(self, q: np.ndarray, entry: np.ndarray, width: int, layer: int) -> tuple[np.ndarray, np.ndarray]:
        """The best ``width`` nodes that each query reaches, best first, -1 where there are fewer; all queries step together."""
        rows, links = len(q), self.links[layer]
        seen = np.zeros((rows, self.n), bool)
        ids = np.full((rows, width), -1)
        sims = np.full((rows, width), -np.inf, np.float32)
        open_ = np.zeros((rows, width), bool)
        ids[:, 0], open_[:, 0] = entry, True
        sims[:, 0] = np.einsum("ij,ij->i", q, self.v[entry])
        seen[np.arange(rows), entry] = True
        step = min(4, width)
        while True:
            live = np.flatnonzero(open_.any(axis=1))
            if not len(live):
                break
            ranked = np.where(open_[live], sims[live], -np.inf)
            pick = np.argpartition(-ranked, step - 1, axis=1)[:, :step] if step < width else np.tile(np.arange(width), (len(live), 1))
            picked = np.where(np.take_along_axis(open_[live], pick, 1), np.take_along_axis(ids[live], pick, 1), -1)
            open_[live[:, None], pick] = False
            near = np.where(picked[:, :, None] >= 0, links[picked], -1).reshape(len(live), -1)
            row, col = np.nonzero(near >= 0)
            flat = np.unique(row * self.n + near[row, col])
            row, node = flat // self.n, flat % self.n
            new = ~seen[live[row], node]
            row, node = row[new], node[new]
            seen[live[row], node] = True
            if not len(row):
                continue
            count = np.bincount(row, minlength=len(live))
            place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            more = int(count.max())
            new_ids = np.full((len(live), more), -1)
            new_sims = np.full((len(live), more), -np.inf, np.float32)
            new_ids[row, place] = node
            new_sims[row, place] = np.einsum("ij,ij->i", q[live[row]], self.v[node])
            all_ids = np.concatenate([ids[live], new_ids], axis=1)
            all_sims = np.concatenate([sims[live], new_sims], axis=1)
            all_open = np.concatenate([open_[live], new_ids >= 0], axis=1)
            best = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
            ids[live], sims[live] = np.take_along_axis(all_ids, best, 1), np.take_along_axis(all_sims, best, 1)
            open_[live] = np.take_along_axis(all_open, best, 1)
        order = np.argsort(-sims, axis=1)
        return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)

    def search(self, q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        at = np.full(len(q), self.entry)
        for layer in range(int(self.level[self.entry]), 0, -1):
            at = self._beam(q, at, 1, layer)[0][:, 0]
        return self._beam(q, at, min(width, self.n), 0)

    def links_of(self, q: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) of all that are found at ``least`` or more, after widening and audit."""
        audited = np.linspace(0, len(q) - 1, min(AUDITED, len(q))).astype(int)
        truth = self.v @ q[audited].T >= least
        width = min(BEAM, self.n)
        while True:
            query, node = self._links(q, width, least)
            found = np.isin(query, audited).sum()
            if width >= self.n or found >= MIN_RECALL * truth.sum():
                return query, node
            width = min(self.n, 2 * width)

    def _links(self, q, width, least):
        out, rows = [], np.arange(len(q))
        while len(rows):
            ids, sims = self.search(q[rows], width)
            full = (sims[:, -1] >= least) & (width < self.n)
            done = np.flatnonzero(~full)
            i, j = np.nonzero(sims[done] >= least)
            out.append((rows[done[i]], ids[done[i], j]))
            rows, width = rows[full], min(self.n, 4 * width)
        return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node with the smallest one it reaches by the links (a, b), where that is another."""
    nodes, back = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = back[: len(a)], back[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        after = label.copy()
        np.minimum.at(after, x, low)
        np.minimum.at(after, y, low)
        after = after[after]
        if (after == label).all():
            break
        label = after
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


class Bound:
    """Upper bounds of the cosines with unit vectors (rows of ``v``): of some directions exact, the rest as if it were parallel."""

    def __init__(self, v: np.ndarray):
        # the main directions, by the smaller of the two matrices
        few = len(v) < v.shape[1]
        axes = np.linalg.svd(v, full_matrices=False)[2].T if few else np.linalg.eigh(v.T @ v)[1][:, ::-1]
        self.axes = axes[:, :DIRECTIONS]
        self.v = self.cut(v)

    def cut(self, unit: np.ndarray) -> np.ndarray:
        part = unit @ self.axes
        rest = np.sqrt(np.maximum(0, 1 - np.einsum("ij,ij->i", part, part)))
        return np.concatenate([part, rest[:, None]], axis=1).astype(np.float32)

    def possible(self, unit: np.ndarray, own: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Which queries and which rows may have a link with each other; ``own`` has the row that is the query itself, or -1."""
        asked, nodes = np.zeros(len(unit), bool), np.zeros(len(self.v), bool)
        cut = self.cut(unit)
        step = max(1, BOUNDED // max(1, len(self.v)))
        for i in range(0, len(unit), step):
            most = cut[i : i + step] @ self.v.T
            itself = np.flatnonzero(own[i : i + step] >= 0)
            most[itself, own[i : i + step][itself]] = -1
            rows = np.flatnonzero(most.max(axis=1) >= least)
            asked[i + rows] = True
            for row in rows.tolist():
                nodes |= most[row] >= least
        return asked, nodes


class _Shard:
    """The members of a shard (rows of ``v``) with their ids and times, and the queries that wait for its graph."""

    def __init__(self, ids: np.ndarray, times: np.ndarray, v: np.ndarray):
        self.ids, self.times = ids, times
        self.exact = v / np.linalg.norm(v, axis=1, keepdims=True)
        self.order = np.argsort(ids)
        self.bound = Bound(self.exact)
        self.nodes, self.graph = np.zeros(len(ids), bool), None
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def ask(self, ids: np.ndarray, times: np.ndarray, v: np.ndarray) -> bool:
        """Take queries; true if those that wait should be answered."""
        unit = v / np.linalg.norm(v, axis=1, keepdims=True)
        at = self.order[np.minimum(np.searchsorted(self.ids, ids, sorter=self.order), len(self.ids) - 1)]
        own = np.where(self.ids[at] == ids, at, -1)
        asked, nodes = self.bound.possible(unit, own, THRESHOLD - 1e-4)
        if (nodes & ~self.nodes).any():
            self.nodes, self.graph = self.nodes | nodes, None
        if asked.any():
            self.held.append((ids[asked], times[asked], unit[asked]))
        return sum(x.nbytes for _, _, x in self.held) > HELD

    def answers(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(ids of the queries, their times, query, row) of links, of the queries that wait."""
        if not self.held:
            return
        ids, times, unit = (np.concatenate(c) for c in zip(*self.held, strict=True))
        self.held, kept = [], np.flatnonzero(self.nodes)
        if self.graph is None:
            self.graph = Graph(self.exact[kept].astype(np.float32))
        for i in range(0, len(ids), TOGETHER):
            own, asked = ids[i : i + TOGETHER], unit[i : i + TOGETHER]
            q, node = self.graph.links_of(asked.astype(np.float32), THRESHOLD - 1e-5)
            node = kept[node]
            good = np.concatenate([np.einsum("ij,ij->i", asked[q[k : k + 50_000]], self.exact[node[k : k + 50_000]]) for k in range(0, len(q), 50_000)] or [np.zeros(0)])
            good = (good >= THRESHOLD) & (own[q] != self.ids[node])
            yield own, times[i : i + TOGETHER], q[good], node[good]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (shard, query, node, times, vector), members before queries: links of each node, and links that span.

    Members have 0 as query, queries that are members 1, and those of other shards 2;
    of the links of the latter, both ends have their number here.  The vectors of a
    shard have one length; a batch may have shards of several.
    """
    none = pa.nulls

    def rows_of(ids, n, a, b) -> pa.RecordBatch:
        x, y = len(ids), len(a)
        columns = [pa.concat_arrays([pa.array(ids, pa.int64()), none(y, pa.int64())]), pa.concat_arrays([pa.array(n, pa.int64()), none(y, pa.int64())])]
        columns += [pa.concat_arrays([none(x, pa.int64()), pa.array(c, pa.int64())]) for c in (a, b)]
        return pa.RecordBatch.from_arrays(columns, names=["node", "n_links", "a", "b"])

    def answers(held: _Shard | None, foreign: bool) -> Iterator[pa.RecordBatch]:
        for ids, times, q, node in held.answers() if held else ():
            n = np.bincount(q, held.times[node], len(ids)).astype(np.int64)
            both, numbers = ids, n
            if foreign:
                rows, at = np.unique(node, return_inverse=True)
                both, numbers = np.append(ids, held.ids[rows]), np.append(n, np.bincount(at, times[q], len(rows)).astype(np.int64))
            yield rows_of(both, numbers, *_spanning(ids[q], held.ids[node]))

    now, held, members = None, None, []
    for batch in batches:
        shards, query = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        ids, times = batch.column(2).to_numpy(), batch.column(3).to_numpy()
        vectors, at = batch.column(4), 0
        while at < batch.num_rows:
            if (shards[at], query[at]) != now:
                if now and now[1]:
                    yield from answers(held, now[1] == 2)
                if not now or shards[at] != now[0]:
                    held, members = None, []
                now = shards[at], query[at]
            upto = at + int(np.argmax(np.append((shards[at:] != shards[at]) | (query[at:] != query[at]), True)))
            own_vectors = vectors.slice(at, upto - at).flatten().to_numpy().astype(np.float64).reshape(upto - at, -1)
            if not query[at]:
                members.append((ids[at:upto], times[at:upto], own_vectors))
            else:
                if members:
                    held, members = _Shard(*(np.concatenate(c) for c in zip(*members, strict=True))), []
                if held and held.ask(ids[at:upto], times[at:upto], own_vectors):
                    yield from answers(held, query[at] == 2)
            at = upto
    if now and now[1]:
        yield from answers(held, now[1] == 2)


def near_duplicates(vectors: DataFrame, shards: int | None = None, id_col="vec_id", vector_col="embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``vectors``.

    Vectors link at a cosine of ``THRESHOLD`` or more in double precision.  Null
    vectors, zero vectors, vectors with a null or non-finite part, and rows without
    id link with nothing; so do vectors of different lengths with each other, of
    which there may be any number.  A repeated row counts as another vector with
    the same id, and rows of one id with different vectors link each for itself.
    An empty table gives no rows; other columns are not read.  Of links, a task
    gives each query's number and at most one row a node, so a dense group does not
    multiply.  Without ``shards`` there are as many as SHARD_VECTORS asks for.
    """
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(F.col("vec_id").isNotNull() & finite & F.exists("v", lambda x: x != 0.0), F.lit(False))
    # a written copy with one form of zero, so that equal vectors have equal bytes
    rows = materialise(rows.withColumn("v", F.when(usable, F.transform("v", lambda x: x + 0.0))), "vectors")
    members = rows.where("v IS NOT NULL").groupBy("v").agg(F.min("vec_id").alias("id"), F.count("*").alias("times"))
    node = F.monotonically_increasing_id().alias("node")
    members = materialise(members.select(node, "id", "times", "v", F.size("v").cast("bigint").alias("length")), "vector-classes")
    shards = shards or max(SHARDS, -(-members.count() // SHARD_VECTORS))

    # the shards of each length are numbered apart
    place = lambda shard: (F.col("length") * shards + shard).alias("shard")
    members_at = members.withColumn("home", F.pmod(F.xxhash64("node"), F.lit(shards)))
    index = members_at.select(place(F.col("home")), F.lit(0).alias("query"), "node", "times", "v")
    # a shard and the half behind it, in a ring; of the two of an even ring that face each other one asks
    asked = members_at.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(shards // 2))))
    asked = asked.where((2 * F.col("s") != shards) | (2 * F.col("home") < shards))
    query = F.when(F.col("s") == 0, 1).otherwise(2).alias("query")
    asked = asked.select(place((F.col("home") + F.col("s")) % shards), query, "node", "times", "v")
    dealt = index.unionByName(asked).repartitionByRange(shards, "shard").sortWithinPartitions("shard", "query")
    found = materialise(dealt.mapInArrow(_compare, "node bigint, n_links bigint, a bigint, b bigint"), "vector-links")

    linked = found.where("node IS NOT NULL").groupBy("node").agg(F.sum("n_links").alias("n"))
    groups = components(found.where("a IS NOT NULL").select("a", "b"))
    classes = members.join(linked, "node", "left").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = classes.groupBy("component").agg(F.min("id").alias("component_id"))
    classes = lookup(classes, smallest.withColumnRenamed("component", "__c"), F.col("component").cast("string"), "__c", pos="component")
    others = F.coalesce("n", F.lit(0)) + F.col("times") - 1
    classes = classes.select("v", others.alias("n_links"), "component_id")
    result = rows.join(classes, "v", "left")
    component = F.coalesce("component_id", "vec_id")
    kept = F.coalesce(F.col("vec_id") == component, F.lit(False))
    return result.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), kept.alias("kept"))
