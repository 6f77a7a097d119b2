"""Nearest vectors by inner product: a small-world graph per shard, shard results merged.

Rows are dealt evenly over shards. The task of a shard builds a hierarchical navigable
small-world graph over its distinct vectors, kept as flat neighbour arrays, one per layer, and
then answers the queries, which follow the shard's rows in blocks; every shard gets every query
and returns its nearest rows, and the nearest of all shards are kept. Largest inner product
becomes nearest neighbour by one more component, which gives all stored vectors of a shard the
same length; queries have 0 there. Scores come from the original vectors in double precision.

All nodes of a batch walk the graph in step, so each step is a few array operations. A step
opens several nodes of each beam and compares only neighbours not seen before; reverse links
sort out a node's list only when it is full. Both keep the work on a row small as shards fill.

Edge cases: rows whose vector is NULL, empty, zero or holds a NULL or non-finite component take
no part, nor do rows without ``vec_id``, which nothing could name. Copies of a vector share a
node and are all found, by ascending id. Repeated rows count once; of different vectors under
one id the better score counts, and the id's own rows are never its neighbours. Vectors of
another length than a query's are no candidates for it. Empty tables give no rows. Other
columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from candlemill.llm.vectors import matrices, pieces

NEAREST = 20
QUERY_EVERY = 20
#: Rows and components of a shard at most on average, and shards at least.
SHARD_ROWS = 65_536
SHARD_VALUES = 1 << 23
SHARDS = 8
#: Neighbours per node on upper layers (twice as many on the lowest), beam widths.
LINKS = 16
BEAM_BUILD = 64
BEAM_SEARCH = 96
#: Nodes of a beam opened in one step of a walk, and pairs compared at once.
OPENED = 8
PAIRS = 1024
#: Nodes or queries that walk together, and nodes whose first links come from all others.
BATCH = 512
SEED_NODES = 1024

FOUND = "query_id long, vec_id long, score double"


def _top(ids, sims, count):
    """The ``count`` best of each row, best first; absent ones (-1) last."""
    if ids.shape[1] > count:
        part = np.argpartition(-sims, count - 1, axis=1)[:, :count]
        ids, sims = np.take_along_axis(ids, part, 1), np.take_along_axis(sims, part, 1)
    order = np.argsort(-sims, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)


def _first(values):
    """Where a value of a sorted array differs from the one before."""
    fresh = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=fresh[1:])
    return fresh


class Graph:
    """Layers over unit-length-like ``points``; node numbers are places in ``points``.

    Nodes are ordered by layer: layer ``l`` holds the first ``sizes[l]`` of them, and its
    neighbours are one flat array of that many rows.
    """

    def __init__(self, points, links=LINKS, beam=BEAM_BUILD):
        self.points, self.links, self.beam = points, links, beam
        self.sizes = [len(points)]
        while self.sizes[-1] > 4 * links:
            self.sizes.append(max(1, self.sizes[-1] // links))
        self.layers = [
            np.full((size, links * (1 if level else 2)), -1, np.int32) for level, size in enumerate(self.sizes)
        ]
        for level in reversed(range(len(self.sizes))):
            self._fill(level)

    def _sims(self, rows, ids):
        """Similarity of each row's vector to its listed nodes; -inf for absent ones."""
        sims = np.matmul(self.points[ids], rows[:, :, None])[:, :, 0]
        sims[ids < 0] = -np.inf
        return sims

    def _pair_sims(self, rows, row, ids):
        """Similarity of ``rows[row]`` to ``points[ids]``, in parts that stay in the cache."""
        sims = np.empty(len(row), np.result_type(rows, self.points))
        for i in range(0, len(row), PAIRS):
            part = slice(i, i + PAIRS)
            np.einsum("ij,ij->i", rows.take(row[part], 0), self.points.take(ids[part], 0), out=sims[part])
        return sims

    def _spread(self, ids, sims, count):
        """At most ``count`` of the candidates, sorted best first, that point apart.

        A candidate nearer to a chosen one than to the node itself is left for last.
        """
        between = self.points[ids]
        between = np.matmul(between, between.transpose(0, 2, 1))
        free = ids >= 0
        chosen, taken = np.zeros_like(free), np.zeros(len(ids), np.int64)
        for j in range(ids.shape[1]):
            take = free[:, j] & (taken < count)
            chosen[:, j] = take
            taken += take
            free &= ~(take[:, None] & (between[:, j] > sims))
        rank = np.where(chosen, 0, np.where(ids >= 0, 1, 2)) * ids.shape[1] + np.arange(ids.shape[1])
        order = np.argsort(rank, axis=1)[:, :count]
        return np.take_along_axis(ids, order, 1)

    def _walk(self, rows, level, entries, width, reach):
        """The ``width`` best nodes among the first ``reach`` found from ``entries``."""
        layer, count = self.layers[level], len(rows)
        at = np.arange(count)[:, None]
        entries = np.sort(entries, axis=1)
        entries[:, 1:][entries[:, 1:] == entries[:, :-1]] = -1
        seen = np.zeros((count, reach + 1), bool)
        seen[:, reach] = True  # where absent neighbours (-1) point
        seen[at, entries] = True
        seen[:, reach] = True
        ids, sims = _top(entries, self._sims(rows, entries), width)
        if ids.shape[1] < width:
            more = width - ids.shape[1]
            ids = np.pad(ids, ((0, 0), (0, more)), constant_values=-1)
            sims = np.pad(sims, ((0, 0), (0, more)), constant_values=-np.inf)
        done = ids < 0
        active, flat_seen = np.arange(count), seen.reshape(-1)
        kind = np.int32 if seen.size < 1 << 31 else np.int64
        while True:
            some = ~done[active]
            some &= np.cumsum(some, axis=1, dtype=np.int32) <= OPENED
            row, col = np.nonzero(some)
            if not len(row):
                break
            row, active = active[row], active[some.any(axis=1)]
            done[row, col] = True
            # An absent neighbour (-1) falls on the last place of the row before.
            near = ((row * (reach + 1)).astype(kind)[:, None] + layer[ids[row, col]]).ravel()
            near = np.sort(near[~flat_seen[near]])
            near = near[_first(near)]
            flat_seen[near] = True
            row, near = np.divmod(near, reach + 1)
            near_sims = self._pair_sims(rows, row, near)
            # Only what beats the worst of a beam can enter it.
            enters = near_sims > sims[row, -1]
            if not enters.any():
                continue
            row, near, near_sims = row[enters], near[enters], near_sims[enters]
            fresh = _first(row)
            to, begins = row[fresh], np.flatnonzero(fresh)
            at = np.cumsum(fresh) - 1
            place = width + np.arange(len(row)) - begins[at]
            shape = len(to), int(place.max()) + 1
            all_ids, all_sims = np.full(shape, -1, np.int64), np.full(shape, -np.inf, sims.dtype)
            all_done = np.ones(shape, bool)
            all_ids[:, :width], all_sims[:, :width], all_done[:, :width] = ids[to], sims[to], done[to]
            all_ids[at, place], all_sims[at, place], all_done[at, place] = near, near_sims, False
            best = np.argsort(-all_sims, axis=1)[:, :width]
            ids[to] = np.take_along_axis(all_ids, best, 1)
            sims[to] = np.take_along_axis(all_sims, best, 1)
            done[to] = np.take_along_axis(all_done, best, 1)
        return np.where(np.isneginf(sims), -1, ids), sims

    def _descend(self, rows, level):
        """Entries for ``level``: the best nodes found on the layers above."""
        entries = np.zeros((len(rows), 1), np.int64)
        for above in range(len(self.sizes) - 1, level, -1):
            found, _ = self._walk(rows, above, entries, self.links // 2, self.sizes[above])
            entries = np.where(found < 0, found[:, :1], found)
        return entries

    def _fill(self, level):
        size = self.sizes[level]
        seeds = min(size, SEED_NODES)
        for start in range(0, size, BATCH):
            stop = min(size, start + BATCH)
            own = np.arange(start, stop)
            rows = self.points[start:stop]
            # Those of the batch, and of the first nodes all before them, are compared at once.
            low = 0 if start < seeds else start
            sims = rows @ self.points[low:stop].T
            sims[own[:, None] <= np.arange(low, stop)] = -np.inf
            ids = np.broadcast_to(np.arange(low, stop), sims.shape)
            ids, sims = _top(ids, sims, self.beam)
            if low:
                found, found_sims = self._walk(rows, level, self._starts(rows, own, level), self.beam, start)
                ids, sims = _top(np.concatenate([ids, found], 1), np.concatenate([sims, found_sims], 1), self.beam)
            ids = np.where(np.isneginf(sims), -1, ids)
            chosen = self._spread(ids, sims, self.links)
            self.layers[level][start:stop, : chosen.shape[1]] = chosen
            self._link_back(level, own, chosen)

    def _starts(self, rows, own, level):
        entries = self._descend(rows, level)
        # Nodes of upper layers are in this layer from the start, so all entries are.
        return np.minimum(entries, own[0] - 1)

    def _link_back(self, level, own, chosen):
        """Adds the reverse links; a full node keeps those that point apart."""
        layer = self.layers[level]
        room = layer.shape[1]
        to, back = chosen.ravel(), np.repeat(own, chosen.shape[1])
        back, to = back[to >= 0], to[to >= 0]
        order = np.argsort(to, kind="stable")
        to, back = to[order], back[order]
        place = np.arange(len(to)) - np.searchsorted(to, to)
        # Links fill a list from its start; a node with room for all of them just takes them.
        held = (layer[to] >= 0).sum(axis=1)
        fits = held + np.searchsorted(to, to, side="right") - np.searchsorted(to, to) <= room
        layer[to[fits], (held + place)[fits]] = back[fits]
        to, back, place = to[~fits], back[~fits], place[~fits]
        for turn in range(0, int(place.max(initial=-1)) + 1, room):
            now = (place >= turn) & (place < turn + room)
            nodes, row = np.unique(to[now], return_inverse=True)
            for part in range(0, len(nodes), BATCH):
                some = (row >= part) & (row < part + BATCH)
                at = nodes[part : part + BATCH]
                added = np.full((len(at), room), -1, np.int64)
                added[row[some] - part, place[now][some] - turn] = back[now][some]
                ids = np.concatenate([layer[at].astype(np.int64), added], axis=1)
                ids, sims = _top(ids, self._sims(self.points[at], ids), ids.shape[1])
                ids = ids[:, : int((ids >= 0).sum(axis=1).max())]
                kept = self._spread(ids, sims[:, : ids.shape[1]], room)
                layer[at] = -1
                layer[at[:, None], np.arange(kept.shape[1])] = kept

    def search(self, rows, width):
        """The ``width`` best nodes found for each row, best first, -1 where there are fewer."""
        return self._walk(rows, 0, self._descend(rows, 0), width, self.sizes[0])[0]


class Shard:
    """The rows of one shard and one vector length, as graph nodes with their ids."""

    def __init__(self, ids, vectors, nearest=NEAREST, beam=BEAM_SEARCH):
        self.nearest, self.beam = nearest, max(beam, nearest + 1)
        order = np.lexsort((ids, *vectors.T[::-1]))
        ids, vectors = ids[order], vectors[order]
        fresh = np.ones(len(ids), bool)
        fresh[1:] = (vectors[1:] != vectors[:-1]).any(axis=1)
        again = np.zeros(len(ids), bool)
        again[1:] = ~fresh[1:] & (ids[1:] == ids[:-1])
        node = np.cumsum(fresh) - 1
        vectors, ids, node = vectors[fresh], ids[~again], node[~again]
        # Nodes in a fixed random order, so layers are random samples.
        mixed = np.random.default_rng(len(vectors)).permutation(len(vectors))
        self.vectors = vectors[mixed]
        begins = np.searchsorted(node, np.arange(len(vectors) + 1))
        self.ids, self.begins = ids, begins[:-1][mixed]
        # A query returns no more copies of one vector than the nearest it asks for, and itself.
        self.copies = np.minimum(begins[1:] - begins[:-1], nearest + 1)[mixed]
        self.unit = float(np.abs(self.vectors).max())  # keeps squares of huge components finite
        points = self.vectors / self.unit
        squares = (points * points).sum(axis=1)
        extra = np.sqrt(np.maximum(squares.max() - squares, 0.0))
        self.graph = Graph(np.column_stack([points, extra]).astype(np.float32))

    def answer(self, query_ids, queries):
        """``(query id, vec_id, score)`` arrays of the nearest rows of each query."""
        sizes = np.abs(queries).max(axis=1, keepdims=True)
        rows = np.pad(queries / sizes, ((0, 0), (0, 1))).astype(np.float32)
        nodes = self.graph.search(rows, min(self.beam, max(1, len(self.vectors))))
        row, col = np.nonzero(nodes >= 0)
        node = nodes[row, col]
        score = np.concatenate(
            [(queries[row[i : i + PAIRS]] * self.vectors[node[i : i + PAIRS]]).sum(axis=1) for i in range(0, len(row), PAIRS)]
            or [np.zeros(0)]
        )
        times = self.copies[node]
        each = np.repeat(np.arange(len(node)), times)
        nth = np.arange(len(each)) - np.repeat(np.cumsum(times) - times, times)
        row, score = row[each], score[each]
        ids = self.ids[self.begins[node[each]] + nth]
        other = ids != query_ids[row]
        row, score, ids = row[other], score[other], ids[other]
        order = np.lexsort((ids, -score, row))
        row, score, ids = row[order], score[order], ids[order]
        first = np.arange(len(row)) - np.searchsorted(row, row) < self.nearest
        return query_ids[row[first]], ids[first], score[first]


def _search(nearest, beam):
    """Task: the rows of a shard come first, then the queries; shards follow one another."""

    def run(batches):
        shard, rows, graphs = None, {}, None
        for piece in pieces(batches, "embedding"):
            shards = piece.column("shard").to_numpy()
            asked = piece.column("is_query").to_numpy(zero_copy_only=False)
            change = np.flatnonzero((np.diff(shards) != 0) | (np.diff(asked.astype(np.int8)) != 0)) + 1
            for start, stop in zip([0, *change], [*change, len(piece)]):
                if shards[start] != shard:
                    shard, rows, graphs = shards[start], {}, None
                part = piece.slice(start, stop - start)
                ids = part.column("vec_id").to_numpy(zero_copy_only=False)
                for at, matrix in matrices(part.column("embedding")):
                    if not asked[start]:
                        rows.setdefault(matrix.shape[1], []).append((ids[at], matrix))
                        continue
                    if graphs is None:
                        graphs = {
                            size: Shard(*(np.concatenate(x) for x in zip(*found)), nearest, beam)
                            for size, found in rows.items()
                        }
                        rows = {}
                    if matrix.shape[1] in graphs:
                        for i in range(0, len(at), BATCH):
                            found = graphs[matrix.shape[1]].answer(ids[at][i : i + BATCH], matrix[i : i + BATCH])
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(x) for x in found], ["query_id", "vec_id", "score"]
                            )

    return run


def usable(embeddings):
    """``(vec_id, embedding)`` of the rows that take part."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return rows.filter(F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda c: c != 0))


def nearest_vectors(
    embeddings, queries=None, nearest=NEAREST, beam=BEAM_SEARCH, shard_rows=SHARD_ROWS, least_shards=SHARDS
):
    """The ``nearest`` rows found for each query, by rank.

    ``queries`` is a frame like ``embeddings``; by default its rows whose id is divisible by
    ``QUERY_EVERY``.
    """
    rows = usable(embeddings)
    asked = rows.filter(F.col("vec_id") % QUERY_EVERY == 0) if queries is None else usable(queries)
    sizes = rows.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.size("embedding")), F.lit(0)).alias("values")).first()
    shards = max(least_shards, -(-sizes["rows"] // shard_rows), -(-sizes["values"] // SHARD_VALUES))
    # Dealt by place in the input, so no id and no vector makes a shard large.
    dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)).cast("int")
    stored = rows.select(dealt.alias("shard"), F.lit(False).alias("is_query"), "vec_id", "embedding")
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    asked = asked.select(every.alias("shard"), F.lit(True).alias("is_query"), "vec_id", "embedding")
    both = stored.unionByName(asked).repartitionById(shards, "shard")
    both = both.sortWithinPartitions("shard", "is_query")
    found = both.mapInArrow(_search(nearest, beam), FOUND).repartition("query_id")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    ranked = best.withColumn("rank", rank).filter(F.col("rank") <= nearest)
    return ranked.select("query_id", "rank", "vec_id", "score")
