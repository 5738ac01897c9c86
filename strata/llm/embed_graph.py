"""Embedding near-duplicates by a robust-pruned flat graph over overlapping shards.

1. Equal vectors become one node with its number of copies.
2. Pivots, drawn by a hash of the vectors so that dense regions get more of them, deal every node to its ``overlap``
   closest ones.  A shard that is still too large is dealt on in blocks; every pair of blocks is searched.
3. Each block builds its graph: a node's candidates are robust-pruned (a candidate closer to a chosen neighbour than to
   the node, by the factor ``ALPHA``, is dropped), those in range and those out of range apart, so that a group of near
   copies can't fill the list; reverse edges are added, and what the block's medoid can't reach gets an edge.
4. The lists of a node from all its shards are united.
5. Every node searches each of its shards from the shard's medoid: a greedy search with a beam, which goes on over
   the beam's end as long as nodes in range are left to expand.
6. Links across shards: a node visits the cells (nodes with the same closest pivot) of its own pivots and of the
   pivots of every node found in range of it, and is compared with all nodes there.  Both ends of a link take
   over each other's cells; rounds go on until no node has a cell left to visit.  Every node has one cell, so a link is counted once
   from each end and no list of links is kept.
7. Cosines are verified in double precision; links become components.
8. The audit compares a fixed number of nodes, of all and of the linked ones, with all nodes; while the mean recall of a node is
   below ``LEAST_RECALL`` the search runs again with twice the overlap and beam, and fails beyond ``MOST_OVERLAP``.

Pivots (at most ``MAX_PIVOTS``) and audit queries are the only vectors that reach the driver or every task.

Defined cases: null, empty or zero vectors and vectors with null or non-finite components link with nothing and
are their own component; vectors of different lengths never link; repeated rows link as copies; a null
``vec_id`` counts for no ``component_id``; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import checkpoint
from strata.llm.components import components

THRESHOLD = 0.95
OVERLAP, BEAM, DEGREE, ALPHA = 4, 32, 12, 1.2
#: Nodes a shard holds in the mean, and at most in one block.
SHARD_ROWS, BLOCK_ROWS = 2000, 4000
MAX_PIVOTS = 16_384
LEAST_RECALL, AUDIT_QUERIES, MOST_OVERLAP = 0.97, 200, 64
#: Rows compared at a time.
CHUNK = 512


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, width)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length one; scaled first, so that no square over- or underflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def prune(near: np.ndarray, candidates: np.ndarray, degree: int) -> np.ndarray:
    """(rows, degree) robust-pruned candidates, -1 where fewer are left.

    ``near``: similarity of all nodes; ``candidates``: (rows, c) node numbers by falling similarity, -1 for none."""
    rows = np.arange(len(candidates))
    distance = 1.0 - np.where(candidates >= 0, near[rows[:, None], candidates], -3.0)
    alive = candidates >= 0
    out = np.full((len(candidates), degree), -1, dtype=np.int64)
    for k in range(degree):
        at = np.argmax(alive, axis=1)
        some = alive[rows, at]
        if not some.any():
            break
        chosen = candidates[rows, at]
        out[some, k] = chosen[some]
        between = 1.0 - near[chosen[:, None], candidates]
        alive &= ~((ALPHA * between <= distance) & some[:, None])
        alive[rows, at] = False
    return out


def build(near: np.ndarray, threshold: float, degree: int = DEGREE) -> list[np.ndarray]:
    """Neighbour numbers of each node of a block; ``near``: (n, n) similarities."""
    n = len(near)
    if n < 2:
        return [np.zeros(0, np.int64)] * n
    near = near.copy()
    np.fill_diagonal(near, -2.0)
    most = min(n - 1, 6 * degree)
    lists: list[set] = [set() for _ in range(n)]
    for inside in (True, False):
        masked = np.where((near >= threshold) == inside, near, -2.0)
        top = np.argpartition(-masked, most - 1, axis=1)[:, :most]
        value = np.take_along_axis(masked, top, axis=1)
        order = np.argsort(-value, axis=1, kind="stable")
        top, value = np.take_along_axis(top, order, axis=1), np.take_along_axis(value, order, axis=1)
        top = np.where(value > -2.0, top, -1)
        for a, row in enumerate(prune(near, top, degree).tolist()):
            lists[a].update(b for b in row if b >= 0)
    for a in range(n):  # reverse edges, for which a list may grow to twice its share
        for b in list(lists[a]):
            if len(lists[b]) < 4 * degree:
                lists[b].add(a)
    start = medoid(near)
    reached = np.zeros(n, dtype=bool)
    reached[start] = True
    frontier = [start]
    while frontier:
        frontier = list({b for a in frontier for b in lists[a] if not reached[b]})
        reached[frontier] = True
    lost = np.flatnonzero(~reached)
    if len(lost):
        ways = np.flatnonzero(reached)
        for b, a in zip(lost.tolist(), ways[near[np.ix_(lost, ways)].argmax(axis=1)].tolist()):
            lists[a].add(b)
    return [np.array(sorted(x), dtype=np.int64) for x in lists]


def medoid(near: np.ndarray) -> int:
    """The node with the highest mean similarity to all."""
    return int(near.sum(axis=1).argmax())


def search(near: np.ndarray, neighbours: np.ndarray, start: int, threshold: float, beam: int) -> np.ndarray:
    """(queries, nodes) whether a node in range has been found.

    ``near``: (queries, nodes) similarities, read only where the search goes; ``neighbours``: (nodes, d), -1 for none."""
    queries, nodes = near.shape
    seen = np.zeros((queries, nodes), dtype=bool)
    done = np.zeros((queries, nodes), dtype=bool)
    found = np.zeros((queries, nodes), dtype=bool)
    pool = np.full((queries, beam), -1, dtype=np.int64)
    value = np.full((queries, beam), -np.inf, dtype=np.float32)
    pool[:, 0], value[:, 0] = start, near[:, start]
    seen[:, start] = True
    found[:, start] = near[:, start] >= threshold
    open_ = np.zeros((queries, beam), dtype=bool)
    open_[:, 0] = True
    active = np.arange(queries)
    while len(active):
        ranked = np.where(open_[active], value[active], -np.inf)
        at = ranked.argmax(axis=1)
        node = pool[active, at]
        idle = ~open_[active, at]
        open_[active, at] = False
        if idle.any():  # the beam is spent: expand nodes in range that it has lost
            left = found[active[idle]] & ~done[active[idle]]
            node[idle] = np.where(left.any(axis=1), left.argmax(axis=1), -1)
            going = node >= 0
            active, node = active[going], node[going]
            if not len(active):
                break
        done[active, node] = True
        step = neighbours[node]
        new = (step >= 0) & ~seen[active[:, None], step]
        seen[active[:, None], np.where(new, step, node[:, None])] = True
        close = np.where(new, near[active[:, None], step], -np.inf).astype(np.float32)
        row, col = np.nonzero(close >= threshold)
        found[active[row], step[row, col]] = True
        ids = np.concatenate([pool[active], step], axis=1)
        values = np.concatenate([value[active], close], axis=1)
        opens = np.concatenate([open_[active], new], axis=1)
        best = np.argpartition(-values, beam - 1, axis=1)[:, :beam]
        pool[active] = np.take_along_axis(ids, best, axis=1)
        value[active] = np.take_along_axis(values, best, axis=1)
        open_[active] = np.take_along_axis(opens, best, axis=1) & (value[active] > -np.inf)
    return found


def _place(pivots: dict[int, np.ndarray], overlap: int):
    """Nodes with the cells of their closest pivots and the closest one of these, their home."""
    base, start = {}, 0
    for width in sorted(pivots):
        base[width] = start
        start += len(pivots[width])

    def run(batches):
        for batch in batches:
            vectors = batch.column(1)
            width = np.diff(vectors.offsets.to_numpy())
            home = np.empty(len(width), dtype=np.int64)
            cells = np.empty(len(width), dtype=object)
            for w in np.unique(width).tolist():
                every = np.flatnonzero(width == w)
                for at in range(0, len(every), CHUNK):
                    rows = every[at:at + CHUNK]
                    if w in pivots:
                        near = unit(_matrix(vectors.take(pa.array(rows)), w)) @ pivots[w].T
                        m = min(overlap, near.shape[1])
                        home[rows] = near.argmax(axis=1) + base[w]
                        near[np.arange(len(rows)), home[rows] - base[w]] = np.inf  # of equal pivots the same one
                        top = np.argpartition(-near, m - 1, axis=1)[:, :m] + base[w]
                    else:
                        home[rows] = -w
                        top = np.full((len(rows), 1), -w)
                    cells[rows] = top.tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), vectors, batch.column(2), pa.array(home, pa.int32()),
                 pa.array(cells.tolist(), pa.list_(pa.int32()))], ["node", "vector", "copies", "home", "cells"])
    return run


PLACED = "node long, vector array<double>, copies long, home int, cells array<int>"


def _deal(blocks: dict[int, int]):
    """Nodes to the shards of their cells, and to the pairs of blocks of a large shard."""

    def run(batches):
        for batch in batches:
            cells = batch.column(4)
            shard = cells.flatten().to_numpy()
            owner = np.repeat(np.arange(len(cells)), np.diff(cells.offsets.to_numpy()))
            n = np.fromiter((blocks.get(s, 1) for s in shard.tolist()), np.int64, len(shard))
            drawn = batch.column(0).to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(17)
            own = drawn[owner].astype(np.int64) % n
            each = np.repeat(np.arange(len(shard)), n)
            other = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
            at = pa.array(owner[each])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (shard[each], np.minimum(own[each], other),
                                                   np.maximum(own[each], other), own[each])]
                + [batch.column(0).take(at), batch.column(1).take(at), batch.column(2).take(at), cells.take(at)],
                ["shard", "a", "b", "own", "node", "vector", "copies", "cells"])
    return run


DEALT = "shard long, a long, b long, own long, node long, vector array<double>, copies long, cells array<int>"


def _group(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    vectors = table["vector"].combine_chunks()
    width = len(vectors[0]) if len(vectors) else 0
    return table["node"].to_numpy(), unit(_matrix(vectors, width))


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Row and value of every element of a column of lists."""
    lists = column.combine_chunks()
    row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    return row, lists.flatten().to_numpy().astype(np.int64)


def _table_of(rows: int, names: np.ndarray, lists: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """(rows, names): which rows' lists hold which names; values that are no name are left out."""
    row, value = lists
    place = np.minimum(np.searchsorted(names, value), max(0, len(names) - 1))
    there = names[place] == value if len(names) else np.zeros(len(value), dtype=bool)
    out = np.zeros((rows, len(names)), dtype=bool)
    out[row[there], place[there]] = True
    return out


def _named(names: np.ndarray, mark: np.ndarray) -> pa.Array:
    """The names that each row marks, as a column of lists."""
    row, at = np.nonzero(mark)
    stops = np.searchsorted(row, np.arange(len(mark) + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(stops), pa.array(names[at].astype(np.int32)))


def _build(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        node, x = _group(table)
        x = x.astype(np.float32)
        lists = build(x @ x.T, threshold)
        return pa.table({"node": pa.array(node), "around": pa.array([node[r].tolist() for r in lists],
                                                                    pa.list_(pa.int64()))})
    return run


def _search(threshold: float, beam: int, listed: bool):
    """Of one pair of blocks: the nodes of both search the graph of block ``a`` (and of ``b``).

    ``listed``: the links found (``node, low, links``); else the cells of what is found (``node, more``)."""

    def one(node, x, around, host, take):
        hosts = np.flatnonzero(host)
        order = hosts[np.argsort(node[hosts])]
        names = node[order]
        flat = np.concatenate(around[order].tolist() or [np.zeros(0, np.int64)]) if len(order) else np.zeros(0)
        size = np.array([len(v) for v in around[order]], dtype=np.int64)
        place = np.searchsorted(names, flat)
        there = (place < len(names)) & (names[np.minimum(place, len(names) - 1)] == flat)
        row = np.repeat(np.arange(len(order)), size)[there]
        place = place[there]
        count = np.bincount(row, minlength=len(order))
        lists = np.full((len(order), max(1, int(count.max()) if len(count) else 1)), -1, dtype=np.int64)
        lists[row, np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)] = place
        y = x[order].astype(np.float32)
        near = x.astype(np.float32) @ y.T
        start = medoid(y @ y.T)
        found = search(near, lists, start, np.float32(threshold - 1e-4), beam)
        for first in range(0, len(found), CHUNK):  # verified in double precision
            q, h = np.nonzero(found[first:first + CHUNK])
            q, h = q + first, order[h]
            apart = q != h
            q, h = q[apart], h[apart]
            for at in range(0, len(q), 1 << 16):
                a, b = q[at:at + (1 << 16)], h[at:at + (1 << 16)]
                good = np.einsum("ij,ij->i", x[a], x[b]) >= threshold
                take(a[good], b[good])

    def run(table: pa.Table) -> pa.Table:
        node, x = _group(table)
        own = table["own"].to_numpy()
        around = np.empty(len(node), dtype=object)
        around[:] = [np.array(v, dtype=np.int64) for v in table["around"].to_pylist()]
        if not listed:
            lists = _lists(table["cells"])
            names = np.unique(lists[1])
            cells = _table_of(len(node), names, lists)
            width = int(cells.sum(axis=1).max())
            place = np.argsort(~cells, axis=1, kind="stable")[:, :width]  # a vector's number of cells is that of all here
            more = np.zeros_like(cells)

            def take(a, b):
                for k in range(width):
                    more[a, place[b, k]] = True
                    more[b, place[a, k]] = True
            for block in np.unique(own).tolist():
                one(node, x, around, own == block, take)
            keep = np.flatnonzero(more.any(axis=1))
            return pa.table({"node": pa.array(node[keep]), "more": _named(names, more[keep])})
        copies = table["copies"].to_numpy()
        pairs: list[tuple] = []
        for block in np.unique(own).tolist():
            one(node, x, around, own == block, lambda a, b: pairs.append((a, b)))
        a = np.concatenate([p[0] for p in pairs]) if pairs else np.zeros(0, np.int64)
        b = np.concatenate([p[1] for p in pairs]) if pairs else np.zeros(0, np.int64)
        both = np.unique(np.concatenate([a * len(node) + b, b * len(node) + a]))
        a, b = both // len(node), both % len(node)
        low = node.copy()  # the smallest node that a node's links reach here
        while True:
            new = low.copy()
            np.minimum.at(new, a, low[b])
            if (new == low).all():
                break
            low = new
        bounds = np.searchsorted(a, np.arange(len(node) + 1))
        keep = np.flatnonzero(np.diff(bounds))
        links = [[{"node": int(n), "copies": int(c)} for n, c in zip(node[b[s:e]], copies[b[s:e]])]
                 for s, e in zip(bounds[keep], bounds[keep + 1])]
        return pa.table({"node": pa.array(node[keep]), "low": pa.array(low[keep]), "links": pa.array(
            links, pa.list_(pa.struct([("node", pa.int64()), ("copies", pa.int64())])))})
    return run


def in_range(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """(x, y) whether unit vectors are in range; at the threshold by a sum whose order is always the same."""
    near = x @ y.T
    hit = near >= threshold
    a, b = np.nonzero(np.abs(near - threshold) < 1e-9)
    hit[a, b] = np.einsum("ij,ij->i", x[a], y[b]) >= threshold
    return hit


def _lows(hit: np.ndarray, guests: np.ndarray, hosts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest node that each guest and each host reaches over the hits."""
    low_guest, low_host = guests.copy(), hosts.copy()
    rest = hit.any(axis=1)
    for start in np.flatnonzero(rest).tolist():
        if not rest[start]:
            continue
        rows, columns = np.zeros(len(guests), dtype=bool), np.zeros(len(hosts), dtype=bool)
        new = np.array([start])
        while len(new):
            rows[new] = True
            reached = np.flatnonzero(hit[new].any(axis=0) & ~columns)
            columns[reached] = True
            new = np.flatnonzero(hit[:, reached].any(axis=1) & ~rows)
        low = min(guests[rows].min(), hosts[columns].min())
        low_guest[rows], low_host[columns] = low, low
        rest &= ~rows
    return low_guest, low_host


MET = "node long, n long, low long, more array<int>"


def _meet(threshold: float):
    """Nodes that visit a cell, each compared with all nodes at home there."""

    def run(guests: pa.Table, hosts: pa.Table) -> pa.Table:
        if not len(guests) or not len(hosts):
            return pa.table({"node": pa.array([], pa.int64()), "n": pa.array([], pa.int64()),
                             "low": pa.array([], pa.int64()), "more": pa.array([], pa.list_(pa.int32()))})
        guest, x = _group(guests)
        host, y = _group(hosts)
        copies = hosts["copies"].to_numpy().astype(np.float64)
        of_guest, of_host = _lists(guests["cells"]), _lists(hosts["cells"])
        names = np.unique(np.concatenate([of_guest[1], of_host[1]]))
        of_guest = _table_of(len(guest), names, of_guest).astype(np.float32)
        of_host = _table_of(len(host), names, of_host).astype(np.float32)
        hit = np.zeros((len(guest), len(host)), dtype=bool)
        n = np.zeros(len(guest))
        to_guest, to_host = np.zeros(of_guest.shape, dtype=bool), np.zeros(of_host.shape, dtype=bool)
        for at in range(0, len(guest), CHUNK):
            rows = np.s_[at:at + CHUNK]
            part = in_range(x[rows], y, threshold) & (guest[rows, None] != host)
            if part.any():
                hit[rows] = part
                n[rows] = part.astype(np.float64) @ copies
                part = part.astype(np.float32)
                to_guest[rows] = part @ of_host > 0
                to_host |= part.T @ of_guest[rows] > 0
        to_guest &= ~_table_of(len(guest), names, _lists(guests["seen"]))
        to_host &= ~_table_of(len(host), names, _lists(hosts["seen"]))
        low_guest, low_host = _lows(hit, guest, host)
        some, others = np.flatnonzero(hit.any(axis=1)), np.flatnonzero(hit.any(axis=0))
        return pa.table({
            "node": pa.array(np.concatenate([guest[some], host[others]])),
            "n": pa.array(np.concatenate([n[some], np.zeros(len(others))]).astype(np.int64)),
            "low": pa.array(np.concatenate([low_guest[some], low_host[others]])),
            "more": _named(names, np.concatenate([to_guest[some], to_host[others]]))})
    return run


def _pivots(nodes: DataFrame, count: int) -> dict[int, np.ndarray]:
    rows = nodes.orderBy(F.xxhash64("vector"), "node").limit(count).select("vector").collect()
    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(len(r["vector"]), []).append(r["vector"])
    return {w: unit(np.array(v, dtype=np.float64)) for w, v in by.items()}


def place(nodes: DataFrame, overlap: int = OVERLAP, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """A written table ``node, vector, copies, home, cells`` of a table ``node, vector, copies`` of distinct vectors."""
    pivots = _pivots(nodes, min(MAX_PIVOTS, max(1, -(-nodes.count() * overlap // shard_rows))))
    return checkpoint(nodes.select("node", "vector", "copies").mapInArrow(_place(pivots, overlap), PLACED), cache=False)


def _searched(placed: DataFrame, threshold: float, beam: int, block_rows: int, listed: bool) -> DataFrame:
    sizes = placed.select(F.explode("cells").alias("shard")).groupBy("shard").count().collect()
    blocks = {r["shard"]: -(-r["count"] // block_rows) for r in sizes if r["count"] > block_rows}
    dealt = placed.mapInArrow(_deal(blocks), DEALT)
    own_block = dealt.where("a = own and b = own").select("shard", "own", "node", "vector")
    lists = own_block.groupBy("shard", "own").applyInArrow(_build(threshold), "node long, around array<long>")
    united = checkpoint(lists.groupBy("node").agg(
        F.array_distinct(F.flatten(F.collect_list("around"))).alias("around")), cache=False)
    return dealt.join(united, "node").groupBy("shard", "a", "b").applyInArrow(
        _search(threshold, beam, listed),
        "node long, low long, links array<struct<node:bigint,copies:bigint>>" if listed else "node long, more array<int>")


def graph_links(nodes: DataFrame, threshold: float = THRESHOLD, overlap: int = OVERLAP, beam: int = BEAM,
                shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows ``node, low, links`` (one a node and shard) of a table ``node, vector, copies`` of distinct vectors: the
    links within shards."""
    return _searched(place(nodes, overlap, shard_rows), threshold, beam, block_rows, True)


def range_links(nodes: DataFrame, threshold: float = THRESHOLD, overlap: int = OVERLAP, beam: int = BEAM,
                shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows ``node, n, low`` (some a node) of a table ``node, vector, copies`` of distinct vectors: ``n`` adds up to
    the copies of all nodes in range, ``low`` links the node with its component."""
    placed = place(nodes, overlap, shard_rows)
    homes = placed.groupBy(F.col("home").alias("cell")).agg(F.ceil(F.count("*") / block_rows).alias("n_host"))
    homes = checkpoint(homes, cache=False)
    none = F.array().cast("array<int>")
    met = _searched(placed, threshold, beam, block_rows, False)
    seen = placed.select("node", none.alias("seen"))
    rounds = placed.where("false").select("node", F.col("copies").alias("n"), F.col("node").alias("low"))
    while True:
        more = met.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("more"))).alias("more"))
        state = placed.select("node", "cells").join(seen, "node").join(more, "node", "left")
        new = F.when(F.col("more").isNull(), none).otherwise(F.array_except(F.array_union("cells", "more"), "seen"))
        state = checkpoint(state.select("node", "seen", new.alias("new")), cache=False)
        visits = state.select("node", F.explode("new").alias("cell"))
        if visits.isEmpty():
            return rounds
        seen = state.select("node", F.concat("seen", "new").alias("seen"))
        plan = checkpoint(visits.groupBy("cell").agg(F.ceil(F.count("*") / block_rows).alias("n_guest"))
                          .join(homes, "cell"), cache=False)
        every = placed.join(seen, "node")
        guests = visits.join(plan, "cell").withColumn("g", F.pmod(F.xxhash64("node"), "n_guest")).withColumn(
            "h", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_host") - 1)))
        guests = guests.select("node", "cell", "g", "h").join(every.select("node", "vector", "cells", "seen"), "node")
        hosts = every.withColumn("cell", F.col("home")).join(plan, "cell").withColumn(
            "h", F.pmod(F.xxhash64("node"), "n_host")).withColumn(
            "g", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_guest") - 1)))
        hosts = hosts.select(*[F.col(c).alias(c) for c in (  # columns of their own: guests come from the same table
            "node", "cell", "g", "h", "vector", "copies", "cells", "seen")])
        keys = ("cell", "g", "h")
        met = checkpoint(guests.groupBy(*keys).cogroup(hosts.groupBy(*keys)).applyInArrow(_meet(threshold), MET),
                         cache=False)
        rounds = rounds.union(met.select("node", "n", "low"))


def audit(nodes: DataFrame, found: DataFrame, threshold: float = THRESHOLD, queries: int = AUDIT_QUERIES) -> float:
    """Mean share of a node's true links that are found, over ``queries`` nodes (by a hash) of all and as many of those
    with links found; nodes without true links don't count; 1 if all are.

    ``found``: ``node, n`` with the copies in range.  The queries are compared with all nodes; they are a fixed number."""
    rank = (F.xxhash64("vector", F.lit("audit")), "node")
    some = nodes.select("node", "vector").join(found.where("n > 0").select("node"), "node")
    chosen = {r["node"]: r["vector"] for part in (nodes, some)
              for r in part.orderBy(*rank).limit(queries).select("node", "vector").collect()}
    if not chosen:
        return 1.0
    by: dict[int, tuple] = {}
    for w in {len(v) for v in chosen.values()}:
        ids = np.array([n for n, v in chosen.items() if len(v) == w], dtype=np.int64)
        by[w] = ids, unit(np.array([chosen[n] for n in ids.tolist()], dtype=np.float64))

    def brute(batches):
        total = {w: np.zeros(len(ids)) for w, (ids, _) in by.items()}
        for batch in batches:
            own, copies = batch.column(0).to_numpy(), batch.column(2).to_numpy().astype(np.float64)
            width = np.diff(batch.column(1).offsets.to_numpy())
            for w, (ids, q) in by.items():
                rows = np.flatnonzero(width == w)
                if len(rows):
                    hit = in_range(unit(_matrix(batch.column(1).take(pa.array(rows)), w)), q, threshold)
                    total[w] += copies[rows] @ (hit & (own[rows, None] != ids))
        for w, (ids, _) in by.items():
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[w].astype(np.int64))], ["node", "near"])
    true = nodes.select("node", "vector", "copies").mapInArrow(brute, "node long, near long")
    true = true.groupBy("node").agg(F.sum("near").alias("near")).where("near > 0")
    share = F.least(F.lit(1.0), F.coalesce("n", F.lit(0)) / F.col("near"))
    return true.join(found, "node", "left").agg(F.coalesce(F.avg(share), F.lit(1.0))).first()[0]


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = THRESHOLD, overlap: int = OVERLAP, beam: int = BEAM,
                    shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row a vector: ``vec_id, n_links, component_id, kept``."""
    rows = df.select(df[id_col].cast("long").alias("vec_id"), df[vector_col].cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce((F.size("vector") > 0) & finite & F.exists("vector", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("usable", usable)
    nodes = rows.where("usable").groupBy("vector").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    nodes = checkpoint(nodes.withColumn("node", F.monotonically_increasing_id()).select(
        "node", "vector", "copies", "first"), cache=False)
    while True:
        found = range_links(nodes, threshold, overlap, beam, shard_rows, block_rows)
        number = checkpoint(found.groupBy("node").agg(F.sum("n").alias("n")), cache=False)
        recall = audit(nodes, number, threshold)
        if recall >= LEAST_RECALL:
            break
        if overlap >= MOST_OVERLAP:
            raise RuntimeError(f"recall {recall:.4f} of the audited nodes is below {LEAST_RECALL} at overlap {overlap}")
        overlap, beam = 2 * overlap, 2 * beam
    reached = components(found.select("node", "low"))
    first = nodes.select("node", "first", "copies", "vector")
    member = first.join(reached, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = member.groupBy("root").agg(F.min("first").alias("component_id"))
    named = member.join(lowest, "root").join(number, "node", "left").select(
        "vector", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    linked = rows.where("usable").join(named, "vector").select("vec_id", "n_links", "component_id")
    alone = rows.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                            F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
