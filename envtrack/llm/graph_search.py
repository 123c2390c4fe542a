"""Operator 11: approximate nearest neighbours by largest inner product, on a graph made by NN-descent.

Equal vectors are one node. A coordinate sqrt(M^2 - |x|^2) is added to each vector, M being the largest
norm, so that the largest inner product is the nearest node for every query; nodes are compared through
one byte a component while the graph is made, and by the original vectors when it is searched.

* Start: nodes are put in the order of signs of random projections, and each takes its ``DEGREE`` best
  in its block of 2^``CELL_BITS`` nodes; the same in a second order. The first order numbers the nodes,
  so that a node's cell is part of its number.
* Rounds: every node gathers the vectors of some of its neighbours and of the nodes that it is a neighbour
  of (``SAMPLE`` new and ``SAMPLE`` old ones of each kind, best first) by Spark joins, compares each two of
  which one is new, and proposes to each what is better than the last of its list. Lists and proposals
  are merged by node. Rounds end when less than ``FRESH_SHARE`` of the entries are new.
* Search: a query starts at its own node and keeps its ``BEAM`` best nodes; in each step the neighbours of
  all that are not yet visited are asked for in their cells (a query's vector goes once to a cell, with
  positions), until no unvisited node is among the best. All queries move in the same jobs.

Every row is a node and every row is found; what is approximate is which nodes a search meets. Recall on
64 random dimensions without any structure, the worst case, is stated in the README and tested.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no part; a
missing component of a shorter vector counts as 0; a row is never its own neighbour, but a repeated row
is; null ids are no queries and lose every tie; fewer rows than asked for are all found in one block; an
empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from envtrack.llm.common import left_join_by_key, released, spans, staged, whole_groups

DEGREE, SAMPLE, FRESH_SHARE, BEAM = 32, 16, 0.03, 192
CELL_BITS, PARTITION_NODES, ORDERS, PLANES = 12, 1 << 16, 2, 16
SLAB = 512
NAMES = ["node", "others", "scores", "fresh", "turn", "code", "scale"]
LISTS = "node bigint, others array<bigint>, scores array<float>, fresh array<boolean>, turn array<int>, code binary, scale float"
FOUND = "q bigint, ids array<bigint>, scores array<double>, open array<boolean>"


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _flat(column) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column and the sizes of its lists; a null list is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), sizes


def _matrix(column, width: int) -> np.ndarray:
    flat, sizes = _flat(column)
    out = np.zeros((len(sizes), width), np.float64)
    out[np.repeat(np.arange(len(sizes)), sizes), spans(np.zeros_like(sizes), sizes)] = flat
    return out


def dots(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, each the same wherever the row stands."""
    return np.einsum("ij,ij->i", x, y)


# ---------------------------------------------------------------- nodes

def sound_rows(vectors: DataFrame, id_col: str, vec_col: str, seed: int) -> DataFrame:
    """id, row, hash, check and x (the vector as it is) of the rows that take part."""
    good = F.forall(vec_col, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) != float("inf")))
    some = F.exists(vec_col, lambda v: v != 0)
    kept = vectors.where(F.col(vec_col).isNotNull()).where(F.coalesce(good & some, F.lit(False)))
    return kept.select(F.col(id_col).cast("bigint").alias("id"), F.monotonically_increasing_id().alias("row"),
                       F.xxhash64(F.lit(2 * seed), vec_col).alias("hash"),
                       F.xxhash64(F.lit(2 * seed + 1), vec_col).alias("check"), F.col(vec_col).alias("x"))


def distinct_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, DataFrame, int, int, float]:
    """Rows, their different vectors by a 64-bit hash that is free of collisions, their number, width, peak."""
    for seed in itertools.count():
        rows = staged(sound_rows(vectors, id_col, vec_col, seed), "vectors")
        found = staged(rows.groupBy("hash").agg(
            F.first("x").alias("x"), (F.min("check") != F.max("check")).alias("clash")), "nodes")
        peak = F.max(F.array_max(F.transform("x", lambda v: F.abs(v.cast("double")))))
        number, width, largest, clash = found.agg(F.count("*"), F.max(F.size("x")), peak, F.max("clash")).first()
        if not clash:
            return rows, found, number, width or 0, largest or 1.0


def numbered_nodes(found: DataFrame, number: int, width: int, peak: float) -> DataFrame:
    """node, hash, x, code, scale and key1: nodes by locality, with one byte a component."""
    norm = F.aggregate("x", F.lit(0.0), lambda a, v: a + (v.cast("double") / peak) * (v.cast("double") / peak))
    most = found.agg(F.max(norm)).first()[0] or 0.0
    planes = np.random.default_rng(11).standard_normal((width, ORDERS * PLANES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), width) / peak
            side = (x @ planes > 0).astype(np.int64)
            keys = [side[:, a:a + PLANES] @ (1 << np.arange(PLANES)[::-1]) for a in range(0, ORDERS * PLANES, PLANES)]
            full = np.concatenate([x, np.sqrt(np.maximum(0, most - dots(x, x)))[:, None]], axis=1)
            scale = np.abs(full).max(axis=1) / 127
            code = np.rint(full / scale[:, None]).astype(np.int8)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([c.tobytes() for c in code], pa.binary()),
                 pa.array(scale.astype(np.float32)), *(pa.array(k) for k in keys)],
                names=["hash", "x", "code", "scale", *(f"key{i}" for i in range(ORDERS))])

    kind = found.schema["x"].dataType.simpleString()
    keyed = found.select("hash", "x").mapInArrow(
        run, f"hash bigint, x {kind}, code binary, scale float, " + ", ".join(f"key{i} bigint" for i in range(ORDERS)))
    return in_order(keyed, ["key0", "hash"], number, "node").drop("key0")


def in_order(rows: DataFrame, keys: list[str], number: int, name: str) -> DataFrame:
    """``rows`` sorted and numbered from 0 in column ``name``, without gaps however they are dealt to tasks.

    A row's number is its place in its partition and the rows of the partitions before; those counts, one
    row for each partition, are the only data that is broadcast."""
    parts = max(1, math.ceil(number / PARTITION_NODES))
    dealt = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    placed = staged(dealt.withColumn("place", F.monotonically_increasing_id()), name)
    sizes = placed.groupBy(F.shiftright("place", 33).alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()
    before = list(zip((r["part"] for r in sizes), itertools.accumulate((r["n"] for r in sizes), initial=0)))
    offsets = rows.sparkSession.createDataFrame(before, "part bigint, before bigint")
    inside = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("part", F.shiftright("place", 33)).join(F.broadcast(offsets), "part").withColumn(
        name, F.col("before") + inside).drop("part", "before", "place")


def _codes(code, scale) -> np.ndarray:
    code = code.combine_chunks() if isinstance(code, pa.ChunkedArray) else code
    raw = np.frombuffer(b"".join(code.to_pylist()), np.int8)
    return raw.reshape(len(code), -1).astype(np.float32) * scale.to_numpy()[:, None].astype(np.float32)


# ---------------------------------------------------------------- the graph

def _block_lists(degree: int):
    def run(block: pa.Table) -> pa.Table:
        node, code = block.column("node").to_numpy(), _codes(block.column("code"), block.column("scale"))
        n, most = len(node), min(degree, len(node) - 1)
        others, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.float32)]
        for a in range(0, n if most else 0, SLAB):
            s = code[a:a + SLAB] @ code.T
            s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
            best = np.argpartition(s, n - most, axis=1)[:, n - most:]
            others.append(node[best].ravel())
            scores.append(np.take_along_axis(s, best, axis=1).ravel())
        others, sizes = np.concatenate(others), np.full(n, most)
        return pa.table({"node": pa.array(node), "others": _lists(others, sizes, pa.int64()),
                         "scores": _lists(np.concatenate(scores), sizes, pa.float32()),
                         "fresh": _lists(np.ones(len(others), bool), sizes, pa.bool_()),
                         "turn": _lists(np.zeros(len(others), np.int32), sizes, pa.int32()),
                         "code": pa.nulls(n, pa.binary()), "scale": pa.nulls(n, pa.float32())})
    return run


def merged_lists(rows: DataFrame, degree: int, sample: int) -> DataFrame:
    """One list of the ``degree`` best others for each node, from lists and proposals, which have no code.

    Entries whose turn has come (below ``sample``) are no longer fresh; ``turn`` numbers the fresh entries
    and the others of a list, best first.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_groups(batches, ["node"]):
            other, sizes = _flat(group.column("others"))
            score, fresh = _flat(group.column("scores"))[0], _flat(group.column("fresh"))[0].astype(bool)
            turn, turns = _flat(group.column("turn"))
            node = np.repeat(group.column("node").to_numpy(), sizes)
            own = np.flatnonzero(group.column("code").is_valid().to_numpy(zero_copy_only=False))
            old = np.repeat(turns > 0, sizes)
            fresh[old] &= turn >= sample
            order = np.lexsort((~old, other, node))  # of equal entries the list's own
            first = np.append(True, (node[order][1:] != node[order][:-1]) | (other[order][1:] != other[order][:-1]))
            order = order[first[:len(order)]]
            order = order[np.lexsort((other[order], -score[order], node[order]))]
            rank = np.arange(len(order)) - np.searchsorted(node[order], node[order])
            order = order[rank < degree]
            node, other, score, fresh = node[order], other[order], score[order], fresh[order]
            listed = group.column("node").to_numpy()[own]  # every node has one row of its own, in ascending order
            begin = np.searchsorted(node, listed)
            sizes = np.searchsorted(node, listed, side="right") - begin
            ahead = np.repeat(np.concatenate([[0], np.cumsum(fresh)])[begin], sizes)
            before, start = np.cumsum(fresh) - fresh - ahead, np.repeat(begin, sizes)
            turn = np.where(fresh, before, np.arange(len(node)) - start - before)
            take = pa.array(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(listed), _lists(other, sizes, pa.int64()), _lists(score, sizes, pa.float32()),
                 _lists(fresh, sizes, pa.bool_()), _lists(turn.astype(np.int32), sizes, pa.int32()),
                 group.column("code").take(take).combine_chunks(), group.column("scale").take(take).combine_chunks()],
                names=NAMES)

    return rows.repartition("node").sortWithinPartitions("node").mapInArrow(run, LISTS)


def _proposals(members: DataFrame, degree: int) -> DataFrame:
    """What the members of each center propose to each other: lists without a turn."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_groups(batches, ["center"]):
            center, member = group.column("center").to_numpy(), group.column("member").to_numpy()
            fresh = group.column("fresh").to_numpy(zero_copy_only=False).astype(bool)
            order = np.lexsort((~fresh, member, center))
            new = np.append(True, (center[order][1:] != center[order][:-1]) | (member[order][1:] != member[order][:-1]))
            order = order[new]
            code = _codes(group.column("code"), group.column("scale"))
            last = group.column("last").to_numpy()
            begin = np.flatnonzero(np.append(True, center[order][1:] != center[order][:-1]))
            sizes = np.diff(np.append(begin, len(order)))
            width = int(sizes.max())
            for a in range(0, len(begin), 256):
                size, size_begin = sizes[a:a + 256], begin[a:a + 256]
                at = np.full((len(size), width), -1)
                at[np.repeat(np.arange(len(size)), size), spans(np.zeros_like(size), size)] = order[spans(size_begin, size)]
                there = at >= 0
                x = np.where(there[:, :, None], code[at], 0)
                score = x @ x.transpose(0, 2, 1)
                is_new = there & fresh[at]
                fits = there[:, :, None] & there[:, None, :] & (is_new[:, :, None] | is_new[:, None, :])
                fits &= score > last[at][:, :, None]
                fits[:, np.arange(width), np.arange(width)] = False
                g, i, j = np.nonzero(fits)
                run_begin = np.flatnonzero(np.append(True, (g[1:] != g[:-1]) | (i[1:] != i[:-1]))[:len(g)])
                count = np.diff(np.append(run_begin, len(g)))
                none = np.zeros(len(run_begin), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(member[at[g[run_begin], i[run_begin]]]), _lists(member[at[g, j]], count, pa.int64()),
                     _lists(score[g, i, j], count, pa.float32()), _lists(np.ones(len(g), bool), count, pa.bool_()),
                     _lists(np.zeros(0, np.int32), none, pa.int32()), pa.nulls(len(count), pa.binary()),
                     pa.nulls(len(count), pa.float32())], names=NAMES)

    return members.repartition("center").sortWithinPartitions("center").mapInArrow(run, LISTS)


def links(lists: DataFrame) -> DataFrame:
    """node, other, score, fresh, turn: an entry of a list a row."""
    entry = F.explode(F.arrays_zip("others", "scores", "fresh", "turn")).alias("e")
    return lists.select("node", entry).select("node", F.col("e.others").alias("other"), F.col("e.scores").alias("score"),
                                              F.col("e.fresh").alias("fresh"), F.col("e.turn").alias("turn"))


def neighbour_graph(points: DataFrame, degree: int, sample: int, fresh_share: float, number: int) -> DataFrame:
    """The lists of all nodes, by blocks of two orders and then rounds of neighbours of neighbours."""
    codes = points.select("node", "code", "scale")
    empty = [F.array().cast(kind).alias(name) for name, kind in (("others", "array<bigint>"), ("scores", "array<float>"),
                                                                 ("fresh", "array<boolean>"), ("turn", "array<int>"))]
    orders = [codes.withColumn("at", F.col("node"))]
    orders += [in_order(points.select("node", "code", "scale", f"key{i}"), [f"key{i}", "node"], number, "at")
               for i in range(1, ORDERS)]
    first = codes.select("node", *empty, "code", "scale")
    for order in orders:
        block = order.select("node", "code", "scale", F.shiftright("at", CELL_BITS).alias("block"))
        first = first.unionByName(block.groupBy("block").applyInArrow(_block_lists(degree), LISTS))
    lists = staged(merged_lists(first, degree, 0), "lists")
    while True:
        fresh = lists.agg(F.sum(F.size(F.filter("fresh", lambda x: x)))).first()[0] or 0
        if fresh <= fresh_share * degree * number:
            return lists
        entries = links(lists)
        back = Window.partitionBy("center", "fresh").orderBy(F.desc("score"), "member")
        members = entries.where(F.col("turn") < sample).select(
            F.col("node").alias("center"), F.col("other").alias("member"), "fresh").unionByName(
            entries.select(F.col("other").alias("center"), F.col("node").alias("member"), "fresh", "score").withColumn(
                "place", F.row_number().over(back)).where(F.col("place") <= sample).drop("place", "score"))
        last = F.when(F.size("scores") < degree, F.lit(float("-inf"))).otherwise(F.element_at("scores", -1)).cast("float")
        known = lists.select(F.col("node").alias("member"), "code", "scale", last.alias("last"))
        proposed = _proposals(members.join(known, "member"), degree)
        lists, done = staged(merged_lists(lists.unionByName(proposed), degree, sample), "lists"), lists
        released(done)


def adjacency(lists: DataFrame, degree: int) -> DataFrame:
    """node, others: a node's list and the best ``degree`` of the nodes that list it."""
    back = Window.partitionBy("node").orderBy(F.desc("score"), "other")
    entries = links(lists).select("node", "other", "score")
    turned = entries.select(F.col("other").alias("node"), F.col("node").alias("other"), "score").withColumn(
        "place", F.row_number().over(back)).where(F.col("place") <= degree)
    both = entries.select("node", "other").unionByName(turned.select("node", "other"))
    return staged(both.groupBy("node").agg(F.collect_set("other").alias("others")), "graph")


# ---------------------------------------------------------------- the search

def _requests(rows: DataFrame, beam: int, kind: str) -> DataFrame:
    """(cell, q, x, floor, wanted): what each query asks for in each cell, what it holds already left out.

    ``rows`` has for each query its state, with its vector, and the neighbours of nodes that it visits.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_groups(batches, ["q"]):
            q_of, is_state = group.column("q").to_numpy(), group.column("x").is_valid().to_numpy(zero_copy_only=False)
            ids, sizes = _flat(group.column("ids"))
            q, held = np.repeat(q_of, sizes), np.repeat(is_state, sizes)
            order = np.lexsort((~held, ids, q))  # what is held stands before what is wanted
            new = np.append(True, (q[order][1:] != q[order][:-1]) | (ids[order][1:] != ids[order][:-1]))[:len(order)]
            keep = order[new & ~held[order]]
            q, ids = q[keep], ids[keep].astype(np.int64)
            cell = ids >> CELL_BITS
            begin = np.flatnonzero(np.append(True, (q[1:] != q[:-1]) | (cell[1:] != cell[:-1]))[:len(q)])
            count = np.diff(np.append(begin, len(q)))
            states = np.flatnonzero(is_state)  # one for each query, in ascending order
            scores, of_state = _flat(group.column("scores").take(pa.array(states)))
            floor = np.full(len(states), -np.inf)
            full = of_state >= beam
            floor[full] = scores[(np.cumsum(of_state) - 1)[full]]
            at = np.searchsorted(q_of[states], q[begin])
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell[begin]), pa.array(q[begin]), group.column("x").take(pa.array(states[at])).combine_chunks(),
                 pa.array(floor[at]), _lists((ids & ((1 << CELL_BITS) - 1)).astype(np.int16), count, pa.int16())],
                names=["cell", "q", "x", "floor", "wanted"])

    return rows.repartition("q").sortWithinPartitions("q").mapInArrow(
        run, f"cell bigint, q bigint, x {kind}, floor double, wanted array<smallint>")


def _scored(width: int):
    def run(asked: pa.Table, cell: pa.Table) -> pa.Table:
        node = cell.column("node").to_numpy()
        here = np.zeros((1 << CELL_BITS, width))
        here[node & ((1 << CELL_BITS) - 1)] = _matrix(cell.column("x"), width)
        base = (node[0] >> CELL_BITS) << CELL_BITS if len(node) else 0
        queries, floors = _matrix(asked.column("x"), width), asked.column("floor").to_numpy()
        wanted, sizes = _flat(asked.column("wanted"))
        ids, scores, kept = [np.zeros(0, np.int64)], [np.zeros(0)], np.zeros(len(sizes), np.int64)
        for r, (a, z) in enumerate(zip(np.cumsum(sizes) - sizes, np.cumsum(sizes))):
            at = wanted[a:z].astype(np.int64)
            score = dots(here[at], np.broadcast_to(queries[r], (len(at), width)))
            good = score > floors[r]
            ids.append(at[good] + base)
            scores.append(score[good])
            kept[r] = good.sum()
        return pa.table({"q": asked.column("q").combine_chunks() if asked.num_rows else pa.array([], pa.int64()),
                         "ids": _lists(np.concatenate(ids), kept, pa.int64()),
                         "scores": _lists(np.concatenate(scores), kept, pa.float64()),
                         "open": _lists(np.ones(int(kept.sum()), bool), kept, pa.bool_())})
    return run


def _best(rows: DataFrame, beam: int, state: str) -> DataFrame:
    """Each query's ``beam`` best nodes; rows that were held before, which have the vector, have been visited."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_groups(batches, ["q"]):
            ids, sizes = _flat(group.column("ids"))
            scores, open_ = _flat(group.column("scores"))[0], _flat(group.column("open"))[0].astype(bool)
            q = np.repeat(group.column("q").to_numpy(), sizes)
            order = np.lexsort((ids, -scores, q))
            rank = np.arange(len(order)) - np.searchsorted(q[order], q[order])
            order = order[rank < beam]
            q = q[order]
            own = np.flatnonzero(group.column("x").is_valid().to_numpy(zero_copy_only=False))
            asking = group.column("q").to_numpy()[own]
            count = np.searchsorted(q, asking, side="right") - np.searchsorted(q, asking)
            yield pa.RecordBatch.from_arrays(
                [pa.array(asking), group.column("x").take(pa.array(own)).combine_chunks(), _lists(ids[order], count, pa.int64()),
                 _lists(scores[order], count, pa.float64()), _lists(open_[order], count, pa.bool_())],
                names=["q", "x", "ids", "scores", "open"])

    return rows.repartition("q").sortWithinPartitions("q").mapInArrow(run, state)


def greedy_search(points: DataFrame, graph: DataFrame, queries: DataFrame, width: int, beam: int) -> DataFrame:
    """q, ids, scores: the best nodes found from each node of ``queries`` (column q), itself among them."""
    kind = points.schema["x"].dataType.simpleString()
    columns = f"q bigint, x {kind}, ids array<bigint>, scores array<double>, open array<boolean>"

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, one = _matrix(batch.column(1), width), np.ones(batch.num_rows, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), _lists(batch.column(0).to_numpy(), one, pa.int64()),
                 _lists(dots(x, x), one, pa.float64()), _lists(one.astype(bool), one, pa.bool_())],
                names=["q", "x", "ids", "scores", "open"])

    started = queries.join(points.select(F.col("node").alias("q"), "x"), "q").select("q", "x").mapInArrow(begin, columns)
    state = staged(started, "state")
    cells = points.select(F.shiftright("node", CELL_BITS).alias("cell"), "node", "x")
    nothing = F.lit(None)
    while not state.where(F.exists("open", lambda x: x)).isEmpty():
        at = F.explode(F.filter(F.arrays_zip("ids", "open"), lambda e: e["open"])).alias("e")
        wanted = state.select("q", at).select("q", F.col("e.ids").alias("node")).join(graph, "node").select(
            "q", nothing.cast(kind).alias("x"), F.col("others").alias("ids"), nothing.cast("array<double>").alias("scores"))
        asked = _requests(state.drop("open").unionByName(wanted), beam, kind)
        found = asked.groupBy("cell").cogroup(cells.groupBy("cell")).applyInArrow(_scored(width), FOUND)
        held = state.withColumn("open", F.transform("open", lambda x: F.lit(False)))
        found = found.withColumn("x", nothing.cast(kind))
        state, done = staged(_best(held.unionByName(found), beam, columns), "state"), state
        released(done)
    return state.select("q", "ids", "scores")


def nearest(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
            degree: int = DEGREE, sample: int = SAMPLE, beam: int = BEAM, fresh_share: float = FRESH_SHARE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` nearest found of each row that ``is_query`` marks.

    ``is_query`` is a condition on the column ``id``.
    """
    degree, beam = max(degree, k + 1), max(beam, k + 1)
    rows, found, number, width, peak = distinct_vectors(vectors, id_col, vec_col)
    points = numbered_nodes(found, number, width, peak)
    of_hash = points.select("hash", "node")
    asking = rows.where(is_query).select("id", "row", "hash")
    counts = asking.groupBy("hash").agg(F.count("*").alias("asking"))
    counts = staged(counts.join(of_hash, "hash").select(F.col("node").alias("q"), "hash", "asking"), "asking")
    graph = adjacency(neighbour_graph(points, degree, sample, fresh_share, number), degree)
    state = greedy_search(points, graph, counts.select("q"), width, beam)
    least = Window.partitionBy("hash").orderBy(F.asc_nulls_last("id"), "row")
    members = rows.select("hash", "id", "row").withColumn("place", F.row_number().over(least)).where(
        F.col("place") <= k + 1).join(of_hash, "hash").select("node", "id", "row")
    entry = F.explode(F.arrays_zip("ids", "scores")).alias("e")
    hits = state.select("q", entry).select("q", F.col("e.ids").alias("node"), F.col("e.scores").alias("score"))
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    ranked = hits.join(members, "node").withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    best = ranked.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("place", "id", "row", "score"))).alias("best"))
    per_hash = staged(best.join(counts, "q").select("hash", "best", "asking"), "answers")
    answered = left_join_by_key(asking, per_hash, "hash", "asking")
    others = F.slice(F.filter("best", lambda e: e["row"] != F.col("row")), 1, k)
    return answered.select(F.col("id").alias("query_id"), F.posexplode(others).alias("at", "e")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("e.id").alias(id_col), F.col("e.score").alias("score"))
