"""Approximate nearest neighbours by NN-descent and greedy graph search, largest inner product first.

Rows with one vector are one node (the smallest id stands for it), so copies cost nothing and their links are kept.
Vectors are divided by the largest norm and get one more coordinate, which makes all norms equal
to one: neighbours of the graph are then the same by angle, distance and inner product, and a query, whose
own further coordinate is zero, still ranks nodes by its inner product with the vectors as they were.

The graph begins with a few forests of random hyperplanes: a leaf of bounded size (larger ones are dealt at random)
gives each of its nodes its best neighbours there.  Then rounds of NN-descent join neighbours of
neighbours: nodes are held in blocks, a block fetches the vectors of all neighbours of its nodes once, and every two
neighbours of a node are compared; a pair goes on only if it beats the worst neighbour that one of
them has.  Rounds end when few neighbours change.

A query enters at the best of a bounded set of nodes, and at its own node if it is a row of the table.  It keeps the
best nodes that it has seen, looks at the neighbours of those that it hasn't looked at yet, and stops when
there are none.  The best of what it found are ranked again by their vectors as they were, in double precision.

All lists are bounded by parameters of the method (neighbours of a node, nodes that a query keeps); every row is in the graph.

Vectors that are null, empty, zero or hold null or non-finite entries take no part, nor do rows without an id, as a
result could not name them.  Shorter vectors count as ended by zeros.  Rows that repeat an id with one vector are one row, with
another vector a row of their own.  Ties go to the smaller id.  An empty table gives an empty
result; other columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.grouped import lists, map_groups, schema_of, vectors
from vitrine.session import materialize

#: neighbours of a node, further ways to nodes of which it is a neighbour, forests, nodes of a leaf
DEGREE, REVERSE, FORESTS, LEAF = 32, 16, 6, 4_096
#: leaves of a block of descent, as a power of two
COARSE = 2
#: most rounds of descent, and the share of all neighbours that has to change for another one
ROUNDS, STILL = 4, 0.1
#: nodes that a query keeps, rounds of its search, nodes that it ranks by exact products, nodes where queries enter
BEAM, STEPS, EXACT, ENTRIES = 128, 8, 48, 512
#: queries of one block, and vectors that it holds at once
BATCH, HELD = 2_048, 65_536

_NODE = "node long, code array<long>, near binary"


def usable(column: pa.ChunkedArray | pa.Array) -> list[np.ndarray | None]:
    """Vectors as doubles, None for those that take no part."""
    out: list[np.ndarray | None] = []
    for v in column:
        x = None
        if v.is_valid and len(v.values) and not v.values.null_count:
            x = v.values.to_numpy(zero_copy_only=False).astype("<f8") + 0.0
            x = x if np.isfinite(x).all() and x.any() else None
        out.append(x)
    return out


def classes(rows: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(id, vector: packed doubles, size, norm) of every row that takes part, each (id, vector) once."""
    schema = schema_of("id long, vector binary, size int, norm double")

    def run(batches):
        for batch in batches:
            found = usable(batch.column("v"))
            keep = [i for i, x in enumerate(found) if x is not None]
            ids = batch.column("id")
            yield pa.RecordBatch.from_pydict({
                "id": [ids[i].as_py() for i in keep], "vector": [found[i].tobytes() for i in keep],
                "size": [len(found[i]) for i in keep], "norm": [float(np.sqrt(np.square(found[i] / np.abs(found[i]).max()).sum()) * np.abs(found[i]).max()) for i in keep],
            }, schema=schema)

    source = rows.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).alias("v")).where("id IS NOT NULL")
    return source.mapInArrow(run, "id long, vector binary, size int, norm double").distinct()


def unit(packed: list[bytes], size: int, norm: float, further: bool) -> np.ndarray:
    """Packed vectors over the largest norm, with one more coordinate that makes them unit vectors (or zero)."""
    out = np.zeros((len(packed), size + 1), dtype=np.float64)
    for i, p in enumerate(packed):
        v = np.frombuffer(p, dtype="<f8")
        out[i, : len(v)] = v / norm
    if further:
        out[:, size] = np.sqrt(np.maximum(0.0, 1.0 - np.square(out).sum(axis=1)))
    return out


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest scores of every row."""
    return np.argpartition(-scores, k - 1, axis=1)[:, :k] if k < scores.shape[1] else np.broadcast_to(np.arange(scores.shape[1]), scores.shape)


LINKS = "u long, w array<long>, score array<float>"


def per_node(u: np.ndarray, w: np.ndarray, score: np.ndarray, degree: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the ``degree`` best distinct w of every u (u rising, best first, ties to the smaller w), and where each u begins."""
    order = np.lexsort((w, -score, u))
    # of equal (u, w) only the best stays
    by = np.lexsort((-score, w, u))
    twin = np.zeros(len(u), dtype=bool)
    twin[by[1:]] = (u[by[1:]] == u[by[:-1]]) & (w[by[1:]] == w[by[:-1]])
    order = order[~twin[order]]
    first = np.flatnonzero(np.r_[True, u[order][1:] != u[order][:-1]]) if len(order) else np.zeros(0, dtype=int)
    place = np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)]))
    order = order[place < degree]
    return order, np.flatnonzero(np.r_[True, u[order][1:] != u[order][:-1]]) if len(order) else np.zeros(0, dtype=int)


def as_lists(values: np.ndarray, first: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[first, len(values)], pa.int32()), pa.array(values, kind))


def seeds(nodes: DataFrame, leaves: DataFrame, degree: int) -> DataFrame:
    """(u, w, score): lists of the best neighbours of each node in each of its leaves."""

    def leaf(table: pa.Table):
        ids, x = table["node"].to_numpy(), vectors(table["near"], "<f4")
        k = min(degree, len(ids) - 1)
        for a in range(0, len(ids) if k > 0 else 0, 512):
            s = x[a : a + 512] @ x.T
            s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
            at = best(s, k)
            cuts = np.arange(0, at.size, k)
            yield {"u": ids[a : a + 512], "w": as_lists(ids[at].ravel(), cuts, pa.int64()), "score": as_lists(np.take_along_axis(s, at, 1).ravel(), cuts, pa.float32())}

    return map_groups(leaves.join(nodes.select("node", "near"), "node").select("leaf", "node", "near"), "leaf", ["node"], LINKS, leaf)


def keep_best(links: DataFrame, degree: int, known: DataFrame | None = None) -> DataFrame:
    """(node, near_ids, scores, worst, fresh): the ``degree`` best of all lists of every node; ``fresh`` are not in ``known``.

    A task holds one batch and the best of the node that the next batch may go on with.
    """
    ddl = "node long, near_ids array<long>, scores array<float>, worst float, fresh long"
    schema = schema_of(ddl)
    rows = links.withColumn("old", F.lit(False))
    if known is not None:
        rows = rows.unionByName(known.select(F.col("node").alias("u"), F.col("near_ids").alias("w"), F.col("scores").alias("score"), F.lit(True).alias("old")))

    def merged(held):
        u, w, score, old = (np.concatenate(x) for x in held)
        # what is known already comes first among twins, so that it doesn't count as fresh
        by = np.lexsort((~old, w, u))
        twin = np.r_[False, (u[by[1:]] == u[by[:-1]]) & (w[by[1:]] == w[by[:-1]])]
        start = np.maximum.accumulate(np.where(twin, 0, np.arange(len(by))))
        old[by] = old[by][start]
        order, first = per_node(u, w, score, degree)
        return u[order], w[order], score[order], old[order], first

    def table(u, w, score, old, first):
        ends = np.r_[first[1:], len(u)] - 1
        full = ends - first + 1 >= degree
        counts = np.add.reduceat(~old, first) if len(first) else np.zeros(0)
        return pa.RecordBatch.from_arrays([
            pa.array(u[first]), as_lists(w, first, pa.int64()), as_lists(score, first, pa.float32()),
            pa.array(np.where(full, score[ends], -np.inf).astype(np.float32)), pa.array(counts.astype(np.int64))], schema=schema)

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            of, w = lists(pa.chunked_array([batch.column("w")]))
            new = batch.column("u").to_numpy()[of], w, lists(pa.chunked_array([batch.column("score")]))[1], batch.column("old").to_numpy(zero_copy_only=False)[of]
            if not len(of):
                continue
            u, w, score, old, first = merged([[x, y] for x, y in zip(held, new)] if held else [[x] for x in new])
            cut = first[-1]
            if cut:
                yield table(u[:cut], w[:cut], score[:cut], old[:cut], first[:-1])
            held = u[cut:], w[cut:], score[cut:], old[cut:]
        if held:
            yield table(*held, np.zeros(1, dtype=int))

    return rows.repartition("u").sortWithinPartitions("u").mapInArrow(run, ddl)


def descend(nodes: DataFrame, graph: DataFrame, blocks: DataFrame, degree: int) -> DataFrame:
    """(u, w, score): lists of neighbours of neighbours that beat the worst neighbour of u, the best of every block."""
    here = graph.join(blocks, "node").select("block", "node", "near_ids")
    need = here.select("block", F.explode("near_ids").alias("item")).distinct()
    of = nodes.select("node", "near").join(graph.select("node", "worst"), "node").withColumnRenamed("node", "item")
    items = need.join(of, "item")
    rows = here.select("block", F.lit(1).alias("kind"), "node", "near_ids", F.lit(None).cast("binary").alias("near"), F.lit(0.0).cast("float").alias("worst")).unionByName(
        items.select("block", F.lit(0).alias("kind"), F.col("item").alias("node"), F.array().cast("array<long>").alias("near_ids"), "near", "worst"))

    def block(table: pa.Table):
        n = int((table["kind"].to_numpy() == 0).sum())
        ids, x, worst = table["node"][:n].to_numpy(), vectors(table["near"][:n], "<f4"), table["worst"][:n].to_numpy()
        of, item = lists(table["near_ids"][n:])
        item = np.searchsorted(ids, item)
        found, held = [], 0
        for at in np.split(item, np.flatnonzero(np.diff(of)) + 1):
            s = x[at] @ x[at].T
            better = s > worst[at][:, None]
            np.fill_diagonal(better, False)
            i, j = np.nonzero(better)
            found.append((at[i], at[j], s[i, j]))
            held += len(i)
            if held > 1_000_000:
                yield once(found, ids)
                found, held = [], 0
        if found:
            yield once(found, ids)

    def once(found: list, ids: np.ndarray) -> dict:
        u, w, score = (np.concatenate(x) for x in zip(*found))
        order, first = per_node(ids[u], ids[w], score, degree)
        return {"u": ids[u[order[first]]], "w": as_lists(ids[w[order]], first, pa.int64()), "score": as_lists(score[order], first, pa.float32())}

    return map_groups(rows, "block", ["kind", "node"], LINKS, block)


class Index:
    """All rows (id, vector), the nodes (node, near, code), their members (node, id), exact vectors (node, vector) and neighbours (node, near_ids)."""

    def __init__(self, rows: DataFrame, nodes: DataFrame, members: DataFrame, graph: DataFrame, size: int, norm: float, entries: tuple[np.ndarray, np.ndarray]) -> None:
        self.rows = rows
        self.nodes, self.members, self.graph, self.size, self.norm, self.entries = nodes, members, graph, size, norm, entries


def build(
    rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", members: int = 21,
    degree: int = DEGREE, reverse: int = REVERSE, forests: int = FORESTS, leaf: int = LEAF, rounds: int = ROUNDS, still: float = STILL, seed: int = 7,
) -> Index | None:
    """The index of all rows; ``members`` smallest ids of a vector are kept, as many as a query can return and one. None if no row takes part."""
    known = materialize(classes(rows, vec_id, embedding), "ann-rows")
    about = known.agg(F.max("size").alias("size"), F.max("norm").alias("norm")).first()
    if about["size"] is None:
        return None
    size, norm = about["size"], about["norm"]
    by = Window.partitionBy("vector").orderBy("id")
    few = materialize(known.select("vector", "id").withColumn("k", F.row_number().over(by)).where(F.col("k") <= members), "ann-members")
    heads = few.where("k = 1").select(F.col("id").alias("node"), "vector")
    # an id that stands with several vectors names several nodes: only its first vector keeps the id as the node's name
    heads = heads.groupBy("vector").agg(F.min("node").alias("node")).withColumn("twin", F.row_number().over(Window.partitionBy("node").orderBy("vector")) - 1)
    heads = heads.select(F.when(F.col("twin") == 0, F.col("node")).otherwise(-F.abs(F.xxhash64("node", "vector"))).alias("node"), "vector")
    n = known.select("vector").distinct().count()
    bits = max(0, int(np.ceil(np.log2(max(1, n / leaf)))))
    trees = forests if bits else 1
    planes = np.random.default_rng(seed).standard_normal((size + 1, trees * bits))
    weights = 1 << np.arange(bits, dtype=np.int64)
    # the middle of the cloud, from at most ENTRIES nodes; they are also where queries enter
    sample = heads.orderBy(F.xxhash64("node"), "node").limit(ENTRIES).collect()
    entries = np.array([r["node"] for r in sample], dtype=np.int64), unit([bytes(r["vector"]) for r in sample], size, norm, True).astype(np.float32)
    middle = entries[1].mean(axis=0)
    schema = schema_of(_NODE + ", vector binary")

    def place(batches):
        for batch in batches:
            packed = batch.column("vector").to_pylist()
            x = unit(packed, size, norm, True)
            sides = ((x - middle) @ planes > 0).reshape(len(x), trees, bits)
            yield pa.RecordBatch.from_pydict({
                "node": batch.column("node"), "code": (sides @ weights if bits else np.zeros((len(x), trees), dtype=np.int64)).tolist(),
                "near": [v.tobytes() for v in x.astype("<f4")], "vector": packed,
            }, schema=schema)

    nodes = materialize(heads.mapInArrow(place, _NODE + ", vector binary"), "ann-nodes")
    codes = nodes.select("node", F.posexplode("code").alias("tree", "code"))
    count = codes.groupBy("tree", "code").agg(F.ceil(F.count("*") / leaf).alias("parts"))
    dealt = codes.join(count, ["tree", "code"]).withColumn("part", F.pmod(F.xxhash64("node", "tree"), F.col("parts")))
    leaves = materialize(dealt.select("node", "tree", F.xxhash64("tree", "code", "part").alias("leaf")), "ann-leaves")
    graph = materialize(keep_best(seeds(nodes, leaves, degree), degree), "ann-graph")
    # blocks of a few neighbouring leaves: the larger they are, the fewer vectors are fetched twice
    coarse = nodes.select("node", F.shiftright(F.get("code", F.lit(0)), COARSE).alias("code"))
    parts = coarse.groupBy("code").agg(F.ceil(F.count("*") / (leaf << COARSE)).alias("parts"))
    blocks = materialize(coarse.join(parts, "code").select("node", F.xxhash64("code", F.pmod(F.xxhash64("node"), F.col("parts"))).alias("block")), "ann-blocks")
    for _ in range(rounds if bits else 0):
        graph = materialize(keep_best(descend(nodes, graph, blocks, degree), degree, graph), "ann-graph")
        if graph.agg(F.sum("fresh")).first()[0] < still * n * degree:
            break
    # searches also go against the links, so that a node that is nobody's neighbour is found by its own
    turned = graph.select(F.explode(F.arrays_zip(F.col("near_ids").alias("u"), F.col("scores").alias("s"))).alias("x"), "node").select(
        "x.u", F.array("node").alias("w"), F.array("x.s").alias("score"))
    back = keep_best(turned, reverse).select("node", F.col("near_ids").alias("back"))
    ways = graph.join(back, "node", "left").select("node", F.array_union("near_ids", F.coalesce("back", F.array().cast("array<long>"))).alias("near_ids"))
    own = few.join(heads, "vector").select("node", "id")
    return Index(known, nodes, materialize(own, "ann-own"), materialize(ways, "ann-ways"), size, norm, entries)


def search(index: Index, queries: DataFrame, top: int = 20, beam: int = BEAM, steps: int = STEPS, exact: int = EXACT, batch: int = BATCH) -> DataFrame:
    """(query, node, score): the nodes of largest inner product of each query (query long, vector binary, own long: its node or null).

    More nodes than ``top`` come back, so that those who use it can leave some out; the exact products are of the vectors as they were.
    """
    size, norm, (at_ids, at_vectors) = index.size, index.norm, index.entries
    parts = max(1, -(-queries.count() // batch))
    state_ddl = "block long, query long, vector binary, seen array<long>, kept array<long>, scores array<float>, open array<long>"
    state_schema = schema_of(state_ddl)

    def enter(batches):
        for rows in batches:
            x = unit(rows.column("vector").to_pylist(), size, norm, False).astype(np.float32)
            s = x @ at_vectors.T
            first = best(s, min(4, len(at_ids)))
            own = rows.column("own").to_pylist()
            opened = [sorted({*at_ids[f].tolist(), *([] if o is None else [o])}) for f, o in zip(first, own)]
            yield pa.RecordBatch.from_pydict({
                "block": rows.column("block"), "query": rows.column("query"), "vector": rows.column("vector"),
                "seen": opened, "kept": [[] for _ in opened], "scores": [[] for _ in opened], "open": opened,
            }, schema=state_schema)

    state = materialize(queries.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(parts))).mapInArrow(enter, state_ddl), "ann-state")
    near = index.nodes.select("node", "near")
    nothing = {"ids": F.array().cast("array<long>"), "near": F.lit(None).cast("binary")}
    kept_columns = ["query", "vector", "seen", "kept", "scores", "open"]

    def rows_of(kind: int, df: DataFrame, **given) -> DataFrame:
        own = {"node": F.lit(None).cast("long"), **nothing, **{c: F.lit(None).cast(t) for c, t in (
            ("query", "long"), ("vector", "binary"), ("seen", "array<long>"), ("kept", "array<long>"), ("scores", "array<float>"), ("open", "array<long>"))}, **given}
        return df.select("block", F.lit(kind).alias("kind"), *[c.alias(n) for n, c in own.items()])

    def wanted(table: pa.Table):
        ids = np.unique(np.concatenate([lists(table["ids"])[1], table["node"].to_numpy()]))
        yield {"block": np.full(len(ids), table["block"][0].as_py()), "at": ids}

    def step(table: pa.Table):
        kind = table["kind"].to_numpy()
        a, b = int((kind == 0).sum()), int((kind <= 1).sum())
        asked = table.slice(0, a).to_pydict()
        looked = table["node"][a:b].to_numpy()
        of, to = lists(table["ids"][a:b])
        cut = np.searchsorted(of, np.arange(len(looked) + 1))
        q = unit(asked["vector"], size, norm, False).astype(np.float32)
        new, found = [], []
        for i in range(a):
            opened, kept = (np.array(asked[c][i], dtype=np.int64) for c in ("open", "kept"))
            rows = np.searchsorted(looked, opened)
            more = np.unique(np.concatenate([*(to[cut[r] : cut[r + 1]] for r in rows), opened[: 0 if len(kept) else None]]))
            new.append(more[~np.isin(more, kept, assume_unique=True)])
            found.append(np.zeros(len(new[-1]), dtype=np.float32))
        for c in range(b, len(kind), HELD):  # vectors come in the order of their nodes
            ids, x = table["node"][c : c + HELD].to_numpy(), vectors(table["near"][c : c + HELD], "<f4")
            for i in range(a):
                lo, hi = np.searchsorted(new[i], ids[0]), np.searchsorted(new[i], ids[-1], side="right")
                if lo < hi:
                    found[i][lo:hi] = x[np.searchsorted(ids, new[i][lo:hi])] @ q[i]
        out: dict = {name: [] for name in state_schema.names}
        for i in range(a):
            all_ = np.concatenate([np.array(asked["kept"][i], dtype=np.int64), new[i]])
            s = np.concatenate([np.array(asked["scores"][i], dtype=np.float32), found[i]])
            order = np.lexsort((all_, -s))[:beam]
            all_, s = all_[order], s[order]
            seen = np.array(asked["seen"][i], dtype=np.int64)
            opened = all_[~np.isin(all_, seen)]
            for name, value in zip(out, (table["block"][0].as_py(), asked["query"][i], asked["vector"][i], np.concatenate([seen, opened]), all_, s, opened)):
                out[name].append(value)
        yield out

    for _ in range(steps):
        look = state.select("block", F.explode("open").alias("node")).distinct().join(index.graph.select("node", F.col("near_ids").alias("ids")), "node", "left")
        look = materialize(look.withColumn("ids", F.coalesce("ids", nothing["ids"])), "ann-look")
        if look.isEmpty():
            break
        need = map_groups(look, "block", [], "block long, at long", wanted)
        vectors_ = near.withColumnRenamed("node", "at")
        rows = rows_of(0, state, **{c: F.col(c) for c in kept_columns}).unionByName(rows_of(1, look, node=F.col("node"), ids=F.col("ids"))).unionByName(
            rows_of(2, need.join(vectors_, "at"), node=F.col("at"), near=F.col("near")))
        state = materialize(map_groups(rows, "block", ["kind", "node"], state_ddl, step), "ann-state")

    # exact products of the best, and of the query's own node
    chosen = state.select("block", "query", "vector", F.slice("kept", 1, max(exact, top + 1)).alias("kept"))
    need = chosen.select("block", F.explode("kept").alias("node")).distinct().join(index.nodes.select("node", F.col("vector").alias("near")), "node")
    rows = rows_of(0, need, node=F.col("node"), near=F.col("near")).unionByName(rows_of(2, chosen, query=F.col("query"), vector=F.col("vector"), kept=F.col("kept")))

    def rank(table: pa.Table):
        a = int((table["kind"].to_numpy() == 0).sum())
        ids = table["node"][:a].to_numpy()
        packed = table["near"][:a].to_pylist()
        x = np.zeros((a, size))
        for i, p in enumerate(packed):
            x[i, : len(p) // 8] = np.frombuffer(p, dtype="<f8")
        asked = table.slice(a).to_pydict()
        for query, vector, kept in zip(asked["query"], asked["vector"], asked["kept"]):
            v = np.zeros(size)
            v[: len(vector) // 8] = np.frombuffer(vector, dtype="<f8")
            at = np.searchsorted(ids, np.array(kept, dtype=np.int64))
            yield {"query": [query] * len(kept), "node": kept, "score": (x[at] * v).sum(axis=1)}

    return map_groups(rows, "block", ["kind", "node"], "query long, node long, score double", rank)


def nearest(
    rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", every: int = 20, top: int = 20, **parameters,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` nearest other rows of every row whose id is divisible by ``every``."""
    ddl = "query_id long, rank int, vec_id long, score double"
    index = build(rows, vec_id, embedding, top + 1, **parameters)
    if index is None:
        return rows.sparkSession.createDataFrame([], ddl)
    known = index.rows.where(F.col("id") % every == 0).select("id", "vector")
    asked = materialize(known.join(index.nodes.select("node", "vector"), "vector").select("id", "node"), "ann-asked")
    queries = asked.select("node").distinct().join(index.nodes.select("node", "vector"), "node").select(F.col("node").alias("query"), "vector", F.col("node").alias("own"))
    found = materialize(search(index, queries, top), "ann-found")
    # a node stands for the smallest ids of its vector, which are one more than a query can use
    members = index.members.withColumnRenamed("node", "of")
    named = found.join(members, found["node"] == members["of"]).select("query", "node", "id", "score")
    few = named.withColumn("k", F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), "id"))).where(F.col("k") <= top + 1)
    lists_ = few.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("k", "id", "score", "node"))).alias("x"))
    own = lambda x: (x["id"] == F.col("id")) & (x["node"] == F.col("node"))
    result = asked.join(lists_, asked["node"] == lists_["query"]).select("id", F.slice(F.filter("x", lambda x: ~own(x)), 1, top).alias("x"))
    return result.select(F.col("id").alias("query_id"), F.posexplode("x").alias("p", "y")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("y.id").alias("vec_id"), F.col("y.score").alias("score"))
