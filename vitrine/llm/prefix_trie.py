"""Prefix trie of rebuilt conversations, by a van Emde Boas recursion.

A conversation is a sequence of turns, and a node of the trie stands for all conversations that begin alike. The
recursion cuts all sequences at half the depth: what stands above the cut is the upper trie, and the lower halves
below each cut prefix are a forest of their own.  Upper trie and forests have half the depth and are cut
again, all of them in one job per level, so a trie of depth D takes log D levels, and no sequence is ever held whole.

* Going up, names of runs of 1, 2, 4, ... turns are made of the names of their halves.
* Going down, a cut prefix is named by the prefix at the cut above it and the run between them; after the last level
  every prefix of every conversation has its name (128 bits of SHA-256).
* Totals are grafted: within one turn a node's total is its own; two levels of half the depth become one when each root of a
  lower forest gives its total to the node that it hangs on and to that node's ancestors in the upper trie.

Hot groups: turns are numbered by a range sort, whose tasks number what they hold and add what stood in front of it, so a
conversation may span any number of tasks; lookups by conversation are cut into runs of CHUNK places; counts and
totals of a node combine before they are shuffled; ids that end in one node are written as runs of text by tasks that hold
a range of them, and hashed run by run.

Null roles and texts are empty.  Turns come by number, null first; equal numbers of one conversation stand in the order of
the hashes of role and text (any fixed order), and rows that are repeated are turns each.  Rows without a conversation id
belong to none and play no part.  A turn may be of any length: only its hash and its length move.  An
empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.grouped import groups, schema_of
from vitrine.session import materialize

#: most turns that are taken from the conversation that begins a hundred, plus one; size of such a group
HEADS, HUNDRED = 6, 100
#: places of one conversation that one lookup key covers, ids of one run of text
CHUNK, RUN = 1 << 14, 4_096


def name_of(*parts: Column) -> Column:
    """128 bits of the SHA-256 of binary parts of fixed size."""
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def _turns(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, token, size, n): hash of role and text, code points of the text, and how often the row stands there."""
    r, t = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    token = F.unhex(F.substring(F.sha2(F.concat(F.octet_length(r).cast("string"), F.lit(":"), r, t).cast("binary"), 256), 1, 32))
    rows = conversations.select(
        F.col(conv_id).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), token.alias("token"), F.length(t).cast("long").alias("size"))
    return rows.where("conv IS NOT NULL").groupBy("conv", "turn", "token", "size").agg(F.count("*").alias("n"))


def _numbered(turns: DataFrame) -> DataFrame:
    """(conv, place from 1, token, size) of all turns, in order."""
    ddl = "conv long, token binary, size long, n long, task int, until long"
    schema = schema_of(ddl)

    def number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, conv, total = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, n = batch.column("conv").to_numpy(), batch.column("n").to_numpy()
            until = np.cumsum(n)
            first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
            until -= np.repeat(until[first] - n[first], np.diff(np.r_[first, len(ids)]))
            if ids[0] == conv:
                until[: first[1] if len(first) > 1 else len(ids)] += total
            conv, total = ids[-1], int(until[-1])
            yield pa.RecordBatch.from_pydict({
                "conv": batch.column("conv"), "token": batch.column("token"), "size": batch.column("size"), "n": batch.column("n"),
                "task": np.full(len(ids), task, dtype=np.int32), "until": until}, schema=schema)

    ordered = turns.repartitionByRange("conv", F.col("turn").asc_nulls_first(), "token").sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "token")
    placed = materialize(ordered.mapInArrow(number, ddl), "trie-numbered")
    # only conversations that span tasks have turns in front of a task's: at most two of each task
    ends = placed.groupBy("conv", "task").agg(F.max("until").alias("held"))
    spans = ends.join(ends.groupBy("conv").agg(F.count("*").alias("tasks")).where("tasks > 1").select("conv"), "conv", "left_semi")
    before = spans.select("conv", "task", (F.sum("held").over(Window.partitionBy("conv").orderBy("task")) - F.col("held")).alias("before"))
    at = placed.join(before, ["conv", "task"], "left").withColumn("until", F.col("until") + F.coalesce("before", F.lit(0)))
    return at.select("conv", F.explode(F.sequence(F.col("until") - F.col("n") + 1, F.col("until"))).alias("place"), "token", "size")


def rebuilt(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, size) of all rebuilt conversations, and their turns (conv, d from 1, token, size)."""
    own = numbered.groupBy("conv").agg(F.max("place").alias("own"))
    heads = numbered.where((F.col("conv") % HUNDRED == 0) & (F.col("place") < HEADS)).groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("place", "token", "size"))).alias("head"))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS).cast("int")
    plan = own.withColumn("h", h).withColumn("from", F.col("conv") - F.col("conv") % HUNDRED)
    plan = plan.join(heads.withColumnRenamed("conv", "from"), "from", "left").select(
        "conv", "own", "h", F.slice(F.coalesce("head", F.array().cast("array<struct<place: long, token: binary, size: long>>")), 1, F.col("h")).alias("head"))
    plan = materialize(plan.withColumn("taken", F.size("head").cast("long")), "trie-plan")
    chunks = plan.select("conv", "h", "taken", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("own") - 1) / CHUNK).cast("long"))).alias("chunk"))
    kept = numbered.withColumn("chunk", F.floor((F.col("place") - 1) / CHUNK).cast("long")).join(chunks, ["conv", "chunk"]).where("place > h").select(
        "conv", (F.col("place") - F.col("h") + F.col("taken")).alias("d"), "token", "size")
    first = plan.select("conv", F.posexplode("head").alias("p", "x")).select("conv", (F.col("p") + 1).cast("long").alias("d"), "x.token", "x.size")
    sizes = plan.select("conv", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("size"))
    return sizes, first.unionByName(kept)


def named(sizes: DataFrame, turns: DataFrame, levels: int) -> DataFrame:
    """(conv, d, name, size) of every prefix of every conversation, the empty one (d = 0) included."""
    # up: names of runs of 2^k turns that begin at multiples of their length
    runs = [turns.select("conv", (F.col("d") - 1).alias("j"), F.col("token").alias("name"))]
    for k in range(1, levels):
        odd = F.col("j") % 2
        whole = runs[-1].groupBy("conv", F.floor(F.col("j") / 2).cast("long").alias("j2")).agg(
            F.max(F.when(odd == 0, F.col("name"))).alias("a"), F.max(F.when(odd == 1, F.col("name"))).alias("b"))
        runs.append(materialize(whole.where("a IS NOT NULL AND b IS NOT NULL").select("conv", F.col("j2").alias("j"), name_of(F.col("a"), F.col("b")).alias("name")), f"trie-runs-{k}"))
    # down: the prefix in the middle of two cuts, from the one above it and the run that leads there
    cuts = sizes.select("conv", F.lit(0).cast("long").alias("d"), name_of(F.lit(b"")).alias("name"))
    for k in reversed(range(levels)):
        step = 1 << k
        next_ = cuts.withColumn("j", F.floor(F.col("d") / step).cast("long")).join(runs[k].withColumnRenamed("name", "run"), ["conv", "j"])
        cuts = materialize(cuts.unionByName(next_.select("conv", (F.col("d") + step).alias("d"), name_of(F.col("name"), F.col("run")).alias("name"))), f"trie-cuts-{k}")
    return materialize(cuts.join(turns.select("conv", "d", "size"), ["conv", "d"], "left").select("conv", "d", "name", F.coalesce("size", F.lit(0)).alias("size")), "trie-names")


def graft(nodes: DataFrame, names: DataFrame, levels: int) -> DataFrame:
    """(name, n_leaves, saved_tokens) of every node, from its own ``leaf`` and ``saved``.

    At level k a total covers the node's subtree inside its run of 2^k depths.  The roots of the lower runs of each pair
    give theirs to the node above the cut, and all ancestors of that node in the upper run take them over.
    """
    totals = nodes.select("name", "parent", "conv_id", "depth", F.col("leaf").alias("leaves"), F.col("saved").alias("tokens"))
    for k in range(levels):
        step = 1 << k
        # d - 1 is the place in the recursion: a lower run begins at an odd multiple of the step
        roots = totals.where((F.col("depth") - 1) % (2 * step) == step)
        given = roots.groupBy(F.col("parent").alias("name")).agg(F.sum("leaves").alias("leaves"), F.sum("tokens").alias("tokens"))
        if k:
            cut = materialize(given.join(nodes.select("name", "conv_id", "depth"), "name"), "trie-cut")
            size = min(step, CHUNK)
            first = F.col("depth") - step  # places of the upper run, from its first to the cut
            pieces = cut.select("conv_id", "leaves", "tokens", F.explode(F.sequence(F.floor(first / size).cast("long"), F.floor((F.col("depth") - 1) / size).cast("long"))).alias("piece"))
            path = names.where("d > 0").select(F.col("conv").alias("conv_id"), F.floor((F.col("d") - 1) / size).cast("long").alias("piece"), "name")
            given = pieces.join(path, ["conv_id", "piece"]).groupBy("name").agg(F.sum("leaves").alias("leaves"), F.sum("tokens").alias("tokens"))
        more = given.select("name", F.col("leaves").alias("l"), F.col("tokens").alias("t"))
        totals = materialize(totals.join(more, "name", "left").select(
            "name", "parent", "conv_id", "depth", (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"),
            (F.col("tokens") + F.coalesce("t", F.lit(0))).alias("tokens")), "trie-totals")
    # the root stands above all runs: it takes what its children have
    top = totals.where("depth = 1").agg(F.sum("leaves").alias("l"), F.sum("tokens").alias("t"))
    root = totals.where("depth = 0").crossJoin(F.broadcast(top)).select(
        "name", (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"), (F.col("tokens") + F.coalesce("t", F.lit(0))).alias("saved_tokens"))
    return totals.where("depth > 0").select("name", F.col("leaves").alias("n_leaves"), F.col("tokens").alias("saved_tokens")).unionByName(root)


def ends_digest(ends: DataFrame) -> DataFrame:
    """(name, ends_sha256) from (name, conv): SHA-256 of the ascending decimal ids of each name, comma-joined.

    Tasks that hold a range of all (name, id) write runs of text; the runs of a name are hashed one after another.
    """
    run_ddl, out_ddl = "name binary, first long, text string", "name binary, ends_sha256 string"
    run_schema, out_schema = schema_of(run_ddl), schema_of(out_ddl)

    def write(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            names, ids = batch.column("name").to_pylist(), batch.column("conv").to_pylist()
            out: dict = {"name": [], "first": [], "text": []}
            i = 0
            while i < len(ids):
                j = i + 1
                while j < len(ids) and j - i < RUN and names[j] == names[i]:
                    j += 1
                out["name"].append(names[i])
                out["first"].append(ids[i])
                out["text"].append(",".join(map(str, ids[i:j])))
                i = j
            yield pa.RecordBatch.from_pydict(out, schema=run_schema)

    def digest(batches):
        name, state = None, None
        done: dict = {"name": [], "ends_sha256": []}
        for batch in batches:
            for own, text in zip(batch.column("name").to_pylist(), batch.column("text").to_pylist()):
                if own != name:
                    if state is not None:
                        done["name"].append(name)
                        done["ends_sha256"].append(state.hexdigest())
                    name, state = own, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            if len(done["name"]) > 10_000:
                yield pa.RecordBatch.from_pydict(done, schema=out_schema)
                done = {"name": [], "ends_sha256": []}
        if state is not None:
            done["name"].append(name)
            done["ends_sha256"].append(state.hexdigest())
        yield pa.RecordBatch.from_pydict(done, schema=out_schema)

    runs = ends.repartitionByRange("name", "conv").sortWithinPartitions("name", "conv").mapInArrow(write, run_ddl)
    return runs.repartition("name").sortWithinPartitions("name", "first").mapInArrow(digest, out_ddl)


def trie(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node."""
    numbered = materialize(_numbered(materialize(_turns(conversations, conv_id, turn, role, text), "trie-turns")), "trie-places")
    sizes, turns = rebuilt(numbered)
    sizes, turns = materialize(sizes, "trie-sizes"), materialize(turns, "trie-rebuilt")
    deepest = sizes.agg(F.max("size")).first()[0] or 0
    levels = int(deepest).bit_length()  # the cuts above a prefix are the ones of its depth, written in binary
    names = named(sizes, turns, levels)
    nodes = names.groupBy("name").agg(F.min("conv").alias("conv_id"), F.min("d").alias("depth"), F.count("*").alias("n_convs"), F.min("size").alias("size"))
    # the parent of a node is the prefix of its smallest member that is one turn shorter
    above = names.select(F.col("conv").alias("conv_id"), (F.col("d") + 1).alias("depth"), F.col("name").alias("parent"))
    nodes = materialize(nodes.join(above, ["conv_id", "depth"], "left"), "trie-nodes")
    children = nodes.where("parent IS NOT NULL").groupBy("parent").agg(F.count("*").alias("n_children")).withColumnRenamed("parent", "name")
    nodes = materialize(nodes.join(children, "name", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))).select(
        "*", (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("size")).alias("saved")), "trie-children")
    parents = nodes.where("n_children > 0").select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    ends = names.join(sizes.select("conv", F.col("size").alias("d")), ["conv", "d"], "left_semi").select("name", "conv")
    nothing = hashlib.sha256(b"").hexdigest()
    out = nodes.join(graft(nodes, names, levels), "name").join(ends_digest(ends), "name", "left").join(parents, "parent", "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))
