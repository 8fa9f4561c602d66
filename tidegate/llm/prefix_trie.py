"""The trie of conversation prefixes, without building a trie.

Conversations are rebuilt: some start with the first turns of a shared conversation. A sequence
of turns is known by the XOR of 128-bit hashes of (position, role, text), so the hash of every
prefix is a running XOR, which can be computed in parts. Then:

* identical conversations collapse into one weighted sequence with the list of those ending there;
* sequences that are a proper prefix of another one are dropped by an anti-join, which leaves the
  leaves;
* prefixes of the remaining weighted sequences are aggregated into nodes. A node belongs to the
  sequence of its smallest member; sums over a subtree are sums of what sequences own from there
  to their ends, so no step walks from level to level.

Joins go by (conversation, part of it) or by (node, its one owner), which no key makes hot;
parents with very many children are fewer than SHARE and broadcast.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.scans import PART, part_totals, running, spread
from tidegate.llm.shared import col, tasks, written

WORD = r"[^\x20\x09-\x0D]+"
FAMILY = 20  # conversations that share their first one's opening
OPENINGS = 4  # an opening has 0 to 3 turns
SHARE = 1000  # parents of at least one of so many nodes are broadcast
NOBODY = hashlib.sha256(b"").hexdigest()
NODE = ["depth", "h1", "h2"]


def opening_turns(conv: Column) -> Column:
    return F.crc32(conv.cast("string").cast("binary")) % OPENINGS


def _placed(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Turns with their position in their conversation, and the conversations' parts."""
    rows = turns.where(col(conv).isNotNull()).select(
        col(conv).cast("long").alias("conv"), col(turn).alias("turn"),
        F.coalesce(col(role), F.lit("")).alias("role"), F.coalesce(col(text), F.lit("")).alias("text"),
    )
    rows = rows.select(
        "*", F.xxhash64("role", "text").alias("x1"), F.xxhash64(F.lit(1), "text", "role").alias("x2"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
    )
    rows = spread(rows, "conv", ["turn", "role", "text"], ["x1", "x2", "words"]).withColumn("one", F.lit(1).cast("long"))
    return rows, part_totals(rows, "conv", {"n": F.sum("one")})


def rebuilt(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"):
    """Conversations (``conv``), and the turns of each after rebuilding: ``conv``, ``d`` (from 1),
    hash lanes ``g1``, ``g2`` of (position, role, text), ``words``."""
    rows, parts = _placed(turns, conv, turn, role, text)
    parts = written(parts, "parts")
    convs = parts.groupBy("conv").agg(F.sum("n").alias("size"))
    convs = convs.select("conv", "size", (F.col("conv") - F.col("conv") % FAMILY).alias("base"),
                         opening_turns(F.col("conv")).alias("h"))
    lent = convs.select(F.col("conv").alias("base"), F.col("size").alias("lent"))
    convs = convs.join(lent, "base", "left").select(
        "conv", "base", "h", F.least("h", F.coalesce("lent", F.lit(0).cast("long"))).alias("k")
    )
    convs = written(convs, "conversations")
    placed = running(rows, parts.join(convs, "conv"), "conv", {"n": "one"}).withColumnRenamed("run_n", "place")
    placed = written(placed.select("conv", "place", "h", "k", "x1", "x2", "words"), "placed")
    heads = placed.where((F.col("conv") % FAMILY == 0) & (F.col("place") < OPENINGS))
    heads = heads.select(F.col("conv").alias("base"), F.col("place").alias("d"), "x1", "x2", "words")
    opened = convs.join(heads, "base").where(F.col("d") <= F.col("k")).select("conv", "d", "x1", "x2", "words")
    own = placed.where(F.col("place") > F.col("h")).select(
        "conv", (F.col("place") - F.col("h") + F.col("k")).alias("d"), "x1", "x2", "words"
    )
    lanes = opened.unionByName(own).select(
        "conv", "d", F.xxhash64("d", "x1", "x2").alias("g1"), F.xxhash64(F.lit(1), "d", "x2", "x1").alias("g2"), "words"
    )
    return convs.select("conv"), lanes


def collapsed(ends: DataFrame) -> DataFrame:
    """One row per distinct whole sequence (``depth``, ``h1``, ``h2``): ``weight``, the smallest
    conversation ``rep`` and the digest of the list of all that end here.

    The digest follows a sorted list, so it is made by one task, which holds one row at a time.
    """
    names = ["depth", "h1", "h2", "weight", "rep", "ends_sha256"]

    def run(batches):
        now, state, count, first = None, None, 0, 0
        out: list[tuple] = []

        def batch():
            rows, out[:] = list(out), []
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], pa.string() if i == 5 else pa.int64()) for i in range(6)], names
            )

        for part in batches:
            for *key, conv in zip(*[c.to_pylist() for c in part.columns]):
                if key != now:
                    if now:
                        out.append((*now, count, first, state.hexdigest()))
                    now, state, count, first = key, hashlib.sha256(str(conv).encode()), 1, conv
                else:
                    state.update(f",{conv}".encode())
                    count += 1
            if len(out) >= 10_000:
                yield batch()
        if now:
            out.append((*now, count, first, state.hexdigest()))
        yield batch()

    sorted_ends = ends.select(*NODE, "conv").repartition(tasks(ends), *NODE).sortWithinPartitions(*NODE, "conv")
    schema = "depth long, h1 long, h2 long, weight long, rep long, ends_sha256 string"
    return sorted_ends.mapInArrow(run, schema)


def trie(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per node but the root is told apart by ``depth`` 0; see ``trie_report``."""
    convs, lanes = rebuilt(turns, conv, turn, role, text)
    rows = spread(lanes, "conv", ["d"], ["d", "g1", "g2", "words"])
    parts = written(part_totals(rows, "conv", {
        "xor1": F.bit_xor("g1"), "xor2": F.bit_xor("g2"), "n": F.count(F.lit(1)),
    }), "parts")
    whole = parts.groupBy("conv").agg(F.sum("n").alias("depth"), F.bit_xor("xor1").alias("h1"), F.bit_xor("xor2").alias("h2"))
    zero = F.lit(0).cast("long")
    ends = convs.join(whole, "conv", "left").select("conv", *[F.coalesce(c, zero).alias(c) for c in NODE])
    sequences = written(collapsed(ends), "sequences")

    # prefixes of each distinct sequence, read from the conversation that stands for it
    chosen = parts.join(sequences.where("depth > 0").select(
        F.col("rep").alias("conv"), "weight", F.col("depth").alias("length")), "conv")
    prefixes = running(rows, chosen, "conv", {"xor1": "g1", "xor2": "g2"})
    prefixes = written(prefixes.select(
        "conv", PART, F.col("d").alias("depth"), F.col("run_xor1").alias("h1"), F.col("run_xor2").alias("h2"),
        F.col("run_xor1").bitwiseXOR(F.col("g1")).alias("p1"), F.col("run_xor2").bitwiseXOR(F.col("g2")).alias("p2"),
        "words", "weight", "length", F.col("_place"),
    ), "prefixes")
    inner = prefixes.where(F.col("depth") < F.col("length")).select(*NODE)
    leaves = sequences.where("depth > 0").join(inner, NODE, "left_anti").select(F.col("rep").alias("conv"))
    leaf_parts = parts.select("conv", PART).join(leaves, "conv").withColumn("leaf", F.lit(1).cast("long"))
    nodes = prefixes.join(leaf_parts, ["conv", PART], "left").groupBy(*NODE).agg(
        F.sum("weight").alias("n_convs"), F.min("conv").alias("conv_id"), F.sum(F.coalesce("leaf", zero)).alias("n_leaves"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.max("words").alias("words"),
    )
    nodes = written(nodes.withColumn("saving", (F.col("n_convs") - 1) * F.col("words")), "nodes")

    # each node's saving lies with its owner; a sequence's part of a subtree is a backward sum
    owned = prefixes.select("conv", PART, "_place", *NODE).join(
        nodes.select(*NODE, F.col("conv_id").alias("conv"), "saving"), [*NODE, "conv"], "left"
    ).withColumn("saving", F.coalesce("saving", zero))
    owned = written(owned, "owned")
    later = part_totals(owned, "conv", {"saving": F.sum("saving")}, backward=True).withColumnRenamed("saving", "part_saving")
    below = running(owned, later, "conv", {"saving": "saving"}, backward=True)
    saved = below.groupBy(*NODE).agg(F.sum("run_saving").alias("saved_tokens"))

    kids = written(nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("h1"), F.col("p2").alias("h2"))
                   .agg(F.count(F.lit(1)).alias("n_children")), "kids")
    figures = [
        sequences.agg(
            F.sum("weight").alias("n_convs"), F.min("rep").alias("conv_id"), F.max("depth").alias("deepest"),
            F.max(F.when(F.col("depth") == 0, F.col("ends_sha256"))).alias("ends_sha256"),
        ),
        nodes.agg(F.sum("saving").alias("saved_tokens")),
        kids.where("depth = 0").agg(F.sum("n_children").alias("n_children")),
        leaves.agg(F.count(F.lit(1)).alias("n_leaves")),
    ]
    root = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), figures)
    root = root.agg(*[F.max(name).alias(name) for name in root.columns]).where("n_convs IS NOT NULL").select(
        "conv_id", zero.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs",
        F.coalesce("n_children", zero).alias("n_children"),
        F.when(F.col("deepest") == 0, F.lit(1).cast("long")).otherwise(F.col("n_leaves")).alias("n_leaves"),
        F.coalesce("saved_tokens", zero).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NOBODY)).alias("ends_sha256"),
    )
    smallest = sequences.agg(F.min("rep")).first()[0]  # the root's, which is no row of the nodes

    up = nodes.select(*NODE, "conv_id", (F.col("depth") - 1).alias("up"), "p1", "p2")
    above = kids.join(nodes.select(*NODE, F.col("conv_id").alias("parent_conv_id")), NODE, "left")
    above = written(above.select(
        F.col("depth").alias("up"), F.col("h1").alias("p1"), F.col("h2").alias("p2"), "n_children",
        F.coalesce("parent_conv_id", F.lit(smallest).cast("long")).alias("parent_conv_id"),
    ), "above")
    count = nodes.count()
    busy = above.where(F.col("n_children") * SHARE >= count).drop("n_children")  # at most SHARE rows
    rest = above.where(F.col("n_children") * SHARE < count).drop("n_children")
    by = ["up", "p1", "p2"]
    parents = up.join(F.broadcast(busy), by).unionByName(
        up.join(F.broadcast(busy), by, "left_anti").join(rest, by)
    ).select(*NODE, "parent_conv_id")
    made = nodes.select(*NODE, "conv_id", "n_convs", "n_leaves").join(saved, NODE).join(parents, NODE)
    made = made.join(kids, NODE, "left").join(sequences.select(*NODE, "ends_sha256"), NODE, "left")
    return made.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"),
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NOBODY)).alias("ends_sha256"),
    ).unionByName(root)


def trie_report(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: ``conv_id``, ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    Turns are ordered by turn (null first), then role and text; repeated rows are turns of their
    own. A null role or text is empty. Rows without a conversation id belong to none and are left
    out; ids are divided as SQL does, towards zero. An empty table gives no rows, and
    conversations without a turn end at the root. Further columns are ignored.
    """
    return trie(conversations)
