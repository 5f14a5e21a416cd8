"""The trie of conversation prefixes, summed up by bands of depths."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starlattice.llm.common import stored
from starlattice.llm.turns import in_order, joined_sha256

# Depths of a band: a node explodes to at most this many ancestors.
BAND = 16
# Turns of a conversation that are summed in one task are 2 ** BLOCK_BITS.
BLOCK_BITS = 12
# Ids that one string of ends holds are 2 ** END_BITS.
END_BITS = 16
# Parts of a prefix hash: sums of hashes of 28 bits, so that a long holds 2 ** 35 of them.
PARTS, PART_BITS = 4, 28
# Conversations whose row is broadcast: three numbers each, at most about 40 MB.
BROADCAST_BASES = 500_000


@dataclass
class Trie:
    """`nodes`: one row a distinct prefix; `ends`: node, conv_id of every conversation's last node."""

    nodes: DataFrame
    ends: DataFrame


def _positions(lines: DataFrame) -> DataFrame:
    """Adds pos, 1 and up in each conversation of lines (conv_id, place)."""
    run = F.shiftright("place", 33).alias("run")
    counts = lines.groupBy("conv_id", run).agg(F.count(F.lit(1)).alias("n"))
    by_run = Window.partitionBy("conv_id").orderBy("run")
    before = F.sum("n").over(by_run.rowsBetween(Window.unboundedPreceding, -1))
    # A conversation goes on in another range of rows only where two ranges meet: as many rows as ranges at most.
    goes_on = counts.withColumn("before", before).where("before is not null").select(
        F.col("conv_id").alias("on_id"), F.col("run").alias("on_run"), "before"
    )
    in_run = F.row_number().over(Window.partitionBy("conv_id", "run").orderBy("place"))
    numbered = lines.withColumn("run", run).withColumn("in_run", in_run)
    same = (F.col("conv_id") == F.col("on_id")) & (F.col("run") == F.col("on_run"))
    pos = (F.col("in_run") + F.coalesce("before", F.lit(0))).cast("long")
    return numbered.join(F.broadcast(goes_on), same, "left").select(*lines.columns, pos.alias("pos"))


def rebuild(lines: DataFrame, base: Column, shared: Column) -> DataFrame:
    """Conversations that begin with turns of another: the first `shared` of `base`, then their own after as many.

    `lines` (conv_id, pos, ...) gives (conv_id, depth, ...) and, for each
    conversation, a row of depth 0 whose other columns are null. `base` and `shared` are
    expressions of conv_id; fewer than 64 turns are shared, and few conversations share a base.
    """
    rest = [c for c in lines.columns if c not in ("conv_id", "pos")]
    lines = lines.withColumns({"base": base, "shared": shared.cast("long")})
    own = lines.groupBy("conv_id").agg(
        F.first("base").alias("base"), F.first("shared").alias("shared"), F.count(F.lit(1)).alias("n")
    )
    wanted = own.select(F.col("base").alias("base_id")).distinct()
    bases = lines.where("pos < 64").join(wanted, F.col("conv_id") == F.col("base_id"), "left_semi")
    bases = stored(bases.select(F.col("conv_id").alias("base_id"), "pos", *rest), "trie-bases")
    sizes = bases.groupBy("base_id").agg(F.count(F.lit(1)).alias("base_turns"))
    if sizes.count() <= BROADCAST_BASES:
        sizes = F.broadcast(sizes)
    begins = own.join(bases, (F.col("base") == F.col("base_id")) & (F.col("pos") <= F.col("shared")))
    begins = begins.select("conv_id", F.col("pos").alias("depth"), *rest)
    goes = lines.where("pos > shared").join(sizes, F.col("base") == F.col("base_id"), "left")
    taken = F.least("shared", F.coalesce("base_turns", F.lit(0)))
    goes = goes.select("conv_id", (F.col("pos") - F.col("shared") + taken).alias("depth"), *rest)
    kinds = dict(lines.dtypes)
    roots = own.select("conv_id", F.lit(0).cast("long").alias("depth"), *[F.lit(None).cast(kinds[c]).alias(c) for c in rest])
    return begins.unionByName(goes).unionByName(roots)


def _members(rows: DataFrame) -> DataFrame:
    """conv_id, depth, chars, node, parent, ends of every conversation and depth (conv_id, depth, said, chars).

    A prefix is named by the sum of hashes of its turns with their depths, in
    parts, so that long conversations are summed in blocks.
    """
    two = [F.xxhash64(F.lit(i), "depth", "said") for i in range((PARTS + 1) // 2)]
    mask = F.lit((1 << PART_BITS) - 1)
    hashes = [F.shiftrightunsigned(two[i // 2], PART_BITS * (i % 2)).bitwiseAND(mask) for i in range(PARTS)]
    terms = [F.when(F.col("depth") > 0, h).otherwise(F.lit(0)).alias(f"term_{i}") for i, h in enumerate(hashes)]
    block = F.shiftright("depth", BLOCK_BITS).alias("block")
    hashed = rows.select("conv_id", "depth", "chars", block, *terms)
    names = [f"term_{i}" for i in range(PARTS)]
    blocks = hashed.groupBy("conv_id", "block").agg(*[F.sum(n).alias(n) for n in names], F.max("depth").alias("last"))
    by_block = Window.partitionBy("conv_id").orderBy("block")
    earlier = by_block.rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        F.col("conv_id").alias("start_id"),
        F.col("block").alias("start_block"),
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"start_{n}") for n in names],
        F.max("last").over(Window.partitionBy("conv_id")).alias("length"),
    )
    so_far = Window.partitionBy("conv_id", "block").orderBy("depth")
    summed = hashed.select("*", *[F.sum(n).over(so_far).alias(f"in_{n}") for n in names])
    same = (F.col("conv_id") == F.col("start_id")) & (F.col("block") == F.col("start_block"))
    joined = summed.join(starts, same)
    own = [F.col(f"in_{n}") + F.col(f"start_{n}") for n in names]
    above = [o - F.col(n) for o, n in zip(own, names)]

    def name(depth: Column, parts: list[Column]) -> Column:
        return F.substring(F.unhex(F.sha2(F.concat_ws(",", depth, *parts), 256)), 1, 16)

    return joined.select(
        "conv_id",
        "depth",
        "chars",
        name(F.col("depth"), own).alias("node"),
        F.when(F.col("depth") > 0, name(F.col("depth") - 1, above)).alias("parent"),
        (F.col("depth") == F.col("length")).alias("ends"),
    )


def subtree_sums(nodes: DataFrame, paths: DataFrame, deepest: int, band: int) -> DataFrame:
    """node and the sums of n_leaves and saved over its subtree.

    `nodes` (node, depth, rep, n_leaves, saved) are given their ancestors by
    `paths` (conv_id, depth, node), the way to the conversation `rep`. A node explodes to
    its ancestors in its band of `band` depths. The roots of the bands make a trie
    `band` times less deep, which is summed the same way; then each root's whole
    sum goes to its ancestors in the band above. So there are log(deepest) rounds.
    """
    in_band = (
        paths.groupBy("conv_id", F.floor(F.col("depth") / band).cast("long").alias("band"))
        .agg(F.sort_array(F.collect_list(F.struct("depth", "node"))).alias("steps"))
        .select(F.col("conv_id").alias("on_way"), F.col("band").alias("way_band"), F.col("steps.node").alias("way"))
    )

    def to_ancestors(rows: DataFrame, at_band: Column, count: Column) -> DataFrame:
        on = (F.col("rep") == F.col("on_way")) & (at_band == F.col("way_band"))
        return rows.join(in_band, on).select(
            F.explode(F.slice("way", F.lit(1), count)).alias("node"), "n_leaves", "saved"
        )

    def sums(rows: DataFrame) -> DataFrame:
        return rows.groupBy("node").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))

    own_band = F.floor(F.col("depth") / band).cast("long")
    inside = to_ancestors(nodes, own_band, (F.col("depth") % band + 1).cast("int"))
    if deepest < band:
        return sums(inside)
    within = stored(sums(inside), "trie-band-sums")
    roots = nodes.where(F.col("depth") % band == 0).select("node", (F.col("depth") / band).cast("long").alias("depth"), "rep")
    higher = paths.where(F.col("depth") % band == 0).select("conv_id", (F.col("depth") / band).cast("long").alias("depth"), "node")
    roots = stored(roots.join(within, "node"), "trie-band-roots")
    whole = subtree_sums(roots, stored(higher, "trie-band-paths"), deepest // band, band)
    complete = roots.select("node", "depth", "rep").join(whole, "node").where("depth > 0")
    # A root's rows went to itself within the band; above it they go to the whole band before.
    crossing = to_ancestors(complete, F.col("depth") - 1, F.lit(band))
    return sums(within.unionByName(crossing))


def prefix_trie(members: DataFrame, band: int = BAND) -> Trie:
    """The trie of the conversations' turns: `members` (conv_id, depth, said, chars), depth 0 without a turn.

    `said` names role and text of the turn, `chars` is what the turn would save for each
    further conversation that shares it. Every conversation has the depths 0, 1, ... without a
    gap, each once. `nodes` has node, depth, conv_id (its smallest member), parent_conv_id
    (null for the root), n_convs, n_children, n_leaves (childless nodes of the subtree) and
    saved (the sum of (n_convs - 1) * chars over the subtree). No rows: no nodes.
    """
    rows = stored(_members(members), "trie-members")
    found = rows.groupBy("node", "depth").agg(
        F.min("conv_id").alias("rep"),
        F.count(F.lit(1)).alias("n_convs"),
        F.max("parent").alias("parent"),
        F.max("chars").alias("chars"),
        F.sum(F.col("ends").cast("long")).alias("n_ends"),
    )
    nodes = stored(found, "trie-nodes")
    # A node is a leaf if all its members end there.
    own = nodes.select(
        "node",
        "depth",
        "rep",
        (F.col("n_ends") == F.col("n_convs")).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.coalesce("chars", F.lit(0))).alias("saved"),
    )
    known = nodes.agg(F.max("depth").alias("deepest"), F.min("rep").alias("first_conv")).first()
    deepest = known["deepest"] or 0
    sums = subtree_sums(own, rows.select("conv_id", "depth", "node"), deepest, band)
    children = nodes.groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    counted = nodes.join(sums, "node").join(children, "node", "left")
    parents = nodes.select(F.col("node").alias("parent"), F.col("rep").alias("parent_conv_id"))
    # Nodes right below the root are many, and all have its smallest member.
    deep = counted.where("depth > 1").join(parents, "parent", "left").select(*counted.columns, "parent_conv_id")
    top = counted.where("depth <= 1").select(
        "*", F.when(F.col("depth") == 1, F.lit(known["first_conv"]).cast("long")).alias("parent_conv_id")
    )
    columns = [
        "node",
        F.col("rep").alias("conv_id"),
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        "n_leaves",
        "saved",
    ]
    return Trie(deep.unionByName(top).select(*columns), rows.where("ends").select("node", "conv_id"))


def ends_sha256(ends: DataFrame) -> DataFrame:
    """node, sha256 of the ids of the conversations that end there, ascending and comma-joined.

    Ids are joined in strings of at most 2 ** END_BITS numbers; only where a node
    has several of them do the strings pass through one task.
    """
    parts = (
        ends.groupBy("node", F.shiftright("conv_id", END_BITS).alias("bucket"))
        .agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
        .select("node", "bucket", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("part"))
    )
    parts = stored(parts, "trie-ends")
    counts = parts.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.max("part").alias("part"))
    single = counts.where("n = 1").select("node", F.sha2("part", 256).alias("sha256"))
    several = parts.join(counts.where("n > 1").select("node"), "node", "left_semi")
    return single.unionByName(joined_sha256(several, "node", ["bucket"], ","))


def conversation_lines(turns: DataFrame) -> DataFrame:
    """conv_id, pos, said, chars of the turns (conv_id, turn, role, text) in order, texts left behind.

    Turns go by turn (null first), then role and text; null roles and texts count as
    empty. Rows without a conv_id belong to no conversation and are left out.
    Repeated rows are turns of their own. Other columns are not read.
    """
    known = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    said = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    keep = {"conv_id": F.col("conv_id"), "said": said, "chars": F.length("text").cast("long")}
    return _positions(in_order(known, keep, "trie-turns"))
