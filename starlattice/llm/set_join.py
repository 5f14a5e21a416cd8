"""N-gram Jaccard join: near copies by shingle sets, found exactly."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlattice.llm import overlap
from starlattice.llm.common import stored, without
from starlattice.llm.components import components
from starlattice.llm.shingles import digest, shingle_sets

PERCENT = 75
# Shingles of one block of documents, and of one part of the hash range, while they are counted.
BLOCK_SHINGLES = 1 << 20
# Sets of one block: a set's place in it, and one number that means several sets, take 16 bits.
BLOCK_SETS = (1 << 16) - 1
# Sets, and shingles of them, in one block of a group that is compared; a group has one or two blocks.
GROUP_SETS = 256
GROUP_SHINGLES = 1 << 19
# Candidate documents that are broadcast (two longs each).
BROADCAST_IDS = 500_000


def _share(name: str) -> str:
    """SQL: the least number of a set's shingles that another set linked to it must have."""
    return f"ceil({PERCENT} * {name} / 100.0)"


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in slices, so that few texts are held as Python strings at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def describe(docs: DataFrame) -> DataFrame:
    """doc_id, a hash of the text, n_shingles and the digest of the shingle set for every row of docs (doc_id, text)."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            found = [(len(s), digest(s)) for s in shingle_sets(batch.column(2).to_pylist())]
            sizes, digests = pa.array([n for n, _ in found], pa.int64()), pa.array([d for _, d in found], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), sizes, digests], ["doc_id", "text_hash", "n_shingles", "digest"]
            )

    ids = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    return ids.mapInArrow(sets, "doc_id long, text_hash long, n_shingles long, digest binary")


def _blocks(docs: DataFrame, parts: int) -> DataFrame:
    """Each block's distinct shingles, cut by hash range: 40 bits below the range tell them apart.

    A row (block, part) holds the shingles in that part and the owner of each inside the
    block, seven bytes a shingle however many parts there are. Part 0 also names the sets
    and says how many shingles of each are known to be shared inside the block.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, np.ndarray] = {}
        size = 0
        for batch in small_batches(batches):
            for tokens in shingle_sets(batch.column(0).to_pylist()):
                if len(tokens) and (key := digest(tokens)) not in held:
                    held[key] = tokens
                    size += len(tokens)
                if size >= BLOCK_SHINGLES or len(held) == BLOCK_SETS:
                    yield from _cut_block(held, parts)
                    held, size = {}, 0
        if held:
            yield from _cut_block(held, parts)

    return docs.select("text").mapInArrow(
        cut, "block binary, part int, low binary, high binary, owners binary, digests binary, sizes binary, known binary"
    )


def _cut_block(held: dict[bytes, np.ndarray], parts: int) -> Iterator[pa.RecordBatch]:
    names, sets = list(held), list(held.values())
    sizes = np.array([len(s) for s in sets], np.int32)
    owner = np.repeat(np.arange(len(sets), dtype=np.int32), sizes)
    tokens, first, times = np.unique(np.concatenate(sets), return_index=True, return_counts=True)
    several = times > 1
    known = np.bincount(owner[np.isin(np.concatenate(sets), tokens[several])], minlength=len(sets)).astype(np.int32)
    # Several owners: owner len(sets), sent so that other blocks see the shingle.
    holder = np.where(several, len(sets), owner[first])
    # The top 24 bits choose the part, 40 more bits stay.
    part = ((tokens >> np.uint64(40)) * np.uint64(parts)) >> np.uint64(24)
    order = np.lexsort((holder, part))
    tokens, holder, part = tokens[order], holder[order], part[order].astype(np.int64)
    ends = np.searchsorted(part, np.arange(parts + 1))
    block = digest(np.frombuffer(b"".join(names), np.uint8))
    rows = []
    for p in range(parts):
        a, b = ends[p], ends[p + 1]
        if a == b and p:
            continue
        chosen = tokens[a:b]
        rows.append(
            (
                block, p,
                (chosen & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes(),
                ((chosen >> np.uint64(32)) & np.uint64(0xFF)).astype(np.uint8).tobytes(),
                holder[a:b].astype(np.uint16).tobytes(),
                b"".join(names) if p == 0 else None, sizes.tobytes() if p == 0 else None, known.tobytes() if p == 0 else None,
            )
        )
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(column, kind)
            for column, kind in zip(
                zip(*rows), (pa.binary(), pa.int32(), *[pa.binary()] * 6), strict=True
            )
        ],
        ["block", "part", "low", "high", "owners", "digests", "sizes", "known"],
    )


def _count_part(rows: pd.DataFrame) -> pd.DataFrame:
    """How many shingles of each set, in this part, another block has as well; only sets that have some."""
    def numbers(column: str, kind) -> list[np.ndarray]:
        return [np.frombuffer(x, kind) for x in rows[column]]

    low, high, owners = numbers("low", np.uint32), numbers("high", np.uint8), numbers("owners", np.uint16)
    tokens = np.concatenate([a.astype(np.uint64) | (b.astype(np.uint64) << np.uint64(32)) for a, b in zip(low, high)])
    order = np.argsort(tokens, kind="stable")
    ordered = tokens[order]
    same = ordered[1:] == ordered[:-1]
    shared = np.zeros(len(tokens), bool)
    shared[order[1:][same]] = True
    shared[order[:-1][same]] = True
    held, counts, start = [], [], 0
    for owner in owners:
        end = start + len(owner)
        found, times = np.unique(owner[shared[start:end]], return_counts=True)
        held.append(found.tobytes())
        counts.append(times.astype(np.uint32).tobytes())
        start = end
    out = pd.DataFrame(
        {"block": rows["block"], "held": held, "counts": counts, "digests": rows["digests"], "sizes": rows["sizes"], "known": rows["known"]}
    )
    return out[(out["held"] != b"") | out["sizes"].notna()]


def _sum_block(rows: pd.DataFrame) -> pd.DataFrame:
    """The sets of a block of which enough shingles are shared."""
    named = rows[rows["sizes"].notna()].iloc[0]
    sizes = np.frombuffer(named["sizes"], np.int32).astype(np.int64)
    # The last place counts shingles of several sets, which are known already.
    total = np.append(np.frombuffer(named["known"], np.int32).astype(np.int64), 0)
    # Blocks of the same sets fall together; their counts only add, so that no set is missed.
    for held, counts in zip(rows["held"], rows["counts"]):
        total[np.frombuffer(held, np.uint16)] += np.frombuffer(counts, np.uint32)
    enough = np.flatnonzero(100 * total[:-1] >= PERCENT * sizes)
    data = named["digests"]
    return pd.DataFrame({"digest": [data[16 * i : 16 * i + 16] for i in enough.tolist()]})


def shared_sets(docs: DataFrame) -> DataFrame:
    """Digests of the sets of which `PERCENT` hundredths of the shingles occur in other texts too.

    Only these can be linked to anything. A block sends each of its distinct shingles
    once, so a shingle that many documents share comes at most once from each block.
    """
    characters = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    spark = docs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), characters // (16 * BLOCK_SHINGLES), 1)
    parts = min(parts, 1 << 20)
    counted = (
        _blocks(docs, parts)
        .groupBy("part")
        .applyInPandas(_count_part, "block binary, held binary, counts binary, digests binary, sizes binary, known binary")
    )
    return counted.groupBy("block").applyInPandas(_sum_block, "digest binary").distinct()


def _candidate_sets(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """class_no, weight, tokens of every class that can be linked to another."""
    wanted = stored(
        classes.join(shared_sets(docs), "digest").select(
            "class_no", "weight", F.col("first_id").alias("doc_id"), F.col("digest")
        ),
        "candidate-classes",
    )
    ids = wanted.select(F.col("doc_id").alias("wanted_id")).distinct()
    ids = F.broadcast(ids) if wanted.count() <= BROADCAST_IDS else ids
    texts = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi").select("text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            found = list(shingle_sets(batch.column(0).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([digest(s) for s in found], pa.binary()), pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))],
                ["digest", "tokens"],
            )

    made = texts.mapInArrow(sets, "digest binary, tokens array<long>")
    # An id that comes with several texts can make a set more than once.
    once = made.join(wanted.select("class_no", "weight", "digest"), "digest").dropDuplicates(["class_no"])
    return stored(once.select("class_no", "weight", "tokens"), "candidate-sets")


def _clusters(sets: DataFrame) -> DataFrame:
    """class_no and cluster: sets that share a token of their prefixes, rarest tokens first, are in one cluster."""
    entries = sets.select("class_no", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    # Sums that are joined back are stored first: such a join stands alone, and skew handling can split a hot key.
    times = stored(entries.groupBy("token").agg(F.count("*").alias("times")).where("times > 1"), "token-counts")
    ranked = entries.join(times, "token").groupBy("class_no", "n").agg(
        F.sort_array(F.collect_list(F.struct("times", "token"))).alias("shared")
    )
    # Tokens that no other set has come first; what is left of the prefix is shared.
    left = F.expr(f"cast(n - {_share('n')} + 1 - (n - size(shared)) as int)")
    prefix = stored(
        ranked.where(left > 0).select("class_no", F.explode(F.slice("shared", F.lit(1), left)).alias("entry")).select(
            "class_no", F.col("entry.token").alias("token")
        ),
        "prefixes",
    )
    first = stored(prefix.groupBy("token").agg(F.min("class_no").alias("first")), "first-of-tokens")
    edges = prefix.join(first, "token").select(F.col("class_no").alias("a"), F.col("first").alias("b"))
    found = components(edges)
    roots = found.select(F.col("root").alias("node"), "root").distinct()
    return found.unionByName(roots).select(F.col("node").alias("class_no"), F.col("root").alias("cluster"))


def _compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    _, low, high = key
    if low != high and rows["side"].nunique() < 2:
        # One of the two blocks is empty; pairs inside the other one are compared in a group of its own.
        return pd.DataFrame({"class_no": [], "root": [], "links": [], "derived": []}, dtype=np.int64)
    sets = [np.asarray(t, np.int64).view(np.uint64) for t in rows["tokens"]]
    numbers = rows["class_no"].to_numpy()
    first, links, derived = overlap.link(sets, rows["side"].to_numpy(), rows["weight"].to_numpy(), PERCENT)
    return pd.DataFrame({"class_no": numbers, "root": numbers[first], "links": links, "derived": derived.astype(np.int64)})


def _links(sets: DataFrame, clusters: DataFrame) -> DataFrame:
    """class_no, root, links, derived of each group of sets; the rows of a set in several groups tell of different pairs.

    A cluster is cut into bands of sizes, of which only neighbours can be similar, and
    bands into blocks; each pair of blocks is a group of its own.
    """
    banded = stored(
        clusters.join(sets.select("class_no", F.size("tokens").alias("n")), "class_no").select(
            "class_no", "cluster", "n", F.floor(F.log(F.col("n").cast("double")) / -np.log(PERCENT / 100)).cast("int").alias("band")
        ),
        "bands",
    )
    enough = F.greatest(F.ceil(F.count("*") / GROUP_SETS), F.ceil(F.sum("n") / GROUP_SHINGLES))
    blocks = stored(banded.groupBy("cluster", "band").agg(enough.cast("int").alias("blocks")), "band-blocks")
    placed = banded.join(blocks, ["cluster", "band"]).withColumn("block", F.pmod(F.xxhash64("class_no"), F.col("blocks")).cast("int"))
    near = blocks.select(F.col("cluster").alias("near_cluster"), F.col("band").alias("near_band"), F.col("blocks").alias("near_blocks"))
    pairs = placed.join(
        near, (F.col("cluster") == F.col("near_cluster")) & F.col("near_band").between(F.col("band") - 1, F.col("band") + 1)
    ).select("class_no", "cluster", "band", "block", "near_band", F.explode(F.sequence(F.lit(0), F.col("near_blocks") - 1)).alias("near_block"))
    own, other = F.struct("band", "block"), F.struct(F.col("near_band").alias("band"), F.col("near_block").alias("block"))
    grouped = pairs.select(
        "class_no", "cluster", F.least(own, other).alias("low"), F.greatest(own, other).alias("high"), (own > other).cast("int").alias("side")
    )
    return grouped.join(sets, "class_no").groupBy("cluster", "low", "high").applyInPandas(
        _compare, "class_no long, root long, links long, derived long"
    )


def near_copies(docs: DataFrame) -> DataFrame:
    """Links documents (doc_id, text) whose shingle sets have a Jaccard similarity of `PERCENT` hundredths or more.

    Returns doc_id, n_shingles, component_id (the smallest doc_id reachable by
    links, itself included), class_id (the smallest doc_id of equal sets), n_links
    (other rows it is linked to) and n_derived (groups in which its set's overlaps came
    from those of a similar set), one row for each row of docs.

    Null and empty texts have no shingles and link with nothing; repeated rows are
    copies of each other; an id with several texts stands for each of them alone. Rows
    without an id are linked like others, but name no component: where no id is
    reachable, component_id is null. Ids are whole numbers. No rows: no rows.
    Other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = stored(describe(docs), "shingle-digests")
    classes = stored(
        rows.where("n_shingles > 0")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("first_id"), F.count("*").alias("weight"))
        .withColumn("class_no", F.monotonically_increasing_id()),
        "classes",
    )
    sets = _candidate_sets(docs, classes)
    linked = stored(_links(sets, _clusters(sets)), "links")
    found = components(linked.select(F.col("class_no").alias("a"), F.col("root").alias("b")))
    roots = classes.join(found, F.col("class_no") == F.col("node"), "left").withColumn("root", F.coalesce("root", "class_no"))
    least = roots.groupBy("root").agg(F.min("first_id").alias("component_id"))
    degrees = linked.groupBy("class_no").agg(F.sum("links").alias("links"), F.sum("derived").alias("derived"))
    named = stored(
        roots.join(least, "root")
        .join(degrees, "class_no", "left")
        .select(
            "digest",
            F.col("root").alias("group_no"),
            F.col("first_id").alias("class_id"),
            "component_id",
            (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("derived", F.lit(0)).alias("n_derived"),
        ),
        "class-components",
    )
    filled = rows.where("n_shingles > 0").join(named, "digest")
    empty = rows.where("n_shingles = 0").select(
        "*",
        F.lit(None).cast("long").alias("group_no"),
        F.col("doc_id").alias("component_id"),
        F.col("doc_id").alias("class_id"),
        F.lit(0).cast("long").alias("n_links"),
        F.lit(0).cast("long").alias("n_derived"),
    )
    return filled.unionByName(empty).select(
        "doc_id", "text_hash", "n_shingles", "component_id", "class_id", "n_links", "n_derived", "group_no"
    )


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One row of each group of linked documents (doc_id, text), all columns kept.

    The one with the smallest id stays, of equal ids the one with the smaller text
    hash; a null id stays only where there is no other. Rows without words are groups
    of their own. Only the keys of what goes are joined to the texts.
    """
    rows = stored(near_copies(docs).where("group_no is not null").select("group_no", "doc_id", "text_hash"), "near-copies")
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash")
    first = rows.groupBy("group_no").agg(F.min(place).alias("first")).select("group_no", "first.*")
    known = stored(
        first.select("group_no", F.col("doc_id").alias("first_id"), F.col("text_hash").alias("first_hash")), "first-copies"
    )
    gone = (
        rows.join(known, "group_no")
        .where(~(F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_hash") == F.col("first_hash"))))
        .select("doc_id", "text_hash")
    )
    kept = without(docs, gone)
    repeated = stored(rows.groupBy("doc_id", "text_hash").count().where("count > 1"), "repeated-rows")
    if not repeated.take(1):
        return kept
    return without(kept, repeated).unionByName(_once(kept, repeated))


def _once(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """One row for each of the keys (doc_id, text_hash) among the rows of docs."""
    wanted = keys.select(F.col("doc_id").alias("wanted_id"), F.col("text_hash").alias("wanted_hash"))
    found = docs.select(F.struct("*").alias("row"), F.xxhash64("text").alias("hash")).join(
        wanted, F.col("row.doc_id").cast("long").eqNullSafe(F.col("wanted_id")) & (F.col("hash") == F.col("wanted_hash")), "left_semi"
    )
    return found.groupBy(F.col("row.doc_id").alias("id"), "hash").agg(F.first("row").alias("row")).select("row.*")
