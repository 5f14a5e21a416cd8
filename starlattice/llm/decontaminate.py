"""Benchmark decontamination: a prefix-filtered join of item windows with whole documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starlattice.llm.common import ascii_lower, stored, without

# Words of a lower-case text: all but the ASCII characters that are no digits or small letters.
# The second pattern finds as many in the text itself.
WORD = r"[a-z0-9\x80-\x{10FFFF}]+"
ANY_CASE_WORD = r"[a-zA-Z0-9\x80-\x{10FFFF}]+"
# Words of a shingle; shorter windows are one shingle.
SHINGLE = 3
WINDOW_WORDS = 13
# Windows that are broadcast at once: at most 11 shingle hashes and four numbers each, about 10 MB. Of more
# windows only bits of their hashes are broadcast, and the rows that these let through are shuffled.
BLOCK_WINDOWS = 50_000
# Bits that are broadcast for each hash, in rows of 4,096, and the most rows, together 32 MB.
BITS_A_HASH, BITS_A_ROW, MOST_BIT_ROWS = 32, 4096, 1 << 16


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))


def item_windows(items: DataFrame, window: int = WINDOW_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The distinct windows (window_id, window), which texts have them (window_id, text_id), whose these are (text_id, item_ids).

    Items of the same words are one text, so a text that many items have is searched and joined once.
    """
    worded = items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words_of(F.col("text")).alias("words")
    ).where(F.size("words") > 0)
    texts = stored(
        worded.groupBy("words").agg(F.collect_set("item_id").alias("item_ids")).withColumn("text_id", F.monotonically_increasing_id()),
        "item-texts",
    )
    parts = texts.select(
        "text_id",
        F.explode(
            F.array_distinct(
                F.transform(
                    F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1))),
                    lambda i: F.slice("words", i, F.lit(window)),
                )
            )
        ).alias("window"),
    )
    distinct = stored(parts.select("window").distinct().withColumn("window_id", F.monotonically_increasing_id()), "windows")
    # The files of the texts say nothing of how many windows these have, so nothing is broadcast by their size.
    owners = stored(distinct.hint("merge").join(parts, "window").select("window_id", "text_id"), "window-texts")
    return distinct, owners, texts.select("text_id", "item_ids")


def _key(words: Column, place: Column, length: int) -> Column:
    return F.xxhash64(F.lit(length), *[F.get(words, place + i) for i in range(length)])


def _bits(hashes: DataFrame) -> tuple[DataFrame, int]:
    """Bits of the hashes (a column `hash`) in rows (bit_row, bits), and the number of rows that they are dealt to."""
    rows, count = 1, hashes.count()
    while rows < MOST_BIT_ROWS and rows * BITS_A_ROW < count * BITS_A_HASH:
        rows *= 2
    bit = F.expr("shiftrightunsigned(hash, 52)")
    words = hashes.groupBy(F.pmod("hash", F.lit(rows)).alias("bit_row"), F.expr("shiftrightunsigned(hash, 58)").alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int"))).alias("set")
    )
    held = words.groupBy("bit_row").agg(F.map_from_entries(F.collect_list(F.struct("word", "set"))).alias("held"))
    there = F.transform(
        F.sequence(F.lit(0).cast("long"), F.lit(BITS_A_ROW // 64 - 1).cast("long")),
        lambda i: F.coalesce(F.try_element_at("held", i), F.lit(0).cast("long")),
    )
    return held.select("bit_row", there.alias("bits")), rows


def _passing(rows: DataFrame, name: str, bits: tuple[DataFrame, int]) -> DataFrame:
    """The rows whose hash, in the column `name`, may be among those of the bits: all that are, and few others."""
    held, parts = bits
    word = F.get("bits", F.expr(f"shiftrightunsigned({name}, 58)").cast("int"))
    bit = F.expr(f"cast(shiftrightunsigned({name}, 52) % 64 as int)")
    met = rows.join(F.broadcast(held), F.pmod(F.col(name), F.lit(parts)) == F.col("bit_row"))
    return met.where(F.call_function("shiftrightunsigned", word, bit).bitwiseAND(1) == 1).drop("bit_row", "bits")


def _hits(docs: DataFrame, windows: DataFrame, length: int, longest: int, few: bool) -> DataFrame:
    """Where windows of at most `longest` words occur: doc_id, text_hash, start, size, window_id.

    `length` is the number of words in a shingle. One pass over the texts finds all
    places of the windows' shingles. The shingles are ordered by their number there;
    a window that occurs must have its rarest one, so only that is joined. Its place
    in the window gives the only possible start, the length the end, and the
    shingles found on the way must be those of the window, without a gap.

    What is joined is broadcast if the windows are `few`. Of many only bits of the hashes are, which
    let some other places through: they lie in no window that occurs, because a place has one
    shingle. The places of rarest shingles are then shuffled, each with its neighbours.
    """
    parts = windows.select(
        "window_id",
        F.size("window").alias("size"),
        F.transform(F.sequence(F.lit(0), F.size("window") - length), lambda i: _key(F.col("window"), i, length)).alias("keys"),
    )
    if not few:
        parts = parts.hint("merge")
    placed = parts.select("window_id", F.posexplode("keys").alias("offset", "key"))
    worded = (
        docs.select("doc_id", "text_hash", F.size("words").alias("n"), "words", F.posexplode("words").alias("place", "word"))
        .withColumn("key", _key(F.col("words"), F.col("place"), length))
        .where(F.col("place") + length <= F.col("n"))
    )
    if few:
        keys = F.broadcast(placed.select(F.col("key").alias("known")).distinct())
        known = worded.join(keys, F.col("key") == F.col("known"))
    else:
        keys = stored(placed.select(F.col("key").alias("hash")).distinct(), "window-shingles")
        known = _passing(worded, "key", _bits(keys))
    seen = stored(known.select("doc_id", "text_hash", "place", "key"), "shingle-places")
    times = seen.groupBy("key").agg(F.count("*").alias("times"))
    rarest = placed.join(times, "key", "left").groupBy("window_id").agg(
        F.min(F.struct(F.coalesce("times", F.lit(0)).alias("times"), "offset", "key")).alias("rarest")
    )
    anchors = stored(
        parts.join(rarest, "window_id")
        .where("rarest.times > 0")
        .select("window_id", "size", "keys", F.col("rarest.offset").alias("offset"), F.col("rarest.key").alias("anchor")),
        "window-anchors",
    )
    # Places of a document in order; equal rows of documents have equal places.
    documents = seen.groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_set(F.struct("place", "key"))).alias("found")
    )
    places = documents.select("doc_id", "text_hash", "found", F.posexplode("found").alias("at", "here")).withColumn("key", F.col("here.key"))
    if few:
        met = places.join(F.broadcast(anchors), F.col("key") == F.col("anchor"))
    else:
        most = longest - length + 1
        ahead = F.least(F.col("at"), F.lit(most - 1))
        passing = _passing(places, "key", _bits(anchors.select(F.col("anchor").alias("hash")).distinct()))
        near = F.slice("found", F.col("at") - ahead + 1, ahead + most)
        met = passing.select("doc_id", "text_hash", near.alias("found"), ahead.alias("at"), "here", "key").join(
            anchors.hint("merge"), F.col("key") == F.col("anchor")
        )
    first, count = F.col("at") - F.col("offset"), F.size("keys")
    run = F.slice("found", F.greatest(first + 1, F.lit(1)), count)
    start = F.col("here.place") - F.col("offset")
    return (
        met.where((first >= 0) & (first + count <= F.size("found")))
        .where((F.get("found", first)["place"] == start) & (F.get("found", first + count - 1)["place"] == start + count - 1))
        .where(F.transform(run, lambda x: x["key"]) == F.col("keys"))
        .select("doc_id", "text_hash", start.alias("start"), "size", "window_id")
    )


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """What documents (doc_id, text) share with benchmark items (item_id, text).

    Returns doc_id, text_hash, n_words, n_hit (words inside an occurrence of a window
    of `window` item words, or of a whole shorter item) and items (the ids, as
    strings, of items with such windows, sorted), one row for each row of docs.

    Null and empty texts have no words and no hits; items without words have no
    windows; a null item id is the empty string. Repeated items count once, repeated
    documents each get their row. The texts are read once for the windows of three words and more,
    and once for those of two and of one if there are any, however many windows there are.
    No documents: no rows; no items: no hits. Other columns are not read.
    """
    windows, owners, texts = item_windows(items, window)
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    worded = keyed.select("doc_id", "text_hash", words_of(F.coalesce("text", F.lit(""))).alias("words"))
    found, few_windows = [], windows.count() <= BLOCK_WINDOWS
    for length in range(1, SHINGLE + 1):
        sized = windows.where(F.least(F.size("window"), F.lit(SHINGLE)) == length)
        count = sized.count()
        if count:
            found.append(_hits(worded, sized, length, window, count <= BLOCK_WINDOWS))
    counted = keyed.select(
        "doc_id",
        "text_hash",
        F.coalesce(F.regexp_count("text", F.lit(ANY_CASE_WORD)), F.lit(0)).cast("long").alias("n_words"),
    )
    if not found:
        return counted.select("*", F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"))
    hits = stored(reduce(DataFrame.unionByName, found), "window-hits")
    # Words of a window beyond all windows that start before it in its document.
    before = Window.partitionBy("doc_id", "text_hash").orderBy("start", "size", "window_id")
    end = F.col("start") + F.col("size")
    reached = F.coalesce(F.max(end).over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    covered = hits.withColumn("new", F.greatest(end - F.greatest("start", reached), F.lit(0)))
    words = covered.groupBy("doc_id", "text_hash").agg(F.sum("new").alias("n_hit"))
    if not few_windows:
        owners, texts = owners.hint("merge"), texts.hint("merge")
    owned = hits.select("doc_id", "text_hash", "window_id").distinct().join(owners, "window_id")
    ids = (
        owned.select("doc_id", "text_hash", "text_id")
        .distinct()
        .join(texts, "text_id")
        .groupBy("doc_id", "text_hash")
        .agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("items"))
    )
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & a["text_hash"].eqNullSafe(b["text_hash"])
    result = words.alias("w").join(ids.alias("i"), same(words, ids)).select("w.doc_id", "w.text_hash", "n_hit", "items")
    result = stored(result, "contamination")
    return counted.join(result, same(counted, result), "left").select(
        counted["doc_id"],
        counted["text_hash"],
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def contaminated() -> Column:
    """At least one word in twenty is hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of docs that are not contaminated, with all their columns."""
    found = contamination(docs.select("doc_id", "text"), items)
    return without(docs, found.where(contaminated()).select("doc_id", "text_hash"))
