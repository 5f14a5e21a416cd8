"""Quality rules with thresholds from quantile sketches of each language and source."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlattice.llm.common import SPACED_WORD, stored

SYMBOLS = r"[#*$%&|<>]"
# Items that a sketch keeps at its lowest level; groups of fewer documents are exact.
SKETCH_ITEMS = 4096
# Groups with fewer documents take the thresholds of their language, or of all documents.
LEAST_DOCUMENTS = 100
# A value is out of line beyond the upper (lower) quartile by this many quartile distances, and
# where the quartiles are equal, as for faults that most documents lack, beyond this quantile.
REACH = 3.0
RARE = 0.99
RANKS = (0.25, 0.75, RARE)


@dataclass(frozen=True)
class Limit:
    """A measure with an upper bound, and a lower one if `both`; the upper one is never below `least`."""

    name: str
    least: float = 0.0
    both: bool = False


LIMITS = (
    Limit("symbols_per_word", least=0.01),
    Limit("dup_line_share", least=0.05),
    Limit("repeat_share", least=0.05),
    Limit("word_length", both=True),
)


def _repeat_words(words: Column) -> list[tuple[str, Column]]:
    """Columns, each built on the ones before: `repeats` at the end counts words in repeated 3-word windows.

    Windows are told apart by 64-bit hashes. Only texts in which a hash comes twice are
    sorted; neighbours of equal hash give the starting places, and the places
    the covered words.
    """
    shifted = lambda name: (
        F.slice(name, F.lit(1), F.greatest(F.size(name) - 1, F.lit(0))),
        F.slice(name, F.lit(2), F.greatest(F.size(name) - 1, F.lit(0))),
    )
    hashes = F.when(
        F.size(words) >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size(words) - 3),
            lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    repeated = F.size(F.array_distinct("hashes")) < F.size("hashes")
    placed = F.when(
        repeated, F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("hash"), i.alias("place"))))
    ).otherwise(F.array().cast("array<struct<hash:bigint,place:int>>"))
    pairs = F.zip_with(
        *shifted("placed"),
        lambda a, b: F.when(a["hash"] == b["hash"], F.array(a["place"], b["place"])).otherwise(F.array().cast("array<int>")),
    )
    steps = F.zip_with(*shifted("places"), lambda a, b: F.least(b - a, F.lit(3)))
    return [
        ("hashes", hashes),
        ("placed", placed),
        ("places", F.sort_array(F.array_distinct(F.flatten(pairs)))),
        ("repeats", F.when(F.size("places") > 0, F.aggregate(steps, F.lit(3), lambda a, b: a + b)).otherwise(0).cast("long")),
    ]


def measure(docs: DataFrame) -> DataFrame:
    """Counts of each row of docs (doc_id, text, lang, source): base counts, base_failed and shares.

    Null texts count as empty: no words, base_failed. One row for each row, repeated
    rows included; other columns are not read.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", "lang", "source", text.alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda line: F.rlike(line, F.lit(SPACED_WORD)))
    rows = rows.select(
        "doc_id",
        "lang",
        "source",
        F.regexp_extract_all("text", F.lit(SPACED_WORD), F.lit(0)).alias("words"),
        (F.length("text") - F.regexp_count("text", F.lit(r"[\x20\x09-\x0D]"))).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        lines.alias("lines"),
    ).withColumns(
        {
            "n_words": F.size("words").cast("long"),
            "n_lines": F.size("lines").cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        }
    )
    for name, column in _repeat_words(F.col("words")):
        rows = rows.withColumn(name, column)
    rows = rows.select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
        F.col("repeats").alias("n_repeat_words"),
    )
    whole = F.greatest("n_words", F.lit(1))
    return rows.withColumns(
        {
            "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
            "symbols_per_word": F.col("n_symbols") / whole,
            "dup_line_share": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
            "repeat_share": F.col("n_repeat_words") / whole,
            "word_length": F.col("word_chars") / whole,
        }
    )


def thresholds(measured: DataFrame) -> DataFrame:
    """Bounds for every language and source: low_ and high_ columns for each limit.

    One sketch of each measure is built for each language and source from the rows
    that pass the base rules; sketches are merged for the languages and for
    everything, without another look at the rows.
    """
    good = measured.where(~F.col("base_failed"))
    names = [m.name for m in LIMITS]
    groups = stored(
        good.groupBy("lang", "source").agg(
            F.count("*").alias("n"), *[F.kll_sketch_agg_double(m, SKETCH_ITEMS).alias(m) for m in names]
        ),
        "quality-sketches",
    )

    def quartiles(level: str, *keys: str) -> DataFrame:
        rows = groups.groupBy(*keys).agg(
            F.sum("n").alias("n"), *[F.kll_merge_agg_double(m, SKETCH_ITEMS).alias(m) for m in names]
        )
        found = [
            F.array(*[F.kll_sketch_get_quantile_double(m, F.lit(rank)) for rank in RANKS]).alias(m)
            for m in names
        ]
        enough = rows if level == "corpus" else rows.where(F.col("n") >= LEAST_DOCUMENTS)
        return enough.select(*[F.col(k).alias(f"{level}_{k}") for k in keys], F.struct(*found).alias(level))

    own, language = quartiles("own", "lang", "source"), quartiles("language", "lang")
    # One row of a few numbers, empty if no row passes.
    corpus = quartiles("corpus").select("corpus.*").first() if groups.take(1) else None
    everything = F.struct(
        *[F.array(*[F.lit(x) for x in corpus[m]]).alias(m) if corpus else F.lit(None).cast("array<double>").alias(m) for m in names]
    )
    found = (
        measured.select("lang", "source")
        .distinct()
        .join(own, F.col("lang").eqNullSafe(F.col("own_lang")) & F.col("source").eqNullSafe(F.col("own_source")), "left")
        .join(language, F.col("lang").eqNullSafe(F.col("language_lang")), "left")
        .withColumn("quartiles", F.coalesce("own", "language", everything))
    )
    bounds = []
    for limit in LIMITS:
        q1, q3, rare = (F.get(f"quartiles.{limit.name}", i) for i in range(len(RANKS)))
        beyond = F.when(q3 > q1, q3 + REACH * (q3 - q1)).otherwise(rare)
        bounds.append(F.greatest(beyond, F.when(beyond.isNotNull(), F.lit(limit.least))).alias(f"high_{limit.name}"))
        if limit.both:
            bounds.append((q1 - REACH * (q3 - q1)).alias(f"low_{limit.name}"))
    return stored(
        found.select(F.col("lang").alias("bound_lang"), F.col("source").alias("bound_source"), *bounds), "quality-bounds"
    )


def judge(docs: DataFrame) -> DataFrame:
    """Measures and judges every row of docs (doc_id, text, lang, source): adds `kept` to `measure`'s columns.

    A row is kept if it passes the base rules and lies within the bounds of its
    language and source; nulls there are a language and a source like others. Ties
    with a bound are kept. No rows: no rows.
    """
    measured = stored(measure(docs), "quality-measures")
    bounds = thresholds(measured)
    rows = measured.join(
        bounds, F.col("lang").eqNullSafe(F.col("bound_lang")) & F.col("source").eqNullSafe(F.col("bound_source"))
    )
    fits = ~F.col("base_failed")
    for limit in LIMITS:
        fits &= F.coalesce(F.col(limit.name) <= F.col(f"high_{limit.name}"), F.lit(True))
        if limit.both:
            fits &= F.coalesce(F.col(limit.name) >= F.col(f"low_{limit.name}"), F.lit(True))
    return rows.select(*measured.columns, fits.alias("kept"))
