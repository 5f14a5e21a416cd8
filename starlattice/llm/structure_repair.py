"""Conversation structure repair: faults, and the cheapest edits that leave `(s?(ua)+)?`."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from starlattice.llm.common import stored
from starlattice.llm.structure_grammar import (
    FAULTS,
    LETTERS,
    ROLES,
    Grammar,
    after,
    choose_states,
    learn,
    letters_of,
    wanted,
)
from starlattice.llm.turns import in_order

# Rows of a piece: 2 ** 12. A longer conversation is solved in pieces, whose matrices are then joined.
PIECE_BITS = 12
# Texts that a conversation says again, up to this many are broadcast: a digest and two longs, at most about 50 MB.
BROADCAST_REPEATS = 500_000
SPACES = " \t\n\x0b\x0c\r"
ENDS = ".!?"
ROLE_NAMES = {"u": "user", "a": "assistant"}


@dataclass
class Repaired:
    """`report`: one row a conversation with its faults, cost and edits; `rows`: the repaired conversations."""

    report: DataFrame
    rows: DataFrame


def _faults(lines: DataFrame) -> DataFrame:
    """Adds `letter`: the role initial and the first fault of each line."""
    repeats = stored(
        lines.groupBy("conv_id", "digest").agg(F.min("place").alias("first_place"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"),
        "repeated-turns",
    ).select(F.col("conv_id").alias("said_in"), F.col("digest").alias("said"), "first_place")
    small = repeats.count() <= BROADCAST_REPEATS
    same = F.col("conv_id").eqNullSafe(F.col("said_in")) & (F.col("digest") == F.col("said"))
    marked = lines.join(F.broadcast(repeats) if small else repeats, same, "left")
    fault = (
        F.when(F.col("last_character") == "", 0)
        .when(F.col("place") > F.col("first_place"), 1)
        .when(~F.col("last_character").isin(*ENDS), 2)
        .otherwise(3)
    )
    role = F.coalesce(*[F.when(F.col("initial") == r, F.lit(i)) for i, r in enumerate(ROLES[:-1])], F.lit(len(ROLES) - 1))
    return marked.select(
        "conv_id", "turn", "place", F.substring(F.lit(LETTERS), role * len(FAULTS) + fault + 1, F.lit(1)).alias("letter")
    )


def _count(letters: str) -> Column:
    return F.regexp_count("letters", F.lit(f"[{letters}]")).cast("long")


def _pieces(lines: DataFrame) -> DataFrame:
    """Runs of at most 2 ** PIECE_BITS lines of a conversation: their letters, and what the counts need."""
    line = F.struct("place", "letter", "turn")
    gathered = (
        _faults(lines)
        .groupBy("conv_id", F.shiftright("place", PIECE_BITS).alias("piece"))
        .agg(F.sort_array(F.collect_list(line)).alias("lines"))
    )
    turns = F.array_compact(F.array_distinct("lines.turn"))
    legal = "|".join(f"[{letters_of(a)}](?=[{letters_of(b)}])" for a, b in ("su", "ua", "au"))
    return (
        gathered.select(
            "conv_id",
            "piece",
            F.element_at("lines.place", 1).alias("first_place"),
            F.array_join("lines.letter", "").alias("letters"),
            F.size(turns).cast("long").alias("n_turns"),
            F.array_min(turns).alias("first_turn"),
            F.array_max(turns).alias("last_turn"),
        )
        .withColumn("legal", F.regexp_count("letters", F.lit(legal)).cast("long"))
    )


def _joined(pieces: DataFrame) -> DataFrame:
    """Adds what lies between pieces of a conversation: a legal pair of roles, a turn that goes on."""
    by_piece = Window.partitionBy("conv_id").orderBy("piece")
    before = F.lag(F.right("letters", F.lit(1))).over(by_piece)
    across = F.concat(before, F.substring("letters", 1, 1))
    legal = "|".join(f"[{letters_of(a)}][{letters_of(b)}]" for a, b in ("su", "ua", "au"))
    goes_on = F.lag("last_turn").over(by_piece) == F.col("first_turn")
    return pieces.select(
        "*",
        F.count(F.lit(1)).over(Window.partitionBy("conv_id")).alias("n_pieces"),
        F.lead("piece").over(by_piece).isNull().alias("last_piece"),
        F.coalesce(across.rlike(legal).cast("long"), F.lit(0)).alias("legal_across"),
        F.coalesce(goes_on.cast("long"), F.lit(0)).alias("turn_across"),
    )


def _states(pieces: DataFrame, grammar: Grammar) -> DataFrame:
    """conv_id, piece, start, end: the states around each piece of the conversations that have several."""

    @F.pandas_udf("struct<costs:array<long>,ranks:array<long>>")
    def transfers(letters: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([grammar.transfers(x) for x in letters], columns=["costs", "ranks"])

    def choose(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values("piece")
        way = choose_states(list(batch["costs"]), list(batch["ranks"]))
        return pd.DataFrame(
            {"conv_id": batch["conv_id"], "piece": batch["piece"], "start": [s for s, _ in way], "end": [e for _, e in way]}
        )

    kind = dict(pieces.dtypes)["conv_id"]
    several = pieces.where("n_pieces > 1").select("conv_id", "piece", transfers("letters").alias("t"))
    # A conversation sends 32 numbers for every piece of its rows, never the rows.
    return (
        several.select("conv_id", "piece", "t.costs", "t.ranks")
        .groupBy("conv_id")
        .applyInPandas(choose, f"conv_id {kind}, piece long, start int, end int")
    )


def _solved(pieces: DataFrame, grammar: Grammar) -> DataFrame:
    """Adds start, the state before each piece, and its cost and audit."""

    @F.pandas_udf("struct<cost:long,audit:string>")
    def solve(letters: pd.Series, start: pd.Series, end: pd.Series, last: pd.Series) -> pd.DataFrame:
        asked = list(zip(letters, start, end, last))
        known = {x: grammar.solve(x[0], x[1], None if x[2] < 0 else x[2], x[3]) for x in set(asked)}
        return pd.DataFrame([known[x] for x in asked], columns=["cost", "audit"])

    states = _states(pieces, grammar).select(
        F.col("conv_id").alias("state_of"), F.col("piece").alias("state_piece"), "start", "end"
    )
    same = F.col("conv_id").eqNullSafe(F.col("state_of")) & (F.col("piece") == F.col("state_piece"))
    # A conversation of one piece starts with nothing written and may end in any state.
    start, end = F.coalesce("start", F.lit(0)), F.coalesce("end", F.lit(-1))
    return (
        pieces.join(states, same, "left")
        .select(*pieces.columns, start.alias("start"), solve("letters", start, end, "last_piece").alias("found"))
        .select(*pieces.columns, "start", "found.cost", "found.audit")
    )


def _report(solved: DataFrame) -> DataFrame:
    counts = [
        F.sum(_count(letters_of(faults=f))).alias(name)
        for f, name in (("b", "blank"), ("d", "duplicate"), ("t", "truncated"))
    ]
    pairs = F.sum(F.length("letters")) - 1 - F.sum(F.col("legal") + F.col("legal_across"))
    span = F.max("last_turn") - F.min("first_turn") + 1 - F.sum(F.col("n_turns") - F.col("turn_across"))
    audits = F.transform(F.sort_array(F.collect_list(F.struct("piece", "audit"))), lambda x: x.audit)
    return solved.groupBy("conv_id").agg(
        F.coalesce(span, F.lit(0)).cast("long").alias("gaps"),
        *counts,
        pairs.cast("long").alias("illegal"),
        F.sum("cost").alias("cost"),
        F.array_join(audits, "").alias("audit"),
    )


def _apply(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The edits of each piece, then its lines in order: to the rows that stay, step by step."""
    edits: list[str] = []
    at, state = 0, 0
    for batch in batches:
        out: list[tuple] = []
        for conv, place, role, text, audit, start in zip(*(column.to_pylist() for column in batch.columns)):
            if audit is not None:
                edits, at, state = re.findall("I*[DKR]I*$|I*[DKR]", audit), 0, start
                continue
            for step, edit in enumerate(edits[at]):
                if edit == "D":
                    continue
                if edit != "K":
                    role_now = ROLE_NAMES[wanted(state)]
                    out.append((conv, place, step, role_now, text if edit == "R" else "", edit))
                    state = after(state, wanted(state))
                else:
                    out.append((conv, place, step, role, text, edit))
                    state = after(state, role[:1])
            at += 1
        columns = zip(*out) if out else [()] * len(schema)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _repaired(lines: DataFrame, solved: DataFrame) -> DataFrame:
    piece = F.shiftright("place", PIECE_BITS).alias("piece")
    texts = lines.select("conv_id", piece, "place", F.lit(1).alias("line"), "role", "text", _none("audit"), _none("start", "int"))
    edits = solved.select(
        "conv_id", "piece", F.col("first_place").alias("place"), F.lit(0).alias("line"), _none("role"), _none("text"), "audit", "start"
    )
    order = ("conv_id", "piece", "place", "line")
    streamed = (
        texts.union(edits)
        .repartition("conv_id", "piece")
        .sortWithinPartitions(*order)
        .select("conv_id", "place", "role", "text", "audit", "start")
    )
    kind = dict(lines.dtypes)["conv_id"]
    written = T.StructType.fromDDL(f"conv_id {kind}, place long, step int, role string, text string, edit string")
    schema = to_arrow_schema(written)
    return streamed.mapInArrow(lambda batches: _apply(batches, schema), written)


def _none(name: str, kind: str = "string") -> Column:
    return F.lit(None).cast(kind).alias(name)


def repair(turns: DataFrame) -> Repaired:
    """Faults of conversations (conv_id, turn, role, text) and the cheapest edits that mend them.

    Turns go by turn (null first), then role and text. A line's first fault counts: blank
    (nothing but white space), duplicate (role and text said earlier in the
    conversation), truncated (the last character that is no white space is none of
    `.!?`). Keeping a line costs 0, a new role (user or assistant) 1, deleting 2 (blank and
    duplicate lines must go), inserting an empty user or assistant line 5, and a truncated line
    that stays 5 more; the role initials that stay read `(s?(ua)+)?`. Of equally cheap
    edits the ASCII-least string of D, I, K, R is taken.

    `report` has a row for each conversation that has lines: conv_id, gaps (numbers missing
    between its first and last turn; turns that are null count for nothing), blank,
    duplicate, truncated, illegal (neighbours whose initials are not su, ua or au), cost
    and audit (one letter an edit). `rows` has the lines that stay: conv_id, place, step (their
    order), role, text, edit (K, R or I). Null roles and texts count as empty; a null
    conv_id is one conversation; repeated rows are duplicates. No rows: no rows. Other
    columns are not read. A long conversation is ordered, marked and edited in many tasks; its
    audit is one string.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    known = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    keep = {
        "conv_id": F.col("conv_id"),
        "turn": F.col("turn"),
        "role": F.col("role"),
        "text": F.col("text"),
        "initial": F.substring("role", 1, 1),
        "last_character": F.right(F.rtrim(F.col("text"), F.lit(SPACES)), F.lit(1)),
        "digest": F.unhex(said),
    }
    lines = in_order(known, keep, "ordered-turns")
    pieces = stored(_joined(_pieces(lines)), "turn-pieces")
    solved = stored(_solved(pieces, learn(pieces)), "solved-pieces")
    return Repaired(_report(solved), _repaired(lines, solved))
