"""A Re-Pair grammar over fault sequences, with one min-plus transfer matrix and audit rope for each symbol.

A letter stands for one row: its role initial and its fault. The rows that stay must
read `(s?(ua)+)?`, which an automaton of four states accepts: nothing written, an s,
a u, an a. The matrix of a symbol holds, for every state before and after its rows,
the least cost and the ASCII-least edits (D, I, K, R) of that cost.

Inserts are counted to the row after them, so that the edits of a symbol end in the edit of
a row. Edits of equal cost between two states then never begin one another, and
the least of a concatenation is the concatenation of the least.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROLES, FAULTS = "suao", "bdtk"  # o: any other initial; blank, duplicate, truncated, or none
LETTERS = "ABCDEFGHIJKLMNOP"  # one for each role and fault
STATES = 4
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

RULES_A_ROUND = 48
ROUNDS = 6
LEAST_PAIRS = 4
FIRST_RULE = 0xE000

# A rope is a string, or a pair of ropes.
Rope = str | tuple
Entry = tuple[int, Rope] | None
Matrix = list[list[Entry]]


def letter(role: str, fault: str) -> str:
    return LETTERS[ROLES.index(role) * len(FAULTS) + FAULTS.index(fault)]


def letters_of(roles: str = ROLES, faults: str = FAULTS) -> str:
    return "".join(letter(r, f) for r in roles for f in faults)


def after(state: int, role: str) -> int | None:
    """The state after a role is written, None where it must not stand."""
    if role == "s":
        return 1 if state == 0 else None
    if role == "u":
        return 2 if state != 2 else None
    return 3 if role == "a" and state == 2 else None


def wanted(state: int) -> str:
    return "a" if state == 2 else "u"


def _closing(state: int) -> int:
    """Rows to insert at the end."""
    return (0, 2, 1, 0)[state]


def _leaves(rope: Rope) -> Iterator[str]:
    waiting = [rope]
    while waiting:
        part = waiting.pop()
        if isinstance(part, str):
            yield part
        else:
            waiting += [part[1], part[0]]


def spelled(rope: Rope) -> str:
    return "".join(_leaves(rope))


def _less(a: Rope, b: Rope) -> bool:
    for x, y in zip(chain.from_iterable(_leaves(a)), chain.from_iterable(_leaves(b))):
        if x != y:
            return x < y
    return False


def _better(new: tuple[int, Rope], old: Entry) -> bool:
    return old is None or new[0] < old[0] or (new[0] == old[0] and _less(new[1], old[1]))


def letter_matrix(of: str) -> Matrix:
    place = LETTERS.index(of)
    role, fault = ROLES[place // len(FAULTS)], FAULTS[place % len(FAULTS)]
    found: Matrix = [[None] * STATES for _ in range(STATES)]
    for before in range(STATES):
        state, inserted = before, ""
        # After two inserts the automaton is in a state it was in before.
        for _ in range(3):
            paid = INSERT * len(inserted)
            edits = [(state, paid + DELETE, inserted + "D")]
            if fault not in "bd":
                more = paid + (TRUNCATED if fault == "t" else 0)
                edits.append((after(state, wanted(state)), more + REROLE, inserted + "R"))
                kept = after(state, role)
                if kept is not None:
                    edits.append((kept, more + KEEP, inserted + "K"))
            for end, cost, edit in edits:
                if _better((cost, edit), found[before][end]):
                    found[before][end] = (cost, edit)
            state, inserted = after(state, wanted(state)), inserted + "I"
    return found


def _step(row: Sequence[Entry], matrix: Matrix) -> list[Entry]:
    out: list[Entry] = [None] * STATES
    for middle, first in enumerate(row):
        if first is None:
            continue
        for end, second in enumerate(matrix[middle]):
            if second is not None:
                new = (first[0] + second[0], (first[1], second[1]))
                if _better(new, out[end]):
                    out[end] = new
    return out


class Grammar:
    """Pairs in the order they are replaced, and the matrix of each symbol, made bottom-up."""

    def __init__(self, pairs: Iterable[str] = ()):
        self.pairs: list[tuple[str, str]] = []
        self.matrices = {x: letter_matrix(x) for x in LETTERS}
        for pair in pairs:
            self.add(pair)

    def add(self, pair: str) -> None:
        symbol = chr(FIRST_RULE + len(self.pairs))
        left, right = (self.matrices[x] for x in pair)
        self.pairs.append((pair, symbol))
        self.matrices[symbol] = [_step(row, right) for row in left]

    def shorten(self, letters: str) -> str:
        for pair, symbol in self.pairs:
            if pair in letters:
                letters = letters.replace(pair, symbol)
        return letters

    def from_state(self, letters: str, start: int) -> list[Entry]:
        """Least cost and edits to each state after the letters."""
        row: list[Entry] = [None] * STATES
        row[start] = (0, "")
        for symbol in self.shorten(letters):
            row = _step(row, self.matrices[symbol])
        return row

    def solve(self, letters: str, start: int, end: int | None, last: bool) -> tuple[int, str]:
        """Cost and edits from a state to a state, or to the best one; `last` adds the inserts at the end."""
        best: Entry = None
        for state, entry in enumerate(self.from_state(letters, start)):
            if entry is not None and end in (None, state):
                more = _closing(state) if last else 0
                whole = (entry[0] + INSERT * more, (entry[1], "I" * more))
                if _better(whole, best):
                    best = whole
        return best[0], spelled(best[1])

    def transfers(self, letters: str) -> tuple[list[int], list[int]]:
        """For every pair of states the cost (-1: none) and the rank of the edits among those of the start."""
        costs, ranks = [], []
        for start in range(STATES):
            row = self.from_state(letters, start)
            order = sorted(spelled(e[1]) for e in row if e is not None)
            costs += [-1 if e is None else e[0] for e in row]
            ranks += [-1 if e is None else order.index(spelled(e[1])) for e in row]
        return costs, ranks


def choose_states(costs: Sequence[Sequence[int]], ranks: Sequence[Sequence[int]]) -> list[tuple[int, int]]:
    """The states before and after each piece of a conversation on its cheapest, ASCII-least way."""
    unreached = 1 << 60
    to_go = [[INSERT * _closing(s) for s in range(STATES)]]
    for cost in reversed(costs):
        after = to_go[-1]
        to_go.append(
            [
                min((cost[s * STATES + e] + after[e] if cost[s * STATES + e] >= 0 else unreached) for e in range(STATES))
                for s in range(STATES)
            ]
        )
    to_go.reverse()
    state, way = 0, []
    for cost, rank, after in zip(costs, ranks, to_go[1:]):
        cells = range(state * STATES, (state + 1) * STATES)
        total = {i: cost[i] + after[i % STATES] for i in cells if cost[i] >= 0}
        least = min(total.values())
        end = min((i for i, t in total.items() if t == least), key=lambda i: rank[i]) % STATES
        way.append((state, end))
        state = end
    return way


def learn(strings: DataFrame) -> Grammar:
    """Re-Pair over the distinct strings (column `letters`), many pairs a round, most frequent first.

    A round is one pass that counts neighbouring symbols in all strings after the
    rules so far. At most ROUNDS * RULES_A_ROUND rules reach the driver; symbols
    beyond the grammar stay letters, so its bound costs time and never results.
    """
    distinct = strings.select("letters").distinct()
    grammar = Grammar()
    for _ in range(ROUNDS):
        known = Grammar([p for p, _ in grammar.pairs])

        def count(batches: Iterator[pd.DataFrame], known: Grammar = known) -> Iterator[pd.DataFrame]:
            seen: Counter = Counter()
            for batch in batches:
                for letters in batch["letters"]:
                    short = known.shorten(letters)
                    seen.update(a + b for a, b in zip(short, short[1:]))
            yield pd.DataFrame(list(seen.items()), columns=["pair", "n"])

        counts = distinct.mapInPandas(count, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        most = counts.where(F.col("n") >= LEAST_PAIRS).orderBy(F.col("n").desc(), "pair").limit(RULES_A_ROUND).collect()
        if not most:
            break
        for row in most:
            grammar.add(row["pair"])
    return grammar
