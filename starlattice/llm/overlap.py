"""Similar pairs inside a small group of sets: position-blocked lists and answers derived from similar sets."""

from __future__ import annotations

import numpy as np


class Group:
    """Sets of sorted hashes, renumbered so that rare tokens come first, sets sorted by size.

    Tokens that only one set of the group has can be in no overlap; they take the
    first places of their set and are not listed.
    """

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        count = len(sets)
        owner = np.repeat(np.arange(count), self.sizes)
        tokens = np.concatenate(sets) if count else np.zeros(0, np.uint64)
        _, inverse, times = np.unique(tokens, return_inverse=True, return_counts=True)
        rank = np.empty(len(times), np.int64)
        rank[np.argsort(times, kind="stable")] = np.arange(len(times))
        alone = int((times == 1).sum())
        local = rank[inverse]
        order = np.lexsort((local, owner))
        owner, local = owner[order], local[order]
        starts = np.concatenate([[0], np.cumsum(self.sizes)])
        place = np.arange(len(local)) - starts[owner]
        shared = local >= alone
        owner, self.tokens, self.places = owner[shared], local[shared] - alone, place[shared]
        self.bounds = np.searchsorted(owner, np.arange(count + 1))
        # Lists by token, inside them by place in the set: what lies too far back is skipped in one block.
        by = np.lexsort((self.places, self.tokens))
        self.list_owner, self.list_place = owner[by], self.places[by]
        self.list_bounds = np.searchsorted(self.tokens[by], np.arange(len(times) - alone + 1))

    def of(self, x: int) -> np.ndarray:
        return self.tokens[self.bounds[x] : self.bounds[x + 1]]

    def entries(self, tokens: np.ndarray) -> int:
        """Entries in the lists of the tokens."""
        return int((self.list_bounds[tokens + 1] - self.list_bounds[tokens]).sum())

    def overlaps(self, tokens: np.ndarray) -> np.ndarray:
        """How many of the tokens each set of the group has."""
        return np.bincount(_ranges(self.list_owner, self.list_bounds[tokens], self.list_bounds[tokens + 1]), minlength=len(self.sizes))

    def candidates(self, x: int, percent: int) -> np.ndarray:
        """Sets no larger than x, and before it among equals, that share a prefix token at places that still allow the overlap."""
        low, high = self.bounds[x], self.bounds[x + 1]
        size = int(self.sizes[x])
        prefix = size - -(-percent * size // 100) + 1
        own = self.places[low:high] < prefix
        tokens, places = self.tokens[low:high][own], self.places[low:high][own]
        # y at place j needs size_y - j >= overlap >= percent / (100 + percent) * (size_x + size_y), size_y <= size_x.
        furthest = size * (100 - percent) // (100 + percent)
        found = []
        for token, i in zip(tokens.tolist(), places.tolist()):
            a, b = self.list_bounds[token], self.list_bounds[token + 1]
            b = a + np.searchsorted(self.list_place[a:b], furthest, side="right")
            y, j = self.list_owner[a:b], self.list_place[a:b]
            sizes = self.sizes[y]
            least = -(-percent * (size + sizes) // (100 + percent))
            fits = (100 * sizes >= percent * size) & (np.minimum(size - i, sizes - j) >= least)
            fits &= (sizes < size) | ((sizes == size) & (y < x))
            found.append(y[fits])
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def _ranges(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    lengths = high - low
    total = int(lengths.sum())
    if not total:
        return values[:0]
    at = np.repeat(low - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(total)
    return values[at]


class Answers:
    """The overlaps of sets with the whole group, each from its own lists or from a similar set's answers."""

    def __init__(self, group: Group):
        self.group = group
        self.asked: list[int] = []
        self.known = np.zeros((16, len(group.sizes)), np.int32)

    def of(self, x: int) -> tuple[np.ndarray, bool]:
        """The overlaps of x, and whether they were derived; whichever reads less is taken."""
        group, count = self.group, len(self.asked)
        own = group.of(x)
        entries = group.entries(own)
        found, derived = None, False
        if count:
            # What the sets asked before share with x is among their answers.
            listed = np.diff(group.bounds)
            changed = listed[self.asked] + len(own) - 2 * self.known[:count, x]
            best = int(np.argmin(changed))
            similar = self.asked[best]
            # Telling the changed tokens apart reads both sets, then come the lists of the changed ones.
            if len(own) + listed[similar] + int(changed[best]) * entries // max(len(own), 1) < entries:
                gone = np.setdiff1d(group.of(similar), own, assume_unique=True)
                new = np.setdiff1d(own, group.of(similar), assume_unique=True)
                found, derived = self.known[best] - group.overlaps(gone) + group.overlaps(new), True
        if found is None:
            found = group.overlaps(own)
        if count == len(self.known):
            self.known = np.concatenate([self.known, np.zeros_like(self.known)])
        self.known[count] = found
        self.asked.append(x)
        return found, derived


def link(sets: list[np.ndarray], side: np.ndarray, weights: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links sets whose Jaccard similarity is at least `percent` hundredths.

    If sides differ, only pairs across them count. Returns for each set the first
    set of its component inside the group, the summed weights of the sets it links
    to, and whether its answers were derived from a similar set's.
    """
    order = np.argsort([len(s) for s in sets], kind="stable")
    group = Group([sets[i] for i in order])
    side, weights = side[order], weights[order]
    two = len(np.unique(side)) > 1
    root = np.arange(len(sets))
    degree = np.zeros(len(sets), np.int64)
    derived = np.zeros(len(sets), bool)
    answers = Answers(group)
    for x in range(len(sets)):
        found = group.candidates(x, percent)
        if two:
            found = found[side[found] != side[x]]
        if not len(found):
            continue
        overlaps, derived[x] = answers.of(x)
        common = overlaps[found]
        linked = found[100 * common >= percent * (group.sizes[x] + group.sizes[found] - common)]
        if len(linked):
            degree[x] += weights[linked].sum()
            degree[linked] += weights[x]
            roots = np.unique(root[np.append(linked, x)])
            if len(roots) > 1:
                root[np.isin(root, roots)] = roots[0]
    first, degrees, by_change = np.empty(len(sets), np.int64), np.empty(len(sets), np.int64), np.empty(len(sets), bool)
    first[order], degrees[order], by_change[order] = order[root], degree, derived
    return first, degrees, by_change
