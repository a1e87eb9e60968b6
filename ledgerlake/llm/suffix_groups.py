"""Suffix arrays by linear grouping, for many short strings at once.

Every suffix starts with its longest Lyndon prefix, and suffixes are ordered first by that. Groups of suffixes with
one known prefix are taken in descending order. What is greater has been taken out of the line of positions, so a
member's left neighbour in the line is its previous smaller suffix, and its right neighbour the next smaller one,
where its Lyndon prefix ends. Each previous smaller suffix gets its prefix lengthened by what follows it (k members in
a row lengthen it k times) and moves up in its group by k. When all groups have been taken they are the final ones,
and the order inside a group is that of the suffixes that follow the common prefix. No string is renamed or solved
again. The strings of a batch are independent and take their steps together, as operations on whole arrays.
"""
from __future__ import annotations

import numpy as np


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges that begin at `starts`, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


class Grouping:
    """Groups of the suffixes of several strings, each a stretch of slots; a string has the slots of its positions."""

    def __init__(self, symbols: np.ndarray, sizes: np.ndarray):
        n = len(symbols)
        ends = np.cumsum(sizes)
        self.first = ends - sizes
        self.taken = ends.copy()  # per string, the slots from here on belong to groups already taken
        of = np.repeat(np.arange(len(sizes)), sizes)
        self.suffix = np.lexsort((symbols, of))
        self.slot = np.empty(n, "i8")
        self.slot[self.suffix] = np.arange(n)
        key = symbols[self.suffix]
        new = np.ones(n, bool)
        new[1:] = (key[1:] != key[:-1]) | (of[self.suffix][1:] != of[self.suffix][:-1])
        starts = np.nonzero(new)[0]
        self.group = np.empty(n, "i8")  # first slot of a suffix's group
        self.group[self.suffix] = np.repeat(starts, np.diff(np.append(starts, n)))
        self.end = np.zeros(n, "i8")  # by first slot
        self.end[starts] = np.append(starts[1:], n)
        self.left, self.right = np.arange(-1, n - 1), np.arange(1, n + 1)
        self.left[self.first[sizes > 0]] = -1
        self.right[ends[sizes > 0] - 1] = -1
        self.following = np.full(n, -1)  # next smaller suffix, where the Lyndon prefix ends
        self.mark = np.zeros(n, bool)

    def run(self) -> None:
        open_ = np.nonzero(self.taken > self.first)[0]
        while len(open_):
            top = self.group[self.suffix[self.taken[open_] - 1]]
            members = np.sort(self.suffix[_ranges(top, self.taken[open_] - top)])
            self.taken[open_] = top
            self.take(members)
            open_ = open_[top > self.first[open_]]

    def take(self, members: np.ndarray) -> None:
        """Take the members (sorted) of each string's highest group out of the line, and move what stands before them."""
        self.following[members] = self.right[members]
        begins = np.ones(len(members), bool)
        begins[1:] = self.left[members[1:]] != members[:-1]
        at = np.nonzero(begins)[0]
        before, times = self.left[members[at]], np.diff(np.append(at, len(members)))
        after = self.right[members[np.append(at[1:], len(members)) - 1]]
        self.right[before[before >= 0]] = after[before >= 0]
        self.left[after[after >= 0]] = before[after >= 0]
        moved, times = before[before >= 0], times[before >= 0]
        if len(moved):
            self.move(moved, times)

    def move(self, moved: np.ndarray, times: np.ndarray) -> None:
        """Put suffixes at the upper end of their groups, ordered by `times`; equal times make a new group."""
        order = np.lexsort((times, self.group[moved]))
        moved, times = moved[order], times[order]
        old = self.group[moved]
        new_old = np.ones(len(moved), bool)
        new_old[1:] = old[1:] != old[:-1]
        at = np.nonzero(new_old)[0]
        count = np.diff(np.append(at, len(moved)))
        group = old[at]
        low = self.end[group] - count
        to, was = _ranges(low, count), self.slot[moved]
        # others that stand where the moved go change places with them
        self.mark[was] = True
        out = to[~self.mark[to]]
        self.mark[was] = False
        self.mark[to] = True
        free = np.sort(was[~self.mark[was]])
        self.mark[to] = False
        stay = self.suffix[out]
        self.suffix[free], self.slot[stay] = stay, free
        self.suffix[to], self.slot[moved] = moved, to
        self.end[group] = low
        new = new_old
        new[1:] |= times[1:] != times[:-1]
        begins = np.nonzero(new)[0]
        sizes = np.diff(np.append(begins, len(moved)))
        self.group[moved] = np.repeat(to[begins], sizes)
        self.end[to[begins]] = to[begins] + sizes

    def ranks(self) -> np.ndarray:
        """The rank of every suffix, counted through the strings: each group in the order of what follows its prefix."""
        rank = np.where(self.end[self.group] - self.group == 1, self.group, -1)
        todo = np.nonzero(rank < 0)[0]
        # Members that are followed by a member of their own group come after those that are not, by the length of the row.
        last, times = self.following[todo], np.zeros(len(todo), "i8")
        inside = self.group[last] == self.group[todo]
        while inside.any():
            times[inside] += 1
            last[inside] = self.following[last[inside]]
            inside[inside] = self.group[last[inside]] == self.group[todo[inside]]
        order = np.argsort(self.group[todo], kind="stable")
        todo, last, times = todo[order], last[order], times[order]
        while len(todo):
            group = self.group[todo]
            begins = np.nonzero(np.append(True, group[1:] != group[:-1]))[0]
            sizes = np.diff(np.append(begins, len(todo)))
            ready = np.repeat(np.logical_and.reduceat(rank[last] >= 0, begins), sizes)
            now = np.nonzero(ready)[0]
            now = now[np.lexsort((rank[last[now]], times[now], group[now]))]
            place = now[np.append(True, group[now][1:] != group[now][:-1])] if len(now) else now
            del place
            starts = np.nonzero(np.append(True, group[now][1:] != group[now][:-1]))[0]
            counts = np.diff(np.append(starts, len(now)))
            rank[todo[now]] = _ranges(group[now][starts], counts)
            todo, last, times = todo[~ready], last[~ready], times[~ready]
        return rank


def suffix_arrays(symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes, string by string.

    Each string must end in such a way that no suffix is a prefix of another, as a unique last symbol makes sure.
    """
    grouping = Grouping(np.asarray(symbols, "i8"), np.asarray(sizes, "i8"))
    grouping.run()
    out = np.empty(len(symbols), "i8")
    out[grouping.ranks()] = np.arange(len(symbols))
    return out
