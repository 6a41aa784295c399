"""Cheapest edits that make a conversation's roles well formed, by iterative-deepening A*.

A conversation is a string of classes, a letter per row: ``s``, ``u``, ``a`` by the role's initial
(``o`` for any other), in capitals if the row is truncated, ``x`` if it must be deleted. Edits are
tried in ASCII order (Delete, Insert, Keep, Rerole), so the first path that a cost bound admits is
the least audit among the cheapest.
"""

from __future__ import annotations

from functools import lru_cache

# Fixed values of the contract.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
LEGAL = ("su", "ua", "au")

# What stands before: nothing yet, a system turn, a user turn, an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
AFTER = "?sua"
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT,
        (ASSISTANT, "u"): USER}
ENDS = (START, ASSISTANT)
WANTED = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}

# Suffixes are solved one after another, from the end, each this many rows longer: what follows a
# stretch is known when it is searched, so the depth of a search does not grow with a conversation.
STEP = 64
CACHED_ROWS = 32


class Search:
    """One conversation. A node is (rows read, what stands before), as ``4 * read + before``."""

    def __init__(self, classes: str):
        self.classes = classes
        self.size = len(classes)
        self.goals = {4 * self.size + end for end in ENDS}
        # Failed states: the least cost from a node to the end that is not refuted yet.
        self.table: dict[int, int] = {}
        self.solved: set[int] = set()
        self.forced, self.pairs, self.heads = ([0] * (self.size + 1) for _ in range(3))
        self.free = [""] * (self.size + 1)

    def bound(self, begin: int, end: int) -> None:
        """For each place in a stretch of rows: what every repair pays from there on, a bound on
        what else the stretch costs for neighbours that may not stand together, that bound without
        its first free row, and this row's class.

        Two free rows (not deleted by force) that may not be neighbours need an insertion between
        them or an edit of either; pairs that share no row need different edits. So the heaviest
        set of disjoint pairs is a lower bound.
        """
        forced = min(self.table[4 * end + before] for before in range(4)) if end < self.size else 0
        pairs, heads, following = 0, 0, ""
        for i in range(end - 1, begin - 1, -1):
            one = self.classes[i]
            if one == "x":
                forced += DELETE
            else:
                forced += TRUNCATED * one.isupper()
                # The pair of this row and the next free one leaves what follows the next one.
                paired = weight(one, following) if following or end == self.size else 0
                pairs, heads, following = max(pairs, paired + heads), pairs, one
            self.forced[i], self.pairs[i], self.heads[i] = forced, pairs, heads
            self.free[i] = following

    def estimate(self, node: int) -> int:
        """A cost that no path from the node to the end goes below."""
        known = self.table.get(node)
        if known is None:
            read, before = divmod(node, 4)
            rest, known = self.free[read], self.forced[read]
            if rest:
                first = 0 if (before, rest.lower()) in NEXT else weight("", rest)
                known += max(self.pairs[read], first + self.heads[read])
            elif read == self.size and before not in ENDS:
                known += INSERT
            self.table[node] = known
        return known

    def edits(self, node: int) -> list[tuple[str, int, int]]:
        """Letter, cost and next node of every edit, in ASCII order."""
        read, before = divmod(node, 4)
        found = []
        if read < self.size:
            one = self.classes[read]
            found.append(("D", DELETE, node + 4))
        found.append(("I", INSERT, 4 * read + NEXT[before, WANTED[before]]))
        if read < self.size and one != "x":
            extra = TRUNCATED * one.isupper()
            if (before, one.lower()) in NEXT:
                found.append(("K", extra, 4 * (read + 1) + NEXT[before, one.lower()]))
            found.append(("R", REROLE + extra,
                          4 * (read + 1) + NEXT[before, WANTED[before]]))
        return found

    def within(self, root: int, bound: int, whole: bool) -> str | None:
        """The first path from ``root`` that costs at most ``bound``. If there is none, the table
        holds a greater cost for it. Unless ``whole``, a path may end in a solved node."""
        if root in self.goals:
            return ""
        path: list[str] = []
        frames = [[root, bound, iter(self.edits(root)), None, 0]]
        while frames:
            node, left, edits, least, _ = frame = frames[-1]
            for letter, cost, child in edits:
                rest = left - cost
                needed = self.estimate(child)
                if needed > rest:
                    least = cost + needed if least is None else min(least, cost + needed)
                    continue
                if child in self.goals or (not whole and child in self.solved):
                    return "".join([*path, letter])
                frame[3] = least
                path.append(letter)
                frames.append([child, rest, iter(self.edits(child)), None, cost])
                break
            else:
                frames.pop()
                self.table[node] = max(self.estimate(node), least)
                if frames:
                    path.pop()
                    above, needed = frames[-1], frame[4] + self.table[node]
                    above[3] = needed if above[3] is None else min(above[3], needed)
        return None

    def deepened(self, root: int, whole: bool) -> str:
        """Bounds rise to the least cost that is not refuted, until one admits a path."""
        while (path := self.within(root, self.estimate(root), whole)) is None:
            pass
        self.solved.add(root)
        return path

    def run(self) -> tuple[str, int]:
        """The audit and its cost."""
        end = self.size
        while end > STEP:
            self.bound(end - STEP, end)
            end -= STEP
            for before in range(4):
                self.deepened(4 * end + before, whole=False)
        self.bound(0, end)
        audit = self.deepened(START, whole=True)
        return audit, self.estimate(START)


def weight(left: str, right: str) -> int:
    """Least further cost of two neighbours; "" is the end on the right, a fixed turn that does not
    fit on the left. Deleting a truncated row costs only one more than keeping it."""
    if not right and left.lower() == "a" or left and (left + right).lower() in LEGAL:
        return 0
    return DELETE - TRUNCATED if left.isupper() or right.isupper() else min(INSERT, REROLE)


@lru_cache(maxsize=100_000)
def cached(classes: str) -> tuple[str, int]:
    return Search(classes).run()


def cheapest(classes: str) -> tuple[str, int]:
    """The audit (a letter per edit) and its cost. Short conversations repeat, so they are kept."""
    return cached(classes) if len(classes) <= CACHED_ROWS else Search(classes).run()
