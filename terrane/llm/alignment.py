"""Wagner-Fischer alignment of a conversation's turns to the alternating grammar ``(s?(ua)+)?``.

The words of the grammar are one string per length: ``ua`` repeated, with a
system turn in front where the length is odd. Turns are aligned to each
feasible length. All lengths share their endings, so one table of suffix costs
serves them all: cell (i, k) is the least cost of editing the turns from i on
into the last k letters. Only the cells within the Ukkonen band of an incumbent
are filled: k letters for m turns need |k - m| insertions or deletions, which
no alignment can afford beyond the incumbent's cost. The audits of all cheapest
lengths are traced back from the front, in the order of their letters, and the
least one is taken.

Long conversations are aligned in segments. A segment is aligned once for each
pair of phases (what the repaired turns end with before and after it), and
neighbours are put together by the least (cost, audit) over the phase between
them. That is exact: two audits of the same turns and the same cost are never a
prefix of one another, so their order does not depend on what follows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

# The costs of the edits.
REROLE = INSERT = TRUNCATED = 3
DELETE = 4

SEGMENT = 256
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
NAMES = {"u": "user", "a": "assistant"}
_NEVER = 1 << 60

Ways = dict[tuple[int, int], tuple[int, str]]  # (phase before, phase after): (cost, audit)


class Turn(NamedTuple):
    initial: str
    deleted: bool    # must go: blank or a duplicate
    truncated: bool


class Table:
    """Suffix costs in the band: ``rows[i][k - low[i]]`` for an ending in ``last``."""

    def __init__(self, turns: Sequence[Turn], last: str, limit: int):
        self.turns, self.letters = turns, (last, "u" if last == "a" else "a")
        more, less = limit // INSERT, limit // DELETE
        low, row, live = 0, [INSERT * k for k in range(more + 1)], 0
        self.low, self.rows = [low], [row]
        for initial, deleted, truncated in reversed(turns):
            below, under = row, low
            if deleted:
                row = [c + DELETE for c in below]
            else:
                live += 1
                low, row, before = max(0, live - less), [], _NEVER
                stay, change = (TRUNCATED, TRUNCATED + REROLE) if truncated else (0, REROLE)
                for k in range(low, live + more + 1):
                    at = k - under
                    before = min(before + INSERT, below[at] + DELETE if at < len(below) else _NEVER)
                    if at > 0:
                        before = min(before, below[at - 1] + (stay if initial == self.letters[(k - 1) % 2] else change))
                    row.append(before)
            self.low.append(low)
            self.rows.append(row)
        self.low.reverse()
        self.rows.reverse()

    def cost(self, i: int, k: int) -> int:
        at = k - self.low[i]
        return self.rows[i][at] if 0 <= at < len(self.rows[i]) else _NEVER

    def lengths(self, i: int, parity: int, least: int) -> range:
        """The lengths of row i with this parity, from ``least`` on."""
        start = max(self.low[i], least)
        return range(start + (start - parity) % 2, self.low[i] + len(self.rows[i]), 2)

    def trace(self, i: int, k: int) -> str:
        """The audit of cell (i, k) that comes first by its letters."""
        out = []
        while i < len(self.turns) or k:
            cost = self.cost(i, k)
            if i < len(self.turns) and self.cost(i + 1, k) + DELETE == cost:
                out.append("D")
                i += 1
            elif k and self.cost(i, k - 1) + INSERT == cost:
                out.append("I")
                k -= 1
            else:
                out.append("K" if self.turns[i].initial == self.letters[(k - 1) % 2] else "R")
                i, k = i + 1, k - 1
        return "".join(out)


def _incumbent(live: Sequence[Turn], last: str) -> int:
    """Cost of keeping all live turns, changing roles where the letters differ."""
    other = "u" if last == "a" else "a"
    return sum((TRUNCATED if t.truncated else 0) + (REROLE if t.initial != (last, other)[n % 2] else 0) for n, t in enumerate(reversed(live)))


def ways(turns: Sequence[Turn], entries: Iterable[int] = range(4), exits: Iterable[int] = range(4)) -> Ways:
    """The cheapest edits of a segment for each pair of phases, ties by the audit."""
    entries, exits, out = set(entries), set(exits), {}
    gone = [0]                                  # cost of deleting the turns before i
    for _ in turns:
        gone.append(gone[-1] + DELETE)
    for phase in (EMPTY, SYSTEM):               # nothing is written
        if phase in entries and phase in exits:
            out[phase, phase] = gone[-1], "D" * len(turns)
    starts = [(p, gone[p] + (TRUNCATED if t.truncated else 0)) for p, t in enumerate(turns)
              if t.initial == "s" and not t.deleted] if EMPTY in entries else []
    if starts and SYSTEM in exits:
        least = min(c + gone[-1] - gone[p + 1] for p, c in starts)
        out[EMPTY, SYSTEM] = least, min("D" * p + "K" + "D" * (len(turns) - p - 1) for p, c in starts if c + gone[-1] - gone[p + 1] == least)
    live = [t for t in turns if not t.deleted]
    for phase, last in ((ASSISTANT, "a"), (USER, "u")):
        if phase not in exits:
            continue
        table = Table(turns, last, _incumbent(live, last) + 2 * INSERT)
        even = 0 if phase == ASSISTANT else 1   # parity of the letters written after nothing, a system or an assistant turn
        for entry in entries:
            found = [(table.cost(0, k), 0, "", k) for k in table.lengths(0, even if entry != USER else 1 - even, 1 if entry in (EMPTY, SYSTEM) else 0)]
            if entry == EMPTY:
                found += [(c + table.cost(p + 1, k), p + 1, "D" * p + "K", k) for p, c in starts for k in table.lengths(p + 1, even, 1)]
            if found and (least := min(f[0] for f in found)) < _NEVER:
                out[entry, phase] = least, min(head + table.trace(i, k) for cost, i, head, k in found if cost == least)
    return out


def deletions(n: int) -> Ways:
    """Ways of ``n`` turns that all must go."""
    return {pair: (cost + n * DELETE, "D" * n + audit) for pair, (cost, audit) in ways(()).items()}


def compose(first: Ways, second: Ways) -> Ways:
    out: Ways = {}
    for (a, m), (cost, audit) in first.items():
        for (b, z), (more, rest) in second.items():
            if m == b:
                way = cost + more, audit + rest
                out[a, z] = min(out.get((a, z), way), way)
    return out


def joined(parts: list[Ways]) -> Ways:
    """The ways of neighbouring segments, put together pairwise."""
    while len(parts) > 1:
        parts = [compose(*parts[i: i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0] if parts else ways(())


def best(whole: Ways) -> tuple[int, str]:
    return min(whole[EMPTY, end] for end in (EMPTY, ASSISTANT) if (EMPTY, end) in whole)


def align(turns: Sequence[Turn], segment: int = SEGMENT) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair of a whole conversation."""
    if len(turns) <= segment:
        return best(ways(turns, (EMPTY,), (EMPTY, ASSISTANT)))
    return best(joined([ways(turns[i: i + segment], (EMPTY,) if i == 0 else range(4)) for i in range(0, len(turns), segment)]))


def edited(audit: str, rows: Iterable[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the turns of the repaired conversation; ``rows`` are (role, text)."""
    rows, place = iter(rows), 0
    odd = (len(audit) - audit.count("D")) % 2
    for edit in audit:
        if edit == "D":
            next(rows)
            continue
        role = "system" if odd and not place else NAMES["ua"[(place - odd) % 2]]
        kept, text = ("", "") if edit == "I" else next(rows)
        yield edit, kept if edit == "K" else role, text
        place += 1
