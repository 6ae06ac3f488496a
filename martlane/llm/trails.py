"""Persistent strings that share their beginnings, and the cheapest edits of a row of turns.

A Trail is the last piece of a string with a link to what comes before, the rolling hash
of the whole and links to its ancestors at distances of powers of two. So a string is
made longer, or branches, in logarithmic time without a copy, and the longest common
prefix of two is found by comparing hashes of their beginnings. Equal hashes are not
taken for equal text: the beginnings are walked back to the node that both share, and
where they differ the exact first difference counts.

Edits form a small automaton over the roles given so far. A step's table has, for each
state it may begin in, the least cost of each state it can end in and the trail of the
edits; of equal costs the trail that is first in ASCII order stays.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

# A prime; as hashes are checked, another one only changes how often they mislead.
PRIME = (1 << 64) - 59

KEEP, DELETE, INSERT, REROLE = "K", "D", "I", "R"
KEPT_CUT, GIVEN, DELETED = 3, 3, 4  # costs: a cut-off row that stays, a role or row given, a row deleted

# Nothing given yet, a system turn, a user's turn, an assistant's turn.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
FINAL = (START, ASSISTANT)
INITIALS = {SYSTEM: "s", USER: "u", ASSISTANT: "a"}
# The state after a user's or assistant's turn, if one may come next.
SPOKEN = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}


class Trail:
    __slots__ = ("piece", "end", "hash", "ups")

    def __init__(self, before: Trail | None, piece: str, prime: int):
        self.piece = piece
        if before is None:
            self.end, self.hash, self.ups = len(piece), 0, ()
            self.hash = _extended(0, piece, prime)
            return
        self.end = before.end + len(piece)
        self.hash = _extended(before.hash, piece, prime)
        ups, k = [before], 0
        while k < len(ups[k].ups):
            ups.append(ups[k].ups[k])
            k += 1
        self.ups = ups

    @property
    def before(self) -> Trail | None:
        return self.ups[0] if self.ups else None

    def holder(self, length: int) -> Trail:
        """The node in whose piece the first ``length`` characters end."""
        node = self
        for k in range(len(node.ups) - 1, -1, -1):
            if k < len(node.ups) and node.ups[k].end >= length:
                node = node.ups[k]
        return node

    def prefix_hash(self, length: int, prime: int) -> int:
        node = self.holder(length)
        if node.end == length:
            return node.hash
        before = node.before
        start = before.end if before else 0
        return _extended(before.hash if before else 0, node.piece[: length - start], prime)

    def text(self) -> str:
        pieces, node = [], self
        while node is not None:
            pieces.append(node.piece)
            node = node.before
        return "".join(reversed(pieces))


def _extended(hash_: int, piece: str, prime: int) -> int:
    data = piece.encode()
    return (hash_ * pow(256, len(data), prime) + int.from_bytes(data)) % prime


def _first_difference(a: Trail, b: Trail, length: int) -> int:
    """Where the first ``length`` characters of two trails first differ; ``length`` if nowhere."""
    found = length
    a, b = a.holder(length), b.holder(length)
    stop = length
    while a is not b and stop:
        start_a, start_b = a.end - len(a.piece), b.end - len(b.piece)
        start = max(start_a, start_b)
        x, y = a.piece[start - start_a : stop - start_a], b.piece[start - start_b : stop - start_b]
        if x != y:
            found = start + next(i for i, (c, d) in enumerate(zip(x, y, strict=True)) if c != d)
        stop = start
        if start == start_a and start:
            a = a.before
        if start == start_b and start:
            b = b.before
    return found


def common(a: Trail, b: Trail, prime: int = PRIME) -> int:
    """The length of the longest common prefix."""
    low, high = 0, min(a.end, b.end)
    while low < high:
        middle = (low + high + 1) // 2
        if a.prefix_hash(middle, prime) == b.prefix_hash(middle, prime):
            low = middle
        else:
            high = middle - 1
    return _first_difference(a, b, low)


def precedes(a: Trail, b: Trail, prime: int = PRIME) -> bool:
    """Whether a's text comes before b's."""
    if a is b:
        return False
    length = common(a, b, prime)
    if length == a.end or length == b.end:
        return a.end < b.end
    own = [node.piece[length - (node.end - len(node.piece))] for node in (a.holder(length + 1), b.holder(length + 1))]
    return own[0] < own[1]


Table = dict[int, tuple[int, Trail]]


class Edits:
    """The cheapest edits of rows given one after another, from one beginning state."""

    def __init__(self, state: int, prime: int = PRIME):
        self.prime = prime
        self.table: Table = {state: (0, Trail(None, "", prime))}

    def _offer(self, table: Table, state: int, cost: int, before: Trail, piece: str) -> None:
        held = table.get(state)
        if held is None or cost <= held[0]:
            self._hold(table, state, cost, Trail(before, piece, self.prime))

    def _hold(self, table: Table, state: int, cost: int, trail: Trail) -> None:
        held = table.get(state)
        if held is None or cost < held[0] or (cost == held[0] and precedes(trail, held[1], self.prime)):
            table[state] = cost, trail

    def _inserted(self) -> Table:
        """The table with up to two rows inserted; a third would lead to a state that is there."""
        table, last = dict(self.table), self.table
        for _ in range(2):
            more: Table = {}
            for state, (cost, trail) in last.items():
                self._offer(more, SPOKEN[state], cost + GIVEN, trail, INSERT)
            for state, (cost, trail) in more.items():
                self._hold(table, state, cost, trail)
            last = more
        return table

    def delete(self, times: int = 1) -> None:
        """Rows that must go. Rows inserted before them would come later in ASCII order than after."""
        if times:
            self.table = {
                state: (cost + DELETED * times, Trail(trail, DELETE * times, self.prime))
                for state, (cost, trail) in self.table.items()
            }

    def row(self, initial: str, cut: bool) -> None:
        """A row whose role begins with ``initial``; ``cut`` if its text breaks off."""
        kept = KEPT_CUT if cut else 0
        table: Table = {}
        for state, (cost, trail) in self.table.items():
            self._offer(table, state, cost + DELETED, trail, DELETE)
        for state, (cost, trail) in self._inserted().items():
            spoken = SPOKEN[state]
            own = SYSTEM if state == START and initial == "s" else spoken
            if initial == INITIALS[own]:
                self._offer(table, own, cost + kept, trail, KEEP)
            self._offer(table, spoken, cost + kept + GIVEN, trail, REROLE)
        self.table = table

    def follow(self, steps: dict[int, list[tuple[int, int, str]]]) -> None:
        """Rows worked out elsewhere: for each beginning state (end state, cost, edits)."""
        table: Table = {}
        for state, (cost, trail) in self.table.items():
            for end, more, edits in steps[state]:
                self._offer(table, end, cost + more, trail, edits)
        self.table = table

    def steps(self) -> list[tuple[int, int, str]]:
        return [(end, cost, trail.text()) for end, (cost, trail) in self.table.items()]

    def cheapest(self) -> tuple[int, str]:
        """Cost and edits of the cheapest way to end, with rows inserted at the end if need be."""
        ends: Table = {}
        for state, (cost, trail) in self._inserted().items():
            if state in FINAL:
                self._hold(ends, START, cost, trail)
        cost, trail = ends[START]
        return cost, trail.text()


def applied(audit: str, rows: Iterable[tuple[str, str, int]]) -> Iterator[tuple[str, str]]:
    """The (role, text) turns that an audit makes of rows.

    Rows are (role, text, times): the first edit is the row's, further times are deleted.
    """
    at, state = 0, START

    def given() -> str:
        nonlocal state
        state = SPOKEN[state]
        return "user" if state == USER else "assistant"

    for role, text, times in rows:
        if not times:
            continue
        while audit[at] == INSERT:
            at += 1
            yield given(), ""
        edit = audit[at]
        if edit == KEEP and state == START and role[:1] == "s":
            state = SYSTEM
            yield role, text
        elif edit != DELETE:
            name = given()
            yield (role if edit == KEEP else name), text
        at += 1
        if not audit.startswith(DELETE * (times - 1), at):
            raise ValueError(f"the audit keeps a repeated row at {at}")
        at += times - 1
    for _ in audit[at:]:
        yield given(), ""
