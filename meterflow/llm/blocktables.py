"""Cheapest edits of a turn sequence, by Four-Russians block tables.

A row of a conversation is a symbol: whether it must be deleted, its role's initial, and
whether keeping it costs one more. The rows are edited into a string
of role initials that ``(s?(ua)+)?`` matches; four states read that: start, after s,
after u, after a. The cost vector of a prefix holds the least cost of ending in each
state. Less its minimum it is one of few vectors, since an entry more than ``CAP`` above
the minimum never pays: from any state two inserted turns reach the state after a, which
does all that the others can for at most three more. So

* ``Tables`` lists the normalised vectors and, for every vector and every block of
  ``BLOCK`` symbols, the vector behind the block and what its minimum rose by;
* a sequence is read block by block with one look-up each (``forward``), which also goes
  for all vectors at once (``transfers``), so that pieces of one sequence can be read
  apart and put together;
* blocks are expanded backward, symbol by symbol, to mark the states on cheapest paths
  (``marks``). Going forward over marked states only, the least letter is taken at each
  step: of equally cheap edits the result is the ASCII-least. Deleting, inserting,
  keeping and reroling have different letters, and a state allows one inserted role
  only, so the letters decide the edits.

Nothing here knows Spark; ``structure`` applies it to pieces of conversations.
"""

from __future__ import annotations

import functools

import numpy as np

#: The costs of the edits.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: The role that a state allows to be inserted, and the state behind it; states are start, s, u, a.
STATES = 4
START, SYSTEM, USER, ASSISTANT = range(STATES)
NEXT_TURN = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ENDS = (START, ASSISTANT)
CAP = 7
FAR = 99
BLOCK = 4
#: Symbol 0 must be deleted; 1 + 2 * initial + truncated, with initials s, u, a and any other.
SYMBOLS = 9
INITIALS = {"s": 0, "u": 1, "a": 2}


def symbol(role: str, gone: bool, truncated: bool) -> int:
    """The symbol of a row; an empty role has no initial that can be kept."""
    return 0 if gone else 1 + 2 * INITIALS.get(role[:1], 3) + truncated


def row_edges(state: int, sym: int) -> list[tuple[str, int, int]]:
    """Edits that use up a row in a state: (letter, cost, state behind)."""
    edges = [("D", DELETE, state)]
    if sym:
        initial, more = divmod(sym - 1, 2)
        turn = NEXT_TURN[state]
        kept = {1: USER, 2: ASSISTANT}.get(initial)
        if kept == turn:
            edges.append(("K", KEEP + more * TRUNCATED, turn))
        if initial == 0 and state == START:
            edges.append(("K", KEEP + more * TRUNCATED, SYSTEM))
        edges.append(("R", REROLE + more * TRUNCATED, turn))
    return edges


def _closed(vector: list[int]) -> list[int]:
    """A cost vector with inserted turns."""
    out = list(vector)
    for _ in range(STATES):
        for state, turn in NEXT_TURN.items():
            out[turn] = min(out[turn], out[state] + INSERT)
    return out


def _normal(vector: list[int]) -> tuple[tuple[int, ...], int]:
    least = min(vector)
    return tuple(v - least if v - least <= CAP else FAR for v in vector), least


class Tables:
    """Vectors, transitions and marks; vector 0 is that of the empty prefix."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        first, _ = _normal(_closed([0, FAR, FAR, FAR]))
        self.vectors, known = [first], {first: 0}
        step, rise = [], []
        for vector in self.vectors:  # grows while it is gone through
            for sym in range(SYMBOLS):
                after = [FAR] * STATES
                for state in range(STATES):
                    for _, cost, behind in row_edges(state, sym):
                        after[behind] = min(after[behind], vector[state] + cost)
                after, least = _normal(_closed(after))
                if after not in known:
                    known[after] = len(self.vectors)
                    self.vectors.append(after)
                step.append(known[after])
                rise.append(least)
        count = len(self.vectors)
        self.step = np.array(step, np.int32).reshape(count, SYMBOLS)
        self.rise = np.array(rise, np.int32).reshape(count, SYMBOLS)
        self.jump, self.jump_rise = self.step, self.rise
        for _ in range(block - 1):  # a block is a shorter block and one more symbol
            after = self.jump[:, :, None]
            self.jump_rise = (self.jump_rise[:, :, None] + self.rise[after, np.arange(SYMBOLS)]).reshape(count, -1)
            self.jump = self.step[after, np.arange(SYMBOLS)].reshape(count, -1)
        self._places = SYMBOLS ** np.arange(block)[::-1]
        self._back: dict[tuple[int, int], tuple[int, ...]] = {}
        self._pick: dict[tuple[int, int, int, int], tuple[str, int]] = {}

    def blocks(self, symbols: np.ndarray) -> tuple[list[int], list[int]]:
        """Numbers of the whole blocks of a sequence, and the symbols after the last one."""
        whole = len(symbols) // self.block * self.block
        numbers = symbols[:whole].reshape(-1, self.block).astype(np.int64) @ self._places
        return numbers.tolist(), symbols[whole:].tolist()

    def forward(self, symbols: np.ndarray, vector: int = 0) -> tuple[list[int], int, int]:
        """Vectors before each block and each symbol after the last block, vector at the end, rise of the minimum."""
        numbers, rest = self.blocks(symbols)
        seen, total = [], 0
        for number in numbers:
            seen.append(vector)
            total += int(self.jump_rise[vector, number])
            vector = int(self.jump[vector, number])
        for sym in rest:
            seen.append(vector)
            total += int(self.rise[vector, sym])
            vector = int(self.step[vector, sym])
        return seen, vector, total

    def transfers(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every vector before the sequence the one behind it and the rise."""
        at = np.arange(len(self.vectors))
        total = np.zeros(len(at), np.int64)
        numbers, rest = self.blocks(symbols)
        for number in numbers:
            total += self.jump_rise[at, number]
            at = self.jump[at, number]
        for sym in rest:
            total += self.rise[at, sym]
            at = self.step[at, sym]
        return at, total

    def end(self, vector: int) -> tuple[int, int]:
        """Cost above the minimum of ending behind this vector, and the marked states (bits)."""
        least = min(self.vectors[vector][s] for s in ENDS)
        return least, self._inserted(vector, sum(1 << s for s in ENDS if self.vectors[vector][s] == least))

    def _inserted(self, vector: int, mask: int) -> int:
        """The states from which cheapest inserts lead to marked ones, with those."""
        costs = self.vectors[vector]
        for _ in range(STATES):
            for state, turn in NEXT_TURN.items():
                if mask >> turn & 1 and costs[state] < FAR and costs[state] + INSERT == costs[turn]:
                    mask |= 1 << state
        return mask

    def back(self, vector: int, sym: int) -> tuple[int, ...]:
        """For each set of marked states behind a symbol the marked states before it."""
        found = self._back.get((vector, sym))
        if found is None:
            before, after = self.vectors[vector], self.vectors[self.step[vector, sym]]
            least, masks = int(self.rise[vector, sym]), []
            for mask in range(1 << STATES):
                marked = 0
                for state in range(STATES):
                    for _, cost, behind in row_edges(state, sym):
                        if before[state] < FAR and mask >> behind & 1 and before[state] + cost - least == after[behind]:
                            marked |= 1 << state
                masks.append(self._inserted(vector, marked))
            found = self._back[vector, sym] = tuple(masks)
        return found

    def expand(self, symbols: np.ndarray, vector: int = 0) -> list[int]:
        """The vector before each symbol: blocks are jumped, then filled in from the last to the first."""
        seen, _, _ = self.forward(symbols, vector)
        numbers, rest = self.blocks(symbols)
        given, out = symbols.tolist(), [0] * len(symbols)
        out[len(symbols) - len(rest) :] = seen[len(numbers) :]
        for k in range(len(numbers) - 1, -1, -1):
            at = seen[k]
            for i in range(k * self.block, (k + 1) * self.block):
                out[i] = at
                at = int(self.step[at, given[i]])
        return out

    def marks(self, symbols: np.ndarray, vectors: list[int], mask: int) -> list[int]:
        """The marked states before each symbol and behind the last, from those behind the last."""
        out = [mask]
        for sym, vector in zip(reversed(symbols.tolist()), reversed(vectors)):
            mask = self.back(vector, sym)[mask]
            out.append(mask)
        return out[::-1]

    def pick(self, vector: int, sym: int, mask: int, state: int) -> tuple[str, int]:
        """Letters and state behind a symbol, from a marked state, given the marked states behind the symbol."""
        key = (vector, sym, mask, state)
        found = self._pick.get(key)
        if found is None:
            before, after = self.vectors[vector], self.vectors[self.step[vector, sym]]
            least, options = int(self.rise[vector, sym]), []
            for letter, cost, behind in row_edges(state, sym):
                if mask >> behind & 1 and before[state] + cost - least == after[behind]:
                    options.append((letter, behind))
            turn = NEXT_TURN[state]
            if before[state] + INSERT == before[turn] and self.back(vector, sym)[mask] >> turn & 1:
                letters, behind = self.pick(vector, sym, mask, turn)
                options.append(("I" + letters, behind))
            found = self._pick[key] = min(options)
        return found

    def trace(self, symbols: np.ndarray, vectors: list[int], marks: list[int], state: int) -> tuple[list[str], int]:
        """The letters before and at each symbol, and the state behind the last."""
        letters = []
        for i, sym in enumerate(symbols.tolist()):
            piece, state = self.pick(vectors[i], sym, marks[i + 1], state)
            letters.append(piece)
        return letters, state

    def finish(self, vector: int, state: int) -> str:
        """The turns inserted behind the last row."""
        least, _ = self.end(vector)
        return "" if state in ENDS and self.vectors[vector][state] == least else "I" + self.finish(vector, NEXT_TURN[state])

    def solve(self, symbols: np.ndarray) -> tuple[int, list[str], str]:
        """Cost, the letters of each row and those behind the last row."""
        vectors = self.expand(symbols)
        _, last, rise = self.forward(symbols)
        least, mask = self.end(last)
        letters, state = self.trace(symbols, vectors, self.marks(symbols, vectors, mask), START)
        return rise + least, letters, self.finish(last, state)


def apply(letters: str, state: int, role: str | None = None, text: str | None = None):
    """Repaired (role, text) pairs of one row's letters, and the state behind them (no row: inserts only)."""
    turns, names = [], {USER: "user", ASSISTANT: "assistant"}
    for letter in letters:
        turn = NEXT_TURN[state]
        if letter == "I":
            turns.append((names[turn], ""))
        elif letter == "R":
            turns.append((names[turn], text))
        elif letter == "K":
            turns.append((role, text))
            turn = SYSTEM if role[:1] == "s" else turn
        state = state if letter == "D" else turn
    return turns, state


@functools.cache
def tables() -> Tables:
    """The tables, built once in a process."""
    return Tables()
