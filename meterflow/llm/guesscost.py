"""Guess cost of a password by dynamic programming over its segments.

``guess_cost(value)`` is the log10 of the guesses that the cheapest segmentation
of ``value`` needs. A segment is a word (its rank in a ``Ranks`` table, with capitals and
digit look-alikes as variants), a date or year, a repeated block, a walk over neighbour
keys or along the alphabet, or a brute-force character. Every added segment costs
``JOIN`` more, so that cutting a value into many cheap parts is not free. The time
is linear in the length of the value for a fixed longest word; nothing is cut off.
"""

from __future__ import annotations

import math
import re

#: Common passwords and words in order of rank, written for this operator.
WORDS = (
    "password admin letmein welcome qwerty login master monkey dragon sunshine princess football shadow secret "
    "superman batman hello freedom whatever trustno1 iloveyou starwars baseball access user test guest root default "
    "changeme example sample token key pass word love angel summer winter spring autumn monday friday january august "
    "december house flower computer internet server backup database public private system manager office company "
    "money happy lucky tiger eagle lion horse cookie orange banana cherry apple coffee pepper ginger silver golden "
    "purple yellow black white green blue red one two three four five six seven eight nine ten"
).split()
LONGEST_WORD = 24


class Ranks:
    """Ranks of words: the listed passwords first, then more words in order of frequency."""

    def __init__(self, words: list[str] = ()):
        self.rank: dict[str, int] = {}
        for word in [*WORDS, *words]:
            if 3 <= len(word) <= LONGEST_WORD:
                self.rank.setdefault(word.lower(), len(self.rank) + 1)
        self.longest = max(map(len, self.rank))


LISTED = Ranks()
LOOKALIKE = str.maketrans("013457@$!", "oleastasi")
ROWS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "abcdefghijklmnopqrstuvwxyz", "0123456789")
NEXT = {pair for row in ROWS for a, b in zip(row, row[1:]) for pair in ((a, b), (b, a))}
DATE = re.compile(
    r"(?:19|20)\d\d(?:([-/.]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01]))?"
    r"|(?:0[1-9]|[12]\d|3[01])([-/.]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d"
)
LONGEST_BLOCK = 8
JOIN = math.log10(2)


def char_cost(c: str) -> float:
    """Log10 of the alphabet that a brute-force guess of ``c`` runs through."""
    if c.isdigit():
        return 1.0
    if "a" <= c <= "z" or "A" <= c <= "Z":
        return math.log10(26)
    return math.log10(33) if c < "\x80" else 2.0


def _word_cost(part: str, ranks: Ranks) -> float | None:
    low = part.lower()
    plain = low.translate(LOOKALIKE)
    rank = ranks.rank.get(low) or ranks.rank.get(plain)
    if rank is None:
        return None
    capitals = sum(c.isupper() for c in part)
    cost = math.log10(rank) + 0.3
    if capitals:
        simple = capitals == len(part) or capitals == 1 and part[0].isupper()
        cost += JOIN if simple else math.log10(math.comb(len(part), capitals) + 1)
    if low not in ranks.rank:
        cost += JOIN * sum(a != b for a, b in zip(low, plain))
    return cost


def segments(value: str, ranks: Ranks = LISTED) -> dict[int, list[tuple[int, float, str]]]:
    """Per end position the (start, cost, kind) of every segment other than brute force."""
    found: dict[int, list[tuple[int, float, str]]] = {}

    def add(start, end, cost, kind):
        found.setdefault(end, []).append((start, cost, kind))

    for i in range(len(value)):
        for j in range(i + 3, min(len(value), i + ranks.longest) + 1):
            cost = _word_cost(value[i:j], ranks)
            if cost is not None:
                add(i, j, cost, "word")
        if value[i].isdigit() and (m := DATE.match(value, i)):
            add(i, m.end(), 2.1 if m.end() - i == 4 else 4.6, "date")
            if m.end() - i > 4 and DATE.match(value[i : i + 4]):
                add(i, i + 4, 2.1, "date")
    low, start = value.lower(), 0
    for i in range(1, len(value) + 1):
        if i == len(value) or (low[i - 1], low[i]) not in NEXT:
            if i - start >= 3:
                add(start, i, math.log10(47) + math.log10(i - start) + JOIN, "walk")
            start = i
    for size in range(1, LONGEST_BLOCK + 1):
        same = 0  # characters from here on that equal those a block further
        for i in range(len(value) - size - 1, -1, -1):
            same = same + 1 if value[i] == value[i + size] else 0
            times, block = same // size + 1, value[i : i + size]
            if times > 1 and size * times >= 3:
                base = min(sum(map(char_cost, block)), _word_cost(block, ranks) or math.inf)
                for n in {times, max(2, times - 1)}:
                    if size * n >= 3:
                        add(i, i + size * n, base + math.log10(n), "repeat")
    return found


def guess_cost(value: str, ranks: Ranks = LISTED) -> float:
    """Log10 guesses of the cheapest segmentation; 0 for an empty value."""
    found = segments(value, ranks)
    best = [0.0]
    brute = [0.0]  # cheapest with a brute-force character at the end: a run of them is one segment
    for end in range(1, len(value) + 1):
        joined = JOIN if end > 1 else 0.0
        cost = char_cost(value[end - 1])
        run = min(best[end - 1] + joined, brute[end - 1] if end > 1 else math.inf) + cost
        brute.append(run)
        other = (best[s] + c + (JOIN if s else 0.0) for s, c, _ in found.get(end, ()))
        best.append(min([run, *other]))
    return best[-1]
