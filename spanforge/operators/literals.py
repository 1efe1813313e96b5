"""Finding the literals of a list in text: an automaton over all of them, and text read with its JSON escapes undone."""

from __future__ import annotations

import bisect
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

#: An escape, however often the string that holds it was escaped again: two halves of a pair, one unit, a letter, or backslashes alone.
ESCAPED = re.compile(r'\\+u([dD][89abAB][0-9a-fA-F]{2})\\+u([dD][c-fC-F][0-9a-fA-F]{2})|\\+(?:u([0-9a-fA-F]{4})|([nrtbf"/]))?')
#: What the letters of escapes stand for.
LETTERS = {"n": "\n", "r": "\r", "t": "\t", "b": " ", "f": " ", '"': '"', "/": "/"}
SPREAD = 0x110000


def folded(text: str) -> str:
    """Lower case, character by character, so that places stay the same."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


class View:
    """Text with its escapes undone, and the places in the text where its characters came from."""

    def __init__(self, text: str, letters: bool = True):
        """``letters``: undo escapes like ``\\n`` too; else a backslash before a letter is one, as in ``DOMAIN\\name``."""
        parts, at, length = [], 0, 0
        self.places: list[int] = []  # of the undone escapes, in what is read
        self.ends: list[int] = []  # and where they end in the text
        for m in ESCAPED.finditer(text):
            high, low, unit, letter = m.groups()
            end, c = m.end(), "\\"
            if high:
                c = chr(0x10000 + ((int(high, 16) & 0x3FF) << 10) + (int(low, 16) & 0x3FF))
            elif unit:
                c = chr(int(unit, 16))
                c = "\ufffd" if "\ud800" <= c <= "\udfff" else c
            elif letter and letters:
                c = LETTERS[letter]
            elif letter:
                end -= 1
            parts += [text[at : m.start()], c]
            length += m.start() - at + 1
            self.places.append(length - 1)
            self.ends.append(end)
            at = end
        self.text = "".join(parts) + text[at:]

    def place(self, i: int) -> int:
        """Where in the text the ``i``-th character begins."""
        k = bisect.bisect_left(self.places, i)
        return i if k == 0 else self.ends[k - 1] + i - self.places[k - 1] - 1

    def undone(self, i: int) -> bool:
        k = bisect.bisect_left(self.places, i)
        return k < len(self.places) and self.places[k] == i


class Automaton:
    """All literals as one trie whose states know the longest shorter beginning that they end with, so that one pass over a text
    finds all of them, however many there are. Any case is found; a literal that begins or ends with a letter, digit or underscore does so at the
    bounds of a word there, and behind an escape a word begins."""

    def __init__(self, literals: tuple[str, ...]):
        self.step: dict[int, int] = {}
        self.size, depth, above, last = [0], [0], [0], [0]
        for literal in literals:
            state = 0
            for c in map(ord, folded(literal)):
                to = self.step.get(state * SPREAD + c)
                if to is None:
                    to = self.step[state * SPREAD + c] = len(self.size)
                    self.size.append(0)
                    depth.append(depth[state] + 1)
                    above.append(state)
                    last.append(c)
                state = to
            self.size[state] = len(literal)
        self.back = [0] * len(self.size)
        #: The next state on the way back in which a literal ends.
        self.shorter = [0] * len(self.size)
        for state in sorted(range(1, len(self.size)), key=depth.__getitem__):
            at = self.back[above[state]]
            to = self.step.get(at * SPREAD + last[state])
            while to is None and at:
                at = self.back[at]
                to = self.step.get(at * SPREAD + last[state])
            self.back[state] = to if to and above[state] else 0
            self.shorter[state] = self.back[state] if self.size[self.back[state]] else self.shorter[self.back[state]]
        firsts = {folded(x)[0] for x in literals if x}
        within = "".join(sorted(re.escape(c) for c in firsts))
        self.any = re.compile(f"[{within}]") if firsts else None
        wordy = "".join(sorted(re.escape(c) for c in firsts if c.isalnum() or c == "_"))
        other = "".join(sorted(re.escape(c) for c in firsts if not (c.isalnum() or c == "_")))
        ways = [rf"(?<!\w)[{wordy}]"] * bool(wordy) + [f"[{other}]"] * bool(other)
        self.at_words = re.compile("|".join(ways)) if ways else None

    def _ends(self, low: str, first: re.Pattern) -> Iterator[tuple[int, int]]:
        step, back, size, shorter = self.step, self.back, self.size, self.shorter
        state, i, n = 0, 0, len(low)
        while i < n:
            if not state:
                m = first.search(low, i)
                if m is None:
                    return
                i = m.start()
            c = ord(low[i])
            i += 1
            to = step.get(state * SPREAD + c)
            while to is None and state:
                state = back[state]
                to = step.get(state * SPREAD + c)
            state = to or 0
            hit = state if size[state] else shorter[state]
            while hit:
                yield i - size[hit], i
                hit = shorter[hit]

    def found(self, text: str) -> list[tuple[int, int, str]]:
        """(begin, end, literal in lower case) of every literal in ``text``, also where escapes spell it; they may overlap."""
        if self.any is None or not text:
            return []
        whole, low = [], folded(text)
        for a, b in self._ends(low, self.at_words):
            if not (_wordy(low, a) and a and _wordy(low, a - 1) or _wordy(low, b - 1) and b < len(low) and _wordy(low, b)):
                whole.append((a, b, low[a:b]))
        for view in (View(text), View(text, letters=False)) if "\\" in text else ():
            low = folded(view.text)
            for a, b in self._ends(low, self.any):
                inside = _wordy(low, a) and a and _wordy(low, a - 1) and not view.undone(a - 1)
                if not (inside or _wordy(low, b - 1) and b < len(low) and _wordy(low, b) and not view.undone(b)):
                    whole.append((view.place(a), view.place(b), low[a:b]))
        return whole

    def within(self, text: str) -> set[str]:
        """Literals (in lower case) that ``text`` holds anywhere, inside of words too."""
        low = folded(text)
        return {low[a:b] for a, b in self._ends(low, self.any)} if self.any else set()

    def replaced(self, text: str, named: Callable[[str], str]) -> str:
        """``text`` with each literal under another name; of those that overlap, the first, and of those the longest."""
        out, at = [], 0
        for a, b, literal in sorted(self.found(text), key=lambda x: (x[0], -x[1])):
            if a >= at:
                out += [text[at:a], named(literal)]
                at = b
        return "".join(out) + text[at:]


def _wordy(text: str, i: int) -> bool:
    return text[i].isalnum() or text[i] == "_"


@lru_cache(maxsize=2)
def automaton(literals: tuple[str, ...]) -> Automaton:
    """Built once in each worker."""
    return Automaton(literals)


class Leaf(NamedTuple):
    """A string in JSON: its key, whether it lies in a schema, and whether ``arguments`` between shut that of outer objects out."""

    key: str | None
    text: str
    schema: bool = False
    shut: bool = False


class Leaves(list):
    """Strings of one object, in order."""


def _object(pairs: list[tuple[str, object]]) -> Leaves:
    names = {k for k, _ in pairs}
    schema = "name" in names and (not names.isdisjoint({"arguments", "parameters", "inputSchema"}) or ("type", "function") in pairs)
    found = Leaves()
    for key, value in pairs:
        for leaf in _leaves(value, key):
            shut = leaf.shut or key == "arguments"
            found.append(leaf._replace(schema=leaf.schema or schema and not shut, shut=shut))
    return found


def _leaves(value: object, key: str | None) -> list[Leaf]:
    if isinstance(value, str):
        inner = strings_of(value, key)
        return [Leaf(key, value)] if inner is None else inner
    if isinstance(value, Leaves):
        return value
    return [leaf for x in value for leaf in _leaves(x, key)] if isinstance(value, list) else []


def strings_of(text: str, key: str | None = None) -> list[Leaf] | None:
    """Every string in JSON text, that of nested JSON text included; null if ``text`` is no object or array."""
    if text.lstrip()[:1] not in ("{", "["):
        return None
    try:
        return _leaves(json.loads(text, object_pairs_hook=_object), key)
    except (ValueError, RecursionError):
        return None


#: A string of JSON, and whether it is a key.
STRING = re.compile(r'("[^"\\]*(?:\\.[^"\\]*)*")(\s*:)?', re.S)


def edited(text: str, change: Callable[[str], str]) -> str:
    """``text`` changed, or, if it is JSON, every string in it that is not a key, nested JSON too; all other bytes stay."""
    if text.lstrip()[:1] not in ("{", "["):
        return change(text)
    try:
        json.loads(text)
    except (ValueError, RecursionError):
        return change(text)
    out, at = [], 0
    for m in STRING.finditer(text):
        if m[2] is None:
            was = json.loads(m[1])
            now = edited(was, change)
            if now != was:
                out += [text[at : m.start(1)], json.dumps(now, ensure_ascii=False)]
                at = m.end(1)
    return "".join(out) + text[at:]
