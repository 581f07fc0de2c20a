"""Generalised suffix automaton of word sequences, for longest-match tracking over token streams."""

from __future__ import annotations

from collections.abc import Iterable, Iterator


class SuffixAutomaton:
    """All word runs of a set of items; built item by item, states shared between items."""

    def __init__(self, window: int) -> None:
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        #: By state: items with a window that ends there; the window is the state's run of ``window`` words.
        self.owners: dict[int, set[str]] = {}
        #: By state: (length, items) of items shorter than the window that end there whole.
        self.short: dict[int, dict[int, set[str]]] = {}

    def _state(self, length: int, link: int, arcs: dict[int, int]) -> int:
        self.next.append(arcs)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, at: int, word: int, target: int) -> int:
        """The state of the runs that end in ``target`` and are no longer than those through ``at``."""
        if self.length[target] == self.length[at] + 1:
            return target
        copy = self._state(self.length[at] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while at >= 0 and self.next[at].get(word) == target:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if (known := self.next[last].get(word)) is not None:
            return self._split(last, word, known)
        state = self._state(self.length[last] + 1, 0, {})
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at >= 0:
            self.link[state] = self._split(at, word, self.next[at][word])
        return state

    def add(self, words: list[int]) -> None:
        last = 0
        for word in words:
            last = self._extend(last, word)

    def name(self, item: str, words: list[int]) -> None:
        """Note which windows are the item's; only after all items have been added, as states still split before."""
        if len(words) < self.window:
            *_, (_, state, _) = self.walk(words)
            self.short.setdefault(state, {}).setdefault(len(words), set()).add(item)
            return
        for _, state, matched in self.walk(words):
            if matched == self.window:
                self.owners.setdefault(state, set()).add(item)

    def walk(self, words: Iterable[int]) -> Iterator[tuple[int, int, int]]:
        """Position, state and longest matched length after each word, up to the window.

        A match is cut to its last ``window`` words at once. It was one word longer than that at most, so they belong to its
        state or to the next on the chain, and a word costs the same however long items and matches are.
        """
        state, matched = 0, 0
        arcs, link, length, window = self.next, self.link, self.length, self.window
        for i, word in enumerate(words):
            while state and word not in arcs[state]:
                state = link[state]
                matched = length[state]
            if word in arcs[state]:
                state = arcs[state][word]
                matched += 1
                if matched > window:
                    matched = window
                    if length[link[state]] >= window:
                        state = link[state]
            yield i, state, matched

    def found(self, words: list[int]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged runs ``[start, end)`` of words inside occurring windows, and the items that own those windows."""
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        seen: set[int] = set()
        for i, state, matched in self.walk(words):
            longest = 0
            if matched == self.window:
                longest = matched
                if state not in seen:
                    seen.add(state)
                    items |= self.owners[state]
            if self.short:
                at = state
                while at > 0:
                    for n, owners in self.short.get(at, {}).items():
                        if n <= matched:
                            longest = max(longest, n)
                            items |= owners
                    at = self.link[at]
            if longest:
                start = i + 1 - longest
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, i + 1))
        return spans, items
