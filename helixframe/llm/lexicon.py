"""A lexicon trie crossed with Levenshtein automata, as one lazily built finite automaton.

An entry is a whole word, or a stem that any ending may follow.  The nondeterministic
automaton has a state (trie node, edits so far) for all Levenshtein automata of all
entries at once; its deterministic states are made when a word first reaches them.
"""

from __future__ import annotations

DEAD = 0


class Lexicon:
    """Finds the entry nearest to a word, within each entry's number of edits."""

    def __init__(self, entries: list[tuple[str, bool]]) -> None:
        """entries: (text, whether it is a stem); their numbers are their places in the list."""
        self.children: list[dict[str, int]] = [{}]
        self.whole: list[int] = [-1]
        self.stem: list[int] = [-1]
        self.most: list[int] = [0]
        for number, (text, is_stem) in enumerate(entries):
            edits, node = allowed_edits(text, is_stem), 0
            self.most[0] = max(self.most[0], edits)
            for c in text:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.whole.append(-1)
                    self.stem.append(-1)
                    self.most.append(0)
                node = self.children[node][c]
                self.most[node] = max(self.most[node], edits)
            (self.stem if is_stem else self.whole)[node] = number
        self.allowed = [allowed_edits(*e) for e in entries]
        self.letters = {c for kids in self.children for c in kids}
        self.forget()

    def forget(self) -> None:
        """Start anew with the states; they come back as words need them."""
        self.numbers: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.steps: list[dict[str, int]] = []
        self.results: list[tuple[int, int] | None] = []
        self._state({}, None)
        self.begin = self._state({0: 0}, None)

    def _state(self, at: dict[int, int], met: tuple[int, int] | None) -> int:
        """The number of the state with the given least edits by node; met: (edits, stem) reached so far."""
        todo = list(at)
        while todo:  # leaving out letters of an entry
            node = todo.pop()
            for child in self.children[node].values():
                if at[node] + 1 <= self.most[child] and at[node] + 1 < at.get(child, 99):
                    at[child] = at[node] + 1
                    todo.append(child)
        for node, edits in at.items():
            if self.stem[node] >= 0 and edits <= self.allowed[self.stem[node]]:
                met = min(met or (99, 0), (edits, self.stem[node]))
        key = (tuple(sorted(at.items())), met)
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append(key)
            self.steps.append({})
            ends = [(edits, self.whole[node]) for node, edits in at.items() if self.whole[node] >= 0 and edits <= self.allowed[self.whole[node]]]
            self.results.append(min([*ends, met] if met else ends, default=None))
        return self.numbers[key]

    def _step(self, state: int, c: str) -> int:
        at, met = self.states[state]
        following: dict[int, int] = {}

        def reach(node: int, edits: int) -> None:
            if edits <= self.most[node] and edits < following.get(node, 99):
                following[node] = edits

        for node, edits in at:
            reach(node, edits + 1)
            for letter, child in self.children[node].items():
                reach(child, edits + (letter != c))
        return self._state(following, met)

    def nearest(self, word: str) -> tuple[int, int] | None:
        """(edits, number of the entry), or None."""
        state = self.begin
        for c in word:
            c = c if c in self.letters else "\0"
            following = self.steps[state].get(c)
            if following is None:
                following = self.steps[state][c] = self._step(state, c)
            state = following
            if state == DEAD:
                return None
        return self.results[state]


def allowed_edits(text: str, is_stem: bool) -> int:
    """Edits that still count as a misspelling: none in short entries, fewer in stems."""
    return int(len(text) >= 6) if is_stem else int(len(text) >= 5) + int(len(text) >= 9)
