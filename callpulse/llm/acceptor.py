"""Minimal acceptors of words, and their composition with a one-edit transducer.

An acceptor is the smallest deterministic automaton of a set of words. It is built from
the words in order: what can no longer change is replaced by an equal state that was
there before. The transducer copies letters and makes exactly one edit on its way: it
replaces, inserts or deletes one letter. Composing acceptor, transducer and acceptor
gives an automaton whose accepting paths spell the pairs of words one edit apart.
Only its reachable part is ever made, as follows.

Before the edit both acceptors have read the same, so they are in the same state: the
transducer's copying state needs one acceptor state, not two. After the edit both must
read the same rest. An insertion may be made at several places of a repeated letter
with one result; the transducer inserts as late as possible (the letter copied next is
another one), so that each pair has one path. A deletion is an insertion read from the
other side, so pairs are spelled shorter word first.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator


class Acceptor:
    """States are numbers; ``arcs[s]`` maps letters to states, ``final[s]`` accepts.

    A state's number is above those its arcs lead to.
    """

    def __init__(self, words: Iterable[str]):
        """``words`` are sorted by code points and distinct."""
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        known: dict[tuple, int] = {}
        # The path of the last word: its states may still get arcs.
        path: list[tuple[dict[str, int], list[bool]]] = [({}, [False])]
        last = ""

        def settle(length: int) -> None:
            """Makes the path's states beyond ``length`` letters final ones."""
            while len(path) > length + 1:
                arcs, accepts = path.pop()
                path[-1][0][last[len(path) - 1]] = state_of(arcs, accepts[0])

        def state_of(arcs: dict[str, int], accepts: bool) -> int:
            name = (accepts, *arcs.items())
            state = known.get(name)
            if state is None:
                state = known[name] = len(self.arcs)
                self.arcs.append(arcs)
                self.final.append(accepts)
            return state

        for word in words:
            shared = 0
            while shared < min(len(last), len(word)) and last[shared] == word[shared]:
                shared += 1
            settle(shared)
            path += [({}, [False]) for _ in word[shared:]]
            path[-1][1][0] = True
            last = word
        settle(0)
        self.start = state_of(path[0][0], path[0][1][0])

    def accepts(self, word: str) -> bool:
        state = self.start
        for letter in word:
            if letter not in self.arcs[state]:
                return False
            state = self.arcs[state][letter]
        return self.final[state]

    def common(self, one: int, other: int) -> Iterator[str]:
        """All words that lead from both states to accepting ones."""
        todo = [(one, other, "")]
        while todo:
            p, q, read = todo.pop()
            if self.final[p] and self.final[q]:
                yield read
            ours, theirs = self.arcs[p], self.arcs[q]
            for letter in ours.keys() & theirs.keys():
                todo.append((ours[letter], theirs[letter], read + letter))


def one_edit_pairs(words: Acceptor) -> list[tuple[str, str]]:
    """All pairs of accepted words one edit apart, each once, the shorter one first.

    Works through the states from the last ones: the pairs of words that begin in a
    state are those with the edit right there, and those of the states it leads to.
    A state that many beginnings share is worked out once.
    """
    pairs: list[list[tuple[str, str]]] = []
    for p, arcs in enumerate(words.arcs):
        found = [(c + x, c + y) for c, q in arcs.items() for x, y in pairs[q]]
        letters = list(arcs.items())
        for place, (c, q) in enumerate(letters):
            # Replace c by a later letter.
            for d, r in letters[place + 1 :]:
                found += [(c + rest, d + rest) for rest in words.common(q, r)]
            # Insert c: at the end, or before another letter.
            if words.final[p] and words.final[q]:
                found.append(("", c))
            for d, r in letters:
                after = words.arcs[q].get(d)
                if d != c and after is not None:
                    found += [(d + rest, c + d + rest) for rest in words.common(r, after)]
        pairs.append(found)
    return pairs[words.start]
