"""Small weighted finite-state transducers over word classes.

A clause is read as a string of symbols. Each transducer follows one thing (negation, reported
speech, who is meant) and writes flags at the words that matter; `compose` runs two of them
in step, as the product of their states. The composed grammar is a table, so a clause costs
one look-up a word. Insulting words themselves are accepted by a trie over letters, whose arcs
carry the learned weights (`Beginnings`).
"""

from collections.abc import Iterable

import ahocorasick

#: Symbols: an insult, a threat, someone meant, a negation, a word of saying, a quotation mark,
#: any other word.
INSULT, THREAT, TARGET, NOT, SAYS, QUOTE, OTHER = range(7)
SYMBOLS = range(7)

#: Flags of the words that carry weight.
NEGATED, REPORTED, AIMED = 1, 2, 4

State = int
Arc = tuple[State, int]


class Transducer:
    """Deterministic and complete: arcs[state][symbol] is (next state, flags written)."""

    def __init__(self, arcs: list[list[Arc]], final: list[int]):
        self.arcs, self.final = arcs, final  # flags that hold for the whole clause

    def read(self, symbols: Iterable[int]) -> tuple[list[int], int]:
        """Flags at each symbol, and of the clause."""
        state, out = 0, []
        for s in symbols:
            state, flags = self.arcs[state][s]
            out.append(flags)
        return out, self.final[state]


def compose(a: Transducer, b: Transducer) -> Transducer:
    """Both in step: reachable pairs of states, flags of either."""
    names, todo, arcs = {(0, 0): 0}, [(0, 0)], []
    for x, y in todo:
        row = []
        for s in SYMBOLS:
            (p, f), (q, g) = a.arcs[x][s], b.arcs[y][s]
            if (p, q) not in names:
                names[p, q] = len(names)
                todo.append((p, q))
            row.append((names[p, q], f | g))
        arcs.append(row)
    return Transducer(arcs, [a.final[x] | b.final[y] for x, y in todo])


def negation(scope: int = 3) -> Transducer:
    """A negation covers the `scope` words after it."""
    arcs = []
    for left in range(scope + 1):
        flags = NEGATED if left else 0
        row = [(max(0, left - 1), flags if s in (INSULT, THREAT) else 0) for s in SYMBOLS]
        row[NOT], row[QUOTE] = (scope, 0), (left, 0)
        arcs.append(row)
    return Transducer(arcs, [0] * (scope + 1))


def reported_speech() -> Transducer:
    """What follows a word of saying in its clause, or stands in quotation marks after one."""
    plain, said, quoted = range(3)
    heavy = (INSULT, THREAT)
    arcs = [[(state, REPORTED if state and s in heavy else 0) for s in SYMBOLS] for state in (plain, said, quoted)]
    for state in (plain, said, quoted):
        arcs[state][SAYS] = (max(state, said), 0)
    arcs[said][QUOTE] = (quoted, 0)
    arcs[quoted][QUOTE] = (plain, 0)
    return Transducer(arcs, [0, 0, 0])


def target() -> Transducer:
    """Whether the clause names someone, before or after the word that carries weight."""
    arcs = [[(state, 0) for s in SYMBOLS] for state in (0, 1)]
    arcs[0][TARGET] = (1, 0)
    return Transducer(arcs, [0, AIMED])


def clause_grammar() -> Transducer:
    return compose(compose(negation(), reported_speech()), target())


class Beginnings:
    """A trie over letters that finds words by how they begin: `stem` accepts every word that
    starts with it, `stem$` that word alone. Arcs into accepting states carry a value."""

    def __init__(self, values: dict[str, object]):
        self.size = len(values)
        self.trie = ahocorasick.Automaton()
        for stem, value in values.items():
            letters = stem.removesuffix("$")
            self.trie.add_word(letters, (*self.trie.get(letters, ()), (len(letters), stem.endswith("$"), value)))
        if self.size:
            self.trie.make_automaton()

    def find(self, text: str) -> dict[int, object]:
        """Value by the place where a word begins; the longest beginning counts."""
        found: dict[int, tuple[int, object]] = {}
        if not self.size:
            return {}
        for end, entries in self.trie.iter(text):
            for length, whole, value in entries:
                start = end - length + 1
                if start and text[start - 1].isalpha():
                    continue
                if whole and end + 1 < len(text) and text[end + 1].isalpha():
                    continue
                found[start] = value  # matches come by ascending end
        return found
