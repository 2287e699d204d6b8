"""Small weighted finite-state transducers over clause symbols, and their composition.

Every machine here is sequential: a state has one arc for a symbol, or one for all others. The
composition of two is again sequential, so a clause is read once, from left to right."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

#: Stands for any symbol without an arc of its own; as output, for the symbol read.
ANY = "*"


@dataclass
class Transducer:
    """arcs[state][symbol] = (next state, output, weight); state 0 starts, all states end."""

    arcs: dict[int, dict[str, tuple[int, str, float]]] = field(default_factory=dict)

    def step(self, state: int, symbol: str) -> tuple[int, str, float]:
        arcs = self.arcs.get(state, {})
        target, out, weight = arcs.get(symbol) or arcs.get(ANY) or (state, ANY, 0.0)
        return target, symbol if out == ANY else out, weight

    def read(self, symbols: Iterable[str]) -> list[tuple[str, float]]:
        """The output symbol and the weight of each symbol read."""
        state, out = 0, []
        for symbol in symbols:
            state, found, weight = self.step(state, symbol)
            out.append((found, weight))
        return out


def compose(first: Transducer, second: Transducer, alphabet: Iterable[str]) -> Transducer:
    """Reads with ``first`` what ``second`` then reads; weights add up. States are numbered as
    they are reached from the two starts."""
    alphabet = list(alphabet)
    numbers = {(0, 0): 0}
    todo = [(0, 0)]
    composed = Transducer()
    while todo:
        pair = todo.pop()
        arcs = composed.arcs.setdefault(numbers[pair], {})
        for symbol in alphabet:
            a, middle, w1 = first.step(pair[0], symbol)
            b, out, w2 = second.step(pair[1], middle)
            if (a, b) not in numbers:
                numbers[(a, b)] = len(numbers)
                todo.append((a, b))
            arcs[symbol] = (numbers[(a, b)], out, w1 + w2)
    return composed
