"""Can any message of a log type match a wildcard query?

Runs over the distinct log types only. The set of reachable query positions is held
as bits of one integer while the template is read left to right; a placeholder stands
for one or more characters of its alphabet. The answer may be a false "yes", never a
false "no", so it is safe for pruning.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from logloom.functions.glob import Glob, WildcardQuery, as_queries

# The characters a variable of each kind can be made of.
VAR_ALPHABETS = {
    "i": "-0123456789",
    "f": "-.0123456789",
    "d": "+-._\\0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ",
}

_TEMPLATE_PART = re.compile(r"<([ifd])>|([^<]+)")


class _Automaton:
    """Bit-parallel matcher of one query."""

    def __init__(self, query: WildcardQuery):
        glob = Glob.parse(query.query)
        self.fold = not query.case_sensitive
        if self.fold:
            glob = glob.lowered()
        # Case folding of non-ASCII text depends on context; such queries prune nothing.
        self.undecided = self.fold and not all(part.isascii() for part in glob.literals())
        elements: list[str | None] = ["*"] if glob.open_start else []
        self.stars = 1 if glob.open_start else 0
        for n, piece in enumerate(glob.pieces):
            elements.extend(piece)
            if n < len(glob.pieces) - 1 or glob.open_end:
                self.stars |= 1 << len(elements)
                elements.append("*")
        self.accept = 1 << len(elements)
        self.any_one = 0
        self.by_char: dict[str, int] = {}
        for pos, element in enumerate(elements):
            bit = 1 << pos
            if self.stars & bit:
                continue
            if element is None:
                self.any_one |= bit
            else:
                self.by_char[element] = self.by_char.get(element, 0) | bit
        self.by_var = {kind: self._mask(chars) for kind, chars in VAR_ALPHABETS.items()}

    def _mask(self, chars: str) -> int:
        mask = self.any_one
        for c in chars:
            mask |= self.by_char.get(c, 0)
        return mask

    def _step(self, state: int, mask: int) -> int:
        state = (state & self.stars) | ((state & mask) << 1)
        return state | ((state & self.stars) << 1)

    def reaches(self, logtype: str) -> bool:
        if self.undecided:
            return True
        state = 1 | ((1 & self.stars) << 1)
        for kind, text in _TEMPLATE_PART.findall(logtype):
            if kind:
                mask = self.by_var[kind]
                state = self._step(state, mask)
                while (more := state | self._step(state, mask)) != state:
                    state = more
            else:
                text = text.replace("&lt;", "<").replace("&amp;", "&")
                for c in text.lower() if self.fold else text:
                    state = self._step(state, self.any_one | self.by_char.get(c, 0))
                    if not state:
                        return False
        return bool(state & self.accept)


def may_match(queries: Iterable[WildcardQuery | str], logtype: str | Column) -> Column:
    """Boolean Column over log types: some message of the type may match some query."""
    qs = as_queries(queries)
    if not qs:
        return F.lit(True)

    @F.pandas_udf("boolean")
    def test(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automata = [_Automaton(q) for q in qs]
        for logtypes in batches:
            yield logtypes.map(lambda t: any(a.reaches(t) for a in automata)).astype(bool)

    return test(logtype)
