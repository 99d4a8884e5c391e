r"""Wildcard queries as Column predicates.

``*`` stands for any run of characters, ``?`` for exactly one, ``\`` makes the next
character ordinary. A query must match the whole message. Queries are compiled on
the driver into substring, prefix, suffix or equality tests, which stay in generated
code and reach the Parquet scan; only queries that need positions use a regex, and
that regex commits to the leftmost match of each piece, so it never backtracks over
the message.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_ANY_ONE = None  # marks "?" inside a piece

# The only letter whose lower case depends on its neighbours, and its other form.
FINAL_SIGMA = ("ς", "σ")


def folded(text: Column) -> Column:
    """Case-folded text, letter by letter the same whatever stands around a letter."""
    return F.replace(F.lower(text), *[F.lit(c) for c in FINAL_SIGMA])


@dataclass(frozen=True)
class Glob:
    """A cleaned query: the pieces between stars, and whether stars stand at the ends."""

    pieces: tuple[tuple[str | None, ...], ...]
    open_start: bool
    open_end: bool

    @classmethod
    def parse(cls, query: str) -> Glob:
        """Clean a query: merge stars, drop a lone last escape, resolve other escapes."""
        pieces: list[tuple[str | None, ...]] = []
        current: list[str | None] = []
        open_start = open_end = False
        chars = iter(query)
        for ch in chars:
            if ch == "*":
                if current:
                    pieces.append(tuple(current))
                    current = []
                elif not pieces:
                    open_start = True
                open_end = True
                continue
            if ch == "\\":
                escaped = next(chars, "")
                if not escaped:
                    break
                current.append(escaped)
            else:
                current.append(_ANY_ONE if ch == "?" else ch)
            open_end = False
        if current:
            pieces.append(tuple(current))
        return cls(tuple(pieces), open_start, open_end)

    def text(self) -> str:
        """The cleaned query in query syntax."""
        body = "*".join("".join("?" if c is None else _quote(c) for c in piece) for piece in self.pieces)
        if not self.pieces:
            return "*" if self.open_start else ""
        return ("*" if self.open_start else "") + body + ("*" if self.open_end else "")

    def lowered(self) -> Glob:
        """The query that case-folded messages are compared with."""
        pieces = []
        for piece in self.pieces:
            folded: list[str | None] = []
            for c in piece:
                folded.extend([None] if c is None else c.lower().replace(*FINAL_SIGMA))
            pieces.append(tuple(folded))
        return Glob(tuple(pieces), self.open_start, self.open_end)

    def literals(self) -> list[str]:
        """Maximal texts that every match contains."""
        found = []
        for piece in self.pieces:
            run = ""
            for c in (*piece, None):
                if c is None:
                    if run:
                        found.append(run)
                    run = ""
                else:
                    run += c
        return found

    def matches(self, text: Column) -> Column:
        """Boolean Column: ``text`` matches as a whole."""
        if not self.pieces:
            return text.isNotNull() if self.open_start else text == ""
        if len(self.pieces) == 1 and None not in self.pieces[0]:
            literal = F.lit("".join(self.pieces[0]))
            if self.open_start and self.open_end:
                return F.contains(text, literal)
            if self.open_end:
                return F.startswith(text, literal)
            if self.open_start:
                return F.endswith(text, literal)
            return text == literal
        cheap = [F.contains(text, F.lit(part)) for part in dict.fromkeys(self.literals())]
        return reduce(Column.__and__, [*cheap, F.rlike(text, F.lit(self.regex()))])

    def regex(self) -> str:
        """The query as a regular expression in Java syntax."""
        out = [r"(?s)\A"]
        last = len(self.pieces) - 1
        for i, piece in enumerate(self.pieces):
            body = "".join("." if c is None else _regex_char(c) for c in piece)
            starred = i > 0 or self.open_start
            if i == last and not self.open_end:
                # The last piece ends the message; it may not overlap earlier ones.
                out.append((".*" if starred else "") + body + r"\z")
            else:
                out.append(f"(?>.*?{body})" if starred else f"(?>{body})")
        return "".join(out)


def _quote(c: str) -> str:
    return "\\" + c if c in "*?\\" else c


def _regex_char(c: str) -> str:
    return "\\" + c if c.isascii() and not c.isalnum() and c.isprintable() else c


@dataclass(frozen=True)
class WildcardQuery:
    """One search query and its case flag."""

    query: str
    case_sensitive: bool = True

    def cleaned(self) -> str:
        return Glob.parse(self.query).text()

    def matches(self, message: Column, folded_message: Column | None = None) -> Column:
        """``folded_message`` saves folding the message again where the rows have it already."""
        glob = Glob.parse(self.query)
        if self.case_sensitive:
            return glob.matches(message)
        return glob.lowered().matches(folded(message) if folded_message is None else folded_message)


def as_queries(queries: Iterable[WildcardQuery | str]) -> list[WildcardQuery]:
    return [q if isinstance(q, WildcardQuery) else WildcardQuery(q) for q in queries]


def any_match(queries: Iterable[WildcardQuery | str], message: Column) -> Column:
    """True where at least one query matches; an empty list matches every message."""
    tests = [q.matches(message) for q in as_queries(queries)]
    return reduce(Column.__or__, tests) if tests else message.isNotNull()


# CASE branches per expression: keeps generated methods below the JVM's size limits.
_BRANCHES = 128


def first_match_index(
    queries: Iterable[WildcardQuery | str],
    message: Column,
    indexes: Sequence[int] | None = None,
    folded_message: Column | None = None,
) -> Column:
    """Index of the first query in list order that matches, else null; 0 for no queries."""
    qs = as_queries(queries)
    if not qs:
        return F.when(message.isNotNull(), F.lit(0))
    idx = list(indexes) if indexes is not None else list(range(len(qs)))
    groups = []
    for start in range(0, len(qs), _BRANCHES):
        case = F.when(qs[start].matches(message, folded_message), F.lit(idx[start]))
        for q, i in zip(qs[start + 1 : start + _BRANCHES], idx[start + 1 : start + _BRANCHES], strict=True):
            case = case.when(q.matches(message, folded_message), F.lit(i))
        groups.append(case)
    return groups[0] if len(groups) == 1 else F.coalesce(*groups)
