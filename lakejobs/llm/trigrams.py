"""Boolean trigram queries of regular expressions: what a text must hold for the expression to match."""

from __future__ import annotations

import re
from re import _constants as op
from re import _parser

#: Strings followed at once while walking an expression; beyond that the walk starts anew.
MOST_STRINGS = 64


def trigram_query(pattern: str) -> frozenset[frozenset[frozenset[str]]]:
    """Conjunction of disjunctions of trigram sets, all in lower case; empty if nothing is mandatory.

    A text can match only if for every member of the query at least one of its
    sets occurs in it completely. Literal pieces, alternatives and optional parts
    are followed as finite sets of strings; open repeats and wide classes end
    a piece. Letters are folded to lower case, which only adds candidates.
    """
    clauses: set[frozenset[frozenset[str]]] = set()

    def close(strings: set[str]) -> None:
        sets = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings}
        if sets and frozenset() not in sets:
            least = {a for a in sets if not any(b < a for b in sets)}
            clauses.add(frozenset(least))

    def finite(items) -> set[str] | None:
        """All strings the items match, or None where they are too many."""
        found = {""}
        for kind, value in items:
            if kind is op.LITERAL:
                found = {s + chr(value).lower() for s in found}
            elif kind is op.IN:
                chars = set()
                for what, v in value:
                    if what is op.LITERAL:
                        chars.add(chr(v).lower())
                    elif what is op.RANGE and v[1] - v[0] < 8:
                        chars |= {chr(c).lower() for c in range(v[0], v[1] + 1)}
                    else:
                        return None
                found = {s + c for s in found for c in chars}
            elif kind is op.BRANCH:
                options = [finite(x) for x in value[1]]
                if None in options:
                    return None
                found = {s + o for s in found for x in options for o in x}
            elif kind is op.SUBPATTERN:
                inner = finite(value[3])
                if inner is None:
                    return None
                found = {s + o for s in found for o in inner}
            elif kind is op.MAX_REPEAT and value[1] <= 2:
                inner = finite(value[2])
                if inner is None:
                    return None
                repeated = {"".join(x) for n in range(value[0], value[1] + 1) for x in _product(inner, n)}
                found = {s + o for s in found for o in repeated}
            else:
                return None
            if len(found) > MOST_STRINGS:
                return None
        return found

    def walk(items) -> None:
        current = {""}
        for item in items:
            more = finite([item])
            if more is not None and len(current) * len(more) <= MOST_STRINGS:
                current = {s + m for s in current for m in more}
                continue
            close(current)
            current = {""}
            kind, value = item
            if kind is op.SUBPATTERN:
                walk(value[3])
            elif kind is op.MAX_REPEAT and value[0] >= 1:
                walk(value[2])
            elif more is not None:
                current = more
        close(current)

    walk(_parser.parse(pattern, re.IGNORECASE))
    return frozenset(clauses)


def _product(strings: set[str], n: int):
    if n == 0:
        yield ()
        return
    for head in strings:
        for tail in _product(strings, n - 1):
            yield (head, *tail)
