"""Boolean trigram queries from regular expressions.

A text that a pattern matches must hold certain trigrams. The syntax tree of the pattern is
walked once: a part is either a small set of exact strings, or it ends the strings known so
far. All comparisons are on ASCII lower case, so queries are safe for patterns of either case.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product
from re import _constants as op
from re import _parser as parser

# More strings than these for one part say little and cost much.
MOST = 64


@dataclass(frozen=True)
class Any_:
    """Every text may match."""


@dataclass(frozen=True)
class Tri:
    gram: bytes


@dataclass(frozen=True)
class And:
    of: tuple


@dataclass(frozen=True)
class Or:
    of: tuple


Query = Any_ | Tri | And | Or


def both(*parts: Query) -> Query:
    parts = tuple(dict.fromkeys(p for p in parts if not isinstance(p, Any_)))
    return Any_() if not parts else parts[0] if len(parts) == 1 else And(parts)


def either(*parts: Query) -> Query:
    parts = tuple(dict.fromkeys(parts))
    if not parts or any(isinstance(p, Any_) for p in parts):
        return Any_()
    return parts[0] if len(parts) == 1 else Or(parts)


def of_string(text: str) -> Query:
    raw = text.encode().lower()
    return both(*[Tri(raw[i : i + 3]) for i in range(len(raw) - 2)])


def of_strings(texts: set[str]) -> Query:
    return either(*map(of_string, texts))


def _characters(items: list) -> set[str] | None:
    found: set[str] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            found.add(chr(value).lower())
        elif kind is op.RANGE and value[1] - value[0] < MOST:
            found.update(chr(c).lower() for c in range(value[0], value[1] + 1))
        else:
            return None
    return found if len(found) <= 8 else None


def _walk(tree) -> tuple[set[str] | None, Query]:
    """The strings a part can be, if they are few, and what it needs besides."""
    exact: set[str] = {""}
    needs: list[Query] = []

    def flush() -> None:
        nonlocal exact
        needs.append(of_strings(exact))
        exact = {""}

    broken = False
    for kind, value in tree:
        part: set[str] | None = None
        more: Query = Any_()
        if kind is op.LITERAL:
            part = {chr(value).lower()}
        elif kind is op.IN:
            part = _characters(value)
        elif kind is op.SUBPATTERN:
            part, more = _walk(value[3])
        elif kind is op.BRANCH:
            branches = [_walk(branch) for branch in value[1]]
            if all(strings is not None for strings, _ in branches):
                part = set().union(*[strings for strings, _ in branches])
            else:
                more = either(
                    *[both(q, of_strings(s) if s is not None else Any_()) for s, q in branches]
                )
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
            low, high, inner = value
            strings, inside = _walk(inner)
            if high == 1 and low == 0 and strings is not None:
                part = strings | {""}
            elif low == high == 1:
                part, more = strings, inside
            elif low and strings is not None and len(strings) * len(exact) <= MOST:
                # Once before the rest, once after it.
                exact = {a + b for a, b in product(exact, strings)}
                flush()
                broken, exact = True, set(strings)
                continue
            elif low:
                more = both(inside, of_strings(strings) if strings is not None else Any_())
        elif kind is op.AT:
            continue
        needs.append(more)
        if part is not None and len(part) * len(exact) <= MOST:
            exact = {a + b for a, b in product(exact, part)}
            continue
        flush()
        broken = True
        if part is not None:
            exact = part
    if not broken and all(isinstance(n, Any_) for n in needs):
        return exact, Any_()
    flush()
    return None, both(*needs)


def query(pattern: str) -> Query:
    """What trigrams (of ASCII lower case) a text needs for the pattern to match in it."""
    strings, needs = _walk(parser.parse(pattern, re.ASCII))
    return both(needs, of_strings(strings)) if strings is not None else needs


def grams(wanted: Query) -> set[bytes]:
    if isinstance(wanted, Tri):
        return {wanted.gram}
    return set().union(*map(grams, wanted.of)) if isinstance(wanted, And | Or) else set()
