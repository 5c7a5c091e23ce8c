"""License scan: notice phrases and identifier tags by Aho-Corasick, expressions by shunting-yard.

Phrases are looked for in the sequence of words (A-Z lower-cased, ASCII punctuation separates). The
expression that follows an identifier tag is read with the precedence ``with`` > ``and`` > ``or``.
"""

from __future__ import annotations

import re

import ahocorasick
from pyspark.sql import DataFrame

from shoptrail.llm.common import per_text

# The phrases that every scan counts, and their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Phrases of notices that name a license in other words.
NOTICE_PHRASES = {
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "creative commons attribution": "cc-by",
    "cc by": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc0": "cc0",
    "public domain": "public-domain",
    "isc license": "isc",
    "boost software license": "bsl",
    "all rights reserved": "proprietary",
}
TAGS = ("spdx-license-identifier:", "license-expression:")
# What an identifier begins with, its label, and how much it restricts (0 public domain, 1 permissive,
# 2 weak copyleft, 3 copyleft, 4 not for free use). The longest beginning counts.
FAMILIES = {
    "mit": ("mit", 1),
    "apache": ("apache", 1),
    "bsd": ("bsd", 1),
    "isc": ("isc", 1),
    "bsl": ("bsl", 1),
    "zlib": ("zlib", 1),
    "unlicense": ("public-domain", 0),
    "cc0": ("cc0", 0),
    "cc-by": ("cc-by", 1),
    "cc-by-sa": ("cc-by-sa", 3),
    "cc-by-nc": ("cc-by-nc", 4),
    "cc-by-nd": ("cc-by-nd", 4),
    "mpl": ("mpl", 2),
    "epl": ("epl", 2),
    "lgpl": ("lgpl", 2),
    "gpl": ("gpl", 3),
    "agpl": ("agpl", 3),
    "proprietary": ("proprietary", 4),
}
_STRENGTH = {"or": 1, "and": 2, "with": 3}
_SYMBOLS = re.compile(r"[()]|[A-Za-z0-9.+:-]+")
_SEPARATORS = bytes(range(0x00, 0x30)) + bytes(range(0x3A, 0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x80))
_UPPER = bytes(range(0x41, 0x5B))
_TO_WORDS = bytes.maketrans(_SEPARATORS + _UPPER, b" " * len(_SEPARATORS) + _UPPER.lower())
_TO_LOWER = bytes.maketrans(_UPPER, _UPPER.lower())


def automaton(patterns) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for key, value in patterns:
        found.add_word(key, value)
    found.make_automaton()
    return found


def family(identifier: str) -> tuple[str, int]:
    """Label and restriction of an identifier; unknown ones are their own label, taken as not free."""
    name = identifier.lower()
    fits = [begin for begin in FAMILIES if name == begin or name.startswith((begin + "-", begin + "+"))]
    return FAMILIES[max(fits, key=len)] if fits else (name.rstrip("+"), 4)


def to_postfix(expression: str) -> list[str] | None:
    """Shunting-yard: identifiers and operators in postfix order; None if it is no expression."""
    out, waiting, operand_next = [], [], True
    for symbol in _SYMBOLS.findall(expression):
        word = symbol.lower()
        if symbol == "(":
            if not operand_next:
                return None
            waiting.append(symbol)
        elif symbol == ")":
            if operand_next:
                return None
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                return None
            waiting.pop()
        elif word in _STRENGTH:
            if operand_next:
                return None
            while waiting and waiting[-1] != "(" and _STRENGTH[waiting[-1]] >= _STRENGTH[word]:
                out.append(waiting.pop())
            waiting.append(word)
            operand_next = True
        else:
            if not operand_next:
                return None
            out.append(symbol)
            operand_next = False
    if operand_next or "(" in waiting:
        return None
    return out + waiting[::-1]


def evaluate(postfix: list[str]) -> tuple[set[str], int]:
    """Labels that an expression names, and its restriction: the least of alternatives (``or``), the
    greatest of what holds together (``and``); an exception (``with``) lowers it by one step."""
    stack: list[tuple[set[str], int]] = []
    for symbol in postfix:
        if symbol not in _STRENGTH:
            stack.append(({symbol}, family(symbol)[1]))
            continue
        (right, more), (left, less) = stack.pop(), stack.pop()
        if symbol == "with":
            stack.append((left, max(0, less - 1)))
        else:
            stack.append((left | right, min(less, more) if symbol == "or" else max(less, more)))
    names, level = stack[0]
    return {family(name)[0] for name in names}, level


def read_expression(after: str) -> tuple[set[str], int] | None:
    """The longest start of a line's rest that is an expression, as comment marks and prose may follow."""
    symbols = _SYMBOLS.findall(after)
    ends, depth, operand_next = [], 0, True
    for i, symbol in enumerate(symbols):
        word = symbol.lower()
        if operand_next != (symbol == "(" or (symbol != ")" and word not in _STRENGTH)):
            break
        depth += (symbol == "(") - (symbol == ")")
        if depth < 0:
            break
        operand_next = symbol == "(" or word in _STRENGTH
        if not operand_next and not depth:
            ends.append(i + 1)
    if not ends:
        return None
    postfix = to_postfix(" ".join(symbols[: ends[-1]]))
    return evaluate(postfix) if postfix else None


class Scanner:
    """Finds licenses in single texts."""

    def __init__(self):
        phrases = {p: (label, True) for p, label in BASE_PHRASES.items()} | {p: (label, False) for p, label in NOTICE_PHRASES.items()}
        self.phrases = automaton((f" {p} ", (p.count(" ") + 1, *v)) for p, v in phrases.items())
        self.tags = automaton((t, len(t)) for t in TAGS)

    def scan(self, text: str) -> dict:
        """Counts, places and labels of one text.

        ``score`` is the chance that the text names a license if each piece of evidence stood alone:
        0.9 for a valid expression after a tag, 0.7 for each license phrase label, 0 without any.
        """
        raw = text.encode()
        words = raw.translate(_TO_WORDS).split()
        # one byte, one character: only ASCII is compared, and no byte of other characters is ASCII
        joined = (b" " + b" ".join(words) + b" ").decode("latin-1")
        starts, base, others = [], set(), set()
        at, passed = 0, 0
        for end, (length, label, is_base) in self.phrases.iter(joined):
            if is_base:
                passed += joined.count(" ", at, end + 1)
                at = end + 1
                starts.append(passed - 1 - length)
                base.add(label)
            else:
                others.add(label)
        lower = raw.translate(_TO_LOWER).decode("latin-1")
        expressions, restriction = 0, None
        tags = [(end + 1 - length, end + 1) for end, length in self.tags.iter(lower)]
        for (_, begin), (following, _) in zip(tags, [*tags[1:], (len(lower), 0)], strict=False):
            # an expression ends with its line, or where the next tag begins
            following = max(begin, following)
            stop = lower.find("\n", begin, following)
            if (found := read_expression(lower[begin : stop if stop >= 0 else following])) is not None:
                others |= found[0]
                restriction = found[1] if restriction is None else max(restriction, found[1])
                expressions += 1
        labels = base | others
        return {
            "n_words": len(words),
            "n_base": len(starts),
            "first_word": min(starts, default=None),
            "last_word": max(starts, default=None),
            "base_labels": ",".join(sorted(base)),
            "labels": ",".join(sorted(labels)),
            "score": 1.0 - 0.3 ** len(labels) * 0.1**expressions,
            "n_expressions": expressions,
            "restriction": restriction,
        }


FIELDS = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, n_expressions long, restriction int"
)


def scan_licenses(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and what the scan finds, for each row of ``docs``.

    Null and empty texts have no words, no labels and score 0. ``restriction`` is the strictest of the
    text's expressions, null without one. Rows are scanned alone, whatever their number or order.
    """

    def make():
        scanner = Scanner()

        def step(texts: list[str]) -> dict[str, list]:
            found = [scanner.scan(t) for t in texts]
            return {name: [f[name] for f in found] for name in found[0]} if found else {}

        return step

    return per_text(docs, keep, text, make, FIELDS)
