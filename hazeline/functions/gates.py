"""What a text must hold before a regular expression over it can match.

``low`` is the lower-cased text. Patterns that ignore case do so for ASCII letters, which
lower-casing maps onto the ones asked for, so a gate never closes on a match; it only saves
the search in the texts that can't have one. Whole words of a list are looked for all at
once: ``whole`` says which stand in a text, ``stands`` asks it for one of them.
"""

from __future__ import annotations

import functools
import operator
import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal(word: str) -> str:
    """The plain beginning of a word of an alternation, lower-cased."""
    return re.match(r"[^\\()\[\]{}.*+?^$|]*", word).group().lower()


def holds(low: Column, words: list[str]) -> Column:
    """Whether ``low`` holds any of the words' plain beginnings; those that hold another are left out."""
    plain = sorted({literal(w) for w in words}, key=lambda w: (len(w), w))
    out = None
    for i, w in enumerate(plain):
        if not any(p in w for p in plain[:i]):
            here = F.contains(low, F.lit(w))
            out = here if out is None else out | here
    return out


def matches(text: Column, low: Column, words: list[str], pattern: str) -> Column:
    """``text`` RLIKE ``pattern``, looked for only where one of the words stands."""
    return holds(low, words) & text.rlike(pattern)


def spelled(word: str) -> list[str]:
    """The plain words that ``a (?:b|c)`` stands for, lower-cased."""
    m = re.fullmatch(r"(.*)\(\?:([^()]*)\)(.*)", word)
    return [x for part in m[2].split("|") for x in spelled(m[1] + part + m[3])] if m else [word.lower()]


def _tree(words: set[str]) -> str:
    """An alternation that looks at each letter once, the longest word first: a(?:bc|d)?|e."""
    firsts = sorted({w[0] for w in words if w})
    if not firsts:
        return ""
    every = "|".join(re.escape(c) + _tree({w[1:] for w in words if w and w[0] == c}) for c in firsts)
    return every if len(firsts) == 1 and "" not in words else f"(?:{every})" + ("?" if "" in words else "")


def whole(text: Column, words: list[str]) -> Column:
    """The longest of the words that stands, as whole words do, at each place of ``text``: lower-cased, each between line ends.

    One pass over the text, from word to word.
    """
    found = F.regexp_extract_all(text, F.lit(rf"(?i)\b(?:(?=({_tree({x for w in words for x in spelled(w)})})\b))?\w+"), F.lit(1))
    return F.concat(F.lit("\n"), F.lower(F.array_join(found, "\n")), F.lit("\n"))


def within(word: str, words: list[str]) -> list[str]:
    """The words of which ``word`` is the beginning as a whole word: where one of them stands, so does it."""
    every = sorted({x for w in words for x in spelled(w)})
    return [x for x in every for w in spelled(word) if x == w or x.startswith(w) and not re.match(r"\w", x[len(w)])]


def stands(found: Column, word: str, words: list[str]) -> Column:
    """Whether the whole word stands in a text, whose ``whole`` is ``found``."""
    return functools.reduce(operator.or_, (F.contains(found, F.lit(f"\n{x}\n")) for x in within(word, words)))


def any_stands(found: Column, some: list[str], words: list[str]) -> Column:
    """Whether any of ``some`` of the words stands. (As a higher-order function, which also keeps the
    projection out of whole-stage code: labels in one generated method are too long for the JIT.)"""
    return F.exists(F.split(found, "\n"), lambda x: x.isin(*sorted({y for w in some for y in within(w, words)})))
