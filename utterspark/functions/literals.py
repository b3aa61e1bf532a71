"""What a text must contain for a regular expression to match: a literal that every match holds.

Read from the pattern's top level only (groups, classes and escapes for classes count as unknown), so the
literal is always necessary and a pattern it cannot be read from simply has none.
"""

from __future__ import annotations

import re

# Escapes that stand for more than the next character, and how much belongs to them.
_ESCAPES = (
    ("x", re.compile(r"\{[0-9A-Fa-f]+\}|[0-9A-Fa-f]{2}")),
    ("u", re.compile(r"[0-9A-Fa-f]{4}")),
    ("p", re.compile(r"\{[^}]*\}|.")),
    ("P", re.compile(r"\{[^}]*\}|.")),
    ("N", re.compile(r"\{[^}]*\}")),
    ("k", re.compile(r"<[^>]*>")),
    ("c", re.compile(r".")),
)
_QUANTIFIER = re.compile(r"(?:([*?+])|\{(\d+)(?:,\d*)?\})[?+]?")
# case folding, comments mode, quoting and odd classes: nothing is read from such patterns
_UNREADABLE = re.compile(r"\(\?[a-zA-Z]*[ix]|\\Q|\[\^?\]")


def _after_class(p: str, i: int) -> int:
    """The place after the class that begins at ``i``; nested classes count."""
    depth = 0
    while i < len(p):
        if p[i] == "\\":
            i += 1
        elif p[i] == "[":
            depth += 1
        elif p[i] == "]":
            depth -= 1
            if depth == 0:
                return i + 1
        i += 1
    return -1


def _after_group(p: str, i: int) -> int:
    depth = 0
    while 0 <= i < len(p):
        if p[i] == "\\":
            i += 2
            continue
        if p[i] == "[":
            i = _after_class(p, i)
            continue
        depth += {"(": 1, ")": -1}.get(p[i], 0)
        i += 1
        if depth == 0:
            return i
    return -1


def required_literal(pattern: str) -> str | None:
    """The longest literal that every match of ``pattern`` contains, as far as its top level tells; None
    if there is none of two characters (or one beyond ASCII)."""
    if _UNREADABLE.search(pattern):
        return None
    runs, run, i = [], "", 0
    while i < len(pattern):
        c, atom = pattern[i], None
        if c == "\\":
            if i + 1 == len(pattern):
                return None
            c = pattern[i + 1]
            i += 2
            if not c.isalnum():
                atom = c
            elif c.isdigit():
                while i < len(pattern) and pattern[i].isdigit():
                    i += 1
            else:
                for letter, more in _ESCAPES:
                    m = more.match(pattern, i) if c == letter else None
                    if m:
                        i = m.end()
        elif c in "[(":
            i = _after_class(pattern, i) if c == "[" else _after_group(pattern, i)
            if i < 0:
                return None
        elif c in "|){}*?+":  # branches at the top level, or something malformed
            return None
        else:
            atom = None if c in ".^$" else c
            i += 1
        q = _QUANTIFIER.match(pattern, i)
        if q:
            i = q.end()
        least = 1 if q is None or q.group(1) == "+" else int(q.group(2) or 0)
        if atom is not None and least:
            run += atom
        if atom is None or q:
            runs.append(run)
            run = ""
    best = max([*runs, run], key=len)
    return best if len(best) > 1 or best > "\x7f" else None
