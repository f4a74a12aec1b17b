"""Text of an HTML fragment, read token by token.

A small state machine after the HTML standard's tokenizer: data, tag name,
attribute name and value (a quoted value may hold ``>``), comment, other
declaration, raw text. Comments, declarations, tags and the contents of
``script``, ``style`` and ``template`` are left out. What is not closed runs to the
end of the fragment; a ``<`` that starts no tag is text. ``title`` and
``textarea`` are read like any other element. Character references are left to the caller.
"""

from __future__ import annotations

import re

RAW = ("script", "style")

_NAME = re.compile(r"[^\t\n\f\r />]*")
_BETWEEN = re.compile(r"[\t\n\f\r /]*")
_BLANK = re.compile(r"[\t\n\f\r ]*")
_ATTRIBUTE = re.compile(r"(?s).[^\t\n\f\r />=]*")
_BARE_VALUE = re.compile(r"[^\t\n\f\r >]*")
_COMMENT_END = re.compile(r"--!?>")
_RAW_END = {name: re.compile(rf"(?i)</{name}(?=[\t\n\f\r />])") for name in RAW}


def _letter(c: str) -> bool:
    return c.isascii() and c.isalpha()


def tag_end(s: str, at: int) -> int:
    """The place behind the tag whose name ends at ``at``; the end of ``s`` if it is not closed."""
    while True:
        at = _BETWEEN.match(s, at).end()
        if at == len(s):
            return at
        if s[at] == ">":
            return at + 1
        at = _BLANK.match(s, _ATTRIBUTE.match(s, at).end()).end()
        if not s.startswith("=", at):
            continue
        at = _BLANK.match(s, at + 1).end()
        quote = s[at:at + 1]
        if quote in ('"', "'"):
            close = s.find(quote, at + 1)
            if close < 0:
                return len(s)
            at = close + 1
        else:
            at = _BARE_VALUE.match(s, at).end()


def comment_end(s: str, at: int) -> int:
    """The place behind the comment whose ``<!--`` ends at ``at``."""
    for short in (">", "->"):
        if s.startswith(short, at):
            return at + len(short)
    m = _COMMENT_END.search(s, at)
    return m.end() if m else len(s)


def past(s: str, what: str, at: int) -> int:
    found = s.find(what, at)
    return len(s) if found < 0 else found + len(what)


def text_of(s: str) -> str:
    out: list[str] = []
    at, hidden = 0, 0                    # hidden: open template elements
    while at < len(s):
        lt = s.find("<", at)
        lt = len(s) if lt < 0 else lt
        if not hidden:
            out.append(s[at:lt])
        at = lt
        closing = s.startswith("/", lt + 1)
        first = s[lt + 1 + closing:lt + 2 + closing]
        if _letter(first):
            name = _NAME.match(s, lt + 1 + closing)
            at = tag_end(s, name.end())
            tag = name.group().lower()
            if tag == "template":
                hidden = max(0, hidden - 1) if closing else hidden + 1
            elif tag in RAW and not closing:
                end = _RAW_END[tag].search(s, at)
                at = tag_end(s, end.end()) if end else len(s)
        elif s.startswith("<!--", lt):
            at = comment_end(s, lt + 4)
        elif s.startswith(("<!", "<?"), lt) or (closing and first):
            at = past(s, ">", lt + 2)
        elif lt < len(s):
            at = lt + 1 + closing
            if not hidden:
                out.append(s[lt:at])
    return "".join(out)
