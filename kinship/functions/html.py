"""HTML helpers: UTF-8 byte slicing and fragment-to-text conversion.

A fragment's text leaves out tags, comments, declarations and the contents of
``script``, ``style`` and ``template``, and decodes character references with
the result of Python's ``html.unescape`` (HTML5 rules, e.g. legacy names such
as ``&amp`` decode without ``;``). Plain fragments stay in the JVM: where no
``ODD`` sign occurs every tag ends at its first ``>``, and the references
listed in ``ENTITIES`` are decoded with ``regexp_replace`` (``&amp`` last,
which makes the chain equal to a single decoding pass). Only the others, read
by the tokenizer of ``html_tokens``, and those with other references go to one
Arrow function.
"""

from __future__ import annotations

import html as _html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, StringType

from kinship.functions.html_tokens import text_of
from kinship.functions.text import _col

# --- fixed values: references decoded natively, in this order ------------
# (name, character, ";" optional). Names whose ";" is optional are the HTML5
# legacy names, decoded without ";" as well; "amp" comes last so the chain
# equals a single decoding pass.
ENTITIES = (
    ("lt", "<", True),
    ("gt", ">", True),
    ("quot", '"', True),
    ("apos", "'", False),
    ("#39", "'", False),
    ("nbsp", "\u00a0", True),
    ("copy", "©", True),
    ("middot", "·", True),
    ("amp", "&", True),
)
# -------------------------------------------------------------------------

_LEGACY = "|".join(n for n, _, opt in ENTITIES if opt)
_STRICT = "|".join(n for n, _, opt in ENTITIES if not opt)
# An '&' that does not start a natively decoded reference: not one of the
# names with ";", nor a legacy name followed by neither a letter nor a digit
# (``&ltimes;`` or ``&ampx`` go to the Python decoder).
OTHER_REF = f"&(?!(?:{_LEGACY}|{_STRICT});|(?:{_LEGACY})(?![A-Za-z0-9]))"


def entity_pattern(name: str, optional: bool) -> str:
    """Regex of one natively decoded reference (same text in Java and RE2)."""
    return "&" + name + (";?" if optional else ";")


# Signs that a fragment needs the tokenizer: a "<" that no tag name follows (comments,
# declarations, text), tags without end, quoted values with ">", raw text.
# Each is linear to search for; a sign in mere text costs time, no more.
ODD = (r"""(?i)<[^a-z/]|</[^a-z]|</?\z|<[^>]*<|<[^>]*\z|=[ \t\n\f\r]*"[^"]*>|=[ \t\n\f\r]*'[^']*>"""
       r"""|<(?:script|style|template)(?![^ \t\n\f\r/>])""")
PLAIN_TAG = r"<[^>]*>"


@pandas_udf(StringType())
def _unescape(s: pd.Series) -> pd.Series:
    return s.map(lambda v: None if v is None else _html.unescape(v))


def decode_native(c) -> Column:
    """Decode the ``ENTITIES`` references natively (usable in lambdas); for
    text without other references this equals ``html.unescape``."""
    c = _col(c)
    for name, ch, optional in ENTITIES:
        c = F.regexp_replace(c, entity_pattern(name, optional), ch)
    return c


def decode_entities(c) -> Column:
    c = _col(c)
    other = c.rlike(OTHER_REF)
    # Spark evaluates a Python UDF for every row even inside CASE WHEN, so
    # rows that do not need it pass a null (a few bytes in the Arrow batch).
    return F.when(other, _unescape(F.when(other, c))).otherwise(decode_native(c))


@pandas_udf(StringType())
def _text(s: pd.Series) -> pd.Series:
    return s.map(lambda v: None if v is None else _html.unescape(text_of(v)))


@pandas_udf(ArrayType(StringType()))
def _text_all(s: pd.Series) -> pd.Series:
    return s.map(lambda arr: None if arr is None else
                 [None if v is None else _html.unescape(text_of(v)) for v in arr])


def _plain_text(c: Column) -> Column:
    return F.regexp_replace(c, PLAIN_TAG, "")


def _needs_reader(c: Column) -> Column:
    return c.rlike(ODD) | _plain_text(c).rlike(OTHER_REF)


def html_text(c) -> Column:
    """Text of an HTML fragment (tags removed, references decoded)."""
    c = _col(c)
    odd = _needs_reader(c)
    return F.when(odd, _text(F.when(odd, c))).otherwise(decode_native(_plain_text(c)))


def html_text_all(arr) -> Column:
    """Element-wise ``html_text`` over an ``array<string>``; an array with a
    fragment that needs the tokenizer goes to it whole, once."""
    arr = _col(arr)
    odd = F.exists(arr, _needs_reader)
    return F.when(odd, _text_all(F.when(odd, arr))).otherwise(F.transform(arr, lambda x: decode_native(_plain_text(x))))


def byte_slice(text, start_byte, end_byte) -> Column:
    """``text.encode('utf-8')[start:end]`` decoded back to a string.

    Slicing is done on BINARY; a cut inside a multi-byte character is
    repaired with U+FFFD instead of failing the task.
    """
    b = F.encode(_col(text), "UTF-8")
    s, e = _col(start_byte), _col(end_byte)
    part = F.substring(b, s + F.lit(1), F.greatest(e - s, F.lit(0)))
    return F.make_valid_utf8(part.cast("string"))
