"""Question-text normalisers and keyword sets as Spark Column expressions.

Every function here returns a ``Column`` built from built-in SQL functions
(``lower``, ``regexp_replace``, ``split``, ``array_except`` ...), so the work
stays inside whole-stage codegen on the executors. No Python UDF is used.

Python's ``str.strip()`` / ``str.split()`` treat a wider set of characters as
whitespace than Spark's ``trim``; ``WS_CLASS`` spells that set out so that the
Spark expressions agree with the rules they implement. The same class string
is valid in Java regex and in RE2 (used by the DuckDB oracle).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the rules being reproduced) -----------------

# Unicode whitespace as understood by Python's str.split()/str.strip().
WS_CLASS = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)

# ASCII punctuation replaced by the keyword normaliser: all 32 ASCII
# punctuation characters except the backslash, which that rule never matches.
PUNCT_CLASS = r"[!-/:-@\[\]^_`{-~]"

# Characters deleted by the question normaliser.
QUESTION_PUNCT_CLASS = r"[.,?!]"

# Leading words dropped by the question normaliser (one word at most).
QUESTION_WORDS = ("what", "when", "where", "who", "why", "how", "which", "whose", "whom")

# Leading auxiliaries dropped by the question normaliser (after the above).
LEADING_AUX = ("is", "was", "were")

# The short stop-word list (14 words) of the fuzzy linkage job.
STOP_WORDS_14 = (
    "a", "an", "the", "is", "was", "were", "will", "be", "in", "on", "at", "to", "for", "of",
)

# The long stop-word list (35 words) of the candidate search job.
STOP_WORDS_35 = (
    "a", "an", "the", "is", "was", "were", "will", "be", "to", "of", "and",
    "in", "on", "at", "by", "for", "with", "about", "from", "did", "does",
    "do", "has", "have", "had", "what", "when", "where", "who", "why", "how",
    "which", "whose", "whom", "that",
)

# --------------------------------------------------------------------------

STOP_LISTS = {"14": STOP_WORDS_14, "35": STOP_WORDS_35, "none": ()}

# A word of the keyword rule is a maximal run of characters that are neither
# keyword punctuation nor whitespace, so one regex split finds them all.
WORD_SEPARATORS = "[" + PUNCT_CLASS[1:-1] + WS_CLASS[1:-1] + "]+"

# the characters of ``WS_CLASS``
WS_CHARS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
_ANY_WS = f"{WS_CLASS}+"
# a character that is not whitespace: ``strip(x) != ''`` <=> ``x`` contains one
NON_WS = "[^" + WS_CLASS[1:-1] + "]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.btrim(_col(c), F.lit(WS_CHARS))


def has_text(c) -> Column:
    """``strip(c) != ''`` without stripping: true when a non-whitespace
    character exists (stops at the first one; false for null)."""
    return F.coalesce(_col(c).rlike(NON_WS), F.lit(False))


def collapse_ws(c) -> Column:
    """Python ``' '.join(s.split())``: single blanks between words, no ends."""
    return F.trim(F.regexp_replace(_col(c), _ANY_WS, " "))


def normalize_basic(c) -> Column:
    """Lower-case and strip (the exact-merge key)."""
    return strip_ws(F.lower(_col(c)))


def normalize_question(c) -> Column:
    """Key of the keyed-store job.

    lower + strip; delete ``. , ? !``; collapse whitespace; drop one leading
    question word when it is the whole first word; then drop one leading
    ``is``/``was``/``were`` followed by a blank.
    """
    s = F.regexp_replace(F.lower(_col(c)), QUESTION_PUNCT_CLASS, "")
    s = collapse_ws(s)
    s = F.regexp_replace(s, "^(?:" + "|".join(QUESTION_WORDS) + ")(?: |$)", "")
    return F.regexp_replace(s, "^(?:" + "|".join(LEADING_AUX) + ") ", "")


def normalize_text(c) -> Column:
    """Key of the fuzzy job: lower, punctuation to blank, collapse whitespace."""
    return collapse_ws(F.regexp_replace(F.lower(_col(c)), PUNCT_CLASS, " "))


NORMALIZERS = {
    "basic": normalize_basic,
    "question": normalize_question,
    "text": normalize_text,
}


def normalizer(name: str):
    try:
        return NORMALIZERS[name]
    except KeyError:
        raise ValueError(f"unknown normaliser {name!r}; use one of {sorted(NORMALIZERS)}")


def keywords(c, stop_words="14", normalized: bool = False) -> Column:
    """Distinct keyword set: ``normalize_text`` words minus stop words.

    ``stop_words`` is ``"14"``, ``"35"``, ``"none"`` or an explicit sequence.
    The result is an ``array<string>`` without duplicates (set semantics);
    element order is not meaningful.
    """
    words = STOP_LISTS[stop_words] if isinstance(stop_words, str) else tuple(stop_words)
    drop = F.array(*[F.lit(w) for w in ("",) + tuple(words)])
    if normalized:      # already single-blank separated
        return F.array_except(F.split(_col(c), " "), drop)
    # same words as splitting normalize_text(c) on blanks, in one regex pass
    return F.array_except(F.split(F.lower(_col(c)), WORD_SEPARATORS), drop)


def sorted_joined(arr, sep: str = " ") -> Column:
    """Deterministic text form of a string set (sorted, joined)."""
    return F.array_join(F.array_sort(_col(arr)), sep)
