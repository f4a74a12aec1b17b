"""SQL text of the normalisers, for the DuckDB oracle queries.

Nothing here is taken from the modules under test: word lists, classes,
patterns and references are stated again as literals, so a wrong constant on
one side shows up as a difference.
"""

from __future__ import annotations

# --- fixed values ----------------------------------------------------------

# white space as str.split() understands it
WS_CLASS = (r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
            r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")

# ASCII punctuation but for the backslash
PUNCT_CLASS = r"[!-/:-@\[\]^_`{-~]"

QUESTION_WORDS = "what|when|where|who|why|how|which|whose|whom"
LEADING_AUX = "is|was|were"

STOP_WORDS = {
    "14": "a an the is was were will be in on at to for of",
    "35": "a an the is was were will be to of and in on at by for with about from did does do has have had "
          "what when where who why how which whose whom that",
}

TOKEN = r"<[^>]*>|[^<\t\n\x0B\f\r ]+"

ELEMENTS = (r"(?s)<title>.*?</title>", r"(?s)<h1>.*?</h1>", r"(?s)<a .*?</a>")

# removed from a fragment, in this order
MARKUP = (
    r"(?s)<!--.*?-->",
    r"(?is)<script\b[^>]*>.*?</script[ \t\n\f\r]*>",
    r"(?is)<style\b[^>]*>.*?</style[ \t\n\f\r]*>",
    r"(?is)<template\b[^>]*>.*?</template[ \t\n\f\r]*>",
    r"<![^>]*>",
    r"<\?[^>]*>",
    r"<[^>]*>",
)

# references and their characters; the last one last
REFERENCES = (("&lt;?", "<"), ("&gt;?", ">"), ("&quot;?", '"'), ("&apos;", "'"), ("&#39;", "'"),
              ("&nbsp;?", "\u00a0"), ("&copy;?", "\u00a9"), ("&middot;?", "\u00b7"), ("&amp;?", "&"))

# ---------------------------------------------------------------------------


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip_ws(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, {q('^' + WS_CLASS + '+')}, ''), {q(WS_CLASS + '+$')}, '')"


def collapse_ws(x: str) -> str:
    return f"trim(regexp_replace({x}, {q(WS_CLASS + '+')}, ' ', 'g'))"


def norm_basic(x: str) -> str:
    return strip_ws(f"lower({x})")


def norm_question(x: str) -> str:
    s = f"regexp_replace(lower({x}), {q("[.,?!]")}, '', 'g')"
    s = collapse_ws(s)
    s = f"regexp_replace({s}, {q('^(?:' + QUESTION_WORDS + ')(?: |$)')}, '')"
    return f"regexp_replace({s}, {q('^(?:' + LEADING_AUX + ') ')}, '')"


def norm_text(x: str) -> str:
    return collapse_ws(f"regexp_replace(lower({x}), {q(PUNCT_CLASS)}, ' ', 'g')")


NORM = {"basic": norm_basic, "question": norm_question, "text": norm_text}


def stop_list(name: str) -> str:
    return "[" + ", ".join(q(w) for w in ["", *STOP_WORDS[name].split()]) + "]"


def keywords(x: str, stop: str = "14") -> str:
    """Distinct keywords of ``x`` as a DuckDB list (order not meaningful)."""
    return (f"list_distinct(list_filter(string_split({norm_text(x)}, ' '), "
            f"lambda w: NOT list_contains({stop_list(stop)}, w)))")


def sorted_joined(lst: str) -> str:
    return f"array_to_string(list_sort({lst}), ' ')"


# Stand-in views shared by the linkage oracles (see kinship.sources.driver_tables).
QUESTIONS = """questions AS (
  SELECT doc_id AS q_id, doc_id AS ord, text AS question, [lang] AS answer, lang AS dataset
  FROM documents WHERE doc_id % 2 = 0)"""

CORPUS = """corpus AS (
  SELECT doc_id AS example_id, doc_id AS ord, text AS question_text, source AS document_url,
         lang AS document_title, text AS document_text
  FROM documents WHERE doc_id % 2 = 1)"""


def prepared(norm: str, require_url: bool = False, whole: bool = False) -> str:
    """CTEs ``pq`` (questions with stripped question + key) and ``pc``
    (non-empty corpus rows with key); ``whole``: every row is a corpus row."""
    f = NORM[norm]
    corpus = CORPUS.replace("WHERE doc_id % 2 = 1", "") if whole else CORPUS
    url = " AND coalesce(document_url, '') <> ''" if require_url else ""
    return f"""{QUESTIONS},
{corpus},
pq AS (SELECT * REPLACE ({strip_ws("coalesce(question, '')")} AS question) FROM questions),
pq2 AS (SELECT *, {f('question')} AS key FROM pq),
pc0 AS (SELECT *, {strip_ws("coalesce(question_text, '')")} AS corpus_question FROM corpus),
pc AS (SELECT *, {f('corpus_question')} AS key FROM pc0 WHERE corpus_question <> ''{url})"""


def strip_tags(x: str) -> str:
    for p in MARKUP:
        x = f"regexp_replace({x}, {q(p)}, '', 'g')"
    return x


def decode_native(x: str) -> str:
    for ref, ch in REFERENCES:
        x = f"regexp_replace({x}, {q(ref)}, {q(ch)}, 'g')"
    return x


def tokens(x: str) -> str:
    return f"regexp_extract_all({x}, {q(TOKEN)})"


def simplified_text(x: str) -> str:
    return f"array_to_string(list_transform({tokens(x)}, lambda t: replace(t, ' ', '_')), ' ')"


def element_spans() -> str:
    """CTE ``spans``: every title, h1 and a element of every page with its text
    and token offsets. What stands between the elements (``gap``) and the
    elements (``el``) alternate; offsets are running sums over both."""
    cut = "\n  UNION ALL\n  ".join(
        f"""SELECT page_id, url, html, {i} AS elem, string_split_regex(html, {q(p)}) AS gaps,
         regexp_extract_all(html, {q(p)}) AS els FROM pages""" for i, p in enumerate(ELEMENTS))
    return f"""cut AS (
  {cut}),
nth AS (SELECT page_id, url, elem, unnest(range(1, len(els) + 1)) AS k, gaps, els FROM cut),
sized AS (SELECT page_id, url, elem, k, els[k] AS el, len({tokens('gaps[k]')}) AS gap_tok, len({tokens('els[k]')}) AS n_tok FROM nth),
spans AS (
  SELECT page_id, url, elem, k, el, n_tok,
         (sum(gap_tok + n_tok) OVER (PARTITION BY page_id, elem ORDER BY k) - n_tok)::BIGINT AS start_token
  FROM sized)"""
