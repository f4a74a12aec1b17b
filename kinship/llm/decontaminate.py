"""Benchmark decontamination with a positional inverted index, in DataFrame operations only.

The windows of the benchmark items are phrases to look up. Of every phrase the
rarest terms in the training texts are chosen; the index stores the postings
(term, document, position) of those terms. Candidates come from the rarest
list of a phrase, moved back by the term's offset, and are intersected with
the next rarest lists moved likewise. What is left is compared word by word
with the text (or, with some slack, as a set of words close to each other).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinship.llm.common import keyed, lower_ascii, materialise, small, whole_text

#: What separates words, after lower-casing A-Z.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(text), SEPARATORS, -1), "")


def phrases(items: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (``wid, words``) and which items have them (``wid, item``).

    An item with fewer words is one window, one without words has none. Items
    are told apart by id; a null id is the item "null".
    """
    win = (items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
                        words_of(whole_text()).alias("w"))
           .filter(F.size("w") > 0)
           .select("item", F.explode(F.expr(
               f"transform(sequence(0, greatest(size(w) - {length}, 0)), i -> slice(w, i + 1, {length}))")).alias("words"))
           .distinct())
    windows = materialise(win.select("words").distinct().withColumn("wid", F.monotonically_increasing_id()), "windows")
    return windows, materialise(win.join(windows, "words").select("wid", "item"), "window-items")


def rarest(windows: DataFrame, frequencies: DataFrame, terms: int) -> DataFrame:
    """``wid, words, r``: the ``terms`` rarest terms of each window as an array of
    (cf, off, tid). A window with a term that no text holds is left out."""
    ranked = (windows.select("wid", F.posexplode("words").alias("off", "term")).join(frequencies, "term")
              .groupBy("wid").agg(F.sort_array(F.collect_list(F.struct("cf", "off", "tid"))).alias("r")))
    return (windows.join(ranked, "wid").filter(F.size("r") == F.size("words"))
            .select("wid", "words", F.slice("r", 1, terms).alias("r")))


def find_phrases(docs: DataFrame, items: DataFrame, length: int = 10, terms: int = 3, slack: int = 0,
                 max_broadcast: int = 200_000) -> tuple[DataFrame, DataFrame]:
    """Where the windows of ``items`` occur in ``docs``.

    Returns ``doc_id, th, n_words, matches`` of every row, ``matches`` being an
    array of (start, len, wid), and ``wid, item``. With ``slack`` 0 a match is
    the exact phrase; else it is a proximity match: all words of the window lie
    between ``start - slack`` and ``start + len + slack``, the rarest ones at
    most ``slack`` words off their places.

    Null texts have no words; empty tables give no matches; repeated rows each
    get a row. Word positions count from 0.
    """
    windows, window_items = phrases(items, length)
    k = keyed(docs)
    tokens = k.select("doc_id", "th", F.posexplode(words_of(F.col("text"))).alias("pos", "term"))
    vocabulary = windows.select(F.explode("words").alias("term")).distinct()
    frequencies = materialise(
        tokens.select("term").join(small(vocabulary, max_broadcast), "term")
        .groupBy("term").agg(F.count("*").alias("cf")).withColumn("tid", F.monotonically_increasing_id()),
        "frequencies")
    plan = materialise(rarest(windows, frequencies, terms), "phrase-plan")
    anchors = (plan.select(F.explode("r.tid").alias("tid")).distinct()
               .join(frequencies, "tid").select("term", "tid"))
    index = materialise(tokens.join(small(anchors, max_broadcast), "term").select("tid", "doc_id", "th", "pos"), "index")

    # the rarest list of each phrase, moved back to where the phrase would start
    first = plan.select("wid", "r", F.size("words").alias("len"), F.expr("r[0].tid").alias("tid"))
    cand = (index.join(small(first, max_broadcast), "tid")
            .select("wid", "r", "len", "doc_id", "th", F.expr("pos - r[0].off").alias("start"))
            .filter(F.col("start") >= -slack).distinct())
    for i in range(1, terms):
        rest = cand.filter(F.size("r") <= i)             # short windows have no such term
        more = cand.filter(F.size("r") > i).withColumn("tid", F.expr(f"r[{i}].tid"))
        near = ([F.expr(f"p.pos = c.start + c.r[{i}].off")] if not slack else
                [F.expr(f"abs(p.pos - c.start - c.r[{i}].off) <= {slack}")])
        both = (more.alias("c").join(
            index.alias("p"), [F.col("c.tid") == F.col("p.tid"), F.expr("c.doc_id <=> p.doc_id"),
                               F.col("c.th") == F.col("p.th"), *near], "left_semi").drop("tid"))
        cand = both.unionByName(rest)
    listed = (cand.select("wid", "doc_id", "th", "start").join(small(windows, max_broadcast), "wid")
              .groupBy("doc_id", "th")
              .agg(F.collect_set(F.struct("start", F.size("words").alias("len"), "wid", "words")).alias("cands")))
    fits = ("slice(w, c.start + 1, c.len) = c.words" if not slack else
            f"size(array_except(c.words, slice(w, greatest(c.start - {slack}, 0) + 1, "
            f"c.len + {slack} + least(c.start, {slack})))) = 0")
    found = (k.alias("d").join(listed.alias("l"), F.expr("d.doc_id <=> l.doc_id and d.th = l.th"), "left")
             .select("d.doc_id", "d.th", words_of(F.col("d.text")).alias("w"), "l.cands")
             .select("doc_id", "th", F.size("w").cast("long").alias("n_words"), F.expr(
                 f"transform(filter(coalesce(cands, array()), c -> {fits}), "
                 "c -> struct(c.start as start, c.len as len, c.wid as wid))").alias("matches")))
    return found, window_items


def contamination(docs: DataFrame, items: DataFrame, length: int = 10, max_broadcast: int = 200_000,
                  **find) -> DataFrame:
    """``doc_id, th, n_words, n_hit, n_items, items, contaminated`` of every row.

    ``n_hit`` counts the words inside any match, ``items`` lists the ids (as
    strings, sorted) of the items with a match.
    """
    found, window_items = find_phrases(docs, items, length, max_broadcast=max_broadcast, **find)
    per_doc = materialise(found.select(
        "doc_id", "th", "n_words",
        F.expr("cast(size(array_distinct(flatten(transform(matches, m -> sequence(m.start, m.start + m.len - 1))))) "
               "as bigint)").alias("n_hit"),
        F.expr("array_distinct(matches.wid)").alias("wids")), "hits")
    named = (per_doc.select("doc_id", "th", F.explode("wids").alias("wid")).distinct()
             .join(small(window_items, max_broadcast), "wid")
             .groupBy("doc_id", "th").agg(F.sort_array(F.collect_set("item")).alias("items")))
    return (per_doc.alias("d").join(named.alias("n"), F.expr("d.doc_id <=> n.doc_id and d.th = n.th"), "left")
            .select("d.doc_id", "d.th", "n_words", "n_hit",
                    F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                    (F.col("n_hit") > 0).alias("contaminated")))
