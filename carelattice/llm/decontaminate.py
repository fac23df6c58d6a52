"""Benchmark decontamination over a distributed positional inverted index.

Benchmark items are cut into windows of consecutive words. The corpus frequency
of every benchmark term tells which terms of a window are rarest; postings
(document, position, words around) are stored for those terms alone. A phrase is
looked up by intersecting the offset-adjusted posting lists of its rarest terms,
and survivors are compared word by word. Everything is DataFrame code.

The corpus is never shuffled: the benchmark's side of each join is broadcast in
blocks of a fixed number of windows, one pass over the corpus per block.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelattice.llm.common import BROADCAST_ROWS, written

# A-Z are lower-cased; a word is a run without these characters.
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

WINDOW = 13
# Posting lists intersected per window.
RAREST = 2
# Windows per block: with 13 words of some 10 bytes and their places, about 60 MB at most.
BLOCK_WINDOWS = BROADCAST_ROWS


def words_of(text: Column) -> Column:
    """The words of a text, in order; none for NULL."""
    lowered = F.translate(text, _UPPER, _UPPER.lower())
    return F.coalesce(F.array_remove(F.split(lowered, _SEPARATORS), ""), F.array().cast("array<string>"))


def windows_of(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
               size: int = WINDOW, unnamed: bool = False) -> DataFrame:
    """(item_id, phrase): the word windows of each item; a shorter item is one window.

    Items without a word have none; items with a NULL id have some if ``unnamed``.
    """
    cut = items.select(F.col(id_col).alias("item_id"), words_of(F.col(text_col)).alias("w")).where(
        (F.lit(unnamed) | F.col("item_id").isNotNull()) & (F.size("w") > 0))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (size - 1), F.lit(1)))
    return (
        cut.select("item_id", "w", F.explode(starts).alias("at"))
        .select("item_id", F.slice("w", F.col("at"), size).alias("phrase")).distinct()
    )


def _corpus(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows with their words; ``text_key`` tells apart rows that share an id."""
    return docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("text_key"),
        words_of(F.col(text_col).cast("string")).alias("words"))


def term_counts(corpus: DataFrame, phrases: DataFrame) -> DataFrame:
    """(term, n): how often each term of the phrases occurs in the corpus."""
    terms = phrases.select(F.explode("phrase").alias("term")).distinct()
    found = corpus.select(F.explode("words").alias("term")).join(F.broadcast(terms), "term")
    counts = found.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return terms.join(counts, "term", "left").select("term", F.coalesce("n", F.lit(0)).alias("n"))


def rarest_terms(phrases: DataFrame, counts: DataFrame, rarest: int = RAREST) -> DataFrame:
    """(phrase, term, offset, lists): the rarest terms of each phrase and their places in it."""
    placed = phrases.select("phrase", F.posexplode("phrase").alias("offset", "term")).join(counts, "term")
    rank = F.row_number().over(Window.partitionBy("phrase").orderBy("n", "offset"))
    return placed.withColumn("rank", rank).where(F.col("rank") <= rarest).select(
        "phrase", "term", "offset", "rank",
        F.least(F.lit(rarest), F.size("phrase")).alias("lists"))


def postings(corpus: DataFrame, terms: DataFrame, reach: int = WINDOW) -> DataFrame:
    """The positional index of ``terms``: one row per occurrence with the words around it.

    ``around`` starts ``back`` words before the occurrence.
    """
    found = corpus.select("doc_id", "text_key", "words", F.posexplode("words").alias("pos", "term")).join(
        F.broadcast(terms.select("term").distinct()), "term")
    back = F.least(F.col("pos"), F.lit(reach - 1))
    return found.select(
        "term", "doc_id", "text_key", "pos", back.alias("back"),
        F.slice("words", F.col("pos") - back + 1, back + reach).alias("around"))


def _placed(index: DataFrame, chosen: DataFrame) -> DataFrame:
    """Offset-adjusted posting lists: where a phrase would start, by each of its terms."""
    return index.join(F.broadcast(chosen), "term").withColumn("start", F.col("pos") - F.col("offset"))


def exact_matches(index: DataFrame, chosen: DataFrame) -> DataFrame:
    """(doc_id, text_key, start, phrase) of every place where a phrase stands word by word.

    A place is in all posting lists of the phrase's rarest terms once these are
    shifted by their offsets. List entries without the rarest term at its place, or
    with other words than the phrase around them, are dropped before lists meet.
    """
    lead = chosen.where("rank = 1").select(
        "phrase", F.col("term").alias("lead"), F.col("offset").alias("lead_offset"))
    lists = chosen.join(F.broadcast(lead), "phrase")
    at = F.col("back") - F.col("offset")
    placed = (
        _placed(index, lists)
        .where("start >= 0")
        .where(F.get("around", at + F.col("lead_offset")) == F.col("lead"))
        .where(F.slice("around", F.greatest(at + 1, F.lit(1)), F.size("phrase")) == F.col("phrase"))
    )
    return (
        placed.groupBy("doc_id", "text_key", "start", "phrase")
        .agg(F.count_distinct("rank").alias("met"), F.max("lists").alias("lists"))
        .where("met = lists").select("doc_id", "text_key", "start", "phrase")
    )


def near_matches(index: DataFrame, chosen: DataFrame, slop: int = 5) -> DataFrame:
    """(doc_id, text_key, phrase, start): places where all rarest terms of a phrase stand
    at most ``slop`` words out of their mutual order. ``start`` is by the rarest term.

    Starts are put in cells of ``slop + 1`` words and each is also filed under the
    neighbouring cells, so lists meet by equality only.
    """
    placed = _placed(index, chosen).select("doc_id", "text_key", "phrase", "start", "rank", "lists").distinct()
    cell = F.floor(F.col("start") / (slop + 1))
    lead = placed.where("rank = 1").select("doc_id", "text_key", "phrase", F.col("start").alias("at"), "lists",
                                           cell.alias("cell"))
    rest = placed.where("rank > 1").withColumn("cell", F.explode(F.array(cell - 1, cell, cell + 1))).select(
        "doc_id", "text_key", "phrase", "rank", "start", "cell")
    met = lead.join(rest, ["doc_id", "text_key", "phrase", "cell"], "left").where(
        F.col("rank").isNull() | (F.abs(F.col("start") - F.col("at")) <= slop))
    return (
        met.groupBy("doc_id", "text_key", "phrase", "at")
        .agg(F.count_distinct("rank").alias("n"), F.max("lists").alias("lists"))
        .where("n = lists - 1").select("doc_id", "text_key", "phrase", F.col("at").alias("start"))
    )


def _coverage(places: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_hit): words inside at least one place."""
    spans = places.select("doc_id", "text_key", "start", (F.col("start") + F.size("phrase")).alias("end")).groupBy(
        "doc_id", "text_key", "start").agg(F.max("end").alias("end"))
    before = Window.partitionBy("doc_id", "text_key").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0)))
    return spans.withColumn("fresh", F.greatest(fresh, F.lit(0))).groupBy("doc_id", "text_key").agg(
        F.sum("fresh").alias("n_hit"))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  size: int = WINDOW, share: int = 20, block: int = BLOCK_WINDOWS,
                  unnamed: bool = False) -> DataFrame:
    """Per row of ``docs``: id, n_words, n_hit, item_ids, contaminated.

    ``n_hit`` counts words inside an occurrence of a window, ``item_ids`` lists the
    items with occurring windows as sorted strings, and a row is contaminated when
    at least one word in ``share`` is hit. NULL and empty texts have no words. With
    ``unnamed`` passages of items with a NULL id are hit too, and named nowhere.
    Rows that repeat an id with another text are judged apart; equal rows get equal
    results. Other columns are ignored; an empty corpus gives no row, an empty
    benchmark no hit.
    """
    corpus = _corpus(docs, id_col, text_col)
    windows = written(windows_of(items, size=size, unnamed=unnamed), "bench-windows")
    phrases = windows.select("phrase").distinct()
    blocks = max(1, -(-phrases.count() // block))
    places, found = [], []
    for i in range(blocks):
        part = phrases if blocks == 1 else phrases.where(F.pmod(F.xxhash64("phrase"), F.lit(blocks)) == i)
        counts = written(term_counts(corpus, part), "term-counts")
        chosen = written(rarest_terms(part, counts), "rarest-terms")
        index = written(postings(corpus, chosen, size), "postings")
        here = written(exact_matches(index, chosen), "matches")
        places.append(here)
        own = windows if blocks == 1 else windows.join(F.broadcast(part), "phrase", "left_semi")
        found.append(here.select("doc_id", "text_key", "phrase").distinct().join(own, "phrase").select(
            "doc_id", "text_key", "item_id"))
    hits = _coverage(reduce(DataFrame.unionByName, places))
    listed = reduce(DataFrame.unionByName, found).groupBy("doc_id", "text_key").agg(
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    marks = hits.join(listed, hits.doc_id.eqNullSafe(listed.doc_id) & (hits.text_key == listed.text_key)).select(
        hits.doc_id.alias("hit_id"), hits.text_key.alias("hit_key"), "n_hit", "item_ids")
    sized = corpus.select("doc_id", "text_key", F.size("words").cast("bigint").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    return sized.join(
        marks, sized.doc_id.eqNullSafe(F.col("hit_id")) & (F.col("text_key") == F.col("hit_key")), "left",
    ).select(
        "doc_id", "text_key", "n_words", n_hit.alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"))
