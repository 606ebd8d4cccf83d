"""Benchmark decontamination with a distributed positional inverted index.

The words of every training text are stored with their positions (one row
per text, positions being places in the array): the index is partitioned by
document, so building it moves nothing.  For the benchmark, every window of
ten words is looked up from its rarest terms: corpus counts of the benchmark
terms pick the two rarest words of each window; the postings of the rarest
(document, position) are joined to the windows and shifted by the word's
offset.  All lists of a document lie in its row, so the intersection with
the second-rarest word, then with the rest, happens there without moving
postings.  A window that is met in full is an exact phrase; one whose two
rarest words stand within a few words of their places is a proximity match.
DataFrame functions only.

The benchmark is the fixed, small side: its terms and windows are broadcast
only after counting them (``MAX_TERMS``, ``MAX_WINDOWS``).  Beyond that only
postings are shuffled, never with the words of their text: those of the
rarest words carry a 64-bit mask of the words around them, are joined to the
windows by term (adaptive execution splits hot terms), and what passes the
mask is looked up in its document, whose words move once.

Defined results: words are maximal runs of ``WORD`` after A-Z become a-z; a
NULL or empty text has no words and is clean; an item without words has no
window; an item of fewer than ten words is one window; a window that stands
in several items counts for each; rows with equal id and text get equal
results; a NULL item id counts as the empty id; an empty benchmark leaves
all texts clean; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import row_key, written

WORD = r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"
WINDOW = 10
#: Words by which the two rarest words of a window may be out of place in a proximity match.
SLOP = 5
#: Up to so many benchmark terms or windows are broadcast (tens of MB at most).
MAX_TERMS, MAX_WINDOWS = 1_000_000, 200_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str) -> Column:
    """Array of the words of a text; only A-Z change case.  ``lower`` is the
    faster way for texts of ASCII alone, where it means the same."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    low = F.when(F.octet_length(t) == F.char_length(t), F.lower(t)).otherwise(F.translate(t, _UPPER, _LOWER))
    return F.regexp_extract_all(low, F.lit(WORD), F.lit(1))


def index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored index: (key, doc_id, n_words, words)."""
    d = docs.select(row_key(doc_id, text).alias("key"), F.col(doc_id).alias("doc_id"), words(text).alias("words"))
    return written(d.select("key", "doc_id", F.size("words").cast("long").alias("n_words"), "words"), "token-index")


def windows(bench: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item, win): each window of each item, once."""
    b = bench.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), words(text).alias("w")) \
        .where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - WINDOW, F.lit(0)))
    return b.select("item", "w", F.explode(starts).alias("s")) \
        .select("item", F.slice("w", F.col("s") + 1, F.lit(WINDOW)).alias("win")).distinct()


def matches(store: DataFrame, wins: DataFrame, slop: int = SLOP) -> DataFrame:
    """(key, win, start, kind): ``phrase`` for every occurrence of a window,
    ``proximity`` where its two rarest words stand within ``slop`` words of
    their places without being a phrase."""
    win = written(wins.select("win").distinct().withColumn("w", F.xxhash64("win")), "windows")
    n_win = win.count()
    terms = win.select(F.explode("win").alias("term")).distinct()
    each = store.select(F.explode("words").alias("term"))
    if n_win * WINDOW <= MAX_TERMS:
        counts = each.join(F.broadcast(terms), "term").groupBy("term").agg(F.count("*").alias("n"))
    else:  # counted first: one row a term is joined
        counts = each.groupBy("term").agg(F.count("*").alias("n")).join(terms, "term")
    counts = written(counts, "term-counts")
    places = win.select("w", F.posexplode("win").alias("o", "term")).join(counts, "term", "left") \
        .groupBy("w").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term", "o")))
                          .alias("p"))  # at most ten
    plan = win.join(places, "w").where(F.col("p")[0]["n"] > 0) \
        .select("w", "win", F.col("p")[0]["term"].alias("t1"), F.col("p")[0]["o"].alias("o1"),
                F.get("p", F.lit(1))["term"].alias("t2"), F.get("p", F.lit(1))["o"].alias("o2"))
    plan = written(plan, "window-plan")
    if n_win > MAX_WINDOWS:
        return _shuffled_matches(store, plan, slop)
    # Postings of the rarest words, shifted to window starts.  A document's lists are all in
    # its own row, so they are intersected there: the second-rarest word at its place (or
    # near it), then the whole window.
    start = F.col("pos") - F.col("o1")
    phrase = F.slice("words", start + 1, F.size("win")) == F.col("win")
    return store.select("key", "words", F.posexplode("words").alias("pos", "term")) \
        .join(F.broadcast(plan), F.col("term") == F.col("t1")) \
        .where(start >= 0) \
        .select("key", "win", start.alias("start"), _kind(start, phrase, slop).alias("kind")) \
        .where("kind IS NOT NULL").distinct()


def _kind(start: Column, whole: Column, slop: int) -> Column:
    place2 = start + F.col("o2")
    low = F.greatest(place2 - slop, F.lit(0))
    phrase = (F.col("t2").isNull() | (F.get("words", place2) == F.col("t2"))) & whole
    near = F.array_contains(F.slice("words", low + 1, place2 + slop - low + 1), F.col("t2"))
    return F.when(phrase, "phrase").when(near, "proximity")


def _bit(word: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(word), F.lit(64)).cast("int"))


def postings(store: DataFrame, plan: DataFrame, slop: int = SLOP) -> DataFrame:
    """(key, pos, term, mask): postings of the rarest words of the windows; the mask has a bit
    of each word that stands where another word of a window can be."""
    terms = written(plan.select(F.col("t1").alias("term")).distinct(), "rarest-terms")
    reach = WINDOW - 1 + slop
    # masks of a document by doubling, one step a projection; no row of a posting has the words
    d = store.select("key", "words", F.concat(F.array_repeat(F.lit(0).cast("long"), reach), F.transform("words", _bit)).alias("m"))
    size = 1
    while size < 2 * reach + 1:
        step = min(size, 2 * reach + 1 - size)
        d = d.select("key", "words", F.zip_with("m", F.slice("m", F.lit(step + 1), F.greatest(F.size("m") - step, F.lit(0))),
                                                lambda x, y: x.bitwiseOR(F.coalesce(y, F.lit(0).cast("long")))).alias("m"))
        size += step
    d = d.select("key", F.posexplode(F.arrays_zip("words", F.slice("m", F.lit(1), F.size("words")).alias("m"))).alias("pos", "x")) \
        .select("key", "pos", F.col("x.words").alias("term"), F.col("x.m").alias("mask"))
    return d.join(F.broadcast(terms), "term", "left_semi").select("key", "pos", "term", "mask") if terms.count() <= MAX_TERMS else d


def _shuffled_matches(store: DataFrame, plan: DataFrame, slop: int) -> DataFrame:
    """:func:`matches` for more windows than are broadcast."""
    slim = plan.select("w", F.size("win").alias("n"), "t1", "o1", "t2", "o2", F.when(F.col("t2").isNull(), F.lit(0)).otherwise(_bit(F.col("t2"))).cast("long").alias("bit"))
    found = postings(store, plan, slop).join(slim, F.col("term") == F.col("t1")) \
        .where("pos >= o1 AND (mask & bit) = bit") \
        .select("key", "w", (F.col("pos") - F.col("o1")).alias("start"), "n", "t2", "o2").distinct()
    found = written(found, "window-candidates")
    # repeated rows share a key and their words
    texts = store.join(found.select("key").distinct(), "key", "left_semi").groupBy("key").agg(F.first("words").alias("words"))
    whole = F.xxhash64(F.slice("words", F.col("start") + 1, F.col("n"))) == F.col("w")
    kinds = found.join(texts, "key").select("key", "w", "start", _kind(F.col("start"), whole, slop).alias("kind")) \
        .where("kind IS NOT NULL")
    return kinds.join(plan.select("w", "win"), "w").select("key", "win", "start", "kind")


def decontaminate(docs: DataFrame, bench: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", slop: int = SLOP) -> DataFrame:
    """Per document: doc_id, n_words, n_hit (words inside an occurrence of a
    window), n_items, items_sha256, contaminated, n_near (items with proximity
    matches only), and ``key`` (:func:`kerbside.llm.common.row_key`)."""
    store = index(docs, doc_id, text)
    wins = written(windows(bench, item_id, item_text), "benchmark-windows")
    m = written(matches(store, wins, slop), "matches")
    exact = m.where("kind = 'phrase'")
    hit = exact.select("key", F.explode(F.sequence(F.col("start"), F.col("start") + F.size("win") - 1)).alias("pos")) \
        .distinct().groupBy("key").agg(F.count("*").alias("n_hit"))
    by = m.join(wins, "win").groupBy("key", "item").agg(F.max((F.col("kind") == "phrase").cast("int")).alias("exact"))
    items = by.groupBy("key").agg(
        F.array_sort(F.collect_set(F.when(F.col("exact") == 1, F.col("item")))).alias("items"),
        F.sum(1 - F.col("exact")).alias("n_near"))  # a set of item ids: at most the benchmark's
    per = items.join(hit, "key", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return store.select("key", "doc_id", "n_words").join(per, "key", "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"),
        F.when(F.col("items").isNull(), F.lit(0)).otherwise(F.size("items")).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "key")


def drop_contaminated(docs: DataFrame, bench: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` (all columns as they are) without the contaminated ones."""
    bad = decontaminate(docs, bench, doc_id, text).where("contaminated").select(F.col("key").alias("__bad_key")).distinct()
    return docs.join(bad, row_key(doc_id, text) == F.col("__bad_key"), "left_anti")
