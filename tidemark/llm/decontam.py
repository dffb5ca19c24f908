"""Benchmark decontamination with a positional inverted index.

The index holds a posting (term, text key, position) for every training token
that a benchmark item uses. Each window of benchmark words is looked up from
its rarest terms: their lists, moved by the term's place in the window, are
intersected first, and only the texts left are read for the other terms.
Everything is DataFrame operations.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.session import stored
from tidemark.llm.text import ascii_lower, free_name, sized, text_key

#: Characters between words (fixed value): everything in ASCII but digits and lower-case letters.
GAPS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: Terms of the benchmark, or places of its windows' rarest terms, that may be broadcast. About 60 MB.
BROADCAST_TERMS = 500_000
#: Texts left after the rarest lists that may be broadcast as keys, 16 bytes each.
BROADCAST_TEXTS = 1_000_000


def _parts(text: Column) -> Column:
    """Words in order; the first and the last element may be empty."""
    return F.split(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), GAPS)


def word_count(text: Column) -> Column:
    """Number of words (null: 0)."""
    parts = F.split(F.coalesce(text.cast("string"), F.lit("")), "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
    return (F.size(parts) - (parts[0] == "").cast("int")
            - ((F.size(parts) > 1) & (F.element_at(parts, -1) == "")).cast("int")).cast("long")


@dataclass
class Windows:
    """Distinct windows of the benchmark."""

    terms: DataFrame  # window, place, term
    items: DataFrame  # window, item_id


def windows(items: DataFrame, width: int = 13) -> Windows:
    """Every run of ``width`` item words; an item of fewer words, but not none, is one window.

    Null and empty texts have none. Repeated items share their windows.
    """
    words = F.filter(_parts(F.col("text")), lambda w: w != "")
    last = F.greatest(F.size("words") - width + 1, F.lit(1))
    runs = items.select("item_id", words.alias("words")).where(F.size("words") > 0).select(
        "item_id", F.explode(F.transform(F.sequence(F.lit(1), last), lambda at: F.slice("words", at, F.lit(width)))).alias("terms"))
    seed = 0
    while True:  # a window's number is a hash of its words; another seed if two windows share one
        numbered = runs.withColumn("window", F.xxhash64(F.lit(seed), F.array_join("terms", " ")))
        count = numbered.agg(F.countDistinct("window"), F.countDistinct("terms")).first()
        if count[0] == count[1]:
            break
        seed += 1
    numbered = stored(numbered)
    terms = numbered.groupBy("window").agg(F.first("terms").alias("terms")).select("window", F.posexplode("terms").alias("place", "term"))
    return Windows(stored(terms), stored(numbered.select("window", "item_id").distinct()))


def index(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(term, key, pos) of every token of ``docs`` whose term is in ``vocabulary``, stored.

    ``key`` stands for the text, so copies of a text have the same postings.
    """
    # Two steps: beside posexplode the key would be computed anew for every token.
    parts = docs.select(text_key(F.col("text")).alias("key"), _parts(F.col("text")).alias("parts"))
    tokens = parts.select("key", F.posexplode("parts").alias("pos", "term"))
    return stored(tokens.join(sized(vocabulary, BROADCAST_TERMS), "term").select("term", "key", "pos"))


def matches(postings: DataFrame, terms: DataFrame, slack: int = 2, lists: int = 2) -> DataFrame:
    """(key, window, start, exact): where windows occur in the indexed texts.

    ``exact`` marks a phrase: every term at its place. Otherwise the match is one of proximity: the
    rarest term fixes the start, and every other term is at most ``slack`` positions from its place.
    ``lists`` rarest terms are intersected over the whole index before any other term is read.
    """
    counts = postings.groupBy("term").count()
    # A term without postings drops its window: it cannot occur.
    ranked = terms.join(counts, "term", "left").withColumns({
        "missing": F.max(F.col("count").isNull()).over(Window.partitionBy("window")),
        "rank": F.row_number().over(Window.partitionBy("window").orderBy("count", "place")),
        "lists": F.least(F.count(F.lit(1)).over(Window.partitionBy("window")), F.lit(lists))}).where(~F.col("missing"))
    ranked = stored(ranked.select("window", "place", "term", "rank", "lists"))
    shifts = F.explode(F.sequence(F.lit(-slack), F.lit(slack)))
    at = (F.col("pos") - F.col("place")).alias("at")
    looked_up = lambda wanted: postings.join(sized(ranked.where(wanted), BROADCAST_TERMS), "term")
    first = stored(looked_up(F.col("rank") == 1).select("key", "window", "lists", at).distinct().withColumnRenamed("at", "start"))
    # The longer lists are combined as they are; only the shortest is spread over the places that may be off.
    others = looked_up((F.col("rank") > 1) & (F.col("rank") <= F.col("lists"))).groupBy("key", "window", at).agg(
        F.bit_or(F.expr("shiftleft(1, rank - 1)")).alias("seen"))
    spread = first.withColumn("at", F.explode(F.sequence(F.col("start") - slack, F.col("start") + slack)))
    met = others.join(spread, ["key", "window", "at"]).groupBy("key", "window", "start").agg(
        F.bit_or("seen").alias("seen"), F.max("lists").alias("lists")).where(F.expr("seen = shiftleft(1, lists) - 2"))
    left = stored(met.select("key", "window", "start").unionByName(first.where("lists = 1").select("key", "window", "start")))

    wanted = left.join(ranked.select("window", "place", "term"), "window").withColumn("off", shifts).select(
        "key", "window", "start", "place", "off", "term", (F.col("start") + F.col("place") + F.col("off")).alias("pos"))
    inside = postings.join(sized(left.select("key").distinct(), BROADCAST_TEXTS), "key", "left_semi")
    found = wanted.join(inside, ["key", "pos", "term"], "left_semi").groupBy("key", "window", "start").agg(
        F.countDistinct("place").alias("near"), F.count(F.when(F.col("off") == 0, True)).alias("exact"))
    sizes = ranked.groupBy("window").agg(F.count(F.lit(1)).alias("size"))
    return found.join(sizes, "window").where(F.col("near") == F.col("size")).select(
        "key", "window", "start", "size", (F.col("exact") == F.col("size")).alias("exact"))


def _by_text(docs: DataFrame, items: DataFrame, width: int, slack: int) -> tuple[DataFrame, DataFrame]:
    """(key, item_ids, n_items, n_near) and (key, n_hit) of the texts with a match."""
    parts = windows(items.select("item_id", "text"), width)
    postings = index(docs, parts.terms.select("term").distinct())
    occurrences = stored(matches(postings, parts.terms, slack))
    exact = occurrences.where("exact")
    hit = exact.select("key", F.explode(F.sequence("start", F.col("start") + F.col("size").cast("int") - 1)).alias("pos")).distinct().groupBy(
        "key").agg(F.count(F.lit(1)).alias("n_hit"))
    by_item = occurrences.join(parts.items, "window").groupBy("key", "item_id").agg(F.max("exact").alias("exact"))
    named = by_item.groupBy("key").agg(
        F.array_sort(F.collect_list(F.when(F.col("exact"), F.col("item_id").cast("string")))).alias("item_ids"),
        F.count(F.when(F.col("exact"), True)).alias("n_items"), F.count(F.when(~F.col("exact"), True)).alias("n_near"))
    return named, hit


def clean(docs: DataFrame, items: DataFrame, width: int = 13, share: int = 20) -> DataFrame:
    """The rows of ``docs`` that ``contamination`` does not call contaminated, with all their columns, whatever their names.

    Null and empty texts stay, repeated rows each; a very long text is cut into words in one task.
    """
    _, hit = _by_text(docs, items, width, 0)
    key, n_hit = free_name("key", docs), free_name("n_hit", docs)
    rows = docs.withColumn(key, text_key(F.col("text"))).join(hit.select(F.col("key").alias(key), F.col("n_hit").alias(n_hit)), key, "left")
    return rows.where(F.col(n_hit).isNull() | (F.col(n_hit) * share < word_count(F.col("text")))).select(*docs.columns)


def contamination(docs: DataFrame, items: DataFrame, width: int = 13, slack: int = 2, share: int = 20) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near, item_ids.

    A word inside an exact occurrence of a window is hit; a document is contaminated if at least one in
    ``share`` of its words is. ``n_near`` counts items with a proximity match and no exact one. Null and
    empty texts have no words and are clean. Repeated rows each keep their result; without documents
    there are no rows, without items every document is clean. Other columns are ignored.
    """
    named, hit = _by_text(docs, items, width, slack)
    rows = docs.select("doc_id", text_key(F.col("text")).alias("key"), word_count(F.col("text")).alias("n_words"))
    full = rows.join(named.join(hit, "key", "left"), "key", "left").withColumns({
        **{c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_hit", "n_items", "n_near")},
        "item_ids": F.coalesce("item_ids", F.array().cast("array<string>"))})
    return full.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))).alias("contaminated"), "n_near", "item_ids")
