"""Toxicity scores from a learnt lexicon, misspellings included.

A trie holds toxic words and stems learnt from labelled documents. Every word of
a text is matched by running its Levenshtein automaton against the trie. Hits
count by the window they stand in: inside quotation marks they are kept apart
from the others, and close company of other hits is a feature of its own.
"""

from __future__ import annotations

import math
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.session import released, scratch, stored
from tidemark.llm.text import free_name, sized

#: Letters up to which every word's prefixes may become stems; longer stems come from words that share so many.
HEAD_LETTERS = 24
#: Letters of the shortest stem, words that must share one, and letters of the shortest word matched with an edit.
STEM_LETTERS, STEM_WORDS, FUZZY_LETTERS = 4, 5, 5
#: Share of its contexts that an entry must have in toxic documents.
LEAST_RATE = 0.6
#: An entry is matched with an edit only if clean contexts of such near words are at most this share of its toxic ones.
CLEAN_SHARE = 0.05
#: Words on either side of a hit that its window holds.
WINDOW = 5
#: Words whose matches a Python worker keeps; bounds memory, never changes scores.
CACHE_WORDS = 400_000
#: Pairs of a word and a stem up to which the stems' words are sent to the texts' words by broadcast; more are joined by shuffle.
BROADCAST_STEMMED = 200_000
#: Words with such a stem up to which they are named in a filter on the texts.
NAMED_STEMMED = 1_000
#: Quotation marks (fixed values).
OPENING, CLOSING = frozenset("\"'“”„«»‘‚‹"), frozenset("\"'“”»«’‘›")

_WORD = re.compile(r"[^\W_]+")
_JAVA_WORD = "[\\p{L}\\p{N}]+"


class LevenshteinAutomaton:
    """Nondeterministic automaton of the strings within ``edits`` of a word; a state is a set of (letters read, edits made)."""

    def __init__(self, word: str, edits: int = 1):
        self.word, self.edits = word, edits

    def start(self) -> frozenset:
        return self._skips({(0, 0)})

    def _skips(self, states: set) -> frozenset:
        """With the states that leaving out letters of the word leads to."""
        out = set(states)
        for at, made in states:
            out.update((at + n, made + n) for n in range(1, self.edits - made + 1) if at + n <= len(self.word))
        return frozenset(out)

    def step(self, states: frozenset, letter: str) -> frozenset:
        out = set()
        for at, made in states:
            if at < len(self.word) and self.word[at] == letter:
                out.add((at + 1, made))
            if made < self.edits:
                out.add((at, made + 1))
                if at < len(self.word):
                    out.add((at + 1, made + 1))
        return self._skips(out) if out else frozenset()

    def accepted(self, states: frozenset) -> int | None:
        """Fewest edits with the whole word read."""
        return min((made for at, made in states if at == len(self.word)), default=None)

    def reached(self, states: frozenset) -> int | None:
        """Fewest edits, whatever part of the word is read."""
        return min((made for _, made in states), default=None)


class Trie:
    """Words and stems; a stem stands for every word that begins with it."""

    def __init__(self, words: list[str], stems: list[str], exact: frozenset[str] = frozenset()):
        self.root: dict = {}
        self.exact = exact  # entries that match only as they are
        for entries, mark in ((words, "word"), (stems, "stem")):
            for entry in entries:
                node = self.root
                for letter in entry:
                    node = node.setdefault(letter, {})
                node[mark] = entry
        # With one edit, one half of an entry stays whole: at the word's start, or at its end, or for a stem near its place.
        self.words, self.stems = frozenset(words), tuple(stems)
        loose = [e for e in words if len(e) >= FUZZY_LETTERS and e not in exact]
        self.by_size = {
            n: (tuple(e[:len(e) // 2] for e in loose if abs(len(e) - n) < 2), tuple(e[len(e) // 2:] for e in loose if abs(len(e) - n) < 2))
            for n in {len(e) + by for e in loose for by in (-1, 0, 1)}}
        loose = [s for s in stems if len(s) >= FUZZY_LETTERS and s not in exact]
        self.heads = tuple(s[:len(s) // 2] for s in loose)
        places = {len(s) // 2 + by for s in loose for by in (-1, 0, 1)}
        self.inner = [(tuple(s[len(s) // 2:] for s in loose if abs(len(s) // 2 - at) < 2), at) for at in sorted(places)]

    def likely(self, word: str) -> bool:
        """False only for words without an entry within one edit."""
        if word in self.words or word.startswith(self.stems):
            return True
        heads, tails = self.by_size.get(len(word), ((), ()))
        return (word.startswith(heads) or word.endswith(tails) or word.startswith(self.heads)
                or any(word.startswith(tails, at) for tails, at in self.inner))

    def match(self, word: str, edits: int = 1) -> tuple[str, int] | None:
        """The entry nearest to ``word`` and the edits between them, or None. Short entries match only as they are."""
        if not self.likely(word):
            return None
        automaton = LevenshteinAutomaton(word, edits)
        best: tuple[int, str] | None = None
        todo = [(self.root, automaton.start())]
        while todo:
            node, states = todo.pop()
            for mark, far in (("word", automaton.accepted(states)), ("stem", automaton.reached(states))):
                entry = node.get(mark)
                if entry is not None and far is not None and (far == 0 or len(entry) >= FUZZY_LETTERS and entry not in self.exact):
                    best = min(best or (far, entry), (far, entry))
            todo += [(child, after) for letter, child in node.items() if len(letter) == 1 and (after := automaton.step(states, letter))]
        return (best[1], best[0]) if best else None


@dataclass
class Model:
    """What scoring needs; small enough to travel with each task."""

    words: dict[str, float]  # with the weight of evidence of each
    stems: dict[str, float]
    clean: frozenset[str]  # words of clean documents that an edit leads to; never a misspelling
    exact: frozenset[str] = frozenset()  # entries that too many clean words are an edit away from
    weights: list[float] = field(default_factory=list)

    def __post_init__(self):
        self.trie, self.cache = Trie(list(self.words), list(self.stems), self.exact), {}

    def __reduce__(self):
        return Model, (self.words, self.stems, self.clean, self.exact, self.weights)

    def hit(self, chunk: str) -> tuple[float, int]:
        """Evidence of the weightiest lexicon word in a chunk, and the edits to it; (0, 0) without a hit."""
        if len(self.cache) > CACHE_WORDS:
            self.cache = {}
        found = (0.0, 0)
        for word in _WORD.findall(chunk.lower()):
            near = self.trie.match(word)
            if near and (near[1] == 0 or word not in self.clean):
                found = max(found, (self.words.get(near[0]) or self.stems[near[0]], near[1]))
        self.cache[chunk] = found
        return found

    def features(self, text: str | None) -> tuple[float, ...]:
        chunks = (text or "").split()
        known, hit = self.cache.get, self.hit
        hits = [(i, h) for i, c in enumerate(chunks) if (h := known(c) or hit(c))[0]]
        plain = misspelt = quoted = closest = 0.0
        near: deque[tuple[int, float]] = deque()
        for i, (weight, edits) in hits:
            while near and near[0][0] < i - 2 * WINDOW:
                near.popleft()
            near.append((i, weight))
            if _in_quotes(chunks, i):
                quoted += weight
                continue
            closest = max(closest, sum(w for _, w in near) - weight)
            if edits:
                misspelt += weight
            else:
                plain += weight
        total = plain + misspelt + quoted
        return (math.log1p(plain), math.log1p(misspelt), math.log1p(quoted), math.log1p(closest), math.log1p(100 * total / max(len(chunks), 1)))

    def score(self, text: str | None) -> float:
        return float(1 / (1 + math.exp(-max(-30.0, min(30.0, self.weights[0] + sum(w * x for w, x in zip(self.weights[1:], self.features(text), strict=True)))))))


def _in_quotes(chunks: list[str], i: int) -> bool:
    """Whether a quotation opens at or before a word and closes at or after it, inside the word's window."""
    opens = next((c for c in reversed(chunks[max(0, i - WINDOW):i + 1]) if c[0] in OPENING or c.rstrip(".,;:!?")[-1:] in CLOSING), "")
    closes = next((c for c in chunks[i:i + WINDOW + 1] if c.rstrip(".,;:!?")[-1:] in CLOSING or c[0] in OPENING), "")
    return bool(opens and closes and opens[0] in OPENING and closes.rstrip(".,;:!?")[-1:] in CLOSING)


def _significance(toxic: Column, clean: Column, share: float) -> Column:
    """Chernoff exponent of so many toxic contexts at the usual ``share``; 0 below it."""
    rate = toxic / (toxic + clean)
    bits = rate * F.log(rate / F.lit(share)) + F.when(rate < 1, (1 - rate) * F.log((1 - rate) / F.lit(1 - share))).otherwise(0.0)
    return F.when(rate > share, (toxic + clean) * bits).otherwise(0.0)


def _evidence(used: DataFrame) -> DataFrame:
    """(word, bad, good): different contexts in toxic documents only, and in clean ones; one of each document.

    The least of a struct is found by sorting, so rows leave a task ordered by word and pack better.
    """
    return used.groupBy("word", "near").agg(F.min(F.struct("toxic"))["toxic"].alias("toxic")).groupBy("word").agg(
        F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))


def _worded(docs: DataFrame) -> DataFrame:
    """``docs`` with the array ``w`` of its words in place of the text."""
    return docs.withColumn("w", F.regexp_extract_all(F.lower("text"), F.lit(_JAVA_WORD), 0)).drop("text")


def _places() -> Column:
    """(word, near) of every word in ``w``; ``near`` stands for its neighbours."""
    return F.transform("w", lambda word, i: F.struct(
        word.alias("word"), F.xxhash64(F.get("w", i - 1), F.get("w", i + 1)).alias("near")))


def _used(known: DataFrame) -> DataFrame:
    """(word, near, toxic): every word of a doc_id once, with its least context. A text's own words are sorted
    where they are; only a doc_id with several texts (``texts``) is grouped across rows."""
    first = F.filter("places", lambda place, i: (i == 0) | (place["word"] != F.get("places", i - 1)["word"]))
    least = lambda df: _worded(df).withColumn("places", F.sort_array(_places())).select("doc_id", "toxic", F.explode(first).alias("x"))
    several = least(known.where("texts > 1")).groupBy("x.word", "doc_id", "toxic").agg(F.min("x.near").alias("near"))
    return least(known.where("texts = 1")).select("x.word", "x.near", "toxic").unionByName(several.select("word", "near", "toxic"))


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from all labelled documents (``toxic`` 0 or 1; null labels are left out).

    Evidence for a word is the number of different pairs of neighbours it has in toxic and in clean
    documents, one of each document, so that neither copies of one document nor one long document add up. Without both kinds of label the lexicon is
    empty and every text scores the share of toxic labels.
    """
    with scratch(docs.sparkSession), released(docs.sparkSession):
        return _learn(docs, labels)


def _learn(docs: DataFrame, labels: DataFrame) -> Model:
    given = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(given, "doc_id")
    known = stored(known.withColumn("texts", F.count(F.lit(1)).over(Window.partitionBy("doc_id"))))
    count = known.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    if not count[0] or not count[1] or count[0] == count[1]:
        share = (count[1] or 0) / count[0] if count[0] else 0.0
        prior = math.log((share + 0.001) / (1.001 - share))
        return Model({}, {}, frozenset(), frozenset(), [prior, 0.0, 0.0, 0.0, 0.0, 0.0])

    terms = stored(_evidence(_used(known)))
    totals = terms.agg(F.sum("bad"), F.sum("good"), F.count(F.lit(1))).first()
    share, least = totals[0] / (totals[0] + totals[1]), math.log(totals[2]) + 5
    strong = lambda df: df.withColumn("worth", _significance(F.col("bad"), F.col("good"), share)).where(
        (F.col("worth") >= least) & (F.col("bad") >= LEAST_RATE * (F.col("bad") + F.col("good"))))
    # A stem beyond HEAD_LETTERS needs words that share so many; other words have their shorter prefixes only.
    head = F.substring("word", 1, HEAD_LETTERS)
    heads = stored(terms.where(F.length("word") > HEAD_LETTERS + 1).groupBy(head.alias("head")).agg(F.count(F.lit(1)).alias("n"))
                   .where(F.col("n") >= STEM_WORDS).select("head", F.lit(True).alias("deep")))
    most = F.when(F.col("deep"), F.length("word") - 1).otherwise(F.least(F.length("word") - 1, F.lit(HEAD_LETTERS)))
    prefixes = F.explode(F.transform(F.sequence(F.lit(STEM_LETTERS), most), lambda n: F.substring("word", F.lit(1), n)))
    stemmed = terms.where(F.length("word") > STEM_LETTERS).join(heads, head == F.col("head"), "left")
    maybe = stored(strong(stemmed.select("bad", "good", prefixes.alias("word")).groupBy("word").agg(
        F.sum("bad").alias("bad"), F.sum("good").alias("good"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= STEM_WORDS)).select(F.col("word").alias("stem")))
    # Only words that have such a stem meet the texts again, so no text's words are multiplied by their prefixes.
    under = stored(stemmed.select("word", prefixes.alias("stem")).join(sized(maybe, BROADCAST_STEMMED), "stem"))
    few = [r.word for r in under.select("word").distinct().limit(NAMED_STEMMED + 1).collect()]
    texts = _worded(known)
    if len(few) <= NAMED_STEMMED:  # texts without any of them are passed over quickly
        texts = texts.where(F.exists("w", lambda word: word.isin(few)))
    stems = _evidence(texts.select("doc_id", "toxic", F.explode(_places()).alias("x")).select("doc_id", "toxic", "x.word", "x.near").join(
        sized(under, BROADCAST_STEMMED), "word").groupBy(F.col("stem").alias("word"), "doc_id", "toxic").agg(F.min("near").alias("near")))
    kept = lambda df: {r.word: (r.bad, r.good) for r in strong(df).collect()}
    picked, families = kept(terms), kept(stems)
    # The shortest stem stands for its longer ones, and for the words under it.
    short = {s for s in families if not any(s[:n] in families for n in range(STEM_LETTERS, len(s)))}
    lone = {w for w in picked if not any(w[:n] in short for n in range(STEM_LETTERS, len(w) + 1))}
    odds = math.log(share / (1 - share))
    worth = lambda counts: math.log((counts[0] + 0.5) / (counts[1] + 0.5)) - odds
    model = Model({w: worth(picked[w]) for w in sorted(lone)}, {s: worth(families[s]) for s in sorted(short)}, frozenset())

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [(w, m[0], g) for w, g in zip(batch["word"].to_pylist(), batch["good"].to_pylist(), strict=True) if (m := model.trie.match(w)) and m[1] > 0]
            columns = zip(*near) if near else [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.string(), pa.int64()))], names=["word", "entry", "good"])

    close = stored(terms.where("good > 0").select("word", F.col("good").cast("long").alias("good")).mapInArrow(alike, "word string, entry string, good long"))
    entries = picked | families
    common = {r.entry for r in close.groupBy("entry").agg(F.sum("good").alias("good")).collect() if r.good > CLEAN_SHARE * entries[r.entry][0]}
    clean = {r.word for r in close.where(~F.col("entry").isin(sorted(common))).select("word").collect()}
    model = Model(model.words, model.stems, frozenset(clean), frozenset(common))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [list(model.features(t)) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["toxic"], pa.array(rows, pa.list_(pa.float64()))], names=["toxic", "x"])

    seen = known.select(F.col("toxic").cast("int").alias("toxic"), "text").mapInArrow(measured, "toxic int, x array<double>")
    return Model(model.words, model.stems, model.clean, model.exact, fit_weights(stored(seen.groupBy("toxic", "x").agg(F.count(F.lit(1)).alias("n")))))


def fit_weights(seen: DataFrame, size: int = 6, penalty: float = 0.5) -> list[float]:
    """Logistic regression by Newton's method on (toxic, x, n), ``n`` documents with features ``x``; a misspelling is taken to weigh as
    much as a word unless the data disagree. Tasks add up their rows' share of each step; only the sums reach the driver."""
    w, pull = np.zeros(size), penalty * np.eye(size)
    pull[0, 0] = 1e-3
    pull[2, 2] += 4 * penalty
    pull[1, 1] += 4 * penalty
    pull[1, 2] = pull[2, 1] = -4 * penalty

    def sums(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bend, slope = np.zeros((size, size)), np.zeros(size)
            for batch in batches:
                if batch.num_rows:
                    x = np.column_stack([np.ones(batch.num_rows), np.array(batch["x"].to_pylist())])
                    y, n = (np.array(batch[c].to_pylist(), float) for c in ("toxic", "n"))
                    p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
                    bend += (x * (n * p * (1 - p))[:, None]).T @ x
                    slope += x.T @ (n * (y - p))
            yield pa.RecordBatch.from_arrays([pa.array([[*bend.ravel(), *slope]], pa.list_(pa.float64()))], names=["s"])

        total = np.array(seen.mapInArrow(added, "s array<double>").agg(*(F.sum(F.get("s", F.lit(i))) for i in range(size * (size + 1)))).first(), float)
        return total[:size * size].reshape(size, size), total[size * size:]

    for _ in range(50):
        bend, slope = sums(w)
        step = np.linalg.solve(bend + pull, slope - pull @ w)
        w = w + step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def scored(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 in the column ``name``. Only the text decides; null texts score as empty ones.

    Every row and column stays, whatever its name, but for one named ``name``, which is replaced. Repeated rows
    score each. A very long text is read as a whole in one task.
    """
    kept = docs.drop(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array([model.score(t) for t in batch.columns[-1].to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], scores], names=[*batch.schema.names[:-1], name])

    schema = kept.withColumn(name, F.lit(0.0)).schema
    return kept.withColumn(free_name("body", kept), F.col("text").cast("string")).mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Whether a document's label may not be learnt from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1
