"""Runs of periodic words, found on a grammar of the text.

Re-Pair gives a document's word ids a grammar: pairs of neighbours that occur more than
once become rules, the most frequent first. What is left is paired up as a balanced tree, so that
every rule has two parts. A run lies across the boundary of the lowest rule that spans it. So
the runs across each rule's boundary are computed once for the rule, then written at all
places where the derivation uses it, and intervals of the same period that overlap are merged.

All steps are array operations on many documents at once; ids of words are never shared
between documents, so no pair, rule or match crosses from one to the next.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Words worked on at a time; a longer document is worked on alone, as a whole.
CHUNK_WORDS = 300_000
#: Modulus of the prefix hashes; two bases are used. Runs are compared word by word in the end.
PRIME = np.uint64((1 << 31) - 1)

Edit = Callable[[object, list[bytes]], list[bytes]]


def _spans(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``counts`` its number repeated, and 0, 1, ... within it."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


@dataclass
class Grammar:
    """Rules over word ids. Symbols below ``first`` are words; symbol ``first + i`` is rule i."""

    first: int
    left: np.ndarray
    right: np.ndarray
    length: np.ndarray  # words of every symbol, words included
    place: np.ndarray  # where a rule's words occur first
    rounds: list[tuple[int, int]]  # rules made together; parts come from earlier rounds
    roots: np.ndarray  # one symbol per document
    root_at: np.ndarray


class _Rules:
    def __init__(self, n_words: int):
        self.first = self.top = n_words
        self.left, self.right, self.place, self.rounds = [], [], [], []
        self.length = np.ones(n_words, np.int64)

    def add(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Symbols of new rules."""
        made = np.arange(self.top, self.top + len(left))
        self.rounds.append((self.top - self.first, self.top - self.first + len(left)))
        self.top += len(left)
        self.left.append(left)
        self.right.append(right)
        self.place.append(place)
        self.length = np.concatenate([self.length, self.length[left] + self.length[right]])
        return made


def _replace(sym: np.ndarray, at: np.ndarray, take: np.ndarray, made: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sequence with the pairs that start at ``take`` replaced."""
    sym = sym.copy()
    sym[take] = made
    keep = np.ones(len(sym), bool)
    keep[take + 1] = False
    return sym[keep], at[keep]


def repair(ids: np.ndarray, starts: np.ndarray) -> Grammar:
    """Grammar of documents that begin at ``starts``; ids run from 0 and no two documents share any.

    A round replaces every pair that is more frequent than the pairs it overlaps, in all those places
    at once; Re-Pair would take such pairs one after the other, as replacing one leaves the other's
    count as it is. Rounds end when no pair is left twice.
    """
    rules = _Rules(int(ids.max(initial=-1)) + 1)
    sym, at, done = ids.astype(np.int64), np.arange(len(ids)), []
    while len(sym) > 1:
        pairs, back, counts = np.unique(sym[:-1] * rules.top + sym[1:], return_inverse=True, return_counts=True)
        weight = np.where(counts > 1, counts * len(pairs) + np.arange(len(pairs)), 0)[back]
        # Documents without a pair left are finished and leave the array.
        doc = np.searchsorted(starts, at, side="right")
        busy = np.bincount(doc[:-1][weight > 0], minlength=len(starts) + 1) > 0
        if not busy.any():
            break
        if not busy[doc].all():
            rest = busy[doc]
            done.append((sym[~rest], at[~rest]))
            sym, at, doc = sym[rest], at[rest], doc[rest]
            weight = weight[rest[:-1]][:len(sym) - 1]
            weight[doc[:-1] != doc[1:]] = 0  # new neighbours at the seams
        same = weight[1:] == weight[:-1]  # a pair that overlaps itself: every second place counts
        head = np.flatnonzero(np.concatenate([[True], ~same]))
        owner, offset = _spans(np.diff(np.append(head, len(weight))))
        before, after = np.concatenate([[0], weight[:-1]]), np.concatenate([weight[1:], [0]])
        best = (weight > 0) & (offset % 2 == 0) & (before <= weight) & (after <= weight)
        take = np.flatnonzero(best)
        _, first, use = np.unique(sym[take] * rules.top + sym[take + 1], return_index=True, return_inverse=True)
        where = take[first]
        made = rules.add(sym[where], sym[where + 1], at[where])
        sym, at = _replace(sym, at, take, made[use])
    done.append((sym, at))
    sym, at = np.concatenate([s for s, _ in done]), np.concatenate([a for _, a in done])
    order = np.argsort(at)
    sym, at = sym[order], at[order]
    while len(sym) > len(starts):  # a balanced tree over what is left
        doc = np.searchsorted(starts, at, side="right") - 1
        _, offset = _spans(np.bincount(doc, minlength=len(starts)))
        take = np.flatnonzero((offset[:-1] % 2 == 0) & (doc[:-1] == doc[1:]))
        sym, at = _replace(sym, at, take, rules.add(sym[take], sym[take + 1], at[take]))

    def joined(parts):
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    return Grammar(rules.first, joined(rules.left), joined(rules.right), rules.length, joined(rules.place), rules.rounds, sym, at)


class _Hashes:
    """Prefix hashes of the word ids, for the length that two places have in common."""

    def __init__(self, ids: np.ndarray, seed: int):
        random = np.random.default_rng(seed)
        self.sums, self.powers = [], []
        for _ in range(2):
            base = int(random.integers(1 << 20, int(PRIME) - 1))
            powers = np.ones(1, np.uint64)
            while len(powers) <= len(ids):
                powers = np.concatenate([powers, powers * np.uint64(pow(base, len(powers), int(PRIME))) % PRIME])
            letters = random.integers(1, int(PRIME), int(ids.max(initial=0)) + 1).astype(np.uint64)[ids]
            terms = letters * powers[:len(ids)] % PRIME
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms) % PRIME]))
            self.powers.append(powers)

    def equal(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the n words from a and from b (a < b) are the same."""
        good = np.ones(len(a), bool)
        for sums, powers in zip(self.sums, self.powers, strict=True):
            left = (sums[a + n] + PRIME - sums[a]) % PRIME * powers[b - a] % PRIME
            good &= left == (sums[b + n] + PRIME - sums[b]) % PRIME
        return good

    def common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool = False) -> np.ndarray:
        """How many words from a and b on (``back``: before a and b) are the same, at most ``most``."""
        low, high = np.zeros(len(a), np.int64), most.astype(np.int64)
        while (open_ := low < high).any():
            mid = (low + high + 1) // 2
            move = mid if back else 0
            same = self.equal(a - move, b - move, mid)
            low, high = np.where(open_ & same, mid, low), np.where(open_ & ~same, mid - 1, high)
        return low


def _crossing(ids: np.ndarray, g: Grammar, seed: int) -> tuple[np.ndarray, ...]:
    """(rule, start, end, period) of runs of 12 words or more across the boundary of each rule, cut at the rule's ends.

    If words q apart are the same over a run of at least 12 words and two periods, six such matches or
    more follow each other, and four of them lie on one side of the boundary. So the period is the
    distance from four words at the boundary to a place with the same four.
    """
    none = (np.zeros(0, np.int64),) * 4
    a, b = g.place, g.place + g.length[g.first:]
    m = a + g.length[g.left]
    rule = np.flatnonzero(b - a >= 12)
    if not len(rule):
        return none
    two = ids[:-1] * g.first + ids[1:]
    _, two = np.unique(two, return_inverse=True)
    gram = two[:-2] * (int(two.max()) + 1) + two[2:]  # four words
    order = np.argsort(gram, kind="stable")
    fresh = np.concatenate([[True], gram[order][1:] != gram[order][:-1]])
    group_of = np.cumsum(fresh) - 1
    n = np.int64(len(ids))
    listed = group_of * n + order  # by group, then place
    group, rank = np.empty(len(gram), np.int64), np.empty(len(gram), np.int64)
    group[order], rank[order] = group_of, np.arange(len(gram))
    size = np.bincount(group_of)
    found = []
    for shift, later in ((-4, True), (-1, True), (0, False), (-3, False)):
        t = m[rule] + shift
        fits = (t >= a[rule]) & (t + 4 <= b[rule])
        r, t = rule[fits], t[fits]
        often = size[group[t]] > 1
        r, t = r[often], t[often]
        if later:
            low, high = rank[t] + 1, np.searchsorted(listed, group[t] * n + b[r] - 3)
        else:
            low, high = np.searchsorted(listed, group[t] * n + a[r]), rank[t]
        owner, offset = _spans(np.maximum(high - low, 0))
        other = order[low[owner] + offset]
        period = np.abs(other - t[owner])
        pivot = m[r][owner] - 1 if later else m[r][owner] - period
        found.append((r[owner], period, pivot))
    rule, period, pivot = (np.concatenate(x) for x in zip(*found, strict=True))
    fits = (pivot >= a[rule]) & (pivot + period < b[rule])
    rule, period, pivot = rule[fits], period[fits], pivot[fits]
    if not len(rule):
        return none
    hashes = _Hashes(ids, seed)
    ahead = hashes.common(pivot, pivot + period, b[rule] - pivot - period)
    behind = hashes.common(pivot, pivot + period, pivot - a[rule], back=True)
    start, end = pivot - behind, pivot + ahead + period
    good = (ahead > 0) & (end - start >= np.maximum(12, 2 * period))
    return rule[good], start[good], end[good], period[good]


def _derived(g: Grammar, rule: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
    """Every place in the documents of the rules' runs: down from the roots, through rules that hold one."""
    own = np.bincount(rule, minlength=len(g.left))
    holds = np.concatenate([np.zeros(g.first, bool), own > 0])
    for low, high in g.rounds:
        holds[g.first + low:g.first + high] |= holds[g.left[low:high]] | holds[g.right[low:high]]
    order = np.argsort(rule, kind="stable")
    first = np.cumsum(own) - own
    out, sym, at = [], g.roots, g.root_at
    while (open_ := holds[sym]).any():
        sym, at = sym[open_], at[open_]
        r = sym - g.first
        owner, offset = _spans(own[r])
        i = order[first[r][owner] + offset]
        move = at[owner] - g.place[rule[i]]
        out.append((start[i] + move, end[i] + move, period[i]))
        sym, at = np.concatenate([g.left[r], g.right[r]]), np.concatenate([at, at + g.length[g.left[r]]])
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _merged(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
    """Maximal intervals, in order: pieces of one period that share a period's words are one; the least period counts."""
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    span = np.int64(end.max()) + 1
    _, which = np.unique(period, return_inverse=True)
    reach = np.maximum.accumulate(end + which * span) - which * span
    fresh = np.concatenate([[True], (period[1:] != period[:-1]) | (start[1:] + period[1:] > reach[:-1])])
    head = np.flatnonzero(fresh)
    start, period, end = start[head], period[head], np.maximum.reduceat(end, head)
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    least = np.concatenate([[True], (start[1:] != start[:-1]) | (end[1:] != end[:-1])])
    start, end, period = start[least], end[least], period[least]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def runs(ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) by start, then period, of the runs in documents of word ids.

    A run is a longest stretch of words with smallest period q, of at least 12 and 2 * q words.
    ``ids`` holds the documents one after the other, beginning at ``starts``; they run from 0 and no two documents share any.
    """
    none = (np.zeros(0, np.int64),) * 3
    if len(ids) < 12:
        return none
    g = repair(ids, starts)
    for seed in range(8):
        rule, start, end, period = _crossing(ids, g, seed)
        if not len(rule):
            return none
        start, end, period = _merged(*_derived(g, rule, start, end, period))
        owner, offset = _spans(end - start - period)
        if (ids[start[owner] + offset] == ids[start[owner] + offset + period[owner]]).all():
            return start, end, period
    raise RuntimeError("eight pairs of hash bases in a row gave equal hashes to different words")


def _chunk(ids: list, bodies: list[bytes], edit: Edit | None) -> tuple[list, list, list, list, list]:
    """(doc_id, number of words, starts, ends and periods, text without repeated periods) of some documents."""
    words, numbers, at = [], [], [0]
    fresh = count()
    for doc_id, body in zip(ids, bodies, strict=True):
        own = body.split()  # ASCII blanks only
        own = edit(doc_id, own) if edit else own
        numbers.extend(map(defaultdict(fresh.__next__).__getitem__, own))
        words.append(own)
        at.append(len(numbers))
    at = np.array(at)
    numbers = np.array(numbers, np.int64)
    start, end, period = runs(numbers, np.unique(at[:-1][np.diff(at) > 0]))
    owner, offset = _spans(end - start - period)
    keep = np.ones(len(numbers), bool)
    keep[start[owner] + period[owner] + offset] = False
    bounds = np.searchsorted(start, at)
    spans, kept = [], []
    for i, own in enumerate(words):
        low, high = bounds[i], bounds[i + 1]
        spans.append([] if low == high else np.stack([start[low:high] - at[i], end[low:high] - start[low:high], period[low:high]], 1).tolist())
        kept.append(b" ".join(own if low == high else compress(own, keep[at[i]:at[i + 1]].tolist())))
    return ids, [len(w) for w in words], spans, kept


RUN = T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")])


def find_runs(docs: DataFrame, edit: Edit | None = None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row: the text's runs by start and period, and the text without them.

    Words are what lies between ASCII blanks. A run is a longest stretch of words with smallest period q (words q
    apart are the same), of at least 12 and 2 * q words. ``collapsed`` has the words left, with one space between,
    when each run keeps its first q words only. ``edit`` may change a document's words before that.

    Null and empty texts have no words, no runs and an empty ``collapsed``. Every row is judged by itself, so repeated
    rows, ties and null ids need no rule. A very long text is worked on as a whole in one task, in time and
    memory that follow n log n of its words. Other columns are not read, so their names cannot clash.
    """
    slim = docs.selectExpr("doc_id", "cast(cast(text AS string) AS binary) AS body")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, bodies, size, low = batch.column(0), [], 0, 0
            for i, value in enumerate(batch.column(1)):
                bodies.append(value.as_py() or b"")
                size += len(bodies[-1]) // 6
                if size >= CHUNK_WORDS or i == batch.num_rows - 1:
                    own = ids.slice(low, len(bodies))
                    _, n, spans, kept = _chunk(own.to_pylist(), bodies, edit)
                    flat = np.array([s for x in spans for s in x], np.int64).reshape(-1, 3)
                    offsets = np.concatenate([[0], np.cumsum([len(x) for x in spans])])
                    struct = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"])
                    yield pa.RecordBatch.from_arrays(
                        [own, pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), struct), pa.array(kept, pa.binary())],
                        ["doc_id", "n_words", "runs", "kept"])
                    bodies, size, low = [], 0, i + 1

    found = slim.mapInArrow(scan, T.StructType([
        docs.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN, False)),
        T.StructField("kept", T.BinaryType())]))
    return found.selectExpr("doc_id", "n_words", "runs", "cast(kept AS string) AS collapsed")


def plant(doc_id: object, words: list[bytes]) -> list[bytes]:
    """One document in ten, by the crc32 of its id, with its tail made periodic. A null id is left as it is."""
    n, h = len(words), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    unit = words[a:a + 1 + (n - a) // (3 + g % 8)]
    return words[:a] + (unit * ((n - a) // len(unit) + 1))[:n - a]
