"""Secrets in texts: base patterns, and a linear-chain conditional random field.

The field tags a text's words as the begin of a secret, inside one, or outside.
It sees each word's shape, the words beside it and features of the whole text,
is trained on texts whose base spans serve as labels, and is decoded by Viterbi.
A word whose best tag is certain whatever stands beside it ends a run, so only
short runs need the dynamic programme.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.session import stored

KINDS = ("assign", "access", "hex")
#: Kind of the spans that the field adds.
LEARNT = "learnt"
#: Texts with a base span, and texts without one, that the field is trained on at most: the smallest by hash. A bound on training only.
FIT_TEXTS = 1_500
#: Words on either side of a base span in a training sequence, and words of a sequence without one.
MARGIN, PLAIN_WORDS = 8, 40
#: Words with digits, but no secret, that a training text gives sequences for at most: the smallest by hash of place and word.
ODD_WORDS = 20
#: Different training sequences with a base span, and without one, for each of ``FIT_TEXTS`` at most: the smallest by hash.
MARKED_SEQUENCES, PLAIN_SEQUENCES = 4, 8
#: Words whose shape a Python worker keeps; bounds memory, never changes spans.
CACHE_WORDS = 400_000
OUT, BEGIN, INSIDE = 0, 1, 2

# The base patterns. A length in the pattern finds the same matches as a test of longer ones afterwards.
_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_LONG = re.compile(r"\S{16,}")
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_WORD = re.compile(r"\S+")
_VALUE = re.compile(r"[A-Za-z0-9+/_.=-]*[A-Za-z0-9+/_=-]")

Span = tuple[int, int, str]  # start, end, kind


def base_spans(text: str) -> list[Span]:
    """Base spans by start, then kind; code points, end exclusive."""
    found: list[Span] = []
    lower = text.lower()
    if any(name in lower for name in _NAMES):
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text)]
    if max(map(len, text.split()), default=0) >= 16:
        for word in _LONG.finditer(text):
            found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text, word.start(), word.end())]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def shape(word: str) -> int:
    """Number of a word's shape: length, kinds of letters, their order, its first marks."""
    bare = word.strip("\"'`.,;:!?()[]{}<>")
    size = len(bare)
    length = 0 if size < 6 else 1 if size < 10 else 2 if size < 14 else 3 if size < 20 else 4 if size < 32 else 5 if size < 65 else 6
    digits = sum(c.isdigit() for c in bare)
    upper, lower = sum(c.isupper() for c in bare), sum(c.islower() for c in bare)
    mix = 0 if not digits else 1 if digits == size else 2 if 5 * digits < size else 3
    case = 0 if not upper else 1 if not lower else 2 if upper == 1 and bare[0].isupper() else 3
    turns = sum((a.isdigit() != b.isdigit()) for a, b in zip(bare, bare[1:]))
    busy = 0 if turns < 2 else 1 if turns < 5 else 2
    marks = 0 if bare.isalnum() else 1 if "@" in bare or "://" in bare else 2 if "=" in bare or ":" in bare else 3
    return ((((length * 4 + mix) * 4 + case) * 3 + busy) * 4 + marks)


_PARTS = (7, 4, 4, 3, 4)
SHAPES = int(np.prod(_PARTS))
#: Which value of each part a shape has, so that the parts share weights between shapes: [SHAPES, sum of parts].
_HAS = np.concatenate([np.eye(n)[values] for n, values in zip(_PARTS, np.unravel_index(np.arange(SHAPES), _PARTS), strict=True)], axis=1)
#: Roles of a neighbouring word: the edge of the text, names a secret, ends with a sign of assignment, is a sign, has a digit, is plain.
EDGE, NAMES, ASSIGNS, SIGN, DIGITS, PLAIN = range(6)
ROLES = 6


def role(word: str) -> int:
    low = word.lower()
    if not any(c.isalnum() for c in word):
        return SIGN
    if any(name in low for name in (*_NAMES, "key", "credential", "auth")):
        return NAMES
    if word[-1] in "=:":
        return ASSIGNS
    return DIGITS if any(c.isdigit() for c in word) else PLAIN


FILE_BINS = 4


def file_bin(roles: np.ndarray) -> int:
    """Feature of the whole text: the share of words with digits, signs or assignments."""
    odd = float(np.mean(roles != PLAIN)) if len(roles) else 0.0
    return 0 if odd == 0 else 1 if odd < 0.01 else 2 if odd < 0.1 else 3


@dataclass
class Field:
    """Weights of the conditional random field."""

    shapes: np.ndarray  # [SHAPES, 3]
    left: np.ndarray  # [ROLES, 3], by the role of the word before
    right: np.ndarray  # [ROLES, 3], by the role of the word after
    file: np.ndarray  # [FILE_BINS, 3]
    move: np.ndarray  # [3, 3], from tag to tag

    def emissions(self, shapes: np.ndarray, roles: np.ndarray, where: int) -> np.ndarray:
        edge = np.array([EDGE])
        before, after = np.concatenate((edge, roles[:-1])), np.concatenate((roles[1:], edge))
        return self.shapes[shapes] + self.left[before] + self.right[after] + self.file[where]

    def decode(self, emit: np.ndarray) -> np.ndarray:
        """Best tags of a sequence. A sequence starts after an OUT tag, so INSIDE never opens one."""
        move = self.move.copy()
        move[OUT, INSIDE] = -np.inf
        # Going through OUT instead of another tag costs at most ``most`` in moves; a lead beyond it is certain.
        finite = np.where(np.isfinite(move), move, -1e9)
        most = max(finite[a, x] + finite[x, b] - finite[a, OUT] - finite[OUT, b] for a in range(3) for b in (OUT, BEGIN) for x in (BEGIN, INSIDE))
        after_inside = max(finite[x, INSIDE] for x in (BEGIN, INSIDE)) - finite[OUT, BEGIN]
        open_ = emit[:, 1:].max(axis=1) + max(most, 0.0) + max(after_inside, 0.0) + np.abs(emit[:, 1] - emit[:, 2]).max(initial=0.0) >= emit[:, OUT]
        tags = np.zeros(len(emit), dtype=np.int8)
        places = np.flatnonzero(open_)
        if not len(places):
            return tags
        for run in np.split(places, np.flatnonzero(np.diff(places) != 1) + 1):
            a, b = run[0], run[-1] + 1
            score, back = emit[a] + move[OUT], []
            for t in range(a + 1, b):
                paths = score[:, None] + move
                back.append(paths.argmax(axis=0))
                score = paths.max(axis=0) + emit[t]
            if b < len(emit):  # what follows the run is outside
                score = score + move[:, OUT]
            tag = int(score.argmax())
            for t in range(b - 1, a - 1, -1):
                tags[t] = tag
                if t > a:
                    tag = int(back[t - a - 1][tag])
        return tags


class Reader:
    """Shapes and roles of words, with a cache."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def read(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        known = self.known
        if len(known) > CACHE_WORDS:
            known = self.known = {}
        for word in set(words).difference(known):
            known[word] = shape(word) * ROLES + role(word)
        both = np.fromiter(map(known.__getitem__, words), dtype=np.int32, count=len(words))
        return both // ROLES, both % ROLES


_READER = Reader()


def train(sequences: list[tuple[np.ndarray, np.ndarray, int, np.ndarray]], rounds: int = 60, penalty: float = 0.02) -> Field:
    """Maximum likelihood by Adam steps on (shapes, roles, file bin, tags) sequences, all at once, padded."""
    count, width = len(sequences), max(len(s[0]) for s in sequences)
    shapes, tags = np.zeros((count, width), np.int64), np.zeros((count, width), np.int64)
    before, after = np.full((count, width), EDGE), np.full((count, width), EDGE)
    mask, where = np.zeros((count, width)), np.array([s[2] for s in sequences])
    for i, (s, r, _, y) in enumerate(sequences):
        n = len(s)
        shapes[i, :n], tags[i, :n], mask[i, :n] = s, y, 1
        before[i, 1:n], after[i, :n - 1] = r[:-1], r[1:]
    sizes = (_HAS.shape[1] * 3, ROLES * 3, ROLES * 3, FILE_BINS * 3, 9)
    w, m, v = np.zeros(sum(sizes)), np.zeros(sum(sizes)), np.zeros(sum(sizes))
    cuts = np.cumsum(sizes)[:-1]
    real = mask.astype(bool)
    pairs = real[:, 1:]
    for t in range(1, rounds + 1):
        field = _field(w, cuts)
        emit = field.shapes[shapes] + field.left[before] + field.right[after] + field.file[where][:, None, :]
        alpha, beta = np.zeros_like(emit), np.zeros_like(emit)
        alpha[:, 0] = emit[:, 0]
        for k in range(1, width):
            step = _lse(alpha[:, k - 1, :, None] + field.move, 1) + emit[:, k]
            alpha[:, k] = np.where(mask[:, k, None] > 0, step, alpha[:, k - 1])
        for k in range(width - 2, -1, -1):
            step = _lse(field.move + (emit[:, k + 1] + beta[:, k + 1])[:, None, :], 2)
            beta[:, k] = np.where(mask[:, k + 1, None] > 0, step, beta[:, k + 1])
        total = _lse(alpha[:, -1], 1)
        share = np.exp(alpha + beta - total[:, None, None]) * mask[:, :, None]
        both = np.exp(alpha[:, :-1, :, None] + field.move + (emit + beta)[:, 1:, None, :] - total[:, None, None, None]) * mask[:, 1:, None, None]
        gap = share - np.eye(3)[tags] * mask[:, :, None]
        grads = [np.zeros((SHAPES, 3)), np.zeros((ROLES, 3)), np.zeros((ROLES, 3)), np.zeros((FILE_BINS, 3)), both.sum(axis=(0, 1))]
        for g, index in zip(grads, (shapes, before, after)):
            np.add.at(g, index[real], gap[real])
        np.add.at(grads[3], where, gap.sum(axis=1))
        np.add.at(grads[4], (tags[:, :-1][pairs], tags[:, 1:][pairs]), -1)
        grads[0] = _HAS.T @ grads[0]
        g = np.concatenate([x.ravel() for x in grads]) / count + penalty * w / count
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - 0.25 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    return _field(w, cuts)


def _field(w: np.ndarray, cuts: np.ndarray) -> Field:
    parts, *rest = (p.reshape(-1, 3) for p in np.split(w, cuts))
    return Field(_HAS @ parts, *rest)


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _training(text: str) -> Iterator[tuple[np.ndarray, np.ndarray, int, np.ndarray]]:
    """Sequences around the base spans and the odd words of a text, or ``PLAIN_WORDS`` words from a place
    that the text's hash picks if it has neither."""
    places = [(m.start(), m.end()) for m in _WORD.finditer(text)]
    if not places:
        return
    words = [text[a:b] for a, b in places]
    shapes, roles = _READER.read(words)
    where, tags, inside = file_bin(roles), np.zeros(len(places), dtype=np.int64), -1
    spans = base_spans(text)
    starts = np.array([a for a, _ in places])
    marked = []
    for a, b, kind in spans:
        value = _ASSIGN.match(text, a, b).start(2) if kind == "assign" else a
        first, last = np.searchsorted(starts, [value, b - 1], side="right") - 1
        if first > inside:
            tags[first], tags[first + 1:last + 1], inside = BEGIN, INSIDE, last
            marked.append((first, last))
    # Words with digits that are no secret, such as dates and addresses, are the field's hardest counter-examples.
    odd = np.flatnonzero((roles == DIGITS) & (tags == OUT)).tolist()
    odd = [(i, i) for i in sorted(odd, key=lambda i: (zlib.crc32(f"{i} {words[i]}".encode("utf-8", "surrogatepass")), i))[:ODD_WORDS]]
    cuts = [slice(max(0, first - MARGIN), last + 1 + MARGIN) for first, last in [*marked, *odd]]
    if not cuts:
        start = zlib.crc32(text.encode("utf-8", "surrogatepass")) % max(1, len(places) - PLAIN_WORDS + 1)
        cuts = [slice(start, start + PLAIN_WORDS)]
    for cut in cuts:
        yield shapes[cut], roles[cut], where, tags[cut]


def _fit_hashes(rows: DataFrame, fit_texts: int) -> list[int]:
    """Hashes (``order``) of the texts to train on: the smallest of different texts with a base span, and as many of others."""
    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marked = [t is not None and bool(base_spans(t)) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["order"], pa.array(marked, pa.bool_())], names=["order", "marked"])

    # A text that fails the cheap test has no base span and stays on the JVM's side.
    likely = F.col("text").rlike("(?i)passw|secret|token|api_?key|AKIA|[0-9a-f]{16}")
    tested = rows.select("order", F.when(likely, F.col("text")).alias("text"))
    each = stored(tested.mapInArrow(judged, "order long, marked boolean").distinct())
    return [r.order for marked in (True, False) for r in each.where(F.col("marked") == marked).orderBy("order").limit(fit_texts).select("order").collect()]


def learn(docs: DataFrame, fit_texts: int = FIT_TEXTS, seed: int = 5) -> Field | None:
    """A field trained on base spans of ``docs``; None if no text has one."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(text.alias("text"), F.xxhash64(text, F.lit(seed)).alias("order"))
    # Only hashes of texts come to the driver.
    wanted = _fit_hashes(rows, fit_texts)
    if not wanted:
        return None
    chosen = rows.sparkSession.createDataFrame([(x,) for x in wanted], "order long")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [s for t in batch["text"].to_pylist() for s in _training(t)]
            columns = zip(*((s.tolist(), r.tolist(), b, y.tolist()) for s, r, b, y in found)) if found else [[], [], [], []]
            kinds = (pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int32(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["s", "r", "b", "y"])

    texts = rows.join(F.broadcast(chosen), "order").groupBy("order").agg(F.first("text").alias("text")).select("text")
    cuts = stored(texts.mapInArrow(cut, "s array<int>, r array<int>, b int, y array<int>").distinct().withColumns(
        {"marked": F.array_contains("y", BEGIN), "order": F.xxhash64("s", "r", "b", "y")}))
    found = [(np.array(x.s), np.array(x.r), x.b, np.array(x.y)) for marked, each in ((True, MARKED_SEQUENCES), (False, PLAIN_SEQUENCES))
             for x in cuts.where(F.col("marked") == marked).orderBy("order", "s", "r", "b", "y").limit(each * fit_texts).select("s", "r", "b", "y").collect()]
    return train(found) if any(len(x[3]) and x[3].any() for x in found) else None


def spans(text: str, field: Field | None) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans): the field's spans that meet no base span are added, as ``learnt``."""
    base = base_spans(text)
    if field is None:
        return base, base
    words = text.split()
    if not words:
        return base, base
    shapes, roles = _READER.read(words)
    tags = field.decode(field.emissions(shapes, roles, file_bin(roles)))
    if not tags.any():
        return base, base
    places = [(m.start(), m.end()) for m in _WORD.finditer(text)]
    added: list[Span] = []
    begins = np.flatnonzero(tags == BEGIN).tolist()
    for i in begins:
        last = i
        while last + 1 < len(tags) and tags[last + 1] == INSIDE:
            last += 1
        a, b = places[i][0], places[last][1]
        value = max(_VALUE.finditer(text, a, b), key=lambda m: len(m[0]), default=None) if i == last else None
        if value:
            a, b = value.start(), value.end()
        if not any(x < b and a < y for x, y, _ in base):
            added.append((a, b, LEARNT))
    order = (*KINDS, LEARNT)
    return base, sorted(base + added, key=lambda s: (s[0], order.index(s[2]), s[1]))


def as_text(found: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in found)


def find(docs: DataFrame, field: Field | None) -> DataFrame:
    """Per row of ``docs``: doc_id, ``base`` and ``spans`` (start, end, kind).

    A null text is an empty one and has no spans. Repeated rows each have theirs; other columns are
    ignored; no rows give none.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
        for batch in batches:
            both = [spans(t or "", field) for t in batch["text"].to_pylist()]
            columns = [pa.array([[dict(zip(("start", "end", "kind"), s)) for s in pair[k]] for pair in both], kind) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], names=["doc_id", "base", "spans"])

    kind, listed = docs.schema["doc_id"].dataType.simpleString(), "array<struct<start:long,end:long,kind:string>>"
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, base {listed}, spans {listed}")


def digest(found: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of ``find``'s rows."""
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select("doc_id", *(F.size(F.filter("base", _of_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS),
                        F.sha2(text(F.col("base")).cast("binary"), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


def _of_kind(kind: str):
    return lambda span: span["kind"] == kind


def sha256_of(found: list[Span]) -> str:
    """The digest of base spans, for comparisons."""
    return hashlib.sha256(as_text(found).encode()).hexdigest()
