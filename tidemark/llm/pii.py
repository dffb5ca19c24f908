"""Personal data: span generators, boosted trees on format and context, redaction.

Generators of high recall propose spans of four kinds. Those of a base pattern that
meet their kind's full rule are base spans and always stay. Boosted trees learn from
base-pattern matches alone, those that meet the rule against those that fail it, what
personal data looks like here; what the rule tests is hidden from them. They judge the
looser generators' spans, which are never a negative, kind by kind, by a threshold
calibrated on base-pattern matches that they have not seen.
Everything is DataFrame operations; the trees are Spark ML's.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.session import stored
from tidemark.llm.text import free_name, text_key

KINDS = ("email", "ip", "card", "phone")
#: Characters of context on either side of a candidate.
CONTEXT = 24
#: Share of a kind's held-out base-pattern matches above its threshold that must meet the full rule.
PRECISION = 0.98


@dataclass(frozen=True)
class Generator:
    """A pattern for spans of a kind; ``needs`` is a cheap test that texts without one fail."""

    name: str
    kind: str
    needs: str
    pattern: str
    base: bool


# The base patterns. Possessive repeats and the start rule keep them linear on long runs and change no match.
GENERATORS = (
    Generator("email", "email", "@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", True),
    Generator("ip", "ip", r"[0-9]\.[0-9]", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", True),
    Generator("card", "card", "[0-9][ -]?[0-9]", r"[0-9]++(?:[\x20-][0-9]++)*+", True),
    Generator("phone", "phone", r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", True),
    # Looser forms, for the trees to judge.
    Generator("spelled email", "email", "(?i)[\\[( ](?:at|dot)[\\]) ]",
              r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]++ ?[\[( ](?:at)[\]) ] ?[a-z0-9-]++(?: ?[\[( ]dot[\]) ] ?[a-z0-9-]++)++", False),
    Generator("dotted card", "card", r"[0-9]{3}[._/][0-9]{3}", r"(?<![0-9])[0-9]{3,6}(?:[._/][0-9]{3,6}){2,5}(?![0-9])", False),
    Generator("local phone", "phone", "[0-9][ ().-]{1,3}[0-9]{2}", r"(?<![0-9+.])\(?[0-9]{2,5}\)?(?:[ .-][0-9]{2,5}){2,4}(?![0-9.])", False),
)
_CUES = {
    "cue_email": "(?i)mail|contact|@|write to", "cue_ip": "(?i)\\bip\\b|host|server|addr", "cue_card": "(?i)card|visa|master|credit|iban|konto|tarjeta|carte",
    "cue_phone": "(?i)tel|phone|call|mobil|fon|fax|cell",
}
# Nothing that a rule tests by itself (check digit, number of digits, largest part, plus), or the trees would restate the rules.
FEATURES = ("n_chars", "n_groups", "n_dots", "n_gaps", "n_letters", "brackets", "letter_before", "letter_after", "digits_near", "spaced", *_CUES)
#: Dates, with or without an hour, that read like a local phone number.
_DATE = r"^(?:(?:19|20)[0-9]{2}[ .-][01][0-9][ .-][0-3][0-9]|[0-3][0-9][ .-][0-3][0-9][ .-](?:19|20)[0-9]{2})(?: [0-9]{2})?$"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit of a string of digits is right."""
    def weight(digit: Column, place: Column) -> Column:
        twice = digit.cast("int") * F.when(place % 2 == 1, 2).otherwise(1)
        return F.when(twice > 9, twice - 9).otherwise(twice)

    each = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda d: d != ""), weight)
    return (F.length(digits) > 0) & (F.aggregate(each, F.lit(0), lambda total, x: total + x) % 10 == 0)


def meets_rule(kind: Column, value: Column) -> Column:
    """Whether a match of a base pattern passes its kind's test."""
    n, small = F.length(_digits(value)), F.lit("^0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$")
    return (F.when(kind == "email", F.lit(True))
            .when(kind == "ip", F.forall(F.split(value, "\\."), lambda part: F.rlike(part, small)))
            .when(kind == "card", F.when((n >= 12) & (n <= 19), luhn(_digits(value))).otherwise(False))
            .otherwise((n >= 9) & (n <= 15)))


def may_be(kind: Column, value: Column) -> Column:
    """Whether a looser form can be of its kind: the rule, but for what the form leaves out, such as a phone's country code."""
    n = F.length(_digits(value))
    return (F.when(kind == "card", F.when((n >= 12) & (n <= 19), luhn(_digits(value))).otherwise(False))
            .when(kind == "phone", (n >= 7) & (n <= 15) & ~value.rlike(_DATE))
            .otherwise(F.lit(True)))


def candidates(docs: DataFrame) -> DataFrame:
    """(key, generator, kind, base, start, end, value, before, after) of every generator match in the distinct texts.

    ``key`` stands for the text; positions are code points, the end exclusive.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))

    def found(g: Generator) -> Column:
        gaps, hits = F.split(text, g.pattern, -1), F.regexp_extract_all(text, F.lit(g.pattern), 0)
        near = F.transform(gaps, lambda gap: F.struct(
            F.length(gap).alias("length"), F.right(gap, F.lit(CONTEXT)).alias("before"), F.left(gap, F.lit(CONTEXT)).alias("after")))
        pairs = F.transform(F.arrays_zip(hits.alias("value"), near.alias("gap"), F.slice(near, F.lit(2), F.size(near)).alias("next")),
                            lambda x: F.struct(F.lit(g.name).alias("generator"), F.lit(g.kind).alias("kind"), F.lit(g.base).alias("base"),
                                               x["value"].alias("value"), x["gap"]["length"].alias("skip"),
                                               x["gap"]["before"].alias("before"), x["next"]["after"].alias("after")))
        # The last gap has no match after it.
        matched = F.filter(pairs, lambda x: x["value"].isNotNull())
        placed = F.transform(matched, lambda x, i: F.struct(i.alias("place"), x.alias("x")))
        return F.when(text.rlike(g.needs), placed)

    matches = F.concat(*(F.coalesce(found(g), F.array().cast(_MATCHES)) for g in GENERATORS))
    # Two steps: beside explode the key would be computed anew for every match.
    listed = docs.where(text.rlike("[0-9@]|(?i:dot)")).select(text_key(text).alias("key"), matches.alias("matches"))
    rows = listed.select("key", F.explode("matches").alias("m")).select("key", "m.place", "m.x.*").groupBy("key", "generator", "place").agg(  # copies of a text propose the same
        *(F.first(c).alias(c) for c in ("kind", "base", "value", "skip", "before", "after")))
    run = Window.partitionBy("key", "generator").orderBy("place")
    end = F.sum(F.col("skip") + F.length("value")).over(run)
    placed = rows.withColumn("end", end.cast("long")).withColumn("start", F.col("end") - F.length("value"))
    return placed.select("key", "generator", "kind", (F.col("base") & meets_rule(F.col("kind"), F.col("value"))).alias("base"),
                         "start", "end", "value", "before", "after")


_MATCHES = ("array<struct<place:int,x:struct<generator:string,kind:string,base:boolean,value:string,skip:int,before:string,after:string>>>")


def _usual(kind: Column, value: Column) -> Column:
    """A value in the marks of its kind's base pattern, without a phone's plus, so that a looser form is not told by its marks."""
    spelled = F.regexp_replace(F.regexp_replace(value, r"(?i) ?[\[( ]at[\]) ] ?", "@"), r"(?i) ?[\[( ]dot[\]) ] ?", ".")
    return (F.when(kind == "email", spelled).when(kind == "card", F.translate(value, "._/", "   "))
            .when(kind == "phone", F.translate(value, ".+", "-")).otherwise(value))


def features(spans: DataFrame) -> DataFrame:
    """``spans`` with the numeric columns of ``FEATURES``."""
    value = _usual(F.col("kind"), F.col("value"))
    near = F.concat("before", F.lit(" "), "after")
    count = lambda pattern: F.regexp_count(value, F.lit(pattern))
    columns = {
        "n_chars": F.length(value), "n_groups": count("[0-9]+"), "n_dots": count("\\."), "n_gaps": count("[ -]"),
        "n_letters": count("[A-Za-z]"), "brackets": value.rlike("[()\\[\\]]"),
        "letter_before": F.col("before").rlike("[A-Za-z]$"), "letter_after": F.col("after").rlike("^[A-Za-z]"),
        "digits_near": F.regexp_count(near, F.lit("[0-9]")), "spaced": F.col("before").rlike("(^|\\s)$") & F.col("after").rlike("^(\\s|$)"),
        **{name: F.col("before").rlike(pattern) for name, pattern in _CUES.items()}}
    return spans.withColumns({name: column.cast("double") for name, column in columns.items()})


def accepted(spans: DataFrame, precision: float = PRECISION, seed: int = 7) -> DataFrame:
    """Base spans, and looser forms that the trees accept: (key, kind, start, end, base, probability).

    Labels come from base patterns alone: a match that meets its kind's rule is personal, one that fails it is
    not and is never added. Each kind has its own trees and threshold. The trees are fitted on half of all matches
    and the threshold on the other half, parted by hash of text and place; in the fit either label weighs the same in
    total. Matches with the same features are one row with their number, so what is fitted on grows no faster than
    different features do. The threshold lies midway between the least probability above which the share of base
    spans, counted for the whole table, is ``precision`` and the next one below it. A kind none of whose matches
    fail, such as email, has nothing to tell its looser forms from: all that ``may_be`` are added. A kind without
    base spans, or with too few matches for both parts, gets none.
    """
    from_base = F.col("generator").isin([g.name for g in GENERATORS if g.base])
    marked = spans.where(from_base).withColumns({"label": F.col("base").cast("double"), "_order": F.xxhash64("key", "generator", "start")})
    counts = {(r.kind, r.label): r["count"] for r in marked.groupBy("kind", "label").count().collect()}
    base = spans.where("base").select("key", "kind", "start", "end", "base", F.lit(1.0).alias("probability"))
    loose = spans.where(~from_base & may_be(F.col("kind"), F.col("value")))
    judged = [k for k in KINDS if any(g.kind == k and not g.base for g in GENERATORS) and counts.get((k, 1.0))]
    unfailed = [k for k in judged if not counts.get((k, 0.0))]
    extra = loose.where(F.col("kind").isin(unfailed)).withColumn("p", F.lit(1.0)).select("key", "kind", "start", "end", "base", "p")
    if learnt := [k for k in judged if k not in unfailed]:
        columns = VectorAssembler(inputCols=list(FEATURES), outputCol="vector")
        held = (F.pmod(F.xxhash64("_order"), F.lit(2)) == 1).alias("held")
        seen = stored(columns.transform(features(marked.where(F.col("kind").isin(learnt))).groupBy("kind", "label", held, *FEATURES).agg(
            F.count(F.lit(1)).alias("n"))).select("kind", "label", "held", "vector", "n"))
        vectors = columns.transform(features(loose))
        for kind in learnt:
            found = _judged(vectors.where(F.col("kind") == kind), seen.where(F.col("kind") == kind), precision, seed)
            extra = extra if found is None else extra.unionByName(found.select(*extra.columns))
    # One span a place and kind.
    extra = extra.groupBy("key", "kind", "start", "end").agg(F.first("base").alias("base"), F.max("p").alias("probability"))
    # What lies inside a base span of any kind is settled: an address is no local phone number.
    before = Window.partitionBy("key").orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    covered = F.max(F.when(F.col("base"), F.col("end"))).over(before)
    return base.unionByName(extra).withColumn("_covered", covered).where(
        F.col("base") | F.col("_covered").isNull() | (F.col("_covered") < F.col("end"))).drop("_covered")


def _judged(vectors: DataFrame, seen: DataFrame, precision: float, seed: int) -> DataFrame | None:
    """``vectors`` that trees fitted on one part of the matches ``seen`` of a kind accept, with probability ``p``; None if a part lacks labels."""
    totals = {r.label: r.n for r in seen.where("not held").groupBy("label").agg(F.sum("n").alias("n")).collect()}
    if len(totals) < 2:
        return None
    weight = F.col("n") * F.when(F.col("label") == 1, min(1.0, totals[0.0] / totals[1.0])).otherwise(min(1.0, totals[1.0] / totals[0.0]))
    model = GBTClassifier(featuresCol="vector", labelCol="label", weightCol="weight", maxIter=12, maxDepth=4, stepSize=0.3, seed=seed).fit(
        seen.where("not held").withColumn("weight", weight))
    chance = F.round(vector_to_array("probability")[1], 3)
    tried = model.transform(seen.where("held")).select(chance.alias("p"), "label", "n").groupBy("p").agg(
        F.sum(F.col("label") * F.col("n")).alias("good"), F.sum("n").alias("all"))
    above = Window.orderBy(F.desc("p"))  # at most a thousand rounded probabilities
    shares = tried.select("p", "good", (F.sum("good").over(above) / F.sum("all").over(above)).alias("share"),
                          F.coalesce(F.lead("p").over(above), F.lit(0.0)).alias("next"))
    kept = shares.where((F.col("share") >= precision) & (F.col("good") > 0))
    threshold = kept.agg(F.min_by((F.col("p") + F.col("next")) / 2, "p")).first()[0]
    return None if threshold is None else model.transform(vectors).withColumn("p", chance).where(F.col("p") >= threshold)


def by_text(spans: DataFrame) -> DataFrame:
    """(key, spans): each text's spans by start, then kind as in ``KINDS``, then end."""
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    return spans.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", order.alias("rank"), "end", "kind", "base"))).alias("spans"))


def find(docs: DataFrame, **settings) -> DataFrame:
    """Per row of ``docs``: doc_id and ``spans`` (start, rank, end, kind, base), in order.

    A null text is an empty one and has no spans. Copies of a text have the same spans, repeated rows
    each keep theirs. No rows give none; other columns are ignored.
    """
    spans = stored(candidates(docs))
    return docs.select("doc_id", text_key(F.col("text")).alias("key")).join(by_text(accepted(spans, **settings)), "key", "left").select(
        "doc_id", F.coalesce("spans", F.array().cast(_SPANS)).alias("spans"))


_SPANS = "array<struct<start:bigint,rank:bigint,end:bigint,kind:string,base:boolean>>"


def redact(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in angle brackets, and ``n_chars`` renewed if there is one.

    Overlapping spans are replaced by the first one's kind. Null texts stay null; other columns are kept, whatever their
    names. A very long text is rewritten in one task, in time that follows its length times its spans.
    """
    spans = stored(candidates(docs))
    found = by_text(accepted(spans, **settings))
    # Spans that begin inside one before them join it.
    merged = F.aggregate("spans", F.array().cast("array<struct<start:bigint,end:bigint,kind:string>>"), lambda done, x: F.when(
        (F.size(done) > 0) & (F.element_at(done, -1)["end"] > x["start"]),
        F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
            F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], x["end"]).alias("end"),
            F.element_at(done, -1)["kind"].alias("kind"))))).otherwise(
        F.concat(done, F.array(F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))))
    key, cuts = free_name("key", docs), free_name("cuts", docs)
    joined = docs.withColumn(key, text_key(F.col("text"))).join(
        found.select(F.col("key").alias(key), merged.alias(cuts)), key, "left")
    pieces = F.transform(cuts, lambda cut, i: F.concat(
        _between(F.when(i == 0, 0).otherwise(F.col(cuts)[i - 1]["end"]), cut["start"]), F.lit("<"), F.upper(cut["kind"]), F.lit(">")))
    tail = _between(F.element_at(cuts, -1)["end"], F.length("text"))
    text = F.when(F.col(cuts).isNull(), F.col("text")).otherwise(F.concat(F.array_join(pieces, ""), tail))
    out = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(cuts).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*docs.columns)


def _between(start: Column, end: Column) -> Column:
    return F.substring(F.col("text"), (start + 1).cast("int"), (end - start).cast("int"))


def _of_kind(kind: str):
    return lambda span: span["kind"] == kind


def digest(found: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of ``find``'s rows."""
    base = F.filter("spans", lambda s: s["base"])
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id", *(F.size(F.filter(base, _of_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(text(base).cast("binary"), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))
