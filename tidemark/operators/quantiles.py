"""Exact quantiles without sorting or shuffling a whole column.

A sketch brackets each quantile between two values that are sure to enclose it; a
second pass counts the rows below the bracket and keeps, value by value, those inside
it (about 4 rows in 10,000, or the repeats of a few values), which are then put in
order. The brackets are literals in those passes, so Parquet can skip row groups
outside them. Small and large columns go the same way.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.session import stored
from tidemark.operators.ordering import running_totals

_ACCURACY = 10_000  # rank error of the sketch is at most rows / _ACCURACY


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], plain_table: bool = False
) -> dict[str, list[float | None]]:
    """Interpolated quantiles per column, in the order of ``probs``.

    Like ``DataFrame.approxQuantile`` the answer is a few plain numbers, one per
    column and probability; unlike it they are exact. The columns are read up to four
    times, so they are first written out by themselves, unless ``plain_table`` says
    that ``df`` is a columnar table already.
    """
    probs = [float(p) for p in probs]
    values = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    if not plain_table:
        values = stored(values)
    margin = 2.0 / _ACCURACY
    cuts = [min(1.0, max(0.0, p + side)) for p in probs for side in (-margin, margin)]
    first = values.agg(*[
        F.struct(F.count(c).alias("n"), F.percentile_approx(c, cuts, _ACCURACY).alias("cuts")).alias(c) for c in columns
    ]).first()
    found = {c: (first[c]["n"], first[c]["cuts"]) for c in columns if first[c]["n"]}
    answer = quantiles_between(values, found, probs) if found else {}
    return {c: answer.get(c, [None] * len(probs)) for c in columns}


class BracketMissed(ValueError):
    """A quantile lies outside the bracket given for it."""


def quantiles_between(
    values: DataFrame, sketch: dict[str, tuple[int, list[float]]], probs: Sequence[float]
) -> dict[str, list[float]]:
    """Exact quantiles of the columns of doubles in ``values``.

    ``sketch`` has, per column, its number of values and for each probability the two
    values that enclose the quantile. Raises ``BracketMissed`` where they do not.
    """
    slots = [(c, i, cuts[2 * i], cuts[2 * i + 1]) for c, (_, cuts) in sketch.items() for i in range(len(probs))]
    within = [F.col(c).between(low, high) for c, _, low, high in slots]
    counted = values.agg(
        *[F.count_if(F.col(c) < low).alias(f"below:{c}:{i}") for c, i, low, _ in slots],
        *[F.count_if(w).alias(f"within:{c}:{i}") for (c, i, _, _), w in zip(slots, within)],
    ).first()
    below = {(c, i): counted[f"below:{c}:{i}"] for c, i, _, _ in slots}
    for c, i, _, _ in slots:
        at, first = probs[i] * (sketch[c][0] - 1), below[c, i]
        if not first <= math.floor(at) <= math.ceil(at) < first + counted[f"within:{c}:{i}"]:
            raise BracketMissed(f"{c} at {probs[i]}")
    hits = F.array(*[
        F.when(w, F.struct(F.lit(slot).alias("slot"), F.col(c).alias("value")))
        for slot, ((c, _, _, _), w) in enumerate(zip(slots, within))
    ])
    inside = (
        values.where(reduce(lambda x, y: x | y, within))
        .select(F.explode(hits).alias("h"))
        .where(F.col("h").isNotNull())
        .select("h.*")
        .groupBy("slot", "value")
        .agg(F.count("*").alias("n"))
    )
    placed = running_totals(inside, [F.col("slot"), F.col("value")], ["n"])
    starts = {r["slot"]: r["start"] for r in placed.groupBy("slot").agg(F.min("n_before").alias("start")).collect()}

    places, wanted = {}, F.lit(False)
    for slot, (c, i, _, _) in enumerate(slots):
        at = probs[i] * (sketch[c][0] - 1)
        ends = [starts[slot] + int(rank) - below[c, i] for rank in (math.floor(at), math.ceil(at))]
        places[slot] = (at, ends)
        for rank in set(ends):
            holds = (F.col("n_before") <= rank) & (rank < F.col("n_before") + F.col("n"))
            wanted = wanted | ((F.col("slot") == slot) & holds)
    # At most two rows per column and probability come back.
    found = placed.where(wanted).select("slot", "value", "n", "n_before").collect()

    def value_at(slot: int, rank: int) -> float:
        return next(r["value"] for r in found
                    if r["slot"] == slot and r["n_before"] <= rank < r["n_before"] + r["n"])

    answer: dict[str, list[float]] = {c: [0.0] * len(probs) for c in sketch}
    for slot, (c, i, _, _) in enumerate(slots):
        at, (low, high) = places[slot]
        lv, hv = value_at(slot, low), value_at(slot, high)
        answer[c][i] = lv if low == high else (math.ceil(at) - at) * lv + (at - math.floor(at)) * hv
    return answer
