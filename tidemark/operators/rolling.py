"""Error rate over the last n rows, alerts with a cool-down, and error snapshots.

The window counts rows, so it must follow one global order, yet no task may hold
that whole order. Rows get a position by range partition; the window then runs
over chunks of consecutive positions, each given the last n-1 rows of the chunk
before it. Keys sit in the same order, so a key of any size is cut into chunks too.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.session import stored
from tidemark.operators.joins import null_safe_join
from tidemark.operators.ordering import number_rows

CHUNK_ROWS = 1 << 16  # rows per window task
BLOCK_ROWS = 1 << 22  # positions per cool-down task; only breaching rows are in it


def rolling_error_rate(
    df: DataFrame,
    error: Column,
    order_by: Sequence[str],
    n: int = 300,
    keys: Sequence[str] = (),
    keep: Sequence[str] = (),
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Each row with its position ``rn`` and the error rate of the last ``n`` rows of its key.

    ``order_by`` must be unique within a key. ``rn`` counts over all keys, in key
    order, so within a key it is consecutive. ``window_rows`` is below ``n`` while a
    key's window is still filling.
    """
    chunk_rows = max(chunk_rows, n - 1)  # a chunk's first window reaches into one chunk before it only
    columns = list(dict.fromkeys([*keys, *order_by, *keep]))
    slim = df.select(*columns, F.coalesce(error, F.lit(False)).alias("is_error"))
    numbered = number_rows(slim, [F.col(c) for c in [*keys, *order_by]])

    chunk = _div(F.col("rn") - 1, chunk_rows)
    late = (F.col("rn") - 1) % chunk_rows >= chunk_rows - (n - 1)
    spread = numbered.withColumn("_own", chunk).withColumn(
        "_chunk",
        F.explode(F.when(late, F.array("_own", F.col("_own") + 1)).otherwise(F.array("_own"))),
    )
    # Differences of running counts cost the same for any n; a sliding frame would
    # add up all n rows again for each row.
    in_order = Window.partitionBy("_chunk", *keys).orderBy("rn")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    return (
        spread.withColumn("_errors", F.sum(F.col("is_error").cast("bigint")).over(so_far))
        .withColumn("window_rows", F.least(F.row_number().over(in_order), F.lit(n)).cast("bigint"))
        .withColumn("window_errors", F.col("_errors") - F.lag("_errors", n, 0).over(in_order))
        .where(F.col("_chunk") == F.col("_own"))
        .drop("_chunk", "_own", "_errors")
        .withColumn("error_rate", F.col("window_errors") / F.col("window_rows"))
    )


def _div(position: Column, size: int) -> Column:
    """Whole-number division of positions."""
    return ((position - position % size) / size).cast("bigint")


def rolling_alerts(
    rates: DataFrame,
    n: int = 300,
    threshold: float = 0.12,
    cooldown: int = 300,
    keys: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
    last_alerts: DataFrame | None = None,
) -> DataFrame:
    """Rows of ``rolling_error_rate`` that raise an alert: the rate of a full window
    is above ``threshold`` and the key's last alert is at least ``cooldown`` rows back.

    Which rows alert depends on the alert before, row by row. To run it in parallel,
    positions are cut into blocks. Each block is summarised by what it hands on for
    every state it may be entered in, ``block_entries`` finds the state that each is
    entered in, and the blocks are walked again, now knowing theirs. A block may
    hold many keys or a part of one, so neither tiny nor huge keys cost extra.

    ``last_alerts`` (keys and ``rn``) carries the state of an earlier run.
    """
    block_rows = max(block_rows, cooldown)  # a block's alert silences rows of the next one only
    keys = list(keys)
    breaches = rates.where((F.col("window_rows") == n) & (F.col("error_rate") > threshold))
    if last_alerts is not None:
        # A carried alert only silences the breaches within its cool-down.
        waits = last_alerts.select(*keys, (F.col("rn") + cooldown).alias("_free"))
        breaches = (
            null_safe_join(breaches, waits, keys, "left") if keys
            else breaches.withColumn("_free", waits.agg(F.max("_free")).scalar())
        ).where(F.col("_free").isNull() | (F.col("rn") >= F.col("_free")))
    breaches = stored(breaches.select(*rates.columns))
    places = breaches.select(
        _div(F.col("rn"), block_rows).alias("block"), "rn",
        F.to_json(F.struct(*keys)).alias("key") if keys else F.lit("").alias("key"),
    )

    def hand_on(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rn")
        offsets = pdf["rn"].to_numpy() - pdf["block"].iloc[0] * block_rows
        starts, exits = _transfer(offsets, _apart(pdf, offsets, cooldown), cooldown, block_rows)
        return pdf.head(1)[["block"]].assign(
            first_key=pdf["key"].iloc[0], last_key=pdf["key"].iloc[-1], starts=[starts], exits=[exits])

    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rn")
        spaced = _apart(pdf, pdf["rn"].to_numpy() - pdf["block"].iloc[0] * block_rows, cooldown)
        chosen, at = [], np.searchsorted(spaced, pdf["entry"].iloc[0])
        while at < len(spaced):
            chosen.append(at)
            at = np.searchsorted(spaced, spaced[at] + cooldown)
        return pdf.iloc[chosen][["rn"]]

    steps = stored(places.groupBy("block").applyInPandas(
        hand_on, "block LONG, first_key STRING, last_key STRING, starts ARRAY<LONG>, exits ARRAY<LONG>"
    ))
    entries = block_entries(steps, block_rows)
    chosen = places.join(entries, "block").groupBy("block").applyInPandas(pick, "rn LONG")
    return breaches.join(chosen, "rn").select(*rates.columns)


#: What a span of blocks hands on: its first and last block and key, and a step function of the state it is entered in.
_SPAN = ("node LONG, first_block LONG, last_block LONG, first_key STRING, last_key STRING, "
         "starts ARRAY<LONG>, exits ARRAY<LONG>")


def block_entries(steps: DataFrame, block_rows: int) -> DataFrame:
    """(block, entry) of every block: the state it is entered in, from what each block hands on.

    A parallel prefix over a binary tree of block numbers. On the way up the functions of two
    neighbouring spans are composed into one for both; on the way down each span's entry is
    given to its left half, and what the left half makes of it to its right half. A task holds two functions
    at a time, and there are as many rounds as the block numbers have binary digits that differ.
    """
    low, high = steps.agg(F.min("block"), F.max("block")).first()
    level = steps.select((F.col("block") - F.lit(low or 0)).alias("node"), F.col("block").alias("first_block"),
                         F.col("block").alias("last_block"), "first_key", "last_key", "starts", "exits")
    levels = []
    for _ in range(int((high or 0) - (low or 0)).bit_length()):
        levels.append(stored(level))
        level = levels[-1].groupBy(F.shiftright("node", 1).alias("parent")).applyInPandas(_compose(block_rows), _SPAN)
    entries = level.select("node", "first_block", F.lit(0).cast("bigint").alias("entry"))
    for level in reversed(levels):
        above = entries.select(F.col("node").alias("parent"), "entry")
        odd = F.col("node") % 2 == 1
        left = level.where(~odd).select(
            (F.col("node") + 1).alias("node"), F.col("last_block").alias("left_last"), F.col("last_key").alias("left_key"),
            F.arrays_zip("starts", "exits").alias("left_steps"))
        step = F.filter("left_steps", lambda s: s["starts"] >= F.col("entry"))
        linked = (F.col("left_last") + 1 == F.col("first_block")) & (F.col("left_key") == F.col("first_key"))
        entries = level.select("node", "first_block", "first_key", F.shiftright("node", 1).alias("parent")).join(
            above, "parent").join(left, "node", "left").select(
            "node", "first_block", F.when(F.col("left_last").isNull(), F.col("entry"))
            .when(linked, step[0]["exits"]).otherwise(0).alias("entry"))
    return entries.select(F.col("first_block").alias("block"), "entry")


def _compose(block_rows: int):
    """Both halves of a span as one; a span with one half passes as it is.

    State leaves the left half only if the right one begins in the next block, with the same key:
    a cool-down is no longer than a block.
    """
    def compose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node")
        node = int(pdf["node"].iloc[0]) >> 1
        left, right = pdf.iloc[0], pdf.iloc[-1]
        starts, exits = np.asarray(left["starts"]), np.asarray(left["exits"])
        if len(pdf) == 2:
            linked = left["last_block"] + 1 == right["first_block"] and left["last_key"] == right["first_key"]
            inner = exits if linked else np.zeros_like(exits)
            exits = np.asarray(right["exits"])[np.searchsorted(np.asarray(right["starts"]), inner)]
            last = np.append(exits[1:] != exits[:-1], True)  # of equal steps the last start serves all
            starts, exits = starts[last], exits[last]
        return pd.DataFrame({
            "node": [node], "first_block": [left["first_block"]], "last_block": [right["last_block"]], "first_key": [left["first_key"]],
            "last_key": [right["last_key"]], "starts": [starts.tolist()], "exits": [exits.tolist()]})

    return compose


def _apart(pdf: pd.DataFrame, offsets: np.ndarray, cooldown: int) -> np.ndarray:
    """Offsets of sorted rows with a further cool-down added at each change of key, so
    that one walk over the block starts every key afresh."""
    keys = pdf["key"].to_numpy()
    return offsets + np.concatenate(([0], np.cumsum(keys[1:] != keys[:-1]))) * cooldown


def _transfer(
    offsets: np.ndarray, spaced: np.ndarray, cooldown: int, block_rows: int
) -> tuple[list[int], list[int]]:
    """What a block hands on, as a step function of the state it is entered in.

    The state is the first offset that may alert again, from 0 to ``cooldown``. A state
    enters at the first breach at or after it, so one step per breach in the first
    ``cooldown`` places covers every state.
    """
    count = len(spaced)
    onward = np.searchsorted(spaced, spaced + cooldown)
    # The last alert reached from each breach, by doubling the jump.
    last = np.where(onward < count, onward, np.arange(count))
    while True:
        further = last[last]
        if np.array_equal(further, last):
            break
        last = further
    exits = np.maximum(0, offsets[last] + cooldown - block_rows)
    head = int(np.searchsorted(spaced, cooldown, side="right"))
    starts = spaced[:head].tolist() + [cooldown]
    handed = exits[:head].tolist() + [int(exits[head]) if head < count else 0]
    return starts, handed


def alert_snapshot(
    alerts: DataFrame,
    rates: DataFrame,
    path: str,
    n: int = 300,
    k: int = 3,
    keys: Sequence[str] = (),
) -> DataFrame:
    """The ``k`` paths with most errors in each alert's window.

    An alert's window touches at most two buckets of ``n`` positions, so the range
    condition becomes an equi-join on the bucket with a short residual.
    """
    # Positions are unique over all keys, so a window is fixed by its last position;
    # the keys only keep out rows of the key before.
    bucket = _div(F.col("rn") - 1, n)
    first_bucket = _div(F.greatest(F.col("rn") - n, F.lit(0)), n)
    windows = alerts.select(
        *keys, F.col("rn").alias("alert_rn"),
        F.explode(F.sequence(first_bucket, bucket)).alias("_bucket"),
    )
    errors = rates.where("is_error").select(*keys, "rn", path, bucket.alias("_bucket"))
    counts = (
        null_safe_join(errors, windows, [*keys, "_bucket"])
        .where((F.col("rn") <= F.col("alert_rn")) & (F.col("rn") > F.col("alert_rn") - n))
        .groupBy(*keys, "alert_rn", path)
        .agg(F.count("*").alias("errors"))
    )
    top = Window.partitionBy("alert_rn").orderBy(F.col("errors").desc(), path)
    return counts.withColumn("place", F.row_number().over(top).cast("bigint")).where(F.col("place") <= k)
