"""A sample whose category shares follow given targets.

Weights are raked over the tribunal, language and period margins of the cells by
iterative proportional fitting, every record draws an exponential key with its
weight, and the smallest keys are taken. Cells short of their minimum are topped up
and what can't be met is reported by what was drawn. Only histograms of keys by cell,
whose size doesn't depend on the records, come to the driver: the bin that holds a
cell's cut-off is divided again until what is left of it is small enough to be sorted.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casemill.session import materialise

#: The most target cells that a call takes: with BINS, the bound of what the driver holds.
MAX_CELLS = 2_000
#: Bins of the histogram of keys: this many for each halving of a key, over so many halvings.
PER_HALVING, HALVINGS = 16, 64
#: Rows around a cell's cut-off that one task sorts, and the parts into which more are divided at once.
MAX_SORTED, PARTS = 100_000, 1_024


class TargetSample(NamedTuple):
    """sample: the chosen rows with target_id; report: one row for each target cell."""

    sample: DataFrame
    report: DataFrame


def in_cells(records: DataFrame, targets: DataFrame) -> DataFrame:
    """(target_id, row): the records in a cell, each as one column, so that no names can clash."""
    rows = records.select(F.struct(*records.columns).alias("row"))
    date = F.substring("row.publication_date", 1, 4)
    own = rows.select(
        "row",
        F.lower("row.tribunal").alias("tribunal"),
        F.substring(F.lower(F.regexp_replace("row.language", r"(?U)^\s+|\s+\z", "")), 1, 2).alias("language"),
        F.when(date.rlike(r"^\d{4}$"), date).cast("int").alias("year"),
    )
    cells = F.broadcast(targets.select("target_id", "tribunal", "language", "year_from", "year_to"))
    return own.join(cells, ["tribunal", "language"]).where("year BETWEEN year_from AND year_to").select("target_id", "row")


def rake(have: np.ndarray, want: np.ndarray, margins: list[np.ndarray], rounds: int = 200) -> np.ndarray:
    """Expected rows of each cell: ``have`` scaled until its margins are those of ``want``.

    ``margins`` gives each cell's category, once for each margin. Cells without rows
    stay at none, so margins which only they could fill stay short.
    """
    fitted = have.astype(float)
    for _ in range(rounds):
        last = fitted.copy()
        for group in margins:
            now, goal = np.bincount(group, fitted), np.bincount(group, want)
            fitted *= np.where(now > 0, goal / np.where(now > 0, now, 1), 0)[group]
        if np.allclose(fitted, last, rtol=1e-9, atol=1e-12):
            break
    return fitted


def quotas(below: np.ndarray, floor: np.ndarray, have: np.ndarray, size: int) -> np.ndarray:
    """Rows to take of each cell: ``below``, raised to ``floor``, as near to ``size`` as cells allow.

    The surplus that raising makes is taken from cells above their floor, in
    proportion to what they have above it, the largest remainders first.
    """
    take = np.minimum(np.maximum(below, np.minimum(floor, have)), have).astype(np.int64)
    spare = take - np.minimum(floor, have)
    excess = min(int(take.sum()) - size, int(spare.sum()))
    if excess > 0:
        cut = spare * excess / spare.sum()
        least = np.floor(cut).astype(np.int64)
        for k in np.argsort(least - cut, kind="stable")[: excess - int(least.sum())]:
            least[k] += 1
        take -= least
    room = have - take
    for k in np.argsort(-room, kind="stable"):
        more = min(int(room[k]), size - int(take.sum()))
        take[k] += max(0, more)
    return take


def target_sample(records: DataFrame, targets: DataFrame, size: int, seed: int = 17, key: str = "id") -> TargetSample:
    """Draws about ``size`` rows of ``records`` with the shares of ``targets``.

    Columns of the report: those of targets, available, needed, sampled, raked (the
    expected rows by raking), gap (needed - sampled where positive, else 0). Needed
    is the greater of min_rows and target_share * size, rounded to six decimals and
    then up. A record whose tribunal, language or date fits no cell is never drawn;
    repeated rows are each drawn on their own; empty records give an empty sample and
    a report of gaps. NULL in target_share or min_rows counts as 0. A column target_id of
    ``records`` itself is left out of the sample; a map column can't be compared and
    is an error.
    """
    spark = records.sparkSession
    cells = targets.limit(MAX_CELLS + 1).collect()
    if len(cells) > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS} target cells")
    cells.sort(key=lambda c: c["target_id"])
    # equal rows are counted, then told apart by number, so that a row which is there often is never sorted
    inside = in_cells(records, targets).groupBy("target_id", "row").agg(F.count(F.lit(1)).alias("n"))
    h = F.xxhash64(F.lit(seed), "row", "_twin")
    # the place of a row in the order of keys, as an integer: the key is its exponential form
    unit = (F.lit(2**53 - 1) - F.col("_v") + F.lit(0.5)) / F.lit(float(2**53))
    draws = inside.select("target_id", "row", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("_twin"))
    draws = draws.withColumn("_v", F.lit(2**53 - 1) - F.shiftrightunsigned(h, 11)).withColumn("_e", -F.log(unit))

    at = {c["target_id"]: k for k, c in enumerate(cells)}
    span = PER_HALVING * HALVINGS
    bin_of = F.floor(F.log2("_e") * PER_HALVING).cast("int")
    bin_of = F.greatest(F.least(bin_of, F.lit(8 * PER_HALVING - 1)), F.lit(8 * PER_HALVING - span))
    histogram = draws.groupBy("target_id", bin_of.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high")).collect()
    counts = np.zeros((len(cells), span), np.int64)
    places: dict[tuple[int, int], tuple[int, int]] = {}
    for row in histogram:
        cell = at[row["target_id"]], row["b"] + span - 8 * PER_HALVING
        counts[cell] = row["n"]
        places[cell] = row["low"], row["high"] + 1
    have = counts.sum(axis=1)
    want = np.array([(c["target_share"] or 0.0) * size for c in cells])
    needed = np.array([math.ceil(round(max(c["min_rows"] or 0, w), 6)) for c, w in zip(cells, want, strict=True)], np.int64)
    margins = []
    for of in (lambda c: c["tribunal"], lambda c: c["language"], lambda c: (c["year_from"], c["year_to"])):
        index: dict = {}
        margins.append(np.array([index.setdefault(of(c), len(index)) for c in cells], np.int64))
    raked = rake(have, want, margins) if len(cells) else np.zeros(0)

    # the size smallest keys e / weight: the cut-off key is where the cells' shares below it sum to size
    weight = np.where(have > 0, raked / np.maximum(have, 1), 0)
    edges = 2.0 ** ((np.arange(span) + 1 - span + 8 * PER_HALVING) / PER_HALVING)
    cumulative = counts.cumsum(axis=1)

    def below(cut: float) -> np.ndarray:
        place = np.searchsorted(edges, cut * weight, "right")
        return np.where(place > 0, cumulative[np.arange(len(cells)), np.maximum(place - 1, 0)], 0)

    low, high = 0.0, 1.0
    while len(cells) and below(high).sum() < min(size, have[weight > 0].sum()) and high < 1e30:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (low, middle) if len(cells) and below(middle).sum() >= size else (middle, high)
    take = quotas(below(high), needed, have, size) if len(cells) else np.zeros(0, np.int64)

    # whole bins below each cell's cut-off bin; in that bin the rows before a part, and the first of the part
    full, low, high, rest, within = [], [], [], [], []
    for k in range(len(cells)):
        b = int(np.searchsorted(cumulative[k], take[k], "right"))
        first, last = places.get((k, b), (0, 0))
        full.append(b - span + 8 * PER_HALVING)
        low.append(first)
        high.append(last)
        rest.append(int(take[k]) - (int(cumulative[k][b - 1]) if b else 0))
        within.append(int(counts[k][b]) if b < span else 0)
    marked = draws.withColumn("_b", bin_of)
    while wide := [k for k in range(len(cells)) if within[k] > MAX_SORTED and rest[k] > 0 and high[k] - low[k] > 1]:
        step = {k: -(-(high[k] - low[k]) // PARTS) for k in wide}
        bounds = spark.createDataFrame(
            [(cells[k]["target_id"], full[k], low[k], high[k], step[k]) for k in wide], "target_id bigint, _bin int, _low bigint, _high bigint, _step bigint"
        )
        inner = marked.join(F.broadcast(bounds), "target_id").where("_b = _bin AND _v >= _low AND _v < _high")
        part = F.expr("CAST((_v - _low) DIV _step AS INT)")
        parts = np.zeros((len(cells), PARTS), np.int64)
        for r in inner.groupBy("target_id", part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect():
            parts[at[r["target_id"]], r["p"]] = r["n"]
        for k in wide:
            so_far = parts[k].cumsum()
            p = int(np.searchsorted(so_far, rest[k], "left"))
            rest[k] -= int(so_far[p - 1]) if p else 0
            within[k] = int(parts[k][p])
            low[k], high[k] = low[k] + p * step[k], min(high[k], low[k] + (p + 1) * step[k])
    plan = spark.createDataFrame(
        [(c["target_id"], full[k], low[k], high[k], rest[k]) for k, c in enumerate(cells)],
        "target_id bigint, _bin int, _low bigint, _high bigint, _rest bigint",
    )
    marked = marked.join(F.broadcast(plan), "target_id")
    rank = F.row_number().over(Window.partitionBy("target_id").orderBy("_v", F.col("row")[key], "_twin"))
    chosen = (
        marked.where("_b < _bin OR (_b = _bin AND _v < _low)")
        .select("target_id", "row")
        .unionByName(
            marked.where("_b = _bin AND _v >= _low AND _v < _high AND _rest > 0").withColumn("_r", rank).where("_r <= _rest").select("target_id", "row")
        )
    )
    chosen = materialise(chosen)
    sample = chosen.select("target_id", *(F.col("row")[c].alias(c) for c in records.columns if c != "target_id"))
    drawn = {r["target_id"]: r["n"] for r in chosen.groupBy("target_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = []
    for k, c in enumerate(cells):
        n = drawn.get(c["target_id"], 0)
        rows.append((c["target_id"], int(have[k]), int(needed[k]), n, float(raked[k]), max(0, int(needed[k]) - n)))
    report = targets.join(
        F.broadcast(spark.createDataFrame(rows, "target_id bigint, available bigint, needed bigint, sampled bigint, raked double, gap bigint")),
        "target_id",
    )
    return TargetSample(sample, report)
