"""Bins per feature: counting, and merging fine bins into few monotone ones."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

Cuts = Mapping[str, Sequence[float]]
Grouping = Callable[[Sequence[tuple[int, int]], int, int], list[tuple[int, int]]]

MISSING = -1
FINE_CELLS = 200  # quantile cells that the tree sees
MAX_PREBINS = 20
MAX_BINS = 10
MIN_BIN_SHARE = 0.05
SKETCH_ACCURACY = 20_000  # rank error below a hundredth of a fine cell
GAIN_DIGITS = 9


def prebin_cuts(df: DataFrame, features: Sequence[str], max_bins: int = MAX_PREBINS) -> dict[str, list[float]]:
    """Distinct interior quantiles of each feature; features without values are left out.

    One pass with one sketch per feature; only the cut points reach the driver.
    """
    shares = [i / max_bins for i in range(1, max_bins)]
    found = df.agg(
        *[F.percentile_approx(F.col(c).cast("double"), shares, SKETCH_ACCURACY).alias(c) for c in features]
    ).first()
    return {c: sorted(set(found[c])) for c in features if found[c]}


def bin_counts(df: DataFrame, cuts: Cuts, label: str = "TARGET") -> DataFrame:
    """Rows and bad rows per feature and bin; bin -1 holds the missing values.

    Each task counts its own rows and passes on at most one row per feature and bin.
    Generated code for the hundreds of limits would be too large to be compiled.
    """
    features = list(cuts)
    limits = [np.asarray(cuts[c], dtype=float) for c in features]
    slots = max(len(values) for values in limits) + 2

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.zeros((2, len(features), slots))
        for batch in batches:
            labels = batch["label"].to_numpy(dtype=float)
            for i, feature in enumerate(features):
                values = batch[feature].to_numpy(dtype=float)
                slot = np.where(np.isnan(values), 0, np.searchsorted(limits[i], values, side="right") + 1)
                held[0, i] += np.bincount(slot, minlength=slots)
                held[1, i] += np.bincount(slot, weights=labels, minlength=slots)
        which, slot = np.nonzero(held[0])
        rows, bad = held[:, which, slot]
        yield pd.DataFrame({"number": which, "bin": slot - 1, "n": rows, "bad": bad})

    counted = (
        df.select(F.col(label).alias("label"), *[F.col(c).cast("double").alias(c) for c in features])
        .mapInPandas(count, "number int, bin int, n bigint, bad bigint")
        .groupBy("number", "bin")
        .agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    )
    names = F.array(*[F.lit(c) for c in features])
    return counted.select(names[F.col("number")].alias("feature"), "bin", "n", "bad")


def smoothed_woe(good: float, bad: float, all_good: float, all_bad: float) -> tuple[float, float]:
    """WOE and IV of one bin; an empty cell counts as half a row."""
    share_good = max(good, 0.5) / max(all_good, 0.5)
    share_bad = max(bad, 0.5) / max(all_bad, 0.5)
    woe = math.log(share_good / share_bad)
    return woe, (share_good - share_bad) * woe


def tree_grouping(
    cells: Sequence[tuple[int, int]], max_leaves: int = MAX_PREBINS, min_share: float = MIN_BIN_SHARE
) -> list[tuple[int, int]]:
    """Split consecutive cells (rows, bad) as a decision tree would; the leaves as ranges.

    The leaf whose best cut lowers the Gini impurity of all rows most is split next, until
    there are ``max_leaves`` or no cut helps that leaves ``min_share`` of the rows on both
    sides. Equal gains are told apart by position, after rounding.
    """
    n = np.concatenate([[0], np.cumsum([r for r, _ in cells])])
    bad = np.concatenate([[0], np.cumsum([b for _, b in cells])])
    least = max(min_share * n[-1], 1)

    def mixed(rows: np.ndarray, bads: np.ndarray) -> np.ndarray:
        return bads * (rows - bads) / np.maximum(rows, 1)

    def best_cut(start: int, end: int) -> tuple[float, int]:
        at = np.arange(start + 1, end)
        left, left_bad = n[at] - n[start], bad[at] - bad[start]
        right, right_bad = n[end] - n[at], bad[end] - bad[at]
        whole = mixed(n[end] - n[start], bad[end] - bad[start])
        gain = np.round(whole - mixed(left, left_bad) - mixed(right, right_bad), GAIN_DIGITS)
        gain = np.where((left >= least) & (right >= least), gain, 0.0)
        return (float(gain.max()), int(at[gain.argmax()])) if len(at) else (0.0, end)

    leaves = {(0, len(cells)): best_cut(0, len(cells))}
    while len(leaves) < max_leaves:
        (start, end), (gain, at) = min(leaves.items(), key=lambda leaf: (-leaf[1][0], leaf[0]))
        if gain <= 0:
            break
        del leaves[start, end]
        leaves |= {(start, at): best_cut(start, at), (at, end): best_cut(at, end)}
    return sorted(leaves)


def best_grouping(
    rows: Sequence[tuple[int, int]],
    all_rows: int,
    all_bad: int,
    max_bins: int,
    min_share: float,
    turns: int = 0,
) -> list[tuple[int, int]]:
    """Split consecutive fine bins (rows, bad) into ranges with the highest total IV.

    Ranges hold at least ``min_share`` of all rows and their bad rate rises or falls
    throughout; with one of ``turns`` it may also rise to a peak and fall, or fall to a
    valley and rise. A state is the last range and whether the trend has turned; the best
    total of each is kept per number of ranges. Without an admissible split all bins form
    one range.
    """
    size = len(rows)
    n, bad = [0], [0]
    for rows_in_bin, bad_in_bin in rows:
        n.append(n[-1] + rows_in_bin)
        bad.append(bad[-1] + bad_in_bin)

    value, rate = {}, {}
    for start in range(size):
        for end in range(start + 1, size + 1):
            count, bads = n[end] - n[start], bad[end] - bad[start]
            if count > 0 and count >= min_share * all_rows:
                value[start, end] = smoothed_woe(count - bads, bads, all_rows - all_bad, all_bad)[1]
                rate[start, end] = bads / count

    best_total, best_ranges = -1.0, [(0, size)]
    for direction in (1, -1):
        # (last range, turns made) -> (total IV, ranges), for a growing number of ranges
        layer = {(r, 0): (v, [r]) for r, v in value.items() if r[0] == 0}
        for _ in range(max_bins):
            for ((_, end), _), (total, ranges) in layer.items():
                if end == size and total > best_total:
                    best_total, best_ranges = total, ranges
            grown: dict[tuple[tuple[int, int], int], tuple[float, list[tuple[int, int]]]] = {}
            for (last, turned), (total, ranges) in layer.items():
                for end in range(last[1] + 1, size + 1):
                    new = (last[1], end)
                    if new not in value:
                        continue
                    step = (rate[new] - rate[last]) * direction
                    for now in range(turned, turns + 1):
                        if (step if now % 2 == 0 else -step) < 0:
                            continue
                        if (new, now) not in grown or total + value[new] > grown[new, now][0]:
                            grown[new, now] = (total + value[new], [*ranges, new])
            layer = grown
    return best_ranges


def grouped_bins(counts: DataFrame, cuts: Cuts, grouping: Grouping) -> DataFrame:
    """Merge cells of each feature into ranges; returns feature, bin, low, high, n, bad.

    ``grouping`` sees one feature's cells (rows, bad) at a time, a few hundred at most, and
    the rows and bad rows of all its values, missing ones too.
    """
    limits = {c: [None, *values, None] for c, values in cuts.items()}

    def merge(table: pd.DataFrame) -> pd.DataFrame:
        feature = table["feature"].iloc[0]
        edges = limits[feature]
        all_rows, all_bad = int(table["n"].sum()), int(table["bad"].sum())
        held = {b: (int(n), int(bad)) for b, n, bad in zip(table["bin"], table["n"], table["bad"], strict=True)}
        cells = [held.get(b, (0, 0)) for b in range(len(edges) - 1)]
        out = []
        for number, (start, end) in enumerate(grouping(cells, all_rows, all_bad)):
            inside = cells[start:end]
            out.append((number, edges[start], edges[end], sum(r for r, _ in inside), sum(b for _, b in inside)))
        if MISSING in held:
            out.append((MISSING, None, None, *held[MISSING]))
        merged = pd.DataFrame(out, columns=["bin", "low", "high", "n", "bad"])
        merged.insert(0, "feature", feature)
        return merged.astype({"low": "float64", "high": "float64"})

    merged = counts.groupBy("feature").applyInPandas(
        merge, "feature string, bin int, low double, high double, n bigint, bad bigint"
    )
    # pandas marks a missing limit with NaN
    return merged.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("low", "high")})


def merge_bins(
    counts: DataFrame,
    cuts: Cuts,
    max_bins: int = MAX_BINS,
    min_share: float = MIN_BIN_SHARE,
    turns: int = 0,
) -> DataFrame:
    """Cells of each feature to leaves of a tree, and those to few bins with a trend."""

    def grouping(cells: Sequence[tuple[int, int]], all_rows: int, all_bad: int) -> list[tuple[int, int]]:
        leaves = tree_grouping(cells, MAX_PREBINS, min_share)
        sums = [(sum(r for r, _ in cells[a:b]), sum(x for _, x in cells[a:b])) for a, b in leaves]
        ranges = best_grouping(sums, all_rows, all_bad, max_bins, min_share, turns)
        return [(leaves[a][0], leaves[b - 1][1]) for a, b in ranges]

    return grouped_bins(counts, cuts, grouping)


def tree_bins(counts: DataFrame, cuts: Cuts, max_leaves: int = MAX_PREBINS) -> DataFrame:
    """The leaves of each feature's tree as bins."""
    return grouped_bins(counts, cuts, lambda cells, *_: tree_grouping(cells, max_leaves))


def woe_table(counts: DataFrame) -> DataFrame:
    """Append ``woe`` and ``iv`` to rows of (feature, bin, n, bad)."""
    feature = Window.partitionBy("feature")  # a few dozen rows each
    floor = F.lit(0.5)
    bad = F.greatest(F.col("bad").cast("double"), floor)
    good = F.greatest((F.col("n") - F.col("bad")).cast("double"), floor)
    all_bad = F.greatest(F.sum("bad").over(feature).cast("double"), floor)
    all_good = F.greatest(F.sum(F.col("n") - F.col("bad")).over(feature).cast("double"), floor)
    return (
        counts.withColumns({"_good": good / all_good, "_bad": bad / all_bad})
        .withColumn("woe", F.ln(F.col("_good") / F.col("_bad")))
        .withColumn("iv", (F.col("_good") - F.col("_bad")) * F.col("woe"))
        .drop("_good", "_bad")
    )


def information_values(woe: DataFrame) -> DataFrame:
    """Features by information value, highest first."""
    return (
        woe.groupBy("feature").agg(F.round(F.sum("iv"), 6).alias("IV")).orderBy(F.desc("IV"), "feature")
    )


def select_by_iv(ivs: DataFrame, wanted: float = 0.02, fallback: float = 0.005) -> DataFrame:
    """Features with enough information; a lower bar if none clears the first."""
    strongest = ivs.agg(F.max("IV")).scalar()
    bar = F.when(strongest >= wanted, F.lit(wanted)).otherwise(F.lit(fallback))
    return ivs.where(F.col("IV") >= bar)


def optimal_bins(
    train: DataFrame, features: Sequence[str], label: str = "TARGET", turns: int = 0
) -> DataFrame:
    """Merged bins with WOE and IV for every feature that has values.

    ``turns`` is how often the trend of a feature's bad rate may turn, 0 or 1.
    """
    cuts = prebin_cuts(train, features, FINE_CELLS)
    return woe_table(merge_bins(bin_counts(train, cuts, label), cuts, turns=turns))


def woe_expression(feature: str, bins: Iterable[Row]) -> str:
    """SQL expression from a feature to its WOE; missing or unbinned values give 0."""
    ordered = sorted((b for b in bins if b.bin != MISSING), key=lambda b: b.bin)
    if not ordered:
        return "0e0"
    steps = [f"WHEN `{feature}` < {b.high!r}D THEN {b.woe!r}D" for b in ordered if b.high is not None]
    last = ordered[-1]
    rest = f"{last.woe!r}D" if last.high is None else "0e0"
    return f"CASE WHEN `{feature}` IS NULL THEN 0e0 {' '.join(steps)} ELSE {rest} END"


def woe_expressions(woe: DataFrame, features: Sequence[str]) -> dict[str, str]:
    """``woe_expression`` per feature; the collected bin table has a few hundred rows."""
    rows = woe.where(F.col("feature").isin(list(features))).collect()
    return {f: woe_expression(f, [r for r in rows if r.feature == f]) for f in features}


def woe_transform(df: DataFrame, woe: DataFrame, features: Sequence[str]) -> DataFrame:
    """Replace each feature by its WOE in one projection."""
    sql = woe_expressions(woe, features)
    return df.withColumns({f: F.expr(sql[f]) for f in features})


def with_limits(counts: DataFrame, cuts: Cuts) -> DataFrame:
    """Append the ``low`` and ``high`` limits of each bin to rows of (feature, bin, ...)."""
    spark = counts.sparkSession
    rows = []
    for feature, values in cuts.items():
        edges = [None, *[float(v) for v in values], None]
        rows += [(feature, i, edges[i], edges[i + 1]) for i in range(len(edges) - 1)]
    limits = spark.createDataFrame(rows, "feature string, bin int, low double, high double")
    return counts.join(F.broadcast(limits), ["feature", "bin"], "left")
