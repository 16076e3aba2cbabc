"""Ridge fits of many small groups from sums per quarter, for all origins at once.

A training row adds the outer product of ``z = [1, x, y]`` to its group's Gram. The
rows of a group move once, whatever the number of origins: the products are summed per
quarter, and the Gram of an origin is the weighted sum of the quarters before it (weight 1,
or the recency tier of the quarter's age). So a new origin adds terms; it copies no row.

Groups are dealt by key into a fixed number of partitions (adaptive coalescing, which
goes by bytes, would put all of them into one task) and sorted there by key and
quarter. A task solves them a stack at a time: one batched linear solve for all groups
and origins of a stack. A group is bounded by the calendar, a stack by ``STACK_BYTES``.
Everything is summed in the order of the quarters, so results do not depend on
partitioning.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ...functions.calendar import quarter_index
from ...session import ship_package
from ..features import OLDEST_WEIGHT, RECENCY_TIERS

LIVE_SHARE = 1e-12
STACK_BYTES = 32 << 20


def index_of(quarter: str) -> int:
    """Quarters since 1970Q1 of a ``YYYYQn`` label (as ``quarter_index`` counts them)."""
    return (int(quarter[:4]) - 1970) * 4 + int(quarter[5:]) - 1


def _start(index: int) -> dt.date:
    return dt.date(1970 + index // 4, index % 4 * 3 + 1, 1)


def quarter_weights(quarters: np.ndarray, cutoffs: Sequence[int], newest: Sequence[int | None] | None) -> np.ndarray:
    """Weight of every quarter (columns) for every origin (rows): 0 from the origin on,
    before it 1, or with ``newest`` (the newest training quarter of each origin) by age."""
    out = (quarters[None, :] < np.array(cutoffs)[:, None]).astype(np.float64)
    if newest is None:
        return out
    for row, last in zip(out, newest):
        for k in np.flatnonzero(row):
            age = (_start(last) - _start(int(quarters[k]))).days
            row[k] = next((w for bound, w in RECENCY_TIERS if age < bound), OLDEST_WEIGHT)
    return out


def solve_grams(g: np.ndarray, penalty: float | np.ndarray) -> np.ndarray:
    """Ridge coefficients ``[intercept, beta...]`` of a stack of augmented Grams
    ``(groups, m+2, m+2)`` of ``[1, x, y]``; NaN where a group has no row.

    Features are centred and scaled to unit variance; the penalty (one, or one per
    feature) is per observation on the standardised coefficients, the intercept is free.
    Judged by its own size, the fit is the same in any currency unit. A feature without variance, judged against its own mean square, gets 0.
    """
    m = g.shape[1] - 2
    n = g[:, 0, 0]
    some = n > 0
    size = np.where(some, n, 1.0)
    mean, ybar = g[:, 0, 1:m + 1] / size[:, None], g[:, 0, m + 1] / size
    sxx = g[:, 1:m + 1, 1:m + 1] / size[:, None, None] - mean[:, :, None] * mean[:, None, :]
    sxy = g[:, 1:m + 1, m + 1] / size[:, None] - mean * ybar[:, None]
    var = np.clip(np.einsum("gii->gi", sxx), 0.0, None)
    live = var > LIVE_SHARE * np.einsum("gii->gi", g)[:, 1:m + 1] / size[:, None]
    sd = np.sqrt(np.where(live, var, 1.0))
    both = live[:, :, None] & live[:, None, :]
    a = np.where(both, sxx / (sd[:, :, None] * sd[:, None, :]), 0.0)
    at = np.arange(m)
    a[:, at, at] += np.where(live, np.broadcast_to(penalty, (m,)), 1.0)
    b = np.where(live, sxy / sd, 0.0)
    beta = np.linalg.solve(a, b[:, :, None])[:, :, 0] / sd if m else np.zeros((len(g), 0))
    beta = np.where(live, beta, 0.0)
    out = np.concatenate([(ybar - (mean * beta).sum(1))[:, None], beta], axis=1)
    out[~some] = np.nan
    return out


# --- groups of a sorted partition --------------------------------------------------

def _starts(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """Row where each group begins (rows sorted by the keys)."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for key in keys:
        codes = pc.fill_null(table[key].combine_chunks().dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(new)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str], rows: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups, about ``rows`` rows each, with the row each group begins at."""
    held: list = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(pa.Table.from_batches([batch]))
        size += batch.num_rows
        while size >= rows:
            table = pa.concat_tables(held)
            starts = _starts(table, keys)
            end = starts[np.searchsorted(starts, rows, side="right") - 1]
            if end == 0:  # one long group so far
                if len(starts) < 2:
                    break
                end = starts[1]
            yield table.slice(0, end), starts[starts < end]
            held, size = [table.slice(end)], size - int(end)
    if size:
        table = pa.concat_tables(held)
        yield table, _starts(table, keys)


def stacked_grams(z: np.ndarray, quarter: np.ndarray, starts: np.ndarray, cutoffs: Sequence[int],
                  newest: Sequence[int | None] | None) -> np.ndarray:
    """``(groups, origins, m+2, m+2)``: each origin's Gram of every group. Rows come sorted
    by group and quarter."""
    lengths = np.diff(np.append(starts, len(z)))
    width = z.shape[1]
    products = (z[:, :, None] * z[:, None, :]).reshape(len(z), width * width)
    if newest is None:  # weights are 0 or 1: sums between neighbouring origins, then prefix sums
        ranked = np.argsort(np.array(cutoffs), kind="stable")
        segment = np.searchsorted(np.array(cutoffs)[ranked], quarter, side="right")
        cell = np.repeat(np.arange(len(starts)), lengths) * (len(cutoffs) + 1) + segment
        found, first = np.unique(cell, return_index=True)
        sums = np.zeros((len(starts) * (len(cutoffs) + 1), width * width))
        sums[found] = np.add.reduceat(products, first, axis=0)
        out = np.empty((len(starts), len(cutoffs), width * width))
        out[:, ranked] = np.cumsum(sums.reshape(len(starts), -1, width * width)[:, :-1], axis=1)
    else:
        quarters, column = np.unique(quarter, return_inverse=True)
        weights = quarter_weights(quarters, cutoffs, newest)[:, column]
        out = np.stack([np.add.reduceat(products * w[:, None], starts, axis=0) for w in weights], axis=1)
    return out.reshape(len(starts), len(cutoffs), width, width)


# --- the Spark side ----------------------------------------------------------------

def partitions(spark: SparkSession) -> int:
    """Tasks to deal groups to: every core gets some, whatever their bytes."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def deal(rows: DataFrame, keys: Sequence[str], order: str = "quarter") -> DataFrame:
    """Rows dealt by key, whole groups together and in the order of their quarters."""
    return rows.repartition(partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys, order)


def newest_quarters(rows: DataFrame, origins: Sequence[str]) -> list[int | None]:
    """Newest quarter before each origin over all rows: one value per origin."""
    row = rows.agg(*[F.max(F.when(F.col("quarter") < o, quarter_index("quarter"))) for o in origins]).head()
    return list(row)


def fit(rows: DataFrame, keys: Sequence[str], features: Sequence[str], target: str, penalty, origins: Sequence[str] | None = None,
        recency: bool = False, with_gram: bool = False) -> DataFrame:
    """``keys, beta`` of every group, or ``origin, keys, beta`` for every origin that has a row
    of the group before it. Rows lacking a feature or the target are left out. ``penalty`` is
    one number or one per feature; ``with_gram`` adds the Gram (``gram``, row-major)."""
    if recency and origins is None:
        raise ValueError("recency weights are relative to an origin")
    keys, columns = list(keys), [*features, target]
    complete = rows.dropna(subset=columns)
    cutoffs = [index_of(o) for o in origins] if origins is not None else [1 << 30]
    newest = newest_quarters(complete, origins) if recency else None
    penalty = np.asarray(penalty, np.float64)
    narrow = complete.select(*keys, quarter_index("quarter").cast("int").alias("_q"),
                             *[F.col(c).cast("double").alias(f"_x{k}") for k, c in enumerate(columns)])
    fields = [narrow.schema[k] for k in keys] + [T.StructField("beta", T.ArrayType(T.DoubleType()))]
    if origins is not None:
        fields = [T.StructField("origin", T.StringType()), *fields]
    if with_gram:
        fields.append(T.StructField("gram", T.ArrayType(T.DoubleType())))
    width = len(columns) + 1
    per_stack = max(64, STACK_BYTES // (8 * width * width))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, keys, per_stack):
            x = [table[f"_x{k}"].to_numpy() for k in range(len(columns))]
            z = np.column_stack([np.ones(table.num_rows), *x])
            g = stacked_grams(z, table["_q"].to_numpy().astype(np.int64), starts, cutoffs, newest)
            g = g.reshape(-1, width, width)
            some = np.flatnonzero(g[:, 0, 0] > 0)
            own = table.select(keys).take(pa.array(np.repeat(starts, len(cutoffs))[some]))
            out = [own[k].combine_chunks() for k in keys]
            if origins is not None:
                out = [pa.array([origins[k] for k in some % len(cutoffs)], pa.string()), *out]
            out.append(pa.array(list(solve_grams(g[some], penalty)), pa.list_(pa.float64())))
            if with_gram:
                out.append(pa.array(list(g[some].reshape(len(some), -1)), pa.list_(pa.float64())))
            yield pa.RecordBatch.from_arrays(out, [f.name for f in fields])

    ship_package(rows.sparkSession)
    return deal(narrow, keys, "_q").mapInArrow(solve, T.StructType(fields))


def advance(grams: DataFrame, rows: DataFrame, keys: Sequence[str], features: Sequence[str], target: str, penalty,
            since: str, origin: str) -> DataFrame:
    """``origin, keys, beta, gram`` of a later origin from the Grams of the origin ``since``
    and only the rows of the quarters from there on: the new quarters' terms are added."""
    keys = list(keys)
    later = rows.where((F.col("quarter") >= since) & (F.col("quarter") < origin))
    new = fit(later, keys, features, target, penalty, [origin], with_gram=True).select(*keys, F.col("gram").alias("_new"))
    old = grams.where(F.col("origin") == since).select(*keys, F.col("gram").alias("_old"))
    total = F.coalesce(F.zip_with("_old", "_new", lambda a, b: a + b), "_old", "_new")
    both = old.join(new, keys, "full").select(F.lit(origin).alias("origin"), *keys, total.alias("gram"))
    width = len(features) + 2
    schema = T.StructType([*both.schema.fields[:-1], T.StructField("beta", T.ArrayType(T.DoubleType())), both.schema["gram"]])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                g = batch.column("gram").flatten().to_numpy().reshape(-1, width, width)
                beta = list(solve_grams(g, np.asarray(penalty, np.float64)))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(beta, pa.list_(pa.float64())),
                                                  batch.column("gram")], schema.names)

    return both.mapInArrow(solve, schema)
