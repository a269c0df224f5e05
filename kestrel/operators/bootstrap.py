"""Customer-clustered bootstrap of the lift of each variant over the first arm.

Exact resampling (``method="draws"``): each replicate draws n customers with
replacement, sums their per-arm (events, successes), and takes rate
differences. Draw j of replicate r is ``idx = h(seed, r*n + j) mod n`` with a
deterministic integer hash, so a lost task recomputes the same draws, and the DuckDB
oracle reproduces them bit for bit (see ``draw_hash``).

Plan: the customer matrix gets a dense index 0..n-1 by customer_id (no single-task
row_number) and is cut into index ranges of ``RANGE_ROWS``. Each draw is made once: replicates and
blocks of draws are dealt over tasks, which sort a block's draws by range and send each range its
two-byte places as one message. A range's task keeps its rows in an array, adds up those that the messages hit, and passes
on one row of sums per replicate. So work and shuffle are linear in customers times replicates, no
task holds more than a range and a message, and nothing goes through the driver. Few ranges are
copied for several groups of replicates, so that all tasks have work.

``method="poisson"`` is the method for very many customers: every customer gets a
Poisson(1) weight per replicate (inverse CDF of the same hash), computed where the
customer is, in one pass without index or join; tasks pass on one row of sums
per replicate. Replicate sizes are then random, so it is labelled separately. Customers without an id are
one cluster; ids that are not integers are hashed before they are drawn for.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.config import BOOTSTRAP_SEED, EXPERIMENT_GROUPS, N_BOOTSTRAP
from kestrel.operators.quantiles import dense_index
from kestrel.session import materialize, ship_package

CI_PROBS = (0.025, 0.5, 0.975)
#: Customers of an index range (a place in it takes two bytes) and draws of one message's block.
RANGE_ROWS = 1 << 16
DRAWS_AT_ONCE = 1 << 20


def customer_matrix(counts: DataFrame, groups: Sequence[str] = EXPERIMENT_GROUPS) -> DataFrame:
    """One row per customer: n{i}, x{i} per listed arm (0 when absent). Rows of
    unlisted arms are dropped first."""
    g = F.col("experiment_group")
    aggs = []
    for i, name in enumerate(groups):
        aggs += [F.sum(F.when(g == name, F.col("total_events")).otherwise(0)).cast("bigint").alias(f"n{i}"),
                 F.sum(F.when(g == name, F.col("purchase_events")).otherwise(0)).cast("bigint").alias(f"x{i}")]
    return counts.filter(g.isin(list(groups))).groupBy("customer_id").agg(*aggs)


def indexed_matrix(matrix: DataFrame) -> DataFrame:
    """Adds ``idx`` = rank of customer_id (0-based) and ``n_customers``."""
    return dense_index(matrix, ["customer_id"], "idx", "n_customers")


# Fixed constants of the draw hash: two chains, each (prime below 2^31,
# first round (a, a_hi, b), then XOR rounds (k, a, b)).
DRAW_CHAINS = (
    (2147483647, (48271, 69621, 12345), ((0x1B873593, 16807, 67890), (0x2545F491, 40692, 13579))),
    (2147483629, (69069, 1103515245, 24680), ((0x3C6EF372, 22695477, 11223), (0x0F4A7C15, 134775813, 44556))),
)


def draw_hash(ids: np.ndarray, seed: int) -> np.ndarray:
    """Non-negative 62-bit hash of (seed, id) for ids >= 0. Each chain:
    t0 = (id mod p * a + (id div p) * a_hi + b) mod p, then
    t' = ((t XOR k) * a + b) mod p. Operands stay below 2^31 (id div p below
    2^32), products below 2^63: identical bits in any engine with 64-bit integers."""
    ids = ids.astype(np.int64) + seed * 7919
    out = np.zeros(len(ids), np.int64)
    for prime, (a, a_hi, b), rounds in DRAW_CHAINS:
        t = (ids % prime * a + ids // prime * a_hi + b) % prime
        for k, a_r, b_r in rounds:
            t = ((t ^ k) * a_r + b_r) % prime
        out = out * 2 ** 31 + t
    return out


def _lifts(sums: DataFrame, k: int) -> DataFrame:
    rate = [F.try_divide(F.col(f"x{i}").cast("double"), F.col(f"n{i}").cast("double")) for i in range(k)]
    return sums.select("rep", *[((rate[i] - rate[0]) * F.lit(100.0)).alias(f"lift_{i}") for i in range(1, k)])


def _value_columns(k: int) -> list[str]:
    return [c for i in range(k) for c in (f"n{i}", f"x{i}")]


def _sum_schema(k: int) -> str:
    return "rep bigint, " + ", ".join(f"{c} bigint" for c in _value_columns(k))


def _sum_batch(reps: np.ndarray, sums: np.ndarray, k: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(reps), *(pa.array(np.ascontiguousarray(c)) for c in sums.T)],
                                      names=["rep", *_value_columns(k)])


def bootstrap_replicates(counts: DataFrame, groups: Sequence[str] = EXPERIMENT_GROUPS,
                         n_boot: int = N_BOOTSTRAP, seed: int = BOOTSTRAP_SEED,
                         method: str = "draws", range_rows: int = RANGE_ROWS) -> DataFrame:
    """One row per replicate: rep, lift_1..lift_{k-1} (percentage points vs arm 0).
    A replicate that drew no events of an arm has a NULL lift."""
    k = len(groups)
    ship_package(counts.sparkSession)
    matrix = customer_matrix(counts, groups)
    if method == "poisson":
        return _lifts(_poisson_sums(matrix, k, n_boot, seed), k)
    if method != "draws":
        raise ValueError(method)
    return _lifts(_draw_sums(matrix, k, n_boot, seed, range_rows), k)


_MESSAGE = "cell bigint, rep bigint, places binary, rows binary"


def _messages(cells, reps, places, rows) -> pa.RecordBatch:
    """``cell``: index range and group of replicates; rep -1 for matrix rows; ``places`` in the range, two bytes each."""
    return pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(reps, pa.int64()), pa.array(places, pa.binary()), pa.array(rows, pa.binary())],
                                      names=["cell", "rep", "places", "rows"])


def _draw_sums(matrix: DataFrame, k: int, n_boot: int, seed: int, range_rows: int) -> DataFrame:
    spark, values = matrix.sparkSession, _value_columns(k)
    if not 0 < range_rows <= RANGE_ROWS:
        raise ValueError(f"range_rows must lie between 1 and {RANGE_ROWS}")
    indexed = materialize(indexed_matrix(matrix), "bootstrap-indexed-matrix")
    n = indexed.count()
    zeros = spark.range(n_boot).select(F.col("id").alias("rep"), *[F.lit(0).cast("bigint").alias(c) for c in values])
    if not n:
        return zeros
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranges = -(-n // range_rows)
    groups = max(1, min(n_boot, -(-tasks // ranges)))  # a range is copied for so many groups of replicates
    blocks = -(-n // DRAWS_AT_ONCE)

    def rows_of_ranges(batches):
        for batch in batches:
            idx = batch.column(0).to_numpy()
            m = np.column_stack([batch.column(i + 1).to_numpy() for i in range(len(values))])
            for r in np.unique(idx // range_rows).tolist():
                own = idx // range_rows == r
                place, row = (idx[own] % range_rows).astype("<u2").tobytes(), m[own].astype("<i8").tobytes()
                yield _messages([r * groups + g for g in range(groups)], [-1] * groups, [place] * groups, [row] * groups)

    def draws(batches):
        for batch in batches:
            for job in batch.column(0).to_pylist():
                rep, block = divmod(job, blocks)
                ids = rep * n + np.arange(block * DRAWS_AT_ONCE, min(n, (block + 1) * DRAWS_AT_ONCE), dtype=np.int64)
                at = np.sort(draw_hash(ids, seed) % n)
                hit, first = np.unique(at // range_rows, return_index=True)
                parts = [(p % range_rows).astype("<u2").tobytes() for p in np.split(at, first[1:])]
                yield _messages(hit * groups + rep % groups, [rep] * len(hit), parts, [b""] * len(hit))

    def add(batches):
        cell, m, sums = None, np.zeros((range_rows, len(values)), np.int64), {}

        def done():
            return _sum_batch(np.fromiter(sums, np.int64, len(sums)), np.array(list(sums.values()), np.int64).reshape(-1, len(values)), k)

        for batch in batches:
            for c, rep, places, rows in zip(*(x.to_pylist() for x in batch.columns)):
                if c != cell:
                    if sums:
                        yield done()
                    cell, sums = c, {}
                    m[:] = 0
                at = np.frombuffer(places, "<u2")
                if rep < 0:  # sorted before the draws
                    m[at] = np.frombuffer(rows, "<i8").reshape(-1, len(values))
                else:
                    sums[rep] = sums.get(rep, 0) + m[at].sum(0)
        if sums:
            yield done()

    sent = (spark.range(0, n_boot * blocks, 1, min(n_boot * blocks, 4 * tasks)).mapInArrow(draws, _MESSAGE)
            .unionByName(indexed.select("idx", *values).mapInArrow(rows_of_ranges, _MESSAGE)))
    parts = min(ranges * groups, tasks)
    summed = (sent.repartitionById(parts, F.pmod("cell", F.lit(parts)).cast("int")).sortWithinPartitions("cell", "rep")
              .mapInArrow(add, _sum_schema(k)))
    return summed.groupBy("rep").agg(*[F.sum(c).alias(c) for c in values])


#: Cluster ids for which Poisson weights are drawn lie below this (times the replicates, within the hash's range).
CLUSTER_IDS = 1 << 48


# Poisson(1) CDF: P(K <= m) = e^-1 * sum_{i<=m} 1/i!, tabulated by rule up to where it reaches 1.
def _poisson_cdf(max_k: int = 20) -> list[float]:
    out, acc = [], 0.0
    for m in range(max_k + 1):
        acc += math.exp(-1.0) / math.factorial(m)
        out.append(acc)
    return out


def _poisson_sums(matrix: DataFrame, k: int, n_boot: int, seed: int) -> DataFrame:
    """Per replicate the weighted sums: each task adds up its customers for all
    replicates, then n_boot rows per task are summed. The weight of customer c in
    replicate r is the Poisson quantile of h(seed, c * n_boot + r) / 2^62."""
    values = _value_columns(k)
    cdf = np.floor(np.array(_poisson_cdf()) * 2.0 ** 62).astype(np.int64)  # thresholds on the 62-bit hash

    def add(batches):
        sums = np.zeros((n_boot, len(values)), np.int64)
        for batch in batches:
            ids = batch.column(0).to_numpy()
            m = np.column_stack([batch.column(i + 1).to_numpy() for i in range(len(values))])
            for start in range(0, len(ids), 256):
                block = ids[start:start + 256]
                draw = draw_hash((block[:, None] * n_boot + np.arange(n_boot)).ravel(), seed)
                weight = np.searchsorted(cdf, draw, side="right").reshape(len(block), n_boot)
                sums += weight.T @ m[start:start + 256]
        yield _sum_batch(np.arange(n_boot), sums, k)

    who, top = F.col("customer_id"), F.lit(CLUSTER_IDS)
    number = who if isinstance(matrix.schema["customer_id"].dataType, T.IntegralType) else F.lit(-1)
    cluster = F.when(who.isNull(), top).when((number >= 0) & (number < top), number).otherwise(F.pmod(F.xxhash64(who), top)).cast("bigint")
    return (matrix.select(cluster.alias("cluster"), *values).mapInArrow(add, _sum_schema(k))
            .groupBy("rep").agg(*[F.sum(c).alias(c) for c in values]))


def bootstrap_ci(replicates: DataFrame, groups: Sequence[str] = EXPERIMENT_GROUPS) -> DataFrame:
    """Median and 2.5 / 97.5 percentiles (linear interpolation) of each lift.

    ``percentile`` gathers one value per replicate, a bound set by n_boot, not by
    the data. NULL lifts are skipped and the valid count is reported.
    """
    k = len(groups)
    stacked = replicates.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("cmp_idx"), F.lit(f"{groups[i]} vs {groups[0]}").alias("comparison"),
                 F.col(f"lift_{i}").alias("lift")) for i in range(1, k)])))
    q = F.percentile(F.col("lift"), F.array(*[F.lit(p) for p in CI_PROBS]))
    res = stacked.groupBy("cmp_idx", "comparison").agg(q.alias("q"), F.count("lift").alias("n_valid_replicates"))
    return res.select("cmp_idx", "comparison",
                      F.round(F.col("q")[1], 9).alias("median_lift_pp"),
                      F.round(F.col("q")[0], 9).alias("ci_2_5pct"),
                      F.round(F.col("q")[2], 9).alias("ci_97_5pct"),
                      F.col("n_valid_replicates").cast("bigint").alias("n_valid_replicates"))
