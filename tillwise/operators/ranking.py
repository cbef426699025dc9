"""Global rank, NTILE and exact quantiles without a single-partition sort.

``NTILE(k) OVER (ORDER BY x)`` with no PARTITION BY makes Spark move every
row into one partition (``Exchange SinglePartition``).  Here the global
position of each row is computed in parallel instead:

1. ``repartitionByRange`` on the full sort key (ending in a unique column, so
   a value shared by a third of the rows still spreads over many ranges),
   ``sortWithinPartitions``, and a ``monotonically_increasing_id`` whose high
   bits are the partition index and low 33 bits the position inside it;
2. a reliable ``checkpoint`` so the sampled range bounds and the ids are
   fixed once (a recomputation could draw other bounds);
3. one row count per partition, turned into running offsets -- a table with
   at most ``num_partitions`` rows, which is what gets broadcast;
4. global rank = offset of the partition + position inside it.

NTILE is then column arithmetic on the rank.  Cost: one range shuffle and
one checkpoint write of the ranked rows.

Exact (interpolating) quantiles need the values at two ranks only, so they
do not rank the whole column: a mergeable sketch narrows each wanted rank
to a value band, a counting pass proves the band holds it, and only the
band rows are ranked (the whole column is ranked only if a proof fails).
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_LOW_BITS = (1 << 33) - 1

#: Rows of one range partition; the number of ranges follows the ranked rows, not the session.
ROWS_PER_RANGE = 1_000_000


def ranges_for(rows: int, num_partitions: int | None = None, rows_per_range: int = ROWS_PER_RANGE) -> int:
    return num_partitions or max(1, -(-rows // rows_per_range))


def global_rank(df: DataFrame, order: list[Column], rank_col: str = "_rank",
                count_col: str = "_n", num_partitions: int | None = None,
                materialize_input: bool = True) -> DataFrame:
    """Add the 0-based position of each row in ``order`` and the total row count.

    Runs jobs when called: a count (which sizes the ranges: one per
    ``ROWS_PER_RANGE`` rows), a sampling job for the bounds, the shuffle.  With ``materialize_input`` the input is
    persisted (memory and disk) for exactly those reads, so an expensive
    upstream -- an aggregate over all lines -- runs once; it is released as
    soon as the ranked rows are checkpointed.  A lost cached block is simply
    recomputed: the input is deterministic, only the ranked rows (sampled
    bounds, ids) need the reliable checkpoint.  Pass False when the input is
    already cheap to read.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    src = df.persist(StorageLevel.MEMORY_AND_DISK) if materialize_input else df
    try:
        k = num_partitions or ranges_for(src.count())
        placed = (src.repartitionByRange(k, *order)
                     .sortWithinPartitions(*order)
                     .withColumn("_mid", F.monotonically_increasing_id())
                     .checkpoint(eager=True))
    finally:
        if materialize_input:
            src.unpersist()
    pid = F.shiftright("_mid", 33)
    counts = placed.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_cnt"))
    # at most k rows: a single-partition window and a broadcast are bounded by k
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
        F.sum("_cnt").over(Window.partitionBy()).alias(count_col))
    return (placed.join(F.broadcast(offsets), pid == F.col("_pid"))
                  .withColumn(rank_col, F.col("_off") + F.col("_mid").bitwiseAND(F.lit(_LOW_BITS)))
                  .drop("_pid", "_off", "_mid"))


def ntile_of_rank(rank: Column, n: Column, buckets: int) -> Column:
    """SQL NTILE from a 0-based rank: the first ``n % k`` buckets get one row more."""
    q = F.floor(n / F.lit(buckets)).cast("bigint")
    m = (n % F.lit(buckets)).cast("bigint")
    big = m * (q + 1)
    idx = F.when(rank < big, F.floor(rank / (q + 1))) \
           .otherwise(m + F.floor((rank - big) / F.greatest(q, F.lit(1))))
    return (idx + 1).cast("int")


def ntile(df: DataFrame, buckets: int, order: list[Column], out_col: str,
          num_partitions: int | None = None, materialize_input: bool = True) -> DataFrame:
    """``NTILE(buckets) OVER (ORDER BY order)`` as a new column, computed in parallel.

    ``order`` must end in a unique column for the result to be repeatable.
    """
    if buckets < 1:
        raise ValueError("buckets must be positive")
    r = global_rank(df, order, "_rank", "_n", num_partitions, materialize_input)
    return (r.withColumn(out_col, ntile_of_rank(F.col("_rank"), F.col("_n"), buckets))
             .drop("_rank", "_n"))


def ntiles(df: DataFrame, buckets: int, key: str, values: list[str], out_cols: list[str],
           num_partitions: int | None = None, materialize_input: bool = True) -> DataFrame:
    """``NTILE(buckets) OVER (ORDER BY v DESC, key ASC)`` for several columns v
    at once: the input columns plus one score column per value.

    ``key`` must be unique.  Each row is stacked once per value, tagged with
    the value's index; one global rank orders the stacked rows by (index,
    that value DESC in its own type, key), so every value's rows form one
    contiguous run of ``n`` ranks.  One range shuffle and one checkpoint
    serve all the scores (instead of one each), and a hash aggregate on the
    unique key puts the row back together.
    """
    if buckets < 1:
        raise ValueError("buckets must be positive")
    cols = df.columns
    m = F.col("_m")
    stacked = df.select(*cols, F.explode(F.sequence(F.lit(0), F.lit(len(values) - 1))).alias("_m"))
    order = [m.asc()] + [F.when(m == i, F.col(v)).desc() for i, v in enumerate(values)]
    r = global_rank(stacked, order + [F.col(key).asc()], "_rank", "_n", num_partitions,
                    materialize_input)
    n = (F.col("_n") / F.lit(len(values))).cast("bigint")   # exact: _n is len(values) * n
    score = ntile_of_rank(F.col("_rank") - m * n, n, buckets)
    keep = [F.max(F.when(m == 0, F.col(c))).alias(c) for c in cols if c != key]
    scores = [F.max(F.when(m == i, score)).alias(o) for i, o in enumerate(out_cols)]
    return r.groupBy(key).agg(*keep, *scores).select(*cols, *out_cols)


def weighted_positions(df: DataFrame, order: list[Column], weight: str,
                       num_partitions: int | None = None) -> DataFrame:
    """Add ``_start`` (the summed ``weight`` of all rows before each row in
    ``order``) and ``_total`` (the summed weight of all rows).

    Rows must be unique by ``order``.  Like ``global_rank``: range
    partitions fixed by a reliable checkpoint, per-partition totals turned
    into running offsets (a table of at most ``num_partitions`` rows, the
    only thing broadcast), plus a running sum inside each range.  Run on
    (value, count) rows it ranks a column whose values repeat: a value held
    by a third of the rows is one row here, so no range holds it whole.

    Runs jobs when called.  The running sums partition by range number, one
    more exchange after the checkpoint, where two ranges may share a task:
    small for the band it is meant for, dear when a whole column falls back
    to it.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    src = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        k = num_partitions or ranges_for(src.count())
        placed = (src.repartitionByRange(k, *order)
                     .withColumn("_pid", F.spark_partition_id())
                     .checkpoint(eager=True))
    finally:
        src.unpersist()
    w = F.col(weight)
    totals = placed.groupBy("_pid").agg(F.sum(w).alias("_tot"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", F.coalesce(F.sum("_tot").over(before), F.lit(0)).alias("_off"),
                            F.sum("_tot").over(Window.partitionBy()).alias("_total"))
    inside = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (placed.withColumn("_in", F.coalesce(F.sum(w).over(inside), F.lit(0)))
                  .join(F.broadcast(offsets), "_pid")
                  .withColumn("_start", F.col("_off") + F.col("_in"))
                  .drop("_pid", "_off", "_in"))


def exact_quantiles(df: DataFrame, column: str, probs: list[float],
                    names: list[str] | None = None,
                    num_partitions: int | None = None,
                    materialize_input: bool = True,
                    method: str = "band", accuracy: int = 10_000) -> DataFrame:
    """One row: linear-interpolated quantiles of a column, nulls ignored.

    Same definition as ``percentile``/``median`` in Spark, ``quantile_cont``
    in SQL engines and the pandas default: position h = (n-1)p, value
    x[floor h] + (h - floor h)(x[ceil h] - x[floor h]).  Unlike the built-in
    exact percentile, no task ever holds all values.

    ``method="band"`` (default) is an exact selection that does not sort
    the column: a one-pass mergeable sketch (``percentile_approx``) gives a
    narrow value band around each wanted rank, one counting pass checks
    that the ranks really fall inside it, and only the band rows (about
    ``6 / accuracy`` of the column) are range-ranked.  If a check fails the
    whole column is ranked instead, so the result is exact in every case.
    ``method="sort"`` always ranks the whole column.
    """
    names = names or [f"q{i}" for i in range(len(probs))]
    if method not in ("band", "sort"):
        raise ValueError("method must be 'band' or 'sort'")
    vals = df.select(F.col(column).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    if method == "sort":
        return _quantiles_by_sort(vals, probs, names, num_partitions)
    src = vals.persist(StorageLevel.MEMORY_AND_DISK) if materialize_input else vals
    try:
        out = _quantiles_by_band(src, probs, names, num_partitions, accuracy)
        if out is None:
            out = _quantiles_by_sort(src, probs, names, num_partitions)
        return out
    finally:
        if materialize_input:
            src.unpersist()


def _pick(ranked: DataFrame, targets: list[tuple], names: list[str]) -> DataFrame:
    """Interpolate between the values at two ranks, keeping only those rows.

    Each row of ``ranked`` is a distinct value ``_v`` covering the ranks
    ``_start`` .. ``_start + _c - 1``.  ``targets`` holds (low rank, high
    rank, fraction) per output, each a column or a literal.
    """
    def covers(r):
        return (F.col("_start") <= r) & (r < F.col("_start") + F.col("_c"))

    aggs, keep = [], None
    for (lo, hi, frac), name in zip(targets, names):
        cond = covers(lo) | covers(hi)
        keep = cond if keep is None else (keep | cond)
        v_lo = F.max(F.when(covers(lo), F.col("_v")))
        v_hi = F.max(F.when(covers(hi), F.col("_v")))
        aggs.append(F.when(v_lo == v_hi, v_lo).otherwise(v_lo + (v_hi - v_lo) * frac).alias(name))
    return ranked.filter(keep).agg(*aggs)


def _quantiles_by_sort(vals: DataFrame, probs: list[float], names: list[str],
                       num_partitions: int | None) -> DataFrame:
    """Rank the whole column: distinct values with their counts (map-side
    combined), weighted positions, then the two values around each rank."""
    d = vals.groupBy("_v").agg(F.count(F.lit(1)).alias("_c"))
    r = weighted_positions(d, [F.col("_v").asc()], "_c", num_partitions)
    targets = []
    for p in probs:
        h = (F.col("_total") - 1).cast("double") * F.lit(float(p))
        lo = F.floor(h)
        targets.append((lo, F.ceil(h), F.max(h - lo)))
    return _pick(r, targets, names)


def _quantiles_by_band(vals: DataFrame, probs: list[float], names: list[str],
                       num_partitions: int | None, accuracy: int) -> DataFrame | None:
    """The band selection of ``exact_quantiles``; None when a band misses its ranks.

    Only scalars reach the driver: the row count, two sketch values and
    two counts per quantile.
    """
    eps = 3.0 / accuracy   # three times the sketch's rank error on each side
    inf = float("inf")
    asks = sorted({x for p in probs for x in (p - eps, p + eps) if 0.0 < x < 1.0})
    first = [F.count(F.lit(1)).alias("n")]
    if asks:
        first.append(F.percentile_approx("_v", F.array(*[F.lit(x) for x in asks]), accuracy)
                      .alias("e"))
    stats = vals.agg(*first).first()
    n = stats["n"]
    if n == 0:
        return vals.agg(*[F.max("_v").alias(name) for name in names])
    sketch = dict(zip(asks, stats["e"])) if asks else {}
    bands = [(sketch.get(p - eps, -inf), sketch.get(p + eps, inf)) for p in probs]
    v = F.col("_v")
    counts = vals.agg(*[c for i, (a, b) in enumerate(bands) for c in (
        F.count_if(v < F.lit(a)).alias(f"below{i}"),
        F.count_if((v >= F.lit(a)) & (v <= F.lit(b))).alias(f"inside{i}"))]).first()
    targets, offset = [], 0
    for i, p in enumerate(probs):
        h = float(n - 1) * float(p)
        lo, hi = math.floor(h), math.ceil(h)
        below, inside = counts[f"below{i}"], counts[f"inside{i}"]
        if not (below <= lo and below + inside >= hi + 1):
            return None
        # band i holds global ranks below .. below + inside - 1; in the ranked
        # band rows it starts at ``offset``
        targets.append((F.lit(offset + lo - below), F.lit(offset + hi - below), F.lit(h - lo)))
        offset += inside
    member = F.filter(F.array(*[F.when((v >= F.lit(a)) & (v <= F.lit(b)), F.lit(i))
                                for i, (a, b) in enumerate(bands)]), lambda x: x.isNotNull())
    rows = (vals.select(F.explode(member).alias("_band"), "_v")
                .groupBy("_band", "_v").agg(F.count(F.lit(1)).alias("_c")))
    r = weighted_positions(rows, [F.col("_band").asc(), F.col("_v").asc()], "_c", num_partitions)
    return _pick(r, targets, names)


def exact_quantiles_many(df: DataFrame, specs: list[tuple[str, float, str]],
                         num_partitions: int | None = None, materialize_input: bool = True,
                         accuracy: int = 10_000) -> DataFrame:
    """One row: exact interpolated quantiles of several columns, from one
    set of passes.

    ``specs`` holds (column, probability, output name).  The columns are
    stacked as (column index, value) rows; one pass takes every column's
    count and sketch, one pass counts every band, and one weighted rank
    covers every band (or, if a band misses its ranks, every column whole).
    A column with no value gives null.  Same results as ``exact_quantiles``
    per column, with three passes in all instead of three per column.
    """
    cols = list(dict.fromkeys(c for c, _, _ in specs))
    idx = {c: i for i, c in enumerate(cols)}
    ci, v = F.col("_ci"), F.col("_v")
    stacked = (df.select(F.explode(F.array(*[
                    F.struct(F.lit(i).alias("_ci"), F.col(c).cast("double").alias("_v"))
                    for i, c in enumerate(cols)])).alias("_s"))
                 .select("_s._ci", "_s._v").filter(v.isNotNull()))
    src = stacked.persist(StorageLevel.MEMORY_AND_DISK) if materialize_input else stacked
    try:
        eps, inf = 3.0 / accuracy, float("inf")
        asks = {i: sorted({x for c, p, _ in specs if idx[c] == i for x in (p - eps, p + eps)
                           if 0.0 < x < 1.0}) for i in range(len(cols))}
        first = []
        for i in range(len(cols)):
            first.append(F.count_if(ci == i).alias(f"n{i}"))
            if asks[i]:
                first.append(F.percentile_approx(F.when(ci == i, v), F.array(
                    *[F.lit(x) for x in asks[i]]), accuracy).alias(f"e{i}"))
        st = src.agg(*first).first()
        ns = [st[f"n{i}"] for i in range(len(cols))]
        bands = []
        for c, p, _ in specs:
            i = idx[c]
            sk = dict(zip(asks[i], st[f"e{i}"])) if asks[i] and st[f"e{i}"] is not None else {}
            bands.append((i, sk.get(p - eps, -inf), sk.get(p + eps, inf)))
        counts = src.agg(*[x for j, (i, a, b) in enumerate(bands) for x in (
            F.count_if((ci == i) & (v < F.lit(a))).alias(f"below{j}"),
            F.count_if((ci == i) & (v >= F.lit(a)) & (v <= F.lit(b))).alias(f"inside{j}"))]).first()
        targets, offset, proved = [], 0, True
        for j, (c, p, _) in enumerate(specs):
            n = ns[idx[c]]
            if n == 0:
                targets.append((F.lit(-1), F.lit(-1), F.lit(0.0)))   # no row covers -1: null
                continue
            h = float(n - 1) * float(p)
            lo, hi = math.floor(h), math.ceil(h)
            below, inside = counts[f"below{j}"], counts[f"inside{j}"]
            if not (below <= lo and below + inside >= hi + 1):
                proved = False
                break
            targets.append((F.lit(offset + lo - below), F.lit(offset + hi - below), F.lit(h - lo)))
            offset += inside
        names = [name for _, _, name in specs]
        if proved:
            member = F.filter(F.array(*[
                F.when((ci == i) & (v >= F.lit(a)) & (v <= F.lit(b)), F.lit(j))
                for j, (i, a, b) in enumerate(bands)]), lambda x: x.isNotNull())
            rows = (src.select(F.explode(member).alias("_band"), "_v")
                       .groupBy("_band", "_v").agg(F.count(F.lit(1)).alias("_c")))
            r = weighted_positions(rows, [F.col("_band").asc(), F.col("_v").asc()], "_c",
                                   num_partitions)
            return _pick(r, targets, names)
        # a band missed its ranks: rank every column whole, columns one after another
        starts = [sum(ns[:i]) for i in range(len(cols))]
        targets = []
        for c, p, _ in specs:
            n, base = ns[idx[c]], starts[idx[c]]
            if n == 0:
                targets.append((F.lit(-1), F.lit(-1), F.lit(0.0)))
                continue
            h = float(n - 1) * float(p)
            lo, hi = math.floor(h), math.ceil(h)
            targets.append((F.lit(base + lo), F.lit(base + hi), F.lit(h - lo)))
        d = src.groupBy("_ci", "_v").agg(F.count(F.lit(1)).alias("_c"))
        r = weighted_positions(d, [ci.asc(), v.asc()], "_c", num_partitions)
        return _pick(r, targets, names)
    finally:
        if materialize_input:
            src.unpersist()
