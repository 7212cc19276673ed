"""Ranking, top-k and sessionization that stay distributed under skew.

Spark's ``Window`` with no ``partitionBy`` moves all rows to one task, and
``partitionBy(user)`` sends all rows of a hot user to one task.  The
operators here give the same answers as the plain SQL windows but bound
the rows any single task or the driver has to hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Sampled rows per range, and the most ranges an order is cut into.  Both are
# independent of the shuffle partitions: a session for 100 TB may have some
# 100,000 of those, while the bounds are literals of the plan.
_SAMPLE_PER_RANGE = 40
MAX_RANGES = 1000


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def range_bounds(df: DataFrame, order_cols: list[str], ranges: int) -> list:
    """At most ``ranges - 1`` rows of ``order_cols`` that cut the table's order into even ranges.

    Taken once from a sample whose size follows the number of ranges, not
    the data (40,000 rows at most), and sorted by one aggregate; the driver
    holds the bounds only as literals of the plan.
    """
    keys = df.select(F.struct(*order_cols).alias("key"))
    n = keys.count()
    want = ranges * _SAMPLE_PER_RANGE
    if n > 2 * want:
        keys = keys.sample(fraction=want / n, seed=7)
    rows = keys.agg(F.sort_array(F.collect_set("key")).alias("keys")).first()["keys"]
    step = max(1, len(rows) // ranges)
    return rows[step::step][:ranges - 1]


def _bucket(order_cols: list[str], bounds: list, schema) -> Column:
    """The number of bounds not above the row: a pure function of the row (binary search over literals)."""
    if not bounds:
        return F.lit(0)
    key = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(order_cols)])
    literal = F.array(*[F.struct(*[F.lit(v).cast(schema[c].dataType).alias(f"k{i}")
                                   for i, (c, v) in enumerate(zip(order_cols, r))]) for r in bounds])
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))])

    def search(at, step):
        there = at + step
        return F.when((there <= len(bounds)) & (F.get(literal, there - 1) <= key), there).otherwise(at)

    return F.aggregate(steps, F.lit(0), search)


def global_row_number(df: DataFrame, order_cols: list[str], num_partitions: int | None = None,
                      out: str = "row_number") -> DataFrame:
    """1-based position of each row in a total order, without a global window.

    The order is cut into ``num_partitions`` ranges (the shuffle partitions,
    MAX_RANGES at most, unless given) at bounds taken once from
    a sample and written into the plan as literals, so a row's range is a
    function of the row alone: the branch that counts rows per range and
    the branch that numbers rows within a range agree for any frame,
    whatever else it carries and however the two are executed.  The counts
    have one row per range; rows of a range are numbered by an ordinary
    window.  ``order_cols`` (column names, ascending, nulls first) must end
    with a unique key.
    """
    spark = df.sparkSession
    n = num_partitions or min(MAX_RANGES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    bounds = range_bounds(df, order_cols, n)
    ranged = df.withColumn("_part", _bucket(order_cols, bounds, df.schema))
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("_part").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
                           F.sum("_n").over(Window.partitionBy()).alias("_total"))
    inside = Window.partitionBy("_part").orderBy(*order_cols)
    return (ranged.withColumn("_pos", F.row_number().over(inside))
            .join(offsets, F.col("_part") == F.col("_of"))
            .withColumn(out, F.col("_offset") + F.col("_pos"))
            .drop("_part", "_pos", "_of", "_offset"))


def ntile_from_rank(rank: Column, total: Column, k: int) -> Column:
    """SQL ``ntile(k)`` from a 1-based rank and the row count.

    The first ``total % k`` tiles hold one row more than the rest.
    """
    q = (total / F.lit(k)).cast("bigint")
    rem = total - q * F.lit(k)
    big = rem * (q + F.lit(1))
    first = ((rank - F.lit(1)) / (q + F.lit(1))).cast("bigint") + F.lit(1)
    rest = rem + ((rank - F.lit(1) - big) / F.greatest(q, F.lit(1))).cast("bigint") + F.lit(1)
    return F.when(rank <= big, first).otherwise(rest)


def global_ntile(df: DataFrame, order_cols: list, k: int, out: str = "tile",
                 num_partitions: int | None = None) -> DataFrame:
    """``ntile(k) OVER (ORDER BY order_cols)`` computed in parallel."""
    ranked = global_row_number(df, order_cols, num_partitions, out="_rank")
    return (ranked.withColumn(out, ntile_from_rank(F.col("_rank"), F.col("_total"), k))
            .drop("_rank", "_total"))


def top_k_per_group(df: DataFrame, group_cols: list[str], order_cols: list, k: int, out: str = "rank") -> DataFrame:
    """Rows ranked 1..k inside each group, by a total order.

    Spark keeps the first k rows of a group in every task before the
    shuffle (a window group limit), so a hot group costs k rows a task.
    """
    order = Window.partitionBy(*group_cols).orderBy(*_cols(order_cols))
    ranked = df.withColumn(out, F.row_number().over(order)).filter(F.col(out) <= k)
    return ranked.withColumn(out, F.col(out).cast("bigint"))


def _micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 of a wall-clock (``timestamp_ntz``) value.

    Built from its date and clock fields, which do not depend on the session
    time zone (``timestamp_diff`` would convert through it and shift by an
    hour across daylight-saving changes).
    """
    t = ts.cast("timestamp_ntz")
    days = F.unix_date(F.to_date(t)).cast("bigint")
    secs = F.hour(t).cast("bigint") * 3600 + F.minute(t).cast("bigint") * 60
    frac = (F.date_part(F.lit("SECOND"), t) * F.lit(1_000_000)).cast("bigint")
    return (days * F.lit(86400) + secs) * F.lit(1_000_000) + frac


def sessionize(df: DataFrame, user: str, ts: str, tiebreak: str, gap_seconds: int = 1800,
               bucket_seconds: int = 3600, out: str = "session_no") -> DataFrame:
    """Gap-based session numbers per user (a new session after ``gap_seconds``
    without events), equal to ``sum(is_start) OVER (PARTITION BY user ORDER BY ts)``.

    Level 1 orders events inside (user, time bucket); level 2 orders the
    per-bucket summaries of each user (one row per active bucket) to carry
    the previous bucket's last event and session count across bucket
    borders.  A user with a third of all events is therefore ordered by
    many tasks, one per time bucket, not by one.  The bucket summary is
    read off the level-1 window output (its first row per bucket), so the
    events are scanned and shuffled once: both branches share one exchange
    (pass only the user, time and tie-break columns, plus nothing the
    bucket branch would prune, to keep that).  Rows with a null user or
    timestamp belong to no session (null number).
    """
    gap = gap_seconds * 1_000_000
    known = F.col(user).isNotNull() & F.col(ts).isNotNull()
    unknown = df.filter(~known).withColumn(out, F.lit(None).cast("bigint"))
    ev = (df.filter(known).withColumn("_t", _micros(F.col(ts)))
          # coalesce makes the bucket provably non-null, so no inferred
          # not-null filter is pushed into one branch only (that would stop
          # the two branches from sharing the events exchange).
          .withColumn("_b", F.coalesce(F.floor(F.col("_t") / F.lit(bucket_seconds * 1_000_000)).cast("bigint"),
                                       F.lit(0).cast("bigint"))))
    w1 = Window.partitionBy(user, "_b").orderBy("_t", tiebreak)
    whole = Window.partitionBy(user, "_b")
    inner = F.when(F.col("_t") - F.lag("_t").over(w1) > F.lit(gap), 1).otherwise(0)
    ev = (ev.withColumn("_inner", inner)
          .withColumn("_cum_inner", F.sum("_inner").over(w1.rowsBetween(Window.unboundedPreceding, 0)))
          .withColumn("_rn", F.row_number().over(w1))
          .withColumn("_last", F.max("_t").over(whole))
          .withColumn("_inner_starts", F.sum("_inner").over(whole)))
    w2 = Window.partitionBy(user).orderBy("_b")
    buckets = (ev.filter(F.col("_rn") == 1)
               # _first is _t of the first row, taken from the timestamp
               # itself so this branch reads the same columns as the other.
               .select(user, "_b", _micros(F.col(ts)).alias("_first"), "_last", "_inner_starts")
               .withColumn("_prev_last", F.lag("_last").over(w2))
               .withColumn("_first_start",
                           F.when(F.col("_prev_last").isNull() | (F.col("_first") - F.col("_prev_last") > F.lit(gap)), 1)
                           .otherwise(0))
               .withColumn("_starts_before",
                           F.coalesce(F.sum(F.col("_inner_starts") + F.col("_first_start"))
                                      .over(w2.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
               .select(user, "_b", "_first_start", "_starts_before"))
    numbered = (ev.join(buckets, [user, "_b"])
                .withColumn(out, (F.col("_starts_before") + F.col("_first_start") + F.col("_cum_inner"))
                            .cast("bigint"))
                .drop("_t", "_b", "_inner", "_cum_inner", "_rn", "_last", "_inner_starts", "_first_start",
                      "_starts_before"))
    return numbered.unionByName(unknown)


def ordered_funnel(df: DataFrame, user: str, ts: str, step_col: str, steps: list[str],
                   bucket_seconds: int = 300) -> DataFrame:
    """Users reaching each step of an ordered funnel: ``(step_no, step, users)``.

    Step i is reached at the first event of type ``steps[i]`` not before
    the time step i-1 was reached; events without user or time count for
    nobody; events of one moment count in the order of the steps.  The
    events are read and shuffled once, by (user, time bucket).  There the
    events of a moment become one set of bits, a bit per step they serve, and
    a bucket folds its moments, in time order, to a map from "steps reached
    before" to "steps reached after": a moment moves ``r`` to the first step
    from ``r`` on that it does not serve, which is bit arithmetic.  Each
    user's maps are then applied in time order.  The work is linear in the
    events of a bucket, and a user with a third of all events is spread over
    their buckets.  At most 62 steps.
    """
    k = len(steps)
    if k > 62:
        raise ValueError("a funnel has at most 62 steps")
    served = F.lit(None).cast("bigint")
    for step in dict.fromkeys(steps):
        bits = sum(1 << i for i, s in enumerate(steps) if s == step)
        served = F.when(F.col(step_col) == step, F.lit(bits).cast("bigint")).otherwise(served)
    bucket = F.floor(_micros(F.col(ts)) / F.lit(bucket_seconds * 1_000_000)).cast("bigint")
    ev = (df.filter(F.col(user).isNotNull() & F.col(ts).isNotNull() & F.col(step_col).isin(steps))
          .select(F.col(user).alias("_user"), bucket.alias("_b"), F.col(ts).alias("_ts"), served.alias("_bits")))
    # partitioned by (user, bucket) once: moments and buckets are both groups of that
    moments = ev.repartition("_user", "_b").groupBy("_user", "_b", "_ts").agg(F.bit_or("_bits").alias("_bits"))
    buckets = moments.groupBy("_user", "_b").agg(F.sort_array(F.collect_list(F.struct("_ts", "_bits"))).alias("_moments"))

    def through(reached, moment):
        open_ = F.bitwise_not(F.call_function("shiftright", moment["_bits"], reached))
        return reached + F.bit_count(open_.bitwiseAND(-open_) - 1)  # ones below the lowest zero

    def fold(start):
        return F.aggregate("_moments", start, through)

    maps = buckets.select("_user", "_b", F.transform(F.sequence(F.lit(0), F.lit(k)), fold).alias("_map"))
    users = maps.groupBy("_user").agg(F.sort_array(F.collect_list(F.struct("_b", "_map"))).alias("_maps"))
    done = users.select(F.aggregate("_maps", F.lit(0), lambda r, m: F.get(m["_map"], r)).alias("_done"))
    counts = done.agg(*[F.count(F.when(F.col("_done") >= i, 1)).alias(f"_{i}") for i in range(1, k + 1)])
    rows = F.array(*[F.struct(F.lit(i).alias("step_no"), F.lit(s).alias("step"), F.col(f"_{i}").alias("users"))
                     for i, s in enumerate(steps, start=1)])
    return counts.select(F.explode(rows).alias("_row")).select("_row.step_no", "_row.step", "_row.users")
