"""Latest-k look-back: aggregates over the k newest history rows at or before a date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stage_table

# Pieces that time is cut into, however many query dates there are.
CUTS = 4096


def _micros(c: str):
    return F.unix_micros(F.col(c).cast("timestamp")).cast("double")


def _cut_points(pairs: DataFrame, query_date: str, cuts: int) -> tuple[list[float], bool]:
    """Query dates that divide them into pieces of about equal size, and whether these are all of them."""
    times = pairs.select(_micros(query_date).alias("t")).where("t IS NOT NULL").distinct()
    few = [r.t for r in times.limit(cuts + 1).collect()]
    if len(few) <= cuts:
        return sorted(few), True
    probs = [i / (cuts - 1) for i in range(cuts)]
    return sorted(set(times.approxQuantile("t", probs, 1 / (2 * cuts)))), False


def _in_pieces(df: DataFrame, date: str, points: Sequence[float]) -> DataFrame:
    """``_piece``: time is cut into (previous point, this point]; a larger number is earlier.

    The bucketizer's ranges are closed on the left, so the time is negated.
    """
    splits = [float("-inf"), *sorted(-p for p in points), float("inf")]
    piece = Bucketizer(splits=splits, inputCol="_neg", outputCol="_at", handleInvalid="keep")
    timed = piece.transform(df.withColumn("_neg", -_micros(date)))
    return timed.withColumn("_piece", F.col("_at").cast("int")).drop("_neg", "_at")


def visible_history(
    history: DataFrame,
    queries: DataFrame,
    key: str = "Customer_ID",
    query_date: str = "feature_snapshot_date",
    date: str = "snapshot_date",
) -> DataFrame:
    """The rows that a look-back from ``queries`` can see: of their keys, up to each key's last query date.

    One equi-join on the key, with one row for each; a look-back of what is left gives the same rows.
    """
    last = queries.groupBy(F.col(key).alias("_key")).agg(F.max(_micros(query_date)).alias("_last"))
    return history.join(last, (F.col(key) == F.col("_key")) & (_micros(date) <= F.col("_last")), "left_semi")


def lookback(
    queries: DataFrame,
    history: DataFrame,
    columns: Sequence[str],
    key: str = "Customer_ID",
    query_date: str = "feature_snapshot_date",
    date: str = "snapshot_date",
    tie_break: str | None = None,
    k: int = 6,
    cuts: int = CUTS,
) -> DataFrame:
    """Mean, max and sum of each column over the k newest rows with ``date <= query_date``.

    One row per distinct (key, query_date). Without any such row everything is 0;
    with rows that hold only NULL the mean and max are NULL and the sum is 0. Equal
    dates are ordered by ``tie_break`` (the value columns where none is given), so
    the result does not depend on row order.

    Time is cut into pieces that end at query dates. Of one key's rows inside a piece
    only the newest k matter to the date at its end and to all later pieces; Spark
    applies that limit inside the map tasks, so a key holding a third of all rows sends
    at most k rows per piece and task. What a piece needs of earlier ones is carried
    into it: k rows per key and piece. Pieces with query dates before their end (with
    more distinct dates than cut points) get all their rows as well. The look-back
    itself runs inside (key, piece): history and query rows are laid in one sequence,
    query rows after history rows of the same instant, and a numeric frame over the
    running number of history rows picks the k newest. There is no range join, no pair
    per history row, and no window over all rows of a key.
    """
    order = [date, *([tie_break] if tie_break else columns)]
    keep = list(dict.fromkeys([key, *order, *columns]))
    # Stored, as the dates, the marks of the pieces and the query rows are read from them.
    pairs = stage_table(queries.select(key, query_date).where(F.col(key).isNotNull()).distinct(), "asked")
    points, complete = _cut_points(pairs, query_date, cuts)
    past = history.select(*keep).where(F.col(key).isNotNull() & F.col(date).isNotNull())
    past = _in_pieces(past, date, points).where(F.col("_piece") > 0)
    asked = _in_pieces(pairs, query_date, points)
    newest_first = W.partitionBy(key, "_piece").orderBy(*[F.col(c).desc() for c in order])
    newest = past.withColumn("_rn", F.row_number().over(newest_first)).where(F.col("_rn") <= k).drop("_rn")
    # What is carried and what stays in its piece come from the same rows.
    newest = stage_table(newest, "newest")
    if complete:
        # Every piece ends at its only query date.
        places, needed = asked.select(key, "_piece"), newest
    else:
        # One row per cut point, made here.
        ends = pairs.sparkSession.createDataFrame([(p,) for p in points], "_end double")
        at_end = asked.join(F.broadcast(ends), _micros(query_date) == F.col("_end"), "left")
        places = at_end.groupBy(key, "_piece").agg(F.bool_or(F.col("_end").isNull()).alias("_inside"))
        needed = newest.join(places.where("NOT _inside"), [key, "_piece"], "left_semi").unionByName(
            past.join(places.where("_inside"), [key, "_piece"], "left_semi")
        )
    rows = (
        _carried(newest, places, key, keep, order, k)
        .unionByName(needed)
        .withColumn("_is_query", F.lit(0))
        .unionByName(
            asked.select(key, "_piece", F.col(query_date).alias(date), F.lit(1).alias("_is_query")), allowMissingColumns=True
        )
    )
    in_time = W.partitionBy(key, "_piece").orderBy(date, "_is_query", *order[1:]).rowsBetween(W.unboundedPreceding, 0)
    numbered = rows.withColumn("_n", F.sum(1 - F.col("_is_query")).over(in_time))
    frame = W.partitionBy(key, "_piece").orderBy("_n").rangeBetween(-(k - 1), 0)
    found = numbered.select(
        key,
        F.col(date).alias(query_date),
        "_is_query",
        "_n",
        *[f(c).over(frame).alias(f"{c}_{name}") for c in columns for name, f in _FUNCTIONS],
    ).where(F.col("_is_query") == 1)
    none = F.col("_n") == 0
    return found.select(
        key,
        query_date,
        *[
            F.when(none, F.lit(0.0)).otherwise(F.coalesce(n, F.lit(0.0)) if n.endswith("_sum") else F.col(n)).alias(n)
            for n in lookback_names(columns)
        ],
    )


def _carried(newest: DataFrame, places: DataFrame, key: str, keep: Sequence[str], order: Sequence[str], k: int) -> DataFrame:
    """For each (key, piece) asked for, the k newest rows of earlier pieces.

    ``newest`` holds at most k rows per key and piece, so one key has no more of them
    than k times the number of pieces.
    """
    marks = places.select(key, "_piece", F.lit(1).alias("_mark"))
    line = newest.withColumn("_mark", F.lit(0)).unionByName(marks, allowMissingColumns=True)
    # From early to late; a piece's mark stands before its own rows.
    along = W.partitionBy(key).orderBy(F.col("_piece").desc(), F.col("_mark").desc(), *order).rowsBetween(W.unboundedPreceding, 0)
    line = line.withColumn("_n", F.sum(1 - F.col("_mark")).over(along))
    frame = W.partitionBy(key).orderBy("_n").rangeBetween(-(k - 1), 0)
    row = F.when(F.col("_mark") == 0, F.struct(*[c for c in keep if c != key]))
    gathered = line.withColumn("_rows", F.collect_list(row).over(frame)).where("_mark = 1")
    return gathered.select(key, "_piece", F.inline("_rows"))


_FUNCTIONS = (("mean", F.avg), ("max", F.max), ("sum", F.sum))


def lookback_names(columns: Sequence[str]) -> list[str]:
    return [f"{c}_{name}" for c in columns for name, _ in _FUNCTIONS]


def add_lookback(
    df: DataFrame,
    history: DataFrame,
    columns: Sequence[str],
    key: str = "Customer_ID",
    query_date: str = "feature_snapshot_date",
    **options,
) -> DataFrame:
    """``df`` with the look-back columns of its (key, query_date)."""
    found = lookback(df, history, columns, key, query_date, **options)
    return df.join(found, [key, query_date], "left")
