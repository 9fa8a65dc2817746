"""Top N items within every group, by partition lower bounds.

The N-th best item that one partition holds of a group is a lower bound for the group's N-th
best over all partitions.  Groups of at least 1 / HOT of all rows, so at most HOT of them, get such
bounds: every partition sends at most one for each, and the largest bound of a group is broadcast
and filters its rows before anything is shuffled.  The survivors are ranked by a window with a limit
that keeps N rows of a group per partition, so a group with a third of all rows moves at most N
rows per partition instead of millions, and groups too small for a bound move no more than that.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from docketry.runtime import cut, effective_case_id, table

#: Groups of at least 1 / HOT of all rows, and of 20 N rows, get bounds; so many rows are broadcast at most.
HOT = 10_000


def _beats_or_equals(order: list[tuple[str, bool]], bound: str) -> F.Column:
    """Row >= bound in the given order (name, descending), as nested comparisons."""
    keep = F.lit(True)
    for name, desc in reversed(order):
        mine, its = F.col(name), F.col(f"{bound}.{name}")
        keep = ((mine > its) if desc else (mine < its)) | ((mine == its) & keep)
    return keep


def top_n_per_group(df: DataFrame, group: str, order: list[tuple[str, bool]], n: int, rank: str = "rnk") -> DataFrame:
    """The first n rows of every group in a total order, with their rank from 1.

    order: (column, descending) pairs; the last ones must make it total, else ties are settled by
    nothing.  Rows with a null in the group or in an order column are left out; NaN counts as null.
    Repeated rows are rows of their own.  An empty table gives an empty result.  Columns besides
    group and order pass through; one named like ``rank`` is replaced.
    """
    names = [c for c, _ in order]
    whole = df.drop(rank) if rank in df.columns and rank not in names + [group] else df
    for c in [group, *names]:
        whole = whole.where(F.col(c).isNotNull())
        if dict(whole.dtypes)[c] in ("double", "float"):
            whole = whole.where(~F.isnan(c))
    fields = {f.name: f for f in whole.schema.fields}
    keyed = T.StructType([T.StructField(c, fields[c].dataType) for c in [group, *names]])

    def local_bounds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Keeps n rows per group of what the partition has shown so far; folds in large steps."""
        kept, waiting, size = None, [], 0

        def fold() -> pd.DataFrame:
            x = pd.concat(([] if kept is None else [kept]) + waiting, ignore_index=True)
            return x.sort_values(names, ascending=[not d for _, d in order]).groupby(group, sort=False).head(n)

        for b in batches:
            waiting.append(b)
            size += len(b)
            if size >= 100_000:
                kept, waiting, size = fold(), [], 0
        if waiting:
            kept = fold()
        if kept is not None and len(kept):
            place = kept.groupby(group, sort=False).cumcount()
            yield kept[place == n - 1]

    # the larger bound is the one that comes first in the order
    ranked = Window.partitionBy(group).orderBy(*[F.desc(c) if d else F.asc(c) for c, d in order])
    counts = cut(whole.groupBy(group).agg(F.count("*").alias("_c")), "counts")
    least = max(20 * n, -(-(counts.agg(F.sum("_c")).first()[0] or 0) // HOT))
    hot = counts.where(F.col("_c") >= least).select(group)
    kept = whole
    if not hot.isEmpty():
        bounds = whole.select(group, *names).join(F.broadcast(hot), group, "left_semi").mapInPandas(local_bounds, keyed)
        best = bounds.withColumn("_r", F.row_number().over(ranked)).where("_r = 1").select(F.col(group).alias("_g"), F.struct(*names).alias("_bound"))
        best = cut(best, "bounds")  # at most HOT rows
        kept = whole.join(F.broadcast(best), F.col(group) == F.col("_g"), "left").where(F.col("_bound").isNull() | _beats_or_equals(order, "_bound")).drop("_g", "_bound")
    # rank() over a total order with a limit is pushed below the shuffle (window group limit)
    return kept.withColumn(rank, F.row_number().over(ranked)).where(F.col(rank) <= n)


def p7_found(spark, folder: str) -> DataFrame:
    """The five best amounts of every case by votes, value, doc_id and amount_id."""
    amounts = table(spark, folder, "cash_amounts").select("amount_id", "doc_id", "case_id", "value", "feature_votes")
    amounts = amounts.withColumn("case_id", effective_case_id())
    order = [("feature_votes", True), ("value", True), ("doc_id", False), ("amount_id", False)]
    return top_n_per_group(amounts.withColumn("doc_id", F.coalesce("doc_id", F.lit(""))), "case_id", order, 5).select("case_id", "rnk", "amount_id")


P7_SQL = r"""
WITH a AS (
  SELECT lower(coalesce(nullif(trim(case_id, ' ' || chr(9) || chr(10) || chr(13)), ''),
               nullif(trim(split_part(doc_id, '_', 1), ' ' || chr(9) || chr(10) || chr(13)), ''))) AS case_id,
         amount_id, coalesce(doc_id, '') AS doc_id, value, feature_votes
  FROM cash_amounts WHERE value IS NOT NULL AND NOT isnan(value) AND feature_votes IS NOT NULL),
r AS (SELECT case_id, amount_id, CAST(row_number() OVER (PARTITION BY case_id
        ORDER BY feature_votes DESC, value DESC, doc_id, amount_id) AS INTEGER) AS rnk
      FROM a WHERE case_id IS NOT NULL)
SELECT case_id, rnk, amount_id FROM r WHERE rnk <= 5
"""
