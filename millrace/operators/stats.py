"""Statistics over columns and vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import ChiSquareTest, Correlation
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace import scratch
from millrace.operators.skew import _bytes, salted_join


def pair_stats(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Pearson correlation and sample covariance of two columns, per key or overall."""
    return df.groupBy(*keys).agg(F.corr(x, y).alias("corr"), F.covar_samp(x, y).alias("cov"))


def column_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column: count, max, min, mean, L1 and L2 norm, non-zeros, sample variance.

    One pass, all columns in one aggregate.
    """
    packed = []
    for c in cols:
        x = F.col(c).cast("double")
        packed.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(x).alias("n"),
                F.max(x).alias("max"),
                F.min(x).alias("min"),
                F.avg(x).alias("mean"),
                F.sum(F.abs(x)).alias("norm_l1"),
                F.sqrt(F.sum(x * x)).alias("norm_l2"),
                F.count_if(x != 0).alias("non_zeros"),
                F.var_samp(x).alias("variance"),
            )
        )
    return df.agg(F.array(*packed).alias("rows")).select(F.explode("rows").alias("r")).select("r.*")


def correlation_matrix(df: DataFrame, cols: Sequence[str], method: str) -> DataFrame:
    """Correlation of every pair of columns as rows ``(i, j, r)``; ``pearson`` or ``spearman``.

    The matrix is columns × columns, whatever the number of rows.
    """
    if method == "spearman":
        return _rank_correlation(df.select(*cols), list(cols))
    vectors = VectorAssembler(inputCols=list(cols), outputCol="v").transform(df.select(*cols))
    matrix = Correlation.corr(vectors, "v", "pearson").first()[0].toArray()
    cells = [(a, b, float(matrix[i][j])) for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return df.sparkSession.createDataFrame(cells, "i string, j string, r double")


def _counted_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values with their number of rows, laid out in ascending ranges of the value."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return scratch.cut(counts.repartitionByRange(col))


def _ranks_of(counted: DataFrame, col: str) -> DataFrame:
    """Places within a range come from a window over that range, places before it from one
    row count per range."""
    ordered = counted.withColumn("_part", F.spark_partition_id())
    per_part = ordered.groupBy("_part").agg(F.sum("n").alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_part.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_part").orderBy(col).rowsBetween(Window.unboundedPreceding, -1)
    place = F.col("_start") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    return ordered.join(F.broadcast(starts), "_part").select(
        col, (place + (F.col("n") + 1) / 2).alias("rank"), "n"
    )


def average_ranks(df: DataFrame, col: str) -> DataFrame:
    """``(col, rank, n)`` per distinct value; equal values share the mean of their places. Values
    are counted before they are sorted, so copies of a value never move."""
    return _ranks_of(_counted_values(df, col), col)


#: Bytes of a value with its rank in a broadcast table, about.
_RANK_BYTES = 32


def _rank_correlation(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of the average ranks, as rows ``(i, j, r)``; rows with a null are ranked but not correlated.

    Ranks of few values are broadcast, by their true number. One column of many values needs no join with the rows: they are added up by
    its values, which its ranks then weigh. Further such columns are joined by value, frequent ones spread out.
    """
    spark = df.sparkSession
    limit = _bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    rows, large, total = df.dropna(subset=cols).withColumn("_row", F.monotonically_increasing_id()), {}, 0
    for c in dict.fromkeys(cols):
        counted = _counted_values(df, c)
        size, total = counted.agg(F.count(F.lit(1)), F.sum("n")).first()
        # ranks about their mean, so that sums of products stay small
        ranks = _ranks_of(counted, c).select(c, (F.col("rank") - ((total or 0) + 1) / 2).alias(f"_{c}"))
        if size * _RANK_BYTES <= limit:
            rows = rows.join(F.broadcast(ranks), c)
        else:
            large[c] = ranks
    weighed = large.popitem() if large else None
    for c, ranks in large.items():
        rows = salted_join(rows, ranks, [c], spread_by=["_row"])
    names = [c for c in dict.fromkeys(cols) if weighed is None or c != weighed[0]]
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    sums = [F.sum(f"_{c}").alias(f"s_{c}") for c in names] + [F.sum(F.col(f"_{a}") * F.col(f"_{b}")).alias(f"p_{a}_{b}") for a, b in pairs]
    n = F.count(F.lit(1)).alias("n")
    if weighed is None:
        found = rows.agg(n, *sums)
    else:
        w, rank = weighed[0], F.col(f"_{weighed[0]}")
        per = rows.groupBy(w).agg(n, *sums).join(weighed[1], w)
        again = [F.sum(x).alias(x) for x in ("n", *(f"s_{c}" for c in names), *(f"p_{a}_{b}" for a, b in pairs))]
        own = [F.sum(rank * F.col("n")).alias(f"s_{w}"), F.sum(rank * rank * F.col("n")).alias(f"p_{w}_{w}")]
        found = per.agg(*again, *own, *[F.sum(rank * F.col(f"s_{c}")).alias(f"p_{c}_{w}") for c in names])
    got = found.first().asDict()
    if (got["n"] or 0) < 2:
        raise ValueError("a correlation needs two rows at least")

    def spread(a: str, b: str) -> float:
        both = got.get(f"p_{a}_{b}", got.get(f"p_{b}_{a}"))
        return both - got[f"s_{a}"] * got[f"s_{b}"] / got["n"]

    def r(a: str, b: str) -> float:
        if a == b:
            return 1.0
        scale = (spread(a, a) * spread(b, b)) ** 0.5 if min(spread(a, a), spread(b, b)) > 0 else 0.0
        return spread(a, b) / scale if scale else float("nan")

    return spark.createDataFrame([(a, b, r(a, b)) for a in cols for b in cols], "i string, j string, r double")


def chi_square(df: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    """Independence test of each categorical column against the label:
    ``(feature, p_value, degrees_of_freedom, statistic)``. Bucketise continuous columns first."""
    vectors = VectorAssembler(inputCols=list(cols), outputCol="v").transform(df.select(label, *cols))
    names = F.array(*[F.lit(c) for c in cols])
    return ChiSquareTest.test(vectors, "v", label, flatten=True).select(
        names[F.col("featureIndex")].alias("feature"),
        F.col("pValue").alias("p_value"),
        F.col("degreesOfFreedom").cast("long").alias("degrees_of_freedom"),
        "statistic",
    )


def mean_squared_error(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.agg(F.avg(F.pow(F.col(label) - F.col(prediction), 2)).alias("mse"))
