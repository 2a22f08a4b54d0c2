"""Vectors, matrices and feature preparation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import (
    PCA,
    Normalizer,
    PCAModel,
    StandardScaler,
    StandardScalerModel,
    UnivariateFeatureSelector,
    UnivariateFeatureSelectorModel,
    VectorAssembler,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace import scratch
from millrace.operators.skew import hot_keys, salted_join


def labelled(df: DataFrame, label: str | Column, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``label`` (double) and a dense ``features`` vector of the named columns."""
    label = F.col(label) if isinstance(label, str) else label
    rows = df.withColumn("label", label.cast("double"))
    assembled = VectorAssembler(inputCols=list(cols), outputCol="features").transform(rows)
    return assembled.select(*keep, "label", "features")


def from_array(df: DataFrame, col: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(col).cast("array<double>")))


def as_array(df: DataFrame, col: str = "features") -> DataFrame:
    return df.withColumn(col, vector_to_array(col))


def sparse_entries(df: DataFrame, row_id: str, values: str) -> DataFrame:
    """The non-zero ``(index, value)`` pairs of an array column, one row each."""
    return df.select(row_id, F.posexplode(values).alias("idx", "val")).where(F.col("val") != 0)


def coordinate_entries(df: DataFrame, row_id: str, blocks: Sequence[Sequence[str]]) -> DataFrame:
    """Matrix entries ``(i, j, v)``: block number, row id, and every value of that block.

    The values of one block share a cell; ``cells`` adds them up.
    """
    per_block = F.array(
        *[
            F.struct(F.lit(i).cast("long").alias("i"), F.array(*block).alias("vs"))
            for i, block in enumerate(blocks)
        ]
    )
    exploded = df.select(F.col(row_id).alias("j"), F.explode(per_block).alias("b"))
    return exploded.select("b.i", "j", F.explode("b.vs").alias("v"))


def cells(entries: DataFrame) -> DataFrame:
    """Sum of the entries of each matrix cell."""
    return entries.groupBy("i", "j").agg(F.sum("v").alias("v"))


def times_vector(entries: DataFrame, vector: DataFrame) -> DataFrame:
    """Matrix · vector for entries ``(i, j, v)`` and ``vector(j, x)``. The entries are summed to
    cells first; the cells of a crowded column are spread over the rows."""
    return (
        salted_join(cells(entries), vector, ["j"], spread_by=["i"], hot=hot_keys(entries, ["j"]))
        .groupBy("i")
        .agg(F.sum(F.col("v") * F.col("x")).alias("y"))
    )


def blocks(entries: DataFrame, size: int) -> DataFrame:
    """Block form ``(bi, bj, cells)`` of entries ``(i, j, v)``: the cells of each ``size`` by ``size`` block as sorted
    ``(i, j, v)`` with places inside the block; at most ``size * size`` of them."""
    at = lambda c: F.expr(f"{c} div {size}")
    inside = F.struct(F.pmod("i", F.lit(size)).alias("i"), F.pmod("j", F.lit(size)).alias("j"), "v")
    return (
        cells(entries)
        .groupBy(at("i").alias("bi"), at("j").alias("bj"))
        .agg(F.array_sort(F.collect_list(inside)).alias("cells"))
    )


def row_matrix(entries: DataFrame, columns: Sequence[int]) -> DataFrame:
    """Wide form of ``cells``: one row per ``i``, one field per listed ``j``."""
    return entries.groupBy("i").pivot("j", list(columns)).sum("v").fillna(0.0)


def indexed_rows(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows numbered 0.. in a global order: a range-partitioned sort, then each partition is
    numbered from the row counts of those before it (one count per partition)."""
    ordered = scratch.cut(df.repartitionByRange(*order).sortWithinPartitions(*order))
    # the id holds the partition number above bit 33 and the row's place in it below
    placed = ordered.withColumn("_id", F.monotonically_increasing_id()).withColumn(
        "_part", F.shiftright("_id", 33)
    )
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    place = F.col("_id") - F.shiftleft("_part", 33)
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn("row_index", F.col("_off") + place)
        .drop("_id", "_part", "_off")
    )


def standard_scaler(df: DataFrame, col: str = "features", out: str = "scaled") -> StandardScalerModel:
    """Unit sample deviation without centring."""
    return StandardScaler(inputCol=col, outputCol=out, withMean=False, withStd=True).fit(df)


def top_features(df: DataFrame, n: int, col: str = "features", out: str = "selected") -> UnivariateFeatureSelectorModel:
    """The ``n`` categorical features with the lowest chi-square p-values."""
    selector = UnivariateFeatureSelector(featuresCol=col, labelCol="label", outputCol=out)
    selector.setFeatureType("categorical").setLabelType("categorical")
    selector.setSelectionMode("numTopFeatures").setSelectionThreshold(n)
    return selector.fit(df)


def pca(df: DataFrame, k: int, col: str = "features", out: str = "components") -> PCAModel:
    return PCA(k=k, inputCol=col, outputCol=out).fit(df)


def normalizer(p: float = 1.0, col: str = "features", out: str = "normalized") -> Normalizer:
    return Normalizer(p=p, inputCol=col, outputCol=out)
