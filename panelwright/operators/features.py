"""Model inputs: imputation, scaling, splits and bounded samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .positions import stratified_split
from .quantiles import scalar_medians

READY = "__x"  # suffix of a feature column that is imputed or scaled


def _as_stage(expressions: dict[str, str]) -> SQLTransformer:
    """Fitted numbers as a stage that is saved and loaded with its pipeline."""
    made = ", ".join(f"{e} AS `{name}`" for name, e in expressions.items())
    return SQLTransformer(statement=f"SELECT *, {made} FROM __THIS__")


def median_stage(fit_on: DataFrame, features: Sequence[str]) -> SQLTransformer:
    """M2: missing features take the column median of ``fit_on`` (0 if a column is empty)."""
    middle = scalar_medians(fit_on, features)
    return _as_stage({f + READY: f"coalesce(cast(`{f}` AS double), {float(middle[f] or 0.0)!r}D)" for f in features})


def standard_scale(fit_on: DataFrame, features: Sequence[str]) -> dict[str, tuple[float, float]]:
    """M5: mean and population deviation per feature, missing as 0; a constant has scale 1."""
    values = {f: F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features}
    row = fit_on.agg(*[
        F.struct(F.avg(v).alias("mean"), F.min(v).alias("low"),
                 F.when(F.min(v) < F.max(v), F.stddev_pop(v)).alias("deviation")).alias(f)
        for f, v in values.items()]).first()
    fitted = {}
    for f in features:
        constant = row[f]["deviation"] is None
        centre = row[f]["low"] if constant else row[f]["mean"]
        fitted[f] = (centre or 0.0, row[f]["deviation"] or 1.0)
    return fitted


def scale_stage(fit_on: DataFrame, features: Sequence[str]) -> SQLTransformer:
    """Fitted on the training rows, applied to any rows."""
    fitted = standard_scale(fit_on, features)
    return _as_stage({
        f + READY: f"(coalesce(cast(`{f}` AS double), 0.0D) - {m!r}D) / {s!r}D" for f, (m, s) in fitted.items()})


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=[f + READY for f in features], outputCol="features")


def split_by_year(
    df: DataFrame,
    first_test_year: int,
    key: Sequence[str],
    year: str = "year",
    label: str | None = None,
    test_share: float = 0.2,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """M4: earlier years train, later years test.

    Without a year, or if a side is empty, a seeded hash of the row's key takes
    ``test_share`` of the rows, evenly per class when a label is given.
    """
    if year in df.columns:
        train, test = df.filter(F.col(year) < first_test_year), df.filter(F.col(year) >= first_test_year)
        if not train.isEmpty() and not test.isEmpty():
            return train, test
    if label:
        marked = stratified_split(df, label, key, test_share, seed)
    else:
        place = F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(1_000_000))
        marked = df.withColumn("is_test", place < int(test_share * 1_000_000))
    return marked.filter("not is_test").drop("is_test"), marked.filter("is_test").drop("is_test")


def bounded_sample(df: DataFrame, key: Sequence[str], at_most: int, seed: int = 42) -> DataFrame:
    """At most ``at_most`` rows in a seeded order that ignores partitioning."""
    return df.orderBy(seeded_order(key, seed), *key).limit(at_most)


def seeded_order(key: Sequence[str], seed: int) -> Column:
    """A text whose order over rows looks random and is the same in any engine."""
    return F.md5(F.concat_ws("|", F.lit(seed), *[F.col(k).cast("string") for k in key]))
