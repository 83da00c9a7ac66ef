"""Column roles of one analysis, passed to every composite operator."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class AnalysisSpec:
    """Names the roles columns play. Nothing in the operators hard-codes a column or label."""

    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    target: str
    positive: str
    negative: str
    key: tuple[str, ...] = ()
    key_missing: tuple[str, ...] = ()
    excluded: tuple[str, ...] = ()
    group: str | None = None
    test_values: tuple[str, ...] = ()
    test_categories: tuple[str, ...] = ()
    share_categories: tuple[str, ...] = ()
    uncapped: tuple[str, ...] = ()
    rate_categories: tuple[str, ...] = ()
    histogram_by_target: tuple[str, ...] = ()
    histogram: tuple[str, ...] = ()
    box_by_target: tuple[str, ...] = ()
    box_log: tuple[str, ...] = ()
    scatter: tuple[str, ...] = ()
    top_n: int = 10
    alpha: float = 0.05
    sparse_share: float = 0.01
    test_size: float = 0.2
    seed: int = 42
    sample_size: int = 5000
    tie_margin: float = 0.01
    forest_trees: int = 100
    forest_depth: int = 30
    forest_bins: int = 256
    # Train rows a forest that is trained alone is fitted on, in expectation; None is all of them. Scoring always covers
    # all test rows, and a comparison always fits on all train rows.
    forest_rows: int | None = None

    @property
    def target_mapping(self) -> dict[str, int]:
        return {self.negative: 0, self.positive: 1}

    @property
    def model_numeric(self) -> tuple[str, ...]:
        return tuple(c for c in self.numeric if c not in self.excluded)

    @property
    def model_categorical(self) -> tuple[str, ...]:
        return tuple(c for c in self.categorical if c not in self.excluded)


# Column names, types and roles of the public census income file.
CENSUS_INCOME_SCHEMA = T.StructType(
    [
        T.StructField("age", T.LongType()),
        T.StructField("workclass", T.StringType()),
        T.StructField("fnlwgt", T.LongType()),
        T.StructField("education", T.StringType()),
        T.StructField("education-num", T.LongType()),
        T.StructField("marital-status", T.StringType()),
        T.StructField("occupation", T.StringType()),
        T.StructField("relationship", T.StringType()),
        T.StructField("race", T.StringType()),
        T.StructField("sex", T.StringType()),
        T.StructField("capital-gain", T.LongType()),
        T.StructField("capital-loss", T.LongType()),
        T.StructField("hours-per-week", T.LongType()),
        T.StructField("native-country", T.StringType()),
        T.StructField("income", T.StringType()),
    ]
)

CENSUS_INCOME = AnalysisSpec(
    numeric=("age", "fnlwgt", "education-num", "capital-gain", "capital-loss", "hours-per-week"),
    categorical=(
        "workclass", "education", "marital-status", "occupation",
        "relationship", "race", "sex", "native-country",
    ),
    target="income",
    positive=">50K",
    negative="<=50K",
    key_missing=("workclass", "occupation", "native-country"),
    excluded=("fnlwgt", "education"),
    group="sex",
    test_values=("hours-per-week", "age", "education-num"),
    test_categories=("education", "occupation", "workclass", "sex"),
    share_categories=("education", "occupation", "sex", "workclass"),
    uncapped=("sex",),
    rate_categories=("education", "occupation"),
    histogram_by_target=("age",),
    histogram=("fnlwgt", "hours-per-week"),
    box_by_target=("hours-per-week",),
    box_log=("capital-gain", "capital-loss"),
    scatter=("age", "hours-per-week", "education", "occupation", "workclass"),
)
