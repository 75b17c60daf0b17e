"""Feature frames and the fitted preprocessor.

The preprocessor is an ordinary ``PipelineModel`` of built-in stages (a
``SQLTransformer`` holding the fitted literals, a string indexer, a one-hot
encoder, a vector assembler): it saves, loads and runs without this package.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    OneHotEncoder,
    SQLTransformer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrato import config
from estrato.functions import columns as C
from estrato.operators import stats
from estrato.operators.clean import add_mid_depth, add_test_type
from estrato.session import materialise

LABEL = "label"


class InsufficientData(ValueError):
    """A guard failed; the message says which."""


def target_rows(df: DataFrame, target: str) -> DataFrame:
    return df.filter(C.col(target).isNotNull())


def resolve_features(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """The wanted columns that exist, in wanted order."""
    return [c for c in wanted if c in df.columns]


@dataclass
class FeatureFrame:
    df: DataFrame                 # keys + numeric + categorical + label
    numeric: list[str]
    categorical: list[str]
    keys: list[str]

    @property
    def features(self) -> list[str]:
        return self.numeric + self.categorical


def check_features(df: DataFrame, preset: config.TargetPreset,
                   min_rows: int = config.MIN_TARGET_ROWS) -> str | None:
    """Why the table cannot serve the target, or None. Schema checks first; the
    row check stops reading after ``min_rows`` rows with a target."""
    if not df.take(1):
        return "no rows"
    numeric = resolve_features(df, preset.numeric)
    absent = [c for c in preset.required if c not in numeric]
    if absent:
        return "missing required features: " + ", ".join(absent)
    if len(numeric) < config.MIN_NUMERIC_FEATURES:
        return "too few numeric features"
    if preset.target not in df.columns:
        return f"no target column {preset.target}"
    if len(target_rows(df, preset.target).select(C.col(preset.target)).take(min_rows)) < min_rows:
        return "too few rows with a target"
    return None


def feature_frame(df: DataFrame, preset: config.TargetPreset,
                  keys: Sequence[str] = (), check: bool = True) -> FeatureFrame:
    """Rows with a target, reduced to keys, existing features and the label."""
    df = add_test_type(add_mid_depth(df), overwrite=False)
    if check:
        reason = check_features(df, preset)
        if reason:
            raise InsufficientData(reason)
    numeric = resolve_features(df, preset.numeric)
    categorical = resolve_features(df, preset.categorical)
    out = target_rows(df, preset.target).select(
        *[C.col(k) for k in keys if k not in numeric + categorical],
        *[C.col(c).try_cast("double").alias(c) for c in numeric],
        *[C.col(c) for c in categorical],
        C.col(preset.target).try_cast("double").alias(LABEL))
    return FeatureFrame(out, numeric, categorical, list(keys))


def guard_report(df: DataFrame, presets: Sequence[config.TargetPreset]) -> DataFrame:
    """(target, ok, reason) per preset."""
    rows = []
    for preset in presets:
        reason = check_features(df, preset)
        rows.append((preset.name, reason is None, reason))
    return df.sparkSession.createDataFrame(rows, "target string, ok boolean, reason string")


# --- column expressions -----------------------------------------------------

def impute(df: DataFrame, values: dict[str, float | str | None]) -> DataFrame:
    """Fill NULLs per column; a column without a fill value is dropped."""
    keep = {c: F.coalesce(C.col(c), F.lit(v)) for c, v in values.items() if v is not None}
    gone = [c for c, v in values.items() if v is None]
    return df.withColumns(keep).drop(*gone) if keep else df.drop(*gone)


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return impute(df, stats.exact_medians(df, columns))


def impute_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    found = {r["feature"]: r["value"] for r in stats.most_frequent(df, columns).collect()}
    return impute(df, {c: found.get(c) for c in columns})


def standardise(value: Column, mean: float, deviation: float) -> Column:
    """Zero deviation divides by 1."""
    return (value - F.lit(mean)) / F.lit(deviation if deviation > 0 else 1.0)


def scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean 0 and population deviation 1 per column, after median imputation."""
    profile = stats.numeric_profile(df, columns)
    out, gone = {}, []
    for c in columns:
        p = profile[c]
        if p.median is None:
            gone.append(c)
            continue
        filled = F.coalesce(C.col(c).try_cast("double"), F.lit(p.median))
        out[c] = standardise(filled, p.imputed.mean, p.imputed.var ** 0.5)
    return df.withColumns(out).drop(*gone) if out else df.drop(*gone)


def one_hot(df: DataFrame, column: str, levels: Sequence[str]) -> DataFrame:
    """One 0/1 column per level; an unseen value gives zeros only."""
    return df.withColumns({
        f"{column}_{i}": F.when(C.col(column) == F.lit(v), 1.0).otherwise(0.0)
        for i, v in enumerate(levels)})


# --- fitted preprocessor ----------------------------------------------------

@dataclass
class Preprocessor:
    model: PipelineModel
    numeric: list[str]            # features that had values to fit on
    categorical: list[str]
    levels: dict[str, list[str]]
    dropped: list[str]            # all-NULL features, left out

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df)

    @property
    def slots(self) -> list[str]:
        """Source feature of each vector slot, in vector order."""
        return self.numeric + [c for c in self.categorical for _ in self.levels[c]]


def vocabulary(df: DataFrame, columns: Sequence[str],
               max_levels: int | None = None) -> dict[str, list[tuple[str, int]]]:
    """Sorted (level, rows) per column, from one shuffle. Where ``max_levels`` is
    given, a column with more levels has none: they are counted first and never fetched."""
    if not columns:
        return {}
    counts = materialise(stats.category_counts(df, columns), "levels")
    sizes = {r["feature"]: r["count"] for r in counts.groupBy("feature").count().collect()}
    kept = [c for c in columns if sizes.get(c, 0) > 0 and (max_levels is None or sizes[c] <= max_levels)]
    found: dict[str, list[tuple[str, int]]] = {c: [] for c in columns}
    for r in counts.filter(F.col("feature").isin(kept)).collect() if kept else []:
        found[r["feature"]].append((r["value"], r["n"]))
    return {c: sorted(v) for c, v in found.items()}


def fit_preprocessor(train: DataFrame, numeric: Sequence[str],
                     categorical: Sequence[str], out: str = "features",
                     max_levels: int | None = None) -> Preprocessor:
    """Fit median fill, standardisation, mode fill and one-hot on ``train``.

    Numeric slots come first, then all levels per category in sorted order.
    Features without any training value are left out and listed in ``dropped``;
    so are categories with more than ``max_levels`` levels where that is given.
    """
    profile = stats.numeric_profile(train, numeric)
    kept = [c for c in numeric if profile[c].median is not None]
    vocab = vocabulary(train, categorical, max_levels)
    kept_cat = [c for c in categorical if vocab[c]]
    # Scratch columns are numbered: stages do not take every name a column has.
    scaled = [f"__num_{i}" for i in range(len(kept))]
    filled, index, hot = ([f"__{kind}_{i}" for i in range(len(kept_cat))]
                          for kind in ("filled", "index", "hot"))
    exprs = []
    for c, name in zip(kept, scaled):
        p = profile[c]
        sd = p.imputed.var ** 0.5
        exprs.append(f"(coalesce(try_cast({_q(c)} as double), {_d(p.median)}) - {_d(p.imputed.mean)})"
                     f" / {_d(sd if sd > 0 else 1.0)} as {name}")
    for c, name in zip(kept_cat, filled):
        fill = min(vocab[c], key=lambda level: (-level[1], level[0]))[0]
        exprs.append(f"coalesce(cast({_q(c)} as string), {_s(fill)}) as {name}")
    stages = [SQLTransformer(statement="select *, " + ", ".join(exprs) + " from __THIS__")]
    levels = {c: [v for v, _ in vocab[c]] for c in kept_cat}
    if kept_cat:
        stages += [StringIndexerModel.from_labels(levels[c], inputCol=f, outputCol=i,
                                                  handleInvalid="keep")
                   for c, f, i in zip(kept_cat, filled, index)]
        # The extra "unknown" slot is the one dropped: all levels stay.
        encoder = OneHotEncoder(inputCols=index, outputCols=hot, dropLast=True)
        stages.append(encoder.fit(PipelineModel(stages).transform(train.limit(0))))
    stages.append(VectorAssembler(inputCols=scaled + hot, outputCol=out))
    scratch = ", ".join(scaled + filled + index + hot)
    stages.append(SQLTransformer(statement=f"select * except ({scratch}) from __THIS__"))
    dropped = [c for c in [*numeric, *categorical] if c not in kept + kept_cat]
    return Preprocessor(PipelineModel(stages), kept, kept_cat, levels, dropped)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _d(number: float) -> str:
    """A double literal without loss of digits."""
    return f"double('{number!r}')"


def _s(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
