"""The preparation of detection features as one ``pyspark.ml`` pipeline (M2, M3, M4, M8, M5, M9).

Five own estimators, fitted once on a training split and applied to any
frame; the fitted model is a ``PipelineModel`` that can be saved and loaded.

1. ``SparseFilter``: non-finite values become null; features with too few
   values go.
2. ``MedianFill``: nulls become the training median (0 without one).
3. ``VarianceFilter``: constant features go.
4. ``ImportanceFilter``: features below the importance threshold go; if none
   is left, the ten most important ones stay.
5. ``Scaler``: z-scores with the population deviation (0 where there is none),
   and all of them as one vector.

Every stage fits with aggregates over the frame; only numbers per feature
reach the driver.  A table without rows keeps the features that are always
kept, filled with 0.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import exact_quantiles
from . import stats as ST

TOP_IMPORTANT = 10  # fixed value: features kept when none reaches the threshold
VECTOR = "features"


def finite(x):
    """NaN and infinite values -> null."""
    return F.when(F.abs(x) < F.lit(float("inf")), x)


class _Columns(Params):
    """Parameters of the stages and their models; lists run along ``kept`` where they are per feature."""

    features = Param(Params._dummy(), "features", "feature columns in order", TypeConverters.toListString)
    kept = Param(Params._dummy(), "kept", "features that stay", TypeConverters.toListString)
    fills = Param(Params._dummy(), "fills", "values for nulls", TypeConverters.toListFloat)
    means = Param(Params._dummy(), "means", "means", TypeConverters.toListFloat)
    deviations = Param(Params._dummy(), "deviations", "population deviations", TypeConverters.toListFloat)
    strict = Param(Params._dummy(), "strict", "more than half, not half, must be there", TypeConverters.toBoolean)
    alwaysKept = Param(Params._dummy(), "alwaysKept", "features that are never too sparse", TypeConverters.toListString)
    names = Param(Params._dummy(), "names", "features with an importance", TypeConverters.toListString)
    importances = Param(Params._dummy(), "importances", "their importances", TypeConverters.toListFloat)
    threshold = Param(Params._dummy(), "threshold", "least importance", TypeConverters.toFloat)
    clean = Param(Params._dummy(), "clean", "whether non-finite values become null", TypeConverters.toBoolean)
    outputCol = Param(Params._dummy(), "outputCol", "vector column, empty for none", TypeConverters.toString)

    def __init__(self, **given):
        super().__init__()
        self._setDefault(fills=[], means=[], deviations=[], strict=True, alwaysKept=[], names=[], importances=[], threshold=0.0, clean=False, outputCol="")
        self._set(**given)

    def get(self, name: str):
        return self.getOrDefault(getattr(self, name))


class ColumnsModel(_Columns, Model, DefaultParamsReadable, DefaultParamsWritable):
    """Drops, fills and scales feature columns; other columns pass."""

    def _transform(self, df: DataFrame) -> DataFrame:
        kept, fills, means, deviations = (self.get(n) for n in ("kept", "fills", "means", "deviations"))
        rest = [c for c in df.columns if c not in set(self.get("features")) | {self.get("outputCol")}]
        # each stage names a column once: the optimizer merges all stages into one projection
        cols = {c: finite(ST.dbl(c)) if self.get("clean") else ST.dbl(c) for c in kept}
        if fills:
            cols = {c: F.coalesce(x, F.lit(f)) for (c, x), f in zip(cols.items(), fills, strict=True)}
        if deviations:
            cols = {c: F.coalesce((x - F.lit(m)) / F.lit(s), F.lit(0.0)) if s else F.lit(0.0)
                    for (c, x), m, s in zip(cols.items(), means, deviations, strict=True)}
        out = df.select(*rest, *[x.alias(c) for c, x in cols.items()])
        if self.get("outputCol"):
            out = VectorAssembler(inputCols=kept, outputCol=self.get("outputCol")).transform(out)
        return out


class _Stage(_Columns, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """An estimator over the features that the stages before it have left in the frame."""

    def _fit(self, df: DataFrame) -> ColumnsModel:
        there = [c for c in self.get("features") if c in df.columns]
        return ColumnsModel(features=self.get("features"), **self.fitted(df, there))

    def fitted(self, df: DataFrame, there: list[str]) -> dict:
        raise NotImplementedError


class SparseFilter(_Stage):
    def fitted(self, df, there):
        row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(finite(ST.dbl(c))).alias(c) for c in there]).first()
        least = ST.MIN_NONNULL_SHARE * row["_n"]
        enough = lambda n: n > least or (n == least and not self.get("strict"))
        return {"kept": [c for c in there if c in self.get("alwaysKept") or enough(row[c])], "clean": True}


class MedianFill(_Stage):
    def fitted(self, df, there):
        medians = exact_quantiles(ST.long_values(df, there), "value", ["feature"], [0.5]).collect() if there else []
        known = {r["feature"]: r["q0"] for r in medians}
        return {"kept": there, "fills": [float(known.get(c) or 0.0) for c in there]}


class VarianceFilter(_Stage):
    def fitted(self, df, there):
        var = ST.variances(df, there) if there else {}
        return {"kept": [c for c in there if var[c]]}


class ImportanceFilter(_Stage):
    def fitted(self, df, there):
        known = dict(zip(self.get("names"), self.get("importances"), strict=True))
        if not known:  # none given: all stay
            return {"kept": there}
        kept = [c for c in there if c in known and known[c] >= self.get("threshold")]
        best = sorted(known, key=lambda c: (-known[c], c))[:TOP_IMPORTANT]
        return {"kept": kept or [c for c in there if c in best]}


class Scaler(_Stage):
    def fitted(self, df, there):
        mom = ST.moments(df, there) if there else {}
        spread = {c: s if s and s > 1e-12 * max(1.0, abs(m)) else 0.0 for c, (m, s) in mom.items()}
        return {"kept": there, "means": [float(mom[c][0] or 0.0) for c in there], "deviations": [float(spread[c]) for c in there],
                "outputCol": self.get("outputCol")}


def preparation(features: Sequence[str], importance: Mapping[str, float] | None = None, threshold: float = 0.0,
                strict: bool = True, always_kept: Sequence[str] = ("boolean_1",)) -> Pipeline:
    """The unfitted pipeline over ``features``."""
    features, known = list(features), dict(importance or {})
    return Pipeline(stages=[
        SparseFilter(features=features, strict=strict, alwaysKept=list(always_kept)), MedianFill(features=features),
        VarianceFilter(features=features),
        ImportanceFilter(features=features, names=list(known), importances=[float(x) for x in known.values()], threshold=threshold),
        Scaler(features=features, outputCol=VECTOR)])


class Prepared:
    """A fitted preparation: ``kept`` features and what every stage has learned."""

    def __init__(self, model: PipelineModel):
        self.model = model
        fill, scale = model.stages[1], model.stages[-1]
        self.kept = scale.get("kept")
        self.fills = {c: f for c, f in zip(fill.get("kept"), fill.get("fills") or [0.0] * len(fill.get("kept")), strict=True) if c in self.kept}
        self.moments = {c: (m, s) for c, m, s in zip(self.kept, scale.get("means"), scale.get("deviations"), strict=True)}

    @classmethod
    def fit(cls, train: DataFrame, features: Sequence[str], importance: Mapping[str, float] | None = None, threshold: float = 0.0) -> Prepared:
        return cls(preparation(features, importance, threshold).fit(train))

    @classmethod
    def fit_groups(cls, train: DataFrame, group: str, features: Sequence[str], importance: Mapping[str, float] | None = None,
                   threshold: float = 0.0, strict: bool = True, always_kept: Sequence[str] = ("boolean_1",)) -> dict[str, Prepared]:
        """One preparation per value of ``group``, equal to ``fit`` on its rows, from three passes over all of them."""
        features = list(features)
        clean = train.select(group, *[finite(ST.dbl(c)).alias(c) for c in features])
        counts = {r[group]: r for r in clean.groupBy(group).agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(c) for c in features]).collect()}
        medians = {(r[group], r["feature"]): r["q0"] for r in
                   exact_quantiles(ST.long_values(clean, features, [group]), "value", [group, "feature"], [0.5]).collect()}
        fills = {(g, c): float(medians.get((g, c)) or 0.0) for g in counts for c in features}
        # a row per value of the group, numbers per feature
        fill = {c: F.element_at(F.create_map(*[x for g in counts for x in (F.lit(g), F.lit(fills[g, c]))]), F.col(group)) for c in features}
        long = clean.select(group, *[F.coalesce(F.col(c), fill[c]).alias(c) for c in features]).unpivot([group], features, "feature", "value") if counts else None
        moments = {(r[group], r["feature"]): r for r in long.groupBy(group, "feature").agg(
            F.avg("value").alias("m"), F.stddev_pop("value").alias("s"), (F.max("value") > F.min("value")).alias("varies")).collect()} if counts else {}
        out = {}
        for g, n in counts.items():
            least = ST.MIN_NONNULL_SHARE * n["_n"]
            dense = [c for c in features if c in always_kept or n[c] > least or (n[c] == least and not strict)]
            varied = [c for c in dense if moments[g, c]["varies"]]
            chosen = ImportanceFilter(features=features, names=list(importance or {}), importances=[float(x) for x in (importance or {}).values()],
                                      threshold=threshold).fitted(train, varied)["kept"]
            mom = [moments[g, c] for c in chosen]
            spread = [float(r["s"]) if r["s"] > 1e-12 * max(1.0, abs(r["m"])) else 0.0 for r in mom]
            out[g] = cls(PipelineModel(stages=[ColumnsModel(features=features, **k) for k in (
                {"kept": dense, "clean": True}, {"kept": dense, "fills": [fills[g, c] for c in dense]}, {"kept": varied}, {"kept": chosen},
                {"kept": chosen, "means": [float(r["m"]) for r in mom], "deviations": spread, "outputCol": VECTOR})]))
        return out

    @classmethod
    def load(cls, path: str) -> Prepared:
        return cls(PipelineModel.load(path))

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(path)

    def transform(self, df: DataFrame) -> DataFrame:
        """Z-scores of the kept features (other features gone) and the vector of them."""
        return self.model.transform(df)
