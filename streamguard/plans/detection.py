"""Prepared features, model predictions and their scores, shared by the detector queries.

Preparations are fitted once per (data folder, mode), for all attack types in
the same passes, and used by all detectors.  Predictions are a long table per
mode and detector or per clustering, written once per session; a query fits
the models whose predictions it reads, and every score is an aggregate over them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema
from ..operators import cluster as CL
from ..operators import models as MD
from ..operators import neighbors as NB
from ..operators.prepare import VECTOR, Prepared
from ..session import cut_lineage, prepare, side_by_side, write_table
from . import context as ctx

MODES = ["core", "full", "new", "core_new"]
DETECT = list(schema.UCAD_FEATURES)
DBSCAN_EPS, DBSCAN_MIN = 3.0, 50        # fixed values of the reference's detectors
CLUSTERS = 5
RESTARTS, RESTARTS_CLASSES = 10, 20     # K-means restarts: two clusters and latent spaces; five classes
MIN_CONTAMINATION, MAX_CONTAMINATION = 0.01, 0.5
IMPORTANCE_THRESHOLD = 0.0
MODELS_AT_ONCE = 2  # detectors fitted side by side, each for all attack types
BINARY_MODELS = {"core": ["dbscan", "gmm", "isolation_forest", "kmeans", "one_class_svm"],
                 "full": ["gmm", "isolation_forest", "kmeans", "one_class_svm"]}
SPACES = {"latent_kmeans": MD.LATENT_DIM, "projected_kmeans": 2}  # clusterings of latent codes: dimensions
CLASS_FITS = {"kmeans": ("kmeans", 300, RESTARTS_CLASSES), "gmm": ("gmm", 200, 1), "bisecting": ("bisecting", 20, 1),
              "latent_kmeans": ("kmeans", 100, RESTARTS), "projected_kmeans": ("kmeans", 100, RESTARTS)}
CLASS_MODELS = ["bisecting", "gmm", "kmeans", "latent_kmeans", "projected_kmeans"]

_KEPT: dict[tuple, object] = {}


def _once(spark, sf: str, name: str, build):
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _KEPT:
        prepare(spark)
        _KEPT[key] = build()
    return _KEPT[key]


def frame(spark, sf: str, mode: str) -> DataFrame:
    """The table that holds a mode's features."""
    if mode == "core":
        return ctx.typed(spark, sf)
    return ctx.full(spark, sf) if mode == "full" else ctx.new(spark, sf)


def split(spark, sf: str, mode: str, part: str, attack_type: str | None = None) -> DataFrame:
    f = frame(spark, sf, mode).filter(F.col("split") == part)
    return f if attack_type is None else f.filter(F.col("attack_type") == attack_type)


def contamination(train: DataFrame) -> float:
    r = train.agg(F.avg(F.col("attack").cast("double"))).first()[0] or 0.0
    return min(max(r, MIN_CONTAMINATION), MAX_CONTAMINATION)


def importance(spark, sf: str, mode: str) -> dict[str, float]:
    """D1 of a mode over all training files: what the importance filter goes by."""
    def build():
        rows = MD.pca_importance(split(spark, sf, mode, "train"), schema.mode_features(mode)).collect()  # a row per feature
        return {r["feature"]: r["pca_importance"] for r in rows}
    return _once(spark, sf, f"importance-{mode}", build)


def prepared(spark, sf: str, mode: str, attack_type: str | None = None) -> Prepared:
    """The preparation of one attack type (or of all files) in a mode, fitted on its training files, once for all types."""
    def build():
        args = schema.mode_features(mode), importance(spark, sf, mode), IMPORTANCE_THRESHOLD
        train = split(spark, sf, mode, "train")
        return Prepared.fit(train, *args) if attack_type is None else Prepared.fit_groups(train, "attack_type", *args)
    got = _once(spark, sf, f"prepared-{mode}-{'all' if attack_type is None else 'each'}", build)
    return got if attack_type is None else got[attack_type]


def matrices(spark, sf: str, mode: str, attack_type: str | None = None) -> tuple[Prepared, DataFrame, DataFrame]:
    """(preparation, prepared training rows, prepared test rows), cut from lineage for the fits, once for all models."""
    def build():
        p = prepared(spark, sf, mode, attack_type)
        keep = ["packet_id", "attack_type", "attack", *p.kept, VECTOR]
        return p, *(cut_lineage(p.transform(split(spark, sf, mode, part, attack_type)).select(*keep)) for part in ("train", "test"))
    return _once(spark, sf, f"matrices-{mode}-{attack_type or 'all'}", build)


def _long(df: DataFrame, z: DataFrame, model: str, part: str, score) -> DataFrame:
    rows = df.select("packet_id", F.lit(model).alias("model"), F.lit(part).alias("split"), score.cast("double").alias("score"), F.col("pred").cast("int").alias("pred"))
    return rows.join(z.select("packet_id", F.col("attack").cast("int").alias("y")), "packet_id")


def _minority(tr: DataFrame, te: DataFrame, kind: str) -> list[DataFrame]:
    """B3 / B4 on both splits: the smaller predicted cluster of each is the attack."""
    assign = MD.cluster_model(tr, kind, 2, 20 if kind == "kmeans" else 100, RESTARTS)
    return [CL.minority_rule(assign(d).select("packet_id", "cluster").withColumn("_g", F.lit(0)), ["_g"], "cluster") for d in (tr, te)]


def _detect(spark, sf: str, mode: str, attack_type: str, model: str) -> DataFrame:
    p, tr, te = matrices(spark, sf, mode, attack_type)
    if model == "isolation_forest":
        pair, score = MD.isolation_forest(tr, te, p.kept, contamination(tr)), F.col("if_score")
    elif model == "one_class_svm":
        pair, score = MD.one_class_rff(tr, te, p.kept, contamination(tr)), F.col("ocsvm_score")
    elif model == "dbscan":
        points = te.select("packet_id", F.array(*[F.col(c) for c in p.kept]).alias("v"))
        flags = NB.dbscan_flags(points, "packet_id", "v", DBSCAN_EPS, DBSCAN_MIN)
        pair, score = (None, flags.withColumn("pred", F.col("is_noise"))), F.col("neighbours")
    else:
        pair, score = _minority(tr, te, model), F.col("cluster")
    out = [_long(d, z, model, part, score) for d, z, part in zip(pair, (tr, te), ("train", "test"), strict=True) if d is not None]
    return _stacked([d.withColumn("attack_type", F.lit(attack_type)).withColumn("mode", F.lit(mode)) for d in out])


def _stacked(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for d in parts[1:]:
        out = out.unionByName(d)
    return out


def _ready(spark, sf: str, mode: str) -> None:
    """The inputs that all detectors of a mode share."""
    frame(spark, sf, mode)
    prepared(spark, sf, mode, schema.ATTACK_TYPES[0])
    side_by_side(spark, [lambda t=t: matrices(spark, sf, mode, t) for t in schema.ATTACK_TYPES])


def predictions(spark, sf: str, mode: str, model: str) -> DataFrame:
    """(mode, attack_type, model, split, packet_id, y, score, pred) of a binary detector, one fit per attack type."""
    def build():
        _ready(spark, sf, mode)  # shared inputs first, then the attack types side by side
        parts = side_by_side(spark, [lambda t=t: _detect(spark, sf, mode, t, model) for t in schema.ATTACK_TYPES])
        return write_table(_stacked(parts), f"predictions-{mode}-{model}", ("split",))
    return _once(spark, sf, f"predictions-{mode}-{model}", build)


def all_predictions(spark, sf: str, models: Sequence[str] | None = None) -> DataFrame:
    """The predictions of all binary detectors, or of those of ``models``, in both modes."""
    wanted = [(mode, m) for mode, names in BINARY_MODELS.items() for m in names if models is None or m in models]
    modes = list(dict.fromkeys(mode for mode, _ in wanted))
    for mode in modes:
        frame(spark, sf, mode)
    side_by_side(spark, [lambda mode=mode: _ready(spark, sf, mode) for mode in modes])
    return _stacked(side_by_side(spark, [lambda mode=mode, m=m: predictions(spark, sf, mode, m) for mode, m in wanted], MODELS_AT_ONCE))


def class_label():
    names = F.create_map(*[x for i, c in enumerate(schema.CLASSES) for x in (F.lit(c), F.lit(i))])
    return names[F.when(F.col("attack") == 0, F.lit("normal")).otherwise(F.lower("attack_type"))]


def _space(spark, sf: str, model: str) -> list[DataFrame]:
    """(packet_id, y, vector) of the training and the test rows in the space that a clustering works in."""
    if model not in SPACES:
        return [d.withColumn("y", class_label()).select("packet_id", "y", VECTOR) for d in matrices(spark, sf, "full")[1:]]
    from pyspark.ml.feature import VectorAssembler
    raw = [split(spark, sf, "full", part).withColumn("y", class_label()) for part in ("train", "test")]
    codes, zc = MD.latent_model(raw[0], DETECT, k=SPACES[model])
    va = VectorAssembler(inputCols=zc, outputCol=VECTOR)
    return [cut_lineage(va.transform(codes(d).select("packet_id", "y", *zc)).select("packet_id", "y", VECTOR)) for d in raw]


def _cluster(spark, sf: str, model: str) -> DataFrame:
    def build():
        kind, steps, restarts = CLASS_FITS[model]
        a, b = _space(spark, sf, model)
        assign = MD.cluster_model(a, kind, CLUSTERS, steps, restarts)
        one = lambda d: assign(d).select(F.lit(model).alias("model"), "packet_id", "y", "cluster")
        mapped = CL.cluster_to_class(CL.contingency(one(a), ["model"], "cluster", "y"), ["model"])
        found = CL.apply_mapping(one(b), mapped, ["model"], "cluster", "pred").select("model", "packet_id", "y", "cluster", "pred")
        return write_table(found, f"class-predictions-{model}")
    return _once(spark, sf, f"class-predictions-{model}", build)


def class_predictions(spark, sf: str, models: Sequence[str] = CLASS_MODELS) -> DataFrame:
    """(model, packet_id, y, cluster, pred) of the clusterings on the test files; clusters mapped to classes on train."""
    frame(spark, sf, "full")
    if set(models) - set(SPACES):
        matrices(spark, sf, "full")  # shared inputs first, then the models side by side
    return _stacked(side_by_side(spark, [lambda m=m: _cluster(spark, sf, m) for m in models]))
