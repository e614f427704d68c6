"""Feature matrix, category vocabulary and the trained hazard classifier.

Categoricals enter as target means: ordered ones for the FIT rows, those of
all FIT rows elsewhere (``categories``), kept in a table, so no list of
categories reaches the driver.  NULL numerics are imputed with an explicit
missing indicator.  Trees are boosted round by round up to the round that is
best on the VAL split (``boosting``).  Scores will not equal another library's
boosting output; checks on them are rows-only.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressionModel, GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custval.operators.persist import discard, settle
from custval.params import Params
from custval.plans.hazard import categories as CT
from custval.plans.hazard.boosting import boost

ID_COLS = ["customer_id", "split_rand", "order_date", "next_order_date"]
LEAKAGE_COLS = ["days_to_next_order"]
LABEL = "churned_400d"
CAT_COLS = ["this_order_department", "this_order_style", "this_order_channel", "this_order_store",
            "order_month", "entry_department", "first_product_style", "acq_channel", "acq_store",
            "customer_state"]
#: a panel row
ROW_KEYS = ["customer_id", "order_date"]
MAX_DEPTH, STEP, MAX_BINS = 6, 0.05, 64
# The columns above and below must carry the published names.
BOOL_COLS = ["paid_full_price", "cum_bought_cross_gender", "cum_footwear_plus_nonfootwear",
             "cum_ever_ecomm", "cum_ever_retail", "cum_both_channels", "state_missing"]


def feature_columns(panel_cols) -> list[str]:
    drop = set(ID_COLS + LEAKAGE_COLS + [LABEL])
    return [c for c in panel_cols if c not in drop]


def model_frame(panel: DataFrame, keep: tuple = ("customer_id", "order_date")) -> DataFrame:
    """C4: label-less rows dropped; booleans as 0/1; categoricals as text, NULL -> 'missing'.

    ``align_features`` handles absent columns at scoring time.
    """
    feats = feature_columns(panel.columns)
    cols = []
    for c in feats:
        if c in CAT_COLS:
            cols.append(F.coalesce(F.col(c).cast("string"), F.lit("missing")).alias(c))
        elif c in BOOL_COLS:
            cols.append(F.col(c).cast("int").alias(c))
        else:
            cols.append(F.col(c).cast("double").alias(c))
    base = panel.where(F.col(LABEL).isNotNull()) if LABEL in panel.columns else panel
    extra = [LABEL] if LABEL in panel.columns else []
    return base.select(*keep, *extra, *cols)


def align_features(frame: DataFrame, feature_cols: list[str]) -> DataFrame:
    """Project to the trained column list; absent features become NULL."""
    have = set(frame.columns)
    cols = [F.col(c) if c in have else F.lit(None).cast("double").alias(c) for c in feature_cols]
    return frame.select(*[c for c in frame.columns if c not in feature_cols], *cols)


def category_vocab(frame: DataFrame) -> DataFrame:
    """Distinct text per categorical feature (to report unseen categories)."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in CAT_COLS]))
    return frame.select(pairs.alias("p")).select("p.feature", "p.value").distinct()


def _inputs(feats: list[str]) -> list[str]:
    """Everything a tree may split on: category means, imputed numbers, and whether a number is missing."""
    cats, nums = [c for c in CAT_COLS if c in feats], [c for c in feats if c not in CAT_COLS]
    return [f"{c}__mean" for c in cats] + [f"{c}__im" for c in nums] + [f"{c}__na" for c in nums]


def _assembly(feats: list[str], fit_rows: DataFrame) -> Pipeline:
    """Missing indicators that are 0 on all FIT rows split nothing; left out, the trees are the same and every round reads less."""
    nums = [c for c in feats if c not in CAT_COLS]
    some = fit_rows.agg(*[F.max(f"{c}__na").alias(f"{c}__na") for c in nums]).first().asDict()
    return Pipeline(stages=[
        Imputer(inputCols=nums, outputCols=[f"{c}__im" for c in nums], strategy="median"),
        VectorAssembler(inputCols=[c for c in _inputs(feats) if some.get(c, 1.0) != 0.0], outputCol="features", handleInvalid="keep"),
    ])


@dataclass
class HazardModel:
    """A fitted classifier: the pipeline behind the category means, their table, and the rate of unknown categories."""

    pipeline: PipelineModel
    categories: DataFrame
    prior: float
    losses: list[float] = field(default_factory=list)

    @property
    def stages(self) -> list:
        return self.pipeline.stages

    @property
    def trees(self) -> list[DecisionTreeRegressionModel]:
        return [t for s in self.stages if isinstance(s, GBTRegressionModel) for t in s.trees]


def _prepare(frame: DataFrame, feats: list[str]) -> DataFrame:
    nums = [c for c in feats if c not in CAT_COLS]
    return frame.select("*", *[F.col(c).isNull().cast("double").alias(f"{c}__na") for c in nums])


def training_rows(panel: DataFrame, p: Params) -> DataFrame:
    """The model frame of the FIT and VAL rows, with their split."""
    from custval.plans.hazard.curve import split_of
    frame = model_frame(panel, keep=("customer_id", "order_date", "split_rand"))
    return (frame.withColumn(LABEL, F.col(LABEL).cast("double")).withColumn("split", split_of(F.col("split_rand"), p))
            .where(F.col("split") != "test"))


def encoded_rows(panel: DataFrame, p: Params, written: bool = False) -> tuple[DataFrame, DataFrame, DataFrame, float]:
    """(FIT rows with ordered category means, VAL rows with the FIT means, the table of FIT means, the overall rate), each written once.

    ``written``: the panel reads written rows; otherwise those it trains on are written first, and deleted at the end.
    """
    feats = feature_columns(panel.columns)
    cats = [c for c in CAT_COLS if c in feats]
    train = _prepare(training_rows(panel, p), feats)
    train = train if written else settle(train)
    spent = [] if written else [train]
    fit_rows, val_rows = train.where(F.col("split") == "fit"), train.where(F.col("split") == "val")
    prior = CT.prior_of(fit_rows, LABEL)
    table = settle(CT.category_means(fit_rows, cats, LABEL, prior))
    fit_rows = settle(CT.with_ordered_means(fit_rows, cats, LABEL, ROW_KEYS, prior, spent))
    val_rows = settle(CT.with_category_means(val_rows, table, cats, prior))
    discard(*spent)
    return fit_rows, val_rows, table, prior


def fit_hazard_model(panel: DataFrame, p: Params, max_iter: int = 1000, patience: int = 20,
                     written: bool = False) -> tuple[HazardModel, list[str]]:
    """Train on FIT rows, keep the round with the smallest VAL loss (TEST rows never seen).

    Rounds go on until the loss has not fallen for ``patience`` of them (or
    ``max_iter`` is reached); each is trained once.  Category means see only
    FIT rows, and a FIT row only those before it.  ``written``: see ``encoded_rows``.
    """
    feats = feature_columns(panel.columns)
    fit_rows, val_rows, table, prior = encoded_rows(panel, p, written)
    assembly = _assembly(feats, fit_rows).fit(fit_rows)
    # narrow tables of features and label are all that a round reads
    fit_rows, val_rows = (settle(assembly.transform(df).select("features", LABEL), df) for df in (fit_rows, val_rows))
    boosted = boost(fit_rows, val_rows, LABEL, max_iter, patience, MAX_DEPTH, STEP, MAX_BINS)
    discard(fit_rows, val_rows)
    return HazardModel(PipelineModel(stages=[*assembly.stages, *boosted.stages()]), table, prior, boosted.losses), feats


def predict(model: HazardModel, frame: DataFrame, feats: list[str]) -> DataFrame:
    """``frame`` with ``churn_prob``; absent feature columns count as NULL."""
    aligned = align_features(frame, feats)
    encoded = CT.with_category_means(_prepare(aligned, feats), model.categories, [c for c in CAT_COLS if c in feats], model.prior)
    return model.pipeline.transform(encoded).select(*aligned.columns, "churn_prob")


def feature_importance(model: HazardModel, feats: list[str], top: int = 25) -> list[tuple[str, float]]:
    """The trees' importances, by weight, mapped back to names (a driver-size list)."""
    names = [s for s in model.stages if isinstance(s, VectorAssembler)][0].getInputCols()
    share = dict.fromkeys(_inputs(feats), 0.0)
    for k, t in enumerate(model.trees):
        found = t.featureImportances
        for i, v in zip(found.indices, found.values):
            share[names[i]] += (1.0 if k == 0 else STEP) * float(v)
    total = sum(share.values()) or 1.0
    ranked = sorted(((n, v / total) for n, v in share.items()), key=lambda t: -t[1])[:top]
    return [(n.split("__")[0] + ("(missing)" if n.endswith("__na") else ""), float(v)) for n, v in ranked]


#: what a saved artifact must name
ARTIFACT_KEYS = ("version", "features", "categorical", "id_columns", "leakage_columns", "label", "group_column", "window_days",
                 "max_bucket", "horizon", "tiers", "high_churn_cutoff", "r_k", "multipliers", "category_prior")
ARTIFACT_VERSION = 2


@dataclass
class Artifact:
    model: HazardModel
    meta: dict
    vocab: DataFrame

    @property
    def features(self) -> list[str]:
        return self.meta["features"]

    @property
    def multipliers(self) -> dict[int, float]:
        return {int(k): v for k, v in self.meta["multipliers"].items()}


def save_artifact(model: HazardModel, feats: list[str], r: list[float], m: dict[int, float], path: str, p: Params, vocab: DataFrame) -> None:
    """The fitted pipeline, its category means, the category vocabulary, and everything a scoring run needs to know, in one folder."""
    model.pipeline.write().overwrite().save(f"{path}/model")
    model.categories.write.mode("overwrite").parquet(f"{path}/categories")
    vocab.write.mode("overwrite").parquet(f"{path}/vocab")
    meta = {"version": ARTIFACT_VERSION, "features": feats, "categorical": [c for c in CAT_COLS if c in feats], "id_columns": ID_COLS,
            "leakage_columns": LEAKAGE_COLS, "label": LABEL, "group_column": "customer_id", "window_days": p.window_days,
            "max_bucket": p.max_bucket, "horizon": p.horizon, "tiers": {"High": p.tier_high, "Medium": p.tier_medium},
            "high_churn_cutoff": p.high_churn_cutoff, "r_k": list(r), "multipliers": {str(k): v for k, v in m.items()},
            "category_prior": model.prior, "as_of": p.as_of.isoformat()}
    vocab.sparkSession.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")


def load_artifact(spark: SparkSession, path: str) -> Artifact:
    """Read a saved artifact; a missing key or another version is an error before any scoring."""
    meta = json.loads(spark.read.option("wholetext", True).text(f"{path}/meta").first()["value"])
    missing = [k for k in ARTIFACT_KEYS if k not in meta]
    if missing:
        raise ValueError(f"{path} lacks {missing}")
    if meta["version"] != ARTIFACT_VERSION:
        raise ValueError(f"{path} has version {meta['version']}, not {ARTIFACT_VERSION}")
    model = HazardModel(PipelineModel.load(f"{path}/model"), spark.read.parquet(f"{path}/categories"), meta["category_prior"])
    return Artifact(model, meta, spark.read.parquet(f"{path}/vocab"))


def score_from_artifact(artifact: Artifact, latest: DataFrame) -> DataFrame:
    """``latest`` (customer_id, order_seq, ... scoring features) with ``model_prob`` by the saved model."""
    scored = predict(artifact.model, model_frame(latest, keep=("customer_id",)), artifact.features)
    return latest.join(scored.select("customer_id", F.col("churn_prob").alias("model_prob")), "customer_id")


def unseen_categories(artifact: Artifact, latest: DataFrame) -> DataFrame:
    """Values of categorical features that the saved vocabulary does not have, with their rows."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in artifact.meta["categorical"]]))
    counted = model_frame(latest, keep=()).select(pairs.alias("p")).groupBy("p.feature", "p.value").agg(F.count(F.lit(1)).alias("rows"))
    return counted.join(artifact.vocab, ["feature", "value"], "left_anti")
