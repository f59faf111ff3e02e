"""Training, evaluation, selection and batch scoring with Spark ML."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from riskframe.functions import scalar as S
from riskframe.operators import boosting as B
from riskframe.operators import iforest as IF
from riskframe.operators import metrics as M
from riskframe.operators.keys import running_totals

SEED = 42
TEST_FRACTION = 0.2
# The reference's model settings.
GBT_A = dict(max_depth=6, rate=0.1, rounds=100, row_share=0.8, column_share=0.8, regularisation=1.0, min_hessian=1.0, seed=SEED)
# rows are drawn only every so many trees there, and that is off
GBT_B = dict(max_depth=None, max_leaves=31, rate=0.1, rounds=100, column_share=0.8, regularisation=0.0, min_hessian=1e-3, min_rows=20, seed=SEED)
IFOREST = dict(trees=100, sample_size=256, contamination=0.1, seed=SEED)


def matrix_columns(train: DataFrame, test: DataFrame | None, target: str, id_col: str, keep_id: bool = False) -> list[str]:
    """PRJ-03: numeric columns common to train and test, train order, minus target (and id)."""
    test_cols = set(test.columns) if test is not None else set(train.columns)
    return [f.name for f in train.schema.fields
            if isinstance(f.dataType, NumericType) and f.name in test_cols and f.name != target
            and (keep_id or f.name != id_col)]


def split_hash(id_col: str, seed: int = SEED):
    return F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(str(seed))))


def stratified_split(df: DataFrame, label: str, id_col: str, test_fraction: float = TEST_FRACTION,
                     seed: int = SEED) -> DataFrame:
    """ML-01 exact: per class, the ``round(f * n_class)`` rows first in md5(id:seed) order form the test split.

    The rank is an H1 running count per class (no single-partition window),
    and the same md5 makes the split reproducible in SQL.
    """
    h = df.withColumn("__h", split_hash(id_col, seed))
    ranked = running_totals(h, ["__h", id_col], {"__rank": F.lit(1).cast("bigint")}, groups=[label], few_groups=True)
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    j = ranked.join(F.broadcast(sizes), label)
    test = F.col("__rank") <= F.floor(F.col("__n") * test_fraction + 0.5)
    return j.withColumn("split", F.when(test, "validation").otherwise("train")).drop("__h", "__rank", "__n")


def hash_split(df: DataFrame, label: str, id_col: str, test_fraction: float = TEST_FRACTION, seed: int = SEED):
    """ML-01 cheap mode: a hash threshold per row (proportions hold in expectation, no ranking)."""
    u = F.conv(F.substring(split_hash(id_col, seed), 1, 8), 16, 10).cast("double") / float(16 ** 8)
    return df.withColumn("split", F.when(u < test_fraction, "validation").otherwise("train"))


@dataclass
class TrainedModel:
    name: str
    params: dict
    model: object = field(repr=False)
    order: int = 0


def fit_gbt(train: DataFrame, features: list[str], label: str, id_col: str, params: dict, name: str,
            binned: B.Binned | None = None) -> TrainedModel:
    """ML-02 / ML-03: second-order boosted trees on histograms, depth-wise or leaf-wise by the settings (``binned``: the rows, if prepared before)."""
    return TrainedModel(name, params, B.fit(train, features, label, id_col, B.Boosting(**params), binned))


def predict(tm: TrainedModel, df: DataFrame, keep: list[str]) -> DataFrame:
    """Class, probability of the positive class, decision and risk tier for every row."""
    if isinstance(tm.model, B.Model):
        out = B.predict(df, tm.model, keep)
        return out.select(*keep, (F.col("probability") > 0.5).cast("int").alias("prediction"), "probability")
    forest, features, threshold = tm.model
    s = IF.score(df, forest, features, keep)
    return s.select(*keep, IF_flag(F.col("anomaly_score"), threshold).alias("prediction"),
                    F.col("anomaly_score").alias("probability"))


def IF_flag(score, threshold):
    """FUN-17: anomaly score above the contamination threshold -> 1 (fraud)."""
    return S.outlier_flag(score, threshold)


def fit_iforest(train: DataFrame, features: list[str], id_col: str, params: dict = IFOREST,
                name: str = "isolation_forest") -> TrainedModel:
    """ML-04: forest on the training rows; threshold = score quantile at 1 - contamination."""
    forest = IF.fit(train, features, id_col, params["trees"], params["sample_size"], params["seed"])
    forest = forest.cache()
    scored = IF.score(train, forest, features, [id_col])
    thr = scored.agg(F.percentile_approx("anomaly_score", 1 - params["contamination"])).first()[0]
    return TrainedModel(name, dict(params), (forest, features, thr))


def evaluate(pred: DataFrame, label: str, name: str, params: dict, order: int) -> DataFrame:
    """ML-05: one runs-table row: model, params, AUC, precision, recall, F1."""
    r = M.classification_report(pred, label, "prediction", "probability")
    return r.select(F.lit(name).alias("model"), F.lit(order).alias("run_order"),
                    F.create_map(*[x for k, v in params.items() for x in (F.lit(k), F.lit(str(v)))]).alias("params"),
                    "auc", "precision", "recall", "f1", "tp", "fp", "tn", "fn")


def best_run(runs: DataFrame) -> DataFrame:
    """TOP-02: best F1, first run on ties (``max_by`` over a struct, no sort)."""
    key = F.struct(F.col("f1"), -F.col("run_order"))
    return runs.agg(F.max_by(F.struct(*runs.columns), key).alias("b")).select("b.*")


def model_versions(runs: DataFrame, best: DataFrame) -> DataFrame:
    """Registered versions (text numbers) with the best run staged for production."""
    best_model = best.select("model").scalar()          # scalar subquery over a one-row result
    v = runs.select(
        F.lit("fraud_detector").alias("name"), (F.col("run_order") + 1).cast("string").alias("version"),
        F.when(F.col("model") == best_model, "Production").otherwise("None").alias("stage"), "model")
    return v


def latest_version(versions: DataFrame, stage: str | None = None) -> DataFrame:
    """ML-06 / WIN-01: latest version compared as an integer (``"10" > "9"``), optionally by stage."""
    v = versions if stage is None else versions.where(F.col("stage") == stage)
    return v.groupBy("name").agg(F.max_by(F.struct(*v.columns), F.col("version").cast("int")).alias("v")).select("v.*")
