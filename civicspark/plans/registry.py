"""Stored model versions: recorded by path, resolved by status, scored side by side on the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from civicspark.plans import metrics
from civicspark.plans.champion import RegistryError, champion_margin, latest_approved
from civicspark.plans.features import featurize_versions, of_version
from civicspark.plans.model import Model, load
from civicspark.session import materialize
from civicspark.settings import LATE_RATES

ENTRY = (
    "model_group string, version long, status string, created timestamp, usage string, run string, path string, "
    "recorded timestamp"
)


def record(entries: DataFrame, path: str) -> None:
    """Append entries: a new version, or a known one under its new status. Nothing is overwritten,
    so two writers never lose each other's entries."""
    shape = entries.sparkSession.createDataFrame([], ENTRY).schema
    entries.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in shape]).write.mode("append").parquet(path)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The newest entry of every version. A registry that can't be read raises: no comparison, no pass."""
    entries = spark.read.schema(ENTRY).parquet(path)
    keys = ["model_group", "version"]
    rest = [c for c in entries.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), "recorded").alias("_e")
    return entries.groupBy(*keys).agg(newest).select(*keys, "_e.*").select(*entries.columns)


def champion(registry: DataFrame, group: str) -> Row | None:
    """The newest approved version of ``group``, or None where none was ever approved."""
    row = latest_approved(registry.where(F.col("model_group") == group)).first()
    if row is not None and not row["path"]:
        raise RegistryError(f"{group} version {row['version']} is approved, but nothing is stored for it")
    return row


def _own_thresholds(models: dict[str, Model]) -> tuple[dict[str, str], dict[str, DataFrame]]:
    """Which thresholds each model's late rates need; equal ones are computed once."""
    keys, kept, seen = {}, {}, {}
    for name, m in models.items():
        if m.feature_set == "baseline":
            continue
        row = m.thresholds.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("service_name", "threshold_days").cast("decimal(38,0)")).alias("d")
        ).first()
        key = seen.setdefault((row["n"], row["d"]), f"v{len(seen)}")
        keys[name] = key
        kept.setdefault(key, m.thresholds)
    return keys, kept


def score_versions(
    models: dict[str, Model], rows: DataFrame, raw: DataFrame, communities: DataFrame, holidays: DataFrame,
    *, context: DataFrame | None = None, carry=(),
) -> DataFrame:
    """``rows`` with a column ``pred_<name>`` per model.

    The union of the features that the models' own schemas ask for is computed once; late rates
    under each version's own thresholds. Each model then reads its columns from that one table: what
    it doesn't know is carried, what it misses is null.
    """
    keys, thresholds = _own_thresholds(models)
    wide = featurize_versions(rows, raw, thresholds, communities, holidays, context=context, carry=carry)
    out = materialize(wide, "version-features")
    for name, m in models.items():
        own = {r.name: F.col(of_version(r.name, keys[name])) for r in LATE_RATES} if name in keys else {}
        out = m.predict(out.withColumns(own)).withColumnRenamed("pred", f"pred_{name}").drop(*own)
    return out.select("service_request_id", *carry, *[f"pred_{name}" for name in models])


def compare(
    registry: DataFrame, group: str, challenger: Model, rows: DataFrame, raw: DataFrame, communities: DataFrame,
    holidays: DataFrame, carry=("breach",),
) -> tuple[DataFrame, DataFrame]:
    """The challenger against the approved champion, both over ``rows``: their scores, and one row with
    ``pr_auc``, ``champion_exists``, ``champion_version``, ``champion_pr_auc`` and ``margin``.

    The champion is loaded from where the registry says it is stored and scores with its own schema
    and thresholds. Without a champion there is nothing to beat. Any error on the way is raised.
    """
    row = champion(registry, group)
    models = {"challenger": challenger}
    if row is not None:
        models["champion"] = load(registry.sparkSession, row["path"])[0]
    scores = materialize(score_versions(models, rows, raw, communities, holidays, carry=carry), "version-scores")
    found = {name: metrics.average_precision(scores, score=f"pred_{name}").select("pr_auc") for name in models}
    version = F.lit(None if row is None else row["version"]).cast("long")
    margin = champion_margin(found["challenger"], found.get("champion"))
    own = F.lit(found["challenger"].first()["pr_auc"]).cast("double")
    return scores, margin.withColumns({"pr_auc": F.round(own, 4), "champion_version": version})
