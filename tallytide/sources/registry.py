"""Results of model runs: metrics, finished work, models, comparison tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallytide.schema import LABELS, METRICS

_KEY = ("run", "framework", "model")


class Registry:
    """A table of results keyed by run, framework and model.

    Each result is one committed write, so a job that stops half-way leaves
    whole rows only, and the next one asks which models are still to do. A fresh
    start is a new run name; nothing is deleted.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.schema = T.StructType(
            [T.StructField("run", T.StringType()), *METRICS.fields, T.StructField("recorded_at", T.TimestampType())]
        )

    def results(self, run: str | None = None) -> DataFrame:
        """The latest result per key; empty if nothing was recorded."""
        try:
            rows = self.spark.read.schema(self.schema).json(f"{self.path}/metrics")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            rows = self.spark.createDataFrame([], self.schema)
        rows = rows.filter(F.col("run") == run) if run else rows
        payload = [c for c in self.schema.names if c not in _KEY]
        latest = rows.groupBy(*_KEY).agg(F.max_by(F.struct(*payload), F.col("recorded_at")).alias("_row"))
        return latest.select(*_KEY, "_row.*").select(*self.schema.names)

    def record(self, run: str, metrics: DataFrame) -> None:
        """Append metrics rows of one run."""
        known = {f.name: f.dataType for f in METRICS.fields}
        columns = [
            (F.col(c) if c in metrics.columns else F.lit(None)).cast(kind).alias(c) for c, kind in known.items()
        ]
        rows = metrics.select(F.lit(run).alias("run"), *columns, F.current_timestamp().alias("recorded_at"))
        rows.write.mode("append").json(f"{self.path}/metrics")

    def pending(self, run: str, framework: str, models: Sequence[str]) -> list[str]:
        """Models without a result in this run, in the given order."""
        wanted = self.spark.createDataFrame([(i, m) for i, m in enumerate(models)], "i int, model string")
        done = self.results(run).filter(F.col("framework") == framework).select("model")
        return [r["model"] for r in wanted.join(done, "model", "left_anti").orderBy("i").collect()]

    def save_model(self, run: str, framework: str, model: str, fitted: PipelineModel) -> None:
        fitted.write().overwrite().save(self._model_path(run, framework, model))

    def load_model(self, run: str, framework: str, model: str) -> PipelineModel | None:
        """The saved model, or None."""
        path = self._model_path(run, framework, model)
        try:
            self.spark.read.text(f"{path}/metadata").limit(1).count()
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return None
        return PipelineModel.load(path)

    def comparison(self, run: str | None = None) -> DataFrame:
        """Framework ascending, macro-F1 descending, with the F1 of every class."""
        columns = ["framework", "model", "macro_f1", "balanced_accuracy",
                   *[F.col("per_class")[c]["f1"].alias(f"f1_{c}") for c in LABELS], "train_time_s", "predict_time_s"]
        return self.results(run).select(*columns).orderBy("framework", F.desc("macro_f1"), "model")

    def _model_path(self, run: str, framework: str, model: str) -> str:
        return f"{self.path}/models/{run}/{framework}/{model}"


def write_table(df: DataFrame, path: str, order_by: Sequence, kind: str = "csv", mode: str = "error") -> None:
    """Write a result table in order, with a header if it is CSV."""
    writer = df.orderBy(*order_by).write.mode(mode)
    (writer.option("header", True).csv(path) if kind == "csv" else writer.format(kind).save(path))


def append_rows(df: DataFrame, path: str) -> None:
    """Add rows to an existing comparison table, by the names in its header."""
    header = df.sparkSession.read.option("header", True).csv(path).columns
    if sorted(header) != sorted(df.columns):
        raise ValueError(f"columns {df.columns} do not match those of the table, {header}")
    df.select(*[F.col(f"`{c}`") for c in header]).write.mode("append").option("header", True).csv(path)
