"""A trainable scorer on pyspark.ml: does this option answer this question on this state?

Every option of a record is one row. Its features are hashed words of the state and question crossed with
the option's words, and the option's words alone; a logistic regression learns whether it is right. Scores
are normalised over a record's options, or kept per option for multi. Training, calibration and
evaluation are DataFrame jobs; nothing is gathered on the driver but the coefficients."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.ml.pipeline import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.arrays import sigmoid, softmax
from .functions.text import norm_text
from .operators import calibrate, metrics
from .operators.dedup import shared_table

#: Hash buckets of the crossed words.
BUCKETS = 1 << 16


def option_rows(records: DataFrame, *keep: str) -> DataFrame:
    """id, type, place, label, crossed and own words: one row for each option. All distinct words of the state and the question are
    crossed with the option as a whole."""
    words = lambda c: F.array_distinct(F.filter(F.split(norm_text(c), " "), lambda w: w != ""))
    rows = records.select("id", "type", "answer", *keep, words(F.concat_ws(" ", "state", "question")).alias("_text"), F.posexplode("options").alias("place", "_option"))
    rows = rows.withColumns({"own": words(F.col("_option")), "_whole": norm_text(F.col("_option"))})
    # whether the state or the question has all words of the option
    named = F.size(F.array_except("own", "_text")) == 0
    crossed = F.transform("_text", lambda w: F.concat(w, F.lit("|"), F.col("_whole")))
    return rows.select("id", "type", "place", *keep, F.array_contains("answer", F.col("place")).cast("double").alias("label"), crossed.alias("crossed"), F.concat("own", F.array(F.concat(F.lit("n:"), F.col("place").cast("string")), F.concat(F.lit("named:"), named.cast("string")))).alias("own"))


@dataclass
class Model:
    pipeline: PipelineModel
    temperatures: dict[str, float]

    def logits(self, records: DataFrame) -> DataFrame:
        """id, z: the options' logits in their order."""
        scored = self.pipeline.transform(option_rows(records)).select("id", "place", F.get(vector_to_array("rawPrediction"), F.lit(1)).alias("z"))
        return scored.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "z"))), lambda s: s["z"]).alias("z"))

    def predict(self, records: DataFrame) -> DataFrame:
        """Predictions with id, type, source, z, p, a and y, ready for the metrics."""
        return self.predicted(records.select("id", "type", "source", "answer", F.size("options").alias("_n")).join(self.logits(records), "id"))

    def predicted(self, rows: DataFrame, *keep: str) -> DataFrame:
        """Predictions of rows that have their logits, z."""
        t = F.lit(1.0)
        for kind, value in self.temperatures.items():
            t = F.when(F.col("type") == kind, value).otherwise(t)
        rows = rows.withColumn("_t", t)
        multi = F.col("type") == "multi"
        y = F.transform(F.sequence(F.lit(0), F.col("_n") - 1), lambda i: F.array_contains("answer", i).cast("int"))
        return rows.select(*keep, "id", "type", "source", "z", F.when(multi, sigmoid(F.col("z"), F.col("_t"))).otherwise(softmax(F.col("z"), F.col("_t"))).alias("p"), F.when(~multi, F.get("answer", F.lit(0))).alias("a"), F.when(multi, y).alias("y"))

    def save(self, path: str) -> None:
        """The pipeline and the temperatures, below path."""
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        spark = SparkSession.getActiveSession()
        spark.createDataFrame(list(self.temperatures.items()), "type string, temperature double").write.mode("overwrite").parquet(f"{path}/temperatures")

    @classmethod
    def load(cls, path: str) -> Model:
        rows = SparkSession.getActiveSession().read.parquet(f"{path}/temperatures").collect()
        return cls(PipelineModel.load(f"{path}/pipeline"), {r["type"]: r["temperature"] for r in rows})


def fit(records: DataFrame, buckets: int = BUCKETS, iterations: int = 30, ridge: float = 1e-3) -> Model:
    """Learn from single and multi records; temperatures stay 1 until calibrated."""
    stages = [HashingTF(numFeatures=buckets, inputCol="crossed", outputCol="_a", binary=True), HashingTF(numFeatures=buckets // 4, inputCol="own", outputCol="_b", binary=True), VectorAssembler(inputCols=["_a", "_b"], outputCol="features"), LogisticRegression(maxIter=iterations, regParam=ridge)]
    fitted = Pipeline(stages=stages).fit(option_rows(records))
    fitted.stages[-1]._java_obj.setSummary(_none(records.sparkSession))
    return Model(fitted, {})


def _none(spark: SparkSession):
    """No training summary: it holds the session, which the model's functions would otherwise carry to the executors."""
    return getattr(spark._jvm.scala, "Option").empty()


def calibrated(model: Model, held_back: DataFrame) -> Model:
    """The model with a temperature for each type, fitted on records that it has not learned from."""
    found = calibrate.fit_temperatures(Model(model.pipeline, {}).predict(held_back), rounds=4).collect()
    return Model(model.pipeline, {r["type"]: r["temperature"] for r in found})


def evaluate(model: Model, splits: DataFrame) -> DataFrame:
    """split, version (raw or calibrated) and the summary of each: splits are records with `split`. Logits are made once."""
    asked = splits.where(F.col("split").isin("test", "zeroshot"))
    rows = asked.select("split", "id", "type", "source", "answer", F.size("options").alias("_n")).join(model.logits(asked), "id")
    rows, out = shared_table(rows, "logits"), None
    for version, m in (("raw", Model(model.pipeline, {})), ("calibrated", model)):
        for name in ("test", "zeroshot"):
            part = metrics.summarize(m.predicted(rows.where(F.col("split") == name))).select(F.lit(name).alias("split"), F.lit(version).alias("version"), "*")
            out = part if out is None else out.unionByName(part)
    return out
