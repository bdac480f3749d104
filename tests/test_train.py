"""The trainable scorer learns a toy source and is calibrated."""

from __future__ import annotations

from pyspark.sql import functions as F

from decisionframe import train
from decisionframe.operators import metrics
from decisionframe.sources.readers import toy


def test_train_calibrate_evaluate(spark, tmp_path):
    rows = toy(spark, "delay", 300).unionByName(toy(spark, "tags", 300)).withColumn("n", F.element_at(F.split("id", ":"), -1).cast("int")).cache()
    model = train.calibrated(train.fit(rows.where("n % 3 = 0"), 1 << 12, 15), rows.where("n % 3 = 1"))
    test = rows.where("n % 3 = 2")
    single = metrics.core(model.predict(test), ["type"]).first()
    multi = metrics.multi_core(model.predict(test), ["type"]).first()
    assert single["acc"] > 0.8 and multi["option_acc"] > multi["chance"] + 0.2 and set(model.temperatures) == {"score", "multi"}
    report = train.evaluate(model, test.withColumn("split", F.lit("test"))).where("scope = 'all' and n > 0").collect()
    assert {(r["split"], r["version"]) for r in report} >= {("test", "raw"), ("test", "calibrated")}
    model.save(str(tmp_path / "model"))
    again = train.Model.load(str(tmp_path / "model"))
    assert again.temperatures == model.temperatures
    assert again.logits(test).orderBy("id").collect() == model.logits(test).orderBy("id").collect()
