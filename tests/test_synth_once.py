"""The teacher writes for each job once, and jobs of one row group are dealt out to tasks."""

from __future__ import annotations

from pyspark.sql import functions as F

from decisionframe import synth


class Counting(synth.FakeTeacher):
    def __init__(self, folder: str) -> None:
        super().__init__()
        self.folder = folder

    def write(self, job: dict) -> str:
        with open(f"{self.folder}/{job['jid']}", "a") as f:
            f.write("x")
        return super().write(job)


def test_teacher_writes_once(spark, tmp_path):
    rows = synth.make_examples(synth.jobs(spark, 2, 20), Counting(str(tmp_path))).collect()
    assert len(rows) == 40 and [f.read_text() for f in tmp_path.iterdir()] == ["x"] * 40


def test_jobs_are_spread(spark):
    jobs = synth.jobs_on(spark.range(200).coalesce(1), "id", 20)
    assert jobs.select(F.spark_partition_id().alias("p")).distinct().count() > 4
