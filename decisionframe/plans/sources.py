"""Records by source, of which only those whose input has changed are made again.

A marker table beside the records has a row for each source: the key of what it was made of, its number of rows, when. A source's
key is a hash of its name, version and settings and of its input: the paths, lengths and times of the files that its frame reads, which
the driver knows from planning the scan, so nothing is read to tell whether anything has changed. Sources whose key is new are
written together by one job that replaces their `source=` partitions and no others (dynamic partition overwrite); their markers are
written after that, so a build that is broken off leaves records whose markers are old, and the next one makes them again.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import shared_table
from ..schema import COLUMNS
from ..sources.sinks import replace_sources

MARKER = "source string, key string, n long, at double, state string, message string"


@dataclass(frozen=True)
class Source:
    """read gives the table, make the records of it; settings are all that make's result depends on beside the table."""

    name: str
    read: Callable[[SparkSession], DataFrame]
    make: Callable[[DataFrame], DataFrame]
    settings: dict[str, object] = field(default_factory=dict)
    version: int = 1


def files_of(df: DataFrame) -> list[tuple[str, int, int]]:
    """Path, length and time of the files that a frame reads."""
    spark, out = df.sparkSession, []
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for name in sorted(df.inputFiles()):
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext._jvm.java.net.URI.create(name))
        status = where.getFileSystem(hadoop).getFileStatus(where)
        out.append((name, status.getLen(), status.getModificationTime()))
    return out


def key_of(source: Source, table: DataFrame) -> str:
    parts = [source.name, source.version, source.settings, files_of(table)]
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()


def markers(spark: SparkSession, path: str) -> dict[str, dict]:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/markers/_SUCCESS")
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return {}
    return {r["source"]: r.asDict() for r in spark.read.schema(MARKER).parquet(f"{path}/markers").collect()}


def build(spark: SparkSession, sources: list[Source], path: str, force: bool = False) -> dict[str, str]:
    """Brings path/records up to date; what happened to each source: kept, built, or skipped with the reason.

    A source that has no usable rows, or whose plan fails, is skipped: its old partition stays, and it is tried again next time."""
    if len({s.name for s in sources}) < len(sources):
        raise ValueError("two sources have one name")
    old, said, parts, keys = markers(spark, path), {}, [], {}
    for s in sources:
        try:
            table = s.read(spark)
            key = key_of(s, table)
            if not force and s.name in old and old[s.name]["key"] == key and old[s.name]["state"] == "done":
                said[s.name] = "kept"
                continue
            made = s.make(table).select(*COLUMNS)
            parts.append(made.withColumn("source", F.lit(s.name)))
            keys[s.name] = key
        except Exception as e:  # noqa: BLE001
            said[s.name] = "skipped: " + (str(e).splitlines() or [repr(e)])[0][:200]
    if parts:
        rows = shared_table(reduce(DataFrame.unionByName, parts), "records")
        counts = {r["source"]: r["count"] for r in rows.groupBy("source").count().collect()}
        said |= {name: "built" if counts.get(name) else "skipped: no usable rows" for name in keys}
        if counts:
            replace_sources(rows, f"{path}/records")
        fresh = [(name, keys[name], counts[name], time.time(), "done", "") for name in keys if counts.get(name)]
        stay = [tuple(r[c] for c in ("source", "key", "n", "at", "state", "message")) for name, r in old.items() if name not in {x[0] for x in fresh}]
        spark.createDataFrame(stay + fresh, MARKER).coalesce(1).write.mode("overwrite").parquet(f"{path}/markers")
    return said


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of the sources that have a marker."""
    done = [name for name, r in markers(spark, path).items() if r["state"] == "done"]
    return spark.read.parquet(f"{path}/records").where(F.col("source").isin(done))
