"""Scans: tables, files, JSON lines, strict imports, toy sources, and the registry of sources."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, field
from fnmatch import fnmatch
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import keyed, u01
from ..operators.dedup import shared_table
from ..operators.sampling import bounded_scan, bucket_key, round_robin, scan_size
from ..schema import COLUMNS, RECORD, invalid_reason, one, record

#: What JSON lines may hold: answers are one place or a list of places.
LOOSE = T.StructType([f if f.name != "answer" else T.StructField("answer", T.StringType()) for f in RECORD.fields] + [T.StructField("_bad", T.StringType())])
#: What is tried where a text is not UTF-8, as any bytes are valid in it.
FALLBACK = "ISO-8859-1"


def encoding_of(spark: SparkSession, path: str | list[str]) -> str:
    """UTF-8, or FALLBACK if a line at path is no valid UTF-8. Stops at the first such line."""
    return FALLBACK if spark.read.text(path, recursiveFileLookup=True).where(~F.is_valid_utf8("value")).take(1) else "UTF-8"


def _in_lines(spark: SparkSession, path: str | list[str]) -> bool:
    """Whether the first line with anything on it is JSON by itself."""
    first = spark.read.text(path, recursiveFileLookup=True).where(F.trim("value") != "").take(1)
    try:
        return not first or json.loads(first[0][0]) is not None
    except ValueError:
        return False


def read_table(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """CSV, TSV, JSON or Parquet by extension; bad rows of text formats are dropped. JSON is read line by line if its first line is
    JSON, else as one value a file. Text is UTF-8, or else Latin-1, unless an encoding is given; fields of CSV and TSV may be quoted
    and span lines."""
    first = path if isinstance(path, str) else path[0]
    suffix = Path(first.rstrip("*")).suffix.lower()
    if suffix == ".parquet":
        return spark.read.parquet(*([path] if isinstance(path, str) else path))
    encoding = options.pop("encoding", None) or encoding_of(spark, path)
    if suffix in (".jsonl", ".ndjson", ".json"):
        lines = options.pop("multiLine", None) is not True and _in_lines(spark, path)
        # lines are split before they are decoded only if told how they end
        return spark.read.options(**({"lineSep": "\n"} if lines else {"multiLine": True}), mode="DROPMALFORMED", encoding=encoding, **options).json(path)
    sep = options.pop("sep", "\t" if suffix in (".tsv", ".tab") else ",")
    return spark.read.options(**{"header": True, "mode": "DROPMALFORMED", "sep": sep, "multiLine": True, "escape": '"', "encoding": encoding, **options}).csv(path)


def files_below(spark: SparkSession, root: str, pattern: str) -> list[str]:
    """Files at any depth below root whose path from there, or name, matches the pattern; sorted. Names only are looked at."""
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(root)
    system = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(top):
        return []
    found, walk, base = [], system.listFiles(top, True), system.makeQualified(top).toString().rstrip("/") + "/"
    while walk.hasNext():
        name = walk.next().getPath().toString()
        below = name.removeprefix(base)
        if not any(x.startswith((".", "_")) for x in below.split("/")) and (fnmatch(below, pattern) or fnmatch(below.rsplit("/", 1)[-1], pattern)):
            found.append(name)
    return sorted(found)


def read_files(spark: SparkSession, root: str, patterns: dict[str, dict[str, str]], prep: Callable[[DataFrame], DataFrame] | None = None, all_files: bool = True, sample: int | None = None, key: str | None = None) -> DataFrame:
    """The files below root that match a pattern, each pattern with its constant columns, put together by column name: all of
    them, or the first of each pattern. sample keeps so many rows, by the hash of key. A pattern without files raises."""
    out = None
    for pattern, constants in patterns.items():
        files = files_below(spark, root, pattern)
        if not files:
            raise FileNotFoundError(f"{root}: no file matches {pattern}")
        df = read_table(spark, files if all_files else files[:1])
        df = df.withColumns({k: F.lit(v) for k, v in constants.items()}) if constants else df
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise ValueError("read_files needs a pattern")
    out = prep(out) if prep else out
    return bounded_scan(out, key or out.columns[0], sample) if sample is not None else out


def records_of(loose: DataFrame) -> DataFrame:
    """Loosely typed records with answers as arrays."""
    a = F.col("answer")
    places = F.when(a.startswith("["), F.from_json(a, "array<int>")).otherwise(F.array(a.try_cast("int")))
    return loose.withColumn("answer", places).select(*COLUMNS)


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Records from JSON lines. Blank and broken lines are skipped; a missing file is empty."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(where)
    if found is None or not len(found):
        return spark.createDataFrame([], RECORD)
    return records_of(spark.read.schema(LOOSE).options(mode="PERMISSIVE", columnNameOfCorruptRecord="_bad").json(path).where("_bad is null and question is not null"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line (from 1), value: the lines of text files, which Spark cuts into parts as it likes.

    Lines are staged with the part they are of and their order in it; the parts' numbers of lines, added up along a file, are the
    numbers that its lines begin with. So no task reads more of a file than a part, and only the parts' counts are sorted."""
    at = F.col("_metadata")
    lines = spark.read.text(path).select(at["file_path"].alias("file"), at["file_block_start"].alias("start"), F.monotonically_increasing_id().alias("_at"), "value")
    lines = shared_table(lines, "lines")
    parts = lines.groupBy("file", "start").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("file", "start", "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    return lines.join(parts, ["file", "start"]).select("file", (F.col("_before") + F.col("_at") - F.col("_first") + 1).alias("line"), "value")


def load_records(spark: SparkSession, path: str, source: str | None = None) -> DataFrame:
    """A strict import of JSON lines: the first line that is no valid record raises with its file, number and reason; a path without
    records raises."""
    name = source or "import:" + Path(path).stem
    lines = numbered_lines(spark, path).where(F.trim("value") != "")
    rows = lines.select("file", "line", F.from_json("value", LOOSE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r")).select("file", "line", "r.*")
    bad_json = F.col("_bad").isNotNull()
    rows = rows.withColumns({"source": F.coalesce("source", F.lit(name)), "kind": F.coalesce("kind", F.lit("real")), "state": F.coalesce("state", F.lit(""))})
    fixed = rows.withColumn("answer", F.when(F.col("answer").startswith("["), F.from_json("answer", "array<int>")).otherwise(F.array(F.col("answer").try_cast("int"))))
    judged = fixed.withColumn("reason", F.when(bad_json, "bad_json").when(F.col("id").isNull(), "no_id").otherwise(invalid_reason()))
    first = judged.where("reason <> 'ok'").orderBy("file", "line").select("file", "line", "reason").take(1)
    if first:
        where = path if first[0]["file"].endswith(Path(path).name) else first[0]["file"]
        raise ValueError(f"{where}:{first[0]['line']}: {first[0]['reason']}")
    if not judged.take(1):
        raise ValueError(f"{path}: no records")
    return judged.select(*COLUMNS)


def fingerprint(spark: SparkSession, path: str) -> str:
    """sha256 over the sha256 of all files at path, by name."""
    rows = spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("h")).orderBy("path").collect()
    return hashlib.sha256("".join(r["h"] for r in rows).encode()).hexdigest()


def batch_name(path: str, index: int) -> str:
    return f"import:{index}:{Path(path).stem}"


def synth_records(spark: SparkSession, root: str) -> DataFrame:
    """Accepted records of the closed shards only: those with a .done marker beside them."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "shard_*").load(root).select("path").collect()
    names = {r[0] for r in listed}
    closed = sorted(p for p in names if p.endswith(".jsonl") and p[: -len(".jsonl")] + ".done" in names)
    if not closed:
        return spark.createDataFrame([], RECORD)
    rows = spark.read.json(closed)
    return records_of(rows.where("status = 'accepted' and record is not null").select(F.from_json(F.to_json("record"), LOOSE).alias("r")).select("r.*"))


def distinct_values(df: DataFrame, *columns: str, most: int = 100_000) -> dict[str, list[str]]:
    """Sorted distinct values of label columns as strings, without null and 'nan'. More than `most` raise: they are no labels."""
    out = {}
    for c in columns:
        rows = df.select(F.col(c).cast("string").alias("v")).where("v is not null and lower(v) <> 'nan'").distinct().orderBy("v").limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"{c} has more than {most} distinct values")
        out[c] = [r[0] for r in rows]
    return out


# --- toy sources ------------------------------------------------------------------------------------------------------


def _below(n: int, *parts) -> F.Column:
    return (keyed(*parts) % n).cast("int")


#: What the toy records are about.
PIECES = ("cup", "fork", "knife", "plate", "spoon")
SELLERS = ("Ada", "Bo", "Cy", "Dee", "Eli")


def toy_on(rows: DataFrame, name: str, key: str, seed: int = 1234) -> DataFrame:
    """A toy record for each row, drawn by the hash of its key; answers follow from the states.

    stock (binary): do two deliveries cover a request; cheapest (choice): who asks the least for one piece, of offers for several;
    tags (multi): which pieces are not in a list; delay (score): how far from six o'clock, in five levels."""
    i, s = F.col(key), str(seed)
    draw = lambda what, k, *more: _below(k, name, s, i, what, *more)
    make = lambda df, **given: record(df, id=F.concat(F.lit(f"toy:{name}:"), i.cast("string")), source=f"toy:{name}", **given)
    places = lambda k: F.sequence(F.lit(0), k - 1)
    if name == "stock":
        rows = rows.withColumns({"_a": draw("a", 60), "_b": draw("b", 60), "_c": draw("c", 120)})
        state = F.format_string("Two carts brought %d and %d crates to an empty shelf. In the evening %d crates were asked for.", "_a", "_b", "_c")
        return make(rows, type="binary", state=state, question=F.lit("Could the evening's request be met in full?"), options=F.array(F.lit("yes"), F.lit("no")), answer=one(F.when(F.col("_a") + F.col("_b") >= F.col("_c"), 0).otherwise(1)))
    if name == "delay":
        hour = draw("hour", 11) + 1
        level = F.element_at(F.array(*(F.lit(k) for k in (0, 1, 2, 2, 3, 4))), (F.abs(hour - 6) + 1).cast("int"))
        return make(rows, type="score", state=F.format_string("The letter was posted at %d o'clock.", hour), question=F.lit("How far from six o'clock was that, on a scale of 1 to 5?"), options=F.array(*(F.lit(str(k)) for k in range(1, 6))), answer=one(level))
    if name == "cheapest":
        rows = rows.withColumns({"_k": draw("k", 4) + 2, "_step": draw("step", 4) + 1, "_base": draw("base", 20) + 5})
        # five is prime, so steps from any begin give each offer a price of its own
        each = F.transform(places(F.col("_k")), lambda j: F.col("_base") + 3 * ((j * F.col("_step") + F.col("_base")) % 5))
        rows = rows.withColumn("_each", each)
        offers = F.transform("_each", lambda p, j: F.concat(F.element_at(F.array(*map(F.lit, SELLERS)), j + 1), F.lit(" sells "), (2 + j + F.col("_step")).cast("string"), F.lit(" pieces for "), (p * (2 + j + F.col("_step"))).cast("string")))
        return make(rows, type="choice", state=F.concat(F.array_join(offers, ", "), F.lit(".")), question=F.lit("Who asks the least for one piece?"), options=F.slice(F.array(*map(F.lit, SELLERS)), F.lit(1), F.col("_k")), answer=one(F.array_position("_each", F.array_min("_each")) - 1))
    if name == "tags":
        rows = rows.withColumns({"_k": draw("k", 3) + 3}).withColumn("_there", F.filter(places(F.col("_k")), lambda j: keyed(name, s, i, "there", j) % 2 == 0))
        options = F.slice(F.array(*map(F.lit, PIECES)), F.lit(1), F.col("_k"))
        listed = F.array_join(F.array_append(F.transform("_there", lambda j: F.element_at(F.array(*map(F.lit, PIECES)), j + 1)), F.lit("a cloth")), ", ")
        return make(rows, type="multi", state=F.concat(F.lit("On the table lie "), listed, F.lit(".")), question=F.lit("What is still missing from the table?"), options=options, answer=F.array_except(places(F.col("_k")), "_there"))
    raise KeyError(name)


def toy(spark: SparkSession, name: str, n: int, seed: int = 1234) -> DataFrame:
    """n toy records."""
    return toy_on(spark.range(n), name, "id", seed)


# --- registry ---------------------------------------------------------------------------------------------------------


@dataclass
class Source:
    """A source: how to read it, how to map it, and what it is."""

    name: str
    type: str
    map: Callable[[DataFrame], DataFrame]
    read: Callable[[SparkSession], DataFrame] | None = None
    configs: dict[str, Callable[[SparkSession], DataFrame]] = field(default_factory=dict)
    origin: str = "local"
    key: str = "id"
    scale: float = 1.0
    prep: Callable[[DataFrame], DataFrame] | None = None
    version: int = 1
    note: str = ""


class Registry:
    """Sources by name; a later one of the same name wins."""

    def __init__(self) -> None:
        self.sources: dict[str, Source] = {}

    def add(self, *sources: Source) -> None:
        self.sources |= {s.name: s for s in sources}

    def enabled(self, wanted: list[str] | None = None, excluded: list[str] = (), without_origins: tuple[str, ...] = ()) -> tuple[list[Source], list[str]]:
        """The wanted sources (all if none are named) without the excluded ones, and the names that are unknown."""
        names = wanted or list(self.sources)
        found = [self.sources[n] for n in names if n in self.sources and n not in excluded and self.sources[n].origin not in without_origins]
        return found, [n for n in names if n not in self.sources]

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(s.name, s.type, s.origin, s.version, s.note) for s in self.sources.values()], "name string, type string, origin string, version int, note string")


def load(spark: SparkSession, source: Source, want: int, seed: int = 1234) -> DataFrame:
    """Up to want * scale valid records of a source, balanced by label. A config that cannot be read is left out."""
    if source.name.startswith("toy:"):
        return toy(spark, source.name.split(":", 1)[1], want, seed)
    want = int(want * source.scale)
    frames, failed = [], []
    for name, read in (source.configs or {"": source.read}).items():
        try:
            df = read(spark)
            df.schema  # noqa: B018  reads the footer or header
            frames.append(df)
        except Exception as e:  # a config may be missing; all of them may not
            failed.append(f"{name}: {e}")
    if not frames:
        raise ValueError(f"{source.name}: nothing could be read ({'; '.join(failed)[:500]})")
    per = want if len(frames) == 1 else max(2000, want * 2 // len(frames))
    out = None
    for df in frames:
        df = bounded_scan(source.prep(df) if source.prep else df, source.key, scan_size(per), seed)
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    mapped = source.map(out)
    bucket = F.col("bucket").cast("string") if "bucket" in mapped.columns else bucket_key()
    mapped = mapped.where(invalid_reason() == "ok").withColumn("_b", bucket)
    return round_robin(mapped, "_b", "id", want).select(*COLUMNS)
