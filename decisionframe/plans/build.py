"""exclude -> augment -> validate -> exact dedup -> shuffle options -> target -> split -> repeat."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import hard_target
from ..functions.text import norm_lines, norms
from ..operators import augment as aug
from ..operators.dedup import first_wins, record_key
from ..operators.filters import exclude
from ..operators.sampling import repeat_synthetic, shuffle_options, split_of
from ..schema import invalid_reason

SPLITS = ("train", "val", "test", "zeroshot")


@dataclass
class Config:
    seed: int = 1234
    max_options: int = 10
    test_fraction: float = 0.03
    val_fraction: float = 0.03
    label_smoothing: float = 0.03
    neighbour_mass: float = 0.15
    synth_repeat: int = 2
    held_out: tuple[str, ...] = ()
    dropped: tuple[str, ...] = ()
    disabled: list[str] = field(default_factory=list)


Lookups = aug.Lookups


def no_lookups(spark) -> aug.Lookups:
    return aug.Lookups(spark.createDataFrame([], "source string, names map<string,string>"), spark.createDataFrame([], "key string, names array<string>"), spark.createDataFrame([], "question string, yes string, no string"))


def prepared(records: DataFrame, cfg: Config, deleted: DataFrame | None = None, lookups: aug.Lookups | None = None) -> DataFrame:
    """records (RECORD, source_rank, row_ord) after exclusion and augmentation, with `reason` and the normalised options, `_normed`."""
    rows = records
    if cfg.dropped:
        rows = rows.where(~F.col("source").isin(*cfg.dropped))
    if deleted is not None:
        rows = exclude(rows, deleted, cfg.disabled)
    if lookups is not None:
        rows = aug.augment(rows, lookups.labels, lookups.levels, lookups.criteria)
    # a column that is not deterministic keeps filters on `reason` above it: below, they would clean every text anew for
    # each time that a rule names it
    here = F.monotonically_increasing_id() >= 0
    rows = rows.withColumn("_lines", norm_lines(F.col("options")))
    rows = rows.withColumn("_normed", norms(F.col("options"), F.col("_lines"))).drop("_lines")
    return rows.withColumn("reason", F.when(here, invalid_reason(cfg.max_options, F.col("_normed"))))


def build(records: DataFrame, cfg: Config, deleted: DataFrame | None = None, lookups: aug.Lookups | None = None, repeat: bool = True, texts: bool = True) -> DataFrame:
    """The training set with `split` and `rep`. The first row of a key by (source_rank, row_ord) wins. Without texts the same rows
    come with id, source, kind and type only, as statistics need them: texts then end with their key, before the shuffle."""
    rows = prepared(records, cfg, deleted, lookups).where("reason = 'ok'").drop("reason")
    if not texts:
        keyed_rows = rows.select("id", "source", "kind", "type", "source_rank", "row_ord", record_key(F.col("_normed")).alias("_key_of"))
        best = first_wins(keyed_rows, F.col("_key_of"), "source_rank", "row_ord", but=("_key_of",)).withColumn("split", split(cfg))
        return repeat_synthetic(best, cfg.synth_repeat if repeat else 1)
    rows = first_wins(rows, record_key(F.col("_normed")), "source_rank", "row_ord", but=("_normed",))
    rows = shuffle_options(rows)
    target = F.coalesce("target", hard_target(F.col("type"), F.size("options"), F.col("answer"), cfg.label_smoothing, cfg.neighbour_mass))
    rows = rows.withColumns({"target": target, "split": split(cfg)})
    return repeat_synthetic(rows, cfg.synth_repeat if repeat else 1)


def split(cfg: Config) -> Column:
    return split_of(F.col("id"), F.col("source"), cfg.seed, cfg.test_fraction, cfg.val_fraction, cfg.held_out)


def split_stats(built: DataFrame) -> DataFrame:
    """By split and type, with repetitions counted: rows, and synthetic ones."""
    return built.groupBy("split", "type").agg(F.count("*").alias("n"), F.count_if(F.col("kind") == "synth").alias("synthetic"))


def source_stats(built: DataFrame) -> DataFrame:
    """By source: rows, repetitions not counted."""
    return built.where("rep = 1").groupBy("source").agg(F.count("*").alias("n"))


def loss_stats(records: DataFrame, built: DataFrame, cfg: Config, deleted: DataFrame | None = None, lookups: aug.Lookups | None = None) -> DataFrame:
    """What fell: invalid by reason, and duplicates."""
    rows = prepared(records, cfg, deleted, lookups)
    invalid = rows.where("reason <> 'ok'").groupBy("reason").agg(F.count("*").alias("n"))
    kept = built.where("rep = 1").agg(F.count("*").alias("kept"))
    valid = rows.where("reason = 'ok'").agg(F.count("*").alias("valid"))
    return invalid.unionByName(valid.crossJoin(kept).select(F.lit("duplicate").alias("reason"), (F.col("valid") - F.col("kept")).alias("n")))


def pack(built: DataFrame, max_tokens: int = 512) -> DataFrame:
    """One row for training: byte ids of question, options and state with the options' places; rows that lost an option fall."""
    from ..functions.tokens import assemble

    packed = built.withColumn("_packed", assemble(F.col("question"), F.col("options"), F.col("state"), max_tokens)).where(F.size("_packed.pos") == F.size("options"))
    answer = F.when(F.col("type") == "multi", -1).otherwise(F.get("answer", F.lit(0)))
    kinds = F.array_position(F.array(*map(F.lit, ("binary", "choice", "score", "multi"))), F.col("type")) - 1
    return packed.select("id", "source", "split", F.col("_packed.ids").alias("ids"), F.col("_packed.pos").alias("pos"), F.col("target").cast("array<float>").alias("tgt"), answer.cast("short").alias("ans"), kinds.cast("byte").alias("typ"), F.size("_packed.ids").alias("len"))
