"""The canonical decision record and its validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.hashing import pick
from .functions.text import blank, clean_text, is_digit_scale, norm_text, strip

TYPES = ("binary", "choice", "score", "multi")
RECORD = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("source", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("question", T.StringType()),
        T.StructField("options", T.ArrayType(T.StringType())),
        T.StructField("answer", T.ArrayType(T.IntegerType())),
        T.StructField("target", T.ArrayType(T.DoubleType())),
        T.StructField("meta", T.MapType(T.StringType(), T.StringType())),
    ]
)
COLUMNS = [f.name for f in RECORD.fields]
MAX_OPTIONS, MAX_STATE, MAX_QUESTION, MAX_OPTION = 10, 3000, 600, 160


def record(df: DataFrame, *, id: Column, source: Column | str, type: Column | str, state: Column, question: Column | Sequence[str], options: Column | Sequence[str | Column], answer: Column, kind: str = "real", target: Column | None = None, meta: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of df as records with cleaned text. answer is an array of places, or one place. Of several questions the hash of id picks
    one. Questions and options given one by one are constants, and cleaned once instead of in each row."""
    text = lambda c: F.lit(c) if isinstance(c, str) else c
    if isinstance(question, Column):
        question = clean_text(question, MAX_QUESTION)
    else:
        question = pick([clean_text(F.lit(q), MAX_QUESTION, constant=True) for q in question], "question", id)
    if isinstance(options, Column):
        options = F.transform(options, lambda o: clean_text(o, MAX_OPTION))
    else:
        options = F.array(*(clean_text(F.lit(o), MAX_OPTION, constant=True) for o in options))
    return df.select(
        id.cast("string").alias("id"),
        text(source).alias("source"),
        F.lit(kind).alias("kind"),
        text(type).alias("type"),
        clean_text(state, MAX_STATE).alias("state"),
        question.alias("question"),
        options.alias("options"),
        F.array_sort(F.array_distinct(answer)).cast("array<int>").alias("answer"),
        (F.lit(None) if target is None else target).cast("array<double>").alias("target"),
        (F.lit(None) if meta is None else meta).cast("map<string,string>").alias("meta"),
        *keep,
    )


def one(place: Column) -> Column:
    return F.array(place.cast("int"))


def invalid_reason(most: int = MAX_OPTIONS, normed: Column | None = None) -> Column:
    """'ok', or the first rule that a record breaks. normed is the normalised options, where they are there already."""
    t, o, a, q, g = (F.col(c) for c in ("type", "options", "answer", "question", "target"))
    n = F.size(o)
    in_range = F.forall(a, lambda x: x.isNotNull() & (x >= 0) & (x < n))
    normed = F.transform(o, norm_text) if normed is None else normed
    digits = F.transform(o, lambda x: x.try_cast("int").cast("long"))
    first = F.get(o, F.lit(0)).try_cast("int").cast("long")
    steps = digits == F.sequence(first, first + F.greatest(n - 1, F.lit(0)))
    sum_ = F.aggregate(g, F.lit(0.0), lambda acc, x: acc + x)
    bad = lambda condition: F.coalesce(condition, F.lit(True))
    return (
        F.when(bad(~t.isin(*TYPES)), "bad_type")
        .when(bad(F.exists(o, lambda x: x.isNull() | blank(x))), "bad_options")
        .when((n < 2) | (n > most), "option_count")
        .when(F.size(F.array_distinct(normed)) != n, "duplicate_options")
        .when(bad(~in_range | (F.size(F.array_distinct(a)) != F.size(a)) | ((t != "multi") & (F.size(a) != 1))), "answer_range")
        .when(bad(F.length(strip(q)) < 8), "short_question")
        .when(F.col("state").isNull(), "bad_state")
        .when((t == "binary") & (F.transform(o, F.lower) != F.array(F.lit("yes"), F.lit("no"))), "binary_options")
        .when((t == "score") & (n > 10), "score_levels")
        .when((t == "score") & is_digit_scale(o) & bad(~steps), "score_not_consecutive")
        .when(g.isNotNull() & bad((F.size(g) != n) | F.exists(g, lambda x: x.isNull() | (x < 0) | (x > 1 + 1e-6)) | ((t != "multi") & (F.abs(sum_ - 1.0) > 1e-3))), "bad_target")
        .otherwise("ok")
    )
