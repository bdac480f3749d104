"""ask, decide and decide_many as DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .functions.arrays import argmax, chosen, concentration, expected, sureness
from .functions.text import infer_type
from .scorer import LexicalScorer, Scorer, score

#: Other names of the types.
ALIASES = {"noul": "binary", "boolean": "binary", "bool": "binary", "yesno": "binary", "yes/no": "binary", "yes_no": "binary", "binary": "binary", "choice": "choice", "single": "choice", "score": "score", "rating": "score", "scale": "score", "multi": "multi", "multilabel": "multi", "multi-label": "multi", "multi_label": "multi"}
MOST_OPTIONS, MOST_LEVELS = 255, 10
REQUEST = "request_id string, state map<string,string>, questions map<string,struct<type:string,instructions:string,criteria:map<string,string>,threshold:double>>"


def _quoted(c: Column) -> Column:
    """A JSON string: to_json of a list of one, without the brackets."""
    listed = F.to_json(F.array(c))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def _json(c: Column, kind: T.DataType) -> Column:
    """JSON with a blank after commas and colons."""
    if isinstance(kind, T.StringType):
        text = _quoted(c)
    elif isinstance(kind, T.ArrayType):
        text = F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: _json(x, kind.elementType)), ", "), F.lit("]"))
    elif isinstance(kind, T.MapType):
        text = F.concat(F.lit("{"), F.array_join(F.transform(F.map_entries(c), lambda e: F.concat(_quoted(e["key"].cast("string")), F.lit(": "), _json(e["value"], kind.valueType))), ", "), F.lit("}"))
    elif isinstance(kind, T.StructType):
        text = F.concat(F.lit("{"), F.concat_ws(", ", *(F.concat(_quoted(F.lit(f.name)), F.lit(": "), _json(c[f.name], f.dataType)) for f in kind)), F.lit("}"))
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit("null"))


def _value(c: Column, kind: T.DataType) -> Column:
    """A value after 'key: '. Lists and objects are JSON; of scalars, true, false and null are written as Python does."""
    if isinstance(kind, T.ArrayType | T.MapType | T.StructType):
        return F.when(c.isNull(), "None").otherwise(_json(c, kind))
    if isinstance(kind, T.BooleanType):
        return F.when(c.isNull(), "None").when(c, "True").otherwise("False")
    return F.coalesce(c.cast("string"), F.lit("None"))


def render(state: Column, kind: T.DataType) -> Column:
    """A state of this type as text: strings as they are, lists a line for each element (rendered in turn), objects a
    'key: value' line for each field. Null is empty."""
    if isinstance(kind, T.ArrayType):
        text = F.array_join(F.transform(state, lambda x: render(x, kind.elementType)), "\n")
    elif isinstance(kind, T.StructType):
        text = F.when(state.isNotNull(), F.concat_ws("\n", *(F.concat(F.lit(f"{f.name}: "), _value(state[f.name], f.dataType)) for f in kind)))
    elif isinstance(kind, T.MapType):
        text = F.array_join(F.transform(F.map_entries(state), lambda e: F.concat(e["key"].cast("string"), F.lit(": "), _value(e["value"], kind.valueType))), "\n")
    elif isinstance(kind, T.BooleanType):
        text = F.when(state, "True").when(~state, "False")
    else:
        text = state.cast("string")
    return F.coalesce(text, F.lit(""))


def render_state(state: Column) -> Column:
    """A map of strings as 'key: value' lines; a null value is empty, as a request's fields are texts."""
    return F.array_join(F.transform(F.map_entries(state), lambda e: F.concat(e["key"], F.lit(": "), F.coalesce(e["value"], F.lit("")))), "\n")


def labels(criteria: Column) -> Column:
    """Option texts of a criteria map: 'key: description', or the key alone."""
    return F.transform(F.map_entries(criteria), lambda e: F.when(F.coalesce(e["value"], F.lit("")) == "", e["key"]).otherwise(F.concat(e["key"], F.lit(": "), e["value"])))


def questions(requests: DataFrame) -> DataFrame:
    """One row for each question: request_id, name, type, state, question, options, keys, threshold and what is wrong with it."""
    names = F.create_map(*[F.lit(x) for kv in ALIASES.items() for x in kv])
    q = requests.select("request_id", render_state(F.col("state")).alias("state"), F.explode("questions").alias("name", "q"))
    q = q.select("request_id", "name", "state", F.coalesce("q.instructions", F.lit("")).alias("question"), F.coalesce("q.criteria", F.create_map().cast("map<string,string>")).alias("criteria"), F.col("q.threshold").alias("threshold"), F.try_element_at(names, F.lower(F.col("q.type"))).alias("type"), F.col("q.type").alias("given"))
    is_yes = F.col("type") == "binary"
    both = F.array(*(F.when(F.coalesce(F.try_element_at("criteria", F.lit(k)), F.lit("")) != "", F.concat(F.lit(f"{k}: "), F.element_at("criteria", F.lit(k)))).otherwise(F.lit(k)) for k in ("yes", "no")))
    q = q.withColumns({"options": F.when(is_yes, both).otherwise(labels(F.col("criteria"))), "keys": F.when(is_yes, F.array(F.lit("yes"), F.lit("no"))).otherwise(F.map_keys("criteria"))})
    n = F.size("options")
    most = F.when(F.col("type") == "score", MOST_LEVELS).otherwise(MOST_OPTIONS)
    error = (
        F.when(F.col("type").isNull(), F.concat(F.lit("unknown type: "), F.coalesce("given", F.lit("null"))))
        .when(F.trim("question") == "", "instructions are missing")
        .when(~n.between(2, most), F.concat(F.lit("needs 2 to "), most.cast("string"), F.lit(" options, has "), n.cast("string")))
        .when(F.size(F.array_distinct(F.transform("options", F.lower))) != n, "options are not unique")
    )
    return q.withColumn("error", error).drop("criteria", "given")


ANSWER = "struct<type:string,answer:string,p:double,confidence:double,expected:double,selected:array<string>,probabilities:map<string,double>,error:string>"


def answers(scored: DataFrame) -> DataFrame:
    """scored questions with `answer`, a struct by type."""
    p, keys, t = F.col("p"), F.col("keys"), F.col("type")
    ok = F.col("error").isNull()
    best = argmax(p)
    picks = chosen(p, F.coalesce("threshold", F.lit(0.5)))
    said = F.when(t == "multi", F.array_join(F.transform(picks, lambda i: F.get(keys, i)), ", ")).otherwise(F.get(keys, best))
    confidence = F.when(t == "multi", sureness(p)).when(t == "binary", F.array_max(p)).otherwise(concentration(p))
    first = F.when(F.get(keys, F.lit(0)).rlike(r"^\d+$"), F.get(keys, F.lit(0)).try_cast("int")).otherwise(0)
    rounded = F.map_from_arrays(keys, F.transform(p, lambda x: F.round(x, 4)))
    answer = F.struct(
        t.alias("type"), F.when(ok, said).alias("answer"), F.when(ok & (t == "binary"), F.round(F.get(p, F.lit(0)), 4)).alias("p"), F.when(ok, F.round(confidence, 4)).alias("confidence"),
        F.when(ok & (t == "score"), F.round(expected(p) + first, 4)).alias("expected"), F.when(ok & (t == "multi"), F.transform(picks, lambda i: F.get(keys, i))).alias("selected"), F.when(ok, rounded).alias("probabilities"), F.col("error").alias("error"),
    )
    return scored.withColumn("answer", answer.cast(ANSWER))


def ask(requests: DataFrame, scorer: Scorer | None = None, temperatures: dict[str, float] | None = None) -> DataFrame:
    """request_id, answers map(name, answer). A question that is wrong has an error and does not harm the others."""
    q = questions(requests)
    good = score(q.where("error is null"), scorer or LexicalScorer(), temperatures)
    bad = q.where("error is not null").withColumn("p", F.lit(None).cast("array<double>"))
    done = answers(good.unionByName(bad))
    return done.groupBy("request_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "answer")), lambda a, b: F.when(a["name"] < b["name"], -1).when(a["name"] > b["name"], 1).otherwise(0))).alias("answers"))


def decide(rows: DataFrame, scorer: Scorer | None = None, temperatures: dict[str, float] | None = None) -> DataFrame:
    """rows (id, state, question, options and perhaps type) with the type inferred, p, the chosen option and its probability."""
    typed = rows if "type" in rows.columns else rows.withColumn("type", infer_type(F.col("options")))
    filled = typed.withColumn("options", F.when(F.col("options").isNull() | (F.size("options") == 0), F.array(F.lit("yes"), F.lit("no"))).otherwise(F.col("options")))
    scored = score(filled, scorer or LexicalScorer(), temperatures)
    return scored.withColumns({"choice": F.get("options", argmax(F.col("p"))), "confidence": F.when(F.col("type") == "multi", sureness(F.col("p"))).otherwise(concentration(F.col("p")))})


def request_file(spark: SparkSession, source: str, target: str, scorer: Scorer | None = None, temperatures: dict[str, float] | None = None) -> None:
    """A job over JSON lines of requests: target is replaced by their answers, one line a request."""
    _answered(spark.read.schema(REQUEST).json(source), target, scorer, temperatures)


def request_stream(spark: SparkSession, source: str, target: str, checkpoint: str, scorer: Scorer | None = None, temperatures: dict[str, float] | None = None, files: int = 100) -> StreamingQuery:
    """The same for the files that are in source now and were not there at earlier starts. A batch's answers are target/batch=<id>,
    replaced if the batch runs again, so each request is answered once there whatever breaks off."""
    rows = spark.readStream.schema(REQUEST).option("maxFilesPerTrigger", files).json(source)
    answer = lambda df, k: _answered(df, f"{target}/batch={k}", scorer, temperatures)
    return rows.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _answered(requests: DataFrame, target: str, scorer: Scorer | None, temperatures: dict[str, float] | None) -> None:
    """Lines that are no request, or have no questions, have no answers, nor has a request without an id."""
    ask(requests.where("request_id is not null"), scorer, temperatures).write.mode("overwrite").json(target)


def read_answers(spark: SparkSession, target: str) -> DataFrame:
    """request_id, answers of a request job, of either kind."""
    return spark.read.schema(f"request_id string, answers map<string,{ANSWER}>").json(target).select("request_id", "answers")
