"""Mappers for tables with a layout of their own. Each takes a frame with the columns of its data, which are fixed values, and gives
records; rows that do not have what a mapper needs have none. Questions are this library's."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clip, strip
from ..schema import one
from .mappers import _made, mapped_choice, mcq_choices, pairwise, separated, shuffled_two

#: The grades of a product for a query, by the first letter of the label; the shown length of a product's points.
GRADES, POINTS = {"e": "exact match", "s": "substitute", "c": "complement", "i": "irrelevant"}, 800


def _text(c: str) -> Column:
    return strip(F.coalesce(F.col(c).cast("string"), F.lit("")))


def product_match(df: DataFrame, source: str = "products", key: str = "id") -> DataFrame:
    """esci_label, product_locale, product_title, product_bullet_point, query: four grades; locales other than us, or none, go."""
    frame = df.withColumn("_grade", F.lower(F.substring(_text("esci_label"), 1, 1)))
    state = F.concat(F.lit("Offered: "), _text("product_title"), F.lit("\n"), F.substring(_text("product_bullet_point"), 1, POINTS))
    asked = F.concat(F.lit("Somebody searches a shop for \""), _text("query"), F.lit("\". What is this product to them?"))
    return mapped_choice(frame, source, key, state, asked, "_grade", GRADES, _text("product_locale").isin("us", ""))


def plausible_event(df: DataFrame, source: str = "events", key: str = "id") -> DataFrame:
    """premise, question (cause or effect), choice1, choice2, label (0 or 1)."""
    kind = _text("question")
    asked = F.when(kind == "cause", "Which of these led to it?").when(kind == "effect", "Which of these came of it?")
    place = F.col("label").cast("string").try_cast("int")
    options = F.array(_text("choice1"), _text("choice2"))
    return _made(df, source, key, "choice", _text("premise"), asked, options, one(F.when(place.isin(0, 1), place)), asked.isNotNull() & (_text("premise") != ""))


def pleasanter(df: DataFrame, source: str = "pleasant", key: str = "id") -> DataFrame:
    """baseline and less_pleasant: which of two situations one would rather be in."""
    return pairwise(df, source, key, F.lit(""), F.coalesce("baseline", F.lit("")), F.coalesce("less_pleasant", F.lit("")), ["Who of the two has the better day?", "Which of these would one rather live through?"], labels=("Situation 1", "Situation 2"), head="Compare")


def trait_shown(df: DataFrame, source: str = "traits", key: str = "id") -> DataFrame:
    """scenario (text [SEP] trait) and label (0 or 1)."""
    return separated(df.where(F.col("label").isin(0, 1)), source, key, "scenario", "label", question="Is what the person does {t}?")


def moral_action(df: DataFrame, source: str = "morals", key: str = "id") -> DataFrame:
    """situation, intention, moral_action, immoral_action; rows with an action that is not specified go."""
    good, bad = _text("moral_action"), _text("immoral_action")
    state = F.concat(F.lit("What is going on: "), _text("situation"), F.lit("\nWhat is wanted: "), _text("intention"))
    frame = df.where(~good.isin("", "not specified") & ~bad.isin("", "not specified"))
    return shuffled_two(frame, source, key, state, F.lit("Which of the two would be right to do?"), good, bad)


def judged_turns(df: DataFrame, source: str = "judged", key: str = "id") -> DataFrame:
    """conversation_a, conversation_b (lists of role and content), winner (model_a or model_b), turn: first turns with a winner."""
    said = lambda c, k: F.coalesce(F.get(c, F.lit(k))["content"].cast("string"), F.lit(""))
    frame = df.where((F.col("turn") == 1) & F.col("winner").isin("model_a", "model_b") & (F.size("conversation_a") >= 2) & (F.size("conversation_b") >= 2))
    a_wins = F.col("winner") == "model_a"
    a, b = said("conversation_a", 1), said("conversation_b", 1)
    return pairwise(frame, source, key, said("conversation_a", 0), F.when(a_wins, a).otherwise(b), F.when(a_wins, b).otherwise(a), ["Which of these did the judge like more?"])


def two_facts(df: DataFrame, source: str = "facts", key: str = "id") -> DataFrame:
    """question, choices, answerKey, fact1, fact2: the facts are the state."""
    frame = df.withColumn("_facts", F.concat_ws(" ", _text("fact1"), _text("fact2")))
    return mcq_choices(frame, source, key, "question", "choices", "answerKey", "_facts")


def exam_item(df: DataFrame, source: str = "exam", key: str = "id") -> DataFrame:
    """question, choices (texts), answer (a place); perhaps all of them in a struct `train`."""
    frame = df.select("*", *(F.col(f"train.{c}").alias(c) for c in ("question", "choices", "answer") if c not in df.columns)) if "train" in df.columns else df
    place = F.col("answer").cast("int")
    return _made(frame, source, key, "choice", F.lit(""), _text("question"), F.col("choices"), one(F.when(place.between(0, F.size("choices") - 1), place)), F.size("choices") >= 2)


def graded_reply(df: DataFrame, source: str = "graded", key: str = "id") -> DataFrame:
    """orig_score (1 to 5), orig_criteria, orig_score1_description to 5, orig_instruction, orig_response."""
    level = F.floor(_text("orig_score").try_cast("double")).cast("int")
    steps = F.concat_ws("\n", *(F.concat(F.lit(f"{k} means "), _text(f"orig_score{k}_description")) for k in range(1, 6)))
    state = F.concat(F.lit("Looked at: "), _text("orig_criteria"), F.lit("\n"), steps, F.lit("\n\nAsked:\n"), clip(_text("orig_instruction"), 1100), F.lit("\n\nAnswered:\n"), clip(_text("orig_response"), 1100))
    return _made(df, source, key, "score", state, F.lit("Which of the levels does the answer reach?"), F.array(*(F.lit(str(k)) for k in range(1, 6))), one(F.when(level.between(1, 5), level - 1)))


#: By name: the mapper and the columns that it needs beside the key.
MAPPERS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "products": (product_match, ("esci_label", "product_locale", "product_title", "product_bullet_point", "query")),
    "events": (plausible_event, ("premise", "question", "choice1", "choice2", "label")),
    "pleasant": (pleasanter, ("baseline", "less_pleasant")),
    "traits": (trait_shown, ("scenario", "label")),
    "morals": (moral_action, ("situation", "intention", "moral_action", "immoral_action")),
    "judged": (judged_turns, ("conversation_a", "conversation_b", "winner", "turn")),
    "facts": (two_facts, ("question", "choices", "answerKey", "fact1", "fact2")),
    "exam": (exam_item, ("question", "choices", "answer")),
    "graded": (graded_reply, ("orig_score", "orig_criteria", *(f"orig_score{k}_description" for k in range(1, 6)), "orig_instruction", "orig_response")),
}


def mapped(name: str, df: DataFrame, key: str = "id") -> DataFrame:
    """The records of a table by the mapper of this name; a table that lacks a column of it raises."""
    make, needs = MAPPERS[name]
    missing = [c for c in needs if c not in df.columns and not (name == "exam" and "train" in df.columns)]
    if missing:
        raise ValueError(f"{name} needs the columns {', '.join(missing)}")
    return make(df, name, key)


def replaced(df: DataFrame, into: str, columns: list[str], changes: dict[str, str], separator: str = " ") -> DataFrame:
    """Frame preparation: columns joined into one, with the changes made in their order."""
    c = F.concat_ws(separator, *(F.coalesce(F.col(x).cast("string"), F.lit("")) for x in columns))
    for old, new in changes.items():
        c = F.replace(c, F.lit(old), F.lit(new))
    return df.withColumn(into, c)

