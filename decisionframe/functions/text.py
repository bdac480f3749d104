"""Text functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as str.strip() has it: the characters of Java's Unicode class.
_EDGES = "".join(map(chr, (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: What clean_text changes within a text: control characters and other line ends, runs of blanks and of empty lines.
_UNCLEAN = r"[\x00-\x09\x0B-\x1F]|  |\n\n\n"


def bound(c: Column, use: Callable[[Column], Column]) -> Column:
    """use(c) with c computed once, however often use names it."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(_EDGES))


def blank(c: Column) -> Column:
    """strip(c) == "", at the first character that is none of white space."""
    return ~c.rlike(r"(?U:\S)")


def norm_text(c: Column) -> Column:
    """Lower case; everything but letters, digits and _ becomes a space; runs of spaces become one; null becomes ''."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c.cast("string"), F.lit(""))), r"[^\p{L}\p{N}_]+", " "))


def norm_lines(options: Column) -> Column:
    """norm_text of all options at one look, each on a line of its own. An option that has a line end itself makes more lines
    than there are options; norms() sees that."""
    joined = F.lower(F.array_join(options.cast("array<string>"), "\n", ""))
    return F.split(F.regexp_replace(F.regexp_replace(joined, r"[^\p{L}\p{N}_\n]+", " "), r"(?m)^ | $", ""), "\n")


def norms(options: Column, lines: Column) -> Column:
    """norm_text of each option; lines is norm_lines(options), best a column, as it is named twice."""
    return F.when(F.size(lines) == F.size(options), lines).otherwise(F.transform(options, norm_text))


def clean_text(c: Column, most: int = 0, constant: bool = False) -> Column:
    """Line ends to \\n, no control characters, single blanks, at most one empty line; cut after most characters, at the
    last blank if that is beyond four fifths, with " ..." after it. Null becomes ''. A constant is made a
    literal again by the optimizer, which leaves lambdas as they are, so there are none in it."""
    once = (lambda c, use: use(c)) if constant else bound

    def plain(c: Column) -> Column:
        s = F.regexp_replace(c, r"\r\n?", "\n")
        s = F.regexp_replace(s, r"[\x00-\x08\x0B-\x1F]", "")
        s = F.regexp_replace(F.regexp_replace(s, r"\t[ \t]*| [ \t]+", " "), r"\n{3,}", "\n\n")
        edges = F.concat(F.substring(c, 1, 1), F.substring(c, -1, 1))
        return F.when(c.rlike(_UNCLEAN) | edges.rlike(r"(?U:\s)"), strip(s)).otherwise(c)

    s = once(F.coalesce(c.cast("string"), F.lit("")), plain)
    if not most:
        return s

    def head(cut: Column) -> Column:
        blank = once(F.locate(" ", F.reverse(cut)), lambda back: F.when(back > 0, F.lit(most) - back).otherwise(-1))
        return once(blank, lambda blank: F.when(blank > 0.8 * most, F.substring(cut, F.lit(1), blank)).otherwise(cut))

    def short(s: Column) -> Column:
        cut = once(F.substring(s, 1, most), head)
        return F.when(F.length(s) > most, F.concat(F.rtrim(cut, F.lit(_EDGES)), F.lit(" ..."))).otherwise(s)

    return once(s, short)


def humanize(c: Column) -> Column:
    """Underscores and hyphens to blanks, camel case split, single blanks."""
    s = F.regexp_replace(F.regexp_replace(c, r"[_-]", " "), r"(?<=[a-z])(?=[A-Z])", " ")
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def value(c: Column) -> Column:
    """The value, or null where it is NaN."""
    return F.when(c.cast("string").isin("NaN", "nan"), None).otherwise(c)


def first_text(*cs: Column) -> Column:
    """The first column that is not blank, stripped; '' if all are."""
    return F.coalesce(*(F.nullif(strip(value(c).cast("string")), F.lit("")) for c in cs), F.lit(""))


def any_text(*cs: Column) -> Column:
    """first_text(*cs) != "", without the text."""
    told = F.lit(False)
    for c in cs:
        told = told | F.coalesce(~blank(value(c).cast("string")), F.lit(False))
    return told


def clip(c: Column, most: int) -> Column:
    """The first most characters, with " ..." where something was cut."""
    return F.when(F.length(c) > most, F.concat(F.regexp_replace(F.substring(c, 1, most), r"(?U:\s)+$", ""), F.lit(" ..."))).otherwise(c)


def strip_tags(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"<[^>]+>", " "), r"\s+", " "))


def fill(template: Column, **slots: Column) -> Column:
    """template with {name} replaced."""
    for name, c in slots.items():
        template = F.replace(template, F.lit("{" + name + "}"), c)
    return template


def yes_no(c: Column) -> Column:
    """0 for yes, 1 for no, null for anything else."""
    s = F.lower(strip(c.cast("string")))
    return F.when(s.isin("yes", "true", "1", "y"), 0).when(s.isin("no", "false", "0", "n"), 1)


def is_digit_scale(options: Column) -> Column:
    return (F.size(options) > 0) & F.forall(options, lambda o: o.rlike(r"^\p{Nd}+$"))


def infer_type(options: Column) -> Column:
    """binary for none or yes and no, score for consecutive digits, else choice."""
    n = F.size(options)
    lowered = F.array_sort(F.transform(options, lambda o: F.lower(strip(o))))
    numbers = F.transform(options, lambda o: o.try_cast("int"))
    steps = F.forall(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: F.get(numbers, i) == F.get(numbers, F.lit(0)) + i)
    return F.when(options.isNull() | (n == 0) | (lowered == F.array(F.lit("no"), F.lit("yes"))), "binary").when(is_digit_scale(options) & (n > 1) & steps, "score").otherwise("choice")


def labels_for(type_: Column, options: Column) -> Column:
    """The labels a judge answers with: the digits of a digit scale, places of another scale, else letters."""
    places = F.sequence(F.lit(0), F.size(options) - 1)
    return (
        F.when((type_ == "score") & is_digit_scale(options), options)
        .when(type_ == "score", F.transform(places, lambda i: i.cast("string")))
        .otherwise(F.transform(places, lambda i: F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), i + 1, F.lit(1))))
    )


def render_question(type_: Column, state: Column, question: Column, options: Column) -> Column:
    """What a judge is shown."""
    labels = labels_for(type_, options)
    numbered = lambda sign: F.array_join(F.zip_with(labels, options, lambda k, o: F.concat(k, F.lit(sign), o)), "\n")
    body = (
        F.when((type_ == "score") & is_digit_scale(options), F.concat(F.lit("CHOICES (say one of these): "), F.array_join(labels, ", ")))
        .when(type_ == "score", F.concat(F.lit("STEPS, from low to high:\n"), numbered(" = ")))
        .when(type_ == "multi", F.concat(F.lit("CHOICES, of which none, some or all may hold:\n"), numbered(") ")))
        .otherwise(F.concat(F.lit("CHOICES:\n"), numbered(") ")))
    )
    context = F.coalesce(F.nullif(state, F.lit("")), F.lit("(nothing is known)"))
    return F.concat(F.lit("STATE:\n"), context, F.lit("\n\nASKED: "), question, F.lit("\n\n"), body)


def with_criteria(question: Column, yes: Column, no: Column) -> Column:
    """A yes/no question with what yes and no mean, as far as given."""
    line = lambda k, v: F.when(F.coalesce(strip(v), F.lit("")) != "", F.concat(F.lit(f"\n{k} = "), strip(v))).otherwise("")
    return F.concat(F.regexp_replace(question, r"(?U:\s)+$", ""), line("yes", yes), line("no", no))
