"""Functions of arrays: probabilities, shuffles and subsets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .hashing import h60


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)


def softmax(z: Column, t: Column | float = 1.0) -> Column:
    """Softmax of z / t, shifted by the largest; t is at least 1e-6."""
    t = F.greatest(t if isinstance(t, Column) else F.lit(float(t)), F.lit(1e-6))
    e = F.transform(z, lambda x: F.exp(x / t - F.array_max(z) / t))
    return F.transform(e, lambda x: x / total(e))


def sigmoid(z: Column, t: Column | float = 1.0) -> Column:
    t = F.greatest(t if isinstance(t, Column) else F.lit(float(t)), F.lit(1e-6))
    return F.transform(z, lambda x: 1.0 / (1.0 + F.exp(-F.least(F.greatest(x / t, F.lit(-60.0)), F.lit(60.0)))))


def concentration(p: Column) -> Column:
    """1 less the normalised entropy, at least 0; 1 for fewer than two options."""
    q = F.transform(p, lambda x: F.least(F.greatest(x, F.lit(1e-12)), F.lit(1.0)))
    return F.when(F.size(p) < 2, 1.0).otherwise(F.greatest(F.lit(0.0), 1.0 + total(F.transform(q, lambda x: x * F.ln(x))) / F.ln(F.size(p).cast("double"))))


def argmax(p: Column) -> Column:
    """Place of the first largest, from 0."""
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def expected(p: Column, first: Column | int = 0) -> Column:
    """Expected level, levels counted from first."""
    return total(F.transform(p, lambda x, i: x * (i + first)))


def chosen(p: Column, threshold: Column | float = 0.5) -> Column:
    """Places whose probability reaches the threshold."""
    return F.filter(F.sequence(F.lit(0), F.size(p) - 1), lambda i: F.get(p, i) >= threshold)


def sureness(p: Column) -> Column:
    """Mean over the options of the likelier side."""
    return total(F.transform(p, lambda x: F.greatest(x, 1.0 - x))) / F.size(p)


def one_hot(n: Column, answer: Column) -> Column:
    """1.0 at the places in answer."""
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.array_contains(answer, i).cast("double"))


def hash_order(options: Column, key: Column) -> Column:
    """The places of options in an order that depends on key alone."""
    return F.transform(F.array_sort(F.transform(options, lambda o, i: F.struct(h60(F.concat_ws(":", key, i.cast("string"))).alias("h"), i.alias("i")))), lambda s: s["i"])


def take(values: Column, order: Column) -> Column:
    return F.transform(order, lambda i: F.get(values, i))


def moved(answer: Column, order: Column) -> Column:
    """Places in answer after their options were put into order, ascending."""
    return F.array_sort(F.transform(answer, lambda a: (F.array_position(order, a) - 1).cast("int")))


def by_hash(values: Column, key: Column) -> Column:
    """Strings in an order that depends on key and themselves."""
    return F.transform(F.array_sort(F.transform(values, lambda o: F.struct(h60(F.concat_ws(":", key, o)).alias("h"), o.alias("o")))), lambda s: s["o"])


def subset(correct: Column, pool: Column, k: int, key: Column) -> Column:
    """pool if it has at most k values, else correct and k - 1 others, shuffled; both by hashes of key."""
    others = F.slice(by_hash(F.filter(pool, lambda o: o != correct), F.concat(F.lit("sub:"), key)), 1, k - 1)
    return F.when(F.size(pool) <= k, pool).otherwise(by_hash(F.array_append(others, correct), F.concat(F.lit("mix:"), key)))


def hard_target(type_: Column, n: Column, answer: Column, smoothing: float = 0.03, neighbour: float = 0.15) -> Column:
    """Smoothed one-hot target. A score gives neighbour to the levels beside the answer if it has more than two; multi has
    1 - s at answers and s elsewhere."""
    s = min(0.5, smoothing)
    places = F.sequence(F.lit(0), n - 1)
    a = F.get(answer, F.lit(0))
    multi = F.transform(places, lambda i: F.when(F.array_contains(answer, i), 1.0 - s).otherwise(F.lit(s)))
    beside = (a > 0).cast("int") + (a < n - 1).cast("int")
    spread = F.transform(places, lambda i: F.when(i == a, 1.0 - neighbour).when(F.abs(i - a) == 1, neighbour / beside).otherwise(0.0))
    single = F.when((type_ == "score") & (n > 2) & F.lit(neighbour > 0), spread).otherwise(one_hot(n, answer))
    single = F.transform(single, lambda x: (1 - smoothing) * x + smoothing / n) if smoothing > 0 else single
    return F.when(type_ == "multi", multi).otherwise(F.transform(single, lambda x: x / total(single)))


def soft_target(type_: Column, p: Column, answer: Column, mix: float) -> Column:
    """mix parts of the answer and the rest of p; single answers renormalised."""
    hot = one_hot(F.size(p), answer)
    both = F.zip_with(hot, p, lambda h, x: mix * h + (1 - mix) * x)
    sum_ = total(both)
    return F.when(type_ == "multi", both).when(sum_ > 0, F.transform(both, lambda x: x / sum_)).otherwise(F.transform(p, lambda x: 1.0 / F.size(p)))
