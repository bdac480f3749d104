"""Byte tokens and the layout of a model input."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Ids of padding, start, separator and option mark; bytes follow.
PAD, CLS, SEP, MASK, FIRST_BYTE = 0, 1, 2, 3, 4
MOST_QUESTION, MOST_OPTION = 128, 48


def byte_ids(c: Column) -> Column:
    """4 + each UTF-8 byte."""
    pairs = F.filter(F.split(F.hex(F.encode(F.coalesce(c, F.lit("")), "UTF-8")), r"(?<=\G.{2})"), lambda x: x != "")
    return F.transform(pairs, lambda x: F.conv(x, 16, 10).cast("int") + FIRST_BYTE)


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes, and each text's begin and length in them; null is ''."""
    texts = texts.fill_null("").cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), at[:-1], np.diff(at)


def _places(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... of n places, for each."""
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin, n)


def _lists(values: np.ndarray, n: np.ndarray, there: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()), mask=pa.array(~there))


def laid_out(question: pa.Array, options: pa.Array, state: pa.Array, most: int, most_question: int, most_option: int) -> pa.StructArray:
    """What assemble says, of a batch: whole arrays at once."""
    there = options.is_valid().to_numpy(zero_copy_only=False)
    count = options.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    (qs, q_at, q_n), (os, o_at, o_n), (ss, s_at, s_n) = _bytes(question), _bytes(options.flatten()), _bytes(state)
    q_n, o_n = np.minimum(q_n, most_question), np.minimum(o_n, most_option)
    row = np.repeat(np.arange(len(there)), count)
    upto = np.concatenate([[0], np.cumsum(o_n + 1)])
    before = q_n[row] + 2 + upto[:-1] - upto[np.cumsum(count) - count][row]  # where an option's mark would be
    fits = before + o_n + 1 + 2 <= most  # places only grow, so what follows one that does not fit does not fit either
    row, before, o_at, o_n = row[fits], before[fits], o_at[fits], o_n[fits]
    used = q_n + 2 + np.bincount(row, o_n + 1, len(there)).astype(np.int64)
    s_n = np.minimum(s_n, np.maximum(most - used - 2, 0))
    n = np.where(there, used + s_n + 2, 0)
    q_n, s_n = np.where(there, q_n, 0), np.where(there, s_n, 0)
    start = np.cumsum(n) - n
    ids = np.full(int(n.sum()), SEP, np.int32)
    ids[start[there]] = CLS
    ids[start[row] + before] = MASK
    for data, source, goal, m in ((qs, q_at, start + 1, q_n), (os, o_at, start[row] + before + 1, o_n), (ss, s_at, start + used + 1, s_n)):
        ids[_places(goal, m)] = data[_places(source, m)].astype(np.int32) + FIRST_BYTE
    pos = _lists(before, np.bincount(row, minlength=len(there)), there)
    return pa.StructArray.from_arrays([_lists(ids, n, there), pos], names=["ids", "pos"])


def assemble(question: Column, options: Column, state: Column, most: int = 512, most_question: int = MOST_QUESTION, most_option: int = MOST_OPTION) -> Column:
    """struct(ids, pos): start, question, separator, (mark, option)*, separator, state as far as there is room, separator.
    pos are the marks' places; options beyond the room are left out from the end."""

    def run(question: pa.Array, options: pa.Array, state: pa.Array) -> pa.Array:
        return laid_out(question, options, state, most, most_question, most_option)

    # said not to be deterministic, so that a filter on the result does not lay out every row a second time
    return F.arrow_udf(run, "struct<ids:array<int>,pos:array<int>>").asNondeterministic()(question, options, state)


def truncated(question: Column, options: Column, state: Column, most: int = 512, most_question: int = MOST_QUESTION, most_option: int = MOST_OPTION) -> Column:
    """Was anything cut?"""
    size = lambda c: F.octet_length(c)
    used = F.least(size(question), F.lit(most_question)) + F.aggregate(options, F.lit(0), lambda acc, o: acc + 1 + F.least(size(o), F.lit(most_option)))
    return (size(question) > most_question) | F.exists(options, lambda o: size(o) > most_option) | (size(state) > most - used - 4)
