"""Bounded-space online packing of token sequences.

Every partition keeps a fixed number of open windows. A document fills whole windows first; its
rest goes best-fit into an open window. When none has room, the fullest is emitted, after the head
of the rest has filled its gap if that gap is at least MIN_PIECE tokens. What is still open at the
end of a partition is merged there, and the last open window of each partition is merged with those
of up to GROUP neighbouring partitions.

Defined cases: a null or empty text is the closing id alone; a very long text fills as many sequences
as it needs; repeated rows are packed one by one; among equally full windows the oldest is taken; a null
doc_id stays null. Extra columns are ignored; an empty table gives no pieces. Which documents share a
sequence depends on the partitioning of the input, the ids do not.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_array, id_column, slices, text_buffer

#: Tokens of a sequence, open windows of a partition, tokens of the smallest piece worth a cut.
CAPACITY, OPEN, MIN_PIECE = 2048, 64, 16
#: Partitions whose last open windows are merged in one task.
GROUP = 1024
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

#: Fixed values of the tokenizer files whose words are split here: contractions, how texts are normalised and cut into pieces.
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = CONTRACTIONS + "|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
PRE_TOKENIZERS = [
    {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
#: Letters of Latin-1: lower-cased one by one and never recomposed. What is neither ASCII nor one of them is odd.
LETTERS, LATIN = "a-zß-öø-ÿ", "À-ÖØ-öø-ÿ"
PIECES = re.compile(CONTRACTIONS + f"|[{LETTERS}]+|[0-9]|[^ \\t-\\r0-9{LETTERS}]+")
#: Something odd, and a word that has it.
ODD = re.compile(f"[^\\x00-\\x7f{LATIN}]")
ODD_WORD = re.compile(f"[^ \\t-\\r]*[^\\x00-\\x7f{LATIN}][^ \\t-\\r]*")


def byte_letters() -> list[str]:
    """The byte-level alphabet: printable bytes stand for themselves, the rest for 256, 257, ..."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


def little_endian(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Pieces(dict):
    """Pieces, or odd words, to their ids as little-endian bytes; two generations bound what is kept."""

    MOST = 100_000

    def __init__(self, encode: Callable[[str], list[int]]) -> None:
        super().__init__()
        self.encode, self.old = encode, {}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.MOST:
            self.old = dict(self)
            self.clear()
        out = self.old.get(piece)
        if out is None:
            out = little_endian(self.encode(piece))
        self[piece] = out
        return out


class Ids:
    """Texts to their ids as little-endian bytes. A tokenizer file that normalises and splits as the fixed values above say
    never joins across white space and sees each piece by itself, so pieces are cut here, all at once, and their ids are kept;
    words with odd characters, and texts that name an added token, go to the tokenizer. So do all texts for any other file."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        model, self.added = self.tokenizer.model, [t["content"].encode() for t in spec["added_tokens"]]
        plain = {"truncation": None, "padding": None, "normalizer": {"type": "Sequence", "normalizers": NORMALIZERS}, "pre_tokenizer": {"type": "Sequence", "pretokenizers": PRE_TOKENIZERS}}
        whole = all(t["special"] and not (t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"]) for t in spec["added_tokens"])
        self.known = whole and all(spec[k] == v for k, v in plain.items()) and spec["model"]["type"] == "BPE" and not spec["model"]["dropout"]
        letters = byte_letters()
        self.pieces = Pieces(lambda piece: [x.id for x in model.tokenize("".join([letters[b] for b in piece.encode()]))])
        self.odd = Pieces(self.whole)

    def forget(self) -> None:
        """Drops the ids kept so far; the next task starts anew."""
        for kept in (self.pieces, self.odd):
            kept.clear()
            kept.old = {}

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def document(self, raw: bytes) -> bytes:
        text = raw.decode("utf-8", "replace")
        if not self.known or any(x in raw for x in self.added):
            return little_endian(self.whole(text))
        ids = self.pieces.__getitem__
        if raw.isascii() or not ODD.search(text):
            return b"".join(map(ids, PIECES.findall(text.lower())))
        out, at = [], 0
        for m in ODD_WORD.finditer(text):
            out += map(ids, PIECES.findall(text[at : m.start()].lower()))
            out.append(self.odd[m[0]])
            at = m.end()
        out += map(ids, PIECES.findall(text[at:].lower()))
        return b"".join(out)


_IDS: dict[str, Ids] = {}


def ids_of(path: str) -> Ids:
    if path not in _IDS:
        _IDS[path] = Ids(path)
    return _IDS[path]


class Packer:
    """Open windows as [room, pieces]; a piece is (doc, start, ids as bytes, doc_tokens)."""

    def __init__(self, capacity: int, windows: int, least: int) -> None:
        self.capacity, self.windows, self.least, self.open, self.done = capacity, windows, least, [], []

    def add(self, piece: tuple) -> None:
        doc, start, ids, total = piece
        n, full = len(ids) // 4, self.capacity
        while n >= full:
            self.done.append([(doc, start, ids[: 4 * full], total)])
            ids, start, n = ids[4 * full :], start + full, n - full
        if not n:
            return
        best = min((w for w in self.open if w[0] >= n), key=lambda w: w[0], default=None)
        if best is None and len(self.open) >= self.windows:
            fullest = min(self.open, key=lambda w: w[0])
            if fullest[0] >= self.least:
                cut = fullest[0]
                fullest[1].append((doc, start, ids[: 4 * cut], total))
                ids, start, n = ids[4 * cut :], start + cut, n - cut
            self.done.append(fullest[1])
            self.open.remove(fullest)
            best = min((w for w in self.open if w[0] >= n), key=lambda w: w[0], default=None)
        if best is None:
            self.open.append([full - n, [(doc, start, ids, total)]])
        else:
            best[1].append((doc, start, ids, total))
            best[0] -= n
            if not best[0]:
                self.done.append(best[1])
                self.open.remove(best)

    def merge(self) -> list[tuple]:
        """Close all open windows into full sequences; the pieces of the last, not full one."""
        pieces, room, held = [p for w in sorted(self.open, key=lambda w: w[0]) for p in w[1]], self.capacity, []
        self.open = []
        for doc, start, ids, total in pieces:
            while ids:
                take = min(room, len(ids) // 4)
                held.append((doc, start, ids[: 4 * take], total))
                ids, start, room = ids[4 * take :], start + take, room - take
                if not room:
                    self.done.append(held)
                    held, room = [], self.capacity
        return held

    def take(self) -> list[list[tuple]]:
        out, self.done = self.done, []
        return out


def _rows(sequences: list[list[tuple]], first: int) -> pa.RecordBatch:
    cols: list[list] = [[] for _ in range(7)]
    for k, pieces in enumerate(sequences):
        at = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            for c, v in zip(cols, (doc, start, n, zlib.crc32(ids), total, first + k, at), strict=True):
                c.append(v)
            at += n
    arrays = [id_column(np.array(cols[0], np.int64)), *(pa.array(c, pa.int64()) for c in cols[1:])]
    return pa.record_batch([*arrays, pa.nulls(len(cols[0]), pa.binary()), pa.nulls(len(cols[0]), pa.int64())], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids", "part"])


def _pack(path: str, capacity: int, windows: int, least: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ids, packer, n = TaskContext.get().partitionId(), ids_of(path), Packer(capacity, windows, least), 0
        for batch in slices(batches):
            data, off = text_buffer(batch.column(1))
            raw, end = data.tobytes(), np.array([1], "<u4").tobytes()
            for doc, a, b in zip(id_array(batch.column(0)).tolist(), off[:-1].tolist(), off[1:].tolist(), strict=True):
                tokens = ids.document(raw[a:b]) + end
                packer.add((doc, 0, tokens, len(tokens) // 4))
            if done := packer.take():
                yield _rows(done, (part << 33) + n)
                n += len(done)
        ids.forget()
        rest = packer.merge()
        if done := packer.take():
            yield _rows(done, (part << 33) + n)
        if rest:
            out = _rows([rest], 0)
            held = pa.array([p[2] for p in rest], pa.binary())
            yield out.set_column(7, "ids", held).set_column(8, "part", pa.array([part] * len(rest), pa.int64()))

    return pack


def _merge(capacity: int, windows: int, least: int):
    def merge(group: pa.Table) -> pa.Table:
        """The last open windows of up to GROUP partitions, packed once more."""
        group = group.sort_by([("part", "ascending"), ("offset", "ascending")])
        packer = Packer(capacity, windows, least)
        for doc, start, ids, total in zip(id_array(group.column("doc_id").combine_chunks()).tolist(), *(group.column(c).to_pylist() for c in ("start", "ids", "doc_tokens")), strict=True):
            packer.add((doc, start, ids, total))
        rest = packer.merge()
        out = _rows(packer.take() + ([rest] if rest else []), (1 << 62) + (group.column("part")[0].as_py() // GROUP << 33))
        return pa.Table.from_batches([out]).drop_columns(["ids", "part"])

    return merge


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, windows: int = OPEN, least: int = MIN_PIECE) -> DataFrame:
    """One row per piece; see PIECE. tokenizer: the file's path, which every executor can open."""
    from .common import staged

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    packed = staged(rows.mapInArrow(_pack(tokenizer, capacity, windows, least), PIECE + ", ids binary, part long"), "packed")
    closed = packed.where("part is null").drop("ids", "part")
    merged = packed.where("part is not null").groupBy(F.expr(f"part div {GROUP}")).applyInArrow(_merge(capacity, windows, least), PIECE)
    return closed.unionByName(merged)
