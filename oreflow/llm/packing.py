"""Packing documents into sequences of a fixed length (operator 5).

Bounded-space online packing: a partition keeps a fixed number of open windows. A document is cut where it
fills whole sequences; its rest goes to the open window that it fits best. When it fits none, the
fullest window is emitted and a new one opened. Windows still open at the end of a partition are merged:
their pieces are laid end to end, cut at the sequence length, in groups of partitions and then groups
of groups, until one short sequence is left.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from oreflow.llm.common import written

# A worker keeps the ids of at most twice so many words, without their signs, between batches.
CACHED_WORDS = 300_000
# Bytes of text whose words are looked up together, and documents whose ids are laid out together.
AT_ONCE, TOGETHER = 16 << 20, 1_000
# Letters whose lower case is one letter, and signs that follow a word. Such words are tokenized in two parts.
_PARTS = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?%&*#$|]*)")
# Partitions, or groups of them, whose open windows are merged by one task.
MERGED = 16
ID_BYTES = 4

_tokenizers: dict[str, WordIds] = {}


class Cache:
    """The latest results of a function of many texts. What is used again stays when the older half goes."""

    def __init__(self, of: Callable[[list[str]], list[bytes]]):
        self._of = of
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        found = list(map(self._known.get, texts))
        gaps = [k for k, value in enumerate(found) if value is None]
        older = [self._older.get(texts[k]) for k in gaps]
        new = list(dict.fromkeys(texts[k] for k, value in zip(gaps, older, strict=True) if value is None))
        fresh = dict(zip(new, self._of(new), strict=True))
        for k, value in zip(gaps, older, strict=True):
            text = texts[k]
            found[k] = self._known[text] = fresh[text] if value is None else value
        if len(self._known) > CACHED_WORDS:
            self._older, self._known = self._known, {}
        return found


# A text by which to tell how a tokenizer treats white space, case and signs.
_PROBE = "Two words,  a Third\tone!! of ÄRA's 12.5\n\nend. |x| É"


class WordIds:
    """A tokenizer's ids, looked up by word where that gives the same ids.

    It does for tokenizers that drop white space, ignore case, and whose tokens reach neither over white space nor
    from letters to signs: then a text's ids are its words' ids, and a word's those of its letters and its
    signs. A batch's different words are found first, so each is looked up once. Others tokenize whole texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._parts = Cache(self._encode)
        self._by_word = b"".join(self._join(_PROBE.split())) == self._encode([_PROBE])[0]

    @classmethod
    def at(cls, path: str) -> WordIds:
        if path not in _tokenizers:
            _tokenizers[path] = cls(path)
        return _tokenizers[path]

    def _encode(self, parts: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _join(self, words: list[str]) -> list[bytes]:
        parts: list[str] = []
        for word in words:
            two = _PARTS.fullmatch(word)
            parts += (two[1].lower(), two[2]) if two else (word, "")
        ids = self._parts(parts)
        return [ids[k] + ids[k + 1] for k in range(0, len(ids), 2)]

    def of(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Unsigned 32-bit ids of every text; null counts as empty."""
        filled = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(texts):
            before = filled[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(filled, before + AT_ONCE, "right")))
            yield from self._of(texts.slice(at, end - at))
            at = end

    def _of(self, texts: pa.Array) -> Iterator[np.ndarray]:
        if not self._by_word:
            whole = self._encode(pc.fill_null(texts, "").to_pylist())
            yield from (np.frombuffer(ids, "<u4") for ids in whole)
            return
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = split.flatten().dictionary_encode()
        words = self._join(coded.dictionary.to_pylist())
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))])
        pool = np.frombuffer(b"".join(words), "<u4")
        sizes = np.array([len(ids) // ID_BYTES for ids in words], np.int64)
        starts, index = np.cumsum(sizes) - sizes, coded.indices.to_numpy()
        for k in range(0, len(texts), TOGETHER):
            bounds = ends[k : k + TOGETHER + 1]
            some = index[bounds[0] : bounds[-1]]
            n = sizes[some]
            after = np.concatenate([[0], np.cumsum(n)])
            ids = pool[np.repeat(starts[some] - after[:-1], n) + np.arange(after[-1])]
            at = after[bounds - bounds[0]]
            yield from (ids[a:b] for a, b in zip(at[:-1], at[1:], strict=True))


def sequences(
    pieces: Iterable[tuple], length: int, windows: int, first_id: int
) -> Iterator[tuple[int | None, int, tuple]]:
    """Place pieces, each (document, start, ids, document's tokens), in sequences, and yield them placed.

    Yields (sequence, offset, piece). At the end the pieces of windows still open come with None.
    """
    next_id = first_id
    free: list[int] = []  # of the open windows, and what they hold
    held: list[list[tuple[int, tuple]]] = []

    def emit(k: int):
        nonlocal next_id
        for offset, piece in held[k]:
            yield next_id, offset, piece
        next_id += 1
        del free[k], held[k]

    for doc, start, ids, total in pieces:
        n = len(ids) // ID_BYTES
        whole = n // length * length
        for at in range(0, whole, length):
            yield next_id, 0, (doc, start + at, ids[at * ID_BYTES : (at + length) * ID_BYTES], total)
            next_id += 1
        if n == whole:
            continue
        rest, n = (doc, start + whole, ids[whole * ID_BYTES :], total), n - whole
        best = min((f, k) for k, f in enumerate(free) if f >= n)[1] if any(f >= n for f in free) else None
        if best is None:
            if len(free) == windows:
                yield from emit(free.index(min(free)))
            best = len(free)
            free.append(length)
            held.append([])
        held[best].append((length - free[best], rest))
        free[best] -= n
        if not free[best]:
            yield from emit(best)
    for window in held:
        for offset, piece in window:
            yield None, offset, piece


def _rows(placed: Iterable[tuple[int | None, int, tuple]], where: int, key: str, size: int = 20_000):
    """Frames of placed pieces; the ids themselves stay only with pieces that are to be merged."""
    rows = []
    for sequence, offset, (doc, start, ids, total) in placed:
        kept = ids if sequence is None else None
        rows.append((doc, start, len(ids) // ID_BYTES, zlib.crc32(ids), total, sequence, offset, kept, where, len(rows)))
        if len(rows) >= size:
            yield _frame(rows, key)
            rows = []
    if rows:
        yield _frame(rows, key)


COLUMNS = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids", "part", "turn"]


def _frame(rows: list[tuple], key: str) -> pd.DataFrame:
    """Columns of Python values: with a missing one among them, pandas would make numbers inexact."""
    columns = zip([key, *COLUMNS], zip(*rows, strict=True), strict=True)
    return pd.DataFrame({name: pd.Series(values, dtype=object) for name, values in columns})


def _merger(key: str, schema: pa.Schema, length: int, level: int, final: bool) -> Callable[[pa.Table], pa.Table]:
    """Lays the open windows of a group end to end and cuts them. What is over goes up a level, or is the last."""

    def merge(table: pa.Table) -> pa.Table:
        table = table.sort_by([("part", "ascending"), ("turn", "ascending")])
        group = table["part"][0].as_py() // MERGED
        columns = [table[c].to_pylist() for c in (key, "start", "ids", "doc_tokens")]
        cut, fill, number = [], 0, level << 58 | group << 34
        for doc, start, ids, total in zip(*columns, strict=True):
            at, n = 0, len(ids) // ID_BYTES
            while at < n:
                take = min(n - at, length - fill)
                cut.append((number, fill, (doc, start + at, ids[at * ID_BYTES : (at + take) * ID_BYTES], total)))
                at, fill = at + take, fill + take
                if fill == length:
                    number, fill = number + 1, 0
        if not final:
            cut = [(None if fill and s == number else s, offset, piece) for s, offset, piece in cut]
        frame = pd.concat(list(_rows(cut, group, key, max(1, len(cut)))))
        return pa.Table.from_pandas(frame, schema, preserve_index=False)

    return merge


def pack(
    docs: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    end: int = 1,
    length: int = 2048,
    windows: int = 128,
) -> DataFrame:
    """Pack every document's ids, and then id ``end``, into sequences of at most ``length`` ids.

    One row per piece: the document's key, ``start`` (its ids before), ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id`` and ``offset`` there, without gaps. A null or empty text is the end id
    alone. Every input row is a document of its own, also when keys repeat or are null. An empty table
    gives no sequence. ``tokenizer`` is the path of a file for the tokenizers library, on every executor.
    """
    kind = docs.schema[key].dataType
    schema = T.StructType(
        [T.StructField(key, kind)]
        + [T.StructField(c, T.BinaryType() if c == "ids" else T.LongType()) for c in COLUMNS]
    )
    arrow = to_arrow_schema(schema)

    def online(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, part = WordIds.at(tokenizer), TaskContext.get().partitionId()
        last = np.array([end], "<u4")

        def pieces():
            for batch in batches:
                for doc, ids in zip(batch["key"].to_pylist(), ids_of.of(batch["text"]), strict=True):
                    yield doc, 0, np.append(ids, last).tobytes(), len(ids) + 1

        for frame in _rows(sequences(pieces(), length, windows, part << 34), part, key):
            yield pa.RecordBatch.from_pandas(frame, arrow, preserve_index=False)

    packed = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    packed = written(packed.mapInArrow(online, schema), "packed")
    done, open_, level = [packed.filter("sequence_id IS NOT NULL")], packed.filter("sequence_id IS NULL"), 1
    parts = packed.agg(F.max("part")).first()[0] or 0
    while parts >= 0:
        groups = -(-(parts + 1) // MERGED)
        grouped = open_.groupBy(F.floor(F.col("part") / MERGED).alias("grp"))
        merge = _merger(key, arrow, length, level, final=groups == 1)
        merged = written(grouped.applyInArrow(merge, schema), "packed")
        done.append(merged.filter("sequence_id IS NOT NULL"))
        open_, parts, level = merged.filter("sequence_id IS NULL"), groups - 1 if groups > 1 else -1, level + 1
    return reduce(DataFrame.unionByName, done).drop("ids", "part", "turn")
