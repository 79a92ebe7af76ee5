"""Document fingerprints by context-triggered piecewise hashing (operator 6).

A hash rolls over the text's bytes; where it hits a trigger value, a piece ends. Each piece becomes one
letter, so an edit changes only the letters around it. A fingerprint is ``block:letters:letters``: the
letters at a block size and at twice that. Two fingerprints are compared by the edit distance of the
letters at block sizes that they share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.llm.common import written

# The 64 letters, the most letters at a block size, and the smallest block size.
LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
MOST, SMALLEST = 64, 3
# The rolling hash sees so many bytes.
SEEN = 7
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_ODD = 0xD6E8FEB86659FD93
_INVERSE = pow(_ODD, -1, 1 << 64)
_tables = {base: np.cumprod(np.full(1 << 16, base, np.uint64)) for base in (_ODD, _INVERSE)}


def _powers(base: int, n: int) -> np.ndarray:
    """Powers 1 .. n of an odd number modulo 2**64."""
    while len(_tables[base]) < n:
        known = _tables[base]
        _tables[base] = np.concatenate([known, known * known[-1]])
    return _tables[base][:n]


def _rolling(data: np.ndarray) -> np.ndarray:
    """A 32-bit hash of the last ``SEEN`` bytes at every byte; before the text there are zeros."""
    out = np.zeros(len(data), np.uint32)
    wide = data.astype(np.uint32) + np.uint32(1)
    for back in range(min(SEEN, len(data))):
        factor = np.uint32(pow(0x01000193, back + 1, 1 << 32))
        out[back:] += wide[: len(data) - back] * factor
    out ^= out >> np.uint32(15)
    out *= np.uint32(0x85EBCA6B)
    return out ^ (out >> np.uint32(13))


def _letters(sums: np.ndarray, ends: np.ndarray) -> str:
    """A letter for each piece, from running sums of its bytes times powers of an odd number.

    The inverse power of the piece's start makes the letter the same wherever the piece stands.
    """
    starts = np.concatenate([[0], ends[:-1] + 1])
    before = np.where(starts > 0, sums[starts - 1], np.uint64(0))
    value = (sums[ends] - before) * _powers(_INVERSE, len(sums))[starts]
    mixed = (value ^ (value >> np.uint64(29))) * _MULTIPLIER
    return LETTERS[(mixed >> np.uint64(58)).astype(np.int64)].tobytes().decode()


def fingerprint(text: str) -> str:
    """``block:letters:letters`` of the whole text; the empty text has no letters.

    The block size is the smallest one of 3, 6, 12 ... at which the text has at most 64 pieces.
    """
    data = np.frombuffer(text.encode(), np.uint8)
    n = len(data)
    if not n:
        return f"{SMALLEST}::"
    rolled, block = _rolling(data), SMALLEST
    hits = np.flatnonzero(rolled % np.uint32(block) == block - 1)

    def ends(hits: np.ndarray) -> np.ndarray:
        return hits if len(hits) and hits[-1] == n - 1 else np.append(hits, n - 1)

    def at(block: int) -> np.ndarray:
        return hits[rolled[hits].astype(np.uint64) % np.uint64(block) == block - 1]

    while len(ends(hits)) > MOST:
        block *= 2
        hits = at(block)
    sums = np.cumsum((data + np.uint64(1)) * _powers(_ODD, n))
    return f"{block}:{_letters(sums, ends(hits))}:{_letters(sums, ends(at(2 * block)))}"


def edit_distances(left: Sequence[str], right: Sequence[str]) -> np.ndarray:
    """Levenshtein distances of pairs of texts of at most 64 ASCII letters, all pairs at once.

    One 64-bit word a pair holds a column of differences (Myers, Hyyroe); each letter of the right text
    is one step for all pairs.
    """
    n = len(left)
    if not n:
        return np.zeros(0, np.int64)
    m = np.array([len(x) for x in left], np.int64)
    k = np.array([len(x) for x in right], np.int64)
    pattern = np.zeros((n, MOST), np.uint8)
    text = np.zeros((n, MOST), np.uint8)
    for matrix, texts in ((pattern, left), (text, right)):
        flat = np.frombuffer("".join(texts).encode(), np.uint8)
        lengths = m if matrix is pattern else k
        matrix[np.arange(MOST) < lengths[:, None]] = flat
    one, rows = np.uint64(1), np.arange(n)
    places = np.zeros((n, 128), np.uint64)
    for i in range(MOST):
        places[rows, pattern[:, i]] |= np.where(i < m, one << np.uint64(i), np.uint64(0))
    last = one << np.maximum(m - 1, 0).astype(np.uint64)
    up, down, score = np.full(n, ~np.uint64(0)), np.zeros(n, np.uint64), m.copy()
    for j in range(int(k.max())):
        here = places[rows, text[:, j]]
        carried = (((here & up) + up) ^ up) | here
        rise, fall = down | ~(carried | up), up & carried
        live = j < k
        score += live * ((rise & last != 0).astype(np.int64) - (fall & last != 0))
        rise, fall = (rise << one) | one, fall << one
        vertical = here | down
        up, down = np.where(live, fall | ~(vertical | rise), up), np.where(live, rise & vertical, down)
    return np.where(m == 0, k, score)


def likeness(left: Sequence[str], right: Sequence[str]) -> np.ndarray:
    """0 to 1 for pairs of fingerprints: 1 for equal ones, 0 without a common block size.

    Otherwise 1 - edits / the longer length, the best of the block sizes that both have.
    """
    best = np.array([float(a == b) for a, b in zip(left, right, strict=True)])
    rows, a, b = [], [], []
    for k, (x, y) in enumerate(zip(left, right, strict=True)):
        if x != y:
            xb, *xs = x.split(":")
            yb, *ys = y.split(":")
            for i, p in enumerate(xs):
                for j, q in enumerate(ys):
                    if int(xb) << i == int(yb) << j and (p or q):
                        rows.append(k)
                        a.append(p)
                        b.append(q)
    longest = np.array([max(len(p), len(q)) for p, q in zip(a, b, strict=True)], np.float64)
    if rows:
        np.maximum.at(best, rows, 1 - edit_distances(a, b) / longest)
    return best


def _compared(key, text: list[str], following: list[str], next_print: list[str], own: list[str]) -> pd.DataFrame:
    edited = []
    for mine, after in zip(text, following, strict=True):
        cut = len(mine) // 4
        edited.append(mine[: len(mine) - cut] + after[:cut])
    prints = [fingerprint(t) for t in edited]
    return pd.DataFrame({
        "key": key, "n_chars": [len(t) for t in text],
        "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in edited],
        "fingerprint": own, "edited_fingerprint": prints,
        "near_edited": likeness(own, prints), "near_next": likeness(own, next_print),
    })


COLUMNS = {
    "n_chars": T.LongType(), "edited_sha256": T.StringType(), "fingerprint": T.StringType(),
    "edited_fingerprint": T.StringType(), "near_edited": T.DoubleType(), "near_next": T.DoubleType(),
}


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's fingerprint, next to that of an edited text and of the next document.

    In the edited text the last quarter of the code points (rounded down) is replaced by the first as
    many of the next document by ascending key; after the last comes the first. Null texts count as
    empty. Rows of one key are ordered by text, a null key comes first, a single document follows itself.
    An empty table gives an empty one.

    Documents are dealt out by ranges of the key and sorted there, so each meets the next one in its own
    task, but for the last of a range: these, one a task, are joined with the first of the next range.
    """
    kind = docs.schema[key].dataType
    columns = [T.StructField(c, t) for c, t in COLUMNS.items()]
    result = T.StructType([T.StructField("key", T.StringType()), *columns])
    edges = [("part", T.LongType()), ("first", T.StringType()), ("last", T.StringType())]
    schema = T.StructType([*result.fields, *[T.StructField(c, t) for c, t in edges]])

    def within(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, held, first = TaskContext.get().partitionId(), None, True
        for batch in batches:
            keys, texts = batch["key"].tolist(), batch["text"].fillna("").tolist()
            prints = [fingerprint(t) for t in texts]
            if held is not None:
                keys, texts, prints = [held[0], *keys], [held[1], *texts], [held[2], *prints]
            if not texts:
                continue
            held = keys[-1], texts[-1], prints[-1]
            if len(texts) > 1:
                frame = _compared(keys[:-1], texts[:-1], texts[1:], prints[1:], prints[:-1])
                frame["part"], frame["last"] = part, None
                frame["first"] = [texts[0] if first else None, *[None] * (len(frame) - 1)]
                first = False
                yield frame
        if held is not None:
            row = dict.fromkeys(schema.fieldNames()) | {"key": held[0], "fingerprint": held[2]}
            row |= {"part": part, "first": held[1] if first else None, "last": held[1]}
            yield pd.DataFrame({c: pd.Series([value], dtype=object) for c, value in row.items()})

    def across(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield _compared(*(b[c].tolist() for c in ("key", "last", "next_text", "next_print", "fingerprint")))

    # the key travels as text: among nulls, pandas would make it a number with a fraction
    rows = docs.select(F.col(key).alias("place"), F.col(text).cast("string").alias("text"))
    rows = rows.repartitionByRange("place").sortWithinPartitions("place", "text")
    rows = rows.select(F.col("place").cast("string").alias("key"), "text")
    rows = written(rows.mapInPandas(within, schema), "fingerprints")
    firsts = rows.filter("first IS NOT NULL").select(
        F.col("part").alias("next_part"), F.col("first").alias("next_text"), F.col("fingerprint").alias("next_print")
    )
    parts = firsts.select(F.col("next_part").alias("part"))
    follows = F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy()))
    parts = parts.withColumn("next_part", follows)
    lasts = rows.filter("last IS NOT NULL").select("key", "part", "last", "fingerprint")
    lasts = lasts.join(parts, "part").join(firsts, "next_part").mapInPandas(across, result)
    whole = rows.filter("last IS NULL").select(*result.fieldNames()).unionByName(lasts)
    return whole.select(F.col("key").cast(kind).alias(key), *COLUMNS)
