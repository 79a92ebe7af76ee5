"""Brown class-based n-gram language model (operator 3).

A text's probability is that of its words' classes, each given the class before, times that of each word in
its class. Exchange clustering assigns the classes: a word moves to the class where the corpus becomes most
probable, until none moves.

What is clustered are units: words that training met a few times, and the endings of all others. A word that shares
a unit is emitted by its count among the unit's words, less a discount. What the discounts leave is the
probability of an unknown word in that unit: as in the base score, all words that training did not meet are one word.

Exchange goes in two steps. The most frequent units are exchanged one by one, with all counts of pairs at hand. Then
Spark counts, for every other word, the classes before and after it, over all texts; tasks move each word to the
class that gains most, and the round is kept if the corpus became more probable. The words of units travel to
the tasks, up to a bound; the counts of the others are joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.llm.common import written

END = ""  # the word that ends a text; no other is empty


@dataclass(frozen=True)
class Sizes:
    """``words`` that are exchanged one by one, with ``endings``, into ``classes``; code points of an ending; ``head``
    bounds the words that are units, of at least ``least`` occurrences; passes of the first step, ``rounds`` of
    the second, and how much is taken off a count."""

    words: int = 640
    endings: int = 382
    classes: int = 48
    ending: int = 3
    head: int = 1 << 17
    least: int = 3
    passes: int = 12
    rounds: int = 1
    discount: float = 0.75


def tokens(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Words of a batch, A-Z lower-cased, and the bounds of each text among them. Null counts as empty."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = split.flatten()
    some = pc.greater(pc.binary_length(flat), 0)
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))])
    kept = np.concatenate([[0], np.cumsum(some.to_numpy(zero_copy_only=False))])
    return flat.filter(some).dictionary_encode(), kept[ends]


def parts(batches: Iterator[pa.RecordBatch], rows: int = 2500) -> Iterator[pa.RecordBatch]:
    """Smaller batches, for less memory."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def count_words(texts: DataFrame) -> DataFrame:
    """``word`` and ``n`` over all rows of ``text``, with one ``END`` for each row."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            words, bounds = tokens(batch["text"])
            n = np.bincount(words.indices.to_numpy(zero_copy_only=False), minlength=len(words.dictionary))
            yield pa.RecordBatch.from_arrays([words.dictionary.cast(pa.string()), pa.array(n, pa.int64())], ["word", "n"])
            yield pa.RecordBatch.from_arrays([pa.array([END]), pa.array([len(bounds) - 1], pa.int64())], ["word", "n"])

    return texts.mapInArrow(of, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _endings(words: pa.Array, size: int) -> pa.Array:
    return pc.utf8_slice_codeunits(words, -size, None)


@dataclass
class Units:
    """The units: 0 ends a text, 1 is every word that has no other, then words, then endings."""

    words: pa.Array
    endings: pa.Array
    size: int

    def __len__(self) -> int:
        return 2 + len(self.words) + len(self.endings)

    def of(self, words: pa.Array) -> np.ndarray:
        own = pc.index_in(words, value_set=self.words)
        shared = pc.index_in(_endings(words, self.size), value_set=self.endings)
        own = pc.fill_null(own, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        shared = pc.fill_null(shared, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        return np.where(own >= 0, own + 2, np.where(shared >= 0, shared + 2 + len(self.words), 1))

    def sequence(self, words: pa.DictionaryArray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Units of all tokens, with the end after each text, and where the texts end in that."""
        of_word = self.of(words.dictionary) if len(words.dictionary) else np.zeros(0, np.int64)
        units = of_word[words.indices.to_numpy(zero_copy_only=False)]
        ends = bounds[1:] + np.arange(len(bounds) - 1)
        return np.insert(units, bounds[1:], 0), ends


def count_pairs(texts: DataFrame, units: Units) -> np.ndarray:
    """How often each unit follows each other over all rows of ``text``; a text follows an end."""
    n = len(units)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n * n, np.int64)
        for batch in parts(batches):
            if batch.num_rows:
                sequence, _ = units.sequence(*tokens(batch["text"]))
                total += np.bincount(np.concatenate([[0], sequence[:-1]]) * n + sequence, minlength=n * n)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    rows = texts.mapInArrow(of, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    found = np.zeros(n * n)  # at most as many rows as pairs of units
    found[rows["at"].to_numpy()] = rows["n"].to_numpy()
    return found.reshape(n, n)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(pairs: np.ndarray, classes: int, passes: int) -> np.ndarray:
    """The class of every unit. Units are taken by frequency; each moves to the class that gains most."""
    n = len(pairs)
    classes = max(1, min(classes, n))
    order = np.argsort(-(pairs.sum(0) + pairs.sum(1)), kind="stable")
    label = np.empty(n, np.int64)
    label[order] = np.arange(n) % classes
    member = np.zeros((n, classes))
    member[np.arange(n), label] = 1
    into, out = pairs @ member, pairs.T @ member  # of a unit: pairs with a class after it, and before it
    table = member.T @ into
    for _ in range(passes):
        moved = 0
        for u in order:
            own, here = label[u], pairs[u, u]
            right, left = into[u].copy(), out[u].copy()
            right[own] -= here
            left[own] -= here
            table[own] -= right
            table[:, own] -= left
            table[own, own] -= here
            rows, columns = table.sum(1), table.sum(0)
            gain = (_xlogx(table + right) - _xlogx(table)).sum(1) + (_xlogx(table.T + left) - _xlogx(table.T)).sum(1)
            d = np.diag(table)
            both = _xlogx(d + right + left + here) - _xlogx(d)
            gain += both - (_xlogx(d + right) - _xlogx(d)) - (_xlogx(d + left) - _xlogx(d))
            gain -= _xlogx(rows + right.sum() + here) - _xlogx(rows) + _xlogx(columns + left.sum() + here) - _xlogx(columns)
            best = int(gain.argmax()) if gain.max() > gain[own] + 1e-9 else own
            table[best] += right
            table[:, best] += left
            table[best, best] += here
            if best != own:
                label[u], moved = best, moved + 1
                into[:, own] -= pairs[:, u]
                into[:, best] += pairs[:, u]
                out[:, own] -= pairs[u]
                out[:, best] += pairs[u]
        if not moved:
            break
    return label


def _gains(after: np.ndarray, before: np.ndarray, table: np.ndarray, own: np.ndarray) -> np.ndarray:
    """How much the corpus gains from each word in each class: of words with counts of the classes after and before
    them, which are in class ``own`` now. What a word is beside itself is left out."""
    out = np.empty(after.shape)
    for k in range(len(out)):
        t = table.copy()
        t[own[k]] -= after[k]
        t[:, own[k]] -= before[k]
        t = np.maximum(t, 0)
        rows, columns = t.sum(1), t.sum(0)
        gain = (_xlogx(t + after[k]) - _xlogx(t)).sum(1) + (_xlogx(t.T + before[k]) - _xlogx(t.T)).sum(1)
        gain -= _xlogx(rows + after[k].sum()) - _xlogx(rows) + _xlogx(columns + before[k].sum()) - _xlogx(columns)
        out[k] = gain
    return out


def _likelihood(table: np.ndarray) -> float:
    """What the classes add to the log probability of the corpus."""
    return float(_xlogx(table).sum() - _xlogx(table.sum(0)).sum() - _xlogx(table.sum(1)).sum())


def count_classes(texts: DataFrame, units: Units, label: np.ndarray, first: int | None) -> tuple[np.ndarray, DataFrame]:
    """How often each class follows each other, and a table ``word``, ``slot``, ``n``: for the words of the units from
    ``first`` on, none if that is None, the classes after (slot is the class) and before (the class, and all
    classes further on)."""
    classes = int(label.max()) + 1
    free = max(0, 2 + len(units.words) - first) if first is not None else 0
    width = 2 * classes

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, cells = np.zeros(classes * classes, np.int64), np.zeros(free * width, np.int32)
        for batch in parts(batches):
            if batch.num_rows:
                sequence, _ = units.sequence(*tokens(batch["text"]))
                kinds = label[sequence]
                previous = np.concatenate([label[:1], kinds[:-1]])
                table += np.bincount(previous * classes + kinds, minlength=classes * classes)
                if not free:
                    continue
                here = np.flatnonzero((sequence >= first) & (sequence < first + free))
                word = (sequence[here] - first) * width
                for at in (word + kinds[here + 1], word + classes + previous[here]):
                    places, n = np.unique(at, return_counts=True)
                    cells[places] += n.astype(np.int32)
        for word, counts in ((0, cells), (-1, table)):
            at = np.flatnonzero(counts)
            for k in range(0, len(at), 100_000):
                some = at[k : k + 100_000]
                words = np.full(len(some), -1) if word else some // width
                slots = some if word else some % width
                columns = [pa.array(c, pa.int64()) for c in (words, slots, counts[some])]
                yield pa.RecordBatch.from_arrays(columns, ["word", "slot", "n"])

    rows = texts.mapInArrow(of, "word long, slot long, n long").groupBy("word", "slot").agg(F.sum("n").alias("n"))
    rows = written(rows, "classes")
    found, table = rows.filter("word < 0").toArrow(), np.zeros(classes * classes)
    table[found["slot"].to_numpy()] = found["n"].to_numpy()
    return table.reshape(classes, classes), rows.filter("word >= 0")


def move_words(found: DataFrame, table: np.ndarray, label: np.ndarray, first: int) -> np.ndarray:
    """The labels after every word counted has moved to its best class; words of a task at a time."""
    classes, at_once = len(table), 512

    def best(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        words, index = np.unique(frame["word"].to_numpy(), return_inverse=True)
        counts = np.zeros((len(words), 2 * classes))
        counts[index, frame["slot"].to_numpy()] = frame["n"].to_numpy()
        own = label[first + words]
        gain = _gains(counts[:, :classes], counts[:, classes:], table, own)
        to = gain.argmax(1)
        moves = gain[np.arange(len(words)), to] > gain[np.arange(len(words)), own] + 1e-9
        return pd.DataFrame({"word": words[moves], "to": to[moves]})

    # frequent words, which have most counts, are spread over the groups
    groups = found.withColumn("group", F.col("word") % max(1, -(-(len(label) - first) // at_once))).groupBy("group")
    moved = groups.applyInPandas(best, "word long, to long").toArrow()  # a row for a word of the head at most
    label = label.copy()
    label[first + moved["word"].to_numpy()] = moved["to"].to_numpy()
    return label


@dataclass
class Model:
    """Everything a task needs to score a text but for the counts of rare words."""

    sizes: Sizes
    units: Units
    n: int
    v: int
    head_counts: np.ndarray  # of the units' words
    label: np.ndarray  # the class of each unit
    after: np.ndarray  # log10 of a class after a class
    inside: np.ndarray  # log10 of a unit in its class
    mass: np.ndarray  # tokens of each unit that words share
    unknown: np.ndarray  # the probability of a word that is not known, in each unit

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1.0) / (self.n + self.v + 1))

    def emitted(self, counts: np.ndarray, unit: np.ndarray) -> np.ndarray:
        return np.log10(np.maximum(counts - self.sizes.discount, 1e-9) / np.maximum(self.mass[unit], 1))


def _after(table: np.ndarray, trust: float = 20.0) -> np.ndarray:
    """log10 of every class after every class, smoothed so that none is impossible."""
    share = table.sum(0) + 1.0
    share /= share.sum()
    return np.log10((table + trust * share) / (table.sum(1, keepdims=True) + trust))


def _inside(unit: np.ndarray, label: np.ndarray) -> np.ndarray:
    """log10 of every unit in its class, from the units' counts."""
    return np.log10((unit + 0.5) / np.bincount(label, unit + 0.5)[label])


def _transitions(pairs: np.ndarray, label: np.ndarray) -> np.ndarray:
    """log10 of every unit after every unit."""
    member = np.zeros((len(pairs), int(label.max()) + 1))
    member[np.arange(len(pairs)), label] = 1
    return (_after(member.T @ pairs @ member)[:, label] + _inside(pairs.sum(0), label))[label]


def train(texts: DataFrame, sizes: Sizes = Sizes()) -> tuple[Model, DataFrame]:
    """The model of all rows of ``text``, and the table of all words' counts. No rows give a model of ends alone.

    The units' words are the most frequent ones, equally frequent ones by code point.
    """
    counts = written(count_words(texts), "word-counts")
    total = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    words = counts.filter(F.col("word") != END)
    # a count that ``head`` words reach, found by counting, so that few more are sorted
    level = F.floor(F.log2("n") * 16).alias("level")
    levels = words.filter(F.col("n") >= sizes.least).groupBy(level).agg(F.count("*").alias("n"), F.min("n").alias("low"))
    low, reached = sizes.least, 0
    for row in sorted(levels.collect(), key=lambda row: -row["level"]):
        if reached >= sizes.head:
            break
        low, reached = row["low"], reached + row["n"]
    head = words.filter(F.col("n") >= low).orderBy(F.desc("n"), F.asc("word")).limit(sizes.head).toArrow()
    head = head.sort_by([("n", "descending"), ("word", "ascending")]).combine_chunks()

    def beyond(some: pa.Table) -> Column:
        if not some.num_rows:
            return F.lit(True)
        n, word = some["n"][-1].as_py(), some["word"][-1].as_py()
        return (F.col("n") < n) | ((F.col("n") == n) & (F.col("word") > F.lit(word)))

    core = head.slice(0, sizes.words)
    ending = F.expr(f"right(word, {sizes.ending})").alias("ending")
    alone = F.when(beyond(head), F.col("n"))
    shared = words.filter(beyond(core)).groupBy(ending).agg(
        F.sum("n").alias("n"), F.sum(alone).alias("mass"), F.count(alone).alias("kinds")
    )
    shared = written(shared, "endings")
    top = shared.orderBy(F.desc("n"), F.asc("ending")).limit(sizes.endings).collect()
    everything = shared.agg(F.sum("mass").alias("mass"), F.sum("kinds").alias("kinds")).first()
    endings = pa.array([r["ending"] for r in top], pa.string())
    first = Units(pa.array(core["word"].to_pylist(), pa.string()), endings, sizes.ending)
    units = Units(pa.array(head["word"].to_pylist(), pa.string()), endings, sizes.ending)
    mass, kinds = np.zeros(len(units)), np.zeros(len(units))
    mass[2 + head.num_rows :] = [r["mass"] or 0 for r in top]
    kinds[2 + head.num_rows :] = [r["kinds"] for r in top]
    mass[1] = (everything["mass"] or 0) - mass.sum()
    kinds[1] = (everything["kinds"] or 0) - kinds.sum()
    unknown = np.where(mass > 0, sizes.discount * kinds / np.maximum(mass, 1), 1.0)
    label = exchange(count_pairs(texts, first), sizes.classes, sizes.passes)
    # words that have not been exchanged start in the class of their ending
    starts = label[first.of(units.words)] if head.num_rows else np.zeros(0, np.int64)
    label = np.concatenate([label[:2], starts, label[2 + core.num_rows :]])
    free = 2 + core.num_rows
    rounds = sizes.rounds if head.num_rows > core.num_rows else 0
    table, found = count_classes(texts, units, label, free if rounds else None)
    for k in range(rounds):
        moved = move_words(found, table, label, free)
        then, found = count_classes(texts, units, moved, free if k + 1 < rounds else None)
        if _likelihood(then) <= _likelihood(table):
            break
        label, table = moved, then
    ends = (total["n"] or 0) - head_total(head) - mass.sum()
    head_counts = head["n"].to_numpy().astype(np.float64)
    unit_counts = mass.copy()
    unit_counts[0] = ends
    unit_counts[2 : 2 + head.num_rows] = head_counts
    model = Model(
        sizes, units, total["n"] or 0, total["v"], head_counts, label, _after(table), _inside(unit_counts, label), mass, unknown
    )
    return model, counts


def head_total(head: pa.Table) -> int:
    return pc.sum(head["n"]).as_py() or 0


_RARE = {"word": T.StringType(), "n": T.LongType(), "mass": T.DoubleType(), "unknown": T.DoubleType()}
RARE = T.ArrayType(T.StructType([T.StructField(name, kind) for name, kind in _RARE.items()]))


def score(docs: DataFrame, model: Model, counts: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_tokens``, ``n_known``, ``base_score`` and ``score`` of every row, in log10.

    Null texts count as empty; an empty text is its end alone. Repeated rows and keys stay. The base score is
    that of single words with one added to every count. ``perplexity`` is 10 to minus the mean score.
    """
    of = docs.sparkSession.sparkContext.broadcast(model)  # a bounded number of units, some MB
    schema = T.StructType(
        [T.StructField("row", T.LongType()), T.StructField("key", docs.schema[key].dataType)]
        + [T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known")]
        + [T.StructField(c, T.DoubleType()) for c in ("base_score", "score")]
        + [T.StructField("rare", RARE)]
    )

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, row = of.value, TaskContext.get().partitionId() << 33
        end = m.base(np.array([ends_seen]))[0]
        for batch in parts(batches):
            if batch.num_rows:
                words, bounds = tokens(batch["text"])
                n = len(bounds) - 1
                kinds = words.dictionary.cast(pa.string())
                index = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                unit = m.units.of(kinds)
                rare = (unit < 2) | (unit >= 2 + len(m.units.words))
                seen = np.where(rare, 0.0, m.head_counts[np.where(rare, 0, unit - 2)] if len(m.head_counts) else 0.0)
                base = np.where(rare, 0.0, m.base(seen))
                units, ends = m.units.sequence(words, bounds)
                kind = m.label[units]
                steps = m.after[np.concatenate([m.label[:1], kind[:-1]]), kind] + m.inside[units]
                starts = np.concatenate([[0], ends[:-1] + 1])
                doc = np.repeat(np.arange(n), np.diff(bounds))
                total = np.add.reduceat(steps, starts)
                bases = np.bincount(doc, base[index], n) + end
                known = np.bincount(doc, ~rare[index], n).astype(np.int64) + (ends_seen > 0)
                # the rare words of each text, each once
                some = rare[index]
                code, times = np.unique(doc[some] * max(len(kinds), 1) + index[some], return_counts=True)
                which = code % max(len(kinds), 1)
                per_doc = np.bincount(code // max(len(kinds), 1), minlength=n)
                fields = [
                    kinds.take(pa.array(which)), pa.array(times, pa.int64()),
                    pa.array(m.mass[unit[which]], pa.float64()), pa.array(m.unknown[unit[which]], pa.float64()),
                ]
                items = pa.StructArray.from_arrays(fields, ["word", "n", "mass", "unknown"])
                offsets = pa.array(np.concatenate([[0], np.cumsum(per_doc)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + n)), batch["key"], pa.array(np.diff(bounds) + 1),
                        pa.array(known), pa.array(bases), pa.array(total), pa.ListArray.from_arrays(offsets, items),
                    ],
                    schema.fieldNames(),
                )
                row += n

    end_row = counts.filter(F.col("word") == END).first()
    ends_seen = end_row["n"] if end_row else 0
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(scored, schema)
    rows = written(rows, "scored")
    rare = rows.select("row", F.inline("rare")).withColumnRenamed("n", "times")
    # by hint, as Spark takes the rare words for as small as the rows they are kept in
    rare = rare.hint("merge").join(counts, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    alone = F.when(F.col("n") > 0, (F.col("n") - model.sizes.discount) / F.col("mass")).otherwise(F.col("unknown"))
    sums = rare.groupBy("row").agg(
        F.sum(F.col("times") * F.log10((F.col("n") + 1) / F.lit(float(model.n + model.v + 1)))).alias("rare_base"),
        F.sum(F.col("times") * F.log10(alone)).alias("rare_score"),
        F.sum(F.when(F.col("n") > 0, F.col("times"))).alias("rare_known"),
    )
    rows = rows.drop("rare").join(sums, "row", "left")
    zero = F.lit(0.0)
    return rows.select(
        F.col("key").alias(key), "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        (F.col("base_score") + F.coalesce("rare_base", zero)).alias("base_score"),
        (F.col("score") + F.coalesce("rare_score", zero)).alias("score"),
    ).withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def held_out(key: Column, modulus: int, remainder: int) -> Column:
    """Whether the key's CRC-32, as text, leaves the remainder. A null key is never held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % modulus == remainder, F.lit(False))
