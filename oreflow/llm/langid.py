"""Hierarchical language identification (operator 7).

First the family of the language is predicted, then the language within it, at either level by linear
support vector machines for every pair, which vote. Inputs are frequencies of letter sequences.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.llm.common import fresh, uniform

# Families of ISO 639-1 codes. A language that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af lb yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "indic": "hi bn mr gu pa ne ur",
    "turkic": "tr az kk uz ky tk",
    "semitic": "ar he mt am",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
UNKNOWN = "und"
SIZE = 1 << 13
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def family(lang: str) -> str:
    return FAMILY_OF.get(lang, f"={lang}")


def profile(text: str | None) -> np.ndarray | None:
    """Roots of the hashed frequencies of 1, 2 and 3 bytes of the whole text's words, of length 1.

    Letters are lower-cased and words stand between blanks. None for a text that is null or has no letter.
    """
    letters = _NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    if not any(map(str.isalpha, letters)):
        return None
    code = np.frombuffer(f" {letters} ".encode(), np.uint8).astype(np.uint32)
    counts = np.zeros(SIZE)
    for n in (1, 2, 3):
        grams = code[: len(code) - n + 1].copy()
        for k in range(1, n):
            grams = grams * np.uint32(257) + code[k : len(code) - n + 1 + k]
        grams = (grams + np.uint32(n)) * np.uint32(0x9E3779B1)
        counts += np.bincount(grams >> np.uint32(32 - 13), minlength=SIZE)
    root = np.sqrt(counts)
    return (root / np.linalg.norm(root)).astype(np.float32)


def fit_svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, passes: int = 40) -> np.ndarray:
    """Weights, the last for the constant, of a linear machine with squared hinge loss; y is +1 or -1.

    Dual coordinate descent, the rows in a fixed pseudorandom order.
    """
    x = np.concatenate([x, np.ones((len(x), 1), x.dtype)], 1).astype(np.float64)
    alpha, w, random = np.zeros(len(x)), np.zeros(x.shape[1]), np.random.default_rng(0)
    diagonal = 0.5 / c
    square = (x**2).sum(1) + diagonal
    for _ in range(passes):
        moved = 0.0
        for i in random.permutation(len(x)):
            slope = y[i] * (x[i] @ w) - 1 + diagonal * alpha[i]
            new = max(alpha[i] - slope / square[i], 0.0)
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


@dataclass
class Votes:
    """One machine for every pair of classes. The pair's vote is graded: a logistic of its margin."""

    classes: tuple[str, ...]
    weights: np.ndarray  # a row for each pair, in the order of combinations()

    @classmethod
    def fit(cls, x: np.ndarray, names: np.ndarray) -> Votes:
        classes = tuple(sorted(set(names.tolist())))
        rows = [np.zeros(x.shape[1] + 1)][:0]
        for a, b in combinations(classes, 2):
            some = (names == a) | (names == b)
            rows.append(fit_svm(x[some], np.where(names[some] == a, 1.0, -1.0)))
        return cls(classes, np.array(rows, np.float32).reshape(len(rows), x.shape[1] + 1))

    def shares(self, x: np.ndarray) -> np.ndarray:
        """The share of the votes that each class gets, a row for each of ``x``; ties fall to the first class."""
        n = len(self.classes)
        if n == 1:
            return np.ones((len(x), 1))
        margins = x @ self.weights[:, :-1].T + self.weights[:, -1]
        p = 1 / (1 + np.exp(-np.clip(3 * margins, -30, 30)))
        votes = np.zeros((len(x), n))
        for k, (a, b) in enumerate(combinations(range(n), 2)):
            votes[:, a] += p[:, k]
            votes[:, b] += 1 - p[:, k]
        return votes / (n - 1)


@dataclass
class Tree:
    families: Votes
    members: dict[str, Votes]

    @classmethod
    def fit(cls, x: np.ndarray, langs: Sequence[str]) -> Tree:
        names = np.array(langs, object)
        of = np.array([family(lang) for lang in langs], object)
        members = {f: Votes.fit(x[of == f], names[of == f]) for f in sorted(set(of.tolist()))}
        return cls(Votes.fit(x, of), members)

    def predict(self, texts: Sequence[str | None]) -> list[tuple[str, float]]:
        """Language and score; ``und`` and 0 for texts without letters."""
        found = [(UNKNOWN, 0.0)] * len(texts)
        profiles = [profile(t) for t in texts]
        rows = [k for k, p in enumerate(profiles) if p is not None]
        if not rows:
            return found
        x = np.stack([profiles[k] for k in rows])
        upper = self.families.shares(x)
        best = upper.argmax(1)
        for f, name in enumerate(self.families.classes):
            some = np.flatnonzero(best == f)
            if len(some):
                lower = self.members[name].shares(x[some])
                for j, k in enumerate(some):
                    lang = int(lower[j].argmax())
                    found[rows[k]] = (self.members[name].classes[lang], float(upper[k, f] * lower[j, lang]))
        return found


def train(
    docs: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", lang: str = "lang", per_lang: int = 300
) -> Tree | None:
    """Fit the tree on at most ``per_lang`` documents of each language, those with the smallest key hashes.

    Only rows where ``learn`` is true, the language not null and a letter in the text. None without any.
    """
    rows = docs.filter(learn & F.col(lang).isNotNull())
    sizes = rows.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n")).collect()
    if not sizes:
        return None
    # a first cut by the hash, so that not every task sends ``per_lang`` texts of each language
    place = uniform(F.col(key), F.col(text))
    share = F.create_map(*[F.lit(x) for row in sizes for x in (row["lang"], min(1.0, 4 * per_lang / row["n"]))])
    rows = rows.filter((place < share[F.col(lang)]) & F.col(text).rlike(r"\p{L}"))
    rows = rows.select(F.col(lang).alias("lang"), F.col(text).cast("string").alias("text"), place.alias("h"))
    order = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    rows = rows.withColumn("turn", order).filter(F.col("turn") <= per_lang)

    def profiles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(a, h, profile(t)) for a, h, t in zip(batch["lang"], batch["h"], batch["text"], strict=True)]
            found = [(a, h, p.tobytes()) for a, h, p in found if p is not None]
            yield pd.DataFrame(found, columns=["lang", "h", "profile"])

    taken = rows.mapInPandas(profiles, "lang string, h double, profile binary").collect()
    taken = sorted((row["lang"], row["h"], bytes(row["profile"])) for row in taken)
    if not taken:
        return None
    return Tree.fit(np.stack([np.frombuffer(p, np.float32) for _, _, p in taken]), [a for a, _, _ in taken])


def identify(
    docs: DataFrame, tree: Tree | None, text: str = "text", out: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """Add the predicted language and a score from 0 to 1, from the whole text alone.

    A text that is null or has no letter, or any without a tree, is ``und`` with score 0. Rows stay as they
    are; columns of the two names are replaced.
    """
    model = docs.sparkSession.sparkContext.broadcast(tree)  # weights for each pair, 32 kB

    @F.pandas_udf(T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())]))
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for some in batches:
            texts, found = [t if isinstance(t, str) else None for t in some], []
            for k in range(0, len(texts), 1000):
                part = texts[k : k + 1000]
                found.extend(model.value.predict(part) if model.value else [(UNKNOWN, 0.0)] * len(part))
            yield pd.DataFrame(found, columns=["lang", "score"])

    both = fresh(docs, "predicted")
    docs = docs.withColumn(both, predicted(F.col(text).cast("string")))
    return docs.withColumns({out: F.col(f"{both}.lang"), score: F.col(f"{both}.score")}).drop(both)
