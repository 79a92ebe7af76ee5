"""Quality rules as a short-circuit cascade (operator 10).

Each rule's cost and its rejections are estimated on a sample. The rules then run in the order of
rejections per cost, each only on what the rules before it let pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import GAP, WORD, fresh, let, uniform, words_of, written

WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """``fails`` is true for a row to reject; null counts as passed. ``work`` is the effort of testing one
    row, the characters that the test reads, so that costs of rules can be compared and reruns agree."""

    name: str
    fails: Column
    work: Column


def word_chars(text: Column) -> Column:
    """Code points in words."""
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), f"{GAP}+", "")).cast("long")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def n_symbols(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[#*$%&|<>]")), F.lit(0)).cast("long")


def n_lowered(text: Column) -> Column:
    """Words with a lower-case letter, or with a letter of a script without case, as Arabic, Hindi or Korean."""
    pattern = r"[^\x20\x09-\x0D]*[\p{Ll}\p{Lo}&&[^\xAA\xBA]][^\x20\x09-\x0D]*"
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0)).cast("long")


def n_unspaced(text: Column) -> Column:
    """Code points of scripts that put no spaces between words, with their signs."""
    scripts = "Han Hiragana Katakana Bopomofo Thai Lao Khmer Myanmar Tibetan".split()
    others = "[^" + "".join(rf"\p{{Is{script}}}" for script in scripts) + r"\u3000-\u303F\uFF00-\uFFEF]+"
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), others, "")).cast("long")


def lines_of(text: Column) -> Column:
    """Lines that hold a word."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.filter(lines, lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(lines_of(text), lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long")


def repeats(words: Column, width: int = WINDOW) -> Column:
    """Words inside windows of ``width`` words that the text holds twice or more, the first included.

    Windows are compared by a 64-bit hash over their words. A text without a repeated one, which
    most are, is done after making its hashes distinct. Otherwise windows are sorted by hash, those
    equal to a neighbour are the repeated ones, and each adds the words that the one before it in
    the text does not cover.
    """

    def hashes(w: Column) -> Column:
        at = lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)])
        return F.when(F.size(w) >= width, F.transform(F.sequence(F.lit(0), F.size(w) - width), at))

    def covered(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def repeated(s: Column) -> Column:
            same = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
            twins = F.filter(s, lambda x, k: same(x, k + 1) | ((k > 0) & same(x, k - 1)))
            return F.sort_array(F.transform(twins, lambda x: x["i"]))

        start = F.struct(F.lit(-width).alias("last"), F.lit(0).alias("n"))
        step = lambda acc, i: F.struct(
            i.alias("last"), (acc["n"] + F.least(F.lit(width), i - acc["last"])).alias("n")
        )
        return F.aggregate(let(pairs, repeated), start, step, lambda acc: acc["n"])

    def count(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0)

    return F.coalesce(let(let(words, hashes), count), F.lit(0)).cast("long")


def n_repeat_words(text: Column, width: int = WINDOW) -> Column:
    """``repeats`` of a text's words."""
    return repeats(words_of(text), width)


def word_measures(text: Column) -> Column:
    """``n_words``, ``word_chars`` and ``n_repeat_words`` of a text that is taken apart once."""

    def of(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"), F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            repeats(words).alias("n_repeat_words"),
        )

    return let(words_of(text), of)


def default_rules(m: dict[str, Column], size: Column, known: Sequence[str] = ()) -> list[Rule]:
    """The rules of the ``op10`` query over the measures ``m`` of a text of ``size`` code points.

    A rule's work is the characters that it has to read: none for the measures that are ``known``, the others one
    by one as far as the test gets. So a rule's measures are taken only where the cascade reaches it.

    Besides too few words and repeated passages: many symbols, repeated lines, words too short or
    too long to be prose, and shouting. The last four leave a wide margin, so that prose passes, also in
    scripts without case, which cannot shout, and without spaces, whose words have no length here.
    """
    n, dup = m["n_words"], m["n_dup_lines"]
    far = m["word_chars"] > 20 * n

    def reads(measure: str, passes: int = 1) -> Column:
        return F.lit(0) if measure in known else passes * size

    return [
        Rule("few_words", n < 10, reads("n_words")),
        # each word is taken apart, and hashed in five windows
        Rule("repeated_words", 100 * m["n_repeat_words"] > 20 * n, reads("n_repeat_words", 1 + WINDOW)),
        Rule("symbols", 100 * m["n_symbols"] > 40 * n, reads("n_symbols")),
        Rule("repeated_lines", (dup > 0) & (100 * dup > 40 * m["n_lines"]), reads("n_dup_lines") + F.when(dup > 0, reads("n_lines")).otherwise(0)),
        Rule("word_length", (m["word_chars"] < 2 * n) | (far & (m["word_chars"] - m["n_unspaced"] > 20 * n)),
             reads("word_chars") + F.when(far, reads("n_unspaced")).otherwise(0)),
        Rule("shouting", 100 * m["n_lowered"] < 50 * n, reads("n_lowered")),
    ]


MEASURES = {
    "n_words": n_words,
    "word_chars": word_chars,
    "n_symbols": n_symbols,
    "n_dup_lines": n_dup_lines,
    "n_repeat_words": n_repeat_words,
    "n_lines": lambda text: F.size(lines_of(text)).cast("long"),
    "n_lowered": n_lowered,
    "n_unspaced": n_unspaced,
}


def sampled(df: DataFrame, rows: int = 512) -> DataFrame:
    """The ``rows`` rows with the smallest hash of the whole row: at most that many at any input size.

    A first cut by the hash leaves a few times as many to be ordered, so that not every task sends ``rows``
    rows. Written to the shared folder, so that what is computed on them stays above the limit: Spark
    would move it below, and then sort the whole table.
    """
    place = uniform(*[c for c, kind in df.dtypes if "map<" not in kind], F.lit("sample"))
    some = df.filter(place < 4 * rows / max(df.count(), 1))
    return written(some.orderBy(place).limit(rows), "sample")


def order_rules(sample: DataFrame, rules: Sequence[Rule]) -> list[Rule]:
    """The rules by rejections per cost, each judged on the sampled rows that those before it leave.

    The sample only decides the order: every rule is tested on every row that reaches it.
    """
    marks = [F.coalesce(rule.fails, F.lit(False)).alias(f"f{k}") for k, rule in enumerate(rules)]
    costs = [F.coalesce(rule.work, F.lit(0)).cast("double").alias(f"w{k}") for k, rule in enumerate(rules)]
    rows = sample.select(*marks, *costs).collect()
    left, ordered = list(range(len(rules))), []
    while left:

        def gain(k: int) -> tuple[float, float]:
            cost = sum(row[f"w{k}"] for row in rows) + 1.0
            return sum(row[f"f{k}"] for row in rows) / cost, -cost

        best = max(left, key=gain)
        rows = [row for row in rows if not row[f"f{best}"]]
        left.remove(best)
        ordered.append(rules[best])
    return ordered


def rejected_by(rules: Sequence[Rule]) -> Column:
    """The first rule that a row fails, or null. A later rule's expression is not evaluated."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(rules):
        verdict = F.when(rule.fails, F.lit(rule.name)).otherwise(verdict)
    return verdict


def quality_cascade(
    df: DataFrame, rules: Sequence[Rule], sample: DataFrame | None = None, out: str = "rejected_by"
) -> DataFrame:
    """Add a column with the name of the rule that rejects the row; null for rows to keep.

    ``sample`` are rows like those of ``df`` to judge the rules by; by default ``sampled(df)``. Rules whose
    test is null let a row pass. An empty table gives an empty table. Equal rows get equal verdicts.
    ``out`` replaces a column of that name.
    """
    return df.withColumn(out, rejected_by(order_rules(sampled(df) if sample is None else sample, rules)))


def measured(df: DataFrame, text: str = "text", extra: Sequence[str] = ("n_symbols", "n_dup_lines")) -> tuple[DataFrame, dict[str, str]]:
    """Add the measures of a text's words and ``extra`` ones; the second value gives the columns' names, by measure."""
    names, words = {}, fresh(df, "word_measures")
    df = df.withColumn(words, word_measures(F.col(text)))
    for measure in ("n_words", "word_chars", "n_repeat_words", *extra):
        names[measure] = fresh(df, measure)
        made = MEASURES[measure](F.col(text)) if measure in extra else F.col(words)[measure]
        df = df.withColumn(names[measure], made)
    return df.drop(words), names


def drop_rejected(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that pass the default rules, with the columns they came with.

    Null and empty texts have no words and go. Equal rows stay or go together; an empty table gives an
    empty one. Here no measure is needed beyond the verdict, so each is computed only where the
    cascade reaches its rule.
    """
    source = F.col(text)
    size = F.length(F.coalesce(source, F.lit("")))

    def rules(words: Column) -> list[Rule]:
        of_words = {
            "n_words": F.size(words).cast("long"), "word_chars": F.length(F.array_join(words, "")).cast("long"),
            "n_repeat_words": repeats(words),
        }
        others = {name: make(source) for name, make in MEASURES.items() if name not in of_words}
        return default_rules(others | of_words, size, ["n_words"])

    order = [rule.name for rule in order_rules(sampled(docs), rules(words_of(source)))]
    # most rules need the words: they are taken apart once, and the rest as the cascade gets there
    verdict = let(words_of(source), lambda words: rejected_by(sorted(rules(words), key=lambda rule: order.index(rule.name))))
    return docs.filter(verdict.isNull())
