import random

import pytest

SMALL = "/root/testdata/sf0.001"
# Columns that operators use inside, and the documents have as their own.
CLASHING = ("row_key", "value", "words", "n_words", "rejected_by", "pieces", "turn", "score", "host", "id", "k", "part")


def prose(seed, n, vocabulary=400):
    rand = random.Random(seed)
    words = ["".join(rand.choice("bcdfglmnprst") + rand.choice("aeiou") for _ in range(rand.randint(1, 4))) for _ in range(vocabulary)]
    return " ".join(rand.choice(words) for _ in range(n))


@pytest.fixture(scope="session")
def edge_texts():
    """Nulls, empty, blank and very long texts, copies, near copies, ties and odd characters."""
    long = prose(1, 30_000)
    base = prose(2, 300)
    near = base.rsplit(" ", 1)[0] + " changed"
    texts = [
        None, "", " \t\n\x0b\x0c\r ", "one", "One two\tthree", base, base, near, base + "\n" + base, long,
        "É ß İ 一二三 😀 \x85 a\u00a0b", "same line\nsame line\nsame line\nother words here now then",
        "MIXED Case and and and and and and and and", "# * $ % & | < >", prose(3, 9), prose(4, 10), prose(5, 64),
        prose(6, 65), "x" * 5000, "a\n\nb\n \nb\nb",
    ]
    return texts


@pytest.fixture(scope="session")
def edge_docs(spark, edge_texts):
    """The texts as documents, some keys repeated, null or tied, with columns that clash."""
    rows = []
    for k, text in enumerate(edge_texts):
        key = None if k == 4 else 7 if k in (6, 7) else k * 3
        rows.append((key, text, ["en", "de", None][k % 3], ["s1", None, "s2", "é"][k % 4], len(text or ""), *["mine"] * len(CLASHING)))
    rows += [rows[5], rows[5], rows[0]]  # whole rows again
    columns = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame(rows, columns).repartition(3)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture(scope="session")
def edge_dir(spark, edge_docs, tmp_path_factory):
    """The edge documents as a data folder, so that the registered queries can run on them."""
    folder = str(tmp_path_factory.mktemp("edge"))
    edge_docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(k * 3, k % 2, int(k % 5 == 0)) for k in range(12)] + [(0, 1, 1), (None, 0, 1), (3, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


@pytest.fixture(scope="session")
def empty_dir(spark, no_docs, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    no_docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>").write.parquet(f"{folder}/embeddings.parquet")
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    turns.write.parquet(f"{folder}/conversations.parquet")
    return folder


@pytest.fixture(scope="session")
def docs_of(edge_docs):
    """The edge documents on the driver."""
    return [(row["doc_id"], row["text"]) for row in edge_docs.select("doc_id", "text").collect()]
