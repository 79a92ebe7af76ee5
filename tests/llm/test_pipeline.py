"""The pipeline's stages against brute force, each over what the one before it kept."""

from collections import Counter

import corpus_pipeline
from oreflow.llm import mixing, toxicity
from pyspark.sql import functions as F
from tests.llm.conftest import SMALL
from tests.llm.test_operators import check_pieces, fill, plain_groups, plain_simhash, words


def stages(spark, folder, tmp_path, docs):
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, folder)
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        yield name, before, docs


def passes(text):
    ws = (text or "").encode().split()
    windows = Counter(tuple(ws[k : k + 5]) for k in range(len(ws) - 4))
    covered = {k + j for k in range(len(ws) - 4) if windows[tuple(ws[k : k + 5])] > 1 for j in range(5)}
    lines = [line for line in (text or "").split("\n") if line.encode().split()]
    chars = sum(len(w.decode()) for w in ws)
    lower = sum(any(c.islower() for c in w.decode()) for w in ws)
    n = len(ws)
    return not (
        n < 10 or 100 * len(covered) > 20 * n or 100 * sum(map((text or "").count, "#*$%&|<>")) > 40 * n
        or 100 * (len(lines) - len(set(lines))) > 40 * len(lines) or chars < 2 * n or chars > 20 * n or 100 * lower < 50 * n
    )


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "toxicity", "near_duplicates", "source_mix", "packing"]
    for name, before, after in stages(spark, SMALL, tmp_path, docs):
        old, new = before.collect(), after.collect()
        if name != "packing":
            assert after.columns == docs.columns
        if name == "quality_rules":
            assert sorted(r["doc_id"] for r in new) == sorted(r["doc_id"] for r in old if passes(r["text"]))
        elif name == "toxicity":
            chain = toxicity.default_chain(before, spark.read.parquet(f"{SMALL}/labels.parquet"))
            p = chain.predict([toxicity.features(r["text"]) for r in old])[:, 1]
            assert {r["doc_id"] for r in new} == {r["doc_id"] for r, x in zip(old, p) if x < toxicity.THRESHOLD}
        elif name == "near_duplicates":
            old = sorted(old, key=lambda r: r["doc_id"])
            roots = plain_groups([plain_simhash(r["text"]) for r in old])
            assert sorted(r["doc_id"] for r in new) == [old[k]["doc_id"] for k in sorted(set(roots))]
        elif name == "source_mix":
            size, taken = Counter(), Counter()
            for r in old:
                size[r["source"]] += len(words(r["text"]))
            for r in new:
                taken[r["source"]] += len(words(r["text"]))
            order = sorted(size)
            for source, target in zip(order, fill([size[s] for s in order], (3, 1, 2), 1.5, 2)):
                assert abs(taken[source] - target) <= 0.05 * target + 2 * mixing.Policy().block
        else:
            assert check_pieces(new, [(r["doc_id"], r["text"]) for r in old], 2048) < 0.05


def test_run_on_edge_cases_and_empty_tables(spark, edge_dir, empty_dir):
    assert corpus_pipeline.run(spark, empty_dir).collect() == []
    rows = corpus_pipeline.run(spark, edge_dir)
    assert rows.filter(F.col("length") <= 0).count() == 0 and rows.count() > 0


def test_run_without_a_labelled_document(spark, tmp_path):
    spark.read.parquet(f"{SMALL}/documents.parquet").write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SMALL}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
