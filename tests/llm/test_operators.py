"""Each operator against a plain, slow version of itself."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from oreflow.llm import classlm, fingerprints, langid, mixing, packing, quality, simhash, templates, toxicity, urls
from oreflow.llm.queries import QUERIES, tokenizer_path
from tests.llm.conftest import CLASHING, SMALL, prose

SPACE = " \t\n\x0b\x0c\r"


def words(text):
    return (text or "").encode().split()


# ---- quality ---------------------------------------------------------------------------------


def test_rules_run_by_rejections_per_cost(spark):
    df = spark.range(100).withColumnRenamed("id", "x")
    cheap = quality.Rule("cheap", F.col("x") < 10, F.lit(1))
    dear = quality.Rule("dear", F.col("x") < 50, F.lit(100))
    never = quality.Rule("never", F.raise_error(F.lit("tested")).cast("boolean"), F.lit(0))
    null = quality.Rule("null", F.lit(None).cast("boolean"), F.lit(1))
    sample = quality.sampled(df, 100)
    assert [r.name for r in quality.order_rules(sample, [dear, null, cheap])] == ["cheap", "dear", "null"]
    # a rule behind one that rejects every row is never evaluated
    all_rows = quality.Rule("all", F.lit(True), F.lit(1))
    judged = df.select(quality.rejected_by([all_rows, never]).alias("r"))
    assert {r[0] for r in judged.collect()} == {"all"}
    kept = quality.quality_cascade(df, [dear, null, cheap]).filter("rejected_by is null")
    assert kept.count() == 50
    assert quality.quality_cascade(df.limit(0), [cheap]).count() == 0


def test_documents_that_pass_keep_their_columns(edge_docs, no_docs):
    kept = quality.drop_rejected(edge_docs)
    assert kept.columns == edge_docs.columns and no_docs.columns == quality.drop_rejected(no_docs).columns
    texts = [r["text"] for r in kept.collect()]
    assert all(len(words(t)) >= 10 for t in texts) and prose(4, 10) in texts and prose(3, 9) not in texts
    assert quality.drop_rejected(no_docs).count() == 0


def test_clean_texts_in_scripts_without_case_or_spaces_pass(spark):
    rand = random.Random(5)

    def text(first, last, most, n=60, sep=" "):
        return sep.join("".join(chr(rand.randint(first, last)) for _ in range(rand.randint(most // 2, most))) for _ in range(n))

    arabic, hebrew, hindi, korean = ((0x628, 0x63A), (0x5D0, 0x5EA), (0x915, 0x939), (0xAC00, 0xD7A3))
    clean = [text(*script, 6) for script in (arabic, hebrew, hindi, korean)]
    clean += [f"{clean[3]} KBS NATO EU", f"{clean[1]} 1948 1967", text(0x4E00, 0x9FA5, 60), text(0xE01, 0xE2E, 60, sep="\n"), prose(9, 60)]
    bad = [prose(9, 60).upper(), f"{prose(9, 60).upper()} {text(*korean, 3, 20)}", text(97, 122, 60), "1ª Nº " + prose(8, 40).upper()]
    docs = spark.createDataFrame(list(enumerate(clean + bad)), "doc_id long, text string")
    assert sorted(r["doc_id"] for r in quality.drop_rejected(docs).collect()) == list(range(len(clean)))


# ---- toxicity --------------------------------------------------------------------------------


def test_chain_uses_the_earlier_category():
    rand = np.random.default_rng(0)
    a = rand.random(600) < 0.5
    b = np.where(rand.random(600) < 0.95, a, ~a)
    sets = [{"yes" if x else "no", f"noise{k % 50}", "all"} for k, x in enumerate(a)]
    chain = toxicity.fit(sets, {"first": a.astype(float), "second": b.astype(float)}, np.ones(600))
    assert len(chain.weights[1]) == len(chain.weights[0]) + 1 and abs(chain.weights[1][-2]) > 0.1
    p = chain.predict(sets)
    assert ((p[:, 1] > 0.5) == b).mean() > 0.94 and chain.predict([]).shape == (0, 2)


def test_toxic_documents_go_and_clean_ones_stay(spark, edge_docs, no_docs):
    rand = random.Random(3)
    bad = ["grobian", "schuft", "lump"]

    def text(k, toxic):
        line = prose(k, 60).split()
        for _ in range(2 * toxic):
            line.insert(rand.randrange(len(line)), rand.choice(bad) + rand.choice(["", ".", "en"]))
        return " ".join(line)

    rows = [(k, text(k, k % 4 == 0), k % 4 == 0) for k in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic boolean").withColumn("p_toxic", F.lit("mine"))
    labels = docs.filter("doc_id < 500").selectExpr("doc_id", "1 as quality", "cast(toxic as int) as toxic")
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    wrong = kept.filter("toxic").count() + docs.filter("NOT toxic").count() - kept.filter("NOT toxic").count()
    assert wrong <= 4
    # without labels, or rows, nothing is judged toxic
    assert toxicity.drop_toxic(edge_docs, labels.limit(0), 0.6).count() == edge_docs.count()
    assert toxicity.drop_toxic(no_docs, labels).count() == 0


def test_a_key_that_stands_twice_gives_one_chain(spark):
    rows = [(k % 60, prose(k, 40) + " schuft" * (k % 5 == 0)) for k in range(240)]
    labels = spark.createDataFrame([(k, 1, int(k % 5 == 0)) for k in range(60)], "doc_id long, quality int, toxic int")
    chains = []
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string").repartition(1 + len(chains) * 3)
        chains.append(toxicity.default_chain(docs, labels))
    assert chains[0].places == chains[1].places
    assert all((a == b).all() for a, b in zip(chains[0].weights, chains[1].weights, strict=True))


def test_a_chain_without_labels_keeps_everything(spark, edge_docs):
    labels = spark.createDataFrame([(10**9, 1, 1)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0)):  # labels of other documents, none
        assert toxicity.drop_toxic(edge_docs, known).count() == edge_docs.count()


def test_held_out_toxic_documents_are_found(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    part = F.col("doc_id") % 4 == 0
    chain = toxicity.default_chain(docs, labels.filter(~part))
    judged = toxicity.judge(docs, chain, ["p_low", "p"]).join(labels.filter(part), "doc_id")
    clean = judged.filter("toxic = 0")
    assert clean.filter(F.col("p") >= toxicity.THRESHOLD).count() <= 0.05 * clean.count()


@pytest.mark.parametrize("folder, share", [("sf0.01", 0.6), ("sf0.1", 0.9)])
def test_few_held_out_toxic_documents_are_lost(spark, folder, share):
    docs, labels = (spark.read.parquet(f"/root/testdata/{folder}/{t}.parquet") for t in ("documents", "labels"))
    part = F.col("doc_id") % 4 == 0
    chain = toxicity.default_chain(docs, labels.filter(~part))
    toxic = toxicity.judge(docs, chain, ["p_low", "p"]).join(labels.filter(part & (F.col("toxic") == 1)), "doc_id")
    assert toxic.filter(F.col("p") >= toxicity.THRESHOLD).count() >= share * toxic.count()


# ---- mixing ----------------------------------------------------------------------------------


def fill(sizes, weights, share, most):
    """Targets by sharing again and again, for sources in order."""
    left, open_, out = share * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        level = left / sum(weights[k % len(weights)] for k in open_)
        full = [k for k in open_ if most * sizes[k] <= level * weights[k % len(weights)]]
        for k in full or open_:
            out[k] = most * sizes[k] if full else level * weights[k % len(weights)]
        if not full:
            break
        left -= sum(out[k] for k in full)
        open_ -= set(full)
    return out


def test_permutation_meets_every_index_once(spark):
    for n in (1, 2, 3, 64, 1000):
        df = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), [F.lit(5), F.lit(0)]).alias("x"))
        found = [r[0] for r in df.collect()]
        assert sorted(found) == list(range(n))
        assert n < 64 or sum(a == b for a, b in zip(found, range(n))) < n / 8


@pytest.mark.parametrize("sizes", [[100, 200, 300, 50, 0], [5000, 10, 10], [0, 0], [7]])
def test_targets(spark, sizes):
    rows = [(None if k == 3 else f"s{k}", 1, size) for k, size in enumerate(sizes)]
    df = spark.createDataFrame(rows, "source string, rows long, source_size long")
    found = {r["source"]: r["target"] for r in mixing.targets(df, mixing.Policy()).collect()}
    order = sorted(range(len(sizes)), key=lambda k: (k == 3, f"s{k}"))
    expected = fill([sizes[k] for k in order], (3, 1, 2), 1.5, 2)
    assert [found[rows[k][0]] for k in order] == pytest.approx(expected)


def test_mix_is_near_its_targets(spark):
    got = QUERIES["op2_source_mixing"](spark, SMALL).toPandas()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "source", "text").toPandas()
    assert (got["taken"] <= 2 * got["size"]).all()
    size = {k: len(words(t)) for k, t in zip(docs["doc_id"], docs["text"])}
    assert all(size[k] == n for k, n in zip(got["doc_id"], got["size"]))
    of = got.merge(docs[["doc_id", "source"]], "left", "doc_id").groupby("source").agg({"taken": "sum", "target": "first"})
    assert ((of["taken"] - of["target"]).abs() <= 0.05 * of["target"] + 2 * 64).all()


def test_mixed_documents_are_the_taken_words(edge_docs, no_docs):
    mixed = mixing.mixed_documents(edge_docs, policy=mixing.Policy(block=16))
    assert mixed.columns == edge_docs.columns
    rows, source = mixed.collect(), Counter()
    for r in edge_docs.collect():
        source.update({(r["source"], w): 2 for w in words(r["text"])})
    assert rows and all(r["n_chars"] == len(r["text"]) and r["row_key"] == "mine" for r in rows)
    assert all((r["source"], w) in source for r in rows for w in words(r["text"]))
    again = mixing.mixed_documents(edge_docs, policy=mixing.Policy(block=16)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    everything = mixing.mixed_documents(edge_docs, policy=mixing.Policy(share=1.0, most=1, weights=(1,))).collect()
    lost = Counter(w for r in edge_docs.collect() for w in words(r["text"]))
    lost.subtract(w for r in everything for w in words(r["text"]))
    assert not +lost and not -lost
    assert mixing.mixed_documents(no_docs).count() == 0


# ---- language model --------------------------------------------------------------------------


def test_scores(spark, edge_dir, docs_of):
    for folder, docs in ((edge_dir, docs_of), (SMALL, None)):
        got = QUERIES["op3_lm_scoring"](spark, folder).collect()
        docs = docs or [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
        out = lambda key: key is not None and zlib.crc32(str(key).encode()) % 7 == 2
        tokens = [(key, [w.lower() for w in words(t)] + [b""]) for key, t in docs]
        counts = Counter(w for key, ws in tokens if not out(key) for w in ws)
        n, v = sum(counts.values()), len(counts)
        expected = [
            (str(key), out(key), len(ws), sum(counts[w] > 0 for w in ws),
             round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 6))
            for key, ws in tokens
        ]
        found = [(str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in got]
        assert sorted(found) == sorted(expected) and {r["train_tokens"] for r in got} == {n}
        assert all(r["score"] <= 0 and r["perplexity"] >= 1 for r in got)
        if folder == SMALL:
            held = [r for r in got if r["held_out"]]
            assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_exchange_finds_the_classes():
    rand = np.random.default_rng(1)
    pairs = np.zeros((12, 12))
    for _ in range(4000):  # three kinds of words that follow each other in turn
        a = rand.integers(12)
        pairs[a, (a // 4 + 1) % 3 * 4 + rand.integers(4)] += 1
    label = classlm.exchange(pairs, 3, 20)
    assert [len(set(label[k : k + 4])) for k in (0, 4, 8)] == [1, 1, 1] and len(set(label)) == 3
    step = classlm._transitions(pairs, label)
    assert (10.0**step).sum(1) == pytest.approx(1.0)


def test_probabilities_of_a_unit_add_up(spark):
    texts = spark.createDataFrame([(prose(k, 200, 2000),) for k in range(40)], "text string")
    model, counts = classlm.train(texts, classlm.Sizes(words=20, endings=10, classes=4, head=100))
    table = counts.filter("word <> ''").toArrow()
    unit = model.units.of(table["word"].combine_chunks())
    share = 10.0 ** model.emitted(table["n"].to_numpy().astype(float), unit)
    for u in set(unit.tolist()) - set(range(2, 2 + len(model.units.words))):
        assert share[unit == u].sum() + model.unknown[u] == pytest.approx(1.0)


def test_scores_are_those_of_the_model(spark):
    """Token by token from the model's parts, with known, shared and unknown words."""
    train = spark.createDataFrame([(prose(k, 300, 900),) for k in range(40)], "text string")
    model, counts = classlm.train(train, classlm.Sizes(words=30, endings=12, classes=5, head=200))
    known = {r["word"]: r["n"] for r in counts.collect()}
    units = model.units
    at = {w: k + 2 for k, w in enumerate(units.words.to_pylist())}
    ends = {e: k + 2 + len(at) for k, e in enumerate(units.endings.to_pylist())}
    texts = [None, "", "never seen", prose(3, 80, 900), prose(77, 120, 5000), " ".join(units.words.to_pylist()[:50]) + " Qq xyzzy"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in classlm.score(docs, model, counts).collect()}
    for k, text in enumerate(texts):
        total, before = 0.0, model.label[0]
        for word in [*(text or "").lower().split(), ""]:
            unit = 0 if word == "" else at.get(word, ends.get(word[-3:], 1))
            total += model.after[before, model.label[unit]] + model.inside[unit]
            if word and word not in at:
                n = known.get(word, 0)
                total += math.log10((n - 0.75) / model.mass[unit] if n else model.unknown[unit])
            before = model.label[unit]
        assert got[k] == pytest.approx(total)
    # classes follow classes, and units stand in their class, with probability one
    assert (10**model.after).sum(1) == pytest.approx(1.0)
    assert np.bincount(model.label, 10**model.inside) == pytest.approx(1.0)


def test_words_move_to_the_class_they_belong_to(spark):
    """Three kinds of words in turn: frequent ones are exchanged, rarer ones find their kind by Spark's counts."""
    rand = random.Random(4)
    common = [[f"{'abc'[k]}{i}" for i in range(4)] for k in range(3)]
    rare = [[f"{rand.choice('xyz')}{k}{i}q" for i in range(30)] for k in range(3)]

    def text():
        return " ".join(rand.choice(common[k % 3] if rand.random() < 0.7 else rare[k % 3]) for k in range(90))

    texts = spark.createDataFrame([(text(),) for _ in range(200)], "text string")
    model, _ = classlm.train(texts, classlm.Sizes(words=12, endings=5, classes=4, head=1000))
    label = dict(zip(model.units.words.to_pylist(), model.label[2:].tolist()))
    kinds = [{label[w] for w in some} for some in common]
    assert all(len(kind) == 1 for kind in kinds) and len(set.union(*kinds)) == 3
    assert all({label[w] for w in some} == kind for some, kind in zip(rare, kinds))


def test_equally_frequent_words_are_units(spark):
    texts = spark.createDataFrame([(" ".join(f"w{k:03}" for k in range(200)),)] * 5, "text string")
    model, counts = classlm.train(texts, classlm.Sizes(words=10, endings=5, classes=3, head=50))
    assert model.units.words.to_pylist() == [f"w{k:03}" for k in range(50)]
    none, counts = classlm.train(texts.limit(0), classlm.Sizes())
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert all(r["score"] <= 0 and r["n_known"] == 0 for r in classlm.score(docs, none, counts).collect())


# ---- HTML ------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a = "<p>no</p>";</script></head><body>
<header><p>Site</p></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<article><h1>Head &amp; shoulders</h1><p>One <b>two</b><br>three
 four</p><aside>Side</aside><p>Five<p>Six &lt;7&gt;<div class="ad">Buy</div><form><p>Mail</p><input name=x></form>
<ul><li>Item</li></ul><p></p><div class="share">Share</div></article><div id="comments"><p>First!</p></div><footer>&copy;</footer>"""


def text_of(html):
    return "\n".join(t for _, t, main in templates.page_tokens(html) if t and main)


def test_main_text_of_a_page():
    assert text_of(PAGE) == "Head & shoulders\nOne two three four\nFive\nSix <7>\nItem"
    assert text_of("") == "" == text_of(None) and text_of("<article>" + "x" * 10**6) == "x" * 10**6
    assert text_of("<article><p a='>'>1<p>2 < 3</article>") == "1\n2 < 3"
    assert [t for _, t, main in templates.page_tokens("<body><p>a</p><nav>b</nav>") if t and main is None] == ["a"]
    assert text_of("<article><p title='open>one<p>two</article>") == "one\ntwo"
    assert text_of("<article>" + "<div>" * 20_000 + "deep") == "deep"
    assert text_of("<article><ul><li>a<li class=ad>b<li>c</ul>") == "a\nc"
    for odd in ("<", "<article", "</article></nav>", "<!-- x", "<script>", "&#xZ;", "<p/><article/>x"):
        list(templates.page_tokens(odd))


def pages(spark, n, host="site.org"):
    rows = [
        (k, f"http://{host}/{k}", f"<html><body><nav><ul><li>m{k}</li><li>n{k}</li></ul></nav><article><p>Daily news</p><p>{prose(k, 20)}</p>"
         f"<p>{'shared words here' if k % 2 else prose(k + 999, 5)}</p></article><footer>f</footer></body></html>", "mine")
        for k in range(n)
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string")


def test_template_blocks_go_where_a_template_is_known(spark):
    many, few = pages(spark, 12), pages(spark, 3, "few.org")
    odd = [(100, None, None, "x"), (101, "nothing", "<p>a</p>", "x"), (102, "", "", "x")]
    odd = spark.createDataFrame(odd, many.schema)
    got = templates.extract_text(many.union(few).union(odd).union(odd))
    rows = {(r["page_id"], r["url"]): r for r in got.collect()}
    assert got.columns == [*many.columns, "text"] and got.count() == 21
    assert rows[3, "http://site.org/3"]["text"] == f"{prose(3, 20)}\nshared words here"
    assert rows[2, "http://few.org/2"]["text"].startswith("Daily news\n")
    assert rows[100, None]["text"] == "" == rows[102, ""]["text"] and rows[101, "nothing"]["text"] == "a"
    template = templates.deduce(many.withColumn("host", F.lit("h")))
    root = [r["role"] for r in template.filter("root").orderBy("place").collect()]
    assert root[:3] == ["/html", "/html/body", "/html/body/nav"] and "/html/body/article>" in root
    nested = template.filter("class > 0 AND parent >= 0").select("role").distinct().collect()
    assert {r[0] for r in nested} == {"/html/body/nav/ul/li", "/html/body/nav/ul/li>"}


def texts_of(spark, htmls, host="site.org"):
    rows = [(k, f"http://{host}/{k}", html) for k, html in enumerate(htmls)]
    got = templates.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r["text"] for r in sorted(got, key=lambda r: r["page_id"])]


def test_classes_decide_where_names_give_the_wrong_text(spark):
    # no article: blocks in plain elements, some on three of four pages, one of them twice a page
    offer = [f"<div>Our offer</div><div>{'Order now' if k % 4 else prose(k + 500, 3)}</div>" for k in range(16)]
    plain = [
        f"<body><div>Start page</div><div>{prose(k, 30)}</div>{o}<div>{prose(k + 99, 20)}</div>{o if k % 4 else ''}</body>"
        for k, o in enumerate(offer)
    ]
    got = texts_of(spark, plain)
    own = [f"{prose(k, 30)}\n" + ("" if k % 4 else f"{prose(k + 500, 3)}\n") + prose(k + 99, 20) for k in range(16)]
    assert got == own
    # notices inside the article, on most pages; a page without an article element has its text in the same slot
    inner = [f"<h1>{prose(k, 4)}</h1><p>{prose(k + 99, 40)}</p>" + "<p>Read more</p><p>With our app</p>" * (k % 4 > 0) for k in range(16)]
    article = [f"<body><div>{prose(k + 7, 3)}</div><hr><article>{i}</article><p>{prose(k + 70, 2)}</p></body>" for k, i in enumerate(inner)]
    assert texts_of(spark, article) == [f"{prose(k, 4)}\n{prose(k + 99, 40)}" for k in range(16)]
    # an article element that few pages have, around a teaser only
    teaser = [f"<body><div>{prose(k, 40)}</div>" + f"<article>{prose(k + 50, 3)}</article>" * (k % 4 == 0) + "</body>" for k in range(16)]
    got = texts_of(spark, teaser)
    assert all(prose(k, 40) in got[k] for k in range(16))


def test_articles_keep_their_blocks(spark):
    story = "".join(f"<p>{prose(k, 30)}</p>" for k in range(5))
    text = "\n".join(prose(k, 30) for k in range(5))
    # copies of one article, near copies whose menus, or one paragraph, differ
    assert texts_of(spark, [f"<body><nav>a</nav><article>{story}</article>"] * 9) == [text] * 9
    assert texts_of(spark, [f"<body>{story}"] * 9) == [text] * 9
    assert texts_of(spark, [f"<body><nav>{k}</nav><article>{story}</article>" for k in range(9)]) == [text] * 9
    last = [prose(k + 50, 30) for k in range(9)]
    near = [f"<body><nav>{k}</nav><article>{story}<p>{p}</p></article>" for k, p in enumerate(last)]
    assert texts_of(spark, near) == [f"{text}\n{p}" for p in last]
    # one odd, one empty and one null page among many do not stop the others' template from going
    many = [f"<body><article><p>Daily news</p><p>{prose(k, 30)}</p></article>" for k in range(20)]
    got = texts_of(spark, [*many, "<p>odd", "", None])
    assert got == [*(prose(k, 30) for k in range(20)), "odd", "", ""]


def test_names_of_whole_pages_set_nothing_aside():
    for name in ("body", "main", "article"):
        page = "<html class='no-sidebar'><body><main><article><p>Text</p><aside>x</aside></article></main></body></html>"
        assert text_of(page.replace(f"<{name}", f"<{name} class='left-sidebar'")) == "Text"


def test_pages_of_the_table(spark):
    got = QUERIES["op4_html_extraction"](spark, SMALL).collect()
    source = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    assert len(got) == len(source)
    for r in got:
        assert r["text"] == text_of(source[r["page_id"]]) and r["n_chars"] == len(r["text"])


@pytest.mark.parametrize("wrap", [
    '<div class="layout has-sidebar">{}</div>', '<div class="page no-sidebar">{}</div>', "<form action=/x>{}</form>",
    '<section id="content-with-comments" role="main"><div class="widget">{}</div></section>', "{}",
])
@pytest.mark.parametrize("inner", [
    "<main><article>{}</article></main>", "<article>{}</article>", '<main><div class="post share-enabled">{}</div></main>',
    '<article class="ad"><form class="share">{}</form></article>',
])
def test_names_set_nothing_aside_that_holds_the_article(wrap, inner):
    body = f"<h1>{prose(1, 4)}</h1><p>{prose(2, 40)}</p>" + '{}' + f"<p>{prose(3, 30)}</p>"
    text = f"{prose(1, 4)}\n{prose(2, 40)}\n{prose(3, 30)}"
    side = '<div class="sidebar"><p>Side</p></div><div class="comments"><article class="comment">Great!</article></div>'
    for noise in ("", '<div class="share">Tell</div>', '<p class="ad">Buy<div class="ad">Now</div>', "<form>Mail</form>", "<aside>x</aside>"):
        page = f"<html><body><header><h1>Site</h1></header>{wrap.format(inner.format(body.format(noise)))}{side}<footer>f</footer></body></html>"
        assert text_of(page) == text
    # without article elements a name sets aside what holds less than half of the page
    plain = wrap.format(f"<div>{body.format('<p class=ad>Buy</p>')}</div>")
    blocks = [t for _, t, main in templates.page_tokens(f"<body>{side.replace('article', 'div')}{plain}</body>") if t and main is None]
    assert "\n".join(blocks) == text


def test_an_unclosed_paragraph_swallows_nothing():
    assert text_of('<article><p>one<p class="ad">Buy<div>two</div><h2>three</h2></article>') == "one\ntwo\nthree"
    assert text_of("<article><header><h1>Title</h1><p>By me</p></header><p>Text</p></article>") == "Title\nText"
    long = prose(5, 60)
    assert text_of(f"<article><p>{prose(4, 10)}</p><div class='comments'><p>{long}</p></div></article>") == prose(4, 10)


def test_classes_find_the_article_when_no_name_does(spark):
    """The given pages with all elements renamed: the template's slots have to say what the articles' names did."""
    source = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html").collect()
    names = {"article": "x-one", "nav": "x-two", "footer": "x-three", 'div class="ad"': "x-four", "/div": "/x-four"}

    def renamed(html):
        for old, new in names.items():
            html = html.replace(f"<{old}>", f"<{new}>").replace(f"</{old}>", f"</{new}>").replace("<" + old + ">", "<" + new + ">")
        return html

    rows = [(r["page_id"], r["url"], renamed(r["html"] or "")) for r in source]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    hosts = df.select(templates.host_of(F.col("url")).alias("h"), "html").distinct().groupBy("h").count().filter("count >= 8")
    got = templates.extract_text(df).join(hosts, templates.host_of(F.col("url")) == F.col("h"), "left_semi")
    want = {r["page_id"]: text_of(r["html"]) for r in source}
    rows = got.select("page_id", "text").collect()
    assert len(rows) > 60 and sum(r["text"] == want[r["page_id"]] for r in rows) == len(rows)


# ---- packing ---------------------------------------------------------------------------------


def check_pieces(rows, docs, length, name="word_bpe_49k.json"):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path(name))
    expected = Counter()
    for key, text in docs:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        expected[key, len(ids)] += len(ids)
    got, whole, fill = Counter(), defaultdict(list), defaultdict(list)
    for r in rows:
        got[r["doc_id"], r["doc_tokens"]] += r["length"]
        whole[r["doc_id"]].append(r)
        fill[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got == expected
    for places in fill.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at and n > 0
            at += n
        assert at <= length
    once = Counter(key for key, _ in docs)
    for key, text in docs:
        if once[key] == 1:
            ids, at = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4"), 0
            for r in sorted(whole[key], key=lambda r: r["start"]):
                assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
                at += r["length"]
            assert at == len(ids)
    sizes = [sum(n for _, n in places) for places in fill.values()]
    return sum(length - n for n in sizes if n & (n - 1)) / (len(sizes) * length)


@pytest.mark.parametrize("length, windows", [(2048, 128), (64, 2), (1, 1)])
def test_pieces_are_whole(spark, edge_docs, docs_of, length, windows):
    rows = packing.pack(edge_docs, tokenizer_path(), length=length, windows=windows).collect()
    check_pieces(rows, docs_of, length)


def test_a_tokenizer_that_keeps_white_space_and_case(edge_docs, docs_of):
    name = "byte_bpe_50k.json"
    assert packing.WordIds(tokenizer_path())._by_word and not packing.WordIds(tokenizer_path(name))._by_word
    check_pieces(packing.pack(edge_docs, tokenizer_path(name)).collect(), docs_of, 2048, name)


def test_large_keys_stay_exact(spark):
    docs = spark.createDataFrame([(2**60 + 1, "a b c"), (None, "d"), (2**60 + 3, "e")], "doc_id long, text string")
    for df in (packing.pack(docs.coalesce(1), tokenizer_path()), fingerprints.fingerprints(docs)):
        assert {r["doc_id"] for r in df.collect()} == {2**60 + 1, None, 2**60 + 3}


def test_little_padding_and_many_partitions(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    for n in (1, 70):
        rows = packing.pack(docs.repartition(n), tokenizer_path()).collect()
        assert check_pieces(rows, [tuple(r) for r in docs.collect()], 2048) < 0.02


def test_best_fit_with_bounded_windows():
    pieces = [(k, 0, bytes(4 * n), n) for k, n in enumerate([6, 7, 3, 4, 9, 23, 5])]
    placed = list(packing.sequences(iter(pieces), 10, 2, 0))
    assert sum(len(p[2]) for _, _, p in placed) == sum(len(p[2]) for p in pieces)
    at = {(p[0], p[1]): (s, o) for s, o, p in placed}
    assert at[2, 0] == (0, 7) and at[3, 0] == (1, 6)  # 3 fits best beside 7, 4 beside 6
    assert at[5, 0][1] == 0 == at[5, 10][1] and at[5, 20][0] is None


# ---- fingerprints ----------------------------------------------------------------------------


def test_fingerprints_of_every_document(spark, edge_dir, docs_of):
    got = QUERIES["op6_document_fingerprints"](spark, edge_dir).collect()
    docs = sorted(((k, t or "") for k, t in docs_of), key=lambda d: (d[0] is not None, d[0] or 0, d[1]))
    expected = []
    for k, (key, text) in enumerate(docs):
        after, cut = docs[(k + 1) % len(docs)][1], len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        pair = [fingerprints.fingerprint(t) for t in (text, edited, after)]
        near = [float(fingerprints.likeness([pair[0]], [p])[0]) for p in pair[1:]]
        expected.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest(), pair[0], pair[1], *near))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))


def test_likeness():
    text = prose(1, 2000)
    edited = text[:4000] + " something else " + text[4100:]
    a, b, c = map(fingerprints.fingerprint, (text, edited, prose(2, 2000)))
    same, near, far = fingerprints.likeness([a, a, a], [a, b, c])
    assert same == 1 and 0.7 < near < 1 and far < 0.35
    assert all(len(part) <= 64 for part in a.split(":")[1:]) and fingerprints.fingerprint("") == "3::"
    moved = fingerprints.fingerprint("x" * 50 + text)  # letters do not depend on where a piece stands
    assert fingerprints.likeness([a], [moved])[0] > 0.8


def test_edit_distances():
    rand = random.Random(0)
    some = ["".join(rand.choice("abcd") for _ in range(rand.randint(0, 64))) for _ in range(120)]

    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
        return row[-1]

    found = fingerprints.edit_distances(some, some[::-1])
    assert found.tolist() == [plain(a, b) for a, b in zip(some, some[::-1])]


# ---- language --------------------------------------------------------------------------------


def test_held_out_languages(spark):
    folder = "/root/testdata/sf0.01"
    got = QUERIES["op7_language_id"](spark, folder)
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = got.filter("held_out").join(truth.filter("lang is not null"), "doc_id").collect()
    assert len(rows) > 100 and sum(r["lang"] == r["lang_pred"] for r in rows) > 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_texts_without_letters(spark, edge_dir, docs_of):
    got = QUERIES["op7_language_id"](spark, edge_dir).collect()
    letters = {str(k): any(c.isalpha() for c in t or "") for k, t in docs_of}
    assert all((r["lang_pred"] == "und") == (not letters[str(r["doc_id"])]) for r in got)
    assert {r["lang_pred"] for r in got} <= {"und", "en", "de"}
    one = spark.createDataFrame([(1, "abc", "xx")], "doc_id long, text string, lang string")
    tree = langid.train(one, F.lit(True))
    assert tree.predict(["anything", None, "12"]) == [("xx", 1.0), ("und", 0.0), ("und", 0.0)]


# ---- url filters -----------------------------------------------------------------------------


def judge(url, block, allow):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    best = None
    for kind, some in (("block", block), ("allow", allow)):
        for rule in some:
            h, p = rule.split("/", 1)
            if host and (host == h or host.endswith("." + h)) and path.startswith("/" + p):
                rank = (len(rule), len(h), kind == "block")
                if best is None or rank > best[0]:
                    best = (rank, rule, kind)
    return host, path, best and best[1], best[2] if best else "allow"


def test_urls_against_plain_rules(spark):
    rand = random.Random(5)
    hosts = ["net", "a.net", "b.a.net", "example.com", "www.EXAMPLE.com", "xnet", "", "net.org", "É.org", "a..net"]
    paths = ["", "/", "/en/", "/en", "/de/x", "/fr/y?z=/en/", "/de/#/en/", "?/en/", "//", "/😀/en"]
    block = ["net/", "example.com/de/", "a.net/en", "org/", "b.a.net/"]
    allow = ["a.net/en/", "org/fr/", "example.com/", "b.a.net/", "nowhere.else/"]
    urls_ = [f"{rand.choice(['http', 'https', ''])}://{rand.choice(hosts)}{rand.choice(paths)}" for _ in range(300)]
    urls_ += [None, "", "no scheme", "a://b://net/", "http://net\n/en/"]
    rows = [(k, u, "mine", "mine") for k, u in enumerate(urls_)] + [(0, urls_[0], "mine", "mine")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, url_keys string")
    got = urls.filter_urls(df, block, allow)
    assert got.count() == len(rows) and {r[0] for r in got.select("url_keys").collect()} == {"mine"}
    for r in got.collect():
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == judge(r["url"], block, allow), r["url"]
    assert urls.filter_urls(df.limit(0), block, allow).count() == 0
    assert {r[0] for r in urls.filter_urls(df, [], []).select("verdict").collect()} == {"allow"}


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(5000).select(F.col("id").cast("string").alias("key"))
    listed = universe.filter("key % 37 = 0").union(spark.createDataFrame([("elsewhere",)], "key string"))
    cascade = urls.build(listed.union(listed), universe)
    assert len(cascade.levels) > 1
    wrong = universe.filter(cascade.lists(F.col("key")) != (F.col("key") % 37 == 0))
    assert wrong.count() == 0
    assert urls.build(listed.limit(0), universe).levels == ()


def test_a_list_that_is_too_long_is_refused(spark, monkeypatch):
    monkeypatch.setattr(urls, "MAX_BITS", 128)
    keys = spark.range(500).select(F.col("id").cast("string").alias("key"))
    with pytest.raises(ValueError, match="cut the list"):
        urls.build(keys, keys)


# ---- SimHash ---------------------------------------------------------------------------------


def plain_simhash(text):
    ws = [w.lower() for w in words(text)]
    shingles = [b" ".join(ws[i : i + 4]) for i in range(max(1, len(ws) - 3))] if ws else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_groups(values):
    root = list(range(len(values)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= 4:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(k) for k in range(len(values))]


def test_near_duplicates_of_edge_cases(spark, edge_dir, docs_of):
    got = QUERIES["op9_simhash_near_dedup"](spark, edge_dir).collect()
    values = [plain_simhash(t) for _, t in docs_of]
    group, least = plain_groups(values), {}
    for (key, _), g in zip(docs_of, group):
        if key is not None:
            least[g] = min(key, least.get(g, key))
    expected = [(key, f"{v:016x}", least.get(g)) for (key, _), v, g in zip(docs_of, values, group)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))


@pytest.mark.parametrize("at_once, held", [(4_000_000, 4_000_000), (1 << 12, 16)])
def test_all_pairs_within_four_bits_meet(spark, monkeypatch, at_once, held):
    monkeypatch.setattr(simhash, "AT_ONCE", at_once)
    monkeypatch.setattr(simhash, "HELD", held)
    rand = random.Random(11)
    values = [rand.getrandbits(64) for _ in range(30)] + [0, (1 << 64) - 1]
    for k in range(60):  # chains: each a few bits from an earlier one
        v = rand.choice(values)
        for bit in rand.sample(range(64), k % 6):
            v ^= 1 << bit
        values.append(v)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    rows = spark.createDataFrame([(v, k) for k, v in enumerate(signed)], "value long, id long")
    found = {r["value"]: r["component_id"] for r in simhash.groups(rows).collect()}
    assert [found[v] for v in signed] == plain_groups(values)


def test_components(spark):
    edges = [(k, k + 1) for k in range(200)] + [(500, 900 + k) for k in range(50)] + [(1, 1), (3, 2)]
    df = spark.createDataFrame(edges, "src long, dst long")
    roots = {r["node"]: r["root"] for r in simhash.components(df).collect()}
    assert {roots[k] for k in range(201)} == {0} and {roots[k] for k in [500, *range(900, 950)]} == {500}
    assert len(roots) == 201 + 51 and simhash.components(df.limit(0)).count() == 0


def test_one_document_of_each_group_stays(spark, edge_docs, no_docs, docs_of):
    kept = simhash.one_of_each(edge_docs)
    values = [plain_simhash(t) for _, t in docs_of]
    assert kept.columns == edge_docs.columns and kept.count() == len(set(plain_groups(values)))
    assert {r[0] for r in kept.select("value").distinct().collect()} == {"mine"}
    assert simhash.one_of_each(no_docs).count() == 0
    assert set(CLASHING) <= set(kept.columns)
