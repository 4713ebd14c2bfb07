"""Decontamination: planted passages, paraphrases, brute force, odd input."""

import random
import re

import pytest
from pyspark.sql import functions as F

from panelspark.llm import decontaminate as D


def normal(text):
    return " " + " ".join(D.plain(D.tokens_of(text))) + " "


def test_documents_against_plain_search(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = [(r["item_id"], normal(r["text"])) for r in benchmark.collect()]
    expected = {(d["doc_id"], i) for d in docs.collect() for i, t in items if t in normal(d["text"])}
    found = D.find_items(docs, benchmark).select("doc_id", F.explode("items").alias("i")).collect()
    assert {(r["doc_id"], r["i"]["item_id"]) for r in found} == expected and len(expected) > 5
    kept = D.without_items(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == docs.count() - len({d for d, _ in expected})


@pytest.mark.parametrize("seed", range(15))
def test_common_subsequence(seed):
    draw = random.Random(seed)
    a = [draw.choice("abcd") for _ in range(draw.randint(1, 15))]
    b = [draw.choice("abcd") for _ in range(draw.randint(0, 20))]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    used = D.common_subsequence(a, b)
    assert sum(used) == best[-1][-1]
    rest = iter(b)
    assert all(x in rest for x, u in zip(a, used, strict=True) if u)


@pytest.fixture(scope="module")
def corpus(spark):
    """Random documents, half of them with an item: whole, marked up otherwise, or one word in nine changed."""
    draw = random.Random(4)
    words = ["".join(draw.choice("aeioulmnrst") for _ in range(4)) for _ in range(1500)]
    items = [(i, " ".join(draw.choice(words) for _ in range(draw.randint(12, 60)))) for i in range(40)]
    rows = []
    for n in range(200):
        body = [draw.choice(words) for _ in range(draw.randint(20, 400))]
        item = None
        if n % 2:
            item, text = draw.choice(items)
            planted = text.split()
            if n % 4 == 3:
                planted = [w if k % 9 else draw.choice(words) for k, w in enumerate(planted)]
            if n % 8 == 1:
                planted = [re.sub("^.", lambda m: m[0].upper(), w) + draw.choice(["", ",", "."]) for w in planted]
            at = draw.randint(0, len(body))
            body[at:at] = planted
        rows.append((n, " ".join(body), item))
    docs = spark.createDataFrame(rows, "doc_id long, text string, item long")
    return docs, spark.createDataFrame(items, "item_id long, text string")


def test_planted_items_and_paraphrases(corpus):
    docs, benchmark = corpus
    found = D.find_items(docs, benchmark).collect()
    for row in found:
        ids = [x["item_id"] for x in row["items"]]
        assert ids == ([] if row["item"] is None else [row["item"]])


def test_blocks_and_chunks_do_not_matter(corpus, monkeypatch):
    docs, benchmark = corpus
    expected = {r["doc_id"]: [x["item_id"] for x in r["items"]] for r in D.find_items(docs, benchmark).collect()}
    monkeypatch.setattr(D, "ITEMS_PER_BLOCK", 15)
    monkeypatch.setattr(D, "BLOCKS_PER_PASS", 2)
    monkeypatch.setattr(D, "CHUNK_WORDS", 90)
    found = {r["doc_id"]: sorted(x["item_id"] for x in r["items"]) for r in D.find_items(docs, benchmark).collect()}
    assert found == expected


def test_odd_documents(spark, odd_documents, no_documents):
    benchmark = spark.createDataFrame(
        [(1, "the cat sat on the mat and the dog lay"), (2, None), (None, "a row without a key"), (3, "!!"), (4, ""),
         (5, "a row without a key, twice"), (5, "a row without a key, twice"), (6, "a row without a key; twice")],
        "item_id long, text string",
    )
    found = D.find_items(odd_documents, benchmark).collect()
    assert len(found) == odd_documents.count()
    hits = {(r["doc_id"], tuple(x["item_id"] for x in r["items"])) for r in found if r["items"]}
    assert hits == {(1, (1,)), (None, (5, 6))}
    assert D.without_items(odd_documents, benchmark).columns == odd_documents.columns
    assert D.without_items(odd_documents, benchmark).count() == odd_documents.count() - 4
    assert D.find_items(no_documents, benchmark).count() == 0
    assert D.without_items(odd_documents, benchmark.limit(0)).count() == odd_documents.count()


def test_verbatim_items_with_marks_inside_words(spark):
    """Apostrophes, hyphens, slashes, curly quotes and guillemets in an item's words do not hide its copies."""
    draw = random.Random(6)
    words = ["".join(draw.choice("aeioulmnrst") for _ in range(5)) for _ in range(1500)]
    shapes = ["{0}'{1}", "{0}-{1}", "{0}/{1}", "{0}_{1}", "“{0}”", "«{0}»", "¿{0}", "{0}’{1}"]

    def marked(n):
        return " ".join(draw.choice(shapes).format(draw.choice(words), draw.choice(words)) if draw.random() < 0.7
                        else draw.choice(words) for _ in range(n))

    items = [(i, marked(draw.randint(15, 50))) for i in range(30)]
    rows = []
    for n in range(120):
        body = [draw.choice(words) for _ in range(draw.randint(50, 300))]
        item, text = items[n % 30] if n % 2 else (None, "")
        at = draw.randint(0, len(body))
        # Half of the copies have a dash after every word, which is no word.
        body[at:at] = text.replace(" ", " – ").split() if n % 4 == 1 else text.split()
        rows.append((n, " ".join(body), item))
    docs = spark.createDataFrame(rows, "doc_id long, text string, item long")
    found = D.find_items(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    for row in found:
        assert [x["item_id"] for x in row["items"]] == ([] if row["item"] is None else [row["item"]])


def test_items_whose_rare_words_are_changed(spark):
    """What verification accepts is found, also if the changed words are the only ones that weigh anything."""
    draw = random.Random(8)
    common = ["".join(draw.choice("aeiou") for _ in range(4)) for _ in range(300)]
    rare = ["".join(draw.choice("bcdfghk") for _ in range(6)) for _ in range(4000)]
    items = []
    for i in range(30):
        item = [draw.choice(common) for _ in range(draw.randint(15, 50))]
        # All common in a fifth of the items; otherwise a name in every fifth place.
        items.append([draw.choice(rare) if i % 5 and k % 5 == 1 else w for k, w in enumerate(item)])
    rows = []
    for n in range(300):
        body = [draw.choice(common if draw.random() < 0.8 else rare) for _ in range(draw.randint(50, 300))]
        item = n % 30 if n % 2 else None
        if item is not None:
            planted = [draw.choice(rare) if k % 5 == 1 else w for k, w in enumerate(items[item])]
            assert D.verified(items[item], planted)
            at = draw.randint(0, len(body))
            body[at:at] = planted
        rows.append((n, " ".join(body), item))
    docs = spark.createDataFrame(rows, "doc_id long, text string, item long")
    benchmark = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    for row in D.find_items(docs, benchmark).collect():
        assert [x["item_id"] for x in row["items"]] == ([] if row["item"] is None else [row["item"]])


@pytest.mark.parametrize("seed", range(20))
def test_overlaps_against_counting(seed):
    draw = random.Random(seed)
    terms, stride = draw.randint(1, 25), draw.choice([8, 16, 24])
    numbers = D.np.array([draw.randint(-1, terms - 1) for _ in range(draw.randint(0, 150))], D.np.int32)
    table = D.np.array([[draw.randint(0, 3) for _ in range(4)] for _ in range(terms)], D.np.uint8)
    found = D.overlaps(numbers, D.previous(numbers), stride, table)
    assert len(found) == -(-len(numbers) // stride)
    for window, sums in enumerate(found):
        held = set(numbers[window * stride : (window + 3) * stride].tolist()) - {-1}
        assert sums.tolist() == [sum(int(table[t, i]) for t in held) for i in range(4)]


def test_ids_of_any_kind(spark, corpus):
    docs, benchmark = corpus
    expected = {r["doc_id"]: [f"q{x['item_id']}" for x in r["items"]] for r in D.find_items(docs, benchmark).collect()}
    named = benchmark.selectExpr("concat('q', item_id) as item_id", "text")
    found = {r["doc_id"]: [x["item_id"] for x in r["items"]] for r in D.find_items(docs, named).collect()}
    assert found == expected
    clean = {d for d, items in expected.items() if not items}
    for items in (named, benchmark.selectExpr("if(item_id % 2 = 0, item_id, null) as item_id", "text")):
        assert {r["doc_id"] for r in D.without_items(docs, items).collect()} == clean


@pytest.fixture(scope="module")
def paraphrased(spark):
    """Random documents; every second one holds an item of which four words in nine before the answer are changed."""
    draw = random.Random(12)
    words = ["".join(draw.choice("aeioulmnrst") for _ in range(5)) for _ in range(1500)]
    items = [[draw.choice(words) for _ in range(draw.randint(24, 50))] for _ in range(30)]
    rows = []
    for n in range(200):
        body = [draw.choice(words) for _ in range(draw.randint(50, 300))]
        if n % 2:
            item = items[n % 30]
            answer = len(item) - max(1, len(item) // 3)
            at = draw.randint(0, len(body))
            body[at:at] = [draw.choice(words) if k < answer and k % 9 in (1, 3, 5, 7) else w for k, w in enumerate(item)]
        rows.append((n, " ".join(body), n % 30 if n % 2 else None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, item long")
    return docs, spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")


def test_paraphrases_come_from_the_latent_search(paraphrased, monkeypatch):
    docs, benchmark = paraphrased
    found = {r["doc_id"]: [x["item_id"] for x in r["items"]] for r in D.find_items(docs, benchmark).collect()}
    planted = {r["doc_id"]: r["item"] for r in docs.collect()}
    assert all(found[d] in ([], [i]) for d, i in planted.items())
    hits = sum(found[d] == [i] for d, i in planted.items() if i is not None)
    assert hits >= 0.9 * 100
    # Without the basis no item has a direction, and the words alone are too few.
    monkeypatch.setattr(D, "latent_basis", lambda sample, text, items, weights: D.np.zeros((len(items.terms), 4), D.np.float32))
    without = D.find_items(docs, benchmark).where(F.size("items") > 0).count()
    assert without < hits / 2


def test_scripts_without_blanks(spark):
    draw = random.Random(2)
    sign = lambda n: "".join(chr(draw.randrange(0x4E00, 0x5200)) for _ in range(n))
    items = [(i, sign(30)) for i in range(5)]
    docs = spark.createDataFrame([(i, sign(60) + t + sign(60)) for i, t in items] + [(9, sign(200))], "doc_id long, text string")
    found = D.find_items(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r["doc_id"]: [x["item_id"] for x in r["items"]] for r in found} == {**{i: [i] for i in range(5)}, 9: []}


def test_basis_and_weights_come_from_every_passage(spark, monkeypatch):
    draw = random.Random(4)
    words = [f"w{i}" for i in range(90)]
    # So many different passages that a sample of them would be taken.
    texts = [" ".join(draw.choices(words, k=64)) for _ in range(600)] + [None, "", "none of them"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    items = D._items([0, 1], [words[:40], words[40:]])
    numbers = D.np.array([[t.split().count(w) for w in items.terms] for t in texts[:600]], float)
    monkeypatch.setattr(D, "ROW_CELLS", 500)
    monkeypatch.setattr(D, "STRIP_CELLS", 64 * 90)
    monkeypatch.setattr(D, "PAIR_CELLS", 128)
    cells = D.passage_cells(docs, "text", items.terms)
    weights = D.term_weights(cells, 90)
    seen = (numbers > 0).sum(axis=0)
    assert D.np.allclose(weights, D.np.maximum(D.np.log(602 / (seen + 1)) ** D.DAMPING, D.LEAST_WEIGHT))
    rows = numbers * weights
    rows /= D.np.sqrt((rows**2).sum(axis=1))[:, None]
    exact = rows.T @ rows
    products = D.term_products(cells, D.np.arange(90), weights).collect()
    assert {(r["block"], r["n"]) for r in products} == {(0, 601), (1, 601)} and len(products) == 2
    for row in products:
        first = row["block"] * 64
        part = D.np.frombuffer(row["sums"], "<f8").reshape(-1, 90 - first)
        assert D.np.allclose(part, D.np.triu(exact[first : first + len(part), first:]))
    # One round from the same random matrix spans what A'A times it spans.
    monkeypatch.setattr(D, "ROUNDS", 1)
    monkeypatch.setattr(D, "RANK", 20)
    monkeypatch.setattr(D, "OVERSAMPLE", 0)
    basis = D.latent_basis(cells, D.np.arange(90), items, weights)
    own = items.counts() * weights
    own /= D.np.sqrt((own**2).sum(axis=1))[:, None]
    start = D.np.random.default_rng(11).standard_normal((90, 20), dtype=D.np.float32)
    whole = (exact + own.T @ own * (D.ITEM_WEIGHT * 601 / 2)) @ start
    assert D.np.allclose(basis @ (basis.T @ whole), whole, rtol=1e-3, atol=1e-2)
