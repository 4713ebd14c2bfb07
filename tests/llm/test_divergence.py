"""Source divergence against plain Python integers, and the trees against direct sums."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.llm.divergence import Nodes, audit, exact_f, exact_p, leaf_p, pair_price, shared_pairs

COLUMNS = ("lang", "source", "part", "item", "value", "rank")


def price(p, q):
    return (p - q) * (p - q) // q


def plain_audit(rows, min_docs=3, top=200):
    """``rows`` as ``(text, lang, source)``; by the definition, over all kept terms."""
    term = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
    upper = {i: i + 32 for i in range(65, 91)}
    n, docs, groups = {}, Counter(), {}
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = Counter(term.findall((text or "").translate(upper)))
        n.setdefault((lang, source), Counter()).update(found)
        docs.update((lang, t) for t in found)
        groups.setdefault(lang, set()).add(source)
    out = set()
    for lang, sources in groups.items():
        kept = sorted(t for (of, t), d in docs.items() if of == lang and d >= min_docs)
        counts = {s: {t: n[lang, s][t] for t in kept} for s in sources}
        whole = {t: sum(c[t] for c in counts.values()) for t in kept}

        def p(c):
            return {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}

        of = {s: p(c) for s, c in counts.items()}
        q = p(whole)
        for s in sources:
            pairs = [(-sum(price(of[s][t], of[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(-price(of[s][t], q[t]), t) for t in kept if counts[s][t] and of[s][t] > q[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out |= {(lang, s, part, i, -v, r + 1) for r, (v, i) in enumerate(items)}
    return out


def result(df):
    rows = df.select(*COLUMNS).collect()
    found = {tuple(r) for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("seed", range(30))
def test_trees_price_like_direct_sums(seed):
    draw = random.Random(seed)
    groups, terms = draw.randint(1, 5), draw.randint(1, 70)
    counts = np.array([[draw.choice([0, 0, 0, 1, 2, 50]) for _ in range(terms)] for _ in range(groups)])
    nodes, totals = Nodes(counts), counts.sum(axis=1).tolist()
    p = [leaf_p(nodes, t, terms) for t in totals]
    for a in range(groups):
        for b in range(groups):
            pa = [1 + 10**9 * (int(c) + 1) // (totals[a] + terms) for c in counts[a]]
            pb = [1 + 10**9 * (int(c) + 1) // (totals[b] + terms) for c in counts[b]]
            expected = (sum(map(price, pa, pb)), sum(map(price, pb, pa)))
            assert pair_price(nodes, a, b, p[a], p[b]) == expected


def test_equal_subtrees_are_one_node_and_priced_once():
    counts = np.zeros((2, 4096), dtype=np.int64)
    counts[:, :8] = [[5, 4, 3, 2, 1, 0, 0, 1], [5, 4, 3, 2, 0, 0, 2, 0]]
    nodes = Nodes(counts)
    assert nodes.levels[2][0, 0] == nodes.levels[2][1, 0]  # the same four counts
    assert len(np.unique(nodes.levels[5][:, 1:])) == 1  # zeros of all groups and places
    pairs, steps = shared_pairs(nodes, 0, 1)
    assert sum(s.shape[1] for s in steps) < 40 and pairs.shape[1] < 10  # of 4,096 leaves


def test_exact_arithmetic(spark):
    rows = [(0, 0, 1), (10**13, 10**13 + 7, 12_345), (999, 10**12 + 1, 3), (5, 11, 2)]
    got = (
        spark.createDataFrame(rows, "n long, total long, v long")
        .select("n", "total", "v", exact_p(F.col("n"), F.col("total"), F.col("v")).alias("p"))
        .collect()
    )
    for n, total, v, p in got:
        assert p == 1 + 10**9 * (n + 1) // (total + v)
    pairs = [(10**9 + 1, 1), (7, 10**9 + 1), (10**9, 3)]
    for p, q, f in (
        spark.createDataFrame(pairs, "p long, q long").select("p", "q", exact_f(F.col("p"), F.col("q"))).collect()
    ):
        assert f == price(p, q)


def test_documents(documents):
    rows = [tuple(r) for r in documents.select("text", "lang", "source").collect()]
    assert result(audit(documents)) == plain_audit(rows)
    # Small blocks and chunks: many tasks, the same values.
    small = audit(documents, block_terms=50, sources_at_once=3)
    assert result(small) == plain_audit(rows)


def test_odd_documents(odd_documents, no_documents):
    rows = [tuple(r) for r in odd_documents.select("text", "lang", "source").collect()]
    assert result(audit(odd_documents, min_docs=2, top_terms=5)) == plain_audit(rows, 2, 5)
    found = result(audit(odd_documents))  # hardly any term in three rows
    assert found == plain_audit(rows)
    assert audit(no_documents).count() == 0


def test_languages_without_kept_terms(spark):
    rows = [("a b", "x", "s"), ("c", "x", "t"), ("", "x", None), (None, None, "s"), ("É é ab", None, "s")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    assert result(audit(docs)) == plain_audit(rows)
    assert {r[4] for r in plain_audit(rows)} == {0}
    one = spark.createDataFrame([("É é AB", "x", "s")] * 3 + [("", "x", "t")], docs.schema)
    assert result(audit(one)) == plain_audit([("É é AB", "x", "s")] * 3 + [("", "x", "t")])
