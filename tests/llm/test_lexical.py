"""Ranked lexical search (op12) against plain scoring of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from lakeloom.llm import lexical
from lakeloom.tables import load
from tests.conftest import SF001
from tests.llm import cases

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_rank(docs, items, k=10):
    docs = [(i, Counter(plain_terms(t))) for i, t in docs]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(plain_terms(t))
    n_docs, total = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, terms in wanted.items():
        rows = []
        for doc_id, c, n in docs:
            m = 100 - 90 + 90 * n * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if c[t])
            if score > 0:
                rows.append((-score, doc_id is None, doc_id or 0))
        out += [(item, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(rows)[:k])]
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


ITEMS = [(1, "shared3 shared4 SHARED5 a1 b2"), (2, "w5x5 w6x6 the"), (3, None), (4, ""), (5, "nowhere to be found"),
         (6, "x"), (7, "été 中文 c"), (None, "h3 h4 f1"), (1, "c7 c8"), (8, "e1 e1 e2 e3")]


@pytest.mark.parametrize("stages", [lexical.STAGES, (1.0,), (0.5, 1.0)])
def test_awkward_rows(spark, stages):
    docs = cases.frame(spark)
    items = spark.createDataFrame([(i, t, "x", 0) for i, t in ITEMS], "item_id bigint, text string, slice string, score int")
    plain = plain_rank([(r[0], r[1]) for r in cases.documents()], ITEMS, 3)
    assert found(lexical.rank(docs, items, 3, stages)) == plain and plain
    assert found(lexical.rank(docs, items, 3, stages, block_items=2)) == plain


def test_empty_tables(spark):
    docs, none = cases.frame(spark), cases.frame(spark, [])
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert lexical.rank(none, items).count() == 0
    assert lexical.rank(docs, items.where("false")).count() == 0
    assert lexical.rank(docs.where("text IS NULL"), items).count() == 0


def test_given_tables(spark):
    docs, items = load(spark, SF001, "documents"), load(spark, SF001, "benchmark")
    plain = plain_rank([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.collect()])
    assert found(lexical.rank(docs, items)) == plain


def test_many_slices_with_ties(spark, monkeypatch):
    """Every document comes thrice, a long one among them, over slices of a few documents."""
    rng = random.Random(2)
    words = [f"t{int(rng.paretovariate(0.7))}" for _ in range(6000)]
    texts = [" ".join(rng.choices(words, k=rng.randrange(1, 60))) for _ in range(120)] + [" ".join(rng.choices(words, k=400_000))]
    docs = [(n, t) for n, t in enumerate(texts * 3)]
    items = [(n, " ".join(rng.choices(words, k=rng.randrange(1, 12)))) for n in range(25)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5, "doc_id")
    got = found(lexical.rank(df, spark.createDataFrame(items, "item_id bigint, text string"), 5))
    assert got == plain_rank(docs, items, 5)


def test_accumulators_are_dropped_only_on_proof():
    """A bundle's stages in one process: the best k agree with plain sums, and later stages hold fewer."""
    rng = random.Random(4)
    n_docs, n_terms, k = 500, 40, 4
    found_, sizes = [], []
    for _ in range(n_docs):
        own = np.array([t for t in range(n_terms) if rng.random() < 1 / (1 + t / 2)] or [0], np.uint32)
        found_.append(np.repeat(own, rng.randrange(1, 4)))
        sizes.append(len(found_[-1]) + rng.randrange(50))
    own = lexical.Slice.unpack(lexical.Slice.build(list(range(n_docs)), sizes, found_).pack())
    total = sum(sizes)
    block = lexical.Block([(i, [b"%d" % t for t in rng.sample(range(n_terms), 6)]) for i in range(20)])
    block.terms = [np.array(sorted(rng.sample(range(n_terms), 6))) for _ in block.terms]
    df, best = np.zeros(n_terms, np.int64), np.zeros(n_terms, np.int64)
    df[own.terms] = own.sizes
    gain = lexical.impacts(own.tf, lexical.norms(own.n, n_docs, total)[own.doc])
    best[own.terms] = np.maximum.reduceat(gain, own.at[:-1])
    block.plan(n_docs, total, df, best, lexical.STAGES)
    held, floor, most = {}, np.zeros(20, np.int64), 0
    for stage in range(len(lexical.STAGES)):
        held = lexical._unpack_bundle(lexical._pack_bundle(
            lexical.advance(held, own.owned(block.owner == stage), block, stage, floor, k)))
        most = max(most, sum(len(d) for d, _ in held.values()))
    every = 0
    for item, terms in enumerate(block.terms):
        score = np.zeros(n_docs, np.int64)
        for t in terms.tolist():
            i = own.terms.tolist().index(t)
            at = slice(own.at[i], own.at[i + 1])
            score[own.doc[at]] += block.weight[t] * gain[at]
        every += (score > 0).sum()
        want = np.lexsort((np.arange(n_docs), -score))[:k]
        doc, got = held[item]
        order = np.lexsort((doc, -got))[:k]
        assert doc[order].tolist() == want.tolist() and got[order].tolist() == score[want].tolist()
    assert most < every


def test_norms_past_64_bits():
    n = np.array([1, 1 << 40])
    assert lexical.norms(n, 1 << 30, 1 << 62).tolist() == [10 + 90 * int(x) * (1 << 30) // (1 << 62) for x in n]
