"""Toxicity (op5), language-model scores (op3) and vector search (op9)."""

import zlib
from collections import Counter

import numpy as np
import pytest

from lakeloom.llm import covertree, toxicity, xent
from lakeloom.llm.common import HashedWords
from lakeloom.tables import load
from tests.conftest import SF01
from tests.llm import cases


def sets_of(texts):
    lookup = toxicity.Buckets()
    return [toxicity._terms(t.encode(), lookup) for t in texts]


def test_machine_learns_a_pair_that_weights_cannot():
    """Label 1 only where both words stand; each alone is as often 0."""
    rng = np.random.default_rng(0)
    texts, y = [], []
    for i in range(1600):
        filler = " ".join(f"f{j}" for j in rng.integers(0, 40, 6))
        a, b = i % 2, i // 2 % 2
        texts.append(" ".join([filler, "insultx" * a, "groupx" * b]))
        y.append(a and b)
    model = toxicity.fit(sets_of(texts), np.array(y), epochs=30)
    lookup = model.lookup()
    s = [model.score(toxicity._terms(t.encode(), lookup)) for t in
         ("f1 f2 insultx groupx", "f1 f2 insultx", "f1 f2 groupx", "f1 f2", "")]
    assert s[0] > 0.9 and max(s[1:]) < 0.3
    own = np.sort(np.concatenate(sets_of(["insultx", "groupx"])).astype(np.int64))
    rows = [int(np.flatnonzero(model.buckets == b)[0]) for b in own]
    pair = float(model.v[rows].sum(0) @ model.v[rows].sum(0) - (model.v[rows] ** 2).sum())
    assert pair > 1  # the pairs' factors, not the weights alone, carry it


def test_fold_is_never_learnt_and_edge_cases(spark):
    docs = cases.frame(spark)
    rows = [(i, i % 2) for i in (1, 2, 3, 4, 5, 9, 10, 12, 12, 13, 20)] + [(None, 1), (7, None)]
    labels = spark.createDataFrame(rows, "doc_id bigint, toxic int")
    out = toxicity.scores(docs, toxicity.train(docs, labels)).collect()
    assert len(out) == len(cases.documents())
    for r in out:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    held = spark.createDataFrame([(i, 1) for i in range(300) if toxicity.held_out(i)], "doc_id bigint, toxic int")
    model = toxicity.train(docs, held)
    assert not len(model.w) and model.bias < np.log(0.3 / 0.7)  # nothing learnt: nothing predicted
    empty = cases.frame(spark, [])
    assert toxicity.scores(empty, model).count() == 0 and toxicity.clean(empty, model).count() == 0
    assert toxicity.clean(docs, model).columns == docs.columns
    assert toxicity.clean(docs, model).count() == len(cases.documents())


def test_a_term_of_two_toxic_rows_has_a_weight():
    sets = sets_of([f"plain w{i} x{i % 7}" for i in range(198)] + ["zzq plain", "zzq other"])
    model = toxicity.fit(sets, np.array([0] * 198 + [1] * 2))
    assert model.w[list(model.buckets).index(toxicity.term_buckets(b"zzq")[0])] > 0


def test_scores_are_the_explicit_sum_over_pairs():
    """The machine's formula term by term and pair by pair, with and without factors, and a very long text."""
    rng = np.random.default_rng(3)
    words = [b"t%d" % i for i in range(60)]
    buckets = np.unique(np.concatenate([toxicity.term_buckets(w) for w in words]))
    v = (rng.normal(size=(len(buckets) // 2, toxicity.FACTORS)) * 0.2).astype(np.float32)
    model = toxicity.Model(-0.7, buckets, (rng.normal(size=len(buckets)) * 0.3).astype(np.float32), v)
    lookup = model.lookup()
    texts = [b" ".join(rng.choice(words, n)) for n in (0, 1, 2, 7, 40)] + [b" ".join(rng.choice(words, 300_000)) + b" unknown"]
    for text in texts:
        rows = toxicity._terms(text, lookup)
        own = sorted({i for w in set(text.split()) for b in toxicity.term_buckets(w) for i in np.flatnonzero(buckets == b).tolist()})
        assert rows.tolist() == own
        z = model.bias + sum(float(model.w[i]) for i in own)
        z += sum(float(v[i].astype(float) @ v[j].astype(float)) for n, i in enumerate(own) for j in own[n + 1:] if j < len(v))
        assert model.score(rows) == pytest.approx(1 / (1 + np.exp(-z)), rel=1e-4)


def test_only_terms_that_pass_are_gathered(spark, monkeypatch):
    """The model is that of all terms; those that tell nothing stay out of the driver."""
    monkeypatch.setattr(toxicity, "fit", lambda sets, y, real=toxicity.fit: (sets, y, real(sets, y)))
    assert toxicity.MAX_ROWS >= 20_000
    texts = [(i, f"own{i} some w{i % 11} " + ("zzq" if i % 20 == 0 else "yes")) for i in range(400)]
    y = [(i, int(i % 20 == 0)) for i, _ in texts]
    sets, labels, model = toxicity.train(spark.createDataFrame(texts, "doc_id bigint, text string"),
                                         spark.createDataFrame(y, "doc_id bigint, toxic int"))
    kept = [(i, t) for i, t in texts if not toxicity.held_out(i)]
    _, _, plain = toxicity.fit(sets_of([t for _, t in kept]), np.array([i % 20 == 0 for i, _ in kept]))
    assert len(sets) == len(kept) and labels.sum() == sum(i % 20 == 0 for i, _ in kept)
    assert set(np.concatenate(sets).tolist()) == set(plain.buckets.tolist()) == set(model.buckets.tolist())
    assert (model.w == plain.w).all() and (model.v == plain.v).all() and model.bias == plain.bias


def test_toxic_documents_are_found(spark):
    """Held-out rows of the driver's table."""
    docs, labels = load(spark, "/root/testdata/sf0.1", "documents"), load(spark, "/root/testdata/sf0.1", "labels")
    out = toxicity.scores(docs, toxicity.train(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    hit = [r.predicted for r in out if r.toxic == 1]
    miss = [r.predicted for r in out if r.toxic == 0]
    assert sum(hit) > 0.85 * len(hit) and sum(miss) < 0.02 * len(miss)


def plain_losses(rows, targets):
    """The same models by plain counting of words and pairs of words."""
    word, history, pair = ([Counter(), Counter()] for _ in range(3))
    texts = [(i, cases.words(t)) for i, t in rows]
    for i, w in texts:
        for m in (0, 1):
            if m or i in targets:
                word[m].update(w)
                history[m].update([None, *w][:len(w)])
                pair[m].update(zip([None, *w], w))
    known_all = {w for w, n in word[0].items() if n >= xent.LEAST}
    unknown = [sum(n for w, n in word[m].items() if w not in known_all) for m in (0, 1)]
    total = [sum(word[m].values()) for m in (0, 1)]
    out = []
    for i, w in texts:
        if not w:
            out.append((str(i), 0, None, None))
            continue
        own = [Counter(w), Counter([None, *w][:len(w)]), Counter(zip([None, *w], w))]
        counted = [i in targets, True]
        left = [total[m] - len(w) * counted[m] for m in (0, 1)]
        by = [1.0, left[0] / left[1] if left[0] > 0 and left[1] > 0 else 1.0]
        loss = [0.0, 0.0]
        c = lambda tables, kind, m, key: max(tables[m][key] - own[kind][key] * counted[m], 0)
        for before, this in zip([None, *w], w):
            known = c(word, 0, 0, this) >= xent.LEAST
            both = known and (before is None or c(word, 0, 0, before) >= xent.LEAST)
            for m in (0, 1):
                seen = (c(word, 0, m, this) if known else unknown[m]) * by[m]
                p = (seen + xent.MASS_WORD / (len(known_all) + 1)) / (max(left[m], 0) * by[m] + xent.MASS_WORD)
                if both:
                    p = (c(pair, 2, m, (before, this)) * by[m] + xent.MASS_PAIR * p) / (
                        c(history, 1, m, before) * by[m] + xent.MASS_PAIR)
                loss[m] -= np.log(p) / len(w)
        out.append((str(i), len(w), *loss))
    return out


@pytest.mark.parametrize("many", [False, True])
def test_losses_equal_plain_counting(spark, monkeypatch, many):
    """Nulls, copies, repeated rows and a long text; over few and many chunks and ranges, with
    ids broadcast and joined."""
    if many:
        monkeypatch.setattr(xent, "_input_bytes", lambda docs: 1 << 20)
        monkeypatch.setattr(xent.keyed, "MOST_PARTITIONS", 2)
        monkeypatch.setattr(xent, "partitions", lambda spark: 2)
        monkeypatch.setattr(xent, "MOST_IDS", 0)
    rows = [(r[0], r[1]) for r in cases.documents()]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id bigint, text string, score string, mark int")
    targets = [1, 2, 8, 12, 13, 20]
    ids = spark.createDataFrame([(t, "x") for t in targets] + [(None, "y"), (1, "z")], "doc_id bigint, text string")
    got = xent.score(df.repartition(3), ids, range_bytes=1 << (18 if many else 26))
    key = lambda r: (r[0], r[1], r[2] or 0.0)
    got = sorted(((str(r.doc_id), r.n_tokens, r.target_loss, r.background_loss) for r in got.collect()), key=key)
    expected = sorted(plain_losses(rows, set(targets)), key=key)
    for g, e in zip(got, expected, strict=True):
        assert g[:2] == e[:2] and g[2:] == (pytest.approx(e[2:], rel=1e-5) if e[2] is not None else (None, None))
    none = xent.score(df.limit(0), spark.createDataFrame([], "doc_id bigint"))
    assert none.count() == 0


def test_a_very_long_text_among_others(spark):
    rng = np.random.default_rng(8)
    words = [f"v{x}" for x in rng.zipf(1.4, 400_000) % 3000]
    rows = [(0, " ".join(words))] + [(i, " ".join(words[i * 40:i * 40 + 40])) for i in range(1, 60)] + [(60, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    got = xent.score(df, spark.createDataFrame([(i,) for i in range(0, 60, 3)], "doc_id bigint"))
    got = sorted((str(r.doc_id), r.n_tokens, r.target_loss, r.background_loss) for r in got.collect())
    for g, e in zip(got, sorted(plain_losses(rows, set(range(0, 60, 3)))), strict=True):
        assert g[:2] == e[:2] and g[2:] == (pytest.approx(e[2:], rel=1e-5) if e[2] is not None else (None, None))


def test_only_what_others_add_is_answered():
    """Two chunks share one word: nothing else comes back."""
    hashes = HashedWords(17)
    chunks = [xent.Chunk([(0, b"a b c d", True)], hashes), xent.Chunk([(1, b"e f g a", False), (2, b"", True)], hashes)]
    blobs = [(n, data) for n, c in enumerate(chunks) for r, data in c.blobs(1)]
    figures, answers = xent.add_up(blobs)
    assert figures == [0, 4, 8, 4, 8] and [c for c, _ in answers] == [0, 1]
    for chunk, data in answers:
        before = [c.copy() for c in chunks[chunk].counts]
        chunks[chunk].add(1, [(0, xent.keyed.unsqueeze(data))])
        changed = [np.flatnonzero((c != b).any(axis=0)) for c, b in zip(chunks[chunk].counts, before)]
        assert len(changed[0]) == 2 and len(changed[1]) == 0  # the shared word and the start
        assert chunks[chunk].counts[0][1].max() == 2


def test_scores_tell_low_quality_apart(spark):
    """Held-out documents marked as poor lie further from the good ones."""
    labels = load(spark, "/root/testdata/sf0.1", "labels")
    good = labels.where("quality = 1").where(xent.training_fold(labels["doc_id"]))
    out = xent.score(load(spark, "/root/testdata/sf0.1", "documents"), good)
    out = out.join(labels.where(~xent.training_fold(labels["doc_id"])), "doc_id").where("score IS NOT NULL").collect()
    low = np.array([r.score for r in out if r.quality == 0])
    high = np.array([r.score for r in out if r.quality == 1])
    assert np.mean([(x > high).mean() for x in low]) > 0.65


def plain_top(rows, k=10):
    whole = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v):
            x = tuple(int(np.floor(1024 * float(c))) for c in v)
            whole[i] = min(whole.get(i, x), x, key=lambda t: (len(t), np.array(t, "<f8").tobytes()))
    out = []
    for q, x in whole.items():
        if q % 100 == 0:
            s = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in whole.items() if i != q and len(y) == len(x))
            out += [(q, n + 1, i, -v) for n, (v, i) in enumerate(s[:k])]
    return sorted(out)


def test_search_edge_cases(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(700)]
    rows += [(i, rows[100][1]) for i in range(700, 760)]  # ties: copies of a query
    rows += [(1000, None), (1100, [None] * 6), (1200, [float("nan")] * 6), (1300, [float("inf")] * 6), (1400, []),
             (1500, [1.0, 2.0]), (1600, [3.0, -1.0]), (None, [0.0] * 6), (200, rows[200][1]), (1700, [0.0] * 6)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id bigint, embedding array<float>, rank int")
    as_read = [tuple(r) for r in df.select("vec_id", "embedding").collect()]
    got = sorted(tuple(r) for r in covertree.top_k(df.repartition(3)).collect())
    assert got == plain_top(as_read)
    assert covertree.top_k(df.limit(0)).count() == 0


def test_blocks_that_cannot_answer_are_not_shipped(spark, monkeypatch):
    """On clustered vectors few pairs of blocks are formed; the result is that of all."""
    monkeypatch.setattr(covertree, "BLOCK", 60)
    monkeypatch.setattr(covertree, "QUERY_BLOCK", 8)
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(24, 8))
    rows = [(i, (centres[i % 24] * 4 + rng.normal(size=8) * 0.05).astype(np.float32).tolist()) for i in range(2400)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(4)
    figures = {}
    found = sorted(tuple(r) for r in covertree.top_k(df, "vec_id % 20 = 0", figures=figures).collect())
    x = np.floor(np.array([r[1] for r in rows], np.float32).astype(np.float64) * 1024)
    plain = []
    for q in range(0, 2400, 20):
        s = x @ x[q]
        s[q] = -np.inf
        plain += [(q, n + 1, int(i), int(s[i])) for n, i in enumerate(np.lexsort((np.arange(2400), -s))[:10])]
    assert found == sorted(plain)
    assert figures["pairs"] < 0.5 * figures["all"], figures


def test_large_components_stay_exact():
    q = np.array([[2.0 ** 40, 1.0], [1.0, 1.0]])
    p = np.array([[2.0 ** 40, 3.0], [2.0 ** 40, 2.0], [5.0, 5.0]])
    got = covertree.block_topk(np.array([100, 200]), q, np.array([1, 2, 3]), p, 2)
    big = (1 << 63) - 1
    assert list(zip(*got)) == [(100, 1, big), (100, 2, big), (200, 1, 2 ** 40 + 3), (200, 2, 2 ** 40 + 2)]


def test_dual_tree_prunes_and_equals_brute_force():
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(40, 8)) * 5000
    x = np.round(centers[rng.integers(0, 40, 6000)] + rng.normal(size=(6000, 8)) * 30)
    q = x[::50]
    ids, own = np.arange(6000), np.arange(6000)[::50]
    data, queries = covertree.CoverTree(x, 64), covertree.CoverTree(q, 16)
    assert all(((x[p] - c) ** 2).sum(1).max() <= (r + 1e-6) ** 2
               for p, c, r in zip(data.points, data.center, data.radius))
    best = covertree.Best(len(q), 10)
    scored = covertree.search(queries, data, own, ids, best)
    leaves = [sum(not c for c in t.children) for t in (queries, data)]
    assert scored < 0.5 * leaves[0] * leaves[1]
    for r in range(len(q)):
        s = x @ q[r]
        s[own[r]] = -np.inf
        o = np.lexsort((ids, -s))[:10]
        assert best.id[r].tolist() == o.tolist() and best.score[r].tolist() == s[o].tolist()
