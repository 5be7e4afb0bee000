"""The source mix (op10) against its rules on small tables."""

from collections import defaultdict

import pytest

from lakeloom.llm import mixing
from lakeloom.tables import load
from tests.conftest import SF01
from tests.llm import cases


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Reshare the excess by weight until no target is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    names += [None] if None in sizes else []
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(most * sizes[s] for s in capped)
        by = sum(weight[s] for s in free)
        target = {s: most * sizes[s] if s in capped else left * weight[s] / by for s in names}
        over = {s for s in free if target[s] > most * sizes[s]}
        if not over:
            return target
        capped |= over


def check(rows, report):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(cases.words(r[1]))
    target = plain_targets(sizes)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in report:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source], rel=1e-9, abs=1e-9)
        assert r.taken == r.size * r.copies and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in taken:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1
    return taken, target


def test_edge_cases(spark):
    rows = cases.documents()
    report = mixing.mix_report(cases.frame(spark)).collect()
    assert sorted((str(r.doc_id), r.size) for r in report) == sorted((str(r[0]), len(cases.words(r[1]))) for r in rows)
    check(rows, report)
    twice = [r.taken for r in report if r.doc_id == 12]
    assert twice[0] == twice[1]
    assert mixing.mix_report(cases.frame(spark, [])).count() == 0
    assert mixing.mix(cases.frame(spark, [])).count() == 0


def test_only_empty_texts(spark):
    rows = [(i, t, None, s, 0, 0, "", 0) for i, (t, s) in enumerate([(None, "a"), ("", "b"), (" ", None)])]
    report = mixing.mix_report(cases.frame(spark, rows)).collect()
    assert [(r.taken, r.target) for r in report] == [(0, 0.0)] * 3


def test_table_is_near_its_targets_and_reruns_agree(spark):
    docs = load(spark, SF01, "documents")
    rows = [(r.doc_id, r.text, None, r.source) for r in docs.collect()]
    report = mixing.mix_report(docs).collect()
    taken, target = check(rows, report)
    assert sum(abs(taken[s] - target[s]) for s in taken) < 0.005 * sum(target.values())
    again = mixing.mix_report(docs.repartition(5)).collect()
    assert sorted((r.doc_id, r.taken) for r in report) == sorted((r.doc_id, r.taken) for r in again)


def test_inclusion_follows_the_target_share(spark):
    """Half a copy each: about half of the documents, other ones for another seed."""
    rows = [(i, "w " * (5 + i % 7), None, "abc"[i % 3], 0, 0, "", 0) for i in range(1200)]
    df = cases.frame(spark, rows)
    first = {r.doc_id for r in mixing.mix_report(df, weights=(1,), share=0.5).collect() if r.copies}
    other = {r.doc_id for r in mixing.mix_report(df, weights=(1,), share=0.5, seed=1).collect() if r.copies}
    assert 540 < len(first) < 660 and 220 < len(first & other) < 380


def test_weights_raise_inclusion(spark):
    rows = [(i, "one two three four", None, "a", 3 if i % 2 else 1, 0, "", 0) for i in range(2000)]
    sizes = mixing.sized(cases.frame(spark, rows), weight_col="n_chars")
    out = mixing.copies(sizes, mixing.plan(sizes, (1,), 0.25, 2)).collect()
    heavy = sum(r.copies for r in out if r.doc_id % 2)
    light = sum(r.copies for r in out if not r.doc_id % 2)
    assert heavy + light == 500 and 2.2 < heavy / light < 4.2


def plain_copies(rows, max_copies=2, weights=(5, 2, 1), share=1.5, fills=mixing.FILLS):
    """Copies of (source, size, u, w) rows by a plain sort of the ratios."""
    size_of = defaultdict(int)
    for source, size, _, _ in rows:
        size_of[source] += size
    target = plain_targets(size_of, weights, share, max_copies)
    out = [0] * len(rows)
    for source in size_of:
        own = [i for i, r in enumerate(rows) if r[0] == source]
        lo, hi = 0.0, 2.0 ** 80  # the level, by halving
        words = lambda level: sum(rows[i][1] * min(max_copies, level * rows[i][3]) for i in own)
        for _ in range(300):
            lo, hi = (lo, (lo + hi) / 2) if words((lo + hi) / 2) >= target[source] else ((lo + hi) / 2, hi)
        times = {i: min(max_copies, hi * rows[i][3]) for i in own}
        for i in own:
            out[i] = int(times[i] + 1e-9)
        rest = target[source] - sum(out[i] * rows[i][1] for i in own)
        q = {}
        for i in own:
            p, u = times[i] - out[i], rows[i][2]
            if out[i] < max_copies and rows[i][1] and rows[i][3] > 0:
                p = min(max(p, 1e-12), 1 - 1e-12)
                q[i] = (u / (1 - u)) / (p / (1 - p))
        got, left = 0, sorted(q, key=q.get)
        while left and got + rows[left[0]][1] <= rest:
            got += rows[left[0]][1]
            out[left.pop(0)] += 1
        for step in range(fills):
            able = [i for i in left if step == fills - 1 or rows[i][1] <= rest - got]
            best = min(able, key=lambda i: (abs(rows[i][1] - (rest - got)), q[i]), default=None)
            if best is None or abs(rows[best][1] - (rest - got)) >= rest - got:
                continue
            out[best] += 1
            got += rows[best][1]
            left.remove(best)
    return out


@pytest.mark.parametrize("weight_col", [None, "n_chars"])
def test_copies_equal_a_plain_sort_of_the_ratios(spark, weight_col):
    """Unequal weights, certain copies, copies at the cap, null and zero weights."""
    import random

    rng = random.Random(12)
    texts = [" ".join("w" for _ in range(int(rng.paretovariate(0.6)) % 3000)) for _ in range(500)]
    rows = [(i, t + f" {i}", None, rng.choice("aaaabc") if i % 9 else None, rng.choice([None, 0, -1, 1, 2, 5, 40, 10 ** 6]), 0, "", 0)
            for i, t in enumerate(texts)]
    sizes = mixing.sized(cases.frame(spark, rows), weight_col=weight_col).orderBy("doc_id").collect()
    report = mixing.mix_report(cases.frame(spark, rows), weight_col=weight_col).orderBy("doc_id").collect()
    plain = plain_copies([(r.source, r.size, r.u, r.w) for r in sizes])
    assert [r.copies for r in report] == plain
    assert {0, 1, 2} <= set(plain) and len({r.w for r in sizes}) > 4
    if weight_col:
        assert all(n == 0 for n, r in zip(plain, sizes) if r.w == 0)
        mixed = mixing.mix(cases.frame(spark, rows), weight_col=weight_col).groupBy("doc_id").count().collect()
        assert {r.doc_id: r["count"] for r in mixed} == {r.doc_id: n for r, n in zip(sizes, plain) if n}


def test_longer_documents_are_likelier(spark):
    """On the registered path the odds are unequal: about four times for 512 words and more."""
    rows = [(i, "w " * (600 if i % 2 else 20) + str(i), None, "a", 0, 0, "", 0) for i in range(2000)]
    report = mixing.mix_report(cases.frame(spark, rows), weights=(1,), share=0.15).collect()
    long, short = (sum(r.copies for r in report if r.doc_id % 2 == k) for k in (1, 0))
    assert 3.5 < long / short < 7.5


def test_mix_repeats_rows(spark):
    rows = cases.documents()
    out = mixing.mix(cases.frame(spark))
    assert out.columns == cases.frame(spark).columns
    report = mixing.mix_report(cases.frame(spark)).collect()
    assert out.count() == sum(r.copies for r in report if r.size)
    plain = {tuple(r) for r in rows}
    assert all(tuple(r) in plain for r in out.collect())
