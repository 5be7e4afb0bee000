"""SimHash near-duplicates (op1) against all pairs on small tables."""

import re

import numpy as np
import pytest
import xxhash

from lakeloom.llm import simhash
from lakeloom.tables import load
from tests.conftest import SF001
from tests.llm import cases


def plain_fingerprint(text):
    w = cases.words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_groups(fps):
    """Component of each distinct value, by its smallest member."""
    fps = sorted(set(fps))
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def expected(rows):
    fps = [(i, plain_fingerprint(t)) for i, t in rows]
    of = plain_groups([f for _, f in fps])
    low = {}
    for i, f in fps:
        low.setdefault(of[f], []).append(i)
    return sorted((str(i), f"{f:016x}", str(min((x for x in low[of[f]] if x is not None), default=None)))
                  for i, f in fps)


def got(df):
    return sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in df.collect())


def test_edge_cases(spark):
    rows = [(r[0], r[1]) for r in cases.documents()]
    assert got(simhash.near_duplicates(cases.frame(spark))) == expected(rows)
    assert simhash.near_duplicates(cases.frame(spark, [])).count() == 0


def test_table(spark):
    docs = load(spark, SF001, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert got(simhash.near_duplicates(docs)) == expected(rows)


@pytest.mark.parametrize("low,high", [(0, 0), (1 << 63, 5)])
def test_links_connect_what_three_bits_connect(spark, low, high):
    """Chains and dense balls: every link of up to three bits counts, wherever
    its bits lie (both halves, the halves' top bits)."""
    rng = np.random.default_rng(low % 97 + high)
    fps = set(rng.integers(0, 1 << 63, 60, dtype=np.uint64).tolist())
    for base in list(fps)[:12]:
        x = base
        for _ in range(8):  # a chain of steps of one to three bits
            for b in rng.choice(64, rng.integers(1, 4), replace=False).tolist():
                x ^= 1 << b
            fps.add(x)
        fps |= {base ^ (1 << 31), base ^ (1 << 63) ^ (1 << 31) ^ 1}
    fps |= {low, high, low ^ 7, low ^ 0x8000000080000001}
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp bigint")
    roots = simhash.components(simhash.links(df)).collect()
    unsigned = lambda v: v & (1 << 64) - 1
    mine = {f: unsigned(f) for f in fps}
    mine |= {unsigned(r.node): unsigned(r.root) for r in roots}
    parts = {}
    for f, r in mine.items():
        parts.setdefault(r, set()).add(f)
    plain = {}
    for f, r in plain_groups(fps).items():
        plain.setdefault(r, set()).add(f)
    assert sorted(map(sorted, parts.values())) == sorted(map(sorted, plain.values()))


def test_forest_is_linear():
    ball = np.array([1 << i | 1 << j for i in range(64) for j in range(i)], np.uint64)
    heads, tails = simhash.forest(ball, 3)
    assert len(heads) == len(ball) - 1


def test_keep_one(spark):
    rows = cases.documents()
    kept = simhash.keep_one(cases.frame(spark))
    assert kept.columns == cases.frame(spark).columns
    comp = {}
    for r in rows:
        comp.setdefault(plain_groups([plain_fingerprint(x[1]) for x in rows])[plain_fingerprint(r[1])], []).append(r)
    got_rows = [tuple(r) for r in kept.collect()]
    assert len(got_rows) == len(comp)
    for own in comp.values():
        best = min(own, key=lambda r: (r[0] is None, r[0] or 0))[0]
        assert sum(r in own and r[0] == best for r in got_rows) == 1
    assert simhash.keep_one(cases.frame(spark, [])).count() == 0


def test_rows_that_differ_in_their_nulls_stay_apart(spark, monkeypatch):
    """Equal but for which of two columns is null; and exact repeats, with and without a broadcast."""
    base = [(n, f"text number {n} of its own kind {n * n} {n * 7}", "x", None, n, 0, None, None) for n in range(12)]
    twins = [(n, t, None, "x", c, s, f, p) for n, t, _, _, c, s, f, p in base[:6]]
    rows = base + twins + base[6:] * 3 + [(None, None, None, None, None, None, None, None)] * 5
    for most in (simhash.MOST_ROWS, 0):
        monkeypatch.setattr(simhash, "MOST_ROWS", most)
        got = simhash.keep_one(cases.frame(spark, rows).repartition(3))
        assert sorted(r.doc_id for r in got.collect() if r.text) == list(range(12))
        assert got.where("text IS NULL").count() == 1
