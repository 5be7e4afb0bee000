"""Collocations (op13) against plain counting of every n-gram."""

import random
import re
from collections import Counter

import numpy as np

from lakeloom.llm import phrases
from lakeloom.tables import load
from tests.conftest import SF001
from tests.llm import cases


def plain_counts(rows):
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        total[lang] += 0
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for m in (1, 2, 3):
                for s in range(len(w) - m + 1):
                    f[lang, tuple(w[s:s + m])] += 1
    return f, total


def plain_collocations(rows, least=10, covered=50, top=2000):
    f, total = plain_counts(rows)
    found = {k: n for k, n in f.items() if n >= least and len(k[1]) > 1}
    around = Counter()
    for (lang, w), n in found.items():
        if len(w) == 3:
            for part in (w[:2], w[1:]):
                around[lang, part] = max(around[lang, part], n)
    out = []
    for lang in total:
        rank = []
        for (own, w), a in found.items():
            if own == lang and not (around[lang, w] and 100 * around[lang, w] >= covered * a):
                score, _, left, right = min((10 ** 6 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]])
                                            for k in range(1, len(w)))
                rank.append((-score, -a, " ".join(w).encode(), left, right))
        for n, (score, a, phrase, left, right) in enumerate(sorted(rank)[:top]):
            out.append((lang, n + 1, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def test_given_table(spark):
    docs = load(spark, SF001, "documents")
    rows = [tuple(r) for r in docs.select("lang", "text").collect()]
    got = sorted(map(tuple, phrases.collocations(docs).collect()))
    assert got == plain_collocations(rows) and got
    some = sorted(map(tuple, phrases.collocations(docs, 4, 80, 30).collect()))
    assert some == plain_collocations(rows, 4, 80, 30)


def _rows():
    rng = random.Random(6)
    words = ["Of", "the", "a", "été", "中文", "\x00x", "w w", "in\x85"] + [f"v{i}" for i in range(12)]
    made = ["".join(rng.choice(words) + rng.choice([" ", " ", "\t", "  ", ". ", "\n", "!?", "\r\n", "\v"]) for _ in range(rng.randrange(200)))
            for _ in range(60)]
    own = cases.documents()
    return own + [(n, t, [None, "en", "und", "x y"][n % 4], None, n, n, None, None) for n, t in enumerate(made * 2)]


def test_awkward_rows(spark, monkeypatch):
    rows = _rows()
    df = cases.frame(spark, rows)
    plain = plain_collocations([(r[2], r[1]) for r in rows], 5)
    assert sorted(map(tuple, phrases.collocations(df, 5).collect())) == plain and plain
    assert phrases.collocations(cases.frame(spark, [])).count() == 0
    assert phrases.collocations(df.where("text IS NULL")).count() == 0
    # Many ranges a partition, as over a large input.
    monkeypatch.setattr(phrases.keyed, "MOST_PARTITIONS", 1)
    monkeypatch.setattr(phrases, "partitions", lambda spark: 1)
    monkeypatch.setattr(phrases, "_input_bytes", lambda docs: 60 << 20)
    every = phrases.frequent(df, 5, range_bytes=1 << 20).where("size > 0").collect()
    f, _ = plain_counts([(r[2], r[1]) for r in rows])
    assert sorted(((r.lang, r.phrase, r.n) for r in every)) == sorted(
        (lang, " ".join(w), n) for (lang, w), n in f.items() if n >= 5)


def test_colliding_fingerprints_part(spark, monkeypatch):
    """With fingerprints of four bits nearly everything collides; the text decides."""
    monkeypatch.setattr(phrases, "BITS", 4)
    rows = [("en", "a b c. a b d. x y z. y z a."), ("fr", "a b c, a b"), ("en", "q r s")] * 3
    wanted = np.arange(16, dtype=np.uint64)
    chunk = phrases.Chunk([(lang, t.encode()) for lang, t in rows])
    found = Counter()
    for size, lang, text, counts in chunk.phrases(wanted):
        for k, w, n in zip(lang.tolist(), text.to_pylist(), counts.tolist()):
            assert len(w.split()) == size
            found[chunk.languages[k], w.decode()] += n
    f, _ = plain_counts(rows)
    assert found == {(lang, " ".join(w)): n for (lang, w), n in f.items()}


def test_prefix_polynomials_are_the_fingerprints():
    text = b"one two three one two three, four one two"
    chunk = phrases.Chunk([("en", text), ("de", text)])
    at, x = chunk.grams(2)
    names = [(chunk.lang[a], *(chunk.words[i] for i in chunk.ids[a:a + 2])) for a in at.tolist()]
    assert len(names) == 14 and len(set(x.tolist())) == len(set(names)) == 8
    by_name = {}
    for name, value in zip(names, x.tolist()):
        assert by_name.setdefault(name, value) == value


def test_pressed_keys_come_back():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 5000):
        keys = np.unique(rng.integers(0, 1 << 48, n, dtype=np.uint64))
        counts = rng.integers(1, 600, len(keys))
        got = phrases.unpress(phrases.press(keys, counts))
        assert (got[0] == keys).all() and (got[1] == counts).all()


def test_answers_point_into_a_chunks_order():
    rng = np.random.default_rng(3)
    chunks = [np.unique(rng.integers(0, 1 << 48, 400, dtype=np.uint64)) for _ in range(3)]
    chunks = [np.unique(np.concatenate((c, chunks[0][:50]))) for c in chunks]
    answers = {0: [], 1: [], 2: []}
    for r in range(7):
        own = [(n, phrases.press(k, np.full(len(k), 2))) for n, c in enumerate(chunks) if len(k := c[phrases.ranges(c, 7) == r])]
        for chunk, bits in phrases.add_up(own, 6):
            answers[chunk].append((r, bits))
    shared = np.intersect1d(np.intersect1d(chunks[0], chunks[1]), chunks[2])
    for n, c in enumerate(chunks):
        assert (phrases.marked(c, 7, answers[n]) == shared).all()
    assert len(phrases.marked(chunks[0], 7, [])) == 0


def test_long_texts_are_cut_at_separators():
    text = b"aa bb. " * 1000 + b"c " * 5000
    parts = list(phrases.stretches(text, 100))
    assert b"".join(parts) == text and all(p.endswith(b".") for p in parts[:-1]) and len(parts) > 60


def test_scores_are_exact_past_64_bits(spark):
    rng = random.Random(9)
    rows = []
    for _ in range(300):
        a = rng.randrange(1, 10 ** rng.randrange(1, 16))
        rows.append((a, a + rng.randrange(10 ** 15), a + rng.randrange(10 ** rng.randrange(1, 16))))
    df = spark.createDataFrame(rows, "a bigint, l bigint, r bigint").selectExpr("a", "l", "r", phrases.exact_score("a", "l", "r") + " AS s")
    for r in df.collect():
        assert r.s == 10 ** 6 * r.a * r.a // (r.l * r.r)
