"""Repeated passages (op4) against a plain set of windows."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from lakeloom.llm import substrings
from lakeloom.llm.common import HashedWords
from lakeloom.tables import load
from tests.conftest import SF001
from tests.llm import cases


def order(doc_id, text):
    """Null ids first, then ids; rows that share an id by their text's check."""
    return (doc_id is not None, doc_id or 0, zlib.crc32((text or "").encode()))


def expected(rows):
    marks = cases.removed_words([(order(i, t), t) for i, t in rows])
    out = []
    for (i, t), gone in zip(rows, marks):
        w = cases.words(t)
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((str(i), len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((str(r[0]), r[1], r[2], r[3]) for r in df.collect())


def test_edge_cases(spark):
    rows = [(r[0], r[1]) for r in cases.documents()]
    assert got(substrings.report(cases.frame(spark))) == expected(rows)
    assert substrings.report(cases.frame(spark, [])).count() == 0


def test_table(spark):
    docs = load(spark, SF001, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert got(substrings.report(docs)) == expected(rows)


@pytest.mark.parametrize("chunk,bucket", [(64, 128 << 20), (10 ** 6, 1 << 10)])
def test_overlaps_of_random_texts(spark, monkeypatch, chunk, bucket):
    """Few words, so windows repeat everywhere, within and across chunks;
    small buckets take the sorted path."""
    monkeypatch.setattr(substrings, "CHUNK_WORDS", chunk)
    monkeypatch.setattr(substrings, "BUCKET_BYTES", bucket)
    monkeypatch.setattr(substrings, "MOST_PARTITIONS", 4)
    rng = random.Random(chunk)
    base = [rng.choice("ab") + str(rng.randrange(3)) for _ in range(600)]
    rows = []
    for i in rng.sample(range(1000), 40):
        parts = [base[(a := rng.randrange(550)):a + rng.randrange(5, 60)] for _ in range(4)]
        rows.append((i, "  ".join(w for p in parts for w in p)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert got(substrings.report(df)) == expected(rows)


def test_spans_are_equal_texts(spark):
    docs = cases.frame(spark).where("doc_id IN (1, 2, 3, 12, 20)").dropDuplicates(["doc_id"])
    words = {r.doc_id: cases.words(r.text) for r in docs.select("doc_id", "text").collect()}
    found = substrings.spans(docs).collect()
    for s in found:
        n = s.stop - s.start
        assert n >= 20 and words[s.doc_id][s.start:s.stop] == words[s.source_id][s.source_start:s.source_start + n]
    assert any(s.doc_id == 2 and s.source_id == 1 and s.stop - s.start == 60 for s in found)
    assert any(s.doc_id == 12 and (s.source_id, s.source_start, s.start) == (12, 0, 20) for s in found)


def test_texts_keep_layout_and_columns(spark):
    rows = cases.documents()
    out = substrings.remove_repeats(cases.frame(spark))
    assert out.columns == cases.frame(spark).columns
    by_id = {r.doc_id: r for r in out.collect() if r.doc_id not in (None, 12, 13)}
    plain = {r[0]: r for r in rows}
    assert by_id[4].text is None and by_id[5].text == "" and by_id[6].text == plain[6][1]
    assert by_id[3].text == "" and by_id[2].text == cases.passage("c", 25)
    assert by_id[1].text == cases.passage("a", 40) + " " + cases.passage("b", 30)  # the null id's copy comes first
    assert by_id[10].text == plain[10][1] and by_id[1].size == 7 - 7 + plain[1][5]


def test_buckets_see_what_chunks_cannot():
    """The same windows in two chunks meet in one bucket."""
    words = [w.encode() for w in cases.words(cases.passage("z", 50))]
    key = lambda k: (np.array([k]), np.array([5]))
    blobs = []
    for k in (8, 3):
        data, local = substrings.chunk_edges([words], *key(k), HashedWords(11), 1)
        assert not len(local[0])
        blobs += [b for _, b in data]
    keys, _, start, stop, source, _, at = substrings.bucket_pieces(blobs)
    assert set(keys.tolist()) == {8} and set(source.tolist()) == {3}
    assert start.min() == 0 and stop.max() == 50 and (start == at).all()


def test_windows_travel_with_their_whole_hash():
    words = [w.encode() for w in cases.words(cases.passage("y", 60))]
    data, _ = substrings.chunk_edges([words], np.array([1]), np.array([2]), HashedWords(11), 1)
    h = np.array([HashedWords(11)[w] for w in words], np.uint64)
    assert substrings._unpack([b for _, b in data])[7].tolist() == substrings._windows(h)[1].tolist()


def lines_around(n):
    """A line of 8 words (the minimizer of its windows) between differing ones,
    in every text; some texts come again."""
    hashes = HashedWords(11)
    first = lambda t: substrings._windows(np.array([hashes[w.encode()] for w in t * 3], np.uint64))[0][0]
    hot = min(([f"h{k}z{j}" for j in range(8)] for k in range(2_000)), key=first)
    texts = [[f"{a}{i}x{k}" for k in range(14)] + hot + [f"{a}{i}y{k}" for k in range(14)] for i in range(n) for a in "ab"]
    return texts + texts[:5]


def test_windows_around_a_frequent_line_are_dealt_to_many_buckets():
    texts = [[w.encode() for w in t] for t in lines_around(150)]
    ids, crcs = np.arange(len(texts)), np.arange(len(texts))
    g, n = substrings.chunk_heavy(texts, HashedWords(11), 1)
    heavy = g[n >= 100]
    assert len(heavy) >= 1
    data, _ = substrings.chunk_edges(texts, ids, crcs, HashedWords(11), 16, heavy)
    runs = [int(np.isin(substrings._unpack([b])[3], heavy).sum()) for _, b in data]
    assert len(runs) == 16 and min(runs) > 0 and max(runs) < 2 * sum(runs) / 16


def test_heavy_minimizers_lose_no_repeat(spark, monkeypatch):
    monkeypatch.setattr(substrings, "HEAVY_RUNS", 20)
    monkeypatch.setattr(substrings, "SAMPLE", 4)
    monkeypatch.setattr(substrings, "CHUNK_WORDS", 2_000)
    rows = [(i, " ".join(t)) for i, t in enumerate(lines_around(100))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert len(substrings.heavy_minimizers(df))
    assert got(substrings.report(df)) == expected(rows)
    docs = cases.frame(spark)
    monkeypatch.setattr(substrings, "HEAVY_RUNS", 2)
    monkeypatch.setattr(substrings, "SAMPLE", 1)
    assert got(substrings.report(docs)) == expected([(r[0], r[1]) for r in cases.documents()])


def test_a_sample_finds_what_is_spread_thinly():
    """A line that each chunk holds once or twice is heavy over many chunks."""
    texts = [[w.encode() for w in t] for t in lines_around(400)]
    count = {}
    for k in range(0, len(texts), 2):
        for g, n in zip(*substrings.chunk_heavy(texts[k:k + 2], HashedWords(11), 4)):
            count[int(g)] = count.get(int(g), 0) + int(n)
    assert sorted(count.values())[-1] > 400 and sum(n > 200 for n in count.values()) <= 3


def test_words_go_only_if_their_source_holds_the_same():
    """A piece that only hashes vouch for keeps its words."""
    words = [b"w%d" % i for i in range(40)]
    true = {"start": 0, "stop": 25, "there": substrings.digest(words[:25])}
    false = {"start": 10, "stop": 40, "there": substrings.digest(words[5:35])}
    beyond = {"start": 30, "stop": 60, "there": substrings.digest(words[30:60])}
    assert substrings._removed(words, [true, false, beyond]).tolist() == [True] * 25 + [False] * 15
    assert not substrings._removed(words, None).any()


def test_pieces_of_a_source_travel_in_bounded_rows(monkeypatch):
    monkeypatch.setattr(substrings, "TOGETHER", 3)
    cols = tuple(np.array(c) for c in zip(*[(k, k + 1, k + 2, k + 30, k % 2, 7, k + 3) for k in range(10)]))
    rows = list(substrings.by_source(cols))
    assert [r[:2] for r in rows] == [(0, 7)] * 2 + [(1, 7)] * 2
    back = sorted(t for _, _, d in rows for t in zip(*(c.tolist() for c in substrings._of_source(d))))
    assert back == [(k, k + 1, k + 2, k + 30, k + 3) for k in range(10)]
