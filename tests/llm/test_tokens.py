"""Token files (op2) and packing (op7) against the tokenizers library itself."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lakeloom.llm import packing, repair, tokens
from lakeloom.llm.tokens import Encoder
from lakeloom.session import scratch_path
from tests.llm import cases

FILE = "word_bpe_49k.json"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(str(public_tokenizers.path(FILE)))


@pytest.mark.parametrize("name", [FILE, "byte_bpe_50k.json"])
def test_encoder_equals_the_library(name):
    path = str(public_tokenizers.path(name))
    own, ref = Encoder(path, words=4, parts=3), Tokenizer.from_file(path)
    texts = ["", "   ", "don't we'll 'S 'T'RE ''", "İstanbul ΣΑΣ ÀÉß ŉ ſ µm ª",
             "É éa ̀x", "1234 x² ½ 3.14", "a_b __ $$$ ###x!!", "中文字 \U0001f600a",
             "<|endoftext|>x a<|startoftext|> <|", "\x1cq\x1d \x00 \x85y z"]
    texts += [t for _, t, *_ in cases.documents() if t]
    for t in texts:
        assert own.ids(t.encode()).tolist() == ref.encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("chunk, parts", [(8_000_000, 150_000), (200, 3), (5, 1)])
def test_many_texts_equal_the_library(library, monkeypatch, chunk, parts):
    monkeypatch.setattr(tokens, "CHUNK", chunk)
    rng = random.Random(5)
    plain = [*"abcsStTmdDrReEvVlL''''..,<|>  \n\t\x0b09²½ªºßÄéſŉı—“€…°", "'ll", "'re", "'s", "'ve", "x'd"]
    odd = [*plain, "<|endoftext|>", "中", "\u0301", "İ"]
    texts = ["".join(rng.choices(odd if i % 5 else plain, k=rng.randrange(60))) for i in range(800)]
    texts += [None, "", "'", "a'", " ".join(texts[::5]), "x" * 300, *(t for _, t, *_ in cases.documents())]
    own = Encoder(str(public_tokenizers.path(FILE)), parts=parts)
    for _ in range(2):  # the second time with parts that are known
        got = [x.tolist() for x in own.many(texts)]
        assert got == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert len(own.known) <= 2 * parts


def test_a_part_of_many_texts_is_asked_for_once(monkeypatch):
    own, asked = Encoder(str(public_tokenizers.path(FILE))), []
    new = own._new_parts
    monkeypatch.setattr(own, "_new_parts", lambda parts: asked.extend(parts.to_pylist()) or new(parts))
    for _ in range(2):
        assert [len(x) for x in own.many(["The cat's hat, the CAT"] * 500)] == [7] * 500
    assert sorted(asked) == ["'s", ",", "cat", "hat", "the"]
    assert not own.parts  # no text was taken part by part


def test_grammars_of_more_than_65536_symbols():
    rng = np.random.default_rng(6)
    x = rng.permutation(70_000).astype(np.uint32)
    docs = [x, x[:40_000], x[30_000:]] * 3
    g = repair.compress(docs, least=3)
    assert len(g["symbols"]) < 100
    flat, at = repair.expansions(g["terminals"], g["left"], g["right"], g["lengths"])
    assert [i for s in g["symbols"].tolist() for i in flat[at[s]:at[s + 1]].tolist()] == np.concatenate(docs).tolist()
    for i in range(len(g["left"])):
        s, a, b = len(g["terminals"]) + i, g["left"][i], g["right"][i]
        assert flat[at[s]:at[s + 1]].tolist() == [*flat[at[a]:at[a + 1]], *flat[at[b]:at[b + 1]]]


def test_grammar_round_trip_and_slices():
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 5, n).astype("<u2") for n in (0, 1, 2, 500, 3000, 0, 7)] + [np.full(4001, 9, "<u2")]
    g = repair.compress(docs, least=2)
    assert len(g["symbols"]) < sum(map(len, docs)) / 2
    row = {k: g[k].astype("<u4").tobytes() for k in ("terminals", "left", "right", "lengths", "symbols")}
    shard = repair.Shard(row | {"width": 4, "end_id": 1, "n_docs": len(docs),
                                "doc_symbols": g["doc_symbols"].astype("<i8").tobytes()})
    every, sizes = shard.documents()
    assert every.tolist() == [x for d in docs for x in d.tolist() + [1]] and sizes.tolist() == [len(d) + 1 for d in docs]
    for i, d in enumerate(docs):
        whole = d.tolist() + [1]
        assert shard.document(i).tolist() == whole
        for _ in range(40):
            a, b = sorted(rng.integers(0, len(whole) + 1, 2).tolist())
            assert shard.slice(i, a, b).tolist() == whole[a:b]


def _starts(rows, library, end):
    out, at = [], 0
    for doc_id, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [end], "<u4")
        out.append((doc_id, at, len(ids), zlib.crc32(ids)))
        at += len(ids)
    return out


@pytest.mark.parametrize("shard_ids", [50, 10 ** 6])
def test_token_files(spark, library, shard_ids):
    path = scratch_path(spark, "test-repair")
    repair.write(cases.frame(spark), path, shard_ids=shard_ids)
    got = repair.read(spark, path).collect()
    expected = _starts(cases.documents(), library, 1)
    # Rows that share an id may stand in either order.
    assert sorted((str(r[0]), r[2], r[3]) for r in got) == sorted((str(e[0]), e[2], e[3]) for e in expected)
    assert {r[0]: r[1] for r in got if r[0] not in (None, 12, 13)} == {
        e[0]: e[1] for e in expected if e[0] not in (None, 12, 13)}
    starts = sorted((r[1], r[2]) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))


def test_rounds_go_on_until_no_pair_is_frequent():
    rng = np.random.default_rng(2)
    passage = rng.permutation(2000).astype(np.uint32)
    g = repair.compress([passage] * 400)
    assert len(g["symbols"]) == 400 and g["lengths"].max() == 2000
    words = rng.zipf(1.3, 200_000) % 5000
    docs = np.split(words.astype(np.uint32), np.sort(rng.integers(0, len(words), 300))) + [passage[:700]] * 40
    g = repair.compress(docs)
    pairs = {}
    stop = np.cumsum(g["doc_symbols"])
    flat, at = repair.expansions(g["terminals"], g["left"], g["right"], g["lengths"])
    for d, a, b in zip(docs, stop - g["doc_symbols"], stop):
        own = g["symbols"][a:b].tolist()
        assert [x for s in own for x in flat[at[s]:at[s + 1]].tolist()] == d.tolist()
        taken = -1  # of a run of one symbol every other pair counts
        for i, pair in enumerate(zip(own, own[1:])):
            if pair[0] != pair[1] or i != taken:
                pairs[pair] = pairs.get(pair, 0) + 1
                taken = i + 1
    assert max(pairs.values()) < 2 * repair.LEAST
    assert sum(n >= repair.LEAST for (a, b), n in pairs.items() if a != b) == 0


def test_keys_that_share_slots_are_found(monkeypatch):
    monkeypatch.setattr(repair, "_SLOT_BITS", 3)
    rng = np.random.default_rng(4)
    keys = np.unique(rng.integers(0, 1 << 40, 60, dtype=np.uint64))
    codes = np.concatenate((rng.choice(keys, 500), rng.integers(0, 1 << 40, 500, dtype=np.uint64)))
    place = {int(k): i for i, k in enumerate(keys)}
    assert repair._places(codes, keys).tolist() == [place.get(int(c), -1) for c in codes]


def test_symbols_of_three_bytes():
    x = np.array([0, 65535, 65536, (1 << 24) - 1], np.uint32)
    assert repair.unpack_symbols(repair.pack_symbols(x, 3), 3).tolist() == x.tolist()


def test_token_files_of_an_empty_table(spark):
    path = scratch_path(spark, "test-repair")
    repair.write(cases.frame(spark, []), path)
    assert repair.read(spark, path).count() == 0


def test_differencing_beats_its_parts():
    sizes = np.array([8, 7, 6, 5, 4])
    loads = np.bincount(packing.difference(sizes, 2), weights=sizes)
    assert sorted(loads) == [14, 16]  # the classic example
    window = packing.balance(np.array([60, 60, 60]), 100)  # two windows would need 120
    assert sorted(np.bincount(window)) == [1, 1, 1]


@pytest.mark.parametrize("windows", [2, 192])
def test_packing(spark, library, windows):
    rows = packing.pack(cases.frame(spark), windows=windows).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for pieces in by_sequence.values():
        pieces.sort()
        assert pieces[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(pieces, pieces[1:]))
        assert sum(n for _, n in pieces) <= 4096
    texts = defaultdict(list)
    for doc_id, text, *_ in cases.documents():
        texts[doc_id].append(np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4"))
    assert set(texts) == set(by_doc)
    for doc_id, docs in texts.items():
        own = by_doc[doc_id]
        assert sum(r.length for r in own) == sum(map(len, docs))
        if len(docs) == 1:
            own.sort(key=lambda r: r.start)
            assert own[0].start == 0 and all(a.start + a.length == b.start for a, b in zip(own, own[1:]))
            for r in own:
                assert r.doc_tokens == len(docs[0])
                assert r.ids_crc32 == zlib.crc32(docs[0][r.start:r.start + r.length])
    assert packing.pack(cases.frame(spark, [])).count() == 0


def test_packing_leaves_little_padding(spark):
    from lakeloom.tables import load

    rows = packing.pack(load(spark, "/root/testdata/sf0.01", "documents")).groupBy("sequence_id").sum("length").collect()
    loads = [r[1] for r in rows]
    assert max(loads) <= 4096 and sum(loads) >= 0.985 * 4096 * len(loads)


def test_a_million_empty_texts_need_little_memory():
    import tracemalloc

    def run():
        packer = packing._Packer(0, packing.CAPACITY, packing.PIECE, packing.WINDOWS)
        end, n, sequences, held = np.array([2], "<u2"), 0, set(), 0
        for k in range(1_000_000):
            packer.add(k, end)
            if len(packer.rows) >= packing.MOST_PIECES:
                out = packer.take()
                n += out.num_rows
                sequences.update(out["sequence_id"].unique().to_pylist())
        packer.flush()
        out = packer.take()
        sequences.update(out["sequence_id"].unique().to_pylist())
        return n + out.num_rows, len(sequences)

    tracemalloc.start()
    rows, sequences = run()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 1_000_000 and peak < 200 << 20
    assert sequences <= 1.08 * 1_000_000 / packing.CAPACITY


def test_encoder_rests_between_tasks():
    path = str(public_tokenizers.path(FILE))
    own, ref = Encoder(path), Tokenizer.from_file(path)
    text = "The words that were met, and the words' parts."
    want = ref.encode(text, add_special_tokens=False).ids
    for _ in range(3):
        assert own.ids(text.encode()).tolist() == want
        own.rest()
        assert not own.words and not own.words.old and not own.parts.old and own.parts
