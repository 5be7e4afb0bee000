"""Repeated passages by compaction of a de Bruijn graph of words.

Every 20-word window is an edge of the graph (from its first 19 words to its
last 19). An edge that occurs again is a repeat, and runs of repeated edges
that follow one source text without branching are compact paths: spans
(document, start, length) with the coordinates of their earlier source.

The graph is built the way large assemblers do it. Each window belongs to its
minimizer, the 8-word piece of smallest hash inside it; successive windows
mostly share one, so they travel together as a run: one key, its coordinates
and the window's 64-bit hash. Equal windows have equal minimizers at equal
places, so a bucket of minimizers sees every occurrence of its edges, marks
all but the first in (document, start) order, and compacts neighbours whose
sources advance in step. The paths' pieces are joined to their documents,
where pieces that touch make up the whole span.

In the buckets a window is identified by the 64-bit hash of its minimizer, its
place beside it and its own 64-bit hash. Pieces keep their source coordinates; a
piece holds only as long as both sides advance word by word. Before anything is
removed each piece visits its source document, which adds a 128-bit digest of
the words that stand there, and then its own document, which removes the words
only if theirs give the same digest.

Scale: windows that repeat within a chunk of a scan partition are settled
there, and only the first travels, so a passage that a third of all documents
share sends one row per chunk. Buckets grow in number with the input's size.
A first pass counts a sample of all runs by minimizer: windows of one with ``HEAVY_RUNS`` or
more (a frequent line of 8 to 19 words between differing ones) travel one by
one and are dealt by minimizer, place and hash, which keeps equal windows
together and spreads the others over all buckets.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lakeloom.llm.common import HashedWords, columns, lean, partitions, ship, text_bytes

WINDOW, PIECE = 20, 8
CHUNK_WORDS = 300_000
BUCKET_BYTES = 128 << 20
#: Runs from which on a minimizer's windows travel alone, estimated from one run in ``SAMPLE``.
HEAVY_RUNS, SAMPLE = 50_000, 16
MOST_PARTITIONS = 20_000
_B = 0x9E3779B97F4A7C15
_POW = {k: np.uint64(pow(_B, k, 1 << 64)) for k in (1, 2, 4, 8)}
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
NO_ID = -(1 << 63)  # stands for a null id: before all others

#: Pieces of one source travel together, so many in a row at most.
TOGETHER = 10_000
PIECES = "key bigint, crc bigint, start int, stop int, source_key bigint, source_crc bigint, source_start int"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _windows(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all 8-word pieces and of all 20-word windows."""
    h2 = h[:-1] * _POW[1] + h[1:]
    h4 = h2[:-2] * _POW[2] + h2[2:]
    h8 = h4[:-4] * _POW[4] + h4[4:]
    h16 = h8[:-8] * _POW[8] + h8[8:]
    return _mix(h8), _mix(h16[:-4] * _POW[4] + h4[16:])


def _piece_rows(doc, s, src_doc, src_s, keys, crcs) -> tuple[np.ndarray, ...]:
    """Compact marked windows, given in (document, start) order: neighbours
    whose sources advance in step are one path."""
    if not len(s):
        return tuple(np.zeros(0, np.int64) for _ in range(7))
    new = np.ones(len(s), bool)
    new[1:] = ((doc[1:] != doc[:-1]) | (s[1:] != s[:-1] + 1) | (src_doc[1:] != src_doc[:-1])
               | (src_s[1:] != src_s[:-1] + 1))
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(s)) - 1
    return (keys[doc[at]], crcs[doc[at]], s[at], s[last] + WINDOW, keys[src_doc[at]], crcs[src_doc[at]], src_s[at])


def _first_of(kk: np.ndarray, g: np.ndarray, tag: np.ndarray, co: np.ndarray):
    """Order by window and coordinate; for each place in it, where its
    window's first occurrence stands."""
    order = np.lexsort((co, kk))
    k, a, b = kk[order], g[order], tag[order]
    new = np.ones(len(order), bool)
    new[1:] = (k[1:] != k[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order, order[np.flatnonzero(new)[np.cumsum(new) - 1]]


def _rank(keys: np.ndarray, crcs: np.ndarray) -> np.ndarray:
    """Dense order of documents by (id, text check); repeated rows share a rank."""
    order = np.lexsort((crcs, keys))
    k, c = keys[order], crcs[order]
    new = np.concatenate(([0], ((k[1:] != k[:-1]) | (c[1:] != c[:-1])).astype(np.int64)))
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.cumsum(new)
    return rank


_HEAD = struct.Struct("<III")


def _minimizers(words: list[list[bytes]], hashes: HashedWords):
    """Hashes of pieces and windows, the document of each word and the places
    of windows and of their minimizers; none if no text has a window."""
    size = np.array([len(w) for w in words], np.int64)
    n = int(size.sum())
    if n < WINDOW:
        return None
    h = np.fromiter(map(hashes.__getitem__, chain.from_iterable(words)), np.uint64, n)
    piece, win = _windows(h)
    doc = np.repeat(np.arange(len(size)), size)
    s = np.flatnonzero(doc[:n - WINDOW + 1] == doc[WINDOW - 1:])
    if not len(s):
        return None
    spots = WINDOW - PIECE + 1
    p = np.argmin(np.lib.stride_tricks.sliding_window_view(piece, spots), axis=1)[s] + s
    return piece, win, doc, np.cumsum(size) - size, s, p


def chunk_heavy(words: list[list[bytes]], hashes: HashedWords, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """Minimizers of one in ``sample`` runs of a chunk, drawn by window and
    place, and an estimate of their runs."""
    found = _minimizers(words, hashes)
    if found is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    piece, win, _, _, s, p = found
    runs = np.flatnonzero(np.diff(p, prepend=-1) != 0)
    draw = _mix(win[s[runs]] + runs.astype(np.uint64) * np.uint64(_B))
    g, n = np.unique(piece[p[runs[draw % np.uint64(sample) == 0]]], return_counts=True)
    return g, n * sample


def chunk_edges(words: list[list[bytes]], keys: np.ndarray, crcs: np.ndarray, hashes: HashedWords, buckets: int,
                heavy: np.ndarray | None = None):
    """Runs of windows of some documents by bucket, as bytes, and the pieces
    already known to repeat within these documents. Windows of ``heavy``
    minimizers are runs of their own."""
    none = _piece_rows(*(np.zeros(0, np.int64),) * 4, keys, crcs)
    found = _minimizers(words, hashes)
    if found is None:
        return [], none
    piece, win, doc, begin, s, p = found
    new = np.ones(len(s), bool)
    new[1:] = p[1:] != p[:-1]  # a place is in one document only
    alone = np.isin(piece[p], heavy) if heavy is not None and len(heavy) else np.zeros(len(s), bool)
    new |= alone
    run = np.cumsum(new) - 1
    at = np.flatnonzero(new)
    g = piece[p[at]]

    # Within the chunk: of windows that repeat only the first one travels.
    rank = _rank(keys, crcs)
    _, inverse, count = np.unique(g, return_inverse=True, return_counts=True)
    twice = np.flatnonzero((count[inverse] > 1)[run])
    send = np.ones(len(s), bool)
    local = none
    if len(twice):
        ts, tg = s[twice], g[run[twice]]
        tag = win[ts]
        kk = _mix(tg + (p[twice] - ts).astype(np.uint64) * np.uint64(_B)) ^ tag
        co = (rank[doc[ts]] << 32) + ts - begin[doc[ts]]
        order, first = _first_of(kk, tg, tag, co)
        send[twice[order[order != first]]] = False
        hit = co[order] > co[first]
        mine, theirs = ts[order[hit]], ts[first[hit]]
        by = np.argsort(mine)
        mine, theirs = mine[by], theirs[by]
        local = _piece_rows(doc[mine], mine - begin[doc[mine]], doc[theirs], theirs - begin[doc[theirs]], keys, crcs)

    bits = np.add.reduceat(send.astype(np.int64) << (s - s[at][run]), at)
    go = np.flatnonzero(bits)
    # Minimizers are small hashes: mixed once more, they spread evenly over the buckets.
    place = (p[at] - s[at]).astype(np.uint64) * np.uint64(_B)
    dealt = np.where(alone[at], _mix(g + place) ^ win[s[at]], g)
    bucket = ((_mix(dealt + np.uint64(_B)) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    run_doc = doc[s[at]]
    out = []
    order = go[np.argsort(bucket[go], kind="stable")]
    sent = np.flatnonzero(send)
    n_sent = np.bincount(run[sent], minlength=len(at))
    sent_at = np.cumsum(n_sent) - n_sent
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    for a, b in zip(edges.tolist(), np.append(edges[1:], len(order)).tolist()):
        r = order[a:b]
        d, first, per = np.unique(run_doc[r], return_index=True, return_counts=True)
        total = int(n_sent[r].sum())
        which = np.repeat(sent_at[r] - (np.cumsum(n_sent[r]) - n_sent[r]), n_sent[r]) + np.arange(total)
        tags = win[s[sent[which]]]
        blob = b"".join((
            _HEAD.pack(len(d), len(r), total), np.diff(keys[d], prepend=0).astype("<i8").tobytes(),
            crcs[d].astype("<u4").tobytes(), per.astype("<u4").tobytes(), g[r].astype("<u8").tobytes(),
            (p[at[r]] - begin[run_doc[r]]).astype("<i4").tobytes(), (p[at[r]] - s[at[r]]).astype("u1").tobytes(),
            bits[r].astype("<u2").tobytes(), tags.astype("<u8").tobytes()))
        out.append((int(bucket[r[0]]), blob))
    return out, local


def _unpack(blobs: list[bytes]):
    """Per-run and per-window arrays of a bucket."""
    cols: list[list[np.ndarray]] = [[] for _ in range(8)]
    docs = 0
    for blob in blobs:
        nd, nr, nt = _HEAD.unpack_from(blob)
        at = _HEAD.size
        got = []
        for kind, n in (("<i8", nd), ("<u4", nd), ("<u4", nd), ("<u8", nr), ("<i4", nr), ("u1", nr), ("<u2", nr),
                        ("<u8", nt)):
            got.append(np.frombuffer(blob, kind, n, at))
            at += got[-1].nbytes
        key, crc, per, g, p, off, bits, tags = got
        for c, x in zip(cols, (np.cumsum(key), crc.astype(np.int64), np.repeat(np.arange(nd) + docs, per), g,
                               p.astype(np.int64), off.astype(np.int64), bits, tags)):
            c.append(x)
        docs += nd
    return [np.concatenate(c) for c in cols]


def bucket_pieces(blobs: list[bytes]) -> tuple[np.ndarray, ...]:
    """Pieces of repeated paths among all runs of a bucket."""
    keys, crcs, doc, g, p, off, bits, tags = _unpack(blobs)
    n = np.bitwise_count(bits).astype(np.int64)
    _, inverse, count = np.unique(g, return_inverse=True, return_counts=True)
    runs = np.flatnonzero(count[inverse] > 1)
    tag_at = np.cumsum(n) - n
    k = n[runs]
    tag = tags[np.repeat(tag_at[runs] - (np.cumsum(k) - k), k) + np.arange(int(k.sum()))]
    run, place = np.nonzero((bits[runs][:, None] >> np.arange(WINDOW - PIECE + 1, dtype=np.uint16)) & 1)
    run = runs[run]
    offset = off[run] - place
    s = p[run] - offset
    co = (_rank(keys, crcs)[doc[run]] << 32) + s
    kk = _mix(g[run] + offset.astype(np.uint64) * np.uint64(_B)) ^ tag
    order, first = _first_of(kk, g[run], tag, co)
    hit = co[order] > co[first]
    mine, theirs = order[hit], first[hit]
    by = np.lexsort((s[mine], doc[run[mine]]))
    mine, theirs = mine[by], theirs[by]
    return _piece_rows(doc[run[mine]], s[mine], doc[run[theirs]], s[theirs], keys, crcs)


def _rows(cols: tuple[np.ndarray, ...]) -> pa.RecordBatch:
    names = ["key", "crc", "start", "stop", "source_key", "source_crc", "source_start"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c).cast(k) for c, k in zip(cols, kinds)], names=names)


_BLOB = (("key", "<i8"), ("crc", "<u4"), ("start", "<i4"), ("stop", "<i4"), ("source_start", "<i4"))


def by_source(cols: tuple[np.ndarray, ...]) -> Iterator[tuple[int, int, bytes]]:
    """Source key, check of the source's text, and its pieces as bytes."""
    key, crc, start, stop, source_key, source_crc, source_start = cols
    order = np.lexsort((source_crc, source_key))
    k, c = source_key[order], source_crc[order]
    new = np.flatnonzero(np.concatenate((k[:1] == k[:1], (k[1:] != k[:-1]) | (c[1:] != c[:-1]))))
    for a, b in zip(new.tolist(), np.append(new[1:], len(order)).tolist()):
        for i in range(a, b, TOGETHER):
            at = order[i:min(b, i + TOGETHER)]
            own = dict(zip(("key", "crc", "start", "stop", "source_start"), (key, crc, start, stop, source_start)))
            yield int(k[a]), int(c[a]), struct.pack("<I", len(at)) + b"".join(
                own[name][at].astype(kind).tobytes() for name, kind in _BLOB)


def _of_source(data: bytes) -> list[np.ndarray]:
    (n,), at, out = struct.unpack_from("<I", data), 4, []
    for _, kind in _BLOB:
        out.append(np.frombuffer(data, kind, n, at).astype(np.int64))
        at += out[-1].size * np.dtype(kind).itemsize
    return out


def digest(words: list[bytes]) -> bytes:
    """128 bits of the words of a span."""
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def _input_bytes(df: DataFrame) -> int:
    """The optimizer's size of the inputs it knows (files: their size)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(n for n in sizes if n < 1 << 60)  # rows held in memory have no size


def _chunks(batches: Iterator[pa.RecordBatch]):
    """Words, ids and text checks of the documents of a chunk that have a window."""
    words, keys, crcs, held = [], [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            raw = text_bytes(text.as_py())
            own = raw.split()
            if len(own) < WINDOW:
                continue
            words.append(own)
            keys.append(NO_ID if doc_id is None else doc_id)
            crcs.append(zlib.crc32(raw))
            held += len(own)
            if held >= CHUNK_WORDS:
                yield words, keys, crcs
                words, keys, crcs, held = [], [], [], 0
    if words:
        yield words, keys, crcs


def heavy_minimizers(docs: DataFrame) -> np.ndarray:
    """Minimizers with ``HEAVY_RUNS`` runs or more in (doc_id, text) rows, as a
    sample of all runs tells. They change how windows are dealt, not the result."""
    sample = SAMPLE

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lakeloom.llm.common import HashedWords
        from lakeloom.llm.substrings import _chunks, chunk_heavy

        hashes = HashedWords(11)
        for words, _, _ in _chunks(batches):
            g, n = chunk_heavy(words, hashes, sample)
            yield pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array(n, pa.int64())], names=["g", "n"])

    df = docs.mapInArrow(lean(count), "g bigint, n bigint").groupBy("g").agg(F.sum("n").alias("n"))
    found = df.where(F.col("n") >= HEAVY_RUNS).select("g").toPandas()  # one in HEAVY_RUNS runs at most
    return found["g"].to_numpy(np.int64).view(np.uint64)


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", grouped: bool = False) -> DataFrame:
    """Pieces of repeated paths, as far as hashes tell (``grouped``: as
    ``by_source`` gives them): words ``start`` to ``stop`` of a document
    (key: its id, crc: check of its text) stand at ``source_start`` of an
    earlier place. Pieces of one span touch or overlap."""
    spark = docs.sparkSession
    ship(spark)
    session = partitions(spark)
    want = max(session, -(-3 * _input_bytes(docs) // BUCKET_BYTES))
    parts = min(want, max(session, MOST_PARTITIONS))
    subs = -(-want // parts)

    own = columns(docs, doc_id=id_col, text=text_col)
    heavy = heavy_minimizers(own)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lakeloom.llm.common import HashedWords
        from lakeloom.llm.substrings import _chunks, _rows, chunk_edges

        hashes = HashedWords(11)
        for words, keys, crcs in _chunks(batches):
            blobs, local = chunk_edges(words, np.array(keys, np.int64), np.array(crcs, np.int64), hashes, parts * subs,
                                       heavy)
            ids, data = [b for b, _ in blobs], [x for _, x in blobs]
            if len(local[0]):  # settled here; rides along to any bucket
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, _rows(local).schema) as out:
                    out.write_batch(_rows(local))
                ids.append(crcs[0] % (parts * subs))
                data.append(b"\0" * 12 + sink.getvalue().to_pybytes())
            ids = np.array(ids, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array((ids // subs).astype(np.int32)), pa.array((ids % subs).astype(np.int32)),
                 pa.array(data, pa.binary())], names=["part", "sub", "data"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lakeloom.llm.substrings import _rows, bucket_pieces, by_source

        def out(cols: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            if not grouped:
                return _rows(cols)
            found = list(zip(*by_source(cols))) or [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(found, (pa.int64(), pa.int64(), pa.binary()))],
                                              names=["source_key", "source_crc", "data"])

        blobs, sub = [], None
        for batch in batches:
            for own, data in zip(batch.column(1).to_pylist(), batch.column(2)):
                data = data.as_py()
                if data[:12] == b"\0" * 12:
                    for rows in pa.ipc.open_stream(data[12:]):
                        yield out(tuple(c.to_numpy().astype(np.int64) for c in rows.columns))
                    continue
                if own != sub and blobs:
                    yield out(bucket_pieces(blobs))
                    blobs = []
                sub = own
                blobs.append(data)
        if blobs:
            yield out(bucket_pieces(blobs))

    df = own.mapInArrow(lean(split), "part int, sub int, data binary")
    df = df.repartitionById(parts, F.col("part"))
    if subs > 1:
        df = df.sortWithinPartitions("sub")
    return df.mapInArrow(lean(gather), "source_key bigint, source_crc bigint, data binary" if grouped else PIECES)


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start, stop, source_id, source_start: maximal repeated paths,
    pieces glued where both sides go on in step."""
    df = pieces(docs, id_col, text_col).withColumn("step", F.col("source_start") - F.col("start"))
    path = Window.partitionBy("key", "crc", "source_key", "source_crc", "step").orderBy("start", "stop")
    before = F.max("stop").over(path.rowsBetween(Window.unboundedPreceding, -1))
    df = df.withColumn("new", F.coalesce((F.col("start") > before - WINDOW + 1).cast("int"), F.lit(1)))
    df = df.withColumn("at", F.sum("new").over(path.rowsBetween(Window.unboundedPreceding, 0)))
    ids = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return df.groupBy("key", "crc", "source_key", "source_crc", "step", "at").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop")).select(
        ids("key").alias("doc_id"), "start", "stop", ids("source_key").alias("source_id"),
        (F.col("start") + F.col("step")).alias("source_start"))


def _removed(words: list[bytes], found: list | None) -> np.ndarray:
    """Marks of the words of pieces whose source holds the same words."""
    n = len(words)
    step = np.zeros(n + 1, np.int64)
    for f in found or ():
        a, b = f["start"], f["stop"]
        if b <= n and digest(words[a:b]) == f["there"]:
            step[a] += 1
            step[b] -= 1
    return np.cumsum(step[:n]) > 0


def without(raw: bytes, gone: np.ndarray) -> bytes:
    """The text without the marked words and the space after each."""
    spot = [m.start() for m in _WORD.finditer(raw)] + [len(raw)]
    edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
    out, last = [], 0
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
        out.append(raw[last:spot[a]])
        last = spot[b]
    out.append(raw[last:])
    return b"".join(out)


def _with_pieces(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str, str]:
    """``docs`` with its text packed and its pieces in two columns of new
    names. A document's pieces are as many as its length allows at most.

    Pieces and documents are joined twice, by the source and by the document
    itself, over one shuffle of the documents."""
    tag = uuid.uuid4().hex[:8]
    key, crc, packed, found = (f"{k}_{tag}" for k in ("key", "crc", "packed", "found"))
    id_at, text_at = docs.columns.index(id_col), docs.columns.index(text_col)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lakeloom.llm.substrings import NO_ID

        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = [t.as_py() for t in batch.column(text_at)]
            raws = [text_bytes(t) for t in texts]
            ids = [NO_ID if i is None else i for i in batch.column(id_at).to_pylist()]
            cols = [c for i, c in enumerate(batch.columns) if i != text_at]
            cols += [pa.array(ids, pa.int64()), pa.array([zlib.crc32(r) for r in raws], pa.int64()),
                     pa.array([None if t is None else press.compress(r) for t, r in zip(texts, raws)], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    fields = [f for i, f in enumerate(docs.schema.fields) if i != text_at]
    # Keys are never null, so that both joins below take the same shuffled rows.
    fields += [T.StructField(key, T.LongType(), False), T.StructField(crc, T.LongType(), False),
               T.StructField(packed, T.BinaryType())]
    names = [f.name for f in fields]
    at_packed = len(names) - 1

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces with the digest of the words at their source."""
        from lakeloom.llm.substrings import _of_source, digest

        undo = zstandard.ZstdDecompressor()
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        for batch in batches:
            last, words = None, []
            for data, blob in zip(batch.column(at_packed), batch.column(batch.num_columns - 1)):
                data = data.as_py()
                if data != last:
                    last, words = data, (undo.decompress(data) if data else b"").split()
                to, check, start, stop, place = _of_source(blob.as_py())
                there = [digest(words[p:p + n]) for p, n in zip(place.tolist(), (stop - start).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip((to, check, start, stop, there), kinds)],
                    names=["of_key", "of_crc", "start", "stop", "there"])

    own = docs.mapInArrow(lean(pack), T.StructType(fields))
    per = pieces(docs, id_col, text_col, grouped=True)
    met = own.join(per.hint("merge"), (F.col(key) == F.col("source_key")) & (F.col(crc) == F.col("source_crc")))
    met = met.drop("source_key", "source_crc").mapInArrow(
        lean(look), "of_key bigint, of_crc bigint, start int, stop int, there binary")
    met = met.groupBy("of_key", "of_crc").agg(F.collect_list(F.struct("start", "stop", "there")).alias(found))
    df = own.join(met.hint("merge"), (F.col(key) == F.col("of_key")) & (F.col(crc) == F.col("of_crc")), "left")
    return df.drop(key, crc, "of_key", "of_crc"), packed, found


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row.

    A word goes if a window over it also starts at an earlier place. Null and
    empty texts, and texts under 20 words, lose nothing. Rows that repeat
    exactly are one document and get the same result; rows that share an id
    but not the text are documents of their own, in the order of their text's
    check; null ids come before all others. An empty table gives no rows. A very
    long text is a chunk of its own and is worked on whole, in memory some ten
    times its size; other columns are not read, whatever their names.
    """
    ship(docs.sparkSession)
    df, packed, found = _with_pieces(columns(docs, doc_id=id_col, text=text_col), "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lakeloom.llm.substrings import _removed

        undo = zstandard.ZstdDecompressor()
        for batch in batches:
            n_words, n_removed, digest = [], [], []
            for data, own in zip(batch.column(1), batch.column(2).to_pylist()):
                data = data.as_py()
                words = (undo.decompress(data) if data else b"").split()
                gone = _removed(words, own)
                kept = [w for w, g in zip(words, gone.tolist()) if not g] if own else words
                n_words.append(len(words))
                n_removed.append(len(words) - len(kept))
                digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(digest, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return df.select("doc_id", packed, found).mapInArrow(
        lean(run), "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated passages cut out of the text; the layout of what
    is left and all other columns stay. Nulls stay null."""
    ship(docs.sparkSession)
    df, packed, found = _with_pieces(docs, id_col, text_col)
    names = docs.columns
    others = [c for c in names if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lakeloom.llm.substrings import _removed, without

        undo = zstandard.ZstdDecompressor()
        for batch in batches:
            texts = []
            for data, own in zip(batch.column(len(others)), batch.column(len(others) + 1).to_pylist()):
                data = data.as_py()
                raw = None if data is None else undo.decompress(data)
                if raw and own:
                    raw = without(raw, _removed(raw.split(), own))
                texts.append(None if raw is None else raw.decode("utf-8", "surrogatepass"))
            cols = dict(zip(others, batch.columns)) | {text_col: pa.array(texts, pa.string())}
            yield pa.RecordBatch.from_arrays([cols[c] for c in names], names=names)

    quoted = [F.col("`" + c.replace("`", "``") + "`") for c in others]
    return df.select(*quoted, packed, found).mapInArrow(lean(run), docs.schema)
