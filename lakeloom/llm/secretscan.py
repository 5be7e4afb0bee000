"""Secrets in texts, all rules in one pass over the bytes.

The rules' patterns are compiled into one minimal automaton (``automaton.py``).
Its pass marks where some rule has matched; only the stretches around those
marks, between bytes that end every match, are then read rule by rule, each by
the minimal automaton of that rule alone, for the leftmost longest matches
that do not overlap. A match counts if its value is long enough.

Every rule is written so that its longest match is the one that a greedy
backtracking matcher finds. Everything is a function of one text, so it maps
over the scan.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.automaton import Automaton
from lakeloom.llm.common import columns, lean, ship

SLICE_BYTES = 8 << 20


class Rule(NamedTuple):
    """``head`` and ``value`` stand one after the other; the value has ``least`` characters or more."""

    kind: str
    head: str
    value: str
    least: int = 1
    any_case: bool = False


# The kinds whose spans every scan reports.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""",
         r"[A-Za-z0-9+/_.=-]+", 12, True),
    Rule("access", "", r"AKIA[A-Z0-9]+", 18),
    # A run of 16 or more is the same as any run that is then dropped below 16.
    Rule("hex", "", r"[0-9a-f]{16,}", 16),
)
# Public formats of well-known tokens.
ADDED = (
    Rule("private_key", "", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", "", r"gh[oprsu]_[A-Za-z0-9]+", 40),
    Rule("slack", "", r"xox[abprs]-[A-Za-z0-9-]+", 20),
    Rule("google", "", r"AIza[A-Za-z0-9_-]+", 39),
    Rule("stripe", "", r"[rs]k_(live|test)_[A-Za-z0-9]+", 24),
    Rule("jwt", "", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 32),
    Rule("url", r"(https?|ftp|postgres(ql)?|mysql|mongodb(\+srv)?|redis|amqps?)://[A-Za-z0-9._%+-]*:",
         r"[!-.0-9;-?A-~]+@", 2),
)


class Scanner:
    """``spans(texts)``: (rule, start, end) in code points of every text."""

    def __init__(self, rules: tuple[Rule, ...] = BASE + ADDED):
        self.rules = rules
        self.every = Automaton([(r.head + r.value, r.any_case) for r in rules], anywhere=True)
        if not self.every.resets.any():
            raise ValueError("no byte ends every match of the rules")
        self.gap = bytes([int(np.flatnonzero(self.every.resets)[0])])
        self.single = [Automaton([(r.head + r.value, r.any_case)]) for r in rules]
        self.heads = [Automaton([(r.head, r.any_case)]) if r.head else None for r in rules]

    def _stretch(self, data: bytes, start: int, stop: int, bits: int) -> list[tuple[int, int, int]]:
        found = []
        for k, rule in enumerate(self.rules):
            if bits >> k & 1:
                for s, e in self.single[k].matches(data, start, stop):
                    at = self.heads[k].longest(data, s, e) if self.heads[k] else s
                    # Bytes that go on a character do not count.
                    if sum(b & 0xC0 != 0x80 for b in data[at:e]) >= rule.least:
                        found.append((k, s, e))
        return found

    def _slice(self, texts: list[bytes]) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
        """Number in ``texts`` and byte spans of those with any."""
        joined = self.gap.join(texts) + self.gap
        data = np.frombuffer(joined, np.uint8)
        where, bits = self.every.ends(data)
        if not len(where):
            return
        resets = np.flatnonzero(self.every.resets[data])  # the gaps are among them
        behind = np.searchsorted(resets, where - 1)
        at = np.flatnonzero(np.diff(behind, prepend=-1))
        begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
        spans: dict[int, list] = {}
        for b, kinds in zip(behind[at].tolist(), np.bitwise_or.reduceat(bits, at).tolist()):
            start, stop = int(resets[b - 1]) + 1 if b else 0, int(resets[b])
            doc = int(np.searchsorted(begins, start, "right")) - 1
            own = self._stretch(joined, start, stop, kinds)
            if own:
                spans.setdefault(doc, []).extend((k, s - int(begins[doc]), e - int(begins[doc])) for k, s, e in own)
        yield from spans.items()

    def spans(self, texts: list[bytes]) -> dict[int, list[tuple[int, int, int]]]:
        out = {}
        at = 0
        while at < len(texts):
            stop, held = at, 0
            while stop < len(texts) and (stop == at or held + len(texts[stop]) < SLICE_BYTES):
                held += len(texts[stop]) + 1
                stop += 1
            for doc, own in self._slice(texts[at:stop]):
                text = texts[at + doc]
                if not text.isascii():
                    first = np.cumsum(np.frombuffer(text, np.uint8) & 0xC0 != 0x80)
                    place = np.concatenate(([0], first))
                    own = [(k, int(place[s]), int(place[e])) for k, s, e in own]
                out[at + doc] = sorted(own, key=lambda x: (x[1], x[0]))
            at = stop
        return out


SCHEMA = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"


def scan(docs: DataFrame, added: tuple[Rule, ...] = ADDED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts by base kind, a digest of the base spans and all spans of every row.

    ``spans`` is ``kind:start:end`` in code points, end exclusive, by start and
    then kind as listed, comma-joined; ``base_sha256`` is the SHA-256 of the
    same of the base kinds. Spans of different kinds may overlap. Null and
    empty texts have no spans; a null id stays null; repeated rows get the
    same result; an empty table gives no rows; other columns are not read. A
    very long text is read whole, as lanes between bytes that end every match;
    memory is a few times the longest text.
    """
    ship(docs.sparkSession)
    n_base = len(BASE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lakeloom.llm.secretscan import BASE, SCHEMA, Scanner

        rules = BASE + added
        scanner = Scanner(rules)
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        write = lambda own: ",".join(f"{rules[k].kind}:{s}:{e}" for k, s, e in own)
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        nothing = digest("")
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).to_pylist()]
            n = len(texts)
            counts = np.zeros((n_base, n), np.int64)
            sums, lists = [nothing] * n, [""] * n
            for doc, own in scanner.spans(texts).items():
                base = [x for x in own if x[0] < n_base]
                for k, _, _ in base:
                    counts[k, doc] += 1
                sums[doc], lists[doc] = digest(write(base)), write(own)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), *[pa.array(c) for c in counts], pa.array(sums, pa.string()),
                 pa.array(lists, pa.string())], names=names)

    own = columns(docs, doc_id=id_col, text=text_col).select("doc_id", F.col("text").cast("binary").alias("text"))
    return own.mapInArrow(lean(run), SCHEMA)
