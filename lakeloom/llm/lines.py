"""Line-first cleaning: rules per line, then a rule per document.

Every line with a word is judged alone; lines that fail are removed; the
document goes if too little of its text is left. A line fails as

* navigation: three or more separators (``|``, ``>``, bullets) that make up a
  tenth or more of its tokens;
* punctuation: 20 words or more without a mark of any script that ends or
  divides sentences, unless the script has none (Thai and Lao); or at least five
  words of which a third or more end in symbols or repeated exclamation marks;
* shouting: at least five words, and nine tenths of its letters are capitals;
* monotony: at least ten words, and one word makes up over a third of them,
  or over a third repeat the word before;
* boilerplate: at most 40 words that hold one of the set phrases;
* repetition: at least ``REPEAT_WORDS`` words, equal to an earlier line.

Everything is a function of one text, so it maps over the scan.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from lakeloom.llm.common import HashedWords, columns, lean, ship, text_bytes

MAX_LOSS = 0.4
REPEAT_WORDS = 5
SYMBOLS = "#*$%&|<>"
# Set phrases of cookie banners, menus and footers.
BOILERPLATE = (
    "accept all cookies", "all rights reserved", "back to top", "click here", "cookie policy",
    "enable javascript", "follow us on", "log in to", "privacy policy", "read more", "share this",
    "sign up for", "skip to content", "subscribe to our", "terms of service", "terms of use",
    "this site uses cookies", "we use cookies",
)
_PHRASES = re.compile("|".join(re.escape(p) for p in BOILERPLATE))
_SEPARATORS = {"|", ">", ">>", "»", "•", "·", "›", "::", "||"}
# Marks by their Unicode property (planes 0 and 1), and letters of scripts without any.
_MARKS = re.compile("[…" + "".join(re.escape(c) for c in regex.findall(
    r"[\p{Sentence_Terminal}\p{Terminal_Punctuation}--,]", "".join(map(chr, (*range(0xD800), *range(0xE000, 0x12000)))),
    regex.V1)) + "]")
_NO_MARKS = re.compile("[\u0e01-\u0eff]")
_NOISY = re.compile(r"(?:[#*$%&]{2,}|!{2,})$")
_FACTOR = 0x9E3779B97F4A7C15


def line_fault(line: str) -> str | None:
    """Name of the first rule that a line with a word fails, if any.
    Repetition is the document's to judge."""
    words = line.split()
    n = len(words)
    marks = sum(w in _SEPARATORS for w in words)
    if marks >= 3 and 10 * marks >= n:
        return "navigation"
    if n >= 20 and not _MARKS.search(line) and not _NO_MARKS.search(line):
        return "punctuation"
    if n >= 5:
        if 3 * sum(_NOISY.search(w) is not None for w in words) >= n:
            return "punctuation"
        upper = sum(c.isupper() for c in line)
        if upper and 10 * upper >= 9 * sum(c.isalpha() for c in line):
            return "shouting"
    if n >= 10 and 3 * max(Counter(words).most_common(1)[0][1], sum(map(eq, words, words[1:]))) > n:
        return "monotony"
    if n <= 40 and _PHRASES.search(line.lower()):
        return "boilerplate"
    return None


def clean_lines(text: str) -> tuple[list[str], Counter]:
    """The lines that pass, and how often each rule failed one."""
    kept, faults, seen = [], Counter(), set()
    for line in text.split("\n"):
        words = len(line.split())
        if words:
            if words >= REPEAT_WORDS and line in seen:
                faults["repetition"] += 1
                continue
            seen.add(line)
            if fault := line_fault(line):
                faults[fault] += 1
                continue
        kept.append(line)
    return kept, faults


def repeated_words(words: list[bytes], hashes: HashedWords, window: int = 8) -> int:
    """Words covered by windows of ``window`` words found twice or more."""
    n = len(words)
    if n <= window:
        return 0
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    code = np.zeros(n - window + 1, np.uint64)
    for i in range(window):
        code = code * np.uint64(_FACTOR) + h[i:n - window + 1 + i]
    _, inverse, count = np.unique(code, return_inverse=True, return_counts=True)
    at = np.flatnonzero(count[inverse] > 1)
    if not len(at):
        return 0
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + window, -1)
    return int((np.cumsum(step[:n]) > 0).sum())


def measure(text: str, hashes: HashedWords, max_loss: float = MAX_LOSS) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, share of word characters lost, cleaned text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    spaces = sum(map(text.count, " \t\n\v\f\r"))
    chars = len(text) - spaces
    seen: set[str] = set()
    dup = 0
    for line in raw.split(b"\n"):
        if line.strip():
            dup += line in seen
            seen.add(line)
    repeat = repeated_words(words, hashes)
    failed = len(words) < 20 or 100 * repeat > 30 * len(words)
    lines, _ = clean_lines(text)
    cleaned = "\n".join(lines)
    left = len(cleaned) - sum(map(cleaned.count, " \t\n\v\f\r"))
    lost = 1 - left / chars if chars else 0.0
    kept = not failed and lost <= max_loss
    return len(words), chars, sum(map(text.count, SYMBOLS)), dup, repeat, failed, kept, lost, cleaned


SCHEMA = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
          "n_repeat_words bigint, base_failed boolean, kept boolean, share_lost double")


def judge(docs: DataFrame, max_loss: float = MAX_LOSS, with_text: bool = False,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Figures and verdict of every row, and with ``with_text`` the text left.

    A null or empty text has no words and fails; a null id stays null; repeated
    rows are judged alike; an empty table gives no rows; a very long text is
    judged whole, in memory a few times its size; other columns are not read.
    Repeated windows are compared by
    64-bit hashes within one text.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lakeloom.llm.common import HashedWords
        from lakeloom.llm.lines import measure

        hashes = HashedWords(3)
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] + [pa.string()] * with_text
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                 "kept", "share_lost"] + ["text"] * with_text
        for batch in batches:
            rows = [measure(t.as_py() or "", hashes, max_loss) for t in batch.column(1)]
            cols = list(zip(*rows)) if rows else [()] * 9
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                names=["doc_id", *names])

    return columns(docs, doc_id=id_col, text=text_col).mapInArrow(lean(run), SCHEMA + ", text string" * with_text)
