"""Token ids of whole texts with a public tokenizer file.

Tokenizers whose file normalises with NFC, white-space folding and lower case
and whose pre-tokenizer drops white space encode each part that their splitting
pattern finds on its own, so a part's ids are asked of the library once and
looked up after. Texts of plain letters and signs are cut into parts in one
pass, many texts at a time where the pattern is one of runs, so that each distinct
part of them is looked up once; words with other characters are looked at one by
one. Any other tokenizer file encodes each whole text directly.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from lakeloom.llm.common import gather, text_bytes

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# Characters for which lower-casing is one to one and NFC changes nothing.
_SIGNS = r"\x21-\x7e¡-įı-ſ‐-‧‰-⁞€"
_PLAIN = re.compile(f"[{_SIGNS}]+")
_PLAIN_TEXT = re.compile(rf"[\x20\x09-\x0D{_SIGNS}]*")
_SPACE = re.compile(r"[\x20\x09-\x0D]")
#: Runs of letters, single numbers, runs of signs; endings after an apostrophe first.
_RUNS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_BLANK, _LETTER, _SIGN, _NUMBER = range(4)
#: Characters of texts that are cut at a time.
CHUNK = 8_000_000


def _in_plain_text(pattern: str) -> re.Pattern | None:
    """``pattern`` for plain texts alone: its classes of letters and numbers
    written out, for the faster of the two matchers."""
    every = [chr(c) for c in range(0x2060) if _PLAIN.fullmatch(chr(c))] + ["€"]
    for kind in (r"\p{L}", r"\p{N}"):
        pattern = pattern.replace(kind, "".join(re.escape(c) for c in every if regex.match(kind, c)))
    try:
        return re.compile(pattern)
    except re.error:
        return None


def _kinds() -> np.ndarray:
    """Kind of each code point of plain texts."""
    kinds = np.zeros(ord("€") + 1, np.uint8)
    for c in range(len(kinds)):
        if _PLAIN.fullmatch(chr(c)):
            kinds[c] = (_LETTER if regex.match(r"\p{L}", chr(c)) else
                        _NUMBER if regex.match(r"\p{N}", chr(c)) else _SIGN)
    return kinds


def _begins(data: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a part begins at each byte of a plain UTF-8 text, by ``_RUNS``,
    and whether the byte is of a blank. The last two are blank."""
    kind = kinds[:256][data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        head = data[lead]
        two = head < 0xE0
        # Plain characters of three bytes are signs.
        own = kinds[np.where(two, (head.astype(np.uint16) & 0x1F) << 6 | data[lead + 1] & 0x3F, ord("€"))]
        kind[lead] = kind[lead + 1] = own
        kind[lead[~two] + 2] = _SIGN
    blank = kind == _BLANK
    begin = ~blank
    begin[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _NUMBER)
    begin[lead + 1] = False
    # An apostrophe within a run of signs opens no ending: the run goes on.
    at = np.flatnonzero(data == ord("'"))
    at = at[begin[at]]
    if len(at):
        one, two = data[at + 1], data[at + 2]
        short = np.isin(one, list(b"stmd"))
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        begin[at[short | long] + 1] = False
        after = np.concatenate((at[short] + 2, at[long] + 3))
        begin[after] = ~blank[after]
    return begin, blank


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the
    others follow from code point 256 on, in byte order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return {b: chr(b) if b in shown else chr(next(other)) for b in range(256)}


def _pieces(text: str) -> Iterator[str]:
    """A long text cut behind blanks."""
    at = 0
    while len(text) - at > CHUNK and (blank := _SPACE.search(text, at + CHUNK)):
        yield text[at:blank.end()]
        at = blank.end()
    yield text[at:]


class _Recent(dict):
    """A cache of two generations: memory is bounded, frequent entries stay."""

    def __init__(self, compute, limit: int):
        super().__init__()
        self.compute, self.limit, self.old = compute, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Encoder:
    """``ids(text_bytes)``: the token ids of a whole UTF-8 text; ``many(texts)``:
    those of each of many texts. ``rest()`` ends a task: an idle worker keeps
    the latest parts of words only."""

    def __init__(self, path: str, words: int = 50_000, parts: int = 150_000):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            conf = json.load(f)
        small = self.tokenizer.get_vocab_size() <= 1 << 16
        self.dtype, self.code = np.dtype("<u2" if small else "<u4"), "H" if small else "I"
        self.model = self.tokenizer.model
        kinds = [n["type"] for n in (conf.get("normalizer") or {}).get("normalizers", [])]
        pre = (conf.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.by_word = (kinds == ["NFC", "Replace", "Lowercase"] and [p["type"] for p in pre] == ["Split", "ByteLevel"]
                        and pre[0].get("behavior") == "Removed" and pre[0].get("invert") is True
                        and not pre[1].get("use_regex", True) and not pre[1].get("add_prefix_space", True))
        if self.by_word:
            self.split = regex.compile(pre[0]["pattern"]["Regex"])
            self.plain_split = _in_plain_text(pre[0]["pattern"]["Regex"])
            self.kinds = _kinds() if pre[0]["pattern"]["Regex"] == _RUNS else None
            self.special = re.compile("|".join(
                re.escape(t["content"]) for t in conf.get("added_tokens", [])) or r"(?!)")
            self.letters = _byte_letters()
            self.spelled = {b: c for b, c in self.letters.items() if b != ord(" ")}
            # For many parts at a time: the model alone, and which ids close a part.
            self.plain_model = Tokenizer(self.model)
            self.plain_model.pre_tokenizer = WhitespaceSplit()
            suffix = conf["model"].get("end_of_word_suffix")
            self.closes = np.zeros(self.tokenizer.get_vocab_size(), bool)
            self.closes[[i for t, i in self.tokenizer.get_vocab().items() if suffix and t.endswith(suffix)]] = True
            self.parts = _Recent(self._part, parts)
            self.known, self.most_known = pa.array([], pa.large_string()), 2 * parts
            self.known_ids, self.known_n = np.zeros(0, self.dtype), np.zeros(0, np.int64)
            self.words = _Recent(self._word, words)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.dtype).tobytes()

    def _part(self, part: str) -> bytes:
        if not part.isascii():
            part = "".join(map(self.letters.__getitem__, part.encode()))
        return array(self.code, [t.id for t in self.model.tokenize(part)]).tobytes()

    def _new_parts(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of many parts one after the other, and how many each has."""
        every, sizes = [np.zeros(0, self.dtype)], [np.zeros(0, np.int64)]
        for a in range(0, len(parts), 1000):
            some = parts[a:a + 1000].to_numpy(zero_copy_only=False).tolist()
            text = " ".join(some)
            if not text.isascii():
                text = text.encode().decode("latin-1").translate(self.spelled)
            ids = np.array(self.plain_model.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)
            stops = np.flatnonzero(self.closes[ids]) + 1
            if len(stops) != len(some) or stops[-1] != len(ids):  # the ids don't show where parts end
                one = [np.frombuffer(self._part(p), self.dtype) for p in some]
                ids, stops = np.concatenate(one), np.cumsum([len(x) for x in one])
            every.append(ids)
            sizes.append(np.diff(stops, prepend=0))
        return np.concatenate(every), np.concatenate(sizes)

    def _look_up(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where in them and how many those of each of the distinct
        ``parts`` are. The latest parts are kept for the next time."""
        known = len(self.known)
        place = pc.index_in(parts, value_set=self.known).fill_null(-1).to_numpy().copy()
        lost = np.flatnonzero(place < 0)
        new = parts.take(pa.array(lost))
        ids, n = self._new_parts(new)
        ids, n = np.concatenate((self.known_ids, ids)), np.concatenate((self.known_n, n))
        start = np.cumsum(n) - n
        place[lost] = known + np.arange(len(lost))
        idle = np.ones(known, bool)
        idle[place[place < known]] = False
        latest = np.concatenate((place, np.flatnonzero(idle)))[:self.most_known]
        self.known = pa.concat_arrays([self.known, new]).take(pa.array(latest))
        self.known_ids, self.known_n = gather(ids, start[latest], n[latest]), n[latest]
        return ids, start[place], n[place]

    def _word(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "surrogatepass")
        if _PLAIN.fullmatch(text) and not self.special.search(text):
            text, parts = text.lower(), self.parts
            if text.isalpha():
                return parts[text]
            if text[:-1].isalpha() and not text[-1].isalnum():
                return parts[text[:-1]] + parts[text[-1]]
            return b"".join([parts[p] for p in self.split.findall(text)])
        return self._whole(text)

    def packed(self, text: bytes) -> bytes:
        """Ids as consecutive little-endian values of ``dtype``."""
        if not self.by_word:
            return self._whole(text.decode("utf-8", "surrogatepass"))
        if self.plain_split is not None:
            own = text.decode("utf-8", "surrogatepass")
            if _PLAIN_TEXT.fullmatch(own) and not self.special.search(own):
                return b"".join(map(self.parts.__getitem__, self.plain_split.findall(own.lower())))
        return b"".join(map(self.words.__getitem__, text.split()))

    def ids(self, text: bytes) -> np.ndarray:
        return np.frombuffer(self.packed(text), dtype=self.dtype)

    def many(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text in turn; plain texts are taken ``CHUNK`` characters at a time."""
        waiting, held = [], 0
        for text in texts:
            text = text or ""
            if not (self.by_word and self.kinds is not None and _PLAIN_TEXT.fullmatch(text)
                    and not self.special.search(text)):
                waiting.append(self.ids(text_bytes(text)))
            elif len(text) > CHUNK:
                yield from self._together(waiting)
                waiting, held = [], 0
                yield np.concatenate([ids for piece in _pieces(text) for ids in self._together([piece])])
                continue
            else:
                waiting.append(text)
            held += len(text)
            if held >= CHUNK:
                yield from self._together(waiting)
                waiting, held = [], 0
        yield from self._together(waiting)

    def _together(self, waiting: list[str | np.ndarray]) -> Iterator[np.ndarray]:
        """``waiting`` with its texts, all plain, made ids."""
        texts = [w for w in waiting if isinstance(w, str)]
        ids, stops = self._runs(texts) if texts else (None, [])
        start, rest = 0, iter(stops)
        for w in waiting:
            if isinstance(w, str):
                stop = next(rest)
                yield ids[start:stop]
                start = stop
            else:
                yield w

    def _runs(self, texts: list[str]) -> tuple[np.ndarray, list[int]]:
        """The ids of plain texts one after the other, and where each text's end."""
        lower = [t.lower().encode() for t in texts]
        data = np.frombuffer(b"\n".join(lower) + b"\n\n", "u1")
        begin, blank = _begins(data, self.kinds)
        first = np.searchsorted(np.flatnonzero(begin), np.cumsum([len(t) + 1 for t in lower]))
        # The parts' bytes side by side, without blanks.
        data, at = data[~blank], np.flatnonzero(begin[~blank])
        parts = pa.Array.from_buffers(pa.large_string(), len(at), [
            None, pa.py_buffer(np.append(at, len(data))), pa.py_buffer(data)]).dictionary_encode()
        own, start, n = self._look_up(parts.dictionary)
        place = parts.indices.to_numpy()
        count = n[place]
        ids = gather(own, start[place], count)
        return ids, np.concatenate(([0], np.cumsum(count)))[first].tolist()

    def rest(self) -> None:
        if self.by_word:
            self.parts.old, self.words.old = {}, {}
            self.words.clear()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker and file. ``path`` may be the name of a file
    of the installed ``public_tokenizers`` package."""
    if path not in _encoders:
        full = path
        if not os.path.exists(path):
            import public_tokenizers

            full = str(public_tokenizers.path(path))
        _encoders[path] = Encoder(full)
    return _encoders[path]
