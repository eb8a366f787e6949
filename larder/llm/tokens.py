"""Batches of texts to token ids with a public tokenizer file.

The byte-level pre-tokenizer never lets a token reach across a space that follows a
non-space, so a text may be cut there.  Pieces that are words with marks, or two of them with
one line break between, are put together from their words, as a token never joins letters with
the marks or the break behind them.  Each word goes through the tokenizer once and is remembered.
ASCII words and marks, which most texts consist of, are cut out and looked up side by side, by their
own bytes; other pieces go one by one.  All tables are of bounded size.  Texts where a space
follows white space are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np
from tokenizers import Tokenizer

from larder.llm.common import KEPT

#: Words and marks of ASCII that a worker remembers, and other pieces and words.
REMEMBERED, OTHERS = 1 << 19, 50_000
#: Bytes of text that are cut side by side.
_CHUNK = 1 << 19
#: Longest word that is looked up by its bytes.
_LONGEST = 16
_RUN = re.compile(r"\s ")
_WORDS = re.compile(r"([^\W\d_]+)([^\w\s]*)(?:\n([^\W\d_]+)([^\w\s]*))?")
_WORKERS: dict[str, Encoder] = {}
KEPT.append(_WORKERS)
_LETTER, _MARK, _BREAK, _OTHER, _SPACE = range(5)


def _kinds() -> np.ndarray:
    """Kind of every byte: ASCII letter, mark (neither word nor white space), line break, space, or other."""
    out = np.full(256, _OTHER, np.int8)
    for b in range(1, 128):
        c = chr(b)
        out[b] = _SPACE if c == " " else _BREAK if c == "\n" else _LETTER if c.isalpha() else _OTHER if re.match(r"[\w\s]", c) else _MARK
    return out


_KINDS = _kinds()
#: Runs of pieces that are put together: letters, marks or none, and once more behind a line break.
_SHAPES = [
    sum((kind + 1) * 6**k for k, kind in enumerate(runs, 1))
    for one in ([_LETTER], [_LETTER, _MARK])
    for runs in (one, [*one, _BREAK, _LETTER], [*one, _BREAK, _LETTER, _MARK])
]
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


class Words:
    """Ids of words and marks of at most 16 bytes: an open-addressing table from these bytes, as two numbers."""

    def __init__(self, dtype: np.dtype):
        self.n, self.shift = 0, 64 - 16
        self.low, self.high = np.zeros(1 << 15, np.uint64), np.zeros(1 << 15, np.uint64)
        self.ends = np.zeros((1 << 15) + 1, np.int64)  # ids of entry i: pool[ends[i]:ends[i + 1]]
        self.pool = np.zeros(1 << 17, dtype)
        self.slots = np.full(1 << 16, -1, np.int32)

    def _slot(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return (((low * _MIX[0] ^ high) * _MIX[1]) >> np.uint64(self.shift)).astype(np.int64)

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Entry of each key, -1 where there is none."""
        at = self._slot(low, high)
        found = self.slots[at]
        todo = np.flatnonzero((found >= 0) & ((self.low[found] != low) | (self.high[found] != high)))
        while len(todo):
            at[todo] = (at[todo] + 1) & (len(self.slots) - 1)
            f = found[todo] = self.slots[at[todo]]
            todo = todo[(f >= 0) & ((self.low[f] != low[todo]) | (self.high[f] != high[todo]))]
        return found

    def _enter(self, left: np.ndarray) -> None:
        at = self._slot(self.low[left], self.high[left])
        while len(left):
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]
            lost = self.slots[at] != left
            left, at = left[lost], (at[lost] + 1) & (len(self.slots) - 1)

    def put(self, ids: np.ndarray) -> int:
        """Ids behind those of all entries, for as long as none is added; where they start."""
        at = int(self.ends[self.n])
        if at + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool[:at], np.zeros(at + 2 * len(ids), self.pool.dtype)])
        self.pool[at : at + len(ids)] = ids
        return at

    def add(self, low: np.ndarray, high: np.ndarray, ids: list[bytes]) -> None:
        """New entries; no key may be there or come twice."""
        n = self.n + len(low)
        if n > len(self.low):
            more = np.zeros(max(n - len(self.low), len(self.low)), np.uint64)
            self.low, self.high = np.concatenate([self.low, more]), np.concatenate([self.high, more])
            self.ends = np.concatenate([self.ends, more.view(np.int64)])
        at = self.put(np.frombuffer(b"".join(ids), self.pool.dtype))
        self.low[self.n : n], self.high[self.n : n] = low, high
        self.ends[self.n + 1 : n + 1] = at + np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)) // self.pool.itemsize)
        new, self.n = np.arange(self.n, n, dtype=np.int32), n
        if 2 * n > len(self.slots):
            bits = (2 * n).bit_length()
            self.slots, self.shift, new = np.full(1 << bits, -1, np.int32), 64 - bits, np.arange(n, dtype=np.int32)
        self._enter(new)


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        #: Only a byte-level pre-tokenizer without normalizer is known to allow cuts.
        self.cuts = (
            spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
        )
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(vocab.values()) + 1
        self.dtype = np.dtype(np.uint16 if self.size <= 1 << 16 else np.uint32)
        self.width = np.zeros(self.size, np.int64)  # bytes of text behind each id
        self.breaks = np.zeros(self.size, bool)  # ids with a line break in their text
        self.letters = _byte_letters()
        for token, i in vocab.items():
            self.width[i] = len(token)
            self.breaks[i] = "\n" in token or self.letters[10] in token
        for added in spec.get("added_tokens", []):
            self.width[added["id"]] = len(added["content"].encode())
        self.of_bytes = dict(enumerate(self.letters))
        self.forget()
        self.tokenize = self.tokenizer.model.tokenize

    @classmethod
    def of(cls, path: str) -> Encoder:
        """One encoder a worker process and file."""
        if path not in _WORKERS:
            _WORKERS[path] = cls(path)
        return _WORKERS[path]

    def forget(self) -> None:
        """Leave all that was learned from texts."""
        self.table = Words(self.dtype)
        self.known: dict[str, bytes] = {}  # ids of ' ' + piece
        self.words: dict[str, bytes] = {}  # of ' ' + word
        self.behind: dict[str, bytes] = {}  # of words behind a line break
        self.marks: dict[str, bytes] = {"": b""}

    def whole(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in encoded]

    def _tokens(self, word: str, lead: str = "") -> bytes:
        """Ids of a run of letters behind the stand-in ``lead``."""
        # ASCII letters stand for themselves
        shown = word if word.isascii() else word.encode().decode("latin-1").translate(self.of_bytes)
        return array(self.dtype.char, [t.id for t in self.tokenize(lead + shown)]).tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of ' ' + word for a run of letters."""
        ids = self.words.get(word)
        if ids is None:
            ids = self.words[word] = self._tokens(word, self.letters[32])
        return ids

    def _behind(self, word: str) -> bytes:
        """Ids of a run of letters behind a line break."""
        ids = self.behind.get(word)
        if ids is None:
            ids = self.behind[word] = self._tokens(word)
        return ids

    def _marks(self, marks: str) -> bytes:
        ids = self.marks.get(marks)
        if ids is None:
            ids = self.marks[marks] = self.whole([marks])[0]
        return ids

    def _composed(self, piece: str) -> bytes | None:
        """Ids of ' ' + piece from its words and marks, if it is made of them."""
        m = _WORDS.fullmatch(piece)
        if m is None:
            return None
        one, marks, two, more = m.groups()
        ids = self._word(one) + self._marks(marks)
        return ids if two is None else ids + self._marks("\n") + self._behind(two) + self._marks(more)

    def _learn(self, words: list[str]) -> None:
        """Ids of ' ' + word for words that end in no white space, many in one call."""
        item = self.dtype.itemsize
        for at in range(0, len(words), 4000):
            some = words[at : at + 4000]
            ids = np.array(self.tokenizer.encode_batch_fast(["".join([" " + w for w in some])], add_special_tokens=False)[0].ids, np.int64)
            reach = np.cumsum(self.width[ids])
            ends = np.cumsum([len(w.encode("utf-8", "surrogatepass")) + 1 for w in some])
            cut = np.searchsorted(reach, ends) + 1
            if len(reach) and reach[-1] == ends[-1] and (reach[cut - 1] == ends).all():
                raw = ids.astype(self.dtype).tobytes()
                start = 0
                for w, e in zip(some, cut.tolist(), strict=True):
                    self.known[w] = raw[start * item : e * item]
                    start = e
            else:
                for w, ids_ in zip(some, self.whole([" " + w for w in some]), strict=True):
                    self.known[w] = ids_

    def _others(self, pieces: list[str]) -> list[bytes]:
        """Ids of ' ' + piece for pieces that aren't looked up by their bytes."""
        new = []
        for w in dict.fromkeys(pieces):
            if w not in self.known:
                ids = self._composed(w)
                if ids is None:
                    new.append(w)
                else:
                    self.known[w] = ids
        odd = [w for w in new if not w or w[-1].isspace()]
        self._learn([w for w in new if w and not w[-1].isspace()])
        if odd:
            self.known.update(zip(odd, self.whole([" " + w for w in odd]), strict=True))
        return [self.known[w] for w in pieces]

    def _entries(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Entries of the table for words and marks by their bytes; the lowest byte's highest bit tells words behind a line break."""
        entry = self.table.find(low, high)
        lacking = np.flatnonzero(entry < 0)
        if len(lacking):
            a, b = low[lacking], high[lacking]
            by = np.lexsort((a, b))
            a, b = a[by], b[by]
            first = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
            a, b = a[first], b[first]
            behind = (a & np.uint64(0x80)) > 0
            shown = np.stack([a & ~np.uint64(0x80), b], axis=1).astype("<u8").view(f"S{_LONGEST}").reshape(-1).tolist()
            space = self.letters[32]
            ids = [
                self._marks(w) if not w[0].isalpha() else self._tokens(w) if at_break else self._tokens(w, space)
                for w, at_break in zip((x.decode() for x in shown), behind.tolist(), strict=True)
            ]
            self.table.add(a, b, ids)
            entry[lacking] = self.table.find(low[lacking], high[lacking])
        return entry

    def _split(self, bodies: list[str]) -> list[bytes]:
        """Ids of texts that start with a space and have none behind white space."""
        raw = [b.encode() for b in bodies]
        data = np.frombuffer(b"".join([*raw, bytes(_LONGEST)]), np.uint8)
        n = len(data) - _LONGEST
        kind = _KINDS[data[:n]]
        start = np.flatnonzero(np.r_[True, kind[1:] != kind[:-1]] | (kind == _SPACE))
        size, kind = np.diff(np.r_[start, n]), kind[start]
        kind[(kind == _BREAK) & (size > 1)] = _OTHER
        piece = np.flatnonzero(kind == _SPACE)  # the run that each piece starts with
        of = np.cumsum(kind == _SPACE) - 1
        place = np.arange(len(start)) - piece[of]
        weight = np.where(place == 0, 0, np.where(place > 5, 6**7, 6 ** np.minimum(place, 5)))
        weight[size > _LONGEST] = 6**7
        by_bytes = np.isin(np.add.reduceat((kind + 1) * weight, piece), _SHAPES)
        unit = np.flatnonzero(by_bytes[of] & (place > 0))
        at, long = start[unit], size[unit]
        eight = np.ndarray((n + _LONGEST - 7,), "<u8", data, strides=(1,))
        low, high = eight[at] & _MASKS[np.minimum(long, 8)], eight[at + 8] & _MASKS[np.maximum(long - 8, 0)]
        low[(kind[unit] == _LETTER) & (place[unit] > 1)] |= np.uint64(0x80)
        entry = self._entries(low, high)
        first, count = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        first[unit] = self.table.ends[entry]
        count[unit] = self.table.ends[entry + 1] - first[unit]
        rest = piece[~by_bytes]
        if len(rest):
            whole, ends = data[:n].tobytes(), np.r_[start[piece[1:]], n][~by_bytes]
            ids = self._others([whole[s + 1 : e].decode() for s, e in zip(start[rest].tolist(), ends.tolist(), strict=True)])
            count[rest] = np.fromiter(map(len, ids), np.int64, len(ids)) // self.dtype.itemsize
            first[rest] = self.table.put(np.frombuffer(b"".join(ids), self.dtype)) + np.cumsum(count[rest]) - count[rest]
        ends = np.cumsum(count)
        packed = self.table.pool[np.repeat(first - ends + count, count) + np.arange(ends[-1])].tobytes()
        last = np.searchsorted(start, np.cumsum([len(r) for r in raw])) - 1  # the last run of each text
        cut = [0, *(ends[last] * self.dtype.itemsize).tolist()]
        return [packed[a:b] for a, b in zip(cut, cut[1:], strict=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of every text, as native unsigned integers of ``dtype``."""
        if not self.cuts:
            return self.whole(texts)
        out: list[bytes] = [b""] * len(texts)
        plain: list[int] = []
        held: list[tuple[int, int]] = []  # texts of a chunk, and where their first space is
        size = 0

        def close() -> None:
            heads = self.whole([texts[i][:at] for i, at in held])
            for (i, _), head, ids in zip(held, heads, self._split([texts[i][at:] for i, at in held]), strict=True):
                out[i] = head + ids
            held.clear()
            if self.table.n > REMEMBERED:
                self.table = Words(self.dtype)
            for table in (self.known, self.words, self.behind, self.marks):
                if len(table) > OTHERS:
                    table.clear()
            self.marks[""] = b""

        for i, text in enumerate(texts):
            at = text.find(" ")
            if at < 0 or _RUN.search(text):
                plain.append(i)
                continue
            held.append((i, at))
            size += len(text)
            if size >= _CHUNK:
                close()
                size = 0
        if held:
            close()
        for i, ids in zip(plain, self.whole([texts[i] for i in plain]) if plain else [], strict=True):
            out[i] = ids
        return out
