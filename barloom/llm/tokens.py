"""Byte-level BPE ids of whole texts, many at once.

Merges never cross a pre-token, so each distinct pre-token is encoded once by the tokenizer and remembered. Texts are
split into pre-tokens, looked up and put together again as arrays; texts with characters that the splitting rule
below does not cover go to the tokenizer whole.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from .bytesnp import prefix_hash, slices, span_hash, text_column

DEFAULT = "byte_bpe_50k.json"
#: Pre-tokens that are remembered; beyond it the memory starts anew.
MEMO = 500_000
_SLOTS = 1 << 20
#: Pre-tokens that go to the tokenizer at once.
LEARN = 4096
#: Longer texts go to the tokenizer whole: a slice then never has more distinct pre-tokens than there is room for.
LONG = 1 << 20

_LETTER, _NUMBER, _OTHER, _SPACE, _WHITE, _STRANGE = range(1, 7)


def _kinds() -> np.ndarray:
    """Kinds of the code points of the lead bytes C2 to C9 (below U+0280), by Unicode category; rare white space and controls are strange."""
    out = np.full(0x280, _OTHER, np.uint8)
    for c in range(0x280):
        category = unicodedata.category(chr(c))
        if category[0] == "L":
            out[c] = _LETTER
        elif category[0] == "N":
            out[c] = _NUMBER
        elif category[0] in "ZC":
            out[c] = _STRANGE
    out[[9, 10, 13]] = _WHITE
    out[32] = _SPACE
    return out


_KIND = _kinds()


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(DEFAULT)


def _kind_of_bytes(data: np.ndarray) -> np.ndarray:
    """The kind of the character that each byte belongs to."""
    kind = _KIND[np.minimum(data, 127)]
    high = np.flatnonzero(data >= 128)
    if len(high):
        lead = high[(data[high] & 0xC0) == 0xC0]
        kind[high] = _STRANGE
        lead = lead[(data[lead] >= 0xC2) & (data[lead] <= 0xC9)]
        kind[lead] = kind[lead + 1] = _KIND[((data[lead] & 0x1F).astype(np.int64) << 6) | (data[lead + 1] & 0x3F)]
    return kind


def _starts(data: np.ndarray, kind: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """First bytes of the pre-tokens.

    The rule: a contraction ('s 't 're 've 'm 'll 'd), or letters, numbers or other marks with at most one blank before
    them, or white space; of white space before something else the last character stands apart, a blank joins what follows.
    """
    n = len(data)
    white = kind >= _SPACE
    group = np.where(white, _SPACE, kind)
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    start = edge.copy()
    start[1:n] |= group[1:] != group[:-1]
    # The last white-space character before something else.
    last = np.flatnonzero(white[:-1] & ~white[1:] & ~edge[1:n]) if n else np.zeros(0, np.int64)
    start[last] = True
    blank = last[kind[last] == _SPACE]
    start[blank + 1] = False
    # Contractions.
    quote = np.flatnonzero((data[:-1] == 39) & start[:-2]) if n > 1 else np.zeros(0, np.int64)
    quote = quote[~edge[quote + 1] & (kind[quote + 1] == _LETTER)]
    if len(quote):
        a = data[quote + 1]
        b = np.where((quote + 2 < n) & ~edge[np.minimum(quote + 2, n)], data[np.minimum(quote + 2, n - 1)], 0)
        one = (a == 115) | (a == 116) | (a == 109) | (a == 100)
        two = ((a == 114) & (b == 101)) | ((a == 118) & (b == 101)) | ((a == 108) & (b == 108))
        start[quote[one | two] + 1] = False
        after = np.concatenate([quote[one] + 2, quote[two & ~one] + 3])
        after = after[after < n]
        start[after] = True
    return np.flatnonzero(start[:n])


class Encoder:
    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.width = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, k in vocabulary.items():  # one character of a token's name stands for one byte
            self.width[k] = len(token)
        self._clear()

    def _clear(self) -> None:
        self.keys, self.entry = np.zeros(_SLOTS, np.uint64), np.full(_SLOTS, -1, np.int32)
        self.first, self.count, self.used = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32), 0
        self.pool, self.pooled = np.zeros(1 << 18, np.uint32), 0

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Entries of the hashes, -1 where unknown."""
        slot = (h >> np.uint64(44)).astype(np.int64)
        out = self.entry[slot]
        open_ = np.flatnonzero((out >= 0) & (self.keys[slot] != h))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (_SLOTS - 1)
            at = slot[open_]
            out[open_] = self.entry[at]
            open_ = open_[(self.entry[at] >= 0) & (self.keys[at] != h[open_])]
        return out

    def _learn(self, h: np.ndarray, pieces: list[bytes]) -> None:
        """Remember distinct unknown pre-tokens. In a row, most are split as they stand; a check of the widths finds the others."""
        new = len(pieces)
        text = b"".join(pieces).decode("utf-8")
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.cumsum(self.width[ids]) if len(ids) else np.zeros(0, np.int64)
        wanted = np.cumsum([len(p) for p in pieces])
        at = np.searchsorted(ends, wanted)
        if len(ends) and ends[-1] == wanted[-1] and (ends[np.minimum(at, len(ends) - 1)] == wanted).all() and self._apart(pieces):
            counts = np.diff(np.concatenate([[0], at + 1]))
        else:
            got = [x.ids for x in self.tokenizer.encode_batch_fast([p.decode("utf-8") for p in pieces], add_special_tokens=False)]
            ids, counts = np.array([k for x in got for k in x], np.uint32), np.array([len(x) for x in got])
        while self.used + new > len(self.first):
            self.first, self.count = np.resize(self.first, 2 * len(self.first)), np.resize(self.count, 2 * len(self.count))
        while self.pooled + len(ids) > len(self.pool):
            self.pool = np.resize(self.pool, 2 * len(self.pool))
        self.pool[self.pooled : self.pooled + len(ids)] = ids
        self.first[self.used : self.used + new] = self.pooled + np.cumsum(counts) - counts
        self.count[self.used : self.used + new] = counts
        self.pooled += len(ids)
        left, slot = np.arange(new), (h >> np.uint64(44)).astype(np.int64)
        while len(left):
            free = left[self.entry[slot[left]] < 0]
            _, pick = np.unique(slot[free], return_index=True)
            put = free[pick]
            self.keys[slot[put]], self.entry[slot[put]] = h[put], self.used + put
            done = np.zeros(new, bool)
            done[put] = True
            left = left[~done[left]]
            slot[left] = (slot[left] + 1) & (_SLOTS - 1)
        self.used += new

    @staticmethod
    def _apart(pieces: list[bytes]) -> bool:
        """Whether every piece is a blank and then letters or marks, so that no piece joins the one before."""
        return all(p[0] == 32 and len(p) > 1 for p in pieces)

    def _known(self, h: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        found = self._find(h)
        unknown = np.flatnonzero(found < 0)
        if len(unknown):
            new, where = np.unique(h[unknown], return_index=True)
            if self.used + len(new) > MEMO and self.used:
                self._clear()
                return self._known(h, data, starts, ends)
            at = unknown[where]
            raw = data.tobytes()
            pieces = [raw[s:e] for s, e in zip(starts[at], ends[at], strict=True)]
            spaced = np.array([p[0] == 32 and len(p) > 1 for p in pieces])
            for some in (np.flatnonzero(spaced), np.flatnonzero(~spaced)):
                for lo in range(0, len(some), LEARN):
                    part = some[lo : lo + LEARN]
                    self._learn(new[part], [pieces[k] for k in part])
            found = self._find(h)
        return found

    def encode(self, column: pa.Array):
        """Ids of each text of a string array in turn, as unsigned 32-bit arrays; null counts as empty."""
        offsets, whole = text_column(column)
        for lo, hi in slices(offsets):
            data, bounds = whole[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            kind = _kind_of_bytes(data)
            strange = np.concatenate([[0], np.cumsum(kind == _STRANGE)])
            odd = (strange[bounds[1:]] > strange[bounds[:-1]]) | (np.diff(bounds) > LONG)
            if odd.any():  # without the odd texts
                keep = np.repeat(~odd, np.diff(bounds))
                data, kind = data[keep], kind[keep]
                bounds = np.concatenate([[0], np.cumsum(np.where(odd, 0, np.diff(bounds)))])
            starts = _starts(data, kind, bounds)
            ends = np.append(starts[1:], len(data)) if len(starts) else starts
            found = self._known(span_hash(prefix_hash(data), starts, ends), data, starts, ends)
            counts = self.count[found].astype(np.int64)
            upto = np.concatenate([[0], np.cumsum(counts)])
            flat = self.pool[np.repeat(self.first[found] - upto[:-1], counts) + np.arange(upto[-1])]
            cut = upto[np.searchsorted(starts, bounds)]
            for k in range(hi - lo):
                if odd[k]:
                    yield np.array(self.tokenizer.encode_batch_fast([column[lo + k].as_py()], add_special_tokens=False)[0].ids, np.uint32)
                else:
                    yield flat[cut[k] : cut[k + 1]]
