"""Exact, cached encoding with a byte-level BPE of the tokenizers library."""

from __future__ import annotations

import re
from itertools import pairwise

import numpy as np
import pyarrow as pa

from tidemark.llm.words import mix

#: Two blanks in a row, or characters that Python alone counts as blank: such a text is encoded whole.
_RARE = re.compile(r"\s\s|[\x1c-\x1f]")
_PAIRS = ("  ", " \n", "\n ", "\n\n")
_OTHER_BLANKS = [chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n"]


def _splits(text: str) -> bool:
    """Whether every blank stands alone, and none ends the text."""
    if text[-1:].isspace() or any(p in text for p in _PAIRS):
        return False
    return not (any(c in text for c in _OTHER_BLANKS) and _RARE.search(text))


#: Encoded pieces that a worker keeps (some 60 bytes each); later ones are encoded anew.
CACHE = 1 << 21
#: Bytes of a piece that is looked up as two numbers, all those of a block at once; and of the longest one kept.
SHORT, LONG = 15, 64
#: Pieces looked up at a time.
BLOCK = 1 << 19
_LOW = np.array([(1 << 8 * min(n, 8)) - 1 for n in range(SHORT + 1)], np.uint64)
_HIGH = np.array([(1 << 8 * max(n - 8, 0)) - 1 for n in range(SHORT + 1)], np.uint64)
#: Letters and digits 1, punctuation 2, the two blanks 3 (of ASCII; other bytes 0).
_KIND = np.array([3 if c in " \n" else 1 if c.isalnum() else 2 if c.isprintable() else 0 for c in map(chr, range(128))] + 128 * [0], np.uint8)
_TOKENIZERS: dict[tuple, tuple] = {}


class Pieces:
    """The ids of the pieces that a worker keeps, and behind them those of the batch at hand.

    A short piece's key is its bytes and their number, in two words of 8 bytes, so
    equal keys are equal pieces. Short pieces are found by open addressing, as
    rows (key, key, value); longer ones are in a dictionary. A value is the place
    of the ids and, in the lower 32 bits, how many they are.
    """

    def __init__(self) -> None:
        self.slots = np.zeros((1 << 12, 3), np.uint64)
        self.long: dict[bytes, int] = {}
        self.ids, self.n_ids, self.n_short = np.zeros(1 << 14, "<u4"), 0, 0
        self.batch: list[str] = []

    def __len__(self) -> int:
        return self.n_short + len(self.long)

    def __iter__(self):
        """Every piece kept, with its ids."""
        short = ((np.array(r[:2], "<u8").tobytes()[:r[1] >> 56], r[2]) for r in self.slots[self.slots[:, 2] > 0].tolist())
        for piece, value in (*short, *self.long.items()):
            yield piece, self.ids[value >> 32:(value >> 32) + (value & 0xFFFFFFFF)].tobytes()

    def _home(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return (mix(low ^ mix(high)) & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The values of short pieces, 0 for unknown ones."""
        left, at, out = np.arange(len(low)), self._home(low, high), np.zeros(len(low), np.uint64)
        while len(left):
            rows = self.slots.take(at, axis=0)
            hit = (rows[:, 0] == low) & (rows[:, 1] == high)
            out[left[hit]] = rows[hit, 2]
            on = ~hit & (rows[:, 2] > 0)
            left, low, high, at = left[on], low[on], high[on], (at[on] + 1) & (len(self.slots) - 1)
        return out

    def add(self, rows: np.ndarray) -> None:
        """Keep different, unknown short pieces; at most half of all slots are taken."""
        self.n_short += len(rows)
        if 2 * self.n_short > len(self.slots):
            rows = np.concatenate([self.slots[self.slots[:, 2] > 0], rows])
            self.slots = np.zeros((1 << (2 * self.n_short - 1).bit_length(), 3), np.uint64)
        at = self._home(rows[:, 0], rows[:, 1])
        while len(rows):
            free = np.flatnonzero(self.slots[at, 2] == 0)
            self.slots[at[free], 2] = rows[free, 2]  # of several pieces on one slot, one stays
            won = free[self.slots[at[free], 2] == rows[free, 2]]
            self.slots[at[won]] = rows[won]
            on = np.ones(len(rows), bool)
            on[won] = False
            rows, at = rows[on], (at[on] + 1) & (len(self.slots) - 1)

    def hold(self, ids: np.ndarray) -> int:
        """Put ids behind those kept, for this batch or to be kept; returns their place."""
        if self.n_ids + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[:self.n_ids], np.zeros(self.n_ids + 2 * len(ids), "<u4")])
        self.ids[self.n_ids:self.n_ids + len(ids)] = ids
        return self.n_ids


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def load(path: str, special_as_text: bool = False):
    """The tokenizer of a file, the byte length of each id, and the worker's pieces for it; with
    `special_as_text`, special tokens' strings are ordinary text."""
    key = path, special_as_text
    if key not in _TOKENIZERS:
        import os

        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = Tokenizer.from_file(path)
        if special_as_text:
            tokenizer.encode_special_tokens = True
        vocabulary = tokenizer.get_vocab(with_added_tokens=False)
        lengths = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            lengths[i] = len(token)  # a byte-level vocabulary writes every byte as one character
        _TOKENIZERS[key] = (tokenizer, lengths, Pieces())
    return _TOKENIZERS[key]


def _whole(tokenizer, texts: list[str]) -> list[bytes]:
    return [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def _pieces(tokenizer, lengths: np.ndarray, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The pieces' ids one after another, and how many each has. Those that begin with a blank (none
    ends with one) are encoded many in a row: no token crosses, and the ids' byte lengths say which are whose."""
    counts, found = np.zeros(len(pieces), np.int64), []
    blank = np.array([p[:1] in (b" ", b"\n") for p in pieces], bool)
    rows = np.flatnonzero(blank)
    for i in range(0, len(rows), 4096):
        part = [pieces[k] for k in rows[i:i + 4096].tolist()]
        ids = np.frombuffer(_whole(tokenizer, [b"".join(part).decode()])[0], "<u4")
        cuts = np.searchsorted(np.cumsum(lengths[ids]), np.cumsum([len(p) for p in part])) + 1
        counts[rows[i:i + 4096]] = np.diff(cuts, prepend=0)
        found.append(ids)
    other = np.flatnonzero(~blank)
    for k, raw in zip(other.tolist(), _whole(tokenizer, [pieces[k].decode() for k in other.tolist()]), strict=True):
        counts[k] = len(raw) // 4
        found.append(np.frombuffer(raw, "<u4"))
    order = np.concatenate([rows, other])
    places = np.zeros(len(pieces), np.int64)
    places[order] = np.cumsum(counts[order]) - counts[order]
    return np.concatenate([*found, np.zeros(0, "<u4")]), (places.astype(np.uint64) << np.uint64(32)) | counts.astype(np.uint64)


def _starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces begin: with each text, blank, and ASCII punctuation behind an ASCII letter or digit."""
    kind = _KIND[data]
    begins = kind == 3
    begins[1:] |= (kind[1:] == 2) & (kind[:-1] == 1)
    begins[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.flatnonzero(begins)


def _block(tokenizer, lengths: np.ndarray, cache: Pieces, raw: bytes, starts: np.ndarray) -> tuple[np.ndarray, bytes]:
    """How many ids each piece of the bytes has, and all their ids."""
    sizes = np.diff(starts, append=len(raw))
    eights = np.ndarray(len(raw) + 8, "<u8", raw + bytes(15), strides=(1,))  # the 8 bytes from each place on
    short = np.flatnonzero(sizes <= SHORT)
    s, n = starts[short], sizes[short]
    low, high = eights[s] & _LOW[n], eights[s + 8] & _HIGH[n] | n.astype(np.uint64) << np.uint64(56)
    values = np.zeros(len(starts), np.uint64)
    values[short] = known = cache.find(low, high)

    unknown = np.flatnonzero(known == 0)
    unknown = unknown[np.lexsort((high[unknown], low[unknown]))]
    a, b = low[unknown], high[unknown]
    first = np.ones(len(unknown), bool)
    first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    at, to = s[unknown[first]], (s + n)[unknown[first]]
    new = [raw[i:j] for i, j in zip(at.tolist(), to.tolist(), strict=True)]
    long = {i: raw[starts[i]:starts[i] + sizes[i]] for i in np.flatnonzero(sizes > SHORT).tolist()}
    new_long = list({p for p in long.values() if p not in cache.long})
    ids, found = _pieces(tokenizer, lengths, new + new_long)
    found += np.uint64(cache.hold(ids)) << np.uint64(32)
    values[short[unknown]] = found[np.cumsum(first) - 1]
    held = dict(zip(new_long, found[len(new):].tolist(), strict=True))
    for i, piece in long.items():
        values[i] = held[piece] if piece in held else cache.long[piece]
    cache.batch += [p.decode().removeprefix(" ") for p in new + new_long]
    if len(cache) + len(new) + len(new_long) <= CACHE:
        cache.add(np.stack([a[first], b[first], found[:len(new)]], axis=1))
        cache.long.update((p, v) for p, v in held.items() if len(p) <= LONG)
        cache.n_ids += len(ids)

    counts = (values & np.uint64(0xFFFFFFFF)).astype(np.int64)
    ends = np.cumsum(counts)
    places = (values >> np.uint64(32)).astype(np.int64)
    return counts, cache.ids[np.arange(counts.sum()) + np.repeat(places - ends + counts, counts)].tobytes()


def _by_pieces(tokenizer, lengths: np.ndarray, cache: Pieces, texts: list[str]) -> list[bytes]:
    column = pa.array(texts, pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[:len(texts) + 1]
    raw = column.buffers()[2].to_pybytes()[:offsets[-1]] if offsets[-1] else b""
    starts = _starts(np.frombuffer(raw, np.uint8), offsets)
    cache.batch, counts, ids = [], [], []
    for i in range(0, len(starts), BLOCK):
        part = starts[i:i + BLOCK]
        to = starts[i + BLOCK] if i + BLOCK < len(starts) else len(raw)
        n, found = _block(tokenizer, lengths, cache, raw[part[0]:to], part - part[0])
        counts.append(n)
        ids.append(found)
    ends = np.concatenate([[0], *counts]).cumsum()
    out = b"".join(ids)
    cuts = (4 * ends[np.searchsorted(starts, offsets)]).tolist()
    return [out[i:j] for i, j in pairwise(cuts)]


def encode_all(path: str, texts: list[str]) -> list[bytes]:
    """Each text's ids as little-endian uint32, the same as encoding it whole.

    The vocabulary's splitting rule never joins a blank to what stands before
    it, nor punctuation to a letter or digit before it, so a text with single
    blanks falls apart in front of each space, line break and such punctuation,
    and each different piece needs the library only once. Texts that hold an
    added token's string are encoded whole.
    """
    tokenizer, lengths, cache = load(path)
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    whole = {i for i, text in enumerate(texts) if not _splits(text) or any(t in text for t in added)}
    split = [i for i in range(len(texts)) if i not in whole]
    out: list[bytes] = [b""] * len(texts)
    for rows, encoded in ((split, _by_pieces(tokenizer, lengths, cache, [texts[i] for i in split])),
                          (sorted(whole), _whole(tokenizer, [texts[i] for i in sorted(whole)]))):
        for i, ids in zip(rows, encoded, strict=True):
            out[i] = ids
    return out
