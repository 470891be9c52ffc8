"""Token ids of whole texts with a public tokenizer's file of word-end BPE, by slices of an Arrow batch.

Words of ASCII and Latin-1 letters, digits and punctuation (all that most texts hold) are split and merged here: the distinct pieces of a slice
together, each merge step one numpy pass over all of them, with the file's own ranks. A word with anything else (apostrophes, other
scripts, combining marks, the names of special tokens) goes to the tokenizers library whole. No rule of the file looks across white space, so
the ids of a text are those of its words one after another; tests hold them against the library's for whole texts.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .words import _LOWER, _SPACE, U, _powers, is_huge, mix, parts, slices

#: A cache of pieces that each worker keeps: slots, and ids after which it starts anew.
SLOTS, KEPT_IDS = 19, 1 << 21
#: Longer pieces go to the library.
LONGEST = 40
NONE = np.int32(2**31 - 1)
_LETTER, _DIGIT, _MARK, _ODD = 1, 2, 3, 4
_CLASS = np.full(256, _ODD, np.uint8)
_CLASS[33:127] = _MARK
_CLASS[[ord("'"), ord("<")]] = _ODD
_CLASS[48:58] = _DIGIT
_CLASS[65:91] = _CLASS[97:123] = _LETTER
_CLASS[_SPACE] = 0
_coders: dict[str, Coder] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_symbols() -> list[str]:
    """Byte-level BPE's public alphabet: printable bytes stand for themselves, the others for code points from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return [chr(b if b in plain else next(other)) for b in range(256)]


class Coder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        symbols = _byte_symbols()
        self._inner = np.array([vocab[s] for s in symbols], np.int32)
        self._last = np.array([vocab[s + end] for s in symbols], np.int32)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right, joined = (np.array([vocab[x] for x in xs], np.int64) for xs in ([m[0] for m in merges], [m[1] for m in merges], ["".join(m) for m in merges]))
        self._joined = np.append(joined, -1).astype(np.int32)
        self._pair = np.append(left << 20 | right, -1)
        # two tables: pairs whose slot in the first is taken have one in the second
        self._first = self._table(np.arange(len(merges)), 0x9E3779B97F4A7C15)
        lost = np.flatnonzero(self._first[self._slot(self._pair[:-1], 0x9E3779B97F4A7C15)] != np.arange(len(merges)))
        tries = (int(x) | 1 for x in mix(np.arange(1000, dtype=U)))
        self._factor = next(f for f in tries if len(set(self._slot(self._pair[lost], f).tolist())) == len(lost))
        self._second = self._table(lost, self._factor)
        self._forget()

    @staticmethod
    def _slot(pair: np.ndarray, factor: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((pair.astype(U) * U(factor)) >> U(44)).astype(np.int64)

    def _table(self, which: np.ndarray, factor: int) -> np.ndarray:
        out = np.full(1 << 20, len(self._pair) - 1, np.int32)
        out[self._slot(self._pair[which], factor)[::-1]] = which[::-1]
        return out

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pair = left.astype(np.int64) << 20 | right
        a = self._first[self._slot(pair, 0x9E3779B97F4A7C15)]
        b = self._second[self._slot(pair, self._factor)]
        return np.where(self._pair[a] == pair, a, np.where(self._pair[b] == pair, b, NONE))

    def _merged(self, symbols: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of n symbols each, merged as long as a pair of theirs has a rank, lowest first, then leftmost."""
        rows, width = symbols.shape
        out, size = symbols.copy(), n.copy()
        at = np.arange(rows)
        column = np.arange(width)
        rank = np.full((rows, width), NONE, np.int32)
        if width > 1:
            inside = column[None, 1:] < n[:, None]
            r, c = np.nonzero(inside)
            rank[r, c] = self._rank(symbols[r, c], symbols[r, c + 1])
        while len(at):
            best = rank.argmin(axis=1)
            i = np.arange(len(at))
            top = rank[i, best]
            live = top != NONE
            if not live.all():
                out[at[~live]], size[at[~live]] = symbols[~live], n[~live]
                at, symbols, n, rank, best, top = at[live], symbols[live], n[live], rank[live], best[live], top[live]
                if not len(at):
                    break
                i = np.arange(len(at))
            symbols[i, best] = self._joined[top]
            source = np.minimum(column[None, :] + (column[None, :] > best[:, None]), width - 1)
            symbols = np.take_along_axis(symbols, source, 1)
            rank = np.take_along_axis(rank, np.minimum(column[None, :] + (column[None, :] >= best[:, None]), width - 1), 1)
            n = n - 1
            rank[i, n - 1] = NONE
            has = best < n - 1
            k, b = i[has], best[has]
            rank[k, b] = self._rank(symbols[k, b], symbols[k, b + 1])
            has = best > 0
            k, b = i[has], best[has]
            rank[k, b - 1] = self._rank(symbols[k, b - 1], symbols[k, b])
        return out, size

    def _forget(self) -> None:
        self._hash = np.zeros(1 << SLOTS, U)
        self._place = np.zeros(1 << SLOTS, np.int64)  # begin << 32 | n
        self._ids, self._used = np.zeros(1 << 20, np.int32), 0

    def _store(self, ids: np.ndarray) -> int:
        while self._used + len(ids) > len(self._ids):
            self._ids = np.concatenate([self._ids, np.zeros_like(self._ids)])
        at = self._used
        self._ids[at : at + len(ids)] = ids
        self._used += len(ids)
        return at

    def _learn(self, low: np.ndarray, raw: np.ndarray, start: np.ndarray, end: np.ndarray, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of pieces lie in the store, and how many."""
        size = end - start
        begin, n = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        library = odd | (size > LONGEST)
        for lo, hi in ((1, 4), (5, 8), (9, 12), (13, 18), (19, LONGEST)):
            which = np.flatnonzero(~library & (size >= lo) & (size <= hi))
            if not len(which):
                continue
            m = size[which]
            where = np.minimum(start[which][:, None] + np.arange(hi)[None, :], len(low) - 1)
            symbols = self._inner[low[where]]
            i = np.arange(len(which))
            symbols[i, m - 1] = self._last[low[end[which] - 1]]
            symbols, m = self._merged(symbols, m.astype(np.int64))
            flat = symbols[np.arange(symbols.shape[1])[None, :] < m[:, None]]
            begin[which], n[which] = self._store(flat) + np.cumsum(m) - m, m
        which = np.flatnonzero(library)
        if len(which):
            words = [raw[start[k] : end[k]].tobytes().decode("utf-8", "replace") for k in which]
            encode = getattr(self._library, "encode_batch_fast", self._library.encode_batch)
            for k, e in zip(which, encode(words, add_special_tokens=False), strict=True):
                ids = np.array(e.ids, np.int32)
                begin[k], n[k] = self._store(ids), len(ids)
        return begin, n

    def encode(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a slice (its bytes, and where each text starts), and where each text's begin and the last one's end."""
        size, rows = len(raw), len(at) - 1
        if not size:
            return np.zeros(0, np.uint32), np.zeros(rows + 1, np.int64)
        kind = _CLASS[raw]
        low = _LOWER[raw]
        lead = np.flatnonzero(raw[:-1] == 0xC3)
        if len(lead):
            second = raw[lead + 1]
            letter = (second >= 0x80) & (second <= 0xBF) & (second != 0x97) & (second != 0xB7)
            lead, second = lead[letter], second[letter]
            kind[lead] = kind[lead + 1] = _LETTER
            low[lead + 1] = np.where(second < 0x9F, second + 0x20, second)
        new = np.zeros(size + 1, bool)
        new[at] = True
        gap = kind == 0
        before = np.concatenate([[True], gap[:-1]]) | new[:-1]
        after = np.concatenate([gap[1:], [True]]) | new[1:]
        start, end = np.flatnonzero(~gap & before), np.flatnonzero(~gap & after) + 1
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(rows + 1, np.int64)
        odd = np.concatenate([[0], np.cumsum(kind == _ODD)])
        odd = odd[end] > odd[start]
        cut = np.concatenate([[True], (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)])
        if odd.any():
            edge = np.zeros(size + 1, np.int8)
            edge[start[odd]] += 1
            edge[end[odd]] -= 1
            inside = np.cumsum(edge[:-1]) > 0
            cut &= ~inside
            low = np.where(inside, raw, low)
        piece = np.flatnonzero(~gap & (cut | before))
        word = np.searchsorted(start, piece, "right") - 1
        stop = np.minimum(np.append(piece[1:], size), end[word])
        power, inverse = _powers(size + 1)
        with np.errstate(over="ignore"):
            sums = np.zeros(size + 1, U)
            np.cumsum((low.astype(U) + U(1)) * power[:size], out=sums[1:])
            key = mix((sums[stop] - sums[piece]) * inverse[piece] + (stop - piece).astype(U) * U(0xD6E8FEB86659FD93) + odd[word].astype(U)) | U(1)
        if self._used > KEPT_IDS:
            self._forget()
        slot = (key >> U(64 - SLOTS)).astype(np.int64)
        place = self._place[slot]
        miss = np.flatnonzero(self._hash[slot] != key)
        if len(miss):
            new_key, first, back = np.unique(key[miss], return_index=True, return_inverse=True)
            f = miss[first]
            begin, n = self._learn(low, raw, piece[f], stop[f], odd[word[f]])
            found = begin << 32 | n
            place[miss] = found[back]
            slot = (new_key >> U(64 - SLOTS)).astype(np.int64)
            self._hash[slot], self._place[slot] = new_key, found
        begin, n = place >> 32, place & (1 << 32) - 1
        ends = np.cumsum(n)
        where = np.repeat(begin - (ends - n), n) + np.arange(ends[-1])
        pieces = np.searchsorted(piece, at)
        return self._ids[where].astype(np.uint32), np.concatenate([[0], ends])[pieces]


def coder(path: str) -> Coder:
    if path not in _coders:
        _coders[path] = Coder(path)
    return _coders[path]


def encoded(texts: pa.Array, path: str, end: int | None = 1) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, ids of each text of a slice), each followed by the id that ends a document; null texts have no other."""
    tail = np.array([] if end is None else [end], np.uint32)
    for lo, hi, data, begins in slices(texts):
        if is_huge(data, begins):
            ids = np.concatenate([coder(path).encode(data[a:b], np.array([0, b - a]))[0] for a, b in parts(data)])
            at = np.array([0, len(ids)])
        else:
            ids, at = coder(path).encode(data, begins)
        yield lo, [np.concatenate([ids[at[i] : at[i + 1]], tail]) for i in range(hi - lo)]
