"""Texts as pieces between white space, and token ids remembered by piece, for tokenizers that drop white space.

Such a tokenizer never joins what stands on both sides of white space, so a text's ids are its pieces' ids in order, and
each distinct piece is encoded once per worker as long as the memory bound of the cache allows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import chain, filterfalse

import numpy as np
import regex

from lectio.llm.hashing import prefix, span

#: Unicode's White_Space (fixed values).
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WHITE = regex.compile(f"[{WHITE}]+")
#: What str.split() takes for white space and Unicode does not.
_ODD = regex.compile("[\x1c-\x1f]")


def split(text: str) -> list[str]:
    if _ODD.search(text):
        return [x for x in _WHITE.split(text) if x]
    return text.split()


class PieceCache:
    """ids of texts by way of their pieces. encode_pieces: list of pieces -> list of little-endian id bytes."""

    def __init__(self, encode_pieces: Callable[[list[str]], list[bytes]], most: int = 800_000):
        self.encode_pieces, self.most, self.known = encode_pieces, most, {}

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """One bytes of ids for each text. Of more than ``most`` pieces the cache keeps those of these texts alone."""
        split_texts = [split(x) for x in texts]
        new = list(set(filterfalse(self.known.__contains__, chain.from_iterable(split_texts))))
        if len(self.known) + len(new) > self.most:
            used = set().union(*split_texts).intersection(self.known)
            self.known = {x: self.known[x] for x in used}
        for i in range(0, len(new), 50_000):
            part = new[i : i + 50_000]
            self.known.update(zip(part, self.encode_pieces(part)))
        return [b"".join(map(self.known.__getitem__, x)) for x in split_texts]


def slices(texts: list[str], most_docs: int = 2000, most_chars: int = 2_000_000) -> Iterable[tuple[int, int]]:
    """(from, to) of runs of texts, short enough that memory stays bounded; a longer text is a run of its own."""
    begin = chars = 0
    for i, x in enumerate(texts):
        if i > begin and (i - begin >= most_docs or chars + len(x) > most_chars):
            yield begin, i
            begin, chars = i, 0
        chars += len(x)
    if begin < len(texts):
        yield begin, len(texts)


def id_type(size: int) -> np.dtype:
    return np.dtype("<u2" if size <= 1 << 16 else "<u4")


class PieceTable:
    """ids of texts by way of their pieces between ASCII white space, as sorted arrays: some 25 bytes a piece.

    A piece is known by a 64-bit hash of its bytes and length. encode_pieces: list of pieces -> list of id bytes. When more
    than ``most`` pieces are known, the table is emptied.
    """

    def __init__(self, encode_pieces: Callable[[list[str]], list[bytes]], kind: np.dtype, most: int = 2_000_000):
        self.encode_pieces, self.kind, self.most = encode_pieces, kind, most
        self.clear()

    def clear(self) -> None:
        none = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.old, self.new = none, none  # sorted hashes, where the ids begin, how many; the newest apart, so that few rows move
        self.ids, self.used = np.zeros(1 << 20, self.kind), 0

    @staticmethod
    def _merge(a: tuple, b: tuple) -> tuple:
        order = np.argsort(np.concatenate([a[0], b[0]]), kind="stable")
        return tuple(np.concatenate([x, y])[order] for x, y in zip(a, b))

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(where, how many, known) for each hash."""
        where, many, known = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int32), np.zeros(len(hashes), bool)
        for names, begin, count in (self.old, self.new):
            if len(names):
                at = np.minimum(np.searchsorted(names, hashes), len(names) - 1)
                hit = names[at] == hashes
                where, many, known = np.where(hit, begin[at], where), np.where(hit, count[at], many), known | hit
        return where, many, known

    def _learn(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        coded = []
        for i in range(0, len(pieces), 20_000):
            coded += self.encode_pieces([x.decode() for x in pieces[i : i + 20_000]])
        many = np.array([len(x) // self.kind.itemsize for x in coded], np.int32)
        data = np.frombuffer(b"".join(coded), self.kind)
        if self.used + len(data) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(max(len(self.ids) // 2, 2 * len(data)), self.kind)])
        self.ids[self.used : self.used + len(data)] = data
        order = np.argsort(hashes)
        self.new = self._merge(self.new, (hashes[order], (self.used + np.cumsum(many) - many)[order], many[order]))
        self.used += len(data)
        if len(self.new[0]) > 200_000:
            self.old, self.new = self._merge(self.old, self.new), tuple(x[:0] for x in self.new)

    def encode(self, texts: list[str]) -> list[bytes]:
        data = [x.encode() for x in texts]
        raw = b" ".join([*data, b""])
        seen = np.frombuffer(raw, np.uint8)
        gap = np.concatenate([[True], (seen == 32) | ((seen >= 9) & (seen <= 13)), [True]])
        edge = np.flatnonzero(gap[1:] != gap[:-1])
        start, stop = edge[::2], edge[1::2]
        hashes = span(prefix(seen), start, stop)
        if len(self.old[0]) + len(self.new[0]) > self.most:
            self.clear()
        names, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        where, many, known = self._find(names)
        if not known.all():
            fresh = np.flatnonzero(~known)
            self._learn(names[fresh], [raw[a:b] for a, b in zip(start[first[fresh]].tolist(), stop[first[fresh]].tolist())])
            where, many, _ = self._find(names)
        where, many = where[inverse], many[inverse].astype(np.int64)
        ends = np.cumsum(many)
        flat = self.ids[np.repeat(where - (ends - many), many) + np.arange(int(ends[-1]) if len(ends) else 0)]
        last = np.searchsorted(start, np.cumsum([len(x) + 1 for x in data]))  # pieces before the end of each text
        cuts = np.append(0, ends)[last] * self.kind.itemsize
        body = flat.tobytes()
        return [body[a:b] for a, b in zip([0, *cuts[:-1].tolist()], cuts.tolist())]
