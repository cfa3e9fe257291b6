"""Byte-pair encoding by a pair occurrence index, and decoding.

All new words of a run of documents stand in one array of symbols. An index maps each adjacent pair that has a merge rank
to all its positions; the active ranks are applied in ascending order, each to all positions at once, and only the lists
of the pairs next to a merge change.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectio.llm.common import kept, table, texts
from lectio.llm.pieces import WHITE, PieceCache, slices


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes themselves, others from 256 on."""
    shown = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


def unknown_parts(spec: dict) -> list[str]:
    """What a file asks for beyond what BPE does: NFC, white space to one space, lower case; words by one pattern, as bytes; merges
    with a word's end marked; no decoder; added tokens taken wherever they stand."""
    model, steps = spec["model"], lambda part, key: [(x or {}) for x in ((spec[part] or {}).get(key) or [])]
    normal, split = steps("normalizer", "normalizers"), steps("pre_tokenizer", "pretokenizers")
    plain = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "byte_fallback": False, "ignore_merges": False}
    as_expected = {
        "model": all(model.get(k, v) == v for k, v in plain.items()) and bool(model.get("end_of_word_suffix")),
        "normalizer": [x["type"] for x in normal] == ["NFC", "Replace", "Lowercase"] and (normal[1]["pattern"], normal[1]["content"]) == ({"Regex": r"\s+"}, " "),
        "pre_tokenizer": [x["type"] for x in split] == ["Split", "ByteLevel"] and "Regex" in split[0]["pattern"] and (split[0]["behavior"], split[0]["invert"]) == ("Removed", True) and not split[1]["add_prefix_space"] and not split[1]["use_regex"],
        "decoder": spec.get("decoder") is None,
        "added_tokens": not any(x.get(k) for x in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")),
    }
    return [part for part, ok in as_expected.items() if not ok]


class BPE:
    """A word-end BPE vocabulary (the JSON file of the tokenizers library; NFC, lower case, white space dropped). A file that asks
    for anything else is refused, as its ids would be wrong."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if odd := unknown_parts(spec):
            raise ValueError(f"this file's {', '.join(odd)} are of a kind that is not done here")
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        names = vocab | self.special
        self.names = [""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.names[i] = name
        letters = byte_letters()
        self.inner = np.array([vocab[x] for x in letters], np.int64)
        self.final = np.array([vocab[x + suffix] for x in letters], np.int64)
        pairs = [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in model["merges"]]
        self.left = np.array([vocab[a] for a, _ in pairs], np.int64)
        self.right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        made_first = np.full(len(self.names), -1)
        made_first[self.made[::-1]] = np.arange(len(pairs))[::-1]
        if (np.maximum(made_first[self.left], made_first[self.right]) > np.arange(len(pairs))).any():
            raise ValueError("merges must come after those that make their parts: only then may all positions of a pair be merged at once")
        keys = self.left << 32 | self.right
        self.by_key = np.argsort(keys)
        self.keys = keys[self.by_key]
        split_on = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"[^\s", f"[^{WHITE}")
        self.word = regex.compile(split_on)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The merge rank of each pair, -1 without one."""
        keys = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.by_key[at], -1)

    def words(self, piece: str) -> list[str]:
        # a capital sigma is lowered by itself, as the library does, whatever follows
        return self.word.findall(unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower())

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """ids of each word (not empty)."""
        data = np.frombuffer(b"".join(words), np.uint8)
        sizes = np.array([len(x) for x in words], np.int64)
        ends = np.cumsum(sizes)
        sym = self.inner[data]
        sym[ends - 1] = self.final[data[ends - 1]]
        n = len(sym)
        # position n is a wall: words end before it and begin after it
        nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)
        nxt[ends - 1] = n
        prv[ends - sizes] = n
        sym, nxt, prv = np.append(sym, -1), np.append(nxt, n), np.append(prv, n)
        alive = np.ones(n + 1, bool)
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def add(at: np.ndarray) -> None:
            """Enter the pairs that begin at these positions."""
            at = at[nxt[at] < n]
            r = self.ranks(sym[at], sym[nxt[at]])
            at, r = at[r >= 0], r[r >= 0]
            if not len(r):
                return
            order = np.argsort(r, kind="stable")
            at, r = at[order], r[order]
            cuts = np.flatnonzero(np.diff(r)) + 1
            for rank, where in zip(r[np.append(0, cuts)].tolist(), np.split(at, cuts)):
                if rank in index:
                    index[rank].append(where)
                else:
                    index[rank] = [where]
                    heapq.heappush(heap, rank)

        add(np.arange(n))
        while heap:
            rank = heapq.heappop(heap)
            lists = index.pop(rank)
            at = np.unique(np.concatenate(lists)) if len(lists) > 1 else lists[0]
            a, b = self.left[rank], self.right[rank]
            at = at[alive[at] & (sym[at] == a)]
            at = at[sym[nxt[at]] == b]
            if a == b and len(at) > 1:  # of overlapping pairs the left one wins
                taken, keep = -1, []
                for p, q in zip(at.tolist(), nxt[at].tolist()):
                    if p != taken:
                        keep.append(p)
                        taken = q
                at = np.array(keep, np.int64)
            if not len(at):
                continue
            gone = nxt[at]
            after = nxt[gone]
            sym[at] = self.made[rank]
            alive[gone] = False
            nxt[at] = after
            prv[after] = at
            prv[n] = n
            before = prv[at]
            add(np.unique(np.concatenate([before[before < n], at])))
        left = np.flatnonzero(alive[:n])
        return np.split(sym[left], np.searchsorted(left, ends[:-1]))

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each piece, strings of special tokens included."""
        plan = []
        for x in pieces:
            parts = self.marks.split(x) if self.marks and self.marks.search(x) else [x]
            plan.append([p if p in self.special else self.words(p) for p in parts])
        new = list(dict.fromkeys(w for parts in plan for p in parts if isinstance(p, list) for w in p))
        known = {w: x.astype("<i4").tobytes() for w, x in zip(new, self.merge([w.encode() for w in new]))} if new else {}
        return [b"".join(np.array([self.special[p]], "<i4").tobytes() if isinstance(p, str) else b"".join(map(known.__getitem__, p)) for p in parts) for parts in plan]

    def decode(self, ids: np.ndarray) -> str:
        """What the library's decode() gives without a decoder: the tokens, special ones too, joined by one space."""
        return " ".join(map(self.names.__getitem__, ids.tolist()))


def _coder(path: str) -> tuple[BPE, PieceCache]:
    def make() -> tuple[BPE, PieceCache]:
        bpe = BPE(path)
        return bpe, PieceCache(bpe.encode_pieces, 500_000)

    return kept(f"bpe {path}", make)


def encode_decode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """documents -> doc_id, ids (array of int), decoded (text). A null or empty text has no ids and decodes to an empty text.

    Each row is encoded by itself: repeated rows and ids, and null ids, give rows of their own. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, cache = _coder(vocabulary)
        for batch in batches:
            said = batch.column(1).to_pylist()
            for a, b in slices(said, most_chars=8_000_000):
                ids = [np.frombuffer(x, "<i4") for x in cache.encode(said[a:b])]
                for c in range(0, len(ids), 500):
                    some = ids[c : c + 500]
                    offsets = np.cumsum([0, *map(len, some)]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(a + c, len(some)), pa.ListArray.from_arrays(offsets, np.concatenate(some)), pa.array([bpe.decode(x) for x in some], pa.string())], ["doc_id", "ids", "decoded"])

    rows = texts(docs)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded string")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> doc_id, n_tokens, ids_sha256, decoded_sha256. Null texts, equal and null ids: see encode_decode()."""
    import public_tokenizers

    return digest(encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


def digest(coded: DataFrame) -> DataFrame:
    """encode_decode() rows -> doc_id, n_tokens, ids_sha256, decoded_sha256: a row each, those of empty texts with no ids."""
    said = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(said, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
