"""Line dedup by a segment-partition edit join.

The edits that two lines may be apart grow with the shorter one's length. Of two lines within e edits, the longer one holds
at least one of the shorter one's e + 1 segments, at nearly the same place. Every distinct line enters its segments in an
index keyed by segment, place and length, and probes the index with the substrings that such a neighbour's segments could
be, as far as a filter of all indexed keys has them. What meets there is compared by counts of letters and pairs of them,
then verified with a banded bit-parallel edit distance. Lengths and edits are those of code points.

A line goes as soon as one earlier line is near enough, so a line first asks the few lines before it that share a key; only
those that find none ask all the others. A large group of near copies costs its size, not its square.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectio.llm.common import forget, keep_nothing, lean, row_name, small_batches, stored, table, texts
from lectio.llm.hashing import gathered, mix, powers, scatter
from lectio.llm.pieces import slices


@dataclass(frozen=True)
class Limits:
    """Two lines are the same when at most so many edits apart: one for each ``every`` code points of the shorter one, ``least``
    at least and ``most`` at most. Lines of fewer than ``min_bytes`` bytes (stripped) are never removed."""

    least: int = 1
    every: int = 20
    most: int = 4
    min_bytes: int = 20

    def allowed(self, size: np.ndarray) -> np.ndarray:
        """How many edits a line may be away from one of so many code points that is not longer."""
        return np.clip(size // self.every, self.least, self.most)


#: Bits of the filters of keys, the bound on what is broadcast; each key has two. A fuller filter passes more records; it
#: loses none.
FILTER_BITS, FILTER_PARTS = 27, 256
#: Of each of the first rounds: the lines before it, in the order of a key, that a line may ask, and how many of all its keys
#: it asks. Lines of a key that are put in order at once. What is left out here is asked in the end.
ASKED, CELL = [(1, 2, 2), (1, 8, 4)], 4096
#: Code points that are compared at once, a bound of memory alone.
COMPARED = 1_000_000
#: Characters of the texts that are cut up at once, lines that a task remembers having seen, and keys that it gathers before
#: it sends their bits: bounds of memory alone.
RUN_CHARS, SEEN, GATHERED = 500_000, 200_000, 1_000_000
#: Lines that may be broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: What a line may lose at its ends when its length is judged.
ENDS = " \t\n\r\x0b\x0c"
_UP, _DOWN = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_TABLES: dict[str, np.ndarray] = {}


def _lines(said: list[str], min_bytes: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(text number, line number, bytes) of each line that is long enough; a line keeps its white space."""
    doc, number, data = [], [], []
    for i, x in enumerate(said):
        for k, line in enumerate(x.encode().split(b"\n")):
            if len(line) >= min_bytes and len(line.strip()) >= min_bytes:
                doc.append(i)
                number.append(k)
                data.append(line)
    return np.array(doc, np.int64), np.array(number, np.int32), data


def _names(data: list[bytes]) -> np.ndarray:
    """128 bits for each line, as two numbers."""
    return np.frombuffer(b"".join(hashlib.blake2b(x, digest_size=16).digest() for x in data), "<i8").reshape(-1, 2)


class _Fresh:
    """Lines that this task has not seen, as far as it remembers; one that comes again only costs time."""

    def __init__(self) -> None:
        self.seen: set[int] = set()

    def of(self, data: list[bytes], names: np.ndarray) -> list[bytes]:
        if len(self.seen) > SEEN:
            self.seen.clear()
        return [x for x, name in zip(data, names[:, 0].tolist()) if name not in self.seen and not self.seen.add(name)]


def _few(table: DataFrame) -> DataFrame:
    """A stored table, broadcast when its size allows."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


#: Four bits for a count modulo 8, so that the bits in which two differ are how far apart they are, the shorter way round.
_CYCLE = np.array([0b0000, 0b0001, 0b0011, 0b0111, 0b1111, 0b1110, 0b1100, 0b1000], np.uint64)


def signatures(raw: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Twelve words for each line: its code points counted in 64 classes (see _CYCLE), and which of 512 classes of two neighbours
    it has. One edit changes at most two counts by one, and takes away or adds at most two pairs of neighbours."""
    n = len(sizes)
    line = np.repeat(np.arange(n), sizes)
    kind = (mix(raw.astype(np.uint64)) & np.uint64(63)).astype(np.int64)
    counts = np.bincount(line * 64 + kind, minlength=64 * n).reshape(n, 4, 16) & 7
    letters = (_CYCLE[counts] << (np.arange(16, dtype=np.uint64) * np.uint64(4))).sum(2, dtype=np.uint64)
    inside = np.flatnonzero(line[1:] == line[:-1])
    pair = (mix((raw[inside].astype(np.uint64) << np.uint64(32)) | raw[inside + 1]) & np.uint64(511)).astype(np.int64)
    has_pair = np.zeros(n * 512, bool)
    has_pair[line[inside] * 512 + pair] = True
    return np.concatenate([letters, np.packbits(has_pair, bitorder="little").view("<u8").reshape(n, 8)], 1)


def may_be_near(a: Column, b: Column, edits: Column) -> Column:
    """Whether two signatures (arrays of twelve words) are not further apart than so many edits can take them."""
    word = lambda x, k: F.get(x, F.lit(k))
    total = lambda f, ks: reduce(Column.__add__, (F.bit_count(f(k)) for k in ks))
    letters = total(lambda k: word(a, k).bitwiseXOR(word(b, k)), range(4))
    gone = total(lambda k: word(a, k).bitwiseAND(F.bitwise_not(word(b, k))), range(4, 12))
    new = total(lambda k: word(b, k).bitwiseAND(F.bitwise_not(word(a, k))), range(4, 12))
    return (letters <= 2 * edits) & (gone <= 2 * edits) & (new <= 2 * edits)


def segments(size: np.ndarray, k: int, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, length) of segment k of ``edits`` + 1 even ones, the longer ones last."""
    short, longer = size // (edits + 1), size % (edits + 1)
    plain = edits + 1 - longer
    return k * short + np.maximum(k - plain, 0), short + (k >= plain)


def _point_values(raw: np.ndarray) -> np.ndarray:
    """An odd random number for each code point."""
    if "points" not in _TABLES:
        _TABLES["points"] = mix(np.arange(1 << 16, dtype=np.uint64)) | np.uint64(1)
    out = _TABLES["points"][raw & np.uint32(0xFFFF)]
    rare = np.flatnonzero(raw > 0xFFFF)
    out[rare] = mix(raw[rare].astype(np.uint64)) | np.uint64(1)
    return out


def _scales(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_TABLES.get("up", ())) < n:
        _TABLES["up"], _TABLES["down"] = powers(_UP, n), powers(_DOWN, n)
    return _TABLES["up"][:n], _TABLES["down"][:n]


def keys_of(data: list[bytes], limits: Limits, bits: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, int, bool]]:
    """(line number, key, edits, whether a probe) of the index records of lines, and with a filter of their keys of the probes
    that may meet one of another line.

    Equal keys are an equal substring, segment number and indexed length. A probe with a line's own segments is left out:
    it would be the index record once more.
    """
    joined = b"".join(data)
    raw = np.frombuffer(joined.decode().encode("utf-32-le"), "<u4")
    begins = np.cumsum([0] + [len(x) for x in data])[:-1]
    sizes = np.add.reduceat((np.frombuffer(joined, np.uint8) & 0xC0 != 0x80).astype(np.int64), begins)
    begin = np.cumsum(sizes) - sizes
    up, down = _scales(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_point_values(raw) * up[: len(raw)], out=sums[1:])

    def key(which: np.ndarray, start: np.ndarray, length: np.ndarray, k: int, of: np.ndarray) -> np.ndarray:
        at = begin[which] + start
        return mix((sums[at + length] - sums[at]) * down[at] + np.uint64((k + 1) * 0x9FB21C651E98DF25 % (1 << 64)) + of.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))

    for edits in range(limits.least, limits.most + 1):
        for less in range(edits + 1 if bits is not None else 1):  # partners of the same length or up to ``edits`` shorter
            near = np.flatnonzero(limits.allowed(sizes - less) == edits)
            of = sizes[near] - less
            for k in range(edits + 1):
                start, length = segments(of, k, edits)
                if not less:
                    yield near, key(near, start, length, k, of), edits, False
                for shift in range(-k, k + 1) if bits is not None else ():
                    # at most k edits before the segment's place and edits - k after it
                    if abs(shift - less) <= edits - k and (shift or less):
                        fits = np.flatnonzero((start + shift >= 0) & (start + shift + length <= sizes[near]))
                        found = key(near[fits], start[fits] + shift, length[fits], k, of[fits])
                        hit = has(bits, found)
                        yield near[fits][hit], found[hit], edits, True


def slots(key: np.ndarray, second: bool = False) -> np.ndarray:
    """Where one of a key's two bits stands."""
    return ((key >> np.uint64(8 if second else 64 - FILTER_BITS)) & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)


def has(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether a filter may hold each key."""
    at = slots(key)
    found = (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
    some = np.flatnonzero(found)
    at = slots(key[some], True)
    found[some] = bits[at >> 3] >> (at & 7).astype(np.uint8) & 1
    return found


def _filter(*sources: tuple[DataFrame, str]) -> np.ndarray:
    """The filter of stored (part, a column with its share of the bits): bits that any of the sources has."""
    bits = np.zeros((FILTER_PARTS, 1 << (FILTER_BITS - FILTER_PARTS.bit_length() - 2)), np.uint8)
    for parts, column in sources:
        for r in parts.select("part", column).toLocalIterator():
            bits[r["part"]] |= np.frombuffer(r[column], np.uint8)
    return bits.reshape(-1)


def _merged(slotted: DataFrame, name: str) -> DataFrame:
    """(part, blob: slots, the highest bit for those that came twice) -> stored (part, once, twice): bits of slots that came,
    and of those that came more than once."""
    each = FILTER_BITS - FILTER_PARTS.bit_length() + 1

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, blobs in gathered(batches):
            times = np.zeros(1 << each, np.uint8)
            for x in blobs:
                x = np.frombuffer(x, "<u4")
                at = (x & np.uint32(0x7FFFFFFF)).astype(np.int64) & ((1 << each) - 1)
                times[at] = np.minimum(times[at] + 1 + (x >> np.uint32(31)).astype(np.uint8), 2)
            packed = [np.packbits(times >= n, bitorder="little").tobytes() for n in (1, 2)]
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array(packed[:1], pa.binary()), pa.array(packed[1:], pa.binary())], ["part", "once", "twice"])

    parts = int(slotted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored(slotted.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(lean(merge), "part int, once binary, twice binary"), name)


def _slotted(keys: list[np.ndarray]) -> list[tuple[int, bytes]]:
    """(part, its slots) of keys, for _merged()."""
    found, times = np.unique(np.concatenate(keys or [np.zeros(0, np.uint64)]), return_counts=True)
    at = np.concatenate([slots(found), slots(found, True)])
    order = np.argsort(at, kind="stable")
    at, more = at[order], np.tile(times, 2)[order]
    starts = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else np.zeros(0, np.int64)
    twice = np.add.reduceat(more, starts) > 1 if len(at) else np.zeros(0, bool)
    each = FILTER_BITS - FILTER_PARTS.bit_length() + 1
    return list(scatter(at[starts] >> each, (at[starts] | (twice.astype(np.int64) << 31)).astype("<u4")))


def line_table(docs: DataFrame, limits: Limits) -> DataFrame:
    """documents -> a row for each line: doc_id, name (of the row), line_no, one, two (the line's name); and rows of slots of
    index keys: part, blob."""
    rows = texts(docs).select("doc_id", row_name().alias("name"), "text")
    kinds = [("doc_id", None), ("name", pa.int64()), ("line_no", pa.int32()), ("one", pa.int64()), ("two", pa.int64()), ("part", pa.int32()), ("blob", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh, held = _Fresh(), []
        keep_nothing()
        none = lambda kind, n: pa.nulls(n, kind or rows_type)

        def bits() -> pa.RecordBatch:
            blobs = _slotted(held)
            held.clear()
            return pa.RecordBatch.from_arrays([*(none(k, len(blobs)) for _, k in kinds[:5]), pa.array([k for k, _ in blobs], pa.int32()), pa.array([x for _, x in blobs], pa.binary())], [n for n, _ in kinds])

        for batch in batches:
            said, rows_type = batch.column(2).to_pylist(), batch.column(0).type
            for a, b in slices(said, most_chars=RUN_CHARS):
                doc, number, data = _lines(said[a:b], limits.min_bytes)
                names, at = _names(data), pa.array(doc + a)
                found = [batch.column(0).take(at), batch.column(1).take(at), pa.array(number), pa.array(names[:, 0]), pa.array(names[:, 1])]
                yield pa.RecordBatch.from_arrays([*found, *(none(k, len(doc)) for _, k in kinds[5:])], [n for n, _ in kinds])
                new = fresh.of(data, names)
                held += [key for _, key, _, _ in keys_of(new, limits)] if new else []
            if sum(map(len, held)) > GATHERED:
                yield bits()
        if held:
            yield bits()

    return rows.mapInArrow(lean(run), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, name long, line_no int, one long, two long, part int, blob binary")


def record_table(docs: DataFrame, limits: Limits, indexed: DataFrame) -> DataFrame:
    """documents and the filter of index keys -> stored line, keys, edits, probe (arrays of a batch's records), and part, blob:
    the slots of its probes."""
    shared = docs.sparkSession.sparkContext.broadcast(_filter((indexed, "once")))
    kind = pa.schema([("line", pa.binary()), ("key", pa.binary()), ("edits", pa.binary()), ("probe", pa.binary()), ("part", pa.int32()), ("blob", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh, probed = _Fresh(), []
        keep_nothing()

        def bits() -> pa.RecordBatch:
            blobs = _slotted(probed)
            probed.clear()
            return pa.RecordBatch.from_arrays([*(pa.nulls(len(blobs), pa.binary()) for _ in range(4)), pa.array([k for k, _ in blobs], pa.int32()), pa.array([x for _, x in blobs], pa.binary())], schema=kind)

        for batch in batches:
            said = batch.column(0).to_pylist()
            for a, b in slices(said, most_chars=RUN_CHARS):
                data = _lines(said[a:b], limits.min_bytes)[2]
                new = fresh.of(data, _names(data))
                if not new:
                    continue
                lines, found = _names(new)[:, 0], list(keys_of(new, limits, shared.value))
                probed += [key for _, key, _, probe in found if probe]
                columns = [lines[np.concatenate([x[0] for x in found])], np.concatenate([x[1] for x in found]), *(np.repeat(np.array([x[c] for x in found], np.uint8), [len(x[0]) for x in found]) for c in (2, 3))]
                yield pa.RecordBatch.from_arrays([*(pa.array([c.tobytes()], pa.binary()) for c in columns), pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary())], schema=kind)
            if sum(map(len, probed)) > GATHERED:
                yield bits()
        if probed:
            yield bits()

    with small_batches(docs.sparkSession):
        found = stored(texts(docs).select("text").mapInArrow(lean(run), "line binary, key binary, edits binary, probe binary, part int, blob binary"), "records")
    shared.destroy()
    return found


def meeting_records(records: DataFrame, indexed: DataFrame) -> DataFrame:
    """Records -> stored key, line, edits, index: those whose key another line may have too, each line once for a key."""
    probed = _merged(records.filter("part is not null").select("part", "blob"), "probed")
    shared = records.sparkSession.sparkContext.broadcast(_filter((indexed, "twice"), (probed, "once")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for line, key, edits, probe in zip(*(batch.column(c).to_pylist() for c in range(4))):
                line, key, edits, probe = np.frombuffer(line, "<i8"), np.frombuffer(key, "<u8"), np.frombuffer(edits, np.uint8), np.frombuffer(probe, np.uint8)
                keep = np.flatnonzero((probe == 1) | has(shared.value, key))
                yield pa.RecordBatch.from_arrays([pa.array(key[keep].view("<i8")), pa.array(line[keep]), pa.array(edits[keep].astype(np.int32)), pa.array(probe[keep] == 0)], ["key", "line", "edits", "index"])

    found = records.filter("part is null").select("line", "key", "edits", "probe").mapInArrow(lean(run), "key long, line long, edits int, index boolean")
    found = stored(found.groupBy("key", "line").agg(F.first("edits").alias("edits"), F.max("index").alias("index")), "meeting")
    shared.destroy()
    many = found.groupBy("key").agg(F.count("*").alias("many"), F.max("index").alias("any")).filter("many > 1 and any").select("key", "many")
    found, old = stored(found.join(many, "key"), "shared-keys"), found
    forget(old, probed)
    return found


def line_texts(docs: DataFrame, limits: Limits, wanted: DataFrame) -> DataFrame:
    """documents and wanted (line, at: doc_id, name, line_no of its first place) -> stored line, at, letters, text."""
    small = F.broadcast if wanted.count() <= BROADCAST_ROWS else lambda df: df
    few = wanted.select(F.col("at.name").alias("name"), F.col("at.line_no").alias("line_no"), "line")
    rows = texts(docs).select(row_name().alias("name"), "text").join(small(few.select("name").distinct()), "name", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said = batch.column(1).to_pylist()
            for a, b in slices(said, most_chars=RUN_CHARS):
                doc, number, data = _lines(said[a:b], limits.min_bytes)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc + a)), pa.array(number), pa.array(_names(data)[:, 0]), pa.array(data, pa.binary())], ["name", "line_no", "line", "said"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said = [x.decode() for x in batch.column(1).to_pylist()]
            raw = np.frombuffer("".join(said).encode("utf-32-le"), "<u4")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(signatures(raw, np.array([len(x) for x in said], np.int64)).view(np.int64)), pa.list_(pa.int64())), pa.array(said, pa.string())], ["line", "letters", "text"])

    found = rows.mapInArrow(lean(run), "name long, line_no int, line long, said binary").join(small(few), ["name", "line_no", "line"], "left_semi").select("line", "said")
    found = found.mapInArrow(lean(count), "line long, letters array<long>, text string")
    with small_batches(docs.sparkSession):
        return stored(found.dropDuplicates(["line"]).join(wanted, "line").select("line", "at", "letters", "text"), "line-texts")


def near_pairs(pairs: DataFrame, known: DataFrame, limits: Limits) -> DataFrame:
    """Pairs (line, other) -> stored line of those that are near enough, once each."""
    both = pairs
    for c in ("line", "other"):
        both = both.join(known.select(F.col("line").alias(c), F.col("text").alias(f"{c}_text")), c)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (batch.column(c).to_pylist() for c in (1, 2))
            edits = limits.allowed(np.array([min(len(x), len(y)) for x, y in zip(one, two)], np.int64))
            for most in range(limits.least, limits.most + 1):
                order = sorted(np.flatnonzero(edits == most).tolist(), key=lambda i: max(len(one[i]), len(two[i])))
                while order:
                    # as many as fit with the longest of them
                    n = next((n for n in range(1, min(1024, len(order))) if (n + 1) * len(one[order[n]]) > COMPARED), min(1024, len(order)))
                    some, order = order[:n], order[n:]
                    ok = within([one[i] for i in some], [two[i] for i in some], most)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([i for i, good in zip(some, ok) if good], pa.int64()))], ["line"])

    return stored(both.select("line", "line_text", "other_text").mapInArrow(lean(verify), "line long").distinct(), "near")


def within(one: list[bytes] | list[str], two: list[bytes] | list[str], most: int) -> np.ndarray:
    """Whether each pair is at most ``most`` edits apart: banded bit-parallel distance, all pairs a column at a time.

    A column's vertical differences stand in the bits of one word, the band's 2 * most + 1 diagonals; the band moves down
    by one row a column, and the score is that of its lowest diagonal.
    """
    one, two = ([x if isinstance(x, str) else x.decode() for x in s] for s in (one, two))
    a, b = [x if len(x) >= len(y) else y for x, y in zip(one, two)], [y if len(x) >= len(y) else x for x, y in zip(one, two)]
    la, lb = (np.array([len(x) for x in s], np.int64) for s in (a, b))
    result = la - lb <= most
    if not len(a):
        return result
    wide = int(la.max()) + 2 * most + 2
    rows = np.full((len(a), wide), 0x110000, np.uint32)
    columns = np.full((len(b), int(lb.max()) + 1), 0x110001, np.uint32)
    for i, (x, y) in enumerate(zip(a, b)):
        rows[i, most : most + len(x)] = np.frombuffer(x.encode("utf-32-le"), "<u4")
        columns[i, : len(y)] = np.frombuffer(y.encode("utf-32-le"), "<u4")
    band = 2 * most + 1
    full = np.uint64((1 << band) - 1)
    one_bit = np.uint64(1)
    # bit d of a column j is row j - most + d; before the first column rows above 0 are walls of falling cost
    vp = np.full(len(a), ((1 << band) - 1) & ~((1 << most) - 1), np.uint64) & full
    vn = np.zeros(len(a), np.uint64)
    score = np.full(len(a), most, np.int64)  # of the lowest diagonal: row j + most
    last = np.where(lb == 0, la, 0)  # with nothing in the shorter one the distance is the other's length
    final = np.where(lb == 0, last, most + 1)
    for j in range(int(lb.max())):
        eq = np.zeros(len(a), np.uint64)
        for d in range(band):
            eq |= (rows[:, j + d] == columns[:, j]).astype(np.uint64) << np.uint64(d)
        x = eq | vn
        d0 = ((((x & vp) + vp) ^ vp) | x) & full
        hp = (vn | ~(d0 | vp)) & full
        hn = d0 & vp
        score = score + (((d0 >> np.uint64(band - 1)) & one_bit) == 0)
        x = d0 >> one_bit
        vp = (hn | ~(x | hp)) & full
        vn = x & hp & full
        ended = np.flatnonzero(lb == j + 1)
        if len(ended):
            # from the lowest row up to the last row of a; the words are those of the band one row further down
            s = score[ended].copy()
            up = (lb[ended] + most - la[ended]).astype(np.int64)
            for k in range(most + 1):
                bit = np.uint64(band - 2 - k)
                go = up > k
                s -= go * ((vp[ended] >> bit) & one_bit).astype(np.int64)
                s += go * ((vn[ended] >> bit) & one_bit).astype(np.int64)
            final[ended] = s
    return result & (final <= most)


def near_earlier(docs: DataFrame, limits: Limits, lines: DataFrame, indexed: DataFrame) -> DataFrame:
    """lines (one, two, at: a place) -> line: those with a different earlier line near enough."""
    records = record_table(docs, limits, indexed)
    meeting = meeting_records(records, indexed)
    forget(records)
    met = stored(meeting.select("line").distinct(), "met")
    wanted = stored(lines.select(F.col("one").alias("line"), "at").join(_few(met), "line").groupBy("line").agg(F.min("at").alias("at")), "wanted")
    known = line_texts(docs, limits, wanted)
    rows = stored(meeting.join(known, "line"), "asking")
    forget(meeting, met, wanted)
    gone = tested = None
    for turn, (nearest, furthest, most) in enumerate(ASKED):
        cell = F.pmod(F.xxhash64("line", F.lit(turn)), F.ceil(F.col("many") / CELL))
        before = W.partitionBy("key", "cell").orderBy("at", "line").rowsBetween(-furthest, -nearest)
        asked = rows.withColumn("cell", cell).withColumn("others", F.collect_list(F.struct(F.col("line").alias("other"), F.col("letters").alias("with"))).over(before))
        asked = asked if gone is None else asked.join(gone, "line", "left_anti")
        near = F.filter("others", lambda o: may_be_near(F.col("letters"), o["with"], F.col("edits")))
        asked = asked.select("line", F.transform(near, lambda o: o["other"]).alias("others")).filter(F.size("others") > 0)
        listed = asked.groupBy("line").agg(F.array_distinct(F.flatten(F.collect_list("others"))).alias("others"))
        if tested is not None:
            asked_before = tested.groupBy("line").agg(F.collect_set("other").alias("before"))
            listed = listed.join(asked_before, "line", "left").select("line", F.array_except("others", F.coalesce("before", F.array().cast("array<bigint>"))).alias("others"))
        pairs = listed.select("line", F.explode(F.slice("others", 1, most)).alias("other"))
        pairs = stored(pairs, "pairs")
        new = near_pairs(pairs, known, limits)
        gone, tested = (new, pairs) if gone is None else (gone.unionByName(new), tested.unionByName(pairs))
    # what has found none asks all earlier lines of its keys; a probe and a probe have no segment in common. Most lines of a group
    # of near copies are near by their letters alone, so the distance is part of what joins them, and only near pairs are rows.
    # The askers of a key are dealt to cells, each of which meets all the others
    cells = F.ceil(F.col("many") / CELL).cast("int")
    u = rows.join(gone, "line", "left_anti").withColumn("cell", F.pmod(F.xxhash64("line"), cells).cast("int")).select("key", "cell", "line", "at", "letters", "text", "edits", "index")
    v = rows.withColumn("cell", F.explode(F.sequence(F.lit(0), cells - 1))).select("key", "cell", *(F.col(c).alias(f"v_{c}") for c in ("line", "at", "letters", "text", "index")))
    meets = (F.col("v_at") < F.col("at")) & (F.col("index") | F.col("v_index")) & may_be_near(F.col("letters"), F.col("v_letters"), F.col("edits")) & F.expr("levenshtein(text, v_text, edits) >= 0")
    rest = u.join(v, ["key", "cell"]).filter(meets).select("line", F.col("v_line").alias("other")).distinct()
    rest = stored(rest.join(tested, ["line", "other"], "left_anti"), "pairs")
    return gone.unionByName(near_pairs(rest, known, limits)).distinct()


def removed_lines(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """documents -> name (of a row), line_nos: the lines of which an earlier one is near enough.

    Earlier is by doc_id (null first), then by a hash of doc_id and text, then by line number, whether or not the earlier line
    is removed itself. Rows with equal or null ids are documents of their own; equal rows share a name.
    """
    with small_batches(docs.sparkSession):
        lines = stored(line_table(docs, limits), "lines")
    indexed = _merged(lines.filter("part is not null").select("part", "blob"), "indexed")
    lines = lines.filter("part is null").select(F.struct("doc_id", "name", "line_no").alias("at"), "one", "two")
    near = stored(near_earlier(docs, limits, lines, indexed).select(F.col("line").alias("one"), F.lit(True).alias("near")), "near")
    # a line goes at all its places if an earlier one is near, else at all but the first if it has several
    several = lines.groupBy("one", "two").agg(F.count("*").alias("n")).filter("n > 1").select("one", "two")
    several = stored(several.join(near, "one", "left_anti"), "several")
    first = stored(lines.join(_few(several), ["one", "two"]).groupBy("one", "two").agg(F.min("at").alias("stays")), "firsts")
    places = lines.join(_few(near), "one").select("at").unionByName(lines.join(_few(first), ["one", "two"]).filter(~F.col("at").eqNullSafe(F.col("stays"))).select("at"))
    return places.groupBy("at.name").agg(F.collect_set("at.line_no").alias("line_nos"))


def with_lines_left(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """documents -> row (all columns), left (the text's lines that stay, joined by newlines), n_lines, n_removed.

    A null text is one empty line. Lines that are shorter than limits.min_bytes without outer white space stay, as do first
    ones. Of repeated rows (doc_id and text) the first keeps its lines; the others lose all that are long enough. Columns may
    have any names.
    """
    text = F.coalesce("text", F.lit(""))
    gone = stored(removed_lines(docs.select("doc_id", "text"), limits), "removed")
    twice = stored(docs.select(F.xxhash64("doc_id", text).alias("name"), text.alias("text")).filter(F.octet_length("text") >= limits.min_bytes).groupBy("name").agg(F.count("*").alias("n")).filter("n > 1").select("name"), "twice")
    rows = docs.select(F.struct("*").alias("row"), text.alias("said"), F.xxhash64("doc_id", text).alias("name"))
    again = bool(twice.take(1))
    if again:
        gone = gone.join(twice.withColumn("twice", F.lit(True)), "name", "full_outer")
    joined = rows.join(gone.hint("merge"), "name", "left")
    touched = F.col("line_nos").isNotNull() | F.col("twice") if again else F.col("line_nos").isNotNull()
    joined = joined.withColumn("parts", F.when(touched, F.split("said", "\n", -1)))
    stay = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("line_nos"))
    kept = F.when(F.col("line_nos").isNull(), F.col("said")).otherwise(F.array_join(F.transform(stay, lambda i: F.get("parts", i)), "\n"))
    n_lines = F.length("said") - F.length(F.replace("said", F.lit("\n"), F.lit(""))) + 1
    result = lambda df, left, removed: df.select("row", left.alias("left"), n_lines.cast("long").alias("n_lines"), removed.cast("long").alias("n_removed"))
    removed = F.when(F.col("line_nos").isNull(), 0).otherwise(F.size("line_nos"))
    if not again:
        return result(joined, kept, removed)
    # repeated rows stand side by side already; only these are numbered
    copies = joined.filter("twice").withColumn("nth", F.row_number().over(W.partitionBy("name").orderBy("name")))
    short = F.filter("parts", lambda x: F.octet_length(F.btrim(x, F.lit(ENDS))) < limits.min_bytes)
    parts = [result(joined.filter("twice is null"), kept, removed), result(copies.filter("nth = 1"), kept, removed), result(copies.filter("nth > 1"), F.array_join(short, "\n"), F.size("parts") - F.size(short))]
    return reduce(DataFrame.unionByName, parts)


def without_lines(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """documents -> the same columns with text (the lines that are left), and n_lines, n_removed; columns of these names are
    replaced. See with_lines_left()."""
    found = with_lines_left(docs, limits)
    own = [F.col("left").alias("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns if c not in ("n_lines", "n_removed")]
    return found.select(*own, "n_lines", "n_removed")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_sha256."""
    return without_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
