"""N-gram Jaccard join: all documents whose sets of word shingles are alike, and their groups.

Documents with the same set are one node. Shingles are ordered from rare to frequent: those that occur once, then the
others, the most frequent last; two sets that reach the threshold share a shingle among the first of each (the prefix).
A tile holds the nodes of one size band that have a prefix shingle in common; a set probes its own band and the one
below, so only sizes that can reach the threshold meet. Within a tile, sizes, places in the prefixes and the bit counts of
hashed bitmaps bound the overlap from above; a bitmap's length follows the size. What passes is decided by exact
intersection of the sorted sets. Some rounds compare only neighbours of different components in a tile, in several orders;
then all that is still apart is compared, so that copies, which soon are one component, cost no square.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectio.llm.common import forget, keep_nothing, lean, row_name, stored, table, texts
from lectio.llm.components import components
from lectio.llm.hashing import gathered, mix, powers, prefix, scatter, span
from lectio.llm.pieces import slices

WORDS = 5
#: Alike when 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Bits of the filter of shingles that occur more than once, and the most entries of the table of frequent ones; both are
#: bounds on what is broadcast, whatever the input. A fuller filter passes more shingles; it never loses one.
FILTER_BITS, FREQUENT = 27, 1 << 20
#: Longs of the short bitmap that travels with the rows of a tile, close for sets of some hundred shingles; of the bitmap of
#: a node there are as many as give SPREAD bits for each of its shingles.
LONGS, SPREAD = 8, 4
#: Rounds of neighbours before all that is still apart is compared, and how many nodes of a tile are put in order at once.
ROUNDS, CELL = 3, 4096
#: Shingles are told apart by frequency from so many occurrences on.
LEAST = 6
#: Counts from here on are tallied as one: what goes to the driver to find the least count of a frequent shingle.
TALLIES = 1 << 16
#: Sets that a task remembers having put out; one that is put out again only costs time.
SEEN = 500_000
MAP = [f"b{k}" for k in range(LONGS)]
#: Nodes that may be broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def _edges() -> np.ndarray:
    """The least sizes of the bands. A set and a larger one that may be alike are in the same band or in neighbouring ones."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, -(-100 * out[-1] // PERCENT)))
    return np.array(out, np.int64)


EDGES = _edges()


def shingle_sets(data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct 64-bit shingle hashes of all documents one after the other, size of each document's set).

    Words are runs without ASCII white space, A-Z lower-cased. With 1 to 4 words the whole sequence is one shingle.
    """
    raw = np.frombuffer(b" ".join([*data, b""]).lower(), np.uint8)
    ends = np.cumsum([len(x) + 1 for x in data])
    gap = np.concatenate([[True], (raw == 32) | ((raw >= 9) & (raw <= 13)), [True]])
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    start, stop = edge[::2], edge[1::2]
    words = span(prefix(raw), start, stop)
    n_words = np.diff(np.searchsorted(start, ends), prepend=0)
    first = np.cumsum(n_words) - n_words
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(data), np.int64)
    scale = powers(np.uint64(0xC2B2AE3D27D4EB4F), WORDS)
    sums = np.zeros(max(0, n - WORDS + 1), np.uint64)
    for j in range(WORDS):
        sums += words[j : n - WORDS + 1 + j] * scale[j]
    doc = np.repeat(np.arange(len(data)), np.maximum(n_words - WORDS + 1, 0))
    inside = np.arange(len(doc)) - np.repeat(np.cumsum(np.maximum(n_words - WORDS + 1, 0)) - np.maximum(n_words - WORDS + 1, 0), np.maximum(n_words - WORDS + 1, 0))
    hashes = mix(sums[first[doc] + inside])
    few = np.flatnonzero((n_words > 0) & (n_words < WORDS))
    short = [mix(np.uint64(int(n_words[i])) + (words[first[i] : first[i] + n_words[i]] * scale[: n_words[i]]).sum(keepdims=True))[0] for i in few]
    doc, hashes = np.concatenate([doc, few]), np.concatenate([hashes, np.array(short, np.uint64)])
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    keep = np.ones(len(doc), bool)
    keep[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    return hashes[keep], np.bincount(doc[keep], minlength=len(data))


def _sets(said: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from, to, hashes, sizes) of runs of texts."""
    for a, b in slices(said, 2000, 2_000_000):
        yield a, b, *shingle_sets([x.encode() for x in said[a:b]])


def _set_keys(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Two 64-bit keys of each set: sums of two functions of its elements (0 for an empty one)."""
    ends = np.cumsum(sizes)
    out = []
    for salt in (0x165667B19E3779F9, 0x27D4EB2F165667C5):
        sums = np.append(np.uint64(0), np.cumsum(mix(hashes ^ np.uint64(salt))))
        out.append(mix(sums[ends] - sums[ends - sizes]))
    return np.stack(out, 1).view(np.int64)


def bitmaps(hashes: np.ndarray, sizes: np.ndarray, longs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit numbers of all sets' bitmaps one after the other, where each ends); ``longs`` are powers of two."""
    ends = np.cumsum(longs)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
    bit = hashes & np.repeat((64 * longs - 1).astype(np.uint64), sizes)
    np.bitwise_or.at(out, np.repeat(ends - longs, sizes) + (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    return out, ends


def map_longs(sizes: np.ndarray) -> np.ndarray:
    """Longs of a node's bitmap: the power of two from SPREAD bits a shingle on, at least 4."""
    want = np.maximum(-(-SPREAD * sizes // 64), 4)
    return np.int64(1) << np.ceil(np.log2(want)).astype(np.int64)


def most_in_common(n1: int, n2: int, one: np.ndarray, two: np.ndarray) -> int:
    """A bound of the intersection of two sets by their bitmaps: a bit of one alone stands for an element of it alone."""
    while len(one) > len(two):
        one = one[: len(one) // 2] | one[len(one) // 2 :]
    while len(two) > len(one):
        two = two[: len(two) // 2] | two[len(two) // 2 :]
    return min(n1 - int(np.bitwise_count(one & ~two).sum()), n2 - int(np.bitwise_count(two & ~one).sum()))


def node_table(docs: DataFrame) -> DataFrame:
    """documents -> doc_id, name (of the row), n_shingles, node, map (the set's hashed bitmap): the same set, the same node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, hashes, sizes in _sets(batch.column(2).to_pylist()):
                keys, (maps, ends) = _set_keys(hashes, sizes)[:, 0], bitmaps(hashes, sizes, map_longs(sizes))
                raw, cuts = maps.tobytes(), (8 * ends).tolist()
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(sizes.astype(np.int64)), pa.array(keys), pa.array([raw[i:j] for i, j in zip([0, *cuts[:-1]], cuts)], pa.binary())], ["doc_id", "name", "n_shingles", "node", "map"])

    rows = texts(docs).select("doc_id", row_name().alias("name"), "text")
    return rows.mapInArrow(lean(run), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, name long, n_shingles long, node long, map binary")


def frequencies(docs: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bit filter of shingles that occur in more than one set of a task's documents or in several tasks,
    sorted codes of the most frequent shingles, their counts).

    A code is the upper half of a shingle's hash. Counts are over all documents: each task sends its distinct codes, sorted,
    to the buckets of their range; a bucket's counts are exact for its codes.
    """
    buckets = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_nothing()
        for batch in batches:
            held, seen = [], set()
            for _, _, hashes, sizes in _sets(batch.column(1).to_pylist()):
                keys = _set_keys(hashes, sizes)[:, 0].tolist()
                new = np.array([not (k in seen or seen.add(k)) for k in keys], bool)
                held.append((hashes[np.repeat(new, sizes)] >> np.uint64(32)).astype(np.uint32))
            codes, counts = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
            bucket = (codes.astype(np.uint64) * np.uint64(buckets)) >> np.uint64(32)
            record = np.zeros(len(codes), [("step", "<u4"), ("count", "u1")])
            # steps between codes are small numbers, which compress
            record["step"] = np.diff(codes, prepend=np.uint32(0))
            record["count"] = np.minimum(counts, 255)
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            starts = np.append(0, cuts) if len(codes) else cuts
            record["step"][starts] = codes[starts]
            blobs = list(scatter(bucket, record))
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in blobs], pa.int32()), pa.array([record_bytes(x) for _, x in blobs], pa.binary())], ["bucket", "blob"])

    def record_bytes(blob: bytes) -> bytes:
        x = np.frombuffer(blob, [("step", "<u4"), ("count", "u1")])
        return x["step"].tobytes() + x["count"].tobytes()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, blobs in gathered(batches):
            parts = []
            for x in blobs:
                n = len(x) // 5
                parts.append((np.cumsum(np.frombuffer(x, "<u4", n), dtype=np.uint32), np.frombuffer(x, "u1", n, 4 * n)))
            codes, counts = np.concatenate([c for c, _ in parts]), np.concatenate([k for _, k in parts]).astype(np.int64)
            order = np.argsort(codes, kind="stable")
            codes, counts = codes[order], counts[order]
            starts = np.flatnonzero(np.append(True, np.diff(codes) != 0))
            total = np.add.reduceat(counts, starts)
            more = total > 1
            slots = np.unique(codes[starts][more] >> np.uint32(32 - FILTER_BITS))
            often = total >= LEAST
            yield pa.RecordBatch.from_arrays([pa.array([slots.tobytes()], pa.binary()), pa.array([codes[starts][often].tobytes()], pa.binary()), pa.array([total[often].tobytes()], pa.binary()), pa.array([int(total.sum())], pa.int64())], ["slots", "codes", "counts", "total"])

    found = texts(docs).mapInArrow(lean(count), "bucket int, blob binary").repartition(buckets // 4, "bucket").sortWithinPartitions("bucket").mapInArrow(lean(merge), "slots binary, codes binary, counts binary, total long")
    found = stored(found, "frequencies")
    bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for r in found.select("slots").toLocalIterator():
        slots = np.frombuffer(r["slots"], np.uint32)
        np.bitwise_or.at(bits, slots >> 3, np.uint8(1) << (slots & 7).astype(np.uint8))
    total = found.agg(F.sum("total")).first()[0] or 0

    def tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How many codes have each count, at most TALLIES different ones."""
        for batch in batches:
            for x in batch.column(0).to_pylist():
                count, n = np.unique(np.minimum(np.frombuffer(x, np.int64), TALLIES - 1), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(count), pa.array(n.astype(np.int64))], ["count", "n"])

    # the least count from which there are at most FREQUENT codes; the table of tallies is as long as the counts go
    tally = np.zeros(TALLIES, np.int64)
    for r in found.select("counts").mapInArrow(tallied, "count long, n long").groupBy("count").agg(F.sum("n").alias("n")).collect():
        tally[r["count"]] = r["n"]
    above = np.cumsum(tally[::-1])[::-1]
    least = max(LEAST, int(np.argmax(above <= FREQUENT)), total // FREQUENT + 1 if above[-1] > FREQUENT else 0)

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                c, k = np.frombuffer(c, np.uint32), np.frombuffer(k, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([c[k >= least].tobytes()], pa.binary()), pa.array([k[k >= least].tobytes()], pa.binary())], ["codes", "counts"])

    # at most FREQUENT of them, so 12 MB
    codes, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
    for r in found.select("codes", "counts").mapInArrow(frequent, "codes binary, counts binary").toLocalIterator():
        codes.append(np.frombuffer(r["codes"], np.uint32))
        counts.append(np.frombuffer(r["counts"], np.int64))
    forget(found)
    codes, counts = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(codes)
    return bits, codes[order], counts[order]


def prefix_length(sizes: np.ndarray) -> np.ndarray:
    """How many of a set's first shingles one that is alike must meet."""
    return sizes - (PERCENT * sizes + 99) // 100 + 1


def low_prefix_length(sizes: np.ndarray) -> np.ndarray:
    """The same for a set that is not the larger one of the two: then more must be common."""
    return sizes - -(-2 * PERCENT * sizes // (100 + PERCENT)) + 1


def prefix_rows(docs: DataFrame, known: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """documents -> shingle, node, n, band, place, low, b0 ...: prefix shingles that others may share.

    place: how many of the set's shingles come before it; low: whether it is in the shorter prefix too; b0 ...: the short
    bitmap. A set is put out once by a task, as far as it remembers, and by each task that has it.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(known)
    small = pa.schema([("shingle", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("band", pa.int32()), ("place", pa.int32()), ("low", pa.bool_()), *((c, pa.int64()) for c in MAP)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, codes, counts = shared.value
        seen: set[int] = set()
        for batch in batches:
            if len(seen) > SEEN:
                seen.clear()
            for _, _, hashes, sizes in _sets(batch.column(1).to_pylist()):
                if not len(hashes):
                    continue
                keys = _set_keys(hashes, sizes)[:, 0]
                new = np.array([not (k in seen or seen.add(k)) for k in keys.tolist()], bool) & (sizes > 0)
                hashes, sizes, keys = hashes[np.repeat(new, sizes)], sizes[new], keys[new]
                code = (hashes >> np.uint64(32)).astype(np.uint32)
                slot = code >> np.uint32(32 - FILTER_BITS)
                rank = ((bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1).astype(np.int64)
                if len(codes):
                    at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
                    rank = np.where(codes[at] == code, counts[at] + 1, rank)
                doc = np.repeat(np.arange(len(sizes)), sizes)
                first = np.repeat(np.cumsum(sizes) - sizes, sizes)
                order = np.lexsort((hashes, rank, doc))
                place = np.arange(len(doc)) - first  # lexsort keeps the documents in their order
                keep = (place < prefix_length(sizes)[doc]) & (rank[order] > 0)
                take, place, doc = order[keep], place[keep], doc[keep]
                maps = bitmaps(hashes, sizes, np.full(len(sizes), LONGS, np.int64))[0].reshape(-1, LONGS).view(np.int64)
                band = (np.searchsorted(EDGES, sizes, "right") - 1).astype(np.int32)
                columns = [hashes[take].view(np.int64), keys[doc], sizes[doc].astype(np.int32), band[doc], place.astype(np.int32), place < low_prefix_length(sizes)[doc], *(maps[doc, k] for k in range(LONGS))]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, small)], schema=small)

    found = stored(texts(docs).mapInArrow(lean(run), "shingle long, node long, n int, band int, place int, low boolean, " + ", ".join(f"{c} long" for c in MAP)), "prefixes")
    shared.destroy()
    return found


def enough(common: Column, n1: Column, n2: Column) -> Column:
    return 100 * common >= PERCENT * (n1 + n2 - common)


def may_reach(n1: Column, n2: Column, one: list[Column], two: list[Column]) -> Column:
    """False only if sizes or bit counts rule the threshold out."""
    only = lambda xs, ys: reduce(Column.__add__, (F.bit_count(x.bitwiseAND(F.bitwise_not(y))) for x, y in zip(xs, ys)))
    return enough(F.least(n1 - only(one, two), n2 - only(two, one)), n1, n2)


def _few(wanted: DataFrame) -> DataFrame:
    """A stored table, broadcast when its size allows."""
    return F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted


def _sided(pairs: DataFrame, side: DataFrame, *columns: str) -> DataFrame:
    """pairs (a, b) with columns of both nodes: a_<column>, b_<column>."""
    for n in "ab":
        pairs = pairs.join(side.select(F.col("node").alias(n), *(F.col(c).alias(f"{n}_{c}") for c in columns)), n)
    return pairs.select("a", "b", *(f"{n}_{c}" for c in columns for n in "ab"))


def bounded(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Candidate pairs (a, b) of nodes less those that the bit counts of the nodes' own bitmaps rule out."""
    wanted = stored(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "wanted")
    side = sets.join(_few(wanted), "node", "left_semi")

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for n1, n2, one, two in zip(*(batch.column(c).to_pylist() for c in (2, 3, 4, 5))):
                most = most_in_common(n1, n2, np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64))
                keep.append(100 * most >= PERCENT * (n1 + n2 - most))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    found = stored(_sided(pairs, side, "n", "map").mapInArrow(lean(test), "a long, b long"), "bounded")
    forget(wanted)
    return found


def verified(pairs: DataFrame, docs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes -> those that reach the threshold, by intersection of the sorted sets."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = stored(wanted.join(sets.select("node", "name"), "node"), "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, hashes, sizes in _sets(batch.column(1).to_pylist()):
                keys, ends = _set_keys(hashes, sizes)[:, 0], np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array([hashes[e - n : e].tobytes() for e, n in zip(ends, sizes)], pa.binary())], ["node", "shingles"])

    # the row of a node's name stands for it; repeated rows have the same name and set
    rows = texts(docs).select(row_name().alias("name"), "text").join(_few(wanted.select("name")), "name", "left_semi")
    each = rows.mapInArrow(lean(run), "node long, shingles binary").groupBy("node").agg(F.first("shingles").alias("shingles"))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
                at = np.minimum(np.searchsorted(x, y), len(x) - 1)
                common = int((x[at] == y).sum())
                keep.append(100 * common >= PERCENT * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    each = stored(each, "sets")
    found = stored(_sided(pairs, each, "shingles").mapInArrow(lean(decide), "a long, b long"), "verified")
    forget(wanted, each)
    return found


def apart(tiles: DataFrame, found: DataFrame) -> DataFrame:
    """tiles with part (a node's component, or itself), of the shingles whose nodes are not all in one component."""
    split = tiles.join(found.select("node", F.col("component").alias("part")), "node", "left").withColumn("part", F.coalesce("part", "node"))
    mixed = split.groupBy("shingle").agg(F.min("part").alias("p"), F.max("part").alias("q")).filter("p <> q").select("shingle")
    return split.join(mixed, "shingle", "left_semi")


def neighbours(rows: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) of each node and the next one of its shingle that is in another component, at most one for each row, less
    what sizes and bit counts rule out. The order is by size at first, then by hashes; the nodes of a frequent shingle are
    dealt to cells by a hash, other ones in each round."""
    cell = F.pmod(F.xxhash64("node", F.lit(turn)), F.ceil(F.col("many") / CELL)).alias("cell")
    by = [F.col("n"), F.col("node")] if not turn else [F.xxhash64("node", F.lit(-turn)), F.col("node")]
    tile = W.partitionBy("shingle", "cell")
    rows = rows.withColumn("cell", cell)
    begins = F.coalesce(F.col("part") != F.lag("part").over(tile.orderBy(*by)), F.lit(True))
    marked = rows.withColumn("entry", F.when(begins, F.struct("node", "n", *MAP)))
    backward = tile.orderBy(*(c.desc() for c in by)).rowsBetween(W.unboundedPreceding, -1)
    near = marked.withColumn("other", F.last("entry", ignorenulls=True).over(backward)).filter("other is not null")
    test = may_reach(F.col("n"), F.col("other.n"), [F.col(c) for c in MAP], [F.col(f"other.{c}") for c in MAP])
    return near.filter(test).select(F.least("node", "other.node").alias("a"), F.greatest("node", "other.node").alias("b")).distinct()


def all_apart(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of all nodes in different components that meet in a tile and are not ruled out.

    The key is shingle and band: the smaller set stands in its own, the larger one probes its own and the one below. Of each
    shingle the nodes of the component that has the most are only probed by the others, never by each other.
    """
    count = rows.groupBy("shingle", "part").agg(F.count("*").alias("many_of_part"))
    major = count.groupBy("shingle").agg(F.max_by("part", F.struct("many_of_part", "part")).alias("major"))
    rows = rows.join(major, "shingle").withColumn("minor", F.col("part") != F.col("major"))
    columns = ["node", "n", "part", "place", *MAP]
    shown = lambda df, n, band: df.select("shingle", band.alias("band"), F.struct(*columns).alias(n))
    own, probed = F.col("band"), F.explode(F.array(F.col("band"), F.col("band") - 1))
    x, y = F.col("x"), F.col("y")
    order = F.struct(y["n"].alias("n"), y["node"].alias("node")) < F.struct(x["n"].alias("n"), x["node"].alias("node"))
    sized = (x["part"] != y["part"]) & order & (100 * y["n"] >= PERCENT * x["n"])
    # of the first common shingle of two sets, all that is common stands behind it or is it
    placed = enough(F.least(x["n"] - x["place"], y["n"] - y["place"]), x["n"], y["n"])
    test = may_reach(x["n"], y["n"], [x[c] for c in MAP], [y[c] for c in MAP])
    small = shown(rows.filter("minor and low"), "y", own).join(shown(rows, "x", probed), ["shingle", "band"])
    large = shown(rows.filter("minor"), "x", probed).join(shown(rows.filter("low and not minor"), "y", own), ["shingle", "band"])
    pairs = small.filter(sized & placed & test).unionByName(large.filter(sized & placed & test))
    return pairs.select(F.least(x["node"], y["node"]).alias("a"), F.greatest(x["node"], y["node"]).alias("b")).distinct()


def grouped(docs: DataFrame) -> DataFrame:
    """documents -> doc_id, name, n_shingles, component: of linked rows the same number, null for rows without a shingle.

    A null text has no shingles and, like an empty one, is linked with nothing. Every row is a node's, whatever its id: rows
    with null or equal ids are linked by their texts alone.
    """
    nodes = stored(node_table(docs), "nodes")
    sets = stored(nodes.filter("n_shingles > 0").groupBy("node").agg(F.min("name").alias("name"), F.first("n_shingles").alias("n"), F.first("map").alias("map")), "sets")
    known = frequencies(docs)
    first = prefix_rows(docs, known)
    del known
    rows = first.groupBy("shingle", "node").agg(*(F.first(c).alias(c) for c in first.columns[2:]))
    crowd = first.groupBy("shingle").agg(F.count("*").alias("many"), F.min("node").alias("p"), F.max("node").alias("q")).filter("p <> q").select("shingle", "many")
    tiles = stored(rows.join(crowd, "shingle"), "tiles")
    forget(first)
    links = nodes.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    tested, found = links, links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    for turn in range(ROUNDS):
        pairs = stored(neighbours(apart(tiles, found), turn).join(tested, ["a", "b"], "left_anti"), "pairs")
        near = bounded(pairs, sets)
        new = verified(near, docs, sets)
        forget(near)
        links, tested = links.unionByName(new), tested.unionByName(pairs)
        if not new.take(1):
            break
        found = stored(components(links), "components")
    rest = stored(all_apart(stored(apart(tiles, found), "apart")).join(tested, ["a", "b"], "left_anti"), "pairs")
    if rest.take(1):
        found = stored(components(links.unionByName(verified(bounded(rest, sets), docs, sets))), "components")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component", "node"))
    return nodes.join(found, "node", "left").select("doc_id", "name", "n_shingles", component.alias("component"))


def similar_groups(docs: DataFrame) -> DataFrame:
    """documents -> doc_id, n_shingles, component_id: the least doc_id reachable by links, itself included.

    Rows with the same doc_id are documents of their own that share its number; rows with a null doc_id are left with a null
    component_id unless a document with an id is in it. See grouped().
    """
    placed = grouped(docs)
    least = placed.filter("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    joined = placed.join(least, "component", "left")
    return joined.select("doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """documents -> the same columns of one row of each group: that with the least doc_id, null ones last, then by a hash of
    the row. Rows without a shingle all stay. Columns may have any names."""
    placed = grouped(docs.select("doc_id", "text"))
    best = placed.filter("component is not null").groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "name")).alias("best"))
    stay = stored(best.select("best.name"), "stay")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64("doc_id", text).alias("name"), text.rlike(r"[^\x20\x09-\x0D]").alias("worded"))
    # repeated rows have one name; the join has put them side by side
    nth = F.row_number().over(W.partitionBy("name").orderBy("name"))
    first = rows.filter("worded").join(stay.hint("merge"), "name", "left_semi").withColumn("nth", nth).filter("nth = 1")
    return first.select("row.*").unionByName(rows.filter("not worded").select("row.*"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> doc_id, n_shingles, component_id. Null and short texts, equal and null ids, repeated rows: see similar_groups()."""
    return similar_groups(table(spark, sf_dir, "documents"))


OP6_SQL = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[s:s + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS s FROM doc WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
links AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingle x JOIN shingle y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n + q.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM doc UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT doc.doc_id, coalesce(n, 0) AS n_shingles, min(b) AS component_id FROM doc LEFT JOIN size USING (doc_id) JOIN reach ON reach.a = doc.doc_id GROUP BY ALL
"""
