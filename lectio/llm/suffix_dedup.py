"""Suffix-array dedup: remove each byte covered by a string of SPAN bytes that also starts elsewhere.

Every string of SPAN bytes is assigned to an anchor inside it, the place of its least HEAD-byte hash; equal strings have
their anchors at the same place. Only suffixes that begin at anchors are sorted, and of these only those whose head may
occur twice. Tasks sort their suffixes into runs, front-code them (length of the prefix common with the one before, then
the rest) and exchange them by head; a loser tree merges the runs and never compares a prefix that is known to be equal.
In the sorted order the strings of an anchor that occur again are those with a long enough common prefix on the right and
the same bytes on the left.

Suffixes of different heads need no comparison, so runs are dealt by a hash of the head, not by ranges of one global order:
each task sorts its share of the heads. Copies within a batch settle each other, so that of a passage which many documents
hold a batch sends one suffix. A head that many different suffixes share is dealt in PARTS by longer substrings of the
strings in question, which include what stands beside the passage.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectio.llm.common import forget, release, row_name, stored, table, texts
from lectio.llm.hashing import _BYTES, _INVERSE, _ODD, gathered, mix, powers, scatter
from lectio.llm.pieces import slices

SPAN, HEAD = 200, 32
#: Starts of a string relative to its anchor: 0 ... REACH - 1 bytes before it.
REACH = SPAN - HEAD + 1
#: Bits of the filter of heads that occur twice, the bound on what is broadcast. A fuller filter passes more; it loses none.
FILTER_BITS = 27
#: A head with more anchors than this share of a mean bucket, and at least HOT_LEAST, is dealt in so many parts.
HOT_SHARE, HOT_LEAST, PARTS = 0.25, 64, 4
#: Characters whose anchors are found at once, and suffixes that a task holds before it sends them: bounds of memory alone.
RUN_CHARS, HELD = 500_000, 120_000
#: How hard runs are compressed before they travel.
LEVEL = 5
#: Suffixes of a bucket on average, from which the number of buckets follows.
BUCKET_ROWS = 20_000
_POWERS: dict[str, np.ndarray] = {"up": np.zeros(0, np.uint64), "down": np.zeros(0, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        _POWERS["up"], _POWERS["down"] = powers(_ODD, n), powers(_INVERSE, n)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def anchors(raw: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of documents one after the other: (head hash, anchor, first, last start of the strings assigned to it), in their order."""
    n = len(raw)
    if n < SPAN:
        return (np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3)))
    up, down = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[raw] * up[:n], out=sums[1:])
    heads = mix((sums[HEAD:] - sums[:-HEAD]) * down[: n - HEAD + 1])
    # the upper half decides, then the place: the leftmost of equal ones
    best = (heads & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(heads), dtype=np.uint64)
    width = 1
    while 2 * width <= REACH:
        best = np.minimum(best[:-width], best[width:])
        width *= 2
    best = np.minimum(best[: len(best) - (REACH - width)], best[REACH - width :])
    at = (best & np.uint64(0xFFFFFFFF)).astype(np.int64)
    ends = np.cumsum(sizes)
    inside = np.ones(len(at), bool)  # strings that do not cross documents
    edge = np.zeros(n + 1, np.int64)
    for e in ends[:-1].tolist():
        edge[max(0, e - SPAN + 1)] += 1
        edge[e] -= 1
    inside = np.cumsum(edge)[: len(at)] == 0
    start = np.flatnonzero(inside)
    if not len(start):
        return (np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3)))
    own = at[start]
    new = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (start[1:] != start[:-1] + 1)))
    last = start[np.append(new[1:], len(start)) - 1]
    return heads[own[new]], own[new], start[new], last


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    said = batch.column(1).to_pylist()
    for a, b in slices(said, 2000, RUN_CHARS):
        data = [x.encode() for x in said[a:b]]
        yield a, b, np.frombuffer(b"".join(data), np.uint8), np.array([len(x) for x in data], np.int64)


def repeated_heads(docs: DataFrame, hot_least: int = HOT_LEAST) -> tuple[np.ndarray, np.ndarray, int]:
    """(a bit filter of the heads that occur at two anchors or more, the sorted heads with the most anchors, buckets).

    Counted over all documents. There are as many buckets as the suffixes of repeated heads need, and so many frequent heads
    at most as a bucket can hold of them, times the buckets.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = 4 * parts

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads, counts = np.unique(np.concatenate([anchors(raw, sizes)[0] for _, _, raw, sizes in _runs(batch)] or [np.zeros(0, np.uint64)]), return_counts=True)
            record = np.zeros(len(heads), [("head", "<u8"), ("count", "<u4")])
            record["head"], record["count"] = heads, counts
            blobs = list(scatter((heads >> np.uint64(32)).astype(np.int64) * shares >> 32, record))
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in blobs], pa.int32()), pa.array([x for _, x in blobs], pa.binary())], ["bucket", "blob"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, blobs in gathered(batches):
            rows = np.concatenate([np.frombuffer(x, [("head", "<u8"), ("count", "<u4")]) for x in blobs])
            rows = rows[np.argsort(rows["head"], kind="stable")]
            starts = np.flatnonzero(np.append(True, np.diff(rows["head"]) != 0))
            heads, counts = rows["head"][starts], np.add.reduceat(rows["count"].astype(np.int64), starts)
            found = np.unique((heads[counts > 1] >> np.uint64(64 - FILTER_BITS)).astype(np.uint32))
            often = counts >= hot_least
            yield pa.RecordBatch.from_arrays([pa.array([found.tobytes()], pa.binary()), pa.array([int(counts[counts > 1].sum())], pa.int64()), pa.array([heads[often].tobytes()], pa.binary()), pa.array([counts[often].tobytes()], pa.binary())], ["slots", "rows", "heads", "counts"])

    found = texts(docs).mapInArrow(count, "bucket int, blob binary").repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(merge, "slots binary, rows long, heads binary, counts binary")
    found = stored(found, "heads")
    total = found.agg(F.sum("rows")).first()[0] or 0
    buckets = max(shares, -(-total // BUCKET_ROWS))
    least = max(hot_least, int(HOT_SHARE * total / buckets))
    bits, hot = np.zeros(1 << (FILTER_BITS - 3), np.uint8), [np.zeros(0, np.uint64)]
    for r in found.select("slots").toLocalIterator():
        at = np.frombuffer(r["slots"], np.uint32)
        np.bitwise_or.at(bits, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))
    for r in found.select("heads", "counts").toLocalIterator():
        hot.append(np.frombuffer(r["heads"], np.uint64)[np.frombuffer(r["counts"], np.int64) >= least])
    forget(found)
    return bits, np.sort(np.concatenate(hot)), buckets


def common(x: bytes, y: bytes, known: int) -> int:
    """The length of the common prefix, of which ``known`` bytes are known."""
    low, high = known, min(len(x), len(y))
    if x[low:high] == y[low:high]:
        return high
    while high - low > 1:  # a difference lies in [low, high)
        middle = (low + high) // 2
        if x[low:middle] == y[low:middle]:
            low = middle
        else:
            high = middle
    return low


def front_code(suffixes: list[bytes]) -> tuple[np.ndarray, bytes]:
    """Sorted suffixes -> (for each: bytes common with the one before, bytes that follow), those bytes."""
    sizes, rest, before = np.zeros((len(suffixes), 2), "<u2"), [], b""
    for i, x in enumerate(suffixes):
        k = common(before, x, 0)
        sizes[i] = k, len(x) - k
        rest.append(x[k:])
        before = x
    return sizes, b"".join(rest)


def decode_run(sizes: np.ndarray, rest: bytes) -> Iterator[tuple[int, bytes]]:
    """(bytes common with the one before, suffix) of a front-coded run."""
    at, before = 0, b""
    for k, m in sizes.tolist():
        before = before[:k] + rest[at : at + m]
        at += m
        yield k, before


def merge_runs(runs: list[Iterator[tuple[int, bytes]]]) -> Iterator[tuple[int, bytes, int]]:
    """Sorted runs -> (bytes common with the one put out before, suffix, run), all in order.

    Each contender in the loser tree has the length of the prefix that it shares with the last one put out. The longer one
    wins without a look at the bytes; equally long ones are compared from there on, and the loser keeps what was found.
    """
    size = 1
    while size < max(len(runs), 1):
        size *= 2
    # a contender: [shared with the last winner, suffix, run]; None when a run has ended
    now: list = [None] * size
    for i, run in enumerate(runs):
        first = next(run, None)
        now[i] = [0, first[1], i] if first else None

    def play(x, y):
        """(winner, loser)"""
        if x is None or y is None:
            return (y, x) if x is None else (x, y)
        if x[0] != y[0]:
            return (x, y) if x[0] > y[0] else (y, x)
        k = common(x[1], y[1], x[0])
        winner, loser = (x, y) if x[1][k : k + 1] <= y[1][k : k + 1] else (y, x)
        loser[0] = k
        return winner, loser

    losers: list = [None] * size

    def build(node: int):
        if node >= size:
            return now[node - size]
        winner, losers[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    winner = build(1)
    while winner is not None:
        shared, suffix, run = winner
        yield shared, suffix, run
        following = next(runs[run], None)
        winner = [following[0], following[1], run] if following else None
        node = (run + size) // 2
        while node:
            winner, losers[node] = play(winner, losers[node])
            node //= 2


def pack_run(left: list[bytes], right: list[bytes], nearest: np.ndarray, furthest: np.ndarray, places: np.ndarray, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    """(a sorted, front-coded run, the rows that settle each other).

    left: the bytes before the anchor; right: from it on; nearest, furthest: the starts, in bytes before the anchor. Rows with
    equal (left, right, nearest, furthest) are one suffix; when there are several, all their strings occur again, and the
    suffix is sent without a place.
    """
    order = sorted(range(len(right)), key=lambda i: (right[i], left[i], nearest[i], furthest[i]))
    keys, owner = [], np.zeros(len(order), np.int64)
    for rank, i in enumerate(order):
        if not keys or (right[i], left[i], nearest[i], furthest[i]) != (right[keys[-1]], left[keys[-1]], nearest[keys[-1]], furthest[keys[-1]]):
            keys.append(i)
        owner[rank] = len(keys) - 1
    sizes, rest = front_code([right[i] for i in keys])
    lefts = b"".join(left[i] for i in keys)
    info = np.array([[len(left[i]), nearest[i], furthest[i]] for i in keys], "<u2").reshape(-1, 3)
    many = np.bincount(owner, minlength=len(keys))
    order = np.array(order, np.int64)
    alone = many[owner] == 1
    where = np.stack([ids[order[alone]], places[order[alone]]], 1).astype("<i8")
    head = np.array([len(keys), len(where), len(rest), len(lefts)], "<u4")
    body = b"".join([sizes.tobytes(), info.tobytes(), np.minimum(many, 2).astype("<u1").tobytes(), where[:, 0].tobytes(), where[:, 1].tobytes(), rest, lefts])
    return head.tobytes() + zstandard.compress(body, LEVEL), order[~alone]


def unpack_run(blob: bytes) -> dict:
    keys, rows, rest, lefts = np.frombuffer(blob, "<u4", 4).tolist()
    said, out, at = zstandard.decompress(blob[16:]), {}, 0
    for name, kind, shape in (("sizes", "<u2", (keys, 2)), ("info", "<u2", (keys, 3)), ("many", "<u1", (keys,)), ("where", "<i8", (2, rows))):
        n = int(np.prod(shape))
        out[name] = np.frombuffer(said, kind, n, at).reshape(shape)
        at += n * np.dtype(kind).itemsize
    return out | {"where": out["where"].T, "rest": said[at : at + rest], "lefts": said[at + rest :]}


def parted(row: tuple) -> Iterator[tuple]:
    """A suffix (head, left, right, nearest, furthest, place, name) -> it in PARTS by starts, each with a head of its own: a
    hash of the bytes that all strings of that part have in common, which are many more than those of the head."""
    head, left, right, nearest, furthest, place, name = row
    step = -(-REACH // PARTS)
    for low in range(nearest // step * step, furthest + 1, step):
        a, b = max(low, nearest), min(low + step - 1, furthest)
        # by the part's own bounds, whatever the row's: strings of several rows meet
        core = left[max(0, len(left) - low) :] + right[: SPAN - (low + step - 1)]
        key = int.from_bytes(hashlib.blake2b(core, digest_size=8, key=low.to_bytes(2, "little")).digest(), "little")
        yield key, left[len(left) - b :], right[: SPAN - a], a, b, place, name


def repeated_starts(shared: np.ndarray, left: list[bytes], nearest: np.ndarray, furthest: np.ndarray, many: np.ndarray) -> np.ndarray:
    """For suffixes in sorted order: whether the string that starts d bytes before the anchor occurs elsewhere (rows x REACH).

    shared[i]: the prefix common with the one before. Strings with SPAN - d bytes after the anchor are equal there within a
    class of neighbours; of these the same d bytes on the left make them equal.
    """
    n = len(left)
    found = np.zeros((n, REACH), bool)
    sizes = np.array([len(x) for x in left], np.int64)
    raw = np.frombuffer(b"".join(left) + b"\0", np.uint8)
    ends = np.cumsum(sizes)
    hashes, scale = np.zeros(n, np.uint64), powers(_ODD, REACH)
    for d in range(REACH):
        if d:
            ok = sizes >= d
            hashes[ok] += _BYTES[raw[ends[ok] - d]] * scale[d]
        group = np.cumsum(shared < SPAN - d)
        rows = np.flatnonzero((nearest <= d) & (d <= furthest))
        if not len(rows):
            continue
        key = mix(hashes[rows] ^ mix(group[rows].astype(np.uint64)))
        order = np.argsort(key, kind="stable")
        key, rows = key[order], rows[order]
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        total = np.add.reduceat(many[rows].astype(np.int64), starts)
        found[rows[np.repeat(total > 1, np.diff(np.append(starts, len(rows))))], d] = True
    return found


def spans_of(found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, last) of each run of true cells."""
    wide = np.zeros((len(found), found.shape[1] + 2), np.int8)
    wide[:, 1:-1] = found
    change = np.diff(wide, axis=1)
    row, first = np.nonzero(change == 1)
    return row, first, np.nonzero(change == -1)[1] - 1


def _joined(name: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of each name, those that touch or overlap as one."""
    order = np.lexsort((start, name))
    name, start, stop = name[order], start[order], stop[order]
    if not len(name):
        return name, start, stop
    fresh = np.append(True, name[1:] != name[:-1])
    group = np.cumsum(fresh)
    # ends so far within a name: spans of later names are shifted beyond those of earlier ones
    shift = group * (int(stop.max()) + 1)
    reach = np.maximum.accumulate(stop + shift)
    new = np.append(True, (start + shift)[1:] > reach[:-1])
    begins = np.flatnonzero(new)
    ends = np.append(begins[1:], len(name)) - 1
    return name[begins], start[begins], (reach - shift)[ends]


def repeated_spans(docs: DataFrame, hot_least: int = HOT_LEAST) -> DataFrame:
    """documents -> name (a hash of doc_id and text), start, stop: bytes that are covered, in pieces that may overlap."""
    bits, hot, buckets = repeated_heads(docs, hot_least)
    shared = docs.sparkSession.sparkContext.broadcast((bits, hot))
    del bits, hot

    def packed(held: list[tuple], salt: int) -> pa.RecordBatch:
        """Suffixes by bucket, and the spans of those that settle each other, which go along to any bucket."""
        heads = np.array([x[0] for x in held], np.uint64)
        out, settled = [], []
        for bucket, blob in scatter((heads % np.uint64(buckets)).astype(np.int64), np.arange(len(held), dtype=np.int64)):
            rows = [held[i] for i in np.frombuffer(blob, np.int64).tolist()]
            numbers = np.array([x[3:7] for x in rows], np.int64).T
            run, twice = pack_run([x[1] for x in rows], [x[2] for x in rows], numbers[0], numbers[1], numbers[2], numbers[3])
            out.append((bucket, run, None))
            settled.append(np.stack([numbers[3], numbers[2] - numbers[1], numbers[2] - numbers[0] + SPAN], 1)[twice])
        done = np.stack(_joined(*np.concatenate(settled).T), 1)
        if len(done):
            out.append(((salt * 7919 + len(held)) % buckets, None, done.astype("<i8").tobytes()))
        return pa.RecordBatch.from_arrays([pa.array([k for k, _, _ in out], pa.int32()), pa.array([x for _, x, _ in out], pa.binary()), pa.array([x for _, _, x in out], pa.binary())], ["bucket", "run", "done"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, hot = shared.value
        task, held = TaskContext.get().partitionId(), []
        for batch in batches:
            names = batch.column(0).to_numpy(zero_copy_only=False)
            for a, b, raw, sizes in _runs(batch):
                heads, at, first, last = anchors(raw, sizes)
                slot = (heads >> np.uint64(64 - FILTER_BITS)).astype(np.uint32)
                keep = np.flatnonzero((bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1)
                data, ends = raw.tobytes(), np.cumsum(sizes)
                doc = np.searchsorted(ends, at[keep], "right")
                often = np.zeros(len(keep), bool)
                if len(hot):
                    often = hot[np.minimum(np.searchsorted(hot, heads[keep]), len(hot) - 1)] == heads[keep]
                for head, p, s, e, i, begin, many in zip(heads[keep].tolist(), at[keep].tolist(), first[keep].tolist(), last[keep].tolist(), doc.tolist(), (ends - sizes)[doc].tolist(), often.tolist()):
                    row = (head, data[s:p], data[p : e + SPAN], p - e, p - s, p - begin, names[a + i])
                    if many:
                        held += parted(row)
                    else:
                        held.append(row)
                if len(held) > HELD:
                    yield packed(held, task)
                    held = []
        if held:
            yield packed(held, task)

    def spans(name: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in _joined(name, start, stop)], ["name", "start", "stop"])

    def settle(rows: list, runs: list[dict]) -> pa.RecordBatch | None:
        """Rows (shared, run, number in the run) with a common head -> their repeated spans."""
        left = [runs[r]["lefts"][runs[r]["left_at"][k] : runs[r]["left_at"][k + 1]] for _, r, k in rows]
        info = np.array([runs[r]["info"][k] for _, r, k in rows], np.int64)
        many = np.array([runs[r]["many"][k] for _, r, k in rows], np.int64)
        row, first, last = spans_of(repeated_starts(np.array([x[0] for x in rows]), left, info[:, 1], info[:, 2], many))
        if not len(row):
            return None
        where = [runs[rows[i][1]]["where"][runs[rows[i][1]]["where_at"][rows[i][2]] : runs[rows[i][1]]["where_at"][rows[i][2] + 1]] for i in row.tolist()]
        times = np.array([len(x) for x in where])
        where = np.concatenate(where)
        return spans(where[:, 0], where[:, 1] - np.repeat(last, times), where[:, 1] - np.repeat(first, times) + SPAN) if len(where) else None

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, blobs in gathered(batches):
            for x in blobs:
                if x[1] is not None:
                    yield spans(*np.frombuffer(x[1], "<i8").reshape(-1, 3).T)
            runs = [unpack_run(x[0]) for x in blobs if x[0] is not None]
            for r in runs:
                r["left_at"] = np.append(0, np.cumsum(r["info"][:, 0], dtype=np.int64))
                r["where_at"] = np.append(0, np.cumsum(r["many"] == 1, dtype=np.int64))
            count, rows = [0] * len(runs), []
            for k, _, run in merge_runs([decode_run(r["sizes"], r["rest"]) for r in runs]):
                if k < HEAD and len(rows) >= 20_000:  # between heads only
                    if (done := settle(rows, runs)) is not None:
                        yield done
                    rows = []
                rows.append((k, run, count[run]))
                count[run] += 1
            if rows and (done := settle(rows, runs)) is not None:
                yield done

    rows = texts(docs).select(row_name().alias("name"), "text")
    cuts = rows.mapInArrow(cut, "bucket int, run binary, done binary")
    found = stored(cuts.repartition(-(-buckets // 4), "bucket").sortWithinPartitions("bucket").mapInArrow(sort, "name long, start long, stop long"), "spans")
    shared.destroy()
    # the runs are settled: their files need not lie there while the texts are joined
    del cuts
    release(docs.sparkSession)
    return found


def without_repeats(docs: DataFrame, hot_least: int = HOT_LEAST) -> DataFrame:
    """documents -> doc_id, n_bytes, spans (array of start, stop: the maximal removed runs of bytes), kept (binary).

    A null text is empty. Matches never cross documents; rows are documents of their own, also with equal or null ids, so of
    repeated rows of SPAN bytes or more nothing is left. What is left of a text may begin or end inside a character.
    """
    spans = repeated_spans(docs, hot_least).distinct().groupBy("name").agg(F.collect_list(F.struct("start", "stop")).alias("pieces"))
    rows = texts(docs).withColumn("name", row_name()).join(spans.hint("merge"), "name", "left").select("doc_id", "text", "pieces")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, merged, kept = [], [], []
            for text, pieces in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data, out = text.encode(), []
                for x in sorted((p["start"], p["stop"]) for p in pieces or ()):
                    if out and x[0] <= out[-1][1]:
                        out[-1] = (out[-1][0], max(out[-1][1], x[1]))
                    else:
                        out.append(x)
                at, parts = 0, []
                for s, e in out:
                    parts.append(data[at:s])
                    at = e
                sizes.append(len(data))
                merged.append([{"start": s, "stop": e} for s, e in out])
                kept.append(b"".join([*parts, data[at:]]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(merged, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])

    return rows.mapInArrow(cut, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> doc_id, n_bytes, n_removed, n_spans, kept_sha256. Null texts, equal and null ids, repeated rows: see without_repeats()."""
    found = without_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: acc + x["stop"] - x["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
