"""A BM25 index in segments, and the best matches from it, exact, without most of the long lists.

A segment holds the postings of some thousand chunks as one row: the chunks in order of length; the terms in order, each with
the places and counts of its chunks. Of a term that is frequent in it there are also the peaks, the largest count in each pair
of chunks. What a term adds to a score falls with the length, so a peak and the shortest length of its run bound it, whatever
the weights are on the day. A question adds up its rare terms exactly and the peaks of its frequent ones. Chunks whose sum
stays below the score of the best ones found so far are not looked up in the long lists.

New recordings are further segments. Numbers of chunks, words and terms add up, so nothing of the old text is read for them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lectio.operators.retrieval import BLOCK, K1, TOP_K, B, postings, split_words, term_counts, weights_of, words
from lectio.sources.batches import Batches
from lectio.sources.shared import stored

SEGMENT, RUN, FREQUENT = 8192, 2, 0.1
#: Bytes of a segment's texts, and questions whose matches are sent at once.
CHARACTERS, SENT = 1 << 24, 256
#: Terms of segments that are added up at once.
COUNTED = 1 << 20
SEGMENT_SCHEMA = "chunk_ids array<string>, lengths binary, terms array<string>, starts binary, places binary, counts binary, frequent binary, peaks binary"
SIZES = "chunks long, words long"
_LISTED = pa.schema([("chunk_ids", pa.list_(pa.string())), ("lengths", pa.binary()), ("terms", pa.list_(pa.string())), *((c, pa.binary()) for c in ("starts", "places", "counts", "frequent", "peaks"))])


def _narrow(values: np.ndarray) -> bytes:
    """Numbers in 1, 2 or 4 bytes each, as the largest needs; _numbers() reads them."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0))).newbyteorder("<")).tobytes()


def _numbers(raw: pa.Buffer | bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{len(raw) // n}") if n else np.zeros(0, np.uint8)


def _pairs(group: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Chunks (low; or length, terms, tfs) -> (terms; of each occurrence or count: which chunk, which term, how often; lengths)."""
    if "low" in group.column_names:
        flat, lengths = split_words(group["low"].combine_chunks())
        row, count = np.repeat(np.arange(group.num_rows, dtype=np.int32), lengths), np.broadcast_to(1, len(flat))
    else:
        lists = group["terms"].combine_chunks()
        flat, lengths = pc.list_flatten(lists), group["length"].to_numpy()
        row = np.repeat(np.arange(group.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        count = pc.list_flatten(group["tfs"].combine_chunks()).to_numpy(zero_copy_only=False)
    coded = flat.dictionary_encode()
    return coded.dictionary, row, coded.indices.to_numpy(zero_copy_only=False), count, lengths


def _packed(group: pa.Table) -> pa.Table:
    """Chunks (chunk_id, low: the text in lower case; or chunk_id, length, terms, tfs) -> the one row of their segment."""
    n, (names, row, term, count, lengths) = group.num_rows, _pairs(group)
    chunks = pa.table({"length": lengths, "chunk_id": group["chunk_id"]})
    sorted_ = pc.sort_indices(chunks, sort_keys=[("length", "ascending"), ("chunk_id", "ascending")])
    chunks, at = chunks.take(sorted_), np.empty(n, np.int64)
    at[sorted_.to_numpy()] = np.arange(n)
    order = pc.sort_indices(names)
    ranks = np.empty(len(order), np.int64)
    ranks[order.to_numpy()] = np.arange(len(order))
    # term and place in one number: occurrences are sorted, and counted where it changes
    both = ranks[term]
    both *= n
    both += at[row]
    del row, term
    if "low" in group.column_names:
        both.sort()
        first = np.flatnonzero(np.append(True, both[1:] != both[:-1])[: len(both)])
        both, count = both[first], np.diff(first, append=len(both))
    else:
        order_ = np.argsort(both)
        both, count = both[order_], count[order_]
    names = names.take(order)
    term, place = np.divmod(both, max(n, 1))
    starts = np.searchsorted(term, np.arange(len(names) + 1))
    frequent = np.flatnonzero(np.diff(starts) > FREQUENT * n)
    peaks = np.zeros((len(frequent), -(-n // RUN)), np.uint8)
    for row, t in zip(peaks, frequent.tolist()):
        a, b = starts[t], starts[t + 1]
        np.maximum.at(row, place[a:b] // RUN, np.minimum(count[a:b], 255).astype(np.uint8))
    one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x)
    parts = [chunks["length"].to_numpy().astype("<i8"), starts.astype("<i4"), _narrow(place), _narrow(count), frequent.astype("<i4"), peaks]
    lengths, *rest = (pa.array([x if isinstance(x, bytes) else x.tobytes()], pa.binary()) for x in parts)
    return pa.table([one(chunks["chunk_id"]), lengths, one(names), *rest], schema=_LISTED)


def _segments(size: int, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Chunks (chunk_id, low) of a task -> segments of ``size`` of them, or of fewer with some ``most`` bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, taken = [], 0, 0
        for batch in batches:
            ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("low")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            a = 0
            while a < batch.num_rows:
                # as many as fit, and the one that passes the edge
                before = int(ends[a - 1]) if a else 0
                b = min(int(np.searchsorted(ends, before + most - taken)) + 1, a + size - rows, batch.num_rows)
                held.append(batch.slice(a, b - a))
                rows, taken, a = rows + b - a, taken + int(ends[b - 1]) - before, b
                if rows >= size or taken >= most:
                    yield from _packed(pa.Table.from_batches(held)).to_batches()
                    held, rows, taken = [], 0, 0
        if held:
            yield from _packed(pa.Table.from_batches(held)).to_batches()

    return run


@dataclass(frozen=True)
class Index:
    """segments: SEGMENT_SCHEMA. terms: term, df. chunks and words: how many there are."""

    segments: DataFrame
    terms: DataFrame
    chunks: int
    words: int

    def plus(self, other: Index) -> Index:
        """Both together. Recordings must be in one of them alone."""
        terms = self.terms.unionByName(other.terms).groupBy("term").agg(F.sum("df").alias("df"))
        return Index(self.segments.unionByName(other.segments), terms, self.chunks + other.chunks, self.words + other.words)


def indexed(chunks: DataFrame, size: int = SEGMENT, lemmas: DataFrame | None = None) -> Index:
    """Chunks (chunk_id, text; null: no words) -> their index, written once. Segments are made where the chunks lie, so no text is
    exchanged; with lemmas (word, lemma), which may make one term of several, counts are. Segments have ``size`` chunks, fewer where
    these are long or a task has no more."""
    if lemmas is None:
        rows = chunks.select("chunk_id", F.lower(F.coalesce("text", F.lit(""))).alias("low"))
        return index_of(stored(rows.mapInArrow(_segments(size, CHARACTERS), SEGMENT_SCHEMA), "segments"))
    named = postings(chunks, lemmas).groupBy("chunk_id").agg(F.collect_list(F.struct("term", "tf")).alias("named"))
    rows = term_counts(chunks).select("chunk_id", "length").join(named, "chunk_id", "left").withColumn("counted", F.coalesce("named", F.array().cast("array<struct<term:string,tf:bigint>>")))
    rows = rows.select("chunk_id", "length", F.col("counted.term").alias("terms"), F.col("counted.tf").alias("tfs"))
    there = chunks.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("characters")).first()
    n = max(1, -(-there["n"] // size), -(-there["characters"] // CHARACTERS))
    named = rows.withColumn("segment", F.pmod(F.xxhash64("chunk_id"), F.lit(n)))
    return index_of(stored(named.groupBy("segment").applyInArrow(lambda group: _packed(group.drop_columns(["segment"])), SEGMENT_SCHEMA), "segments"))


def index_of(segments: DataFrame) -> Index:
    """The index that stored segments make up: only their terms and lengths are read."""

    def summed(held: list[pa.Table]) -> list[pa.RecordBatch]:
        return pa.concat_tables(held).group_by("term").aggregate([("df", "sum"), ("words", "sum")]).rename_columns(["term", "df", "words"]).to_batches()

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for terms, starts, lengths in zip(batch.column("terms"), batch.column("starts"), batch.column("lengths")):
                lengths = np.frombuffer(lengths.as_buffer(), "<i8")
                df = np.diff(np.frombuffer(starts.as_buffer(), "<i4")).astype(np.int64)
                held.append(pa.table({"term": pa.concat_arrays([terms.values, pa.array([None], pa.string())]), "df": np.append(df, len(lengths)), "words": np.append(np.zeros(len(df), np.int64), lengths.sum())}))
                if sum(t.num_rows for t in held) > COUNTED:
                    yield from summed(held)
                    held = []
        if held:
            yield from summed(held)

    counted = segments.select("terms", "starts", "lengths").mapInArrow(sizes, "term string, df long, words long")
    counted = stored(counted.groupBy("term").agg(F.sum("df").alias("df"), F.sum("words").alias("words")), "terms")
    all_of = counted.filter("term is null").first()
    return Index(segments, counted.filter("term is not null").select("term", "df"), all_of["df"] if all_of else 0, all_of["words"] if all_of else 0)


def append_index(saved: Batches, chunks: DataFrame, batch: str, size: int = SEGMENT) -> bool:
    """Segments and counts of further chunks, published together. Chunks must be new; nothing of the old ones is read."""
    if any(r["batch"] == batch for r in saved.listed()):
        return False
    made = indexed(chunks, size)
    spark = chunks.sparkSession
    return saved.append(batch, segments=made.segments, terms=made.terms, sizes=spark.createDataFrame([(made.chunks, made.words)], SIZES))


def saved_index(saved: Batches) -> Index:
    """The index of all published batches: their counts are added up, and no posting is read for it."""
    sizes = saved.read("sizes", SIZES).agg(F.sum("chunks"), F.sum("words")).first()
    terms = saved.read("terms", "term string, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return Index(saved.read("segments", SEGMENT_SCHEMA), terms, sizes[0] or 0, sizes[1] or 0)


@dataclass
class Asked:
    """Questions of a block: their ids, their terms with weights, and which question has which term how often."""

    ids: list
    terms: pa.Array
    idf: np.ndarray
    rows: list[tuple[np.ndarray, np.ndarray]]  # of each question: which terms, how often
    average: float


def best_in(segment: dict, asked: Asked, pool: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(question, places of chunks, scores, postings read) for each question: its best ``pool`` chunks here, ties at the edge too."""
    ints = lambda c: np.frombuffer(segment[c], "<i4")
    lengths, starts, frequent = np.frombuffer(segment["lengths"], "<i8"), ints("starts"), ints("frequent")
    places, counts = (_numbers(segment[c], int(starts[-1])) for c in ("places", "counts"))
    n, known = len(lengths), segment["terms"]
    norm = K1 * (1 - B + B * lengths / asked.average)
    peaks = np.frombuffer(segment["peaks"], np.uint8).reshape(len(frequent), -1)
    number = pc.index_in(asked.terms, value_set=known).to_pylist()
    there = {t: at for t, at in enumerate(number) if at is not None}
    row = {at: k for k, at in enumerate(frequent.tolist())}
    part = lambda t, tf, norm: asked.idf[t] * tf * (K1 + 1) / (tf + norm)
    lists, bounds, parts, of = {}, {}, [], {}
    for t, at in there.items():
        where, tf = places[starts[at] : starts[at + 1]], counts[starts[at] : starts[at + 1]]
        if at in row and asked.idf[t] > 0:
            peak = peaks[row[at]].astype(np.float64)  # 255: that or more
            bounds[t] = np.where(peak == 255, asked.idf[t] * (K1 + 1), part(t, peak, norm[::RUN]))
            of[t] = len(parts)
            parts.append(np.zeros(n))
            parts[-1][where] = part(t, tf, norm[where])
        else:
            lists[t] = where, part(t, tf, norm[where])
    parts = np.array(parts).reshape(len(parts), n).T.copy()  # a chunk's parts lie together
    for q, (terms, times) in enumerate(asked.rows):
        rare, most, long, weights, read = np.zeros(n), np.zeros(-(-n // RUN)), [], [], 0
        for t, k in zip(terms.tolist(), times.tolist()):
            if t in bounds:
                most += k * bounds[t]
                long.append(of[t])
                weights.append(k)
            elif t in lists:
                where, score = lists[t]
                rare[where] += k * score
                read += len(where)
        bound = rare + np.repeat(most, RUN)[:n]
        exact = np.full(n, -np.inf)

        def look_up(some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            found = parts[some[:, None], long]
            total = rare[some]
            for x, k in zip(found.T, weights):  # in order of terms: equal chunks have equal sums
                total += k * x
            exact[some] = total
            return found, total

        # those of the highest bounds give a score that the rest must reach: some few first, and more as long as it helps
        open_, least, size, best = bound > 0, 0.0, pool, np.zeros(0)
        while True:
            left = np.flatnonzero(open_ & (bound >= least))
            some = left if len(left) <= size else left[np.argpartition(-bound[left], size)[:size]]
            if not len(some):
                break
            found, total = look_up(some)
            read += int(np.count_nonzero(found))
            open_[some] = False
            best = np.append(best, total)
            if len(best) >= pool:
                best = np.partition(best, len(best) - pool)[len(best) - pool :]
                least = max(0.0, best[0] - 1e-9)
            size *= 2
        kept = np.flatnonzero((exact >= least) & (exact > 0))
        yield q, kept, exact[kept], read


def _blocks(questions: DataFrame, index: Index, lemmas: DataFrame | None, block: int) -> Iterator[Asked]:
    """Questions with their known terms, ``block`` of them at a time; only these go through the driver."""
    asked = words(questions, "question_id", lemmas).groupBy("question_id", "term").agg(F.count("*").alias("times"))
    asked = asked.join(weights_of(index.terms, index.chunks).select("term", "idf"), "term")
    n = max(1, -(-questions.count() // block))
    asked = stored(asked.withColumn("block", F.pmod(F.xxhash64("question_id"), F.lit(n))), "asked") if n > 1 else asked.withColumn("block", F.lit(0))
    for k in range(n):
        rows = asked.filter(F.col("block") == k).orderBy("question_id", "term").collect()
        ids, terms = list(dict.fromkeys(r["question_id"] for r in rows)), sorted({r["term"] for r in rows})
        number, idf, own = {t: i for i, t in enumerate(terms)}, np.zeros(len(terms)), {q: ([], []) for q in ids}
        for r in rows:
            idf[number[r["term"]]] = r["idf"]
            own[r["question_id"]][0].append(number[r["term"]])
            own[r["question_id"]][1].append(r["times"])
        yield Asked(ids, pa.array(terms, pa.string()), idf, [(np.array(a, np.int64), np.array(b, np.float64)) for a, b in own.values()], index.words / max(index.chunks, 1) or 1.0)


def best_matches(questions: DataFrame, index: Index, pool: int = 2 * TOP_K, lemmas: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """question_id, chunk_id, score > 0: of each segment the best ``pool`` (ties at the edge stay), so the best of all are among
    them; exact. Segments stay where they are: no posting is exchanged, and a task sends ``pool`` rows a question and segment."""
    spark, kind = questions.sparkSession, questions.schema["question_id"].dataType
    arrow, found = to_arrow_type(kind), None
    for asked in _blocks(questions, index, lemmas, block):
        sent = spark.sparkContext.broadcast(asked)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    segment = {c: batch.column(c)[i].as_buffer() for c in ("lengths", "starts", "places", "counts", "frequent", "peaks")} | {c: batch.column(c)[i].values for c in ("terms", "chunk_ids")}
                    best = best_in(segment, sent.value, pool)
                    while some := list(islice(best, SENT)):
                        ids = [sent.value.ids[q] for q, kept, *_ in some for _ in range(len(kept))]
                        kept, score = (np.concatenate(x) for x in list(zip(*some))[1:3])
                        yield pa.RecordBatch.from_arrays([pa.array(ids, arrow), segment["chunk_ids"].take(pa.array(kept)), pa.array(score)], ["question_id", "chunk_id", "score"])

        rows = index.segments.mapInArrow(run, f"question_id {kind.simpleString()}, chunk_id string, score double")
        found = rows if found is None else found.unionByName(rows)
    return found
