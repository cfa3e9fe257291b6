"""Hybrid retrieval: a BM25 index, dense similarity, and their fusion by reciprocal ranks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from lectio.functions.text import tokens
from lectio.operators.guard import guarded
from lectio.sources.batches import Batches
from lectio.sources.shared import few, spread, stored

TOP_K, RRF_K = 40, 60
K1, B, EPSILON = 1.5, 0.75, 0.25
#: Rows of a query side that may be broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 200_000
#: Questions of a block whose matrix goes to every task, and vectors of a cell that a block meets when there are several.
BLOCK, CELL = 4096, 50_000
#: Vectors that are scored at once; centres of cells, and vectors of a pack.
TILE, CENTRES, PACK = 512, 1024, 4096
#: Chunks whose words are counted at once.
SLICE = 512
#: Postings of a cell of chunks that a block of questions meets.
CELL_POSTINGS = 500_000
LEMMAS = "word string, lemma string"


def words(df: DataFrame, key: str, lemmas: DataFrame | None = None, pattern: str = "[а-яёa-z0-9]+") -> DataFrame:
    """(key, text) -> (key, term), a row for each occurrence; lemmas (word, lemma) map words to their normal form."""
    found = df.select(key, F.explode(tokens(F.col("text"), pattern)).alias("term"))
    if lemmas is None:
        return found
    named = lemmas.select(F.col("word").alias("term"), "lemma").dropDuplicates(["term"])
    return found.join(named, "term", "left").select(key, F.coalesce("lemma", "term").alias("term"))


def said(text: Column) -> Column:
    """The words of a text (null: none) with a space between them: short to send, and nothing is left to be parsed."""
    return F.array_join(tokens(F.coalesce(text, F.lit(""))), " ")


#: Of each byte of UTF-8: 1 for a letter or digit of the default pattern of words(), 2 and 3 for the first bytes of its Cyrillic ones.
_BYTES = np.zeros(256, np.uint8)
_BYTES[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = 1
_BYTES[0xD0], _BYTES[0xD1] = 2, 3


def split_words(low: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Texts in lower case -> (their words by the default pattern of words(), one after the other; how many each text has). A null has none."""
    n, (_, offsets, data) = len(low), low.buffers()
    ends = np.frombuffer(offsets, np.int32)[low.offset : low.offset + n + 1] if n else np.zeros(1, np.int32)
    data = np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    kind = _BYTES[data]
    good = kind == 1
    first = np.flatnonzero(kind > 1)
    if len(first):
        after = data[np.minimum(first + 1, len(data) - 1)]
        first = first[np.where(kind[first] == 2, after >= 0xB0, (after <= 0x8F) | (after == 0x91))]
        good[first] = good[first + 1] = True
    begin = good.copy()
    begin[1:] &= ~good[:-1]
    edge = ends[ends < len(data)]
    begin[edge] = good[edge]  # a word does not go on in the next text
    counts = np.diff(np.searchsorted(np.flatnonzero(begin), ends))
    starts = np.flatnonzero(begin[good])
    spelt = np.append(starts, np.count_nonzero(good)).astype(np.int32)
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(spelt), pa.py_buffer(data[good])), counts


def counted(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """said() of some chunks -> (terms in order; and of each pair: which chunk, which term, how often), in order of chunks and terms."""
    lists = pc.split_pattern(texts, " ")
    row = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    coded = pc.list_flatten(lists).dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    names, ranks = coded.dictionary.take(order), np.empty(len(order), np.int64)
    ranks[order.to_numpy()] = np.arange(len(order))
    pairs, times = np.unique(row * len(names) + ranks[coded.indices.to_numpy(zero_copy_only=False)], return_counts=True)
    row, term = np.divmod(pairs, max(len(names), 1))
    if len(names) and names[0].as_py() == "":  # of chunks without words
        there = term > 0
        names, row, term, times = names[1:], row[there], term[there] - 1, times[there]
    return names, row, term, times


def term_counts(chunks: DataFrame, *others: str) -> DataFrame:
    """chunk_id, text (null: no words) -> chunk_id, the others, length, counted: an array of (term, tf), in order of terms.

    A chunk's words are sorted and cut where the word changes, inside its row: nothing is exchanged.
    """
    rows = chunks.select("chunk_id", *others, F.sort_array(tokens(F.coalesce("text", F.lit("")))).alias("_said"))
    n = F.size("_said")
    rows = rows.withColumn("_first", F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: (i < n) & ((i == 0) | (F.get("_said", i) != F.get("_said", i - 1)))))
    ends = F.concat(F.slice("_first", 2, F.greatest(F.size("_first"), F.lit(1))), F.array(n))
    one = F.when(n > 0, F.zip_with("_first", ends, lambda a, b: F.struct(F.get("_said", a).alias("term"), (b - a).cast("long").alias("tf"))))
    return rows.select("chunk_id", *others, n.cast("long").alias("length"), F.coalesce(one, F.array().cast("array<struct<term:string,tf:bigint>>")).alias("counted"))


def postings(chunks: DataFrame, lemmas: DataFrame | None = None) -> DataFrame:
    """chunk_id, term, tf, length: to be stored once, whatever the number of questions.

    A chunk's terms are counted in its row; lemmas (word, lemma), which may make one term of several, are met by an exchange of
    the counts. They do not change a chunk's length.
    """
    # outer: else a filter on the size of ``counted`` would be pushed down to the text, which does the counting for each word again
    found = term_counts(chunks).select("chunk_id", "length", F.explode_outer("counted").alias("c")).filter("c is not null").select("chunk_id", "length", "c.term", "c.tf")
    if lemmas is None:
        return found.select("chunk_id", "term", "tf", "length")
    named = lemmas.select(F.col("word").alias("term"), "lemma").dropDuplicates(["term"])
    found = found.join(named, "term", "left").select("chunk_id", "length", F.coalesce("lemma", "term").alias("term"), "tf")
    return found.groupBy("chunk_id", "length", "term").agg(F.sum("tf").alias("tf")).select("chunk_id", "term", "tf", "length")


def corpus_size(chunks: DataFrame, posted: DataFrame) -> tuple[int, float]:
    """(number of chunks, average length)."""
    n = chunks.count()
    return n, (posted.agg(F.sum("tf")).first()[0] or 0) / max(n, 1)


def term_weights(posted: DataFrame, n: int) -> DataFrame:
    """term, df, idf; a negative idf becomes EPSILON times the mean over all terms. The counts are written once, as the mean is
    worked out from all of them first."""
    return weights_of(stored(posted.groupBy("term").agg(F.count("*").alias("df")), "terms"), n)


def weights_of(counted: DataFrame, n: int) -> DataFrame:
    """(term, df) of n chunks -> term, df, idf."""
    counted = counted.withColumn("raw", F.log(n - F.col("df") + 0.5) - F.log(F.col("df") + 0.5))
    mean = counted.agg(F.avg("raw")).first()[0] or 0.0
    return counted.select("term", "df", F.when(F.col("raw") < 0, EPSILON * mean).otherwise(F.col("raw")).alias("idf"))


def bm25(questions: DataFrame, posted: DataFrame, weights: DataFrame, n: int, average: float, lemmas: DataFrame | None = None) -> DataFrame:
    """question_id, chunk_id, score > 0. The questions' terms are broadcast while they are few; repeated ones count again."""
    asked = words(questions, "question_id", lemmas).groupBy("question_id", "term").agg(F.count("*").alias("times")).join(weights.select("term", "idf"), "term")
    asked = F.broadcast(asked) if asked.count() <= BROADCAST_ROWS else asked
    part = F.col("idf") * F.col("times") * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / average))
    scored = posted.join(asked, "term").groupBy("question_id", "chunk_id").agg(F.sum(part).alias("score"))
    return scored.filter("score > 0")


def bm25_best(questions: DataFrame, posted: DataFrame, weights: DataFrame, average: float, pool: int = 2 * TOP_K, lemmas: DataFrame | None = None, block: int = BLOCK, cell: int = CELL_POSTINGS) -> DataFrame:
    """The rows of bm25() that may be among the best ``pool`` of a question, for ranked(); exact.

    A posting is joined once with its term, however many questions ask it, and sent to its cell of chunks; questions are dealt to
    blocks. Where a block meets a cell the parts are summed, so pairs of question and chunk are not exchanged, but for the best of a cell.
    """
    asked = words(questions, "question_id", lemmas).groupBy("question_id", "term").agg(F.count("*").alias("times")).join(weights, "term")
    asked = stored(asked, "asked")
    wanted = stored(asked.select("term", "df", "idf").dropDuplicates(["term"]).withColumn("number", F.monotonically_increasing_id()), "wanted")
    blocks = max(1, -(-questions.count() // block))
    rows = wanted.agg(F.sum("df")).first()[0] or 0
    cells = max(2 * questions.sparkSession.sparkContext.defaultParallelism, -(-rows // cell))
    part = F.col("idf") * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / average))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    known = posted.join(few(wanted), "term").select("chunk_id", "number", part.alias("part"), F.pmod(F.xxhash64("chunk_id"), F.lit(cells)).cast("int").alias("cell"))
    known = spread(known.withColumn("block", every(blocks) if blocks > 1 else F.lit(0)), rows * blocks, "block", "cell")
    asked = asked.join(few(wanted.select("term", F.col("number").alias("number"))), "term").select("question_id", "number", "times", F.pmod(F.xxhash64("question_id"), F.lit(blocks)).cast("int").alias("block")).withColumn("cell", every(cells))
    kind = questions.schema["question_id"].dataType
    schema = pa.schema([("question_id", to_arrow_type(kind)), ("chunk_id", pa.string()), ("score", pa.float64())])
    meet = lambda q, k: _summed(q, k, pool).cast(schema)
    return asked.groupBy("block", "cell").cogroup(known.groupBy("block", "cell")).applyInArrow(meet, f"question_id {kind.simpleString()}, chunk_id string, score double")


def _coded(column: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """(the different values in order, nulls first; which of them each row has)."""
    coded = column.combine_chunks().dictionary_encode(null_encoding="encode")
    order = pc.sort_indices(coded.dictionary, null_placement="at_start")
    ranks = np.empty(len(order), np.int64)
    ranks[order.to_numpy()] = np.arange(len(order))
    return coded.dictionary.take(order), ranks[coded.indices.to_numpy(zero_copy_only=False)]


def _summed(asked: pa.Table, known: pa.Table, pool: int) -> pa.Table:
    """(question_id, number, times) x (chunk_id, number, part) -> question_id, chunk_id, score > 0: of each question the best ``pool``, and
    what differs from the last of them by no more than ranked() rounds off. Of equal scores only the last ``pool`` chunks stay."""
    (questions, who), (chunks, where) = _coded(asked["question_id"]), _coded(known["chunk_id"])
    number, part = known["number"].to_numpy(), known["part"].to_numpy()
    order = np.argsort(number, kind="stable")
    number, part, where = number[order], part[order], where[order]
    # in order of terms: chunks with the same words have the same sum to the last bit
    term, times = asked["number"].to_numpy(), asked["times"].to_numpy()
    order = np.lexsort((term, who))
    who, term, times = who[order], term[order], times[order]
    first, last = np.searchsorted(number, term), np.searchsorted(number, term, "right")
    ends, found = np.searchsorted(who, np.arange(len(questions) + 1)).tolist(), [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    for q, (a, b) in enumerate(zip(ends, ends[1:])):
        lists = [slice(x, y) for x, y in zip(first[a:b].tolist(), last[a:b].tolist())]
        score = np.bincount(np.concatenate([where[x] for x in lists]), np.concatenate([part[x] for x in lists]) * np.repeat(times[a:b], last[a:b] - first[a:b]), len(chunks))
        least = np.partition(score, -pool)[-pool] - 1e-9 if len(score) > pool else -np.inf
        kept = np.flatnonzero((score >= least) & (score > 0))
        kept = kept[np.lexsort((-kept, -score[kept]))]
        place = np.arange(len(kept))
        kept = kept[place - np.searchsorted(-score[kept], -score[kept]) < pool]
        found.append((np.full(len(kept), q), kept, score[kept]))
    q, kept, score = (np.concatenate(x) for x in zip(*found))
    return pa.table({"question_id": questions.take(pa.array(q)), "chunk_id": chunks.take(pa.array(kept)), "score": score})


def _best(matrix: np.ndarray, vectors: np.ndarray, pool: int, least: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(question, vector, score) of the best ``pool`` of these vectors for each row of the matrix; ties at the edge stay, and what
    is below ``least`` goes. A tile of vectors at a time, so memory does not grow with their number."""
    top = np.full((len(matrix), pool), -np.inf)
    floor = np.full(len(matrix), -np.inf) if least is None else least
    kept = []
    for a in range(0, len(vectors), TILE):
        score = matrix @ vectors[a : a + TILE].T
        top = np.partition(np.concatenate([top, score], 1), score.shape[1], axis=1)[:, score.shape[1] :]
        floor = np.maximum(floor, top.min(1))
        q, v = np.nonzero(score >= floor[:, None])
        kept.append((q, v + a, score[q, v]))
    q, v, score = (np.concatenate(x) for x in zip(*kept)) if kept else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    good = score >= floor[q]
    return q[good], v[good], score[good]


def _frame(names: np.ndarray, ids: np.ndarray, found: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pd.DataFrame:
    q, v, score = found
    return pd.DataFrame({"question_id": names[q], "chunk_id": ids[v], "score": score})


def _questions(asked: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(ids, matrix) of the questions of a block."""
    rows = asked.orderBy("question_id").collect()
    return np.array([r["question_id"] for r in rows], object), np.array([r["embedding"] for r in rows], np.float64)


def dense(questions: DataFrame, vectors: DataFrame, pool: int = 2 * TOP_K, block: int = BLOCK, cell: int = CELL) -> DataFrame:
    """(question_id, embedding) x (chunk_id, embedding) -> question_id, chunk_id, score (the inner product); exact.

    Up to ``block`` questions are one matrix that is broadcast, and the vectors stay where they are. More questions are dealt to
    blocks and the vectors to cells, and each block meets each cell in a task of its own. A task sends the best ``pool`` of each
    question, whatever the number of its vectors, and scores a tile of them at a time.
    """
    schema = f"question_id {questions.schema['question_id'].dataType.simpleString()}, chunk_id string, score double"
    # an alias, as both may be columns of one table
    asked, known = questions.select("question_id", F.col("embedding").alias("embedding")), vectors.select("chunk_id", "embedding")
    n = asked.count()
    if n <= block:
        sent = questions.sparkSession.sparkContext.broadcast(_questions(asked))

        def all_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            names, matrix = sent.value
            for pdf in batches:
                if len(pdf) and len(names):
                    yield _frame(names, pdf["chunk_id"].to_numpy(), _best(matrix, np.stack(pdf["embedding"].to_numpy()).astype(np.float64), pool))

        return known.mapInPandas(all_of, schema)
    blocks, cells = -(-n // block), max(1, -(-known.count() // cell))
    some = asked.withColumn("block", F.pmod(F.xxhash64("question_id"), F.lit(blocks)).cast("int")).withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))))
    other = known.withColumn("cell", F.pmod(F.xxhash64("chunk_id"), F.lit(cells)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def meet(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(v):
            return pd.DataFrame({"question_id": q["question_id"][:0], "chunk_id": v["chunk_id"][:0], "score": np.zeros(0)})
        matrix, there = (np.stack(x["embedding"].to_numpy()).astype(np.float64) for x in (q, v))
        return _frame(q["question_id"].to_numpy(), v["chunk_id"].to_numpy(), _best(matrix, there, pool))

    return some.groupBy("block", "cell").cogroup(other.groupBy("block", "cell")).applyInPandas(meet, schema)


def vector_cells(vectors: DataFrame, most: int = CENTRES, pack: int = PACK) -> tuple[DataFrame, np.ndarray]:
    """(chunk_id, embedding) -> (packs: cell, chunk_ids, vectors, radius; the cells' centres). To be stored once.

    Centres are some of the vectors, at most ``most`` of them; each vector goes to the nearest. A cell with more than ``pack``
    vectors, such as copies of one, is several packs. The radius reaches from the centre to the furthest vector of the pack.
    """
    known, spark = vectors.select("chunk_id", "embedding"), vectors.sparkSession
    n = known.count()
    rows = known.orderBy(F.xxhash64("chunk_id"), "chunk_id").limit(min(most, int(np.ceil(np.sqrt(n))))).collect()
    centres = np.unique(np.array([r["embedding"] for r in rows], np.float64), axis=0)
    sent = spark.sparkContext.broadcast(centres)

    @F.pandas_udf("int")
    def nearest(embedding: pd.Series) -> pd.Series:
        c, out = sent.value, []
        for a in range(0, len(embedding), TILE):
            x = np.stack(embedding.to_numpy()[a : a + TILE]).astype(np.float64)
            out.append((x @ c.T - (c * c).sum(1) / 2).argmax(1))
        return pd.Series(np.concatenate(out) if out else [], dtype="int32")

    dealt = stored(known.withColumn("cell", nearest("embedding")), "in-cells")
    sizes = dealt.groupBy("cell").agg(F.count("*").alias("n"))
    dealt = dealt.join(F.broadcast(sizes), "cell").withColumn("part", F.pmod(F.xxhash64("chunk_id"), F.ceil(F.col("n") / pack)))

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        x, cell = np.stack(pdf["embedding"].to_numpy()).astype(np.float64), int(pdf["cell"].iloc[0])
        return pd.DataFrame({"cell": [cell], "chunk_ids": [pdf["chunk_id"].tolist()], "vectors": [x.tobytes()], "radius": [float(np.sqrt(((x - sent.value[cell]) ** 2).sum(1).max()))]})

    return stored(dealt.groupBy("cell", "part").applyInPandas(packed, "cell int, chunk_ids array<string>, vectors binary, radius double"), "packs"), centres


def met_by(matrix: np.ndarray, centre: np.ndarray, radius: float, least: np.ndarray) -> np.ndarray:
    """Which questions may have a vector of the pack at or above ``least``: a product with a vector is that with the centre and at
    most length times radius more."""
    return np.flatnonzero(matrix @ centre + np.sqrt((matrix * matrix).sum(1)) * radius >= least - 1e-9)


def dense_in_cells(questions: DataFrame, packs: DataFrame, centres: np.ndarray, pool: int = 2 * TOP_K, block: int = BLOCK) -> DataFrame:
    """The same as dense(), from vector_cells(): the cell nearest to a question gives scores to begin with, and packs that cannot
    reach the last of them are not scored. Questions go in blocks, one after the other; of each a matrix is broadcast."""
    spark, kind = questions.sparkSession, questions.schema["question_id"].dataType.simpleString()
    asked = questions.select("question_id", "embedding")
    n = max(1, -(-asked.count() // block))
    asked, found = asked.withColumn("_block", F.pmod(F.xxhash64("question_id"), F.lit(n))), None

    def scored(names: np.ndarray, matrix: np.ndarray, home: np.ndarray, least: np.ndarray, at_home: bool) -> DataFrame:
        sent = spark.sparkContext.broadcast((names, matrix, home, least))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            names, matrix, home, least = sent.value
            for pdf in batches:
                for cell, ids, raw, radius in zip(pdf["cell"], pdf["chunk_ids"], pdf["vectors"], pdf["radius"]):
                    who = np.flatnonzero(home == cell) if at_home else met_by(matrix, centres[cell], radius, least)
                    who = who if at_home else who[home[who] != cell]
                    if len(who):
                        yield _frame(names[who], np.asarray(ids), _best(matrix[who], np.frombuffer(raw, np.float64).reshape(len(ids), -1), pool, least[who]))

        near = packs.filter(F.col("cell").isin(np.unique(home).tolist())) if at_home else packs
        return near.mapInPandas(run, f"question_id {kind}, chunk_id string, score double")

    for k in range(n):
        names, matrix = _questions(asked.filter(F.col("_block") == k))
        if not len(names) or not len(centres):
            continue
        home = (matrix @ centres.T - (centres * centres).sum(1) / 2).argmax(1)
        first = stored(scored(names, matrix, home, np.full(len(names), -np.inf), True), "at-home")
        full = ranked(first, pool).filter(F.col("rank") == pool).select("question_id", "score").collect()
        known = {r["question_id"]: r["score"] for r in full}
        rows = first.unionByName(scored(names, matrix, home, np.array([known.get(q, -np.inf) for q in names]), False))
        found = rows if found is None else found.unionByName(rows)
    return spark.createDataFrame([], f"question_id {kind}, chunk_id string, score double") if found is None else found


def ranked(scores: DataFrame, pool: int = 2 * TOP_K, digits: int = 9) -> DataFrame:
    """Best ``pool`` of each question with rank from 1; of equal scores (rounded) the later chunk first."""
    order = W.partitionBy("question_id").orderBy(F.round("score", digits).desc(), F.col("chunk_id").desc())
    return scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= pool)


def fused(dense_ranks: DataFrame, bm25_ranks: DataFrame, top_k: int | None = TOP_K) -> DataFrame:
    """question_id, chunk_id, score, dense_rank, bm25_rank, position: best top_k by the sum of 1 / (RRF_K + rank)."""
    d = dense_ranks.select("question_id", "chunk_id", F.col("rank").alias("dense_rank"))
    b = bm25_ranks.select("question_id", "chunk_id", F.col("rank").alias("bm25_rank"))
    both = d.join(b, ["question_id", "chunk_id"], "full_outer")
    part = lambda c: F.coalesce(1 / (RRF_K + F.col(c)), F.lit(0.0))
    both = both.withColumn("score", part("dense_rank") + part("bm25_rank"))
    order = W.partitionBy("question_id").orderBy(F.round("score", 12).desc(), F.col("dense_rank").asc_nulls_last(), F.col("bm25_rank").asc_nulls_last())
    return both.withColumn("position", F.row_number().over(order)).filter(F.col("position") <= (top_k or TOP_K))


def with_neighbours(chunks: DataFrame, neighbours: int = 1, wanted: DataFrame | None = None) -> DataFrame:
    """chunk_id, context: the text between up to ``neighbours`` chunks of the same recording on each side.

    wanted (chunk_id): only these have one. Then the texts that are needed are looked up, and no other text moves: chunk numbers
    of a recording have no gaps, so those of the neighbours are known.
    """
    if wanted is None:
        span = W.partitionBy("video_id").orderBy("chunk_no").rowsBetween(-neighbours, neighbours)
        return chunks.select("chunk_id", F.array_join(F.collect_list("text").over(span), " ").alias("context"))
    near = F.explode(F.sequence(F.col("chunk_no") - neighbours, F.col("chunk_no") + neighbours))
    wanted = few(stored(wanted.select("chunk_id").distinct(), "wanted"))
    own = stored(chunks.select("chunk_id", "video_id", "chunk_no").join(wanted, "chunk_id", "left_semi"), "own")
    # few are broadcast, and no text is exchanged
    told = chunks.select("video_id", "chunk_no", "text").join(few(own.select("chunk_id", "video_id", near.alias("chunk_no"))), ["video_id", "chunk_no"])
    said = told.groupBy("chunk_id").agg(F.sort_array(F.collect_list(F.struct("chunk_no", "text"))).alias("said"))
    return said.select("chunk_id", F.array_join(F.transform("said", lambda x: x["text"]), " ").alias("context"))


def candidate_report(candidates: DataFrame, chunks: DataFrame) -> DataFrame:
    """question_id, position, chunk_id, minute, dense_rank, bm25_rank, text (200 characters)."""
    shown = candidates.join(chunks.select("chunk_id", "start", "text"), "chunk_id")
    return shown.select("question_id", "position", "chunk_id", F.round(F.col("start") / 60).cast("long").alias("minute"), "dense_rank", "bm25_rank", F.substring("text", 1, 200).alias("text"))


def embed(df: DataFrame, encode: Callable[[list[str]], np.ndarray], key: str) -> tuple[DataFrame, DataFrame]:
    """(key, text) -> ((key, embedding), dead letters) by a pluggable encoder that maps a list of texts to a matrix. A text that it
    cannot take (a null one, say) is a dead letter; all others have their vectors."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf["text"].isna().any():
            raise ValueError("no text")
        return pd.DataFrame({key: pdf[key], "embedding": list(np.asarray(encode(list(pdf["text"])), np.float32))})

    kind = T.StructType([df.schema[key], T.StructField("embedding", T.ArrayType(T.FloatType()))])
    return guarded(df.select(key, "text"), run, kind, key, "embed")


def analysed(terms: DataFrame, known: DataFrame, analyse: Callable[[list[str]], list[str]]) -> tuple[DataFrame, DataFrame]:
    """(term) x a dictionary (word, lemma) -> (what the dictionary lacks: word, lemma; dead letters). Only distinct words that are
    not in it go to ``analyse``, which maps a list of words to their normal forms."""
    new = terms.select(F.col("term").alias("word")).distinct().join(known.select("word"), "word", "left_anti")
    kind = T.StructType([T.StructField("word", T.StringType()), T.StructField("lemma", T.StringType())])
    return guarded(new, lambda pdf: pd.DataFrame({"word": pdf["word"], "lemma": list(analyse(list(pdf["word"])))}), kind, "word", "analyse")


def occurrences(chunks: DataFrame, **groups: Column) -> DataFrame:
    """The groups, term, n: how often each word is there, whatever the chunk (null text: no words). Counted where the texts lie, so that what is exchanged
    grows with the words that are different."""
    return chunks.select(*(x.alias(name) for name, x in groups.items()), F.explode(tokens(F.col("text"))).alias("term")).groupBy(*groups, "term").agg(F.count("*").alias("n"))


def lemma_counts(counted: DataFrame, lemmas: DataFrame) -> DataFrame:
    """occurrences() and lemmas (word, lemma) -> term, n: of each normal form. A word is looked up once, however often it is there."""
    named = lemmas.select(F.col("word").alias("term"), "lemma").dropDuplicates(["term"])
    return counted.groupBy("term").agg(F.sum("n").alias("n")).join(named, "term", "left").groupBy(F.coalesce("lemma", "term").alias("term")).agg(F.sum("n").alias("n"))


def learn_lemmas(chunks: DataFrame, dictionary: Batches, batch: str, analyse: Callable[[list[str]], list[str]]) -> DataFrame:
    """The lemmas (word, lemma) of all words of the dictionary and the chunks; what was new is published as a batch. Words that the
    analyser could not take keep their own form, and are asked again next time. Chunks that are counted already (term) are not
    read again."""
    known = dictionary.read("lemmas", LEMMAS)
    terms = chunks if "term" in chunks.columns else occurrences(chunks)
    new, _ = analysed(terms.select("term"), known, analyse)
    if not new.isEmpty():
        dictionary.append(batch, lemmas=new)
    return dictionary.read("lemmas", LEMMAS)
