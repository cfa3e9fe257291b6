"""Saved tables that grow, the index in segments, and rows numbered by ranges."""

import collections
import math
import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from lectio.operators import ordering, reports, retrieval, search
from lectio.operators import transcripts as tr
from lectio.sources import artifacts, batches
from lectio.sources.batches import Batches

CHUNK = "chunk_id string, text string"


def corpus(seed, n):
    rng = random.Random(seed)
    names = [f"w{i}" for i in range(300)]
    return [(f"c{i:04d}", " ".join(rng.choices(names, weights=[1 / (k + 1) for k in range(300)], k=rng.randrange(0, 60)))) for i in range(n)] + [("none", None), ("copy1", "w0 w1 w250"), ("copy2", "w0 w1 w250")]


def plain_bm25(chunks, questions, best):
    """{(question, chunk): score} of the best chunks by falling rounded score, then falling id."""
    tf = {k: collections.Counter((x or "").split()) for k, x in chunks}
    n, average = len(tf), sum(sum(c.values()) for c in tf.values()) / len(tf)
    df = collections.Counter(t for c in tf.values() for t in c)
    raw = {t: math.log(n - x + 0.5) - math.log(x + 0.5) for t, x in df.items()}
    mean = sum(raw.values()) / len(raw)
    idf = {t: x if x >= 0 else 0.25 * mean for t, x in raw.items()}
    out = {}
    for q, said in questions:
        scores = {k: sum(m * idf[t] * c[t] * 2.5 / (c[t] + 1.5 * (0.25 + 0.75 * sum(c.values()) / average)) for t, m in collections.Counter(said.split()).items() if t in c) for k, c in tf.items()}
        for k in sorted((k for k in scores if scores[k] > 0), key=lambda k: (round(scores[k], 9), k), reverse=True)[:best]:
            out[q, k] = round(scores[k], 6)
    return out


QUESTIONS = [(1, "w0 w1 w2 w9 w40 w41 w299"), (2, "w250 w250 w3"), (3, "nowhere"), (4, "w0")]


@pytest.mark.parametrize("size", [7, 40, 4096])
def test_best_matches_are_those_of_a_plain_count(spark, size):
    rows = corpus(1, 150)
    index = search.indexed(spark.createDataFrame(rows, CHUNK), size)
    asked = spark.createDataFrame(QUESTIONS, "question_id int, text string")
    for block in (4096, 2):
        got = retrieval.ranked(search.best_matches(asked, index, 9, block=block), 9)
        assert {(r["question_id"], r["chunk_id"]): round(r["score"], 6) for r in got.collect()} == plain_bm25(rows, QUESTIONS, 9)
    plan = search.best_matches(asked, index, 9)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert search.best_matches(asked, search.indexed(spark.createDataFrame([], CHUNK))).count() == search.best_matches(asked.limit(0), index).count() == 0


def test_an_index_by_lemmas(spark):
    """The same scores as those of the join."""
    rows = corpus(3, 60)
    chunks, asked = spark.createDataFrame(rows, CHUNK), spark.createDataFrame(QUESTIONS, "question_id int, text string")
    lemmas = spark.createDataFrame([(f"w{i}", f"w{i // 3}") for i in range(300)], "word string, lemma string")
    posted = retrieval.postings(chunks, lemmas)
    n, average = retrieval.corpus_size(chunks, posted)
    joined = retrieval.bm25(asked, posted, retrieval.term_weights(posted, n), n, average, lemmas)
    rows_of = lambda found: {(r["question_id"], r["chunk_id"]): round(r["score"], 6) for r in retrieval.ranked(found, 9).collect()}
    assert rows_of(search.best_matches(asked, search.indexed(chunks, 16, lemmas), 9, lemmas)) == rows_of(joined) != {}


def test_long_lists_are_not_read_where_nothing_can_be_among_the_best(spark):
    """A few chunks hold a rare passage amid frequent words."""
    rng = random.Random(8)
    rows = [(f"c{i:04d}", " ".join(rng.choices([f"w{k}" for k in range(30)], k=20)) + (" rare passage of words" if i % 100 == 0 else "")) for i in range(2000)]
    index = search.indexed(spark.createDataFrame(rows, CHUNK))
    (asked,) = search._blocks(spark.createDataFrame([(1, "w1 w2 w3 w4 rare passage of words")], "question_id int, text string"), index, None, 10)
    segment = index.segments.first().asDict()
    segment["terms"], segment["chunk_ids"] = pa.array(segment["terms"]), pa.array(segment["chunk_ids"])
    starts = np.frombuffer(segment["starts"], "<i4")
    there = [starts[i + 1] - starts[i] for i in pc.index_in(asked.terms, value_set=segment["terms"]).to_pylist()]
    ((_, kept, _, read),) = search.best_in(segment, asked, 10)
    assert len(kept) >= 10 and read < 0.2 * sum(there)


def test_an_index_that_grew_is_one_that_was_built_whole(spark, tmp_path):
    rows = corpus(2, 120)
    saved, asked = Batches(spark, str(tmp_path / "index")), spark.createDataFrame(QUESTIONS, "question_id int, text string")
    for name, part in (("a", rows[:50]), ("b", rows[50:]), ("b", rows[50:])):
        search.append_index(saved, spark.createDataFrame(part, CHUNK), name, size=16)
    grown = search.saved_index(saved)
    whole = search.indexed(spark.createDataFrame(rows, CHUNK))
    assert sorted(map(tuple, grown.terms.collect())) == sorted(map(tuple, whole.terms.collect()))
    assert (grown.chunks, grown.words) == (whole.chunks, whole.words) == (123, whole.words)
    assert {(r[0], r[1]) for r in retrieval.ranked(search.best_matches(asked, grown, 9), 9).collect()} == set(plain_bm25(rows, QUESTIONS, 9))
    both = search.indexed(spark.createDataFrame(rows[:50], CHUNK)).plus(search.indexed(spark.createDataFrame(rows[50:], CHUNK)))
    assert sorted(map(tuple, both.terms.collect())) == sorted(map(tuple, whole.terms.collect())) and both.words == whole.words


SEGMENTS = "video_id string, seg_no int, start double, end double, text string"


def test_a_batch_is_published_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    index = Batches(spark, str(tmp_path / "x"))
    assert index.read("chunks", tr.CHUNKS).count() == 0
    segments = spark.createDataFrame([(v, i, i * 40.0, i * 40.0 + 40, f"{v}{i}") for v in "ab" for i in range(5)], SEGMENTS)
    assert tr.append_windows(index, segments.filter("video_id = 'a'"), "one")
    move = batches.move

    def broken(*args):
        raise OSError("lost")

    monkeypatch.setattr(batches, "move", broken)
    with pytest.raises(OSError):  # between the writing and the new list
        tr.append_windows(index, segments, "two")
    assert {r["video_id"] for r in index.read("chunks", tr.CHUNKS).collect()} == {"a"}
    monkeypatch.setattr(batches, "move", move)
    assert tr.append_windows(index, segments, "two") and not tr.append_windows(index, segments, "two")
    found = [r["chunk_id"] for r in index.read("chunks", tr.CHUNKS).collect()]
    assert sorted(found) == sorted(r["chunk_id"] for r in tr.windows(segments).collect())
    with pytest.raises(ValueError, match="no chunks"):
        tr.append_windows(index, segments, "three")
    assert len(index.listed()) == 2


def test_words_are_analysed_once(spark, tmp_path):
    asked = spark.sparkContext.accumulator(0)

    def analyse(words):
        asked.add(len(words))
        assert "bad" not in words
        return [w[:2] for w in words]

    known, chunks = Batches(spark, str(tmp_path / "lemmas")), spark.createDataFrame([("a", "aaa aab bbb"), ("b", "aaa bad")], CHUNK)
    assert sorted(map(tuple, retrieval.learn_lemmas(chunks.filter("chunk_id = 'a'"), known, "1", analyse).collect())) == [("aaa", "aa"), ("aab", "aa"), ("bbb", "bb")]
    before = asked.value
    lemmas = retrieval.learn_lemmas(chunks, known, "2", analyse)
    assert asked.value - before == 1 and lemmas.count() == 3  # the new word alone, which the analyser cannot take
    assert sorted((r["chunk_id"], r["term"], r["tf"]) for r in retrieval.postings(chunks, lemmas).collect()) == [("a", "aa", 2), ("a", "bb", 1), ("b", "aa", 1), ("b", "bad", 1)]


def plain_windows(segments, window=90.0, overlap=15.0):
    segments = sorted(x for x in segments if x[1] is not None and x[2] is not None)
    out, at, n = [], 0, len(segments)
    while at < n:
        stop = max(next((j for j in range(at, n) if segments[j][2] - segments[at][1] > window), n), at + 1)
        text = " ".join(x[3] or "" for x in segments[at:stop]).strip()
        if text:
            out.append((len(out), segments[at][1], segments[stop - 1][2], text))
        if stop >= n:
            break
        back = [k for k in range(at + 1, stop) if segments[k][1] <= segments[stop - 1][2] - overlap]
        at = back[-1] if back else at + 1
    return out


@pytest.mark.parametrize("cell", [3, 32, 1024])
def test_windows_against_a_plain_walk(spark, cell):
    """Bounds out of order, gaps in the numbers, windows over several cells, nulls."""
    rng, rows, expected = random.Random(1), [], {}
    for v in range(9):
        at, number, own = 0.0, 0, []
        for _ in range(rng.choice([1, 2, 7, 30, 150])):
            takes, number = rng.choice([0.0, 3.0, 10.0, 40.0, 120.0]), number + rng.choice([1, 1, 2, 60 if v % 4 == 0 else 1])
            begin = at + rng.uniform(-20, 5) if v % 3 == 0 else at
            own.append((number, round(begin, 1), round(begin + takes, 1), rng.choice(["a", "b c", " ", None, "d"])))
            at += takes * rng.random()
        own.append((number + 1, None, at, "no start"))
        own.append((number + 2, at, None, "no end"))
        rows += [(f"v{v}", *x) for x in own]
        expected[f"v{v}"] = plain_windows(own)
    df, found = spark.createDataFrame(rows, SEGMENTS), collections.defaultdict(list)
    for r in tr.windows(df, cell=cell).collect():
        found[r["video_id"]].append((r["chunk_no"], r["start"], r["end"], r["text"]))
    assert {k: sorted(v) for k, v in found.items()} == {k: v for k, v in expected.items() if v}
    assert tr.without_bounds(df).count() == 18


def test_cleaning_counts_in_one_scan(spark):
    df = spark.createDataFrame([("v", i, 0.0, 0.0, x) for i, x in enumerate(["a", "a", " ", "a", "спасибо за просмотр", "b", None])] + [("w", 0, 0.0, 0.0, "...")], SEGMENTS)
    flags = tr.flagged(df)
    assert sorted(map(tuple, tr.clean_counts(flags).collect())) == [("v", 3, 4), ("w", 0, 1)]
    assert sorted((r["seg_no"], r["text"]) for r in tr.clean(df).collect()) == [(0, "a"), (1, "a"), (5, "b")]
    assert tr.clean_counts(flags)._jdf.queryExecution().executedPlan().toString().count("Scan ") == 1


def test_numbers_and_sums_in_an_order(spark):
    rng = random.Random(6)
    rows = [(rng.choice([None, "a", "b"]), rng.choice([None, *range(20)]), i) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, x int, id int").repartition(7)
    place = lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0, r[2])
    order = ["g", "x", "id"]
    inside, all_of = collections.Counter(), {}
    for i, r in enumerate(sorted(rows, key=place)):
        all_of[r[2]] = (i, inside[r[0]])
        inside[r[0]] += 1
    assert {r["id"]: r["number"] for r in ordering.numbered(df, order).collect()} == {k: v[0] for k, v in all_of.items()}
    assert {r["id"]: r["number"] for r in ordering.numbered(df, order, within=["g"]).collect()} == {k: v[1] for k, v in all_of.items()}
    sums, total = {}, 0
    for r in sorted(rows, key=place):
        sums[r[2]], total = total, total + r[2]
    assert {r["id"]: r["s"] for r in ordering.sum_before(df, order, "id", "s").collect()} == sums
    assert ordering.numbered(df.limit(0), order, within=["g"]).count() == ordering.sum_before(df.limit(0), order, "id", "s").count() == 0


def test_files_are_listed_where_they_lie(spark, tmp_path):
    root = tmp_path / "courses"
    for path in ("a/course.json", "a/audio/v1.wav", "a/audio/v1.m4a", "a/audio/v2.m4a", "a/transcripts/v1.json", "a/answers/q1.json", "a/answers/_half", "a/chunks.jsonl", "a/notes.txt", "b/course.json"):
        (root / path).parent.mkdir(parents=True, exist_ok=True)
        (root / path).write_text("{}")
    courses = spark.createDataFrame([("a",), ("b",), ("c",)], "course string")
    found = artifacts.list_artifacts(courses, str(root))
    assert {(r["course"], r["path"]): r["stage"] for r in found.collect()} == {
        ("a", "course.json"): "ingest", ("a", "audio/v1.wav"): "prepare-audio", ("a", "audio/v1.m4a"): "download", ("a", "audio/v2.m4a"): "download", ("a", "transcripts/v1.json"): "transcribe",
        ("a", "answers/q1.json"): "answer", ("a", "chunks.jsonl"): "index", ("a", "notes.txt"): None, ("b", "course.json"): "ingest",
    }
    assert all(r["bytes"] == 2 and r["modified"] is not None for r in found.collect())
    assert {r["path"] for r in reports.publishable(found.withColumn("path", found.path)).collect()} >= {"course.json", "answers/q1.json"}
    sources = spark.createDataFrame([("a",), ("a",), ("b",)], "course string")
    status = reports.stage_status(sources, reports.done_stages(found), spark.createDataFrame([("a",)], "course string"))
    assert {(r["course"], r["stage"]): (r["done"], r["total"]) for r in status.collect() if r["course"] == "a"} == {("a", "ingest"): (1, 2), ("a", "download"): (2, 2), ("a", "prepare-audio"): (1, 2), ("a", "transcribe"): (1, 2), ("a", "index"): (1, 1), ("a", "extract"): (0, 1), ("a", "answer"): (1, 1)}
