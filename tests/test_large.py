"""Operators and queries where a table outgrows one block, one row or one task."""

import hashlib
import json
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lectio import registry
from lectio.operators import planning, replies, reports, retrieval, search
from lectio.sources import artifacts, shared
from lectio.sources.batches import Batches
from lectio.sources.shared import stored


def test_questions_from_the_vectors_own_table_meet_them_in_blocks(spark):
    v = spark.createDataFrame([(f"v{i}", [float(i % 7), float(i % 5), 1.0]) for i in range(30)], "chunk_id string, embedding array<float>")
    q = v.filter("chunk_id < 'v2'").select(F.col("chunk_id").alias("question_id"), "embedding")
    one, many = (sorted(map(tuple, retrieval.ranked(retrieval.dense(q, v, 4, block=n, cell=9), 4).collect())) for n in (50, 3))
    assert many == one and len(one) == 11 * 4 + 4


def test_a_manifest_in_parts_is_the_one_of_a_row(spark, monkeypatch):
    monkeypatch.setattr(reports, "PART", 3)
    courses = spark.createDataFrame([("a", "A \"é\"", None, ["s"]), ("b", None, "de", []), ("none", "N", "de", ["s"])], "course string, title string, language string, question_sets array<string>")
    sources = spark.createDataFrame([("a", "v1"), ("a", "v2"), ("b", "v3")], "course string, video_id string")
    rows = [("ab"[i % 2], f"q{i * 7 % 40}", "s", ["full", None][i % 3 == 0], list(range(i % 4))) for i in range(50)] + [("unknown", "q", "s", "full", []), ("a", None, "s", "full", [])]
    answers = spark.createDataFrame(rows, "course string, question_id string, question_set string, coverage string, citations array<int>").repartition(5)
    whole = {r["course"]: hashlib.md5(r["as_json"].encode()).hexdigest() for r in reports.manifest(courses, sources, answers).collect()}
    parts = reports.manifest_parts(courses, sources, answers)
    assert len(whole) == 3 and dict(map(tuple, reports.manifest_digests(parts).collect())) == whole
    assert parts.filter("course = 'a' and part >= 0").count() >= 9


def test_words_of_a_slice_are_counted(spark):
    rows = [("a", "b a B ё-я"), ("b", None), ("c", " .,"), ("d", "z"), ("e", "a a a")] + [(f"x{i}", f"w{i % 7} w1 я") for i in range(40)]
    words = [re.findall("[а-яёa-z0-9]+", (x or "").lower()) for _, x in rows]
    said = [r[0] for r in spark.createDataFrame(rows, "chunk_id string, text string").coalesce(1).select(retrieval.said(F.col("text"))).collect()]
    assert said == [" ".join(x) for x in words]
    names, row, term, times = retrieval.counted(pa.array(said))
    assert [(i, names[t].as_py(), n) for i, t, n in zip(row.tolist(), term.tolist(), times.tolist())] == [(i, w, n) for i, x in enumerate(words) for w, n in sorted(Counter(x).items())]
    assert [len(x) for x in retrieval.counted(pa.array(["", ""]))] == [0] * 4


def test_lemmas_are_counted_without_reading_a_text_again(spark, tmp_path):
    rows = [("v1", "walked walks b-B"), ("v2", None), ("v2", "walked, walked"), ("v3", ".")]
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(text):
        read.add(1)
        return text

    chunks = spark.createDataFrame(rows, "video_id string, text string").withColumn("text", seen.asNondeterministic()("text"))
    counted = stored(retrieval.occurrences(chunks, one=F.col("video_id") == "v1"), "occurrences")
    dictionary = Batches(spark, str(tmp_path))
    first = retrieval.learn_lemmas(counted.filter("one"), dictionary, "one", lambda words: [w[:4] for w in words])
    assert sorted(map(tuple, first.collect())) == [("b", "b"), ("walked", "walk"), ("walks", "walk")]
    lemmas = retrieval.learn_lemmas(counted, dictionary, "all", lambda words: [w[:4] for w in words])
    assert sorted(map(tuple, retrieval.lemma_counts(counted, lemmas).collect())) == [("b", 2), ("walk", 4)]
    assert read.value == len(rows)


def test_an_index_of_long_chunks_has_small_segments_and_narrow_numbers(spark, monkeypatch):
    monkeypatch.setattr(search, "CHARACTERS", 2000)
    rows = [(f"c{i}", " ".join(f"w{i * k % 50}" for k in range(100)) + " few" * (300 if i == 3 else 1)) for i in range(60)]
    chunks, asked = spark.createDataFrame(rows, "chunk_id string, text string"), spark.createDataFrame([(1, "few w7"), (2, "w1 w2 none")], "question_id int, text string")
    index = search.indexed(chunks)
    segments = index.segments.collect()
    assert len(segments) >= 5 and max(len(s["chunk_ids"]) for s in segments) < 40
    assert all(len(s["places"]) == np.frombuffer(s["starts"], "<i4")[-1] for s in segments)
    posted = retrieval.postings(chunks)
    joined = retrieval.bm25(asked, posted, retrieval.term_weights(posted, 60), 60, index.words / 60)
    best = lambda found: {(r["question_id"], r["chunk_id"]): round(r["score"], 6) for r in retrieval.ranked(found, 9).collect()}
    assert best(search.best_matches(asked, index, 9)) == best(joined) != {}


def test_json_question_sets_are_not_parsed_as_yaml(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": "a", "questions": [{"id": "é", "number": 1, "text": "1e5: x"}]}')
    (tmp_path / "b.yaml").write_text("id: b\nquestions: []\n")
    (tmp_path / "c.json").write_text('{"id": 1e5}')  # a string in YAML
    good, dead = artifacts.read_question_sets(spark, str(tmp_path))
    raw = {r["path"].rsplit("/", 1)[1]: json.loads(r["raw"]) for r in good.collect()}
    assert raw == {"a.json": {"id": "a", "questions": [{"id": "é", "number": 1, "text": "1e5: x"}]}, "b.yaml": {"id": "b", "questions": []}, "c.json": {"id": 1e5}} and dead.count() == 0


def test_registration_deals_its_entries_by_their_number(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shared, "TASK_ROWS", 50)
    orders = spark.range(300).selectExpr("id as o_orderkey", "id % 7 as o_custkey")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    orders.selectExpr("o_orderkey as l_orderkey", "explode(sequence(1, 3)) as l_linenumber", "o_orderkey * 11 % 90 as l_partkey").write.parquet(f"{tmp_path}/lineitem.parquet")
    found, met = planning.numbered, []
    monkeypatch.setattr(planning, "numbered", lambda rows, *a: met.append(rows) or found(rows, *a))
    first = {}
    for k in range(300):
        for i in range(3) if k % 2 == 0 else range(1):
            first.setdefault((f"c{k % 7}", f"v{k * 11 % 90 if k % 2 == 0 else k}"), (k, i))
    courses = {c: sorted((at, v) for (x, v), at in first.items() if x == c) for c, _ in first}
    rows = {(r["course"], r["video_id"], r["order"]) for r in registry.e7_registered(spark, str(tmp_path)).collect()}
    assert rows == {(c, v, i + 1) for c, listed in courses.items() for i, (_, v) in enumerate(listed)}
    assert met[0].rdd.getNumPartitions() == 900 // 50  # the session has 4


def test_quotes_are_verified_once(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(quote):
        read.add(1)
        return quote

    said = ["the first line of a lecture", "and a second one that follows"]
    chunks = spark.createDataFrame([(f"v{i}:0000", f"v{i}", 0.0, 20.0, " ".join(said)) for i in range(9)], "chunk_id string, video_id string, start double, end double, text string")
    segments = spark.createDataFrame([(f"v{i}", k, k * 10.0, k * 10.0 + 10, x) for i in range(9) for k, x in enumerate(said)], "video_id string, seg_no int, start double, end double, text string")
    rows = [(i, k + 1, f"v{i}:0000", x) for i in range(10) for k, x in enumerate([said[0], "said by nobody at all", said[1].replace("second", "sekond"), None])]
    claims = spark.createDataFrame(rows, "answer_id int, position int, chunk_id string, quote string").withColumn("quote", seen.asNondeterministic()("quote"))
    found = {(r["answer_id"], r["position"]): (r["n"], r["start"]) for r in replies.build_citations(claims, chunks, segments).collect() if r["kept"]}
    assert found == {(i, p): at for i in range(9) for p, at in ((1, (1, 0.0)), (3, (2, 0.0)))}
    assert read.value == len(rows)


def test_joined_postings_send_the_best_of_a_cell_whatever_the_copies(spark):
    said = ["a b b c", "a c d d d", "b e", "f a a a g h", "", None, "x y"]
    rows = [(f"v{i:03d}", said[i % 7] + f" w{i % 3}" if said[i % 7] else said[i % 7]) for i in range(80)] + [(f"copy{i:03d}", "a b c") for i in range(300)]
    chunks = spark.createDataFrame(rows, "chunk_id string, text string").repartition(5)
    asked = spark.createDataFrame([(1, "a b a"), (2, "c c d w1"), (3, "unknown"), (4, None), (5, "h g f e w2"), (6, "a")], "question_id long, text string")
    posted = stored(retrieval.postings(chunks), "postings")
    n, average = retrieval.corpus_size(chunks, posted)
    weights = retrieval.term_weights(posted, n)
    every, best = retrieval.bm25(asked, posted, weights, n, average), lambda df: sorted((r["question_id"], r["rank"], r["chunk_id"], round(r["score"], 9)) for r in retrieval.ranked(df, 4).collect())
    assert every.count() > 700 and len(best(every)) == 4 * 4
    for sizes in ({}, {"block": 2, "cell": 40}, {"block": 1, "cell": 10**6}):
        found = stored(retrieval.bm25_best(asked, posted, weights, average, 4, **sizes), "found")
        assert best(found) == best(every)
    # two cells a core at least: of each fewer than twice 4 rows a question, though 300 copies tie
    assert found.count() < 2 * 4 * 4 * 2 * spark.sparkContext.defaultParallelism
    assert retrieval.bm25_best(asked.filter("question_id = 3"), posted, weights, average).count() == 0
    null = spark.createDataFrame([(None, "x y"), ("v", "x"), ("w", "z"), ("u", "z")], "chunk_id string, text string")
    posted = retrieval.postings(null)
    args = spark.createDataFrame([(None, "x y")], "question_id string, text string"), posted, retrieval.term_weights(posted, 4)
    assert sorted(map(str, retrieval.bm25_best(*args, 1.25).collect())) == sorted(map(str, retrieval.bm25(*args, 4, 1.25).collect())) != []
