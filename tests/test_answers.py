"""Quotes, citations, plans, checks and artifacts on small tables."""

import hashlib
import json
import random
from difflib import SequenceMatcher

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lectio.operators import planning, replies, reports, retrieval
from lectio.sources import artifacts

CHUNK = "chunk_id string, video_id string, chunk_no int, start double, end double, text string"
SOURCE = "Поппер считал, что критерием научности теории является её фальсифицируемость, а не подтверждаемость."


def chunks(spark, *texts):
    return spark.createDataFrame([(f"v:{i:04d}", "v", i, i * 90.0, i * 90.0 + 90, x) for i, x in enumerate(texts)], CHUNK)


def verified(spark, quote, source):
    df = spark.createDataFrame([(quote, source)], "quote string, source string")
    return replies.verify_quotes(df).first()["verified"]


def test_quotes(spark):
    assert verified(spark, "критерием научности теории", SOURCE)
    assert verified(spark, "КРИТЕРИЕМ научности — теории!", SOURCE)
    assert verified(spark, "критерием научности теорий является её фальсифицируемость", SOURCE)
    assert not verified(spark, "Платон написал диалог о государстве и законах", SOURCE)
    assert not verified(spark, "наука", SOURCE)
    assert not verified(spark, "критерием научности теории", "")
    assert not verified(spark, None, None)


def test_the_bound_is_never_below_the_share(spark):
    pairs = [("abcdefghijkl", "abcdxxefghijkl"), ("aaaaaaaaaaaa", "aaaa"), ("abcabcabcabc", "cabcab"), ("qwertyuiopas", "zzzz")]
    df = spark.createDataFrame(pairs, "a string, b string").select(replies.gram_bound(F.col("a"), F.col("b")).alias("most"), replies.matched_share("a", "b").alias("share"))
    assert all(r["most"] >= r["share"] for r in df.collect())


def test_citations_are_numbered_without_gaps(spark):
    known = chunks(spark, SOURCE, "Второй фрагмент говорит о другом предмете.")
    claims = spark.createDataFrame([(1, 1, "v:0000", "критерием научности теории"), (1, 2, "x:0000", "критерием научности теории"), (1, 3, "v:0001", "говорит о другом предмете"), (1, 4, "v:0001", " ")], "answer_id int, position int, chunk_id string, quote string")
    found = replies.build_citations(claims, known).orderBy("position").collect()
    assert [(r["kept"], r["n"]) for r in found] == [(True, 1), (False, None), (True, 2), (False, None)]


def test_quote_starts_in_its_segment(spark):
    parts = spark.createDataFrame([("c", 0, 600.0, "начало лекции о науке"), ("c", 1, 608.0, "Поппер считал критерием"), ("c", 2, 612.0, "научности теории опровержимость")], "chunk_id string, seg_no int, start double, text string")
    claims = spark.createDataFrame([(1, "c", "считал критерием", 600.0), (2, "c", "критерием научности теории", 600.0), (3, "c", "чего-то нет вовсе", 600.0), (4, "c", "наука", 599.0)], "claim_id int, chunk_id string, quote string, chunk_start double")
    assert {r["claim_id"]: r["start"] for r in replies.quote_starts(claims, parts).collect()} == {1: 608.0, 2: 608.0, 3: 600.0, 4: 599.0}


def test_overlap_join_counts_a_pair_once(spark):
    c = spark.createDataFrame([("a", "v", 0.0, 200.0)], "chunk_id string, video_id string, start double, end double")
    s = spark.createDataFrame([("v", 0, 0.0, 190.0, "x"), ("v", 1, 190.0, 200.0, "y"), ("v", 2, 200.0, 210.0, "z"), ("w", 0, 0.0, 9.0, "q")], "video_id string, seg_no int, start double, end double, text string")
    assert sorted(r["seg_no"] for r in replies.chunk_segments(c, s).collect()) == [0, 1]


def test_whole_answers(spark):
    known = chunks(spark, SOURCE)
    raw = [(1, 1, "garbage"), (1, 2, "```json\n" + json.dumps({"answer_md": "a [1] b [2]", "citations": [{"chunk_id": "x", "quote": "q"}, {"chunk_id": "v:0000", "quote": "критерием научности теории"}], "coverage": "full", "outside_lectures_md": " ", "readings": [{"text": "book", "chunk_id": "v:0000"}, {"text": " ", "chunk_id": "v:0000"}], "more": 1}) + "\n```"), (2, 1, '{"answer_md": "x", "coverage": "whole"}'), (2, 2, "no")]
    good, bad = replies.parse_answers(spark.createDataFrame(raw, "request_id int, attempt int, raw string"))
    assert [(r["request_id"], r["raw"]) for r in bad.collect()] == [(2, "no")]
    (a,) = replies.assemble_answers(good, known).collect()
    assert (a["answer_md"], a["coverage"], a["outside_lectures_md"], list(a["dropped"])) == ("a  b [1]", "partial", None, [1])
    assert [(c["n"], c["chunk_id"]) for c in a["citations"]] == [(1, "v:0000")] and [r["text"] for r in a["readings"]] == ["book"]


def test_extracts_keep_fragments_whose_quote_is_not_there(spark):
    known = chunks(spark, SOURCE, "Второй фрагмент.")
    candidates = spark.createDataFrame([("q", 1, "v:0000"), ("q", 2, "v:0001"), ("q", 3, "v:0001"), ("q", 4, "v:0001"), ("q", 5, "v:0000"), ("r", 1, "v:0000")], "question_id string, position int, chunk_id string")
    judged = spark.createDataFrame([("q", 1, True, 0.5, ["p"], "нет такого нигде вообще", ["r", " "]), ("q", 2, True, 0.9, ["p"], "", []), ("q", 3, True, 0.9, [], "", []), ("q", 4, False, 1.0, ["p"], "", [])], "question_id string, position int, relevant boolean, relevance double, points array<string>, quote string, readings array<string>")
    asked = spark.createDataFrame([("q", "h1"), ("r", "h2"), ("s", "h3")], "question_id string, input_hash string")
    x, r, none = replies.assemble_extracts(candidates, judged, known, asked, "m").orderBy("question_id").collect()
    assert [(c["chunk_id"], c["quote"]) for c in x["relevant"]] == [("v:0001", "Второй фрагмент."), ("v:0000", SOURCE[:300])]
    assert [(c["text"], c["chunk_id"]) for c in x["readings"]] == [("r", "v:0000")]
    # the one that was not judged counts; a question whose replies all failed, and one without candidates, have empty extracts
    assert (x["candidates"], x["model"], x["prompt_version"], x["input_hash"], x["schema_version"]) == (5, "m", "extract_v1", "h1", 1)
    assert (r["candidates"], r["relevant"], r["readings"], r["input_hash"]) == (1, [], [], "h2") and (none["candidates"], none["relevant"]) == (0, [])


def test_many_quotes_of_a_chunk_share_its_table(spark, monkeypatch):
    rng = random.Random(4)
    source = "".join(rng.choice("abc ") for _ in range(400))
    needles = [source[i : i + 30].replace("a", rng.choice("ab")) for i in range(200)] + [None, ""]
    built = []
    places = replies.places_of
    monkeypatch.setattr(replies, "places_of", lambda *x: built.append(1) or places(*x))
    found = replies.shares(needles, [source] * 202, 0.5)
    assert len(built) == 1 and found == [replies.share_in_blocks(x, source, 0.5) if x else 0.0 for x in needles]
    assert [round(x, 9) for x in replies.shares(needles[:200], [source] * 200)] == [round(sum(b.size for b in SequenceMatcher(None, x, source, autojunk=False).get_matching_blocks() if b.size >= 4) / len(x), 9) for x in needles[:200]]


def test_prompt_values_as_json(spark):
    values = {"name": "Ё {n}", "n": 3, "x": 0.5, "big": 1e16, "flag": True, "list": ["a\n\"b\"", "ж"], "none": [], "o": {"k": [1, None]}, "m": {"u": 1}, "gone": None}
    df = spark.createDataFrame([tuple(values.values())], "name string, n int, x double, big double, flag boolean, list array<string>, none array<int>, o struct<k:array<int>>, m map<string,int>, gone string")
    template, expected = "|".join("{" + k + "}" for k in values), "|".join("{" + k + "}" for k in values)
    for k, v in values.items():
        expected = expected.replace("{" + k + "}", v if isinstance(v, str) else json.dumps(v, ensure_ascii=False, indent=2))
    assert planning.prompts(df, template, list(values)).first()["prompt"] == expected


def test_fusion_and_ties(spark):
    s = "question_id int, chunk_id string, rank int"
    d = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], s)
    b = spark.createDataFrame([(1, "b", 1), (1, "c", 2)], s)
    found = retrieval.fused(d, b).orderBy("position").collect()
    assert [r["chunk_id"] for r in found] == ["b", "a", "c"]
    assert [r["chunk_id"] for r in retrieval.fused(d, b, 1).collect()] == ["b"]
    ranks = retrieval.ranked(spark.createDataFrame([(1, "a", 0.5), (1, "b", 0.5)], "question_id int, chunk_id string, score double"))
    assert {r["chunk_id"]: r["rank"] for r in ranks.collect()} == {"b": 1, "a": 2}


def test_missing_vectors_leave_bm25(spark, tmp_path):
    none = artifacts.load_vectors(spark, str(tmp_path / "nothing"))
    assert none.count() == 0
    df = spark.createDataFrame([("a", [1.0])], "chunk_id string, embedding array<float>")
    assert artifacts.save_vectors(df, str(tmp_path / "v")) and not artifacts.save_vectors(df, str(tmp_path / "v"))
    assert artifacts.load_vectors(spark, str(tmp_path / "v")).count() == 1


def test_context_stays_in_the_recording(spark):
    known = chunks(spark, "a", "b", "c").unionByName(spark.createDataFrame([("w:0000", "w", 0, 0.0, 1.0, "z")], CHUNK))
    expected = {"v:0000": "a b", "v:0001": "a b c", "v:0002": "b c", "w:0000": "z"}
    assert {r["chunk_id"]: r["context"] for r in retrieval.with_neighbours(known).collect()} == expected
    assert {r["chunk_id"]: r["context"] for r in retrieval.with_neighbours(known, wanted=known.union(known)).collect()} == expected
    few = retrieval.with_neighbours(known, 2, known.filter("chunk_no = 2"))
    assert [tuple(r) for r in few.collect()] == [("v:0002", "a b c")] and "Window" not in few._jdf.queryExecution().toString()


def test_registration(spark):
    entry = "array<struct<id:string,title:string,duration:double>>"
    df = spark.createDataFrame([("c", 0, "playlist", "p", None, None, [("a", "A", 5.0), None, ("b", None, 0.0)]), ("c", 1, "video", "a", "again", 1.0, None), ("c", 2, "video", "d", "D", 2.0, None)], f"course string, url_pos int, type string, id string, title string, duration double, entries {entry}")
    assert [(r["video_id"], r["title"], r["duration_s"], r["order"]) for r in planning.registered(df).orderBy("order").collect()] == [("a", "A", 5.0, 1), ("b", "b", None, 2), ("d", "D", 2.0, 3)]


def test_related_questions(spark):
    df = spark.createDataFrame([("w", "s13", ["g16", "g17"])], "crosswalk_id string, course_question string, general array<string>")
    assert {r["question_id"]: list(r["related"]) for r in reports.related_questions(df).collect()} == {"s13": ["g16", "g17"], "g16": ["s13"], "g17": ["s13"]}


def test_number_gaps_and_audit(spark):
    df = spark.createDataFrame([("a", "full", [(1,), (2,), (3,)]), ("b", "full", [(2,)]), ("c", "partial", [])], "question_id string, coverage string, citations array<struct<n:int>>")
    assert [r["question_id"] for r in reports.gaps_in_numbers(df).collect()] == ["b"]
    assert sorted((r["question_id"], r["allowed"]) for r in reports.coverage_audit(df).collect()) == [("b", "partial"), ("c", "not_found")]


def test_files(spark, tmp_path):
    for name, body in (("good.json", {"slug": "c", "title": "Тема"}), ("bad.json", None)):
        (tmp_path / name).write_text(json.dumps(body, ensure_ascii=False) if body else "{oops", encoding="utf-8")
    good, bad = artifacts.read_objects(spark, str(tmp_path), artifacts.COURSE)
    assert [r["title"] for r in good.collect()] == ["Тема"] and bad.count() == 1
    lines = tmp_path / "chunks.jsonl"
    lines.write_text('{"chunk_id": "v:0000", "text": "a"}\n\n', encoding="utf-8")
    assert artifacts.read_lines_json(spark, str(lines)).count() == 1
    assert artifacts.read_lines_json(spark, str(tmp_path / "none.jsonl")).count() == 0
    out = str(tmp_path / "out")
    artifacts.write_objects(spark.createDataFrame([("c", "Тема"), ("d", "x")], "course string, title string"), out)
    artifacts.write_objects(spark.createDataFrame([("d", "y")], "course string, title string"), out)
    assert sorted((r["course"], r["title"]) for r in spark.read.json(out).collect()) == [("c", "Тема"), ("d", "y")]


def test_question_set_files(spark, tmp_path):
    (tmp_path / "s.yaml").write_text(json.dumps({"id": "s", "kind": "course", "questions": [{"id": "s01", "number": 1, "text": "Вопрос"}]}), encoding="utf-8")
    (tmp_path / "crosswalk-s.yaml").write_text("{}", encoding="utf-8")
    sets = artifacts.exploded_sets(artifacts.read_question_sets(spark, str(tmp_path))[0])
    assert [(r["question_id"], r["text"]) for r in sets.collect()] == [("s01", "Вопрос")]
    assert artifacts.read_question_sets(spark, str(tmp_path), crosswalks=True)[0].count() == 1
    (tmp_path / "broken.yaml").write_text("{oops: [", encoding="utf-8")
    good, bad = artifacts.read_question_sets(spark, str(tmp_path))
    assert good.count() == 1 and [r["id"].rsplit("/", 1)[1] for r in bad.collect()] == ["broken.yaml"]


def test_chunks_lie_in_the_order_of_the_recordings(spark, tmp_path):
    rows = [(c, o, n, f"{c}{o}:{n:04d}", "x") for c in "ab" for o in range(9) for n in range(12)]
    random.Random(3).shuffle(rows)
    artifacts.write_chunks(spark.createDataFrame(rows, "course string, order int, chunk_no int, chunk_id string, text string").repartition(5), str(tmp_path / "out"))
    for c in "ab":
        names = sorted((tmp_path / "out" / f"course={c}").glob("part-*"))
        lines = [json.loads(x) for f in names for x in f.read_text().splitlines()]
        assert [(x["order"], x["chunk_no"]) for x in lines] == [(o, n) for o in range(9) for n in range(12)]


def test_rules(spark):
    df = spark.createDataFrame([(1, " a -> x "), (2, "# c"), (3, "no arrow"), (4, "b -> y -> z"), (5, "a -> w")], "pos int, value string")
    rules, odd = artifacts.replacement_rules(df)
    assert sorted(map(tuple, rules.collect())) == [(1, "a", "w"), (4, "b", "y -> z")] and odd.count() == 1


def test_dead_letters_are_appended(spark, tmp_path):
    bad = spark.createDataFrame([(1, "x")], "request_id int, raw string")
    for _ in range(2):
        artifacts.dead_letters(bad, "L", str(tmp_path / "dead"))
    assert spark.read.json(str(tmp_path / "dead")).count() == 2


def test_lemmas_and_bm25(spark):
    known = chunks(spark, "кошки спят", "собака спит и спит", "о кошке ни слова", "пусто")
    lemmas = spark.createDataFrame([("кошки", "кошка"), ("кошке", "кошка")], "word string, lemma string")
    posted = retrieval.postings(known, lemmas)
    n, average = retrieval.corpus_size(known, posted)
    asked = spark.createDataFrame([(1, "Кошка")], "question_id int, text string")
    scores = retrieval.bm25(asked, posted, retrieval.term_weights(posted, n), n, average, lemmas)
    # the word is in half of the chunks, so its weight is none, and nothing is above 0
    assert scores.count() == 0
    one = spark.createDataFrame([(1, "собака собака")], "question_id int, text string")
    assert [r["chunk_id"] for r in retrieval.bm25(one, posted, retrieval.term_weights(posted, n), n, average).collect()] == ["v:0001"]


def extract_of(spark, *replies_in_order):
    raw = spark.createDataFrame([(1, i, x) for i, x in enumerate(replies_in_order)], "request_id int, attempt int, raw string")
    good, bad = replies.parse_extracts(raw)
    return ([tuple(r) for r in good.drop("request_id").collect()] or [None])[0], [r["raw"] for r in bad.collect()]


@pytest.mark.parametrize("reply, expected", [
    ('{"relevant": true}', (True, 0.0, [], "", [])),
    ('{"relevant": "yes", "relevance": "0.5"}', (True, 0.5, [], "", [])),
    ('{"relevant": "OFF", "relevance": 1, "points": ["a", "b"], "quote": "q", "more": {}}', (False, 1.0, ["a", "b"], "q", [])),
    ('{"relevant": 1, "relevance": true, "readings": []}', (True, 1.0, [], "", [])),
    ('{"relevant": 0.0, "relevance": " 2.5e-1 "}', (False, 0.25, [], "", [])),
    ("{}", None), ('{"relevant": null}', None), ('{"relevant": 2}', None), ('{"relevant": "maybe"}', None), ('{"relevant": true, "relevance": 1.5}', None),
    ('{"relevant": true, "relevance": "0.5d"}', None), ('{"relevant": true, "relevance": "half"}', None), ('{"relevant": true, "relevance": null}', None),
    ('{"relevant": true, "points": "a"}', None), ('{"relevant": true, "points": ["a", 1]}', None), ('{"relevant": true, "points": [null]}', None), ('{"relevant": true, "quote": 5}', None), ('[true]', None), ("{oops", None),
])
def test_fields_of_a_reply_have_their_types(spark, reply, expected):
    good, bad = extract_of(spark, reply)
    assert (good and tuple(list(x) if isinstance(x, list) else x for x in good[1:])) == expected and bad == ([] if expected else [reply])


def test_a_malformed_reply_leaves_the_next_attempt(spark):
    good, bad = extract_of(spark, '{"relevant": true, "points": "a"}', '{"relevant": false}', '{"relevant": true}')
    assert (good[0], good[1], bad) == (1, False, [])


@pytest.mark.parametrize("more, ok", [
    ({}, True), ({"citations": [{"chunk_id": "a", "more": 1}], "readings": [{"text": "t", "chunk_id": "c"}]}, True), ({"citations": 3}, False), ({"answer_md": 5}, False), ({"coverage": "whole"}, False),
    ({"citations": [{"quote": "q"}]}, False), ({"citations": [{"chunk_id": "a", "quote": None}]}, False), ({"citations": ["a"]}, False), ({"readings": [{"text": "t"}]}, False), ({"outside_lectures_md": None}, False), ({"citations": {}}, False),
])
def test_fields_of_an_answer_have_their_types(spark, more, ok):
    raw = json.dumps({"answer_md": "a", "coverage": "full"} | more)
    good, bad = replies.parse_answers(spark.createDataFrame([(1, 1, raw)], "request_id int, attempt int, raw string"))
    assert (good.count(), bad.count()) == (int(ok), int(not ok))


@given(st.text("ab ", max_size=20), st.text("ab ", max_size=40), st.integers(0, 20))
def test_blocks_are_those_of_a_plain_matcher(needle, source, cut):
    source = source + needle[cut:] + source[:5] + needle[:cut]
    if needle:
        blocks = SequenceMatcher(None, needle, source, autojunk=False).get_matching_blocks()
        assert replies.share_in_blocks(needle, source) == sum(b.size for b in blocks if b.size >= 4) / len(needle)


def test_many_questions_meet_the_vectors_in_blocks(spark):
    rng = random.Random(2)
    vector = lambda: [rng.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(4)]
    asked = [(i, vector()) for i in range(11)]
    known = [(f"c{i}", vector()) for i in range(37)]
    q, v = spark.createDataFrame(asked, "question_id int, embedding array<float>"), spark.createDataFrame(known, "chunk_id string, embedding array<float>")
    one, many = (sorted(map(tuple, retrieval.ranked(retrieval.dense(q, v, pool=5, block=n, cell=9), pool=5).collect())) for n in (50, 3))
    assert one == many and len(one) == 55
    score = {(i, c): sum(a * b for a, b in zip(x, y)) for i, x in asked for c, y in known}
    best = {(i, c) for i, _ in asked for c, _ in sorted(known, key=lambda k: (round(score[i, k[0]], 9), k[0]), reverse=True)[:5]}
    assert {(r[0], r[1]) for r in one} == best
    assert retrieval.dense(q.limit(0), v).count() == retrieval.dense(q, v.limit(0), block=3).count() == 0
    packs, centres = retrieval.vector_cells(v, pack=4)
    for block in (50, 3):
        assert sorted(map(tuple, retrieval.ranked(retrieval.dense_in_cells(q, packs, centres, pool=5, block=block), pool=5).collect())) == one
    assert packs.agg(F.max(F.size("chunk_ids"))).first()[0] <= 37 and packs.agg(F.sum(F.size("chunk_ids"))).first()[0] == 37
    assert retrieval.dense_in_cells(q.limit(0), packs, centres).count() == 0
    none, nowhere = retrieval.vector_cells(v.limit(0))
    assert retrieval.dense_in_cells(q, none, nowhere).count() == 0


def test_far_cells_are_skipped_and_copies_are_dealt(spark):
    """Vectors around five directions, a third of them copies of one: most packs cannot reach what the nearest cell gives."""
    rng = np.random.default_rng(5)
    middle = np.linalg.qr(rng.normal(size=(16, 16)))[0][:5]
    x = np.concatenate([np.repeat(middle[:1], 200, 0), middle[rng.integers(0, 5, 400)] + rng.normal(0, 0.02, (400, 16))])
    asked = middle + rng.normal(0, 0.02, (5, 16))
    v = spark.createDataFrame([(f"c{i:03d}", y.tolist()) for i, y in enumerate(x)], "chunk_id string, embedding array<double>")
    q = spark.createDataFrame([(i, y.tolist()) for i, y in enumerate(asked)], "question_id int, embedding array<double>")
    packs, centres = retrieval.vector_cells(v, most=20, pack=50)
    rows = lambda found: sorted((r["question_id"], r["rank"], r["chunk_id"], round(r["score"], 9)) for r in retrieval.ranked(found, 7).collect())
    assert rows(retrieval.dense_in_cells(q, packs, centres, 7)) == rows(retrieval.dense(q, v, 7))
    least = np.sort(asked @ x.T, 1)[:, -7]
    rows = packs.collect()
    assert max(len(r["chunk_ids"]) for r in rows) < 100
    met = sum(len(retrieval.met_by(asked, centres[r["cell"]], r["radius"], least)) for r in rows)
    assert met < 0.4 * len(rows) * len(asked)


def test_a_bad_row_costs_no_other(spark):
    def encode(texts):
        assert "bad" not in texts
        return np.array([[len(x)] for x in texts])

    df = spark.createDataFrame([(f"k{i}", "bad" if i == 7 else None if i == 3 else "x" * i) for i in range(20)], "chunk_id string, text string")
    good, dead = retrieval.embed(df, encode, "chunk_id")
    assert sorted((r["chunk_id"], r["embedding"][0]) for r in good.collect()) == sorted((f"k{i}", float(i)) for i in range(20) if i not in (3, 7))
    assert {(r["label"], r["id"]): r["error"].split(":")[0] for r in dead.collect()} == {("embed", "k3"): "ValueError", ("embed", "k7"): "AssertionError"}
    assert [x.count() for x in retrieval.embed(df.limit(0), encode, "chunk_id")] == [0, 0]


def test_finished_answers(spark):
    known = chunks(spark, SOURCE)
    raw = json.dumps({"answer_md": "a [1]", "coverage": "full", "citations": [{"chunk_id": "v:0000", "quote": "критерием научности теории"}]})
    good, _ = replies.parse_answers(spark.createDataFrame([("q", 1, raw)], "request_id string, attempt int, raw string"))
    asked = spark.createDataFrame([("q", "s", "Why?")], "question_id string, question_set string, text string")
    x = spark.createDataFrame([("q", "h", [("v:0000", ["p", "r"])])], "question_id string, input_hash string, relevant array<struct<chunk_id:string,points:array<string>>>")
    (a,) = planning.finished_answers(replies.assemble_answers(good, known), asked, x, "m", "tmpl").collect()
    assert a["input_hash"] == hashlib.sha256("Why?hv:0000p rmtmpl".encode()).hexdigest()
    assert (a["question_set"], a["question"], a["model"], a["coverage"], a["error"], len(a["citations"])) == ("s", "Why?", "m", "partial", None, 1) and a["generated_at"] is not None


def test_stored_answers_that_do_not_agree(spark):
    """Known cases of a stored corpus: one claims more than its citations allow, one has none, one is in the index alone."""
    answers = spark.createDataFrame([("s12", "full", [(1,)]), ("g09", "partial", []), ("s13", "full", [(1,), (2,), (3,)])], "question_id string, coverage string, citations array<struct<n:int>>")
    assert {(r["question_id"], r["allowed"]) for r in reports.coverage_audit(answers).collect()} == {("s12", "partial"), ("g09", "not_found")}
    index = spark.createDataFrame([("s12", "full", 1), ("g09", "partial", 0), ("s13", "full", 3), ("g04", "partial", 2)], "question_id string, coverage string, citations int")
    assert [tuple(r) for r in reports.manifest_drift(index, answers).collect()] == [("g04", "no answer")]


@pytest.mark.parametrize("question, sent", [("g14", 17), ("s01", 17), ("s05", 16), ("g16", 15)])
def test_answers_that_hashed_more_fragments_are_stale(spark, question, sent):
    fragments = [(f"v:{i:04d}", ["p"]) for i in range(sent)]
    x = spark.createDataFrame([(question, "m", "h", fragments)], "question_id string, model string, input_hash string, relevant array<struct<chunk_id:string,points:array<string>>>")
    asked = spark.createDataFrame([(question, "s", "Why?")], "question_id string, question_set string, text string")
    old = hashlib.sha256(("Why?h" + "".join(f"{c}p" for c, _ in fragments) + "mtmpl").encode()).hexdigest()
    stored = spark.createDataFrame([(question, "m", old, None)], "question_id string, model string, input_hash string, error string")
    assert planning.work_plan(asked, stored, x, "m", "tmpl").first()["ready"] == (sent <= 15)


def test_rules_of_every_kind(spark):
    df = spark.createDataFrame([("-a", "x", 2)], "slug string, title string, schema_version int").withColumn("question_sets", F.array(F.lit("B")))
    assert {r["rule"] for r in reports.violations(df, ["title"], reports.patterns("course")).collect()} == {"slug", "question_sets", "schema_version"}
    df = spark.createDataFrame([("v", "video", "typed", [1])], "video_id string, kind string, source string, segments array<int>").withColumn("schema_version", F.lit(1))
    assert [r["rule"] for r in reports.violations(df, ["kind"], reports.patterns("transcript")).collect()] == ["source"]


def test_unknown_keys_at_every_level(spark):
    df = spark.createDataFrame([("f", '{"a": 1, "z": {"q": 1}, "list": [{"b": 1}, {"c": {"d": 1, "e": 2}}, 5, null]}'), ("g", "no json"), ("h", '{"list": {"w": 1}}')], "path string, raw string")
    found = reports.unknown_keys(df, {"": ["a", "list"], "list": ["b", "c"], "list.c": ["d"]})
    assert sorted(map(tuple, found.collect())) == [("f", "list.c.e"), ("f", "z"), ("h", "list.w")]


def test_sets_crosswalks_and_courses_are_checked_together(spark):
    raw = lambda *files: spark.createDataFrame([(p, json.dumps(x)) for p, x in files], "path string, raw string")
    q = lambda *ids: [{"id": x, "number": i + 1, "text": "?"} for i, x in enumerate(ids)]
    sets = raw(("/s/a.yaml", {"id": "a", "title": "A", "kind": "course", "questions": q("a01", "a02")}), ("/s/b.yaml", {"id": "other", "title": "B", "kind": "general", "questions": q("a02", "b01")}), ("/s/c.yaml", {"id": "c", "title": "C", "kind": "odd", "questions": q("c01", "c01"), "typo": 1}))
    walks = raw(("/s/crosswalk-x.yaml", {"status": "draft", "pairs": [{"course": "a01", "general": ["b01", "c01"]}]}))
    courses = raw(("/c/ml/course.json", {"slug": "ml", "title": "M", "question_sets": ["a", "c"], "sources": []}), ("/c/x/course.json", {"slug": "y", "title": "Y", "question_sets": ["a"]}))
    found = {(r["path"], r["rule"], r["detail"]) for r in reports.findings(sets, walks, courses).collect()}
    assert found == {
        ("/s/b.yaml", "taken id", "a02"), ("/s/b.yaml", "name", "other"), ("/s/c.yaml", "invalid", "kind"), ("/s/c.yaml", "duplicate", "c01"), ("/s/c.yaml", "unknown key", "typo"),
        ("/s/crosswalk-x.yaml", "unknown question", "c01"), ("/c/ml/course.json", "unknown set", "c"), ("/c/x/course.json", "slug", "y"),
    }
    report = {r["path"]: (r["errors"], r["warnings"], r["ok"]) for r in reports.validated(sets, walks, courses).collect()}
    assert report["/s/a.yaml"] == (0, 0, True) and report["/s/b.yaml"] == (1, 1, False) and report["/s/c.yaml"] == (3, 0, False) and len(report) == 6


def test_chunks_are_written_by_course(spark, tmp_path):
    rows = chunks(spark, "a", "b").withColumn("course", F.lit("c")).withColumn("order", F.lit(1))
    artifacts.write_chunks(rows, str(tmp_path / "chunks"))
    assert sorted(r["text"] for r in artifacts.read_lines_json(spark, str(tmp_path / "chunks")).collect()) == ["a", "b"]
