"""Repair, cleaning and windows on small recordings."""

import random

import pytest

from lectio.operators import transcripts as tr

RAW = "video_id string, pos int, start double, end double, text string, duration double"
SEGMENTS = "video_id string, seg_no int, start double, end double, text string"


def rows(df, *columns):
    return [tuple(r) for r in df.orderBy("video_id", *([c for c in ("pos", "seg_no", "chunk_no") if c in df.columns])).select(*columns).collect()]


@pytest.mark.parametrize("raw, expected", [
    ([(5.0, None, "x", 12.5)], [(5.0, 12.5)]),
    ([(2583.44, 2575.0, "x", 3000.0)], [(2575.0, 2583.44)]),
    ([(10.0, None, "x", 60.0), (40.0, 50.0, "y", 60.0)], [(10.0, 40.0), (40.0, 50.0)]),
    ([(5334.02, 5318.4145, "x", 5057.0)], [(5057.0, 5057.0)]),
    ([(100.0, 100.0, "z" * 125, 900.0)], [(100.0, 110.0)]),
    ([(100.0, 100.0, "z" * 1000, 900.0), (103.0, 104.0, "y", 900.0)], [(100.0, 103.0), (103.0, 104.0)]),
    ([(None, 3.0, "x", 9.0), (4.0, 4.0, " ", 9.0)], [(4.0, 4.0)]),
    ([(1.0, None, "x", 9.0), (None, None, "y", 9.0)], [(1.0, 1.0 + 1 / 12.5)]),
])
def test_bounds(spark, raw, expected):
    df = spark.createDataFrame([("v", i, *x) for i, x in enumerate(raw)], RAW)
    assert rows(tr.repair_bounds(df), "start", "end") == expected


def words(spark, *parts, duration=100.0):
    return tr.words_to_segments(spark.createDataFrame([("v", i, *x, duration) for i, x in enumerate(parts)], RAW))


def test_words_are_cut_at_pauses(spark):
    found = words(spark, (0.0, 0.5, " раз"), (0.5, 1.0, " два"), (5.0, 5.5, " три"))
    assert rows(found, "start", "end", "text") == [(0.0, 1.0, "раз два"), (5.0, 5.5, "три")]


def test_untimed_words_join_what_is_open(spark):
    assert rows(words(spark, (0.0, 0.4, " раз"), (None, None, " два"), (0.5, 0.9, " три")), "text") == [("раз два три",)]
    assert rows(words(spark, (None, None, "lost")), "text") == []


def test_long_segments_are_cut(spark):
    found = words(spark, *[(float(i), i + 1.0, f" {i}") for i in range(50)])
    assert all(e - s <= 20 for s, e in rows(found, "start", "end"))


def loops(spark, texts, n=2):
    df = spark.createDataFrame([("v", i, float(i), i + 1.0, x) for i, x in enumerate(texts)], SEGMENTS)
    return [x for (x,) in rows(tr.without_loops(df, n), "text")]


def test_loops(spark):
    assert loops(spark, ["так вот"] * 5) == ["так вот"] * 2
    assert loops(spark, list("aaba")) == list("aaba")
    assert loops(spark, list("aaa"), 0) == ["a"]


def test_runs_are_counted_after_the_filters(spark):
    df = spark.createDataFrame([("v", i, 0.0, 1.0, x) for i, x in enumerate(["a", "...", "a", " ", "a", "b"])], SEGMENTS)
    assert rows(tr.clean(df), "text") == [("a",), ("a",), ("b",)]


def test_windows_cover_everything(spark):
    df = spark.createDataFrame([("v", i, i * 10.0, i * 10 + 10.0, f"s{i}") for i in range(20)], SEGMENTS)
    found = rows(tr.windows(df), "chunk_id", "start", "end", "text")
    assert [x[0] for x in found] == [f"v:{i:04d}" for i in range(len(found))]
    assert found[-1][2] == 200.0 and found[0][1:3] == (0.0, 90.0)
    assert {w for x in found for w in x[3].split()} == {f"s{i}" for i in range(20)}
    assert all(b[1] < a[2] for a, b in zip(found, found[1:]))


def test_a_long_segment_stands_alone_and_blank_windows_have_no_number(spark):
    df = spark.createDataFrame([("v", 0, 0.0, 300.0, " "), ("v", 1, 300.0, 310.0, "b")], SEGMENTS)
    assert rows(tr.windows(df), "chunk_id", "start", "end", "text") == [("v:0000", 300.0, 310.0, "b")]


@pytest.mark.parametrize("parts", [1, 7])
def test_partitioning_does_not_matter(spark, parts):
    df = spark.createDataFrame([(f"v{k}", i, i * 7.0, i * 7 + 9.0, f"{i % 3}") for k in range(5) for i in range(40)], SEGMENTS)
    assert rows(tr.windows(tr.clean(df.repartition(parts))), "chunk_id", "text") == rows(tr.windows(tr.clean(df)), "chunk_id", "text")


def test_prompt_stops_at_the_first_term_that_does_not_fit(spark):
    g = spark.createDataFrame([("c", 1, "abc"), ("c", 2, "d" * 20), ("c", 3, "e")], "course string, pos int, term string")
    c = spark.createDataFrame([("c", "T"), ("x", "U")], "course string, title string")
    assert [tuple(r) for r in tr.glossary_prompt(g, c, 10).collect()] == [("c", "T. Имена и термины: abc.")]


def test_unit_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "embedding array<float>")
    assert [list(r[0]) for r in tr.unit_vectors(df).collect()] == [[pytest.approx(0.6), pytest.approx(0.8)], [0.0, 0.0]]


def plain_segments(parts, duration, pause_s, max_s):
    """Cut word by word, as a reader of the rule would."""
    out, held, opened, ended = [], [], None, None

    def flush():
        said = "".join(held).strip()
        if said and opened is not None:
            out.append((opened, min(max(ended, opened), duration), said))

    for start, end, said in parts:
        if start is None:
            held.append(said)
            continue
        low, high = sorted((max(0.0, start), max(0.0, start) if end is None else end))
        low, high = min(low, duration), min(high, duration)
        if opened is not None and (low - (ended or low) > pause_s or high - opened > max_s):
            flush()
            held, opened = [], None
        opened = low if opened is None else opened
        held.append(said)
        ended = high
    flush()
    return out


def test_words_against_a_plain_walk(spark):
    rng = random.Random(4)
    recordings = {}
    for k in range(60):
        at, parts = 0.0, []
        for _ in range(rng.randint(1, 60)):
            at += rng.choice([0.0, 0.1, 0.3, 0.9, 3.0])
            start = None if rng.random() < 0.15 else at
            end = None if rng.random() < 0.2 else at + rng.choice([0.0, 0.5, 1.0, -2.0])
            parts.append((start, end, rng.choice([" a", "b", " ", "", " c "])))
        recordings[f"v{k}"] = parts
    df = spark.createDataFrame([(v, i, *x, 30.0) for v, parts in recordings.items() for i, x in enumerate(parts)], RAW)
    found = {}
    for r in tr.words_to_segments(df, 0.6, 4.0).orderBy("video_id", "seg_no").collect():
        found.setdefault(r["video_id"], []).append((r["start"], r["end"], r["text"]))
    assert found == {v: x for v, parts in recordings.items() if (x := plain_segments(parts, 30.0, 0.6, 4.0))}


def test_recordings_that_yield_nothing(spark):
    quiet = spark.createDataFrame([("v", 0, 0.0, 5.0, " "), ("v", 1, 5.0, 9.0, "")], SEGMENTS)
    assert rows(tr.windows(quiet), "text") == []
    both = quiet.unionByName(spark.createDataFrame([("w", 0, 0.0, 5.0, "a")], SEGMENTS))
    assert rows(tr.windows(both), "chunk_id", "text") == [("w:0000", "a")]
    assert rows(words(spark, (0.0, 1.0, " "), (None, None, "")), "text") == []
    assert rows(tr.windows(quiet.limit(0)), "text") == rows(tr.clean(quiet), "text") == []


def test_names_of_a_glossary_in_a_row_are_an_echo(spark):
    terms = ["Popper", "Lakatos", "Feyerabend"]
    df = spark.createDataFrame([("Popper, Lakatos, Feyerabend.",), ("Popper met Lakatos before the war and spoke of it often",), ("Popper",), ("",)], "text string")
    assert [r[0] for r in df.select(tr.is_glossary_echo(df["text"], terms)).collect()] == [True, False, False, False]
