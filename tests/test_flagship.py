"""The steps of w2_bm25_candidates: what is exchanged, and the short ways against the plain ones."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lectio.functions import text as fn
from lectio.operators import retrieval, search
from lectio.operators import transcripts as tr
from lectio.plans import tables

SEGMENTS = "video_id string, seg_no int, start double, end double, text string"
ODD = ["", " ", "a", "Ёлка ЁЖ-2 x", "İstanbul ΑΣ K ß ǅ", "naïve café́ ﬁ", "а́б ѐ ў я1я а", "𝒳y z𐐀", "ё", "ѓёа рсєя", "a b c", "x" * 700 + " " + "я" * 300, "а", "№5 5№ ①", "ᲀᲂ в", "end я"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_are_exchanged_once_up_to_their_cleaning(spark, tmp_path):
    spark.createDataFrame([(i, "a b\n\nc  d\nc d") for i in range(5)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    rows = tr.clean(tables.segments(spark, str(tmp_path)))
    # a table of few files may be dealt to all cores first, whole texts by turns
    assert plan(rows).count("hashpartitioning") == 1 and plan(rows).count("Sort [") == 1
    assert [tuple(r) for r in rows.filter("video_id = 'v3'").orderBy("seg_no").select("seg_no", "start", "end", "text").collect()] == [(0, 0.0, 0.24, "a b"), (2, 0.24, 0.56, "c d"), (3, 0.56, 0.8, "c d")]


def test_the_index_of_a_text_is_made_where_it_lies(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(search, "stored", lambda df, name: (plans.append((name, plan(df))), retrieval.stored(df, name))[1])
    index = search.indexed(spark.createDataFrame([(f"c{i}", f"w{i % 3} x") for i in range(10)], "chunk_id string, text string"), 2)
    assert "Exchange" not in dict(plans)["segments"]
    rows = index.segments.collect()
    assert sorted(c for r in rows for c in r["chunk_ids"]) == [f"c{i}" for i in range(10)] and max(len(r["chunk_ids"]) for r in rows) == 2
    assert sorted(map(tuple, index.terms.collect())) == [("w0", 4), ("w1", 3), ("w2", 3), ("x", 10)] and (index.chunks, index.words) == (10, 20)


def test_segments_end_at_their_size_or_their_bytes():
    low = ["a b"] * 7 + ["c" * 50] + [""] * 3 + ["d e f"] * 5
    table = pa.table({"chunk_id": [f"c{i:02d}" for i in range(len(low))], "low": pa.array(low, pa.string())})
    for most in (3, 4, 100):
        out = [r for b in search._segments(most, 20)(iter(table.to_batches(max_chunksize=5))) for r in b.to_pylist()]
        assert sorted(c for r in out for c in r["chunk_ids"]) == table["chunk_id"].to_pylist()
        assert all(len(r["chunk_ids"]) <= most and sum(len(low[int(c[1:])]) for c in r["chunk_ids"][:-1]) < 100 for r in out)
        assert sum(np.frombuffer(r["lengths"], "<i8").sum() for r in out) == 7 * 2 + 1 + 5 * 3


def test_words_are_those_of_the_expression(spark):
    rng = random.Random(5)
    texts = ODD + ["".join(rng.choices("aяё Яz9.ÑѐЯ\U0001d4b3", k=rng.randrange(30))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").coalesce(1)
    rows = df.orderBy("i").select(F.lower("text").alias("low"), retrieval.tokens(F.col("text")).alias("words")).collect()
    low = pa.array([r["low"] for r in rows])
    for part, some in ((low, rows), (low.slice(3, 40), rows[3:43]), (low.slice(0, 0), [])):
        words, counts = retrieval.split_words(part)
        assert words.to_pylist() == [w for r in some for w in r["words"]] and counts.tolist() == [len(r["words"]) for r in some]


def test_white_space_of_any_kind_is_collapsed(spark):
    assert {c for c in map(chr, range(0x10000)) if not 0xD800 <= ord(c) < 0xE000 and (c in " \t\n\x0b\f\r\x85" or __import__("unicodedata").category(c).startswith("Z"))} == set(fn.SPACES)
    texts = [f"{a}x{c}{b}y é{a}" for c in fn.SPACES for a in ("", c) for b in ("", " ", c)] + ["", "x y", " x", "x ", "x  y", "é​y", "\x1cx"]
    df = spark.createDataFrame([(x,) for x in [*texts, None]], "text string")
    plain = F.trim(F.regexp_replace("text", f"{fn.SPACE}+", " "))
    assert df.filter(~fn.collapse(F.col("text")).eqNullSafe(plain)).count() == 0
    assert all(r["a"] == r["text"].strip(fn.SPACES) for r in df.filter("text is not null").select("text", fn.strip(F.col("text")).alias("a")).collect())


def test_boilerplate_is_that_of_one_expression(spark):
    texts = ["Субтитры Иван", "x редактор п. Иванов y", "Редактор П. Иванов", "редактᲂр п. Иванов", "предактор п. Иванов", "редактор п Иванов", "перевод а. б", "ПЕРЕВОД  А. Б", "перевод", "...", "", "thanks for watching", "a\nредактор п. Иванов", "корректора к. м", "ẞ расшифровка ё. -"]
    df = spark.createDataFrame([(x,) for x in [*texts, None]], "text string")
    for patterns in (tr.BOILERPLATE, tr.BOILERPLATE[-1:], tr.BOILERPLATE[:3], []):
        whole = F.col("text").rlike("(?iuU)^(?:" + "|".join(patterns) + ")$")
        assert [r["text"] for r in df.filter(~tr.is_boilerplate(F.col("text"), patterns).eqNullSafe(whole)).collect()] == []
    assert df.filter(tr.is_boilerplate(F.col("text"))).count() >= 7
    letters = spark.createDataFrame([(chr(i),) for i in range(0x80, 0x10000) if not 0xD800 <= i < 0xE000], "c string")
    for x in sorted(set("".join(w for words in tr.WORDS_OF.values() for w in words))):
        assert letters.filter(F.concat(F.lit("ж"), "c").rlike(f"(?iu)^ж{x}$") & (F.upper("c") != x.upper())).count() == 0


def plain_windows(rows, window_s=90.0, overlap_s=15.0):
    """(start, end, text) of a recording -> its windows, as a reader of the rule would cut them."""
    out, i, more = [], 0, lambda x, y: x > y or (math.isnan(x) and not math.isnan(y))
    while i < len(rows):
        stop = next((j for j in range(i, len(rows)) if more(rows[j][1] - rows[i][0], window_s)), len(rows))
        stop = max(stop, i + 1)
        said = re.sub(r"^\s+|\s+$", "", " ".join(r[2] or "" for r in rows[i:stop]))
        if said:
            out.append((rows[i][0], rows[stop - 1][1], said))
        if stop >= len(rows):
            break
        i = max([k for k in range(i + 1, stop) if not more(rows[k][0], rows[stop - 1][1] - overlap_s)], default=i + 1)
    return out


@pytest.mark.parametrize("cell", [1024, 4])
def test_windows_are_those_of_a_plain_walk(spark, cell):
    rng = random.Random(6)
    recordings = {}
    for k in range(600):
        at, rows = 0.0, []
        for _ in range(rng.randrange(1, 25)):
            at += rng.choice([0.0, 5.0, 20.0, 120.0])
            rows.append((at, at + rng.choice([1.0, 15.0, 40.0, 100.0, -30.0]), rng.choice(["a", " b", " ", "", None, "ж ", "　"])))
        recordings[f"v{k}"] = rows
    if cell > 25:
        nan = float("nan")
        recordings |= {"nan": [(0.0, 10.0, "a"), (nan, 20.0, "b"), (5.0, nan, "c"), (nan, nan, "d"), (30.0, 40.0, "e"), (200.0, 210.0, "f")]}
    df = spark.createDataFrame([(v, i, *x) for v, rows in recordings.items() for i, x in enumerate(rows)], SEGMENTS)
    found = {}
    for r in tr.windows(df, cell=cell).orderBy("video_id", "chunk_no").collect():
        assert r["chunk_no"] == len(found.setdefault(r["video_id"], [])) and r["chunk_id"] == f"{r['video_id']}:{r['chunk_no']:04d}"
        found[r["video_id"]].append((r["start"], r["end"], r["text"]))
    expected = {v: x for v, rows in recordings.items() if (x := plain_windows(rows))}
    assert {v: repr(x) for v, x in found.items()} == {v: repr(x) for v, x in expected.items()}


def test_runs_of_a_text_are_cut_within_their_recording(spark):
    rng = random.Random(7)
    recordings = {f"v{k}": rng.choices(["a", "b", "...", "", None], k=30) for k in range(40)}
    df = spark.createDataFrame([(v, i, 0.0, 1.0, x) for v, texts in recordings.items() for i, x in enumerate(texts)], SEGMENTS)
    expected = set()
    for v, texts in recordings.items():
        last, n = None, 0
        for i, x in enumerate(texts):
            if x in ("a", "b"):
                n = n + 1 if x == last else 1
                last = x
                expected |= {(v, i)} if n <= 2 else set()
    rows = tr.flagged(df)
    assert {(r["video_id"], r["seg_no"]) for r in rows.filter("kept").collect()} == expected
    assert rows.filter("kept is null").count() == 0 and rows.count() == 1200


def test_no_text_is_exchanged_for_the_neighbours_of_few(spark):
    chunks = retrieval.stored(spark.createDataFrame([(f"v{i // 10}:{i % 10:04d}", f"v{i // 10}", i % 10, f"t{i}") for i in range(100)], "chunk_id string, video_id string, chunk_no int, text string"), "chunks")
    found = retrieval.with_neighbours(chunks, wanted=chunks.filter("chunk_no in (0, 5)"))
    assert plan(found).count("hashpartitioning") == 1
    assert {r["chunk_id"]: r["context"] for r in found.collect()} == {f"v{v}:{n:04d}": " ".join(f"t{v * 10 + k}" for k in (n - 1, n, n + 1) if k >= 0) for v in range(10) for n in (0, 5)}


def test_the_best_of_a_segment_are_those_of_a_whole_sum():
    rng = np.random.default_rng(8)
    low = [" ".join(f"w{w}" for w in rng.zipf(1.5, rng.integers(0, 40)) % 60) for _ in range(700)] + ["w1 w2 w3"] * 90
    (segment,) = search._packed(pa.table({"chunk_id": [f"c{i:04d}" for i in range(len(low))], "low": low})).to_pylist()
    segment["terms"] = pa.array(segment["terms"])
    names = sorted({w for x in low for w in x.split()})
    idf = {w: [-0.2, 0.4, 2.0, 5.0][i % 4] for i, w in enumerate(names)}
    rows = [rng.choice(len(names), k, replace=False) for k in (1, 2, 5, 12, 25)]
    rows = [(np.sort(x), rng.integers(1, 3, len(x)).astype(float)) for x in rows]
    asked = search.Asked(list(range(5)), pa.array(names), np.array([idf[w] for w in names]), rows, 20.0)
    at = {c: i for i, c in enumerate(segment["chunk_ids"])}
    for pool in (3, 40, 5000):
        for q, kept, score, _ in search.best_in(segment, asked, pool):
            expected = {}
            for i, x in enumerate(low):
                said = x.split()
                s = sum(k * idf[names[t]] * (n := said.count(names[t])) * 2.5 / (n + 1.5 * (0.25 + 0.75 * len(said) / 20.0)) for t, k in zip(*rows[q]))
                if s > 0:
                    expected[at[f"c{i:04d}"]] = s
            edge = sorted(expected.values())[-pool] if len(expected) >= pool else 0.0
            assert dict(zip(kept.tolist(), score.tolist())) == pytest.approx({i: s for i, s in expected.items() if s >= edge - 1e-9})
