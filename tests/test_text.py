"""Column functions: one row in, one value out."""

import pytest
from pyspark.sql import functions as F

from lectio.functions import text as fn
from lectio.operators.planning import answer_hash, kind_text
from lectio.operators.replies import renumbered, verified_coverage
from lectio.operators.transcripts import chunk_id, is_boilerplate, is_glossary_echo, replaced


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("raw, expected", [
    ('<think>why {x}</think> {"a": 1}', '{"a": 1}'),
    ('{"a": 1} <think>never closed {"b": 2}', '{"a": 1}'),
    ('Here you are: {"a": {"b": 1}} and more', '{"a": {"b": 1}}'),
    ('```json\n{"a": 1}\n```', '{"a": 1}'),
    ("```plain```", "plain"),
    ("nothing", "nothing"),
])
def test_json_out_of_a_reply(spark, raw, expected):
    assert value(spark, fn.json_of(F.lit(raw))) == expected


@pytest.mark.parametrize("seconds, clock, minutes", [(610.0, "10:10", "10:10"), (3671.0, "1:01:11", "61:11"), (59.9, "00:59", "00:59"), (0.0, "00:00", "00:00"), (7200.0, "2:00:00", "120:00")])
def test_times(spark, seconds, clock, minutes):
    assert value(spark, fn.clock(F.lit(seconds))) == clock
    assert value(spark, fn.minutes(F.lit(seconds))) == minutes


def test_link(spark):
    assert value(spark, fn.deep_link(F.lit("a-b"), F.lit(75.9))) == "https://youtu.be/a-b?t=75"


def test_spacing_and_quote_form(spark):
    assert value(spark, fn.collapse(F.lit("  a \t\n b "))) == "a b"
    assert value(spark, fn.quote_form(F.lit("  Ещё,   РАЗ — «так»!"))) == "еще раз так"


def test_chunk_numbers_are_never_cut(spark):
    assert value(spark, chunk_id(F.lit("-x"), F.lit(7))) == "-x:0007"
    assert value(spark, chunk_id(F.lit("v"), F.lit(12345))) == "v:12345"


def test_whole_words_are_replaced_in_order(spark):
    text = F.lit("поппер и попперовский, ПОППЕР")
    assert value(spark, replaced(text, [("поппер", "Поппер")])) == "Поппер и попперовский, Поппер"
    assert value(spark, replaced(F.lit("a b"), [("a", "b"), ("b", "$1\\")])) == "$1\\ $1\\"


@pytest.mark.parametrize("text, gone", [("Продолжение следует...", True), ("...", True), ("Редактор М.Иванова", True), ("Корректор А.Егорова", True), ("Редактор журнала пришёл", False), ("Thanks for watching this", True), ("Наука", False)])
def test_boilerplate(spark, text, gone):
    assert value(spark, is_boilerplate(F.lit(text))) is gone


def test_glossary_echo(spark):
    terms = ["Карл Поппер", "Томас Кун", "Кант"]
    assert value(spark, is_glossary_echo(F.lit("карл поппер, томас кун"), terms)) is True
    assert value(spark, is_glossary_echo(F.lit("карл поппер, карл поппер"), terms)) is False
    assert value(spark, is_glossary_echo(F.lit("здесь карл поппер спорит с тем, о чём много раз писал томас кун в книгах"), terms)) is False


def test_prompts_fill_one_after_another(spark):
    assert value(spark, fn.fill(F.lit("{a} {b} {c}"), {"a": F.lit("{b}"), "b": F.lit("x")})) == "x x {c}"


@pytest.mark.parametrize("claimed, n, expected", [("full", 1, "partial"), ("full", 2, "partial"), ("full", 3, "full"), ("partial", 0, "not_found"), ("partial", 1, "partial"), ("not_found", 4, "not_found")])
def test_coverage(spark, claimed, n, expected):
    assert value(spark, verified_coverage(F.lit(claimed), F.lit(n))) == expected


def test_markers_are_renumbered(spark):
    numbers = F.create_map(F.lit(1), F.lit(1), F.lit(3), F.lit(2))
    assert value(spark, renumbered(F.lit("Раз [1], два [2], три [3]."), numbers, F.lit(True))) == "Раз [1], два , три [2]."
    assert value(spark, renumbered(F.lit("[01] [9] [99999999999]"), numbers, F.lit(True))) == "[1]  "
    assert value(spark, renumbered(F.lit("[7] as it was"), numbers, F.lit(False))) == "[7] as it was"


def test_only_selected_fragments_enter_the_hash(spark):
    item = lambda k: F.struct(F.lit(f"v:{k:04d}").alias("chunk_id"), F.array(F.lit("p")).alias("points"))
    h = lambda n, limit=15: value(spark, answer_hash(F.lit("q"), F.lit("h"), F.array(*map(item, range(n))), F.lit("m"), "", limit=limit))
    assert h(15) == h(37) != h(14)
    assert h(37, 16) != h(37)


def test_kind(spark):
    assert value(spark, kind_text(F.lit("b"), {"a": "1", "b": "2"})) == "2"
