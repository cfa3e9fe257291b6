"""Model replies to verified extracts and answers."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectio.functions.text import json_of, minutes, quote_form, strip
from lectio.sources.shared import stored

MAX_QUOTE, MIN_QUOTE, FUZZY, MIN_BLOCK, OPENING = 300, 12, 0.85, 4, 40
MATERIAL, FULL_FROM = 15, 3
#: Quotes of one chunk from which a table of its places is made.
MANY_QUOTES = 4
COVERAGES = ["full", "partial", "not_found"]
#: What a quoted truth value may be.
TRUE, FALSE = ["1", "on", "t", "true", "y", "yes"], ["0", "off", "f", "false", "n", "no"]


def _at(v: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, f"$.{path}" if path else "$", kind)


def _kind(v: Column, path: str) -> Column:
    """The JSON type at a path: null where there is nothing, VOID for a null."""
    return F.schema_of_variant(_at(v, path))


def _is_number(kind: Column) -> Column:
    return kind.rlike("^(TINYINT|SMALLINT|INT|BIGINT|DECIMAL|FLOAT|DOUBLE)")


def _truth(v: Column, path: str) -> tuple[Column, Column]:
    """(value, whether it may be read as one): true, false, 0 and 1, or a string that names one of them."""
    kind, said, number = _kind(v, path), F.lower(_at(v, path, "string")), _at(v, path, "double")
    value = F.when(kind == "BOOLEAN", _at(v, path, "boolean")).when(_is_number(kind) & number.isin(0.0, 1.0), number == 1.0)
    value = value.when((kind == "STRING") & said.isin(TRUE), True).when((kind == "STRING") & said.isin(FALSE), False)
    return value, value.isNotNull()


def _number(v: Column, path: str, default: float) -> tuple[Column, Column]:
    """(value, whether it may be read as one): a number, a truth value, a string that holds a number, or nothing at all."""
    kind, said = _kind(v, path), strip(_at(v, path, "string"))
    value = F.when(kind.isNull(), F.lit(default)).when(_is_number(kind), _at(v, path, "double")).when(kind == "BOOLEAN", _at(v, path, "boolean").cast("int").cast("double"))
    value = value.when((kind == "STRING") & said.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), said.try_cast("double"))
    return value, value.isNotNull()


def _string(v: Column, path: str, default: str | None = None) -> tuple[Column, Column]:
    """(value, whether it is a string); without a default it must be there."""
    kind = _kind(v, path)
    value = F.when(kind == "STRING", _at(v, path, "string"))
    value = value if default is None else value.when(kind.isNull(), F.lit(default))
    return value, value.isNotNull()


def _list(v: Column, path: str, one: Callable[[Column], tuple[Column, Column]]) -> tuple[Column, Column]:
    """(values, whether it is an array of which ``one`` accepts every item, or nothing at all, which is an empty one)."""
    kind, items = _kind(v, path), _at(v, path, "array<variant>")
    items = F.when(kind.isNull(), F.array().cast("array<variant>")).when(kind.startswith("ARRAY<"), items)
    return F.transform(items, lambda x: one(x)[0]), F.coalesce(F.forall(items, lambda x: F.coalesce(one(x)[1], F.lit(False))), F.lit(False))


def _object(fields: dict[str, Callable[[Column, str], tuple[Column, Column]]]) -> Callable[[Column], tuple[Column, Column]]:
    """Reads an object by its fields; keys beyond them are ignored."""

    def read(v: Column) -> tuple[Column, Column]:
        ok, values = F.schema_of_variant(v).startswith("OBJECT<"), []
        for name, field in fields.items():
            value, good = field(v, name)
            ok, values = ok & good, [*values, value.alias(name)]
        return F.struct(*values), ok

    return read


_item = lambda v: _string(v, "")
EXTRACT_REPLY = _object({
    "relevant": _truth,
    "relevance": lambda v, p: ((x := _number(v, p, 0.0))[0], x[1] & x[0].between(0, 1) & ~F.isnan(x[0])),
    "points": lambda v, p: _list(v, p, _item),
    "quote": lambda v, p: _string(v, p, ""),
    "readings": lambda v, p: _list(v, p, _item),
})
SYNTHESIS_REPLY = _object({
    "answer_md": _string,
    "citations": lambda v, p: _list(v, p, _object({"chunk_id": _string, "quote": lambda v, p: _string(v, p, "")})),
    "coverage": lambda v, p: ((x := _string(v, p))[0], x[1] & x[0].isin(COVERAGES)),
    "outside_lectures_md": lambda v, p: _string(v, p, ""),
    "readings": lambda v, p: _list(v, p, _object({"text": _string, "chunk_id": _string})),
})


def parse_replies(raw: DataFrame, read: Callable[[Column], tuple[Column, Column]]) -> tuple[DataFrame, DataFrame]:
    """(request_id, attempt, raw) -> (request_id, attempt, parsed: the first usable attempt; request_id, attempt, raw: the last
    replies of requests without one).

    A reply is usable if its JSON is an object whose fields all have the type that is asked for, or one that reads as it
    without doubt (a number or a truth value in quotes). Missing fields take their default; a null is not missing.
    """
    value, ok = read(F.col("v"))
    rows = raw.withColumn("v", F.try_parse_json(json_of(F.col("raw")))).select("request_id", "attempt", "raw", F.coalesce(ok, F.lit(False)).alias("ok"), value.alias("parsed"))
    best = rows.groupBy("request_id").agg(F.min(F.when(F.col("ok"), F.col("attempt"))).alias("first"), F.min_by("parsed", F.when(F.col("ok"), F.col("attempt"))).alias("parsed"), F.max("attempt").alias("attempt"), F.max_by("raw", "attempt").alias("raw"))
    return best.filter("first is not null").select("request_id", F.col("first").alias("attempt"), "parsed"), best.filter("first is null").select("request_id", "attempt", "raw")


def parse_extracts(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Judged fragments: relevant is required, relevance defaults to 0 and must be from 0 to 1, lists and strings to empty."""
    good, bad = parse_replies(raw, EXTRACT_REPLY)
    return good.select("request_id", "attempt", "parsed.*"), bad


def parse_answers(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Written answers: answer_md and coverage (full, partial, not_found) are required; every citation needs its chunk_id,
    every reading its text and chunk_id."""
    good, bad = parse_replies(raw, SYNTHESIS_REPLY)
    return good.select("request_id", "attempt", "parsed.*"), bad


def gram_bound(needle: Column, source: Column, size: int = MIN_BLOCK) -> Column:
    """The share of the needle's characters inside a run of ``size`` that the source has too: never less than what matches."""
    n = F.length(needle)
    starts = F.filter(F.sequence(F.lit(1), F.greatest(n - size + 1, F.lit(1))), lambda i: F.contains(source, F.substring(needle, i, F.lit(size))))
    return F.size(F.array_distinct(F.flatten(F.transform(starts, lambda i: F.sequence(i, i + size - 1))))) / n


def places_of(source: str, size: int = MIN_BLOCK) -> dict[str, list[int]]:
    """Where each run of ``size`` characters begins in a text."""
    places: dict[str, list[int]] = {}
    for i in range(len(source) - size + 1):
        places.setdefault(source[i : i + size], []).append(i)
    return places


def common_runs(needle: str, source: str, size: int = MIN_BLOCK, known: dict[str, list[int]] | None = None) -> list[tuple[int, int, int]]:
    """(place in needle, place in source, length) of every maximal common run of ``size`` characters or more.

    known: places_of(source), where a source has many needles; else the source is searched for the needle's own runs.
    """
    places = {} if known is None else known
    for i in range(len(needle) - size + 1 if known is None else 0):
        gram = needle[i : i + size]
        if gram not in places:
            found, at = [], source.find(gram)
            while at >= 0:
                found.append(at)
                at = source.find(gram, at + 1)
            places[gram] = found
    out, open_ = [], {}  # open_: diagonal -> where its run began
    for i in range(len(needle) - size + 2):
        now = {j - i: i for j in places.get(needle[i : i + size], ())} if i + size <= len(needle) else {}
        for d in [d for d in open_ if d not in now]:
            begin = open_.pop(d)
            out.append((begin, begin + d, i - 1 - begin + size))
        for d in now:
            open_.setdefault(d, i)
    return out


def share_in_blocks(needle: str, source: str, threshold: float = 0.0, size: int = MIN_BLOCK, known: dict[str, list[int]] | None = None) -> float:
    """Characters of the needle in matching blocks of at least ``size``, as a share of it.

    Blocks are found from the longest on: of equal ones the leftmost in the needle, then in the source; then the same to
    the left of it on both sides, and to the right. Only runs of ``size`` count, so they are found by their first
    characters. 0 when even all runs together do not reach the threshold, which is known before their places are.
    """
    there, covered = source if known is None else known, set()
    for i in range(len(needle) - size + 1):
        if needle[i : i + size] in there:
            covered.update(range(i, i + size))
    if not covered or len(covered) / len(needle) < threshold:
        return 0.0
    total, parts = 0, [(0, len(needle), 0, len(source), common_runs(needle, source, size, known))]
    while parts:
        a0, a1, b0, b1, runs = parts.pop()
        inside = []
        for i, j, n in runs:
            cut = max(a0 - i, b0 - j, 0)
            n = min(n, a1 - i, b1 - j) - cut
            if n >= size:
                inside.append((i + cut, j + cut, n))
        if not inside:
            continue
        i, j, n = min(inside, key=lambda r: (-r[2], r[0], r[1]))
        total += n
        parts += [(a0, i, b0, j, inside), (i + n, a1, j + n, b1, inside)]
    return total / len(needle)


def shares(needles: list[str | None], sources: list[str | None], threshold: float = 0.0) -> list[float]:
    """share_in_blocks() of each pair, 0 for nulls and empty texts. A source's places are tabled once for all its needles here, if
    it has several."""
    by_source: dict[str, list[int]] = {}
    for k, (a, b) in enumerate(zip(needles, sources)):
        if a and b:
            by_source.setdefault(b, []).append(k)
    out = [0.0] * len(needles)
    for source, rows in by_source.items():
        known = places_of(source) if len(rows) >= MANY_QUOTES else None
        for k in rows:
            out[k] = share_in_blocks(needles[k], source, threshold, known=known)
    return out


def matched_share(needle: Column, source: Column, threshold: float = 0.0) -> Column:
    """share_in_blocks() by row; the quotes of a chunk that come together share its table."""

    @F.pandas_udf(T.DoubleType())
    def share(needles: pd.Series, sources: pd.Series) -> pd.Series:
        return pd.Series(shares(list(needles), list(sources), threshold))

    return share(needle, source)


def verify_quotes(claims: DataFrame, threshold: float = FUZZY) -> DataFrame:
    """Adds needle, exact and verified to rows with quote and source, or hay, the source in its quote form already.

    Contained quotes are decided in the plan, and no text is sent to the matcher for them; the matcher stops at an upper
    bound where that rules a quote out. No shuffle.
    """
    rows = claims if "hay" in claims.columns else claims.withColumn("hay", quote_form(F.coalesce("source", F.lit(""))))
    rows = rows.withColumn("needle", quote_form(F.coalesce("quote", F.lit(""))))
    able = (F.length("needle") >= MIN_QUOTE) & (F.coalesce("hay", F.lit("")) != "")
    rows = rows.withColumn("exact", able & F.contains("hay", "needle"))
    asked = F.when(able & ~F.col("exact"), F.col("hay"))
    return rows.withColumn("verified", F.col("exact") | (matched_share(F.col("needle"), asked, threshold) >= threshold)).drop("hay")


def quotable(chunks: DataFrame, claims: DataFrame, *columns: Column | str) -> DataFrame:
    """chunk_id, the columns, and hay (the quote form of the text), once for each chunk that is claimed."""
    asked = claims.select("chunk_id").distinct()
    return chunks.join(asked, "chunk_id", "left_semi").select("chunk_id", *columns, quote_form(F.col("text")).alias("hay"))


def assemble_extracts(candidates: DataFrame, judged: DataFrame, chunks: DataFrame, asked: DataFrame, model: str = "", version: str = "extract_v1", threshold: float = FUZZY) -> DataFrame:
    """candidates (question_id, position, chunk_id) x judged (question_id, position, relevant, relevance, points, quote, readings) x
    asked (question_id, input_hash) -> the extract of each question asked, as it is stored.

    All candidates count, also those whose replies were unusable and so were not judged; a question of which none was judged,
    or that has none, has an empty extract. Fragments without points or not relevant go. A quote is stripped and cut to
    MAX_QUOTE characters; one that is not in its fragment becomes the fragment's beginning. Order: relevance, then position.
    """
    kept = judged.filter(F.col("relevant") & (F.size("points") > 0)).select("question_id", "position", "relevance", "points", "quote", "readings")
    kept = kept.join(candidates.select("question_id", "position", "chunk_id"), ["question_id", "position"])
    kept = kept.join(quotable(chunks, kept, F.substring("text", 1, MAX_QUOTE).alias("beginning")), "chunk_id")
    kept = verify_quotes(kept.withColumn("quote", F.substring(strip(F.col("quote")), 1, MAX_QUOTE)), threshold)
    quote = F.when(F.col("verified") & (F.col("quote") != ""), F.col("quote")).otherwise(F.col("beginning"))
    item = F.struct((-F.col("relevance")).alias("k"), "position", "chunk_id", "relevance", "points", quote.alias("quote"))
    read = F.transform(F.filter("readings", lambda x: strip(x) != ""), lambda x: F.struct(x.alias("text"), F.col("chunk_id").alias("chunk_id")))
    grouped = kept.groupBy("question_id").agg(F.sort_array(F.collect_list(item)).alias("relevant"), F.sort_array(F.collect_list(F.struct("position", read.alias("items")))).alias("readings"))
    counts = candidates.groupBy("question_id").agg(F.count("*").alias("candidates"))
    pick = F.transform("relevant", lambda x: F.struct(x["chunk_id"].alias("chunk_id"), x["relevance"].alias("relevance"), x["points"].alias("points"), x["quote"].alias("quote")))
    rows = asked.select("question_id", "input_hash").join(counts, "question_id", "left").join(grouped, "question_id", "left")
    return rows.select(
        F.lit(1).alias("schema_version"), "question_id", F.coalesce("candidates", F.lit(0)).alias("candidates"), F.coalesce(pick, F.array().cast("array<struct<chunk_id:string,relevance:double,points:array<string>,quote:string>>")).alias("relevant"),
        F.coalesce(F.flatten(F.transform("readings", lambda x: x["items"])), F.array().cast("array<struct<text:string,chunk_id:string>>")).alias("readings"), F.lit(model).alias("model"), F.lit(version).alias("prompt_version"), "input_hash",
    )


def chunk_segments(chunks: DataFrame, segments: DataFrame, bucket_s: float = 90.0) -> DataFrame:
    """Overlap join on the recording: chunk_id, seg_no, start, end, text. Both sides enter the time buckets that they touch,
    and a pair counts in its first common one, so a long recording is many keys."""
    into = lambda a, b: F.sequence(F.floor(a / bucket_s).cast("long"), F.floor(F.greatest(a, b) / bucket_s).cast("long"))
    left = chunks.select("chunk_id", "video_id", F.col("start").alias("c_start"), F.col("end").alias("c_end")).withColumn("bucket", F.explode(into(F.col("c_start"), F.col("c_end"))))
    right = segments.select("video_id", "seg_no", "start", "end", "text").withColumn("bucket", F.explode(into(F.col("start"), F.col("end"))))
    first = F.greatest(F.floor(F.col("c_start") / bucket_s), F.floor(F.col("start") / bucket_s))
    return left.join(right, ["video_id", "bucket"]).filter((F.col("start") < F.col("c_end")) & (F.col("end") > F.col("c_start")) & (F.col("bucket") == first)).select("chunk_id", "video_id", "seg_no", "start", "end", "text")


def quote_starts(claims: DataFrame, parts: DataFrame) -> DataFrame:
    """(claim_id, chunk_id, quote, chunk_start) x chunk_segments() -> claim_id, start: of the first segment in which the
    quote's first OPENING characters begin, read on into the next one; the chunk's start if there is none."""
    opening = F.substring(quote_form(F.coalesce("quote", F.lit(""))), 1, OPENING)
    asked = claims.select("claim_id", "chunk_id", "chunk_start", opening.alias("opening"))
    own = parts.select("chunk_id", "seg_no", "start", quote_form(F.col("text")).alias("own"))
    own = own.withColumn("following", F.lead("own").over(W.partitionBy("chunk_id").orderBy("seg_no")))
    pair = F.when(F.col("following").isNull(), F.col("own")).otherwise(F.concat("own", F.lit(" "), "following"))
    own = own.withColumn("pair", pair)
    hit = asked.filter(F.length("opening") >= MIN_QUOTE).join(own, "chunk_id").filter(F.expr("instr(pair, opening) between 1 and length(own)"))
    placed = hit.groupBy("claim_id").agg(F.min_by("start", "seg_no").alias("start"))
    return asked.join(placed, "claim_id", "left").select("claim_id", F.coalesce("start", "chunk_start").alias("start"))


def build_citations(claims: DataFrame, chunks: DataFrame, segments: DataFrame | None = None, threshold: float = FUZZY) -> DataFrame:
    """(answer_id, position, chunk_id, quote) -> the same with kept, n (dense from 1), video_id, start.

    A claim is kept if its chunk exists and its quote, stripped and cut, is in it; with a threshold above 1, word for word.
    """
    known = quotable(chunks, claims, "video_id", F.col("start").alias("chunk_start"))
    rows = claims.withColumn("quote", F.substring(strip(F.coalesce("quote", F.lit(""))), 1, MAX_QUOTE)).join(known, "chunk_id", "left")
    rows = verify_quotes(rows, threshold).withColumn("kept", F.coalesce(F.col("verified") & (F.col("quote") != "") & F.col("video_id").isNotNull(), F.lit(False)))
    if segments is not None:
        # written once: they are read several times below, and each time the matcher would go over all quotes
        rows = stored(rows.select("answer_id", "position", "chunk_id", "quote", "kept", "video_id", "chunk_start"), "verified")
    counted = F.sum(F.col("kept").cast("int")).over(W.partitionBy("answer_id").orderBy("position"))
    rows = rows.withColumn("n", F.when(F.col("kept"), counted))
    if segments is None:
        return rows.withColumn("start", F.when(F.col("kept"), F.col("chunk_start"))).select("answer_id", "position", "chunk_id", "quote", "kept", "n", "video_id", "start")
    rows = rows.withColumn("claim_id", F.struct("answer_id", "position"))
    cited = chunks.join(rows.filter("kept").select("chunk_id").distinct(), "chunk_id", "left_semi")
    placed = quote_starts(rows.filter("kept"), chunk_segments(cited, segments))
    return rows.join(placed, "claim_id", "left").select("answer_id", "position", "chunk_id", "quote", "kept", "n", "video_id", "start")


def renumbered(answer_md: Column, numbers: Column, dropped: Column) -> Column:
    """[n] markers by the map of old to new numbers; markers of other numbers vanish. Nothing dropped: as it was."""
    parts = F.split(answer_md, r"\[\d+\]", -1)
    marks = F.regexp_extract_all(answer_md, F.lit(r"\[(\d+)\]"), F.lit(1))
    new = F.transform(marks, lambda m: F.coalesce(F.concat(F.lit("["), F.try_element_at(numbers, m.try_cast("int")).cast("string"), F.lit("]")), F.lit("")))
    return F.when(dropped, F.array_join(F.zip_with(parts, new, lambda p, m: F.concat(p, F.coalesce(m, F.lit("")))), "")).otherwise(answer_md)


def verified_coverage(claimed: Column, citations: Column) -> Column:
    return F.when(citations == 0, "not_found").when((claimed == "full") & (citations < FULL_FROM), "partial").otherwise(claimed)


def answer_readings(readings: DataFrame, chunks: DataFrame) -> DataFrame:
    """(answer_id, position, text, chunk_id) -> answer_id, position, text, video_id, start of those not blank with a known chunk."""
    known = chunks.select("chunk_id", "video_id", "start")
    return readings.filter(strip(F.coalesce("text", F.lit(""))) != "").join(known, "chunk_id").select("answer_id", "position", "text", "video_id", "start")


def assemble_answers(answers: DataFrame, chunks: DataFrame, segments: DataFrame | None = None, threshold: float = FUZZY) -> DataFrame:
    """Parsed answers (request_id, ...) -> answer_id, answer_md, outside_lectures_md, coverage, citations, dropped, readings."""
    base = answers.withColumnRenamed("request_id", "answer_id")
    claims = base.select("answer_id", F.posexplode("citations").alias("position", "c")).select("answer_id", (F.col("position") + 1).alias("position"), "c.chunk_id", "c.quote")
    built = build_citations(claims, chunks, segments, threshold)
    cited = built.groupBy("answer_id").agg(
        F.sort_array(F.collect_list(F.when(F.col("kept"), F.struct("n", "chunk_id", "video_id", "start", "quote")))).alias("citations"),
        F.sort_array(F.collect_list(F.when(~F.col("kept"), F.col("position")))).alias("dropped"),
        F.map_from_entries(F.collect_list(F.when(F.col("kept"), F.struct("position", "n")))).alias("numbers"),
    )
    read = answer_readings(base.select("answer_id", F.posexplode("readings").alias("position", "r")).select("answer_id", "position", "r.text", "r.chunk_id"), chunks)
    read = read.groupBy("answer_id").agg(F.sort_array(F.collect_list(F.struct("position", "text", "video_id", "start"))).alias("read"))
    joined = base.select("answer_id", "answer_md", "outside_lectures_md", "coverage").join(cited, "answer_id", "left").join(read, "answer_id", "left")
    n = F.when(F.col("citations").isNull(), 0).otherwise(F.size("citations"))
    gone = F.coalesce(F.size("dropped") > 0, F.lit(False))
    outside = F.nullif(strip(F.coalesce("outside_lectures_md", F.lit(""))), F.lit(""))
    shown = F.transform("read", lambda x: F.struct(x["text"].alias("text"), x["video_id"].alias("video_id"), x["start"].alias("start")))
    cites = F.coalesce("citations", F.array().cast(joined.schema["citations"].dataType))
    return joined.select("answer_id", renumbered(F.col("answer_md"), F.coalesce("numbers", F.create_map().cast("map<int,bigint>")), gone).alias("answer_md"), outside.alias("outside_lectures_md"), verified_coverage(F.col("coverage"), n).alias("coverage"), cites.alias("citations"), F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"), F.coalesce(shown, F.array().cast("array<struct<text:string,video_id:string,start:double>>")).alias("readings"))


def material(extracts: DataFrame, chunks: DataFrame, limit: int = MATERIAL, fallback: str = "(лекции ничего не дали по этому вопросу)") -> DataFrame:
    """question_id, material: a block of text for each of the first ``limit`` relevant fragments whose chunk is known."""
    items = extracts.select("question_id", F.posexplode_outer(F.slice("relevant", 1, limit)).alias("position", "item"))
    rows = items.join(chunks.select("chunk_id", "start", "text"), F.col("item.chunk_id") == F.col("chunk_id"), "left")
    points = F.array_join(F.transform("item.points", lambda p: F.concat(F.lit("- "), p)), "\n")
    block = F.concat(F.lit("### "), "chunk_id", F.lit(" ("), minutes(F.col("start")), F.lit(")\nТезисы:\n"), points, F.lit("\n\nТекст фрагмента:\n```\n"), "text", F.lit("\n```"))
    grouped = rows.groupBy("question_id").agg(F.sort_array(F.collect_list(F.when(F.col("chunk_id").isNotNull(), F.struct("position", block.alias("block"))))).alias("blocks"))
    shown = F.array_join(F.transform("blocks", lambda x: x["block"]), "\n\n")
    return grouped.select("question_id", F.when(shown == "", fallback).otherwise(shown).alias("material"))
