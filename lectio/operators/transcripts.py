"""Timed transcripts: repair of recognised bounds, cleaning, and time windows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectio.functions.text import SPACES, collapse, strip
from lectio.operators.ordering import numbered
from lectio.sources.batches import Batches
from lectio.sources.shared import stored

CHARS_PER_SECOND, PAUSE_S, MAX_SEGMENT_S = 12.5, 0.6, 20.0
MAX_REPEATS, ECHO_SHARE, MIN_TERM = 2, 0.6, 5
WINDOW_S, OVERLAP_S, GLOSSARY_CHARS = 90.0, 15.0, 700
CHUNKS = "chunk_id string, video_id string, chunk_no int, start double, end double, text string"
#: Numbers of segments that make a cell of a recording.
CELL = 1024
#: Recordings that are cut at once.
RECORDINGS = 256
#: Segments among which the end of a window is looked for before the rest.
NEAR = 24
#: Lines that a recogniser makes up on silence or music.
BOILERPLATE = [
    r"субтитры .*",
    r"редактор субтитров .*",
    r"продолжение следует.*",
    r"спасибо за просмотр.*",
    r"подписывайтесь на канал.*",
    r"ставьте лайки.*",
    r"добро пожаловать на наш канал.*",
    r"с вами был.*",
    r"all rights reserved.*",
    r"thanks for watching.*",
    r"[!?.…\-\s]*",
    r".*\b(?:корректор|редактор|расшифровка|перевод)\s+[а-яё]\.\s*[а-яё-]+.*",
]
#: Of patterns that begin anywhere: words of which they need one.
WORDS_OF = {BOILERPLATE[-1]: ["корректор", "редактор", "расшифровка", "перевод"]}


def repair_bounds(raw: DataFrame) -> DataFrame:
    """Raw recogniser rows (video_id, pos, start, end, text, duration) -> segments with ordered bounds within the recording.

    Rows without a start go, but count as the neighbour of the row before. A missing end is the recording's end for the last
    row, the next start if that is not earlier, else the own start. An empty span around a text is as long as the text takes
    to say, up to the next start.
    """
    order = W.partitionBy("video_id").orderBy("pos")
    clamp = lambda x: F.least(F.greatest(x, F.lit(0.0)), F.col("duration"))
    rows = raw.withColumn("next_start", F.lead("start").over(order)).withColumn("last", F.lead(F.lit(1)).over(order).isNull()).filter("start is not null")
    begin, finish, following = clamp(F.col("start")), clamp(F.col("end")), clamp(F.col("next_start"))
    rows = rows.withColumn("begin", F.when(F.col("end").isNotNull(), F.least(begin, finish)).otherwise(begin))
    closed = F.when(F.col("end").isNotNull(), F.greatest(begin, finish)).when(F.col("last"), F.col("duration")).when(F.col("next_start").isNotNull() & (following >= begin), following).otherwise(begin)
    rows = rows.withColumn("finish", closed)
    ceiling = F.when(F.col("next_start").isNotNull(), F.least("next_start", "duration")).otherwise(F.col("duration"))
    spoken = F.least(F.col("begin") + F.length("text") / F.lit(CHARS_PER_SECOND), F.greatest(ceiling, F.col("begin")))
    empty = (F.col("finish") <= F.col("begin")) & (strip(F.col("text")) != "")
    return rows.select("video_id", "pos", F.col("begin").alias("start"), F.when(empty, spoken).otherwise(F.col("finish")).alias("end"), "text")


def words_to_segments(words: DataFrame, pause_s: float = PAUSE_S, max_segment_s: float = MAX_SEGMENT_S) -> DataFrame:
    """Timed words (video_id, pos, start, end, text, duration) -> video_id, seg_no, start, end, text.

    A cut falls before a word that begins more than pause_s after the last one ended, or that would end more than max_segment_s
    after the segment began. Words without a start join what is open. Where pauses fall is known from neighbours alone, so they
    cut a recording into runs; a run that is not longer than a segment may be is one. Only in longer ones, each a group of its
    own, does a cut depend on the one before. Segments without text, and words before which nothing was timed, give nothing.
    """
    order = W.partitionBy("video_id").orderBy("pos")
    begin = F.greatest(F.col("start"), F.lit(0.0))
    other = F.coalesce("end", begin)
    timed = F.col("start").isNotNull()
    rows = words.select("video_id", "pos", "duration", F.coalesce("text", F.lit("")).alias("text"), F.when(timed, F.least(F.least(begin, other), "duration")).alias("begin"), F.when(timed, F.least(F.greatest(begin, other), "duration")).alias("finish"))
    ended = F.last("finish", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, -1))
    # an end of exactly 0 counts as no pause
    pause = F.coalesce((F.col("begin") - F.nullif("ended", F.lit(0.0)) > pause_s).cast("int"), F.lit(0))
    rows = rows.withColumn("ended", ended).withColumn("pause", pause).withColumn("run", F.sum("pause").over(order)).drop("ended", "pause")
    run = rows.groupBy("video_id", "run").agg(
        F.min_by("begin", F.when(F.col("begin").isNotNull(), F.col("pos"))).alias("start"), F.max("finish").alias("most"), F.max_by("finish", F.when(F.col("begin").isNotNull(), F.col("pos"))).alias("final"),
        F.first("duration").alias("duration"), F.sort_array(F.collect_list(F.struct("pos", "begin", "finish", "text"))).alias("words"),
    ).filter("start is not null")
    long = F.col("most") - F.col("start") > max_segment_s
    said = F.array_join(F.transform("words", lambda x: x["text"]), "")
    short = run.filter(~long).select("video_id", "run", F.lit(0).alias("part"), "start", F.least(F.greatest("final", "start"), "duration").alias("end"), said.alias("text"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for name, number, duration, listed in zip(pdf["video_id"], pdf["run"], pdf["duration"], pdf["words"]):
                held, opened, ended, part = [], None, None, 0
                for x in listed:
                    if x["begin"] is not None:
                        if opened is not None and x["finish"] - opened > max_segment_s:
                            out.append((name, number, part, opened, min(max(ended, opened), duration), "".join(held)))
                            held, opened, part = [], None, part + 1
                        opened = x["begin"] if opened is None else opened
                        ended = x["finish"]
                    held.append(x["text"])
                out.append((name, number, part, opened, min(max(ended, opened), duration), "".join(held)))
            yield pd.DataFrame(out, columns=["video_id", "run", "part", "start", "end", "text"])

    cuts = run.filter(long).select("video_id", "run", "duration", "words").mapInPandas(cut, "video_id string, run long, part int, start double, end double, text string")
    found = short.unionByName(cuts).withColumn("text", strip(F.col("text"))).filter("text <> ''")
    return found.select("video_id", (F.row_number().over(W.partitionBy("video_id").orderBy("run", "part")) - 1).alias("seg_no"), "start", "end", "text")


def replaced(text: Column, rules: list[tuple[str, str]]) -> Column:
    """Whole words replaced, whatever their case, one rule after another; a short list of settings."""
    for wrong, right in rules:
        quoted = wrong.replace("\\E", "\\E\\\\E\\Q")
        text = F.regexp_replace(text, rf"(?iuU)\b\Q{quoted}\E\b", right.replace("\\", "\\\\").replace("$", "\\$"))
    return text


def is_boilerplate(text: Column, patterns: list[str] = BOILERPLATE) -> Column:
    """Patterns that may begin anywhere are tried only where one of their words is: to step back through every line is dear."""
    any_of = lambda some: text.rlike("(?iuU)^(?:" + "|".join(some) + ")$")
    rest = [p for p in patterns if p not in WORDS_OF]
    found = any_of(rest) if rest or not patterns else F.lit(False)
    for p in patterns:
        if p in WORDS_OF:
            # what (?iu) takes for a letter has its upper case; an array, so that this is made once
            one_of = lambda x: reduce(or_, (x.contains(word.upper()) for word in WORDS_OF[p]))  # noqa: B023,E731
            found = found | (F.exists(F.array(F.upper(text)), one_of) & any_of([p]))
    return found


def is_glossary_echo(text: Column, terms: list[str], share: float = ECHO_SHARE) -> Column:
    """At least two terms of MIN_TERM characters occur, and together they fill ``share`` of the text."""
    low = F.lower(text)
    wanted = [t for t in (x.strip().lower() for x in terms) if len(t) >= MIN_TERM]
    if not wanted:
        return F.lit(False)
    times = F.transform(F.array(*map(F.lit, wanted)), lambda t: F.struct(t.alias("t"), ((F.length(low) - F.length(F.replace(low, t, F.lit("")))) / F.length(t)).alias("n")))
    matched = F.size(F.filter(times, lambda x: x["n"] > 0))
    covered = F.aggregate(times, F.lit(0.0), lambda acc, x: acc + F.length(x["t"]) * x["n"])
    return (low != "") & (matched >= 2) & (covered / F.length(low) >= share)


def without_loops(segments: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Of each run of the same text in a recording the first max_repeats (at least one) stay."""
    order = W.partitionBy("video_id").orderBy("seg_no")
    runs = segments.withColumn("new", F.coalesce((F.col("text") != F.lag("text").over(order)).cast("int"), F.lit(1)))
    runs = runs.withColumn("run", F.sum("new").over(order))
    runs = runs.withColumn("nth", F.row_number().over(W.partitionBy("video_id", "run").orderBy("seg_no")))
    return runs.filter(F.col("nth") <= max(1, max_repeats)).drop("new", "run", "nth")


def flagged(segments: DataFrame, rules: list[tuple[str, str]] = (), terms: list[str] = (), patterns: list[str] = BOILERPLATE, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """All rows, their text with spacing and replacements, and kept: false for empty ones, boilerplate and glossary echoes (their
    text is null) and for repetitions beyond max_repeats of the kept one before. One scan, one exchange, on the recording."""
    rows = segments.withColumn("text", replaced(collapse(F.col("text")), list(rules)))
    good = (F.col("text") != "") & ~is_boilerplate(F.col("text"), patterns)
    if terms:
        good = good & ~is_glossary_echo(F.col("text"), list(terms))
    order = W.partitionBy("video_id").orderBy("seg_no")
    rows = rows.withColumn("_good", F.coalesce(good, F.lit(False))).withColumn("text", F.when(F.col("_good"), F.col("text")))
    before = F.last("text", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, -1))
    rows = rows.withColumn("_new", F.col("_good") & F.coalesce(F.col("text") != before, F.lit(True)))
    # counts within a run are differences of counts within the recording, so rows are sorted once
    so_far = order.rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("_nth", F.sum(F.col("_good").cast("int")).over(so_far))
    first = F.max(F.when(F.col("_new"), F.col("_nth"))).over(so_far)
    return rows.withColumn("kept", F.col("_good") & (F.col("_nth") - first < max(1, max_repeats))).drop("_good", "_new", "_nth")


def clean(segments: DataFrame, rules: list[tuple[str, str]] = (), terms: list[str] = (), patterns: list[str] = BOILERPLATE, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Spacing, replacements, boilerplate, glossary echoes, loops, in this order; one exchange, on the recording."""
    return flagged(segments, rules, terms, patterns, max_repeats).filter("kept").drop("kept")


def clean_counts(flags: DataFrame) -> DataFrame:
    """flagged() rows -> video_id, kept, dropped; counted in the pass that cleans."""
    return flags.groupBy("video_id").agg(F.count_if("kept").alias("kept"), F.count_if(~F.col("kept")).alias("dropped"))


def glossary_prompt(glossary: DataFrame, courses: DataFrame, limit: int = GLOSSARY_CHARS) -> DataFrame:
    """(course, pos, term) and (course, title) -> course, prompt: the title and the longest run of first terms that fits."""
    used = F.sum(F.length("term") + 2).over(W.partitionBy("course").orderBy("pos")) - 2
    fit = glossary.withColumn("used", used).filter(F.col("used") <= limit).groupBy("course").agg(F.sort_array(F.collect_list(F.struct("pos", "term"))).alias("terms"))
    there = glossary.select("course").distinct()
    listed = F.array_join(F.transform("terms", lambda x: x["term"]), ", ")
    joined = courses.join(there, "course").join(fit, "course", "left")
    return joined.select("course", F.concat("title", F.lit(". Имена и термины: "), F.coalesce(listed, F.lit("")), F.lit(".")).alias("prompt"))


def chunk_id(video_id: Column, number: Column) -> Column:
    return F.format_string("%s:%04d", video_id, number)


def without_bounds(segments: DataFrame) -> DataFrame:
    """Segments without a start or an end: windows() leaves them out."""
    return segments.filter("start is null or end is null")


def _with_steps(rows: DataFrame, window_s: float, overlap_s: float) -> DataFrame:
    """Adds _stops and _nexts to rows with view, own (how many segments of the view are the row's own) and whole (whether the view
    ends with the recording): where the window that begins at each own segment stops, and where the next one begins: -1 after a
    window that ends the recording; null where the view ends before that is known."""
    n, at = F.size("view"), lambda i: F.get("view", i)
    first = lambda i, a, b: F.get(F.filter(F.sequence(a, b), lambda j: at(j)["end"] - at(i)["start"] > window_s), F.lit(0))
    # mostly a window ends within a few segments; when() looks no further then
    over = lambda i: F.coalesce(first(i, i, F.least(i + NEAR, n - 1)), F.when(i + NEAR < n - 1, first(i, i + NEAR + 1, n - 1)))
    rows = rows.withColumn("_over", F.transform(F.sequence(F.lit(0), F.col("own") - 1), over))
    stops = F.transform("_over", lambda x, i: F.when(x.isNotNull() | F.col("whole"), F.greatest(F.coalesce(x, n), i + 1)))
    back = lambda i, stop: F.array_max(F.filter(F.sequence(i + 1, stop), lambda k: (k < stop) & (at(k)["start"] <= at(stop - 1)["end"] - overlap_s)))
    nexts = F.transform("_stops", lambda stop, i: F.when(F.col("whole") & (stop >= n), F.lit(-1)).when(stop.isNotNull(), F.coalesce(back(i, stop), i + 1)))
    return rows.withColumn("_stops", stops).withColumn("_nexts", nexts).drop("_over")


def _walked(rows: DataFrame) -> DataFrame:
    """Rows with entry, a place in their own segments -> video_id, windows (array of code, start, end, text) from there on."""
    last = lambda acc: F.get("_nexts", F.element_at(acc, -1))
    visited = F.aggregate(F.sequence(F.lit(1), F.col("own")), F.array("entry"), lambda acc, _: F.when(last(acc).between(0, F.col("own") - 1), F.concat(acc, F.array(last(acc)))).otherwise(acc))
    rows = rows.withColumn("_visited", visited)
    said = lambda i: strip(F.array_join(F.transform(F.slice("view", i + 1, F.get("_stops", i) - i), lambda x: x["text"]), " "))
    found = F.transform("_visited", lambda i: F.struct(F.get("view", i)["code"].alias("code"), F.get("view", i)["start"].alias("start"), F.get("view", F.get("_stops", i) - 1)["end"].alias("end"), said(i).alias("text")))
    return rows.select("video_id", F.filter(found, lambda x: x["text"] != "").alias("windows"))


def _cut(window_s: float, overlap_s: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Recordings of one cell (video_id, list) -> video_id, chunk_no, w: their windows, each of which depends on the one before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(a, RECORDINGS) for b in batches for a in range(0, b.num_rows, RECORDINGS)):
            lists = batch.column("list")
            flat, edges = lists.flatten(), np.append(0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))).tolist()
            start, end, text = (flat.field(c).to_pylist() for c in ("start", "end", "text"))
            whose, number, bounds, said = [], [], ([], []), []
            for row, (i, n) in enumerate(zip(edges, edges[1:])):
                done = 0
                while i < n:
                    # as Spark compares: NaN is more than anything
                    stop = i
                    while stop < n and end[stop] - start[i] <= window_s:
                        stop += 1
                    stop = max(stop, i + 1)
                    one = " ".join(text[i:stop]).strip(SPACES)
                    if one:
                        whose.append(row)
                        number.append(done)
                        bounds[0].append(start[i])
                        bounds[1].append(end[stop - 1])
                        said.append(one)
                        done += 1
                    if stop >= n:
                        break
                    back, k = end[stop - 1] - overlap_s, stop - 1
                    while k > i and not (start[k] <= back or back != back):
                        k -= 1
                    i = max(k, i + 1)
            w = pa.StructArray.from_arrays([pa.array(bounds[0], pa.float64()), pa.array(bounds[1], pa.float64()), pa.array(said, pa.string())], ["start", "end", "text"])
            yield pa.RecordBatch.from_arrays([batch.column("video_id").take(pa.array(whose, pa.int64())), pa.array(number, pa.int32()), w], ["video_id", "chunk_no", "w"])

    return run


def _reached(exits: DataFrame, cells: int) -> DataFrame:
    """exits (video_id, code, to: where its chain first leaves its cell) -> video_id, code of all places in which the chain from
    0 enters a cell. Pointers are doubled, so a chain through n cells takes log n rounds, each a join by place; each is written."""
    reached, jumps, far = exits.filter("code = 0").select("video_id", "code"), exits.filter("to is not null"), 1
    while far < cells:
        onward = reached.join(jumps, ["video_id", "code"]).select("video_id", F.col("to").alias("code"))
        reached = stored(reached.unionByName(onward), "reached")
        second = jumps.select("video_id", F.col("code").alias("to"), F.col("to").alias("then"))
        jumps, far = stored(jumps.join(second, ["video_id", "to"]).select("video_id", "code", F.col("then").alias("to")), "jumps"), far * 2
    return reached


def _long_windows(cells: DataFrame, window_s: float, overlap_s: float, size: int) -> DataFrame:
    """Cells of recordings that have several -> video_id, windows, as _walked(). A cell's view is its own segments and those of the
    next cell, or of as many as it takes; then each place knows its step, and only the cells' entries are found by rounds."""
    cells = stored(numbered(cells, ["video_id", "cell"], "at", ["video_id"]), "cells")
    count = cells.groupBy("video_id").agg((F.max("at") + 1).alias("cells"))
    coded = F.transform("list", lambda x, i: F.struct((F.col("at") * size + i).alias("code"), x["start"].alias("start"), x["end"].alias("end"), x["text"].alias("text")))
    base = cells.join(count, "video_id").select("video_id", "at", "cells", coded.alias("list"))
    due, span, done = base.select("video_id", "at", "cells", F.size("list").alias("own")), 1, None
    while True:
        asked = due.withColumn("other", F.explode(F.sequence(F.col("at"), F.least(F.col("at") + span, F.col("cells") - 1))))
        met = asked.join(base.select("video_id", F.col("at").alias("other"), "list"), ["video_id", "other"])
        seen = met.groupBy("video_id", "at", "cells", "own").agg(F.array_sort(F.flatten(F.collect_list("list"))).alias("view"))
        seen = stored(_with_steps(seen.withColumn("whole", F.col("at") + span >= F.col("cells") - 1), window_s, overlap_s), "views")
        open_ = F.exists("_stops", lambda x: x.isNull())
        done = seen.filter(~open_) if done is None else done.unionByName(seen.filter(~open_))
        due, span = seen.filter(open_).select("video_id", "at", "cells", "own"), span * 4
        if due.isEmpty():
            break
    code = lambda i: F.get("view", i)["code"]
    # from the last place to the first: where a place's chain leaves the cell is where the place after it does
    out = lambda acc, i: F.when(F.get("_nexts", i) < 0, F.lit(None)).when(F.get("_nexts", i) >= F.col("own"), code(F.get("_nexts", i))).otherwise(F.get(acc, F.get("_nexts", i) - i - 1))
    leaving = F.aggregate(F.sequence(F.col("own") - 1, F.lit(0), F.lit(-1)), F.array().cast("array<bigint>"), lambda acc, i: F.concat(F.array(out(acc, i)), acc))
    exits = done.withColumn("_leaving", leaving).select("video_id", "at", F.posexplode_outer("_leaving").alias("k", "to"))
    exits = stored(exits.select("video_id", (F.col("at") * size + F.col("k")).alias("code"), "to"), "exits")
    reached = _reached(exits, count.agg(F.max("cells")).first()[0])
    entries = reached.select("video_id", F.floor(F.col("code") / size).alias("at"), (F.col("code") % size).cast("int").alias("entry"))
    return _walked(done.join(entries, ["video_id", "at"]))


def windows(segments: DataFrame, window_s: float = WINDOW_S, overlap_s: float = OVERLAP_S, cell: int = CELL) -> DataFrame:
    """Segments (video_id, seg_no, start, end, text) -> chunks: chunk_id, video_id, chunk_no, start, end, text.

    Each window takes segments until the first that ends more than window_s after it began, at least one; the next begins as
    far back as the overlap allows, and at least one segment on. Windows without text have no number. A null text counts as
    empty; segments without a start or an end are left out (see without_bounds()). Recordings are dealt in cells of ``cell``
    numbers: one cell is walked in its row, and a longer recording is as many tasks as it has cells.
    """
    item = F.struct("seg_no", "start", "end", F.coalesce("text", F.lit("")).alias("text"))
    rows = segments.filter("start is not null and end is not null").groupBy("video_id", F.floor(F.col("seg_no") / cell).alias("cell"))
    cells = stored(rows.agg(F.sort_array(F.collect_list(item)).alias("list")), "cells")
    several = stored(cells.groupBy("video_id").agg(F.count("*").alias("n")).filter("n > 1").select("video_id"), "several")
    alone = cells.join(several, "video_id", "left_anti")
    found = alone.mapInArrow(_cut(window_s, overlap_s), f"video_id {segments.schema['video_id'].dataType.simpleString()}, chunk_no int, w struct<start:double,end:double,text:string>")
    if not several.isEmpty():
        long = _long_windows(cells.join(several, "video_id", "left_semi"), window_s, overlap_s, cell)
        long = long.select("video_id", F.explode_outer("windows").alias("w")).filter("w is not null").select("video_id", "w", "w.code")
        long = numbered(long, ["video_id", "code"], "chunk_no", ["video_id"])
        found = found.unionByName(long.select("video_id", F.col("chunk_no").cast("int").alias("chunk_no"), F.struct("w.start", "w.end", "w.text").alias("w")))
    return found.select(chunk_id(F.col("video_id"), F.col("chunk_no")).alias("chunk_id"), "video_id", "chunk_no", "w.start", "w.end", "w.text")


def course_windows(sources: DataFrame, segments: DataFrame, **sizes: float) -> tuple[DataFrame, DataFrame]:
    """(course, video_id, order) x segments -> (chunks with course and order, sources without a transcript)."""
    chunks = windows(segments.join(sources.select("video_id").distinct(), "video_id", "left_semi"), **sizes)
    return chunks.join(sources.select("course", "video_id", "order"), "video_id"), sources.join(segments.select("video_id").distinct(), "video_id", "left_anti")


def not_yet_cut(segments: DataFrame, chunks: DataFrame, force: bool = False) -> DataFrame:
    """Segments of recordings that have no chunks; all when forced."""
    return segments if force else segments.join(chunks.select("video_id").distinct(), "video_id", "left_anti")


def append_windows(index: Batches, segments: DataFrame, batch: str) -> bool:
    """Cut the recordings that no published batch has, and publish their chunks as one. Whether there was anything new; a batch
    without a chunk is an error. A run that broke off has published nothing, and one that is repeated publishes nothing twice."""
    if any(r["batch"] == batch for r in index.listed()):
        return False
    return index.append(batch, chunks=windows(not_yet_cut(segments, index.read("chunks", CHUNKS))))


def unit_vectors(df: DataFrame, column: str = "embedding") -> DataFrame:
    size = F.sqrt(F.aggregate(column, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    return df.withColumn("_size", size).withColumn(column, F.transform(column, lambda x: F.when(F.col("_size") > 0, x / F.col("_size")).otherwise(x.cast("double")))).drop("_size")
