"""Roll-ups, site look-ups and data-quality checks."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectio.operators.replies import COVERAGES, verified_coverage

#: Names of stages.
STAGES = ["ingest", "download", "prepare-audio", "transcribe", "index", "extract", "answer"]
#: Path parts that never go to the public site.
PRIVATE = ["/audio", "/transcripts", "/extracts", "chunks.jsonl", ".npy"]
#: Answers of a part of a manifest.
PART, PARTS = 1024, "course string, part long, body binary"


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def stage_status(sources: DataFrame, done: dict[str, DataFrame], asked: DataFrame) -> DataFrame:
    """course, stage, done, total, complete. done: for each stage a table with course and a row for each thing that is done.

    Extracts and answers are counted against the tickets, chunks against themselves, all else against the sources.
    """
    counted = _all([d.select("course", F.lit(k).alias("stage")) for k, d in done.items()]).groupBy("course", "stage").agg(F.count("*").alias("done"))
    per = sources.groupBy("course").agg(F.count("*").alias("n_sources")).join(asked.groupBy("course").agg(F.count("*").alias("n_asked")), "course", "left")
    grid = per.withColumn("stage", F.explode(F.array(*map(F.lit, STAGES)))).join(counted, ["course", "stage"], "left").withColumn("done", F.coalesce("done", F.lit(0)))
    total = F.when(F.col("stage").isin("extract", "answer"), F.coalesce("n_asked", F.lit(0))).when(F.col("stage") == "index", F.col("done")).otherwise(F.col("n_sources"))
    return grid.select("course", "stage", "done", total.alias("total"), ((total > 0) & (F.col("done") == total)).alias("complete"))


def done_stages(listing: DataFrame) -> dict[str, DataFrame]:
    """list_artifacts() -> for stage_status(), what is done of each stage. A recording has audio if any form of it lies there; of
    several forms one counts."""
    name = F.regexp_replace(stem(F.col("path")), r"\.[^.]*$", "")
    audio = listing.filter(F.col("stage").isin("download", "prepare-audio")).select("course", name.alias("video_id")).distinct()
    return {"download": audio, **{k: listing.filter(F.col("stage") == k) for k in ("ingest", "prepare-audio", "transcribe", "index", "extract", "answer")}}


def coverage_breakdown(answers: DataFrame) -> DataFrame:
    """question_set, full, partial, not_found."""
    return answers.groupBy("question_set").pivot("coverage", COVERAGES).count().na.fill(0)


def failed_answers(answers: DataFrame) -> DataFrame:
    return answers.filter(F.coalesce("error", F.lit("")) != "").select("question_id", "error")


def course_summary(sources: DataFrame, answers: DataFrame) -> DataFrame:
    """course, videos, answers, citations."""
    a = answers.groupBy("course").agg(F.count("*").alias("answers"), F.sum(F.size("citations")).alias("citations"))
    joined = sources.groupBy("course").agg(F.count("*").alias("videos")).join(a, "course", "left")
    return joined.select("course", "videos", F.coalesce("answers", F.lit(0)).alias("answers"), F.coalesce("citations", F.lit(0)).alias("citations"))


def ready_counts(question_sets: DataFrame, answers: DataFrame) -> DataFrame:
    """question_set, ready, total: questions with a coverage; a missing one reads as none."""
    rows = question_sets.join(answers.select("question_id", "coverage").dropDuplicates(["question_id"]), "question_id", "left")
    return rows.groupBy("question_set").agg(F.count("coverage").alias("ready"), F.count("*").alias("total"))


def manifest(courses: DataFrame, sources: DataFrame, answers: DataFrame) -> DataFrame:
    """course, title, language (ru where none is given), question_sets, videos, answers (sorted array of question, set,
    coverage and number of citations), as_json."""
    a = answers.groupBy("course").agg(F.sort_array(F.collect_list(F.struct("question_id", "question_set", "coverage", F.size("citations").alias("citations")))).alias("answers"))
    n = sources.groupBy("course").agg(F.count("*").alias("videos"))
    rows = courses.select("course", "title", F.coalesce("language", F.lit("ru")).alias("language"), "question_sets").join(n, "course", "left").join(a, "course", "left")
    rows = rows.na.fill(0, ["videos"]).withColumn("answers", F.coalesce("answers", F.array().cast(rows.schema["answers"].dataType)))
    return rows.withColumn("as_json", F.to_json(F.struct(F.col("course").alias("slug"), "title", "language", "question_sets", "videos", "answers")))


def manifest_parts(courses: DataFrame, sources: DataFrame, answers: DataFrame) -> DataFrame:
    """course, part, body (zlib): the text that manifest() has in as_json, for courses whose answers are too many for a row.

    Of a course, part -1 is what stands before the answers; the others, in this order, are up to PART answers each, joined by
    commas. ``courses`` must have a course once. One exchange of the answers, by ranges, so a course is as many tasks as it fills.
    """
    one = ["question_id", "question_set", "coverage", "citations"]
    rows = answers.withColumn("citations", F.size("citations")).select("course", *one).repartitionByRange("course", *one).sortWithinPartitions("course", *one)
    rows = rows.select("course", F.monotonically_increasing_id().alias("part"), F.to_json(F.struct(*one)).alias("body"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said, names, at = [], batch.column("course").to_pylist(), batch.column("part").to_pylist()
            bodies, first = batch.column("body").to_pylist(), 0
            for i in range(1, len(names) + 1):
                if i == len(names) or i - first == PART or names[i] != names[first] or at[i] != at[i - 1] + 1:
                    said.append((names[first], at[first], zlib.compress(",".join(bodies[first:i]).encode())))
                    first = i
            if said:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*said), (pa.string(), pa.int64(), pa.binary()))], ["course", "part", "body"])

    n = sources.groupBy("course").agg(F.count("*").alias("videos"))
    heads = courses.select("course", "title", F.coalesce("language", F.lit("ru")).alias("language"), "question_sets").join(n, "course", "left").na.fill(0, ["videos"])
    text = F.to_json(F.struct(F.col("course").alias("slug"), "title", "language", "question_sets", "videos"))

    def pressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.set_column(2, "body", pa.array([zlib.compress(x.encode()) for x in batch.column("body").to_pylist()], pa.binary()))

    heads = heads.select("course", F.lit(-1).cast("long").alias("part"), F.concat(F.substring(text, F.lit(1), F.length(text) - 1), F.lit(',"answers":[')).alias("body"))
    return heads.mapInArrow(pressed, PARTS).unionByName(rows.mapInArrow(joined, PARTS).join(courses.select("course"), "course", "left_semi"))


def manifest_digests(parts: DataFrame) -> DataFrame:
    """manifest_parts() -> course, md5 of the whole text. A digest needs its bytes in order, so a course is one task; it holds a
    few parts at a time."""

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        course, answers, md5 = None, 0, None

        def whole() -> pa.RecordBatch:
            md5.update(b"]}")
            return pa.RecordBatch.from_pydict({"course": [course], "md5": [md5.hexdigest()]})

        for batch in batches:
            for name, part, body in zip(*(batch.column(c) for c in ("course", "part", "body"))):
                name, part = name.as_py(), part.as_py()
                if md5 is None or name != course:
                    if md5 is not None:
                        yield whole()
                    course, answers, md5 = name, 0, hashlib.md5()
                md5.update(b"," * (answers > 0) + zlib.decompress(body.as_py()))
                answers += part >= 0
        if md5 is not None:
            yield whole()

    return parts.repartition("course").sortWithinPartitions("course", "part").mapInArrow(digested, "course string, md5 string")


def stem(path: Column) -> Column:
    """A file's name without its last ending."""
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)


def whole_manifest(courses: DataFrame, sources: DataFrame, answers: DataFrame, question_sets: DataFrame, crosswalks: DataFrame) -> DataFrame:
    """section, id, as_json: a row for each course (see manifest()), question set and crosswalk of the site's index.

    question_sets: exploded (question_set, title, kind, question_id, number, text); their questions are put in by number.
    crosswalks: (path, id, status, pairs); one without an id has its file's name.
    """
    c = manifest(courses, sources, answers).select(F.lit("courses").alias("section"), F.col("course").alias("id"), "as_json")
    one = F.struct("number", F.struct(F.col("question_id").alias("id"), "number", "text").alias("q"))
    q = question_sets.groupBy("question_set").agg(F.min("title").alias("title"), F.min("kind").alias("kind"), F.transform(F.sort_array(F.collect_list(one)), lambda x: x["q"]).alias("questions"))
    q = q.select(F.lit("question_sets"), F.col("question_set").alias("id"), F.to_json(F.struct(F.col("question_set").alias("id"), "title", "kind", "questions")))
    named = F.coalesce(F.nullif("id", F.lit("")), stem(F.col("path")))
    x = crosswalks.select(F.lit("crosswalks"), named.alias("id"), F.to_json(F.struct(named.alias("id"), "status", "pairs")))
    return c.unionAll(q).unionAll(x)


def publishable(listing: DataFrame, private: list[str] = PRIVATE) -> DataFrame:
    """Rows whose path holds none of the private parts."""
    return listing.filter(~reduce(Column.__or__, (F.col("path").contains(p) for p in private)))


def sets_of_course(courses: DataFrame, question_sets: DataFrame) -> DataFrame:
    """course, position, question_set of the sets that exist."""
    there = question_sets.select("question_set").distinct()
    return courses.select("course", F.posexplode("question_sets").alias("position", "question_set")).join(there, "question_set").select("course", "position", "question_set")


def found_questions(question_sets: DataFrame) -> DataFrame:
    """question_id -> the first set that has it (set_pos, number)."""
    return question_sets.groupBy("question_id").agg(F.min_by("question_set", F.struct("set_pos", "number")).alias("question_set"), F.min_by("text", F.struct("set_pos", "number")).alias("text"))


def related_questions(crosswalks: DataFrame) -> DataFrame:
    """(crosswalk_id, course_question, general: array) -> question_id, related: distinct and sorted, both ways."""
    pairs = crosswalks.select(F.col("course_question").alias("c"), F.explode("general").alias("g"))
    both = pairs.select(F.col("c").alias("question_id"), F.col("g").alias("other")).unionAll(pairs.filter("c <> g").select("g", "c"))
    return both.groupBy("question_id").agg(F.array_sort(F.collect_set("other")).alias("related"))


def duplicates(df: DataFrame, scope: list[str], key: str) -> DataFrame:
    """scope, key, times: keys that occur more than once within a scope."""
    return df.groupBy(*scope, key).agg(F.count("*").alias("times")).filter("times > 1")


def taken_ids(question_sets: DataFrame) -> DataFrame:
    """question_id, question_set, earlier: ids that a set before has already."""
    order = W.partitionBy("question_id").orderBy("path", "number")
    return question_sets.withColumn("earlier", F.lag("question_set").over(order)).filter("earlier is not null and earlier <> question_set").select("question_id", "question_set", "earlier")


def unknown_in_crosswalk(crosswalks: DataFrame, question_sets: DataFrame) -> DataFrame:
    """crosswalk_id, question_id that no set has."""
    named = crosswalks.select("crosswalk_id", F.explode(F.concat(F.array("course_question"), "general")).alias("question_id")).distinct()
    return named.join(question_sets.select("question_id").distinct(), "question_id", "left_anti").select("crosswalk_id", "question_id")


def unknown_sets(courses: DataFrame, question_sets: DataFrame) -> DataFrame:
    named = courses.select("course", F.explode("question_sets").alias("question_set"))
    return named.join(question_sets.select("question_set").distinct(), "question_set", "left_anti").select("course", "question_set")


def name_mismatches(files: DataFrame) -> DataFrame:
    """(path, id) -> rows whose id is not the file's stem."""
    return files.withColumn("stem", stem(F.col("path"))).filter("stem <> id")


def violations(df: DataFrame, key: list[str], rules: dict[str, Column]) -> DataFrame:
    """key, rule: one row for each rule that a row breaks (rules are conditions that hold; null breaks)."""
    broken = F.filter(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items())), lambda x: x.isNotNull())
    return df.select(*key, F.explode(broken).alias("rule"))


#: What ids, slugs and the values of some fields look like.
QUESTION_ID, CHUNK_ID, SLUG = r"^[a-z]{1,4}\d{2,3}$", r"^[\w-]+:\d{4,}$", r"^[a-z0-9][a-z0-9-]*$"
KINDS, STATUSES, RECOGNISERS = ["general", "course"], ["draft", "verified"], ["whisper", "captions"]


def patterns(kind: str) -> dict[str, Column]:
    """Rules of the rows of one kind."""
    c = F.col
    whole = {"schema_version": F.coalesce("schema_version", F.lit(1)) == 1} if kind in ("set", "crosswalk", "course", "transcript", "extract", "answer") else {}
    return whole | {
        "set": lambda: {"id": c("id").rlike(SLUG), "kind": c("kind").isin(KINDS), "title": c("title").isNotNull(), "questions": F.size("questions") >= 1},
        "question": lambda: {"question_id": c("question_id").rlike(QUESTION_ID), "number": c("number") >= 1, "text": c("text") != ""},
        "crosswalk": lambda: {"id": c("id").isNull() | c("id").rlike(SLUG), "status": c("status").isin(STATUSES), "pairs": c("pairs").isNotNull()},
        "pair": lambda: {"course": c("course").rlike(QUESTION_ID), "general": (F.size("general") >= 1) & F.forall("general", lambda x: x.rlike(QUESTION_ID))},
        "course": lambda: {"slug": c("slug").rlike(SLUG), "title": c("title").isNotNull(), "question_sets": (F.size("question_sets") >= 1) & F.forall("question_sets", lambda x: x.rlike(SLUG))},
        "source": lambda: {"order": c("order") >= 1, "duration_s": c("duration_s").isNull() | (c("duration_s") >= 0), "video_id": c("video_id") != "", "url": c("url").isNotNull(), "title": c("title").isNotNull()},
        "transcript": lambda: {"video_id": c("video_id") != "", "source": c("source").isin(RECOGNISERS), "segments": c("segments").isNotNull()},
        "segment": lambda: {"start": c("start") >= 0, "end": c("end") >= c("start")},
        "chunk": lambda: {"chunk_id": c("chunk_id").rlike(CHUNK_ID), "source_type": F.coalesce("source_type", F.lit("video")) == "video", "video_id": c("video_id") != "", "start": c("start") >= 0, "end": c("end") >= 0, "text": c("text") != ""},
        "fragment": lambda: {"chunk_id": c("chunk_id").rlike(CHUNK_ID), "relevance": c("relevance").between(0, 1), "points": F.size("points") >= 1, "quote": c("quote") != ""},
        "extract": lambda: {"question_id": c("question_id").rlike(QUESTION_ID), "candidates": c("candidates") >= 0},
        "answer": lambda: {"question_id": c("question_id").rlike(QUESTION_ID), "coverage": c("coverage").isin(COVERAGES)},
    }[kind]()


def gaps_in_numbers(answers: DataFrame) -> DataFrame:
    """question_id of answers whose citation numbers are not 1 ... N in order of number."""
    n = F.size("citations")
    dense = F.when(n > 0, F.array_sort(F.transform("citations", lambda x: x["n"].cast("int"))) == F.sequence(F.lit(1), F.greatest(n, F.lit(1)))).otherwise(True)
    return answers.filter(~dense).select("question_id")


def unknown_keys(raw: DataFrame, allowed: list[str] | dict[str, list[str]]) -> DataFrame:
    """(path, raw JSON) -> path, key for each key that the schema does not have.

    allowed: the keys of the object, or the keys by place: "" for the object itself, else the name of a field (fields within
    fields joined by dots) that holds an object or an array of objects. Keys below the object come with their place.
    """
    if not isinstance(allowed, dict):
        allowed = {"": allowed}

    def objects_at(place: str) -> Column:
        objects = F.array(F.try_parse_json("raw"))
        for field in place.split(".") if place else ():
            inner = F.transform(objects, lambda o: F.try_variant_get(o, f"$.{field}", "variant"))  # noqa: B023
            listed = F.transform(inner, lambda o: F.when(F.schema_of_variant(o).startswith("ARRAY<"), F.try_variant_get(o, "$", "array<variant>")).otherwise(F.array(o)))
            objects = F.flatten(listed)
        return F.filter(objects, lambda o: F.schema_of_variant(o).startswith("OBJECT<"))

    def odd_at(place: str, keys: list[str]) -> Column:
        found = F.flatten(F.transform(objects_at(place), lambda o: F.json_object_keys(F.to_json(o))))
        return F.transform(F.array_except(found, F.array(*map(F.lit, keys))), lambda k: F.concat(F.lit(place + "." if place else ""), k))

    parts = [odd_at(place, keys) for place, keys in allowed.items()]
    return raw.select("path", F.explode(F.flatten(F.array(*parts))).alias("key"))


def validation_report(findings: DataFrame, checked: DataFrame) -> DataFrame:
    """(path, severity) x checked paths -> path, errors, warnings, ok."""
    n = findings.groupBy("path").agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"))
    rows = checked.select("path").distinct().join(n, "path", "left").na.fill(0, ["errors", "warnings"])
    return rows.withColumn("ok", F.col("errors") == 0)


def coverage_audit(answers: DataFrame) -> DataFrame:
    """Stored answers whose coverage is not what their citations allow: question_id, coverage, citations, allowed."""
    rows = answers.select("question_id", "coverage", F.size("citations").alias("citations"))
    return rows.withColumn("allowed", verified_coverage(F.col("coverage"), F.col("citations"))).filter("coverage <> allowed")


def manifest_drift(index: DataFrame, answers: DataFrame) -> DataFrame:
    """question_id, problem: rows of the manifest (question_id, coverage, citations) that do not agree with the answers."""
    a = answers.select("question_id", F.col("coverage").alias("a_coverage"), F.size("citations").alias("a_citations"))
    both = index.select("question_id", "coverage", "citations").join(a, "question_id", "full_outer")
    problem = F.when(F.col("a_coverage").isNull(), "no answer").when(F.col("coverage").isNull(), "not in manifest").when((F.col("coverage") != F.col("a_coverage")) | (F.col("citations") != F.col("a_citations")), "differs")
    return both.select("question_id", problem.alias("problem")).filter("problem is not null")


#: Keys of the files that are checked together, by place.
SET_KEYS = {"": ["schema_version", "id", "title", "description", "kind", "questions"], "questions": ["id", "number", "text"]}
CROSSWALK_KEYS = {"": ["schema_version", "id", "status", "pairs"], "pairs": ["course", "general"]}
COURSE_KEYS = {"": ["schema_version", "slug", "title", "language", "question_sets", "sources"], "sources": ["video_id", "url", "title", "duration_s", "order"]}
SET_FILE = "schema_version int, id string, title string, description string, kind string, questions array<struct<id:string,number:int,text:string>>"
CROSSWALK_FILE = "schema_version int, id string, status string, pairs array<struct<course:string,general:array<string>>>"
COURSE_FILE = "schema_version int, slug string, title string, language string, question_sets array<string>, sources array<struct<video_id:string,url:string,title:string,duration_s:double,order:int>>"


def findings(sets: DataFrame, crosswalks: DataFrame, courses: DataFrame) -> DataFrame:
    """(path, raw JSON) of all question sets, crosswalks and courses -> path, severity, rule, detail: I1 to I5 and I8 together.

    Files that break a rule of their own are errors and are not compared with others. Of the others: an id that an earlier
    set (by path) has, an unknown question of a crosswalk, an unknown set of a course and a course in another's folder are
    errors; a set whose id is not its file's name is a warning.
    """

    def read(raw: DataFrame, schema: str) -> DataFrame:
        return raw.select("path", F.from_json("raw", schema).alias("o")).select("path", "o.*")

    def error(df: DataFrame, rule: Column, detail: Column, severity: str = "error") -> DataFrame:
        return df.select("path", F.lit(severity).alias("severity"), rule.alias("rule"), detail.cast("string").alias("detail"))

    s, x, c = read(sets, SET_FILE), read(crosswalks, CROSSWALK_FILE), read(courses, COURSE_FILE)
    questions = s.select("path", F.col("id").alias("question_set"), F.explode("questions").alias("q")).select("path", "question_set", F.col("q.id").alias("question_id"), "q.number", "q.text")
    pairs = x.select("path", F.explode("pairs").alias("p")).select("path", "p.*")
    sources = c.select("path", F.explode("sources").alias("s")).select("path", "s.*")
    broken = [violations(df, ["path"], patterns(kind)) for df, kind in ((s, "set"), (questions, "question"), (x, "crosswalk"), (pairs, "pair"), (c, "course"), (sources, "source"))]
    own = [error(df, F.lit("invalid"), F.col("rule")) for df in broken]
    own += [error(unknown_keys(raw, keys), F.lit("unknown key"), F.col("key")) for raw, keys in ((sets, SET_KEYS), (crosswalks, CROSSWALK_KEYS), (courses, COURSE_KEYS))]
    own += [error(duplicates(df, ["path"], key), F.lit("duplicate"), F.col(key)) for df, key in ((questions, "question_id"), (questions, "number"), (pairs, "course"), (sources, "video_id"))]
    wrong = _all(own)
    bad = wrong.select("path").distinct()
    good = lambda df: df.join(bad, "path", "left_anti")
    known = good(questions)
    taken = taken_ids(known).join(good(s).select("path", F.col("id").alias("question_set")), "question_set")
    walked = good(x).select("path", F.explode("pairs").alias("p")).select(F.col("path").alias("crosswalk_id"), F.col("p.course").alias("course_question"), F.col("p.general").alias("general"))
    unknown = unknown_in_crosswalk(walked, known).withColumnRenamed("crosswalk_id", "path")
    named = unknown_sets(good(c).select(F.col("path").alias("course"), "question_sets"), good(s).select(F.col("id").alias("question_set"))).withColumnRenamed("course", "path")
    folder = F.regexp_extract("path", r"([^/]+)/[^/]*$", 1)
    return _all([
        wrong, error(taken, F.lit("taken id"), F.col("question_id")), error(unknown, F.lit("unknown question"), F.col("question_id")), error(named, F.lit("unknown set"), F.col("question_set")),
        error(good(c).filter(F.col("slug") != folder), F.lit("slug"), F.col("slug")), error(name_mismatches(good(s).select("path", "id")), F.lit("name"), F.col("id"), "warning"),
    ])


def validated(sets: DataFrame, crosswalks: DataFrame, courses: DataFrame) -> DataFrame:
    """(path, raw) of the three kinds of files -> path, errors, warnings, ok for every file."""
    checked = _all([df.select("path") for df in (sets, crosswalks, courses)])
    return validation_report(findings(sets, crosswalks, courses), checked)
