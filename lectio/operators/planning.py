"""What is to be asked: tickets, content hashes, resume, prompts, registration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectio.functions.text import fill, indented_json
from lectio.operators.ordering import numbered
from lectio.operators.replies import MATERIAL
from lectio.sources.shared import spread

#: The note and the guidance of a prompt by the kind of its question.
KIND_NOTE = {
    "general": "общий список МФТИ — тема шире того, что читалось в курсе",
    "course": "список курса — тема разбиралась на лекциях",
}


def tickets(courses: DataFrame, question_sets: DataFrame, question_set: str | None = None, question_id: str | None = None) -> DataFrame:
    """Questions of each course's sets: course, question_set, kind, question_id, number, text."""
    wanted = courses.select("course", F.explode("question_sets").alias("question_set")).distinct()
    rows = question_sets.join(wanted, "question_set")
    if question_set is not None:
        rows = rows.filter(F.col("question_set") == question_set)
    if question_id is not None:
        rows = rows.filter(F.col("question_id") == question_id)
    return rows.select("course", "question_set", "kind", "question_id", "number", "text")


def extract_hashes(questions: DataFrame, candidates: DataFrame, chunks: DataFrame, model: str, template: str) -> DataFrame:
    """question_id, input_hash: sha256 of question, each candidate's id and text in order, model and template, joined by nothing."""
    rows = candidates.join(chunks.select("chunk_id", F.col("text").alias("said")), "chunk_id")
    listed = rows.groupBy("question_id").agg(F.sort_array(F.collect_list(F.struct("position", "chunk_id", "said"))).alias("all"))
    joined = questions.select("question_id", "text").join(listed, "question_id", "left")
    body = F.coalesce(F.array_join(F.transform("all", lambda x: F.concat(x["chunk_id"], x["said"])), ""), F.lit(""))
    return joined.select("question_id", F.sha2(F.concat("text", body, F.lit(model), F.lit(template)), 256).alias("input_hash"))


def answer_hash(question: Column, extract_hash: Column, relevant: Column, model: Column, template: str, version: str = "synthesize_v1", limit: int = MATERIAL) -> Column:
    """sha256 of question, extract hash, id and points of the first ``limit`` fragments, model, template or its version."""
    body = F.array_join(F.transform(F.slice(relevant, 1, limit), lambda x: F.concat(x["chunk_id"], F.array_join(x["points"], " "))), "")
    return F.sha2(F.concat(question, extract_hash, body, model, F.lit(template or version)), 256)


def work_plan(asked: DataFrame, answers: DataFrame, extracts: DataFrame, model: str, template: str, force: bool = False) -> DataFrame:
    """tickets x stored answers and extracts -> question_id, question_set, ready.

    Ready: both exist and were made by ``model``, the answer has no error, and its hash is what it would be today.
    """
    a = answers.select("question_id", F.col("model").alias("a_model"), F.col("input_hash").alias("a_hash"), "error")
    x = extracts.select("question_id", F.col("model").alias("x_model"), F.col("input_hash").alias("x_hash"), "relevant")
    rows = asked.join(a, "question_id", "left").join(x, "question_id", "left")
    today = answer_hash(F.col("text"), F.col("x_hash"), F.col("relevant"), F.lit(model), template)
    ready = (F.coalesce("error", F.lit("")) == "") & (F.col("a_model") == model) & (F.col("x_model") == model) & (F.col("a_hash") == today)
    return rows.select("question_id", "question_set", F.lit(False).alias("ready") if force else F.coalesce(ready, F.lit(False)).alias("ready"))


def pending(sources: DataFrame, audio: DataFrame, transcripts: DataFrame, force: bool = False, limit: int = 0) -> DataFrame:
    """Recordings with audio and without transcript, in order; limit 0: all."""
    rows = sources.join(audio.select("video_id").distinct(), "video_id", "left_semi")
    rows = rows if force else rows.join(transcripts.select("video_id").distinct(), "video_id", "left_anti")
    return rows.orderBy("order").limit(limit) if limit else rows


def registered(metadata: DataFrame, entries: int | None = None) -> DataFrame:
    """Fetched metadata (course, url_pos, type, id, title, duration, entries) -> course, video_id, url, title, duration_s, order.

    Playlists give their entries, null ones left out, anything else itself; the first occurrence of an id counts. The order
    within a course comes from ranges of the whole table, so a course of any size is as many tasks as it fills.
    entries: about how many there are in all, if that is known; what a task sorts does not grow with them then.
    """
    own = F.array(F.struct("id", "title", "duration"))
    listed = F.when(F.col("type") == "playlist", F.col("entries")).otherwise(own)
    rows = metadata.select("course", "url_pos", F.posexplode(listed).alias("entry_pos", "e")).filter("e is not null and e.id is not null")
    rows = rows.select("course", F.col("e.id").alias("id"), "url_pos", "entry_pos", F.col("e.title").alias("title"), F.col("e.duration").alias("duration"))
    rows = rows if entries is None else spread(rows, entries, "course", "id")
    rows = rows.groupBy("course", "id").agg(F.min(F.struct("url_pos", "entry_pos", "title", "duration")).alias("first")).select("course", "id", "first.*")
    rows = numbered(rows, ["course", "url_pos", "entry_pos"], "order", ["course"])
    order = (F.col("order") + 1).cast("int")
    return rows.select("course", F.col("id").alias("video_id"), F.concat(F.lit("https://www.youtube.com/watch?v="), "id").alias("url"), F.coalesce(F.nullif("title", F.lit("")), "id").alias("title"), F.nullif(F.col("duration").cast("double"), F.lit(0.0)).alias("duration_s"), order.alias("order"))


def prompts(rows: DataFrame, template: str, fields: list[str]) -> DataFrame:
    """Adds prompt: the template with {field} filled in order from the columns of that name. Strings go in as they are, all else
    (numbers, truth values, arrays, objects, maps) as JSON; a null is null, of whatever type."""
    texts = {name for name, kind in rows.dtypes if kind == "string"}
    values = {f: F.coalesce(F.col(f), F.lit("null")) if f in texts else indented_json(F.col(f)) for f in fields}
    return rows.withColumn("prompt", fill(F.lit(template), values))


def kind_text(kind: Column, texts: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in texts.items() for x in pair))[kind]


def with_kind_texts(rows: DataFrame, settings: dict[str, dict[str, str]]) -> DataFrame:
    """Adds a column for each setting (a note, a guidance, ...): its wording for the row's kind, null for other kinds."""
    return rows.withColumns({name: kind_text(F.col("kind"), texts) for name, texts in settings.items()})


def finished_answers(assembled: DataFrame, asked: DataFrame, extracts: DataFrame, model: str, template: str = "", version: str = "synthesize_v1") -> DataFrame:
    """assemble_answers() x tickets (question_id, question_set, text) x extracts (question_id, input_hash, relevant) -> answers as
    they are stored: with question, set, model, prompt version, the hash of what was asked, and the time.

    A question without an extract was asked with none. Answers to no ticket are left out; failed ones are dead letters.
    """
    x = extracts.select("question_id", F.col("input_hash").alias("x_hash"), "relevant")
    rows = assembled.join(asked.select(F.col("question_id").alias("answer_id"), "question_set", "text"), "answer_id").join(x.withColumnRenamed("question_id", "answer_id"), "answer_id", "left")
    none = F.array().cast(extracts.schema["relevant"].dataType)
    today = answer_hash(F.col("text"), F.coalesce("x_hash", F.lit("")), F.coalesce("relevant", none), F.lit(model), template, version)
    return rows.select(
        F.lit(1).alias("schema_version"), F.col("answer_id").alias("question_id"), "question_set", F.col("text").alias("question"), "answer_md", "outside_lectures_md", "citations", "readings", "coverage",
        F.lit(model).alias("model"), F.lit(version).alias("prompt_version"), today.alias("input_hash"), F.current_timestamp().alias("generated_at"), F.lit(None).cast("string").alias("error"),
    )


def run_cost(candidates: DataFrame, plan: DataFrame) -> DataFrame:
    """questions, judgements and model calls of what is not ready."""
    due = plan.filter("not ready").select("question_id")
    per = due.join(candidates.groupBy("question_id").agg(F.count("*").alias("n")), "question_id", "left")
    return per.agg(F.count("*").alias("questions"), F.coalesce(F.sum("n"), F.lit(0)).alias("judgements")).select("questions", "judgements", (F.col("questions") + F.col("judgements")).alias("calls"))
