"""Reading and writing of the artifacts: JSON objects, JSON lines, plain lists, rules, question sets."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectio.functions.text import strip
from lectio.operators.guard import guarded

QUESTION_SET = "id string, title string, description string, kind string, questions array<struct<id:string,number:int,text:string>>"
COURSE = "schema_version int, slug string, title string, language string, question_sets array<string>, sources array<struct<video_id:string,url:string,title:string,duration_s:double,order:int>>"
TRANSCRIPT = "schema_version int, video_id string, source string, model string, language string, segments array<struct<start:double,end:double,text:string>>"
CHUNK = "chunk_id string, source_type string, video_id string, start double, end double, text string"
EXTRACT = "schema_version int, question_id string, candidates int, relevant array<struct<chunk_id:string,relevance:double,points:array<string>,quote:string>>, readings array<struct<text:string,chunk_id:string>>, model string, prompt_version string, input_hash string"
ANSWER = "schema_version int, question_id string, question_set string, question string, answer_md string, outside_lectures_md string, citations array<struct<n:int,chunk_id:string,video_id:string,start:double,quote:string>>, readings array<struct<text:string,video_id:string,start:double>>, coverage string, model string, prompt_version string, input_hash string, generated_at timestamp, error string"


def read_objects(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """One JSON object in each file -> (rows with their path, files that could not be read)."""
    files = spark.read.text(path, wholetext=True).withColumn("path", F.input_file_name())
    rows = files.withColumn("o", F.from_json("value", schema + ", _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"}))
    bad = F.col("o._corrupt").isNotNull() | F.col("o").isNull()
    return rows.filter(~bad).select("o.*", "path").drop("_corrupt"), rows.filter(bad).select("path", F.col("value").alias("_corrupt"))


def _unless(condition: str, error: AnalysisException) -> None:
    """Anything but the named condition is an error of its own and goes on."""
    if error.getCondition() != condition:
        raise error


def read_lines_json(spark: SparkSession, path: str, schema: str = CHUNK) -> DataFrame:
    """JSON lines; blank lines are left out, and a missing file is an empty table."""
    try:
        rows = spark.read.schema(schema).json(path)
    except AnalysisException as error:
        _unless("PATH_NOT_FOUND", error)
        return spark.createDataFrame([], schema)
    return rows.dropna("all")


def write_objects(df: DataFrame, path: str, by: str = "course") -> None:
    """One JSON object a row, in folders by ``by``; only the folders that occur are replaced."""
    df.write.partitionBy(by).mode("overwrite").option("partitionOverwriteMode", "dynamic").json(path)


def write_chunks(chunks: DataFrame, path: str) -> None:
    """JSON lines by course, in the order of the recordings and chunks: within a file, and of a course's files by their names."""
    order = ["course", "order", "chunk_no"]
    chunks.repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy("course").mode("overwrite").json(path)


def save_vectors(vectors: DataFrame, path: str, force: bool = False) -> bool:
    """chunk_id, embedding as Parquet, unless they are there already. Whether something was written."""
    try:
        vectors.write.mode("overwrite" if force else "errorifexists").parquet(path)
    except AnalysisException as error:
        _unless("PATH_ALREADY_EXISTS", error)
        return False
    return True


def load_vectors(spark: SparkSession, path: str) -> DataFrame:
    """The vectors, or none if there are none yet: the dense side then adds nothing."""
    try:
        return spark.read.schema("chunk_id string, embedding array<float>").parquet(path)
    except AnalysisException as error:
        _unless("PATH_NOT_FOUND", error)
        return spark.createDataFrame([], "chunk_id string, embedding array<float>")


def listed(lines: DataFrame) -> DataFrame:
    """(value, ...) -> stripped values without blanks and # comments."""
    return lines.withColumn("value", strip(F.col("value"))).filter("value <> '' and not startswith(value, '#')")


def replacement_rules(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pos, value) -> (pos, wrong, right by position; lines without an arrow). A repeated wrong keeps its first place and
    its last value."""
    rows = listed(lines)
    parts = F.split("value", "->", 2)
    good = rows.filter(F.contains("value", F.lit("->"))).select("pos", strip(parts[0]).alias("wrong"), strip(parts[1]).alias("right"))
    rules = good.groupBy("wrong").agg(F.min("pos").alias("first"), F.max_by("right", "pos").alias("right"))
    return rules.select(F.col("first").alias("pos"), "wrong", "right"), rows.filter(~F.contains("value", F.lit("->")))


def read_question_sets(spark: SparkSession, path: str, crosswalks: bool = False) -> tuple[DataFrame, DataFrame]:
    """YAML (or JSON) files -> (path, raw object as JSON; dead letters: files that are neither). Files named crosswalk-* apart from
    the others. Needs PyYAML for YAML."""
    files = spark.read.text(path, wholetext=True).withColumn("path", F.input_file_name())
    named = F.regexp_extract("path", r"([^/]+)$", 1).startswith("crosswalk-")
    files = files.filter(named if crosswalks else ~named)

    def parse(pdf: pd.DataFrame) -> pd.DataFrame:
        import json

        try:
            from yaml import safe_load
        except ImportError:
            safe_load = None

        def refused(name: str) -> None:
            raise ValueError(f"{name} is not JSON")

        def load(text: str) -> object:
            # JSON first: as YAML, of which it is a part, it would take a hundred times the memory
            try:
                return json.loads(text, parse_constant=refused)
            except ValueError:
                if safe_load is None:
                    raise
                return safe_load(text)

        return pd.DataFrame({"path": pdf["path"], "raw": [json.dumps(load(x), ensure_ascii=False) for x in pdf["value"]]})

    kind = T.StructType([T.StructField("path", T.StringType()), T.StructField("raw", T.StringType())])
    return guarded(files, parse, kind, "path", "question-sets")


def exploded_sets(raw: DataFrame) -> DataFrame:
    """path, question_set, kind, question_id, number, text."""
    rows = raw.withColumn("s", F.from_json("raw", QUESTION_SET)).select("path", F.col("s.id").alias("question_set"), "s.kind", F.explode("s.questions").alias("q"))
    return rows.select("path", "question_set", "kind", F.col("q.id").alias("question_id"), "q.number", "q.text")


def dead_letters(bad: DataFrame, label: str, path: str) -> None:
    """Replies that could not be read, appended with their label and time."""
    bad.select(F.lit(label).alias("label"), "request_id", "raw", F.current_timestamp().alias("at")).write.mode("append").json(path)


def write_each(rows: DataFrame, root: str) -> DataFrame:
    """(path below root, value) -> path, bytes: a file for each row, written by the tasks under a name of the attempt and then
    renamed, so a reader never sees half of one. Rows must have paths of their own; the result must be read for them to be written."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = fs.FileSystem.from_uri(root)
        made: set[str] = set()
        for batch in batches:
            sizes = []
            for path, value in zip(batch.column("path").to_pylist(), batch.column("value").to_pylist()):
                folder, data = os.path.dirname(f"{base}/{path}"), value.encode()
                if folder not in made:
                    files.create_dir(folder)
                    made.add(folder)
                temporary = f"{folder}/_{uuid.uuid4().hex}"
                with files.open_output_stream(temporary, compression=None) as out:
                    out.write(data)
                files.move(temporary, f"{base}/{path}")
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(sizes, pa.int64())], ["path", "bytes"])

    return rows.select("path", "value").mapInArrow(write, "path string, bytes long")


#: The stage whose result a path below a course's folder is.
STAGE_OF = {r"^course\.json$": "ingest", r"^audio/.*\.wav$": "prepare-audio", r"^audio/": "download", r"^transcripts/.*\.json$": "transcribe", r"^chunks\.jsonl$": "index", r"^extracts/.*\.json$": "extract", r"^answers/.*\.json$": "answer"}
FOLDERS = ["", "audio", "transcripts", "extracts", "answers"]


def list_artifacts(courses: DataFrame, root: str) -> DataFrame:
    """(course) -> course, path (below its folder), stage, bytes, modified of all its files, root/course/...

    A task lists some folders; no content is read and no path goes through the driver. A folder that is missing has no files, and
    names that begin with an underscore are not finished. A file that is no stage's result has a null stage.
    """

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            for course, folder in zip(batch.column("course").to_pylist(), batch.column("folder").to_pylist()):
                top = f"{base}/{course}"
                found = files.get_file_info(fs.FileSelector(f"{top}/{folder}".rstrip("/"), allow_not_found=True, recursive=folder != ""))
                found = [x for x in found if x.type == fs.FileType.File and not x.base_name.startswith("_")]
                yield pa.RecordBatch.from_arrays([pa.array([course] * len(found), pa.string()), pa.array([x.path[len(top) + 1 :] for x in found], pa.string()), pa.array([x.size for x in found], pa.int64()), pa.array([x.mtime for x in found], pa.timestamp("us", "UTC"))], ["course", "path", "bytes", "modified"])

    folders = courses.select("course").distinct().withColumn("folder", F.explode(F.array(*map(F.lit, FOLDERS))))
    found = folders.repartition("course", "folder").mapInArrow(look, "course string, path string, bytes long, modified timestamp")
    stage = F.coalesce(*(F.when(F.col("path").rlike(pattern), name) for pattern, name in STAGE_OF.items()))
    return found.select("course", "path", stage.alias("stage"), "bytes", "modified")
