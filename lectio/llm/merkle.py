"""A Merkle manifest of documents: trees of eight children, one a language, their roots under one root, and proofs from a log.

The nodes of a tree are appended in the order in which they are complete (postorder), so the place of a node follows from
its level and number alone: before leaf i stand i leaves and, of each level, i divided by its width, rounded down. Builders
take aligned blocks of 512 leaves, which are whole subtrees, and write their part of the log as one row; the roots of blocks
are the leaves of the next turn. A proof reads its siblings at computed places: no tree is walked and no pointer stored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectio.llm.common import few, lowered, stored, table
from lectio.operators.ordering import numbered

ARITY, LEVELS = 8, 3
BLOCK = ARITY**LEVELS
DIGEST = 64
PATH = "array<struct<place: int, others: string>>"


def h(*parts: bytes) -> bytes:
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def height(n: int) -> int:
    """Levels above n leaves: a lone leaf is its own root."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def position(level: int, i: int, n: int) -> int:
    """Where node i of a level stands in the log of a tree of n leaves. It is complete after its last leaf and what that completes
    below it; of each level j, floor(leaf / 8**j) nodes are complete before that leaf."""
    leaf, before = min((i + 1) * ARITY**level, n) - 1, 0
    count = leaf
    while count:
        before, count = before + count, count // ARITY
    return before + level


def append(leaves: list[bytes], levels: int) -> list[bytes]:
    """The log of these leaves up to ``levels`` above them, in order of completion; the last entry is the top."""
    log, waiting = [], [[] for _ in range(levels + 1)]

    def add(node: bytes, level: int) -> None:
        log.append(node)
        waiting[level].append(node)

    for leaf in leaves:
        add(leaf, 0)
        for level in range(levels):
            if len(waiting[level]) < ARITY:
                break
            add(h(*waiting[level]), level + 1)
            waiting[level] = []
    for level in range(levels):
        if waiting[level]:
            add(h(*waiting[level]), level + 1)
            waiting[level] = []
    return log


def siblings(nodes: bytes, i: int, n: int, levels: int) -> Iterator[tuple[int, bytes]]:
    """(place in its run, the run's other digests) of leaf i and of the nodes above it, read from a log of n leaves."""
    for level in range(levels):
        first, there = i - i % ARITY, -(-n // ARITY**level)
        places = (position(level, j, n) * DIGEST for j in range(first, min(first + ARITY, there)) if j != i)
        yield i % ARITY, b"".join(nodes[p : p + DIGEST] for p in places)
        i //= ARITY


def fold(digest: bytes, path: list[tuple[int, bytes]]) -> bytes:
    for place, others in path:
        cut = place * DIGEST
        digest = h(others[:cut], digest, others[cut:])
    return digest


def leaf(*values: Column) -> Column:
    """H of values, each ``-`` if null, else its UTF-8 byte count, ``:``, its value (integers decimal)."""
    said = [x.cast("string") for x in values]
    return F.sha2(F.concat(*(F.when(x.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(x), F.lit(":"), x)) for x in said)).cast("binary"), 256)


@dataclass(frozen=True)
class Log:
    """The appended segments of some trees. segments: tree, turn (0 for leaves, 1 for the roots of their blocks ...), block,
    n (nodes of the turn in the tree), nodes (digests in order of completion), top. roots: tree, n (leaves), root."""

    segments: DataFrame
    roots: DataFrame
    turns: int


def build(leaves: DataFrame) -> Log:
    """leaves (tree long, number long from 0 without gaps, n long: leaves of the tree, digest string) -> the log.

    Each turn takes groups of at most 512 nodes, so neither a large tree nor a small one is a task of its own, and there are as
    many turns as the largest tree has digits to the base 512. No leaves: no segments.
    """
    sizes = leaves.groupBy("tree").agg(F.max("n").alias("leaves"))
    most = sizes.agg(F.max("leaves")).first()[0] or 0
    turns = max(1, -(-height(most) // LEVELS))
    schema = "tree long, turn int, block long, n long, nodes binary, top string"

    def builder(turn: int):
        def run(group: pa.Table) -> pa.Table:
            group = group.sort_by("number")
            n = group["n"][0].as_py()
            log = append([x.encode() for x in group["digest"].to_pylist()], min(LEVELS, height(n)))
            out = {"tree": [group["tree"][0].as_py()], "turn": [turn], "block": [group["number"][0].as_py() // BLOCK], "n": [n], "nodes": [b"".join(log)], "top": [log[-1].decode()]}
            return pa.table(out, pa.schema([("tree", pa.int64()), ("turn", pa.int32()), ("block", pa.int64()), ("n", pa.int64()), ("nodes", pa.binary()), ("top", pa.string())]))

        return run

    nodes, done = leaves.select("tree", "number", "n", "digest"), None
    for turn in range(turns):
        built = stored(nodes.groupBy("tree", F.floor(F.col("number") / BLOCK).alias("block")).applyInArrow(builder(turn), schema), "segments")
        done = built if done is None else done.unionByName(built)
        above = F.ceil(F.col("n") / BLOCK)
        nodes = built.filter(above > 1).select("tree", F.col("block").alias("number"), above.alias("n"), F.col("top").alias("digest"))
    tops = done.filter(F.col("n") <= BLOCK).select("tree", F.col("top").alias("root"))
    return Log(done, tops.join(sizes, "tree").select("tree", F.col("leaves").alias("n"), "root"), turns)


def positions(log: Log) -> DataFrame:
    """tree, position (in the whole tree's log), level, number, digest of every node, from the segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                turn, first, n, size = row["turn"], row["block"] * BLOCK, row["n"], row["leaves"]
                here = min(BLOCK, n - first)
                for level in range(min(LEVELS, height(n)) + 1):
                    if turn and not level:
                        continue  # they are the last nodes of the turn before
                    numbers = range(-(-here // ARITY**level))
                    at = [first // ARITY**level + j for j in numbers]
                    nodes = (position(level, j, here) * DIGEST for j in numbers)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([row["tree"]] * len(at), pa.int64()), pa.array([position(turn * LEVELS + level, i, size) for i in at], pa.int64()), pa.array([turn * LEVELS + level] * len(at), pa.int32()),
                        pa.array(at, pa.int64()), pa.array([row["nodes"][p : p + DIGEST].decode() for p in nodes], pa.string()),
                    ], ["tree", "position", "level", "number", "digest"])

    sized = log.segments.join(log.roots.select("tree", F.col("n").alias("leaves")), "tree")
    return sized.mapInArrow(run, "tree long, position long, level int, number long, digest string")


def _handed(segments: DataFrame) -> DataFrame:
    """Segments with the path from their top -> tree, block, path of each of their leaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                first, n = row["block"] * BLOCK, row["n"]
                here = min(BLOCK, n - first)
                found = [[*({"place": p, "others": o.decode()} for p, o in siblings(row["nodes"], i, here, min(LEVELS, height(n)))), *(row["path"] or [])] for i in range(here)]
                kind = pa.list_(pa.struct([("place", pa.int32()), ("others", pa.string())]))
                yield pa.RecordBatch.from_arrays([pa.array([row["tree"]] * here, pa.int64()), pa.array(range(first, first + here), pa.int64()), pa.array(found, kind)], ["tree", "block", "path"])

    return segments.select("tree", "block", "n", "nodes", "path").mapInArrow(run, f"tree long, block long, path {PATH}")


def paths(log: Log, above: DataFrame | None = None) -> DataFrame:
    """tree, block, path: the siblings from the top of each block of leaves up to the end of ``above`` (tree, path), or to the
    tree's root. The blocks of a turn are the leaves of the next one, so paths are handed down from the last turn."""
    known = log.roots.select("tree", F.lit(0).cast("long").alias("block"))
    known = known.withColumn("path", F.lit(None).cast(PATH)) if above is None else known.join(above.select("tree", "path"), "tree", "left")
    for turn in range(log.turns - 1, 0, -1):
        # a tree that ends at this turn has one block here; one that ends below it waits
        here = log.segments.filter(F.col("turn") == turn)
        handed = _handed(here.join(known, ["tree", "block"]))
        known = known.join(here.select("tree").distinct(), "tree", "left_anti").unionByName(handed)
    return known


def checked(log: Log, claims: DataFrame, above: DataFrame | None = None) -> DataFrame:
    """claims (tree, number, claimed: a digest, others) -> all their columns, proof_sha256 (H of all siblings up to the root) and
    folded_root. above (tree, path): what stands over each tree's root. Claims meet their block's segment, 512 numbers at a
    time; those about a leaf that does not exist have nulls."""
    blocks = log.segments.filter("turn = 0").join(paths(log, above), ["tree", "block"]).select("tree", "block", "n", "nodes", "path")
    claims = claims.withColumn("block", F.floor(F.col("number") / BLOCK))
    kinds = T.StructType([*(x for x in claims.schema.fields if x.name != "block"), T.StructField("proof_sha256", T.StringType()), T.StructField("folded_root", T.StringType())])

    def run(asked: pa.Table, segment: pa.Table) -> pa.Table:
        asked, proofs, roots = asked.drop_columns(["block"]), [None] * asked.num_rows, [None] * asked.num_rows
        for row in segment.to_pylist():
            first, n = row["block"] * BLOCK, row["n"]
            here = min(BLOCK, n - first)
            over = [(x["place"], x["others"].encode()) for x in row["path"] or []]
            for k, (i, digest) in enumerate(zip(asked["number"].to_pylist(), asked["claimed"].to_pylist())):
                if first <= i < first + here:
                    path = [*siblings(row["nodes"], i - first, here, min(LEVELS, height(n))), *over]
                    proofs[k], roots[k] = h(*(others for _, others in path)).decode(), fold(digest.encode(), path).decode()
        return asked.append_column("proof_sha256", pa.array(proofs, pa.string())).append_column("folded_root", pa.array(roots, pa.string()))

    return claims.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInArrow(run, kinds)


@dataclass(frozen=True)
class Manifest:
    """leaves: the rows with tree and number. log: of the languages' trees; top: of the tree over their roots. subroots: tree,
    subroot, root, path (from the subroot up to the root)."""

    leaves: DataFrame
    log: Log
    top: Log
    subroots: DataFrame


def manifest(rows: DataFrame) -> Manifest:
    """rows (lang, doc_id, leaf, others) -> their manifest.

    Leaves of a language go by doc_id, null first, then by digest; languages by their bytes, null first. Equal rows are leaves of
    their own. An empty table has no trees and no root. Names of other columns must not be tree, number, n or block.
    """
    rows = numbered(rows, ["lang", "doc_id", "leaf"], "number", ["lang"])
    langs = stored(rows.groupBy("lang").agg(F.max("number").alias("last")), "languages")
    langs = numbered(langs, ["lang"], "tree").select(F.col("lang").alias("_lang"), "tree", (F.col("last") + 1).alias("n"))
    langs = stored(langs, "trees")
    rows = stored(rows.join(few(langs), F.col("lang").eqNullSafe(F.col("_lang"))).drop("_lang"), "leaves")
    log = build(rows.select("tree", "number", "n", F.col("leaf").alias("digest")))
    subroots = stored(log.roots.select("tree", F.col("root").alias("subroot")), "subroots")
    top = build(subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("number"), F.lit(subroots.count()).cast("long").alias("n"), F.col("subroot").alias("digest")))
    above = _handed(top.segments.filter("turn = 0").join(paths(top), ["tree", "block"])).select(F.col("block").alias("tree"), "path")
    root = top.roots.select("root").first()
    subroots = subroots.join(above, "tree").select("tree", "subroot", F.lit(root["root"] if root else None).cast("string").alias("root"), "path")
    return Manifest(rows, log, top, stored(subroots, "subroots"))


def document_leaf(text: Column) -> Column:
    return leaf(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> doc_id, leaf, subroot, root, proof_sha256, folded_root, verified; a third of the texts is tampered with
    before it is checked against the manifest of the untampered ones. Rows without a doc_id are not tampered with."""
    docs = table(spark, sf_dir, "documents")
    own, changed = document_leaf(F.col("text")), document_leaf(lowered(F.col("text")))
    # the names of the corpus go no further than this; only digests are sorted
    rows = docs.select("lang", "doc_id", own.alias("leaf"), F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, changed).otherwise(own).alias("claimed"))
    made = manifest(stored(rows, "digests"))
    found = checked(made.log, made.leaves.select("tree", "number", "doc_id", "leaf", "claimed"), made.subroots)
    return found.join(few(made.subroots.drop("path")), "tree").select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


_H = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR) END"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TREE = """{0} AS ({1}
UNION ALL SELECT tree, level + 1, i // 8, (any_value(n) + 7) // 8, sha256(string_agg(digest, '' ORDER BY i)) FROM {0} WHERE n > 1 GROUP BY tree, level, i // 8)"""
_BESIDE = """{0} AS (SELECT a.tree, a.level, a.i, coalesce(string_agg(b.digest, '' ORDER BY b.i) FILTER (WHERE b.i < a.i), '') AS lhs, coalesce(string_agg(b.digest, '' ORDER BY b.i) FILTER (WHERE b.i > a.i), '') AS rhs
  FROM {1} a LEFT JOIN {1} b ON b.tree = a.tree AND b.level = a.level AND b.i // 8 = a.i // 8 AND b.i <> a.i WHERE a.n > 1 GROUP BY a.tree, a.level, a.i)"""
_FOLD = """{0} AS ({1}
UNION ALL SELECT f.id, f.own, f.tree, f.level + 1, f.i // 8, f.proof || s.lhs || s.rhs, sha256(s.lhs || f.folded || s.rhs) FROM {0} f JOIN {2} s ON s.tree = f.tree AND s.level = f.level AND s.i = f.i)"""
OP12_SQL = ", ".join(
    [
        "WITH RECURSIVE t AS (SELECT list(v ORDER BY b) AS crc FROM (SELECT b, list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(b)))",
        f"""h AS (SELECT doc_id, lang, sha256(concat({", ".join(_H.format(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))})) AS leaf,
  sha256(concat({", ".join(_H.format(c) for c in ("doc_id", "source", "lang", "n_chars", f"translate(text, '{_UPPER}', '{_LOWER}')"))})) AS lower_leaf,
  xor(list_reduce([4294967295] || [ascii(x) FOR x IN string_split(CAST(doc_id AS VARCHAR), '')], lambda c, x: xor(c >> 8, crc[CAST((xor(c, x) & 255) + 1 AS BIGINT)])), 4294967295) AS crc FROM documents, t)""",
        """k AS (SELECT doc_id, leaf, CASE WHEN crc % 3 = 0 THEN lower_leaf ELSE leaf END AS claimed, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n, row_number() OVER () AS id FROM h)""",
        _TREE.format("up", "SELECT tree, 0 AS level, i, n, leaf AS digest FROM k"),
        "r AS (SELECT tree, digest AS subroot FROM up WHERE n = 1)",
        _TREE.format("top", "SELECT CAST(-1 AS BIGINT) AS tree, 0 AS level, tree AS i, (SELECT count(*) FROM r) AS n, subroot AS digest FROM r"),
        _BESIDE.format("s", "up"),
        _BESIDE.format("ts", "top"),
        _FOLD.format("f", "SELECT id, tree AS own, tree, 0 AS level, i, '' AS proof, claimed AS folded FROM k", "s"),
        _FOLD.format("g", "SELECT f.id AS id, f.own AS own, CAST(-1 AS BIGINT) AS tree, 0 AS level, f.own AS i, f.proof AS proof, f.folded AS folded FROM f JOIN up ON up.tree = f.tree AND up.level = f.level AND up.i = f.i WHERE up.n = 1", "ts"),
    ]
) + """ SELECT doc_id, leaf, subroot, e.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = e.digest AS verified
FROM g JOIN top e ON e.level = g.level AND e.i = g.i AND e.n = 1 JOIN k ON k.id = g.id JOIN r ON r.tree = k.tree"""
