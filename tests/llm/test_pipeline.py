"""The pipeline as a whole on a small corpus, stage by stage against plain Python."""

import hashlib
import zlib

import numpy as np
import pytest

import corpus_pipeline
from lectio.llm import line_dedup, quality
from test_small import edits, groups, hits, prose

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    item = prose(500, 30)
    good = [prose(i, 40) for i in range(80)]
    bad = [prose(200 + i, 40).upper().replace(" ", "!! ") for i in range(80)]
    line, base = "this is a line that many of the documents hold", prose(300, 60)
    words = base.split()
    more = [f"{prose(400 + i, 30)}\n{line}{'.' * (i % 3)}\n{prose(420 + i, 30)}" for i in range(6)]
    more += [base, base, " ".join([*words[:50], "other", *words[51:]]), f"{prose(450, 20)} {item[20:150]} {prose(451, 20)}", line, None, "", base]
    texts = good + bad + more
    ids = [*range(160), *(1000 + i for i in range(len(more) - 4)), None, None, 7, 1006]
    return [(i, x, "en", "s", len(x or "")) for i, x in zip(ids, texts)], [("b1", item), ("b2", None)], [(i, int(i < 80), 0) for i in range(160)]


def lines_left(rows):
    """Rows in order of id (null first), then as they come: each with the lines of which no earlier one is near."""
    limits, seen, out = line_dedup.Limits(), [], []
    for row in rows:
        kept, gone = [], 0
        for line in (row[1] or "").split("\n"):
            long = len(line.encode().strip()) >= limits.min_bytes
            near = long and any(abs(len(x) - len(line)) <= 4 and edits(x, line) <= max(1, min(len(x) // 20, len(line) // 20, 4)) for x in seen)
            gone += near
            kept += [] if near else [line]
            seen += [line] if long else []
        if not gone or "\n".join(kept).strip():
            out.append((row[0], "\n".join(kept)) if gone else row)
    return out


def test_every_stage(spark, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    documents, benchmark, labels = corpus()
    for name, rows, schema in (("documents", documents, COLUMNS), ("benchmark", benchmark, "item_id string, text string"), ("labels", labels, "doc_id long, quality int, toxic int")):
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    learnt = sorted((i for i, _, _ in labels if zlib.crc32(str(i).encode()) % 3 != 1))
    network = quality.fit(spark.createDataFrame(documents, COLUMNS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert network.weights is not None and learnt

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    plain = [(i, x) for i, x, *_ in documents if network.score([(x or "").encode()])[0] >= 0.5]
    assert len({i for i, _ in plain if i is not None and i < 80}) > 70 and not any(i is not None and 80 <= i < 160 for i, _ in plain)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == [c.split()[0] for c in COLUMNS.split(", ")]
        docs.write.parquet(f"{tmp_path}/{name}.parquet")
        docs = spark.read.parquet(f"{tmp_path}/{name}.parquet")
        if name == "line dedup":
            # equal ids come in the order of a hash, which these texts do not depend on
            plain = lines_left(sorted(plain, key=lambda r: (r[0] is not None, r[0] or 0)))
        if name == "n-gram Jaccard join":
            at = sorted(plain, key=lambda r: (r[0] is None, r[0] or 0))
            label = groups([x for _, x in at])
            plain = [r for k, r in enumerate(at) if not label[k][0] or label[k][1] == k]
        if name == "benchmark decontamination":
            plain = [r for r in plain if not hits(r[1], benchmark)[1]]
        found = docs.collect()
        assert sorted((r["doc_id"] or -1, r["text"] or "") for r in found) == sorted((i or -1, x or "") for i, x in plain), name
        assert all(r["n_chars"] == len(r["text"] or "") for r in found)
    tok = tokenizers.Tokenizer.from_file(path)
    expected = []
    for i, x in plain:
        ids = tok.encode(x or "", add_special_tokens=False).ids
        expected.append((i or -1, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert whole.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted((r["doc_id"] or -1, *tuple(r)[1:]) for r in whole.collect()) == sorted(expected)
    assert len(np.unique([r[0] for r in expected])) > 80
