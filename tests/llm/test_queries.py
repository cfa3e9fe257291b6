"""The registered queries themselves, on small tables in a folder, column by column against plain code."""

import hashlib
import zlib
from base64 import b32encode

import numpy as np
import pytest
from test_archives import plain_h, plain_sample, plain_tree
from test_small import edits, kept_bytes, prose

from lectio.llm import importance, registry

sha = lambda x: hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()
SHARED = prose(90, 60)
TEXTS = [prose(i, 30 + i) + ("\n" + prose(100 + i, 12)) for i in range(12)] + [f"{prose(40, 20)} {SHARED} {prose(41, 20)}", f"{prose(42, 9)}\n{SHARED}", None, "", "a b", prose(3, 33) + "\n" + prose(103, 12).replace("a", "b", 1), "Été İ " * 30, "Capital Letters", "More Capital Letters"]
DOCS = [(i * 8 % 23, x, "abc"[i % 3] if i % 5 else None, f"s{i % 2}", None if x is None else len(x)) for i, x in enumerate(TEXTS)]
PAGES = [(4, "http://a.com/x", "<p>é</p>"), (2, "http://b.com/", "<p>é</p>"), (9, None, None), (5, "https://c.net/fr/", "")]


@pytest.fixture(scope="module")
def rows_of(spark, tmp_path_factory):
    pytest.importorskip("public_tokenizers")
    folder = str(tmp_path_factory.mktemp("tables"))
    tables = {
        "documents": spark.createDataFrame(DOCS, "doc_id long, text string, lang string, source string, n_chars long"), "pages": spark.createDataFrame(PAGES, "page_id long, url string, html string"),
        "benchmark": spark.createDataFrame([(1, " ".join(prose(2, 32).split()[:15])), (2, None)], "item_id long, text string"), "labels": spark.createDataFrame([(d[0], int(d[0] % 2), 0) for d in DOCS], "doc_id long, quality int, toxic int"),
    }
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return lambda name: registry.QUERIES[name](spark, folder).collect()


def test_op3_and_op4(rows_of):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {d[0]: tok.encode(d[1] or "", add_special_tokens=False).ids for d in DOCS}
    at, expected = 0, []
    for k in sorted(ids):
        expected.append((k, at, len(ids[k]) + 1, zlib.crc32(np.array([*ids[k], 1], "<u4").tobytes())))
        at += len(ids[k]) + 1
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows_of("op3_token_store")) == expected
    found = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows_of("op4_bpe")}
    assert found == {k: (len(x), sha(" ".join(map(str, x))), sha(tok.decode(x, skip_special_tokens=False))) for k, x in ids.items()}


def test_op7(rows_of):
    kept = dict(zip((d[0] for d in DOCS), kept_bytes(TEXTS)))
    found = rows_of("op7_suffix_dedup")
    assert {r["doc_id"]: r["kept_sha256"] for r in found} == {k: sha(x) for k, x in kept.items()}
    for r in found:
        size = len((dict((d[0], d[1]) for d in DOCS)[r["doc_id"]] or "").encode())
        assert (r["n_bytes"], r["n_removed"]) == (size, size - len(kept[r["doc_id"]])) and (r["n_spans"] > 0) == (r["n_removed"] > 0)
    assert sum(r["n_spans"] for r in found) >= 2


def test_op8(rows_of):
    for r in (found := rows_of("op8_quality_classifier")):
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    assert sorted(r["doc_id"] for r in found) == sorted(d[0] for d in DOCS)


def test_op10(rows_of):
    said = {d[0]: (d[1] or "").split("\n") for d in DOCS}
    seen, kept = [], {}
    for k in sorted(said):
        kept[k] = []
        for line in said[k]:
            near = len(line.encode().strip()) >= 20 and any(edits(line, x) <= min(4, max(1, min(len(line), len(x)) // 20)) for x in seen)
            if len(line.encode().strip()) >= 20:
                seen.append(line)
            if not near:
                kept[k].append(line)
    found = {r["doc_id"]: (r["n_removed"], r["kept_sha256"]) for r in rows_of("op10_line_dedup")}
    assert found == {k: (len(said[k]) - len(x), sha("\n".join(x))) for k, x in kept.items()} and any(n for n, _ in found.values())


def test_op11(rows_of):
    code = lambda x: b32encode(hashlib.sha1(x).digest()).decode()
    one, none = "<p>é</p>".encode(), b""
    assert sorted(tuple(r) for r in rows_of("op11_warc")) == [(2, 9, code(one), "response", None), (4, 9, code(one), "revisit", 2), (5, 0, code(none), "response", None), (9, 0, code(none), "revisit", 5)]


def test_op12(rows_of):
    lower = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x)
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda d, text: plain_h(*map(part, (d[0], d[3], d[2], d[4], text)))
    langs = {x: sorted((d for d in DOCS if d[2] == x), key=lambda d: d[0]) for x in (None, "a", "b", "c")}
    subroots = {x: plain_tree([leaf(d, d[1]) for d in ds])[-1][0] for x, ds in langs.items()}
    root = plain_tree(list(subroots.values()))[-1][0]
    found = {r["doc_id"]: r for r in rows_of("op12_merkle_manifest")}
    assert len(found) == len(DOCS)
    for d in DOCS:
        r = found[d[0]]
        tampered = d[1] is not None and zlib.crc32(str(d[0]).encode()) % 3 == 0 and lower(d[1]) != d[1]
        assert (r["leaf"], r["subroot"], r["root"], r["verified"]) == (leaf(d, d[1]), subroots[d[2]], root, not tampered) and (r["folded_root"] == root) == r["verified"]


def test_op13(rows_of):
    found = sorted(((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in rows_of("op13_importance")), key=repr)
    assert found == plain_sample([(d[0], d[1]) for d in DOCS], [" ".join(prose(2, 32).split()[:15]), None], importance.Draw())
