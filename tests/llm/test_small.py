"""The numbered operators on small tables with nulls, empty and odd texts, ties, repeated rows and clashing columns."""

import hashlib
import os
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from lectio.llm import bpe, chat, common, components, decontaminate, jaccard, line_dedup, quality, suffix_dedup, syncmers, token_store, url_reputation
from lectio.llm.pieces import PieceCache

DOCS = "doc_id long, text string, node long, score string"


def docs(spark, *texts, ids=None):
    """Columns beyond doc_id and text have names that operators use themselves."""
    return spark.createDataFrame([(i if ids is None else ids[i], x, 7, "s") for i, x in enumerate(texts)], DOCS)


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def vocabulary():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


ODD = ["Ǆ ΣΑΣ İstanbul <|endoftext|>x aaaaaaaa a\x1cb don't é́ … x\x01 y １２ ﬁ 日本語 \x00", None, "", "  ", "''''s !!!! 1234", "a" * 3000]


def test_bpe_is_the_library(spark, vocabulary):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(vocabulary)
    found = {r["doc_id"]: r for r in bpe.encode_decode(docs(spark, *ODD), vocabulary).collect()}
    for i, x in enumerate(ODD):
        ids = tok.encode(x or "", add_special_tokens=False).ids
        assert list(found[i]["ids"]) == ids and found[i]["decoded"] == tok.decode(ids, skip_special_tokens=False)
    assert bpe.encode_decode(docs(spark, "a").limit(0), vocabulary).count() == 0


def test_no_merge_makes_an_earlier_one_possible(vocabulary):
    """Then all positions of a pair may be merged at once: a pair's parts are always made before it."""
    model = bpe.BPE(vocabulary)
    made = {}
    for rank, token in enumerate(model.made.tolist()):
        made.setdefault(token, rank)
    late = [r for r, (a, b) in enumerate(zip(model.left.tolist(), model.right.tolist())) if max(made.get(a, -1), made.get(b, -1)) > r]
    assert not late


def test_vocabularies_of_another_kind_are_refused(vocabulary, tmp_path):
    import json

    import public_tokenizers

    with pytest.raises(ValueError, match="model, normalizer, pre_tokenizer, decoder"):
        bpe.BPE(public_tokenizers.path("byte_bpe_50k.json"))
    spec = json.load(open(vocabulary, encoding="utf-8"))
    assert bpe.unknown_parts(spec) == []
    changes = {"model": lambda s: s["model"].update(ignore_merges=True), "normalizer": lambda s: s["normalizer"]["normalizers"].pop(), "pre_tokenizer": lambda s: s["pre_tokenizer"]["pretokenizers"][1].update(use_regex=True), "added_tokens": lambda s: s["added_tokens"][0].update(lstrip=True)}
    for part, change in changes.items():
        other = json.loads(json.dumps({k: v for k, v in spec.items() if k != "model"} | {"model": {k: v for k, v in spec["model"].items() if k not in ("vocab", "merges")}}))
        change(other)
        assert bpe.unknown_parts(other) == [part]


def test_piece_cache_keeps_its_bound():
    cache = PieceCache(lambda xs: [x.encode() for x in xs], most=3)
    assert cache.encode(["a b", "c d e"]) == [b"ab", b"cde"] and cache.encode(["x y z w"]) == [b"xyzw"] and cache.encode(["a"]) == [b"a"]


@pytest.mark.parametrize("values", [[0], [0, 0, 0], [1, 5, 5, 9, 1000, 10**6], list(range(0, 40000, 3))])
def test_elias_fano(values):
    coded = token_store.EliasFano.from_bytes(token_store.EliasFano.build(np.array(values)).to_bytes())
    assert coded.values().tolist() == values and [coded.select(i) for i in range(0, len(values), max(1, len(values) // 50))] == values[:: max(1, len(values) // 50)]


def test_token_blocks_round_trip(spark, vocabulary):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(vocabulary)
    ids = [5, None, -3, 5, 2**40, 1]
    blocks = token_store.write_blocks(docs(spark, *ODD, ids=ids), vocabulary, 1, drops_white_space=True, block_ids=10)
    found = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in token_store.summary(blocks).collect())
    at, expected = 0, []
    for i, x in sorted(zip(ids, ODD), key=lambda p: (p[0] is not None, p[0] or 0, p[1] is not None, (p[1] or "").encode())):
        coded = [*tok.encode(x or "", add_special_tokens=False).ids, 1]
        expected.append((at, i, len(coded), zlib.crc32(np.array(coded, "<u4").tobytes())))
        at += len(coded)
    assert found == expected


def xx(*values):
    """The hash of a row of strings and 64-bit numbers, each seeded by the one before."""
    seed = 42
    for v in values:
        seed = xxhash.xxh64(v.encode() if isinstance(v, str) else (v & (1 << 64) - 1).to_bytes(8, "little"), seed=seed).intdigest()
    return seed - (1 << 64) if seed >> 63 else seed


def plain_sketch(text):
    """The 64 least distinct anchors, each a window of 5 words whose least pair hash is its first or its last one."""
    words = (text or "").lower().split()
    if len(words) < 5:
        return [xx(" ".join(words)) & 0xFFFFFFFF] if words else []
    hashes = [xx(w) for w in words]
    pairs = [xx(a, b) for a, b in zip(hashes, hashes[1:])]
    inner = [pairs[i : i + 4] for i in range(len(words) - 4)]
    return sorted({xx(p[0], p[1], p[3]) & 0xFFFFFFFF for p in inner if min(p) in (p[0], p[3])})[:64]


def plain_likeness(a, b):
    union = sorted(set(a) | set(b))[:64]
    return len(set(union) & set(a) & set(b)) / len(union) if union else 1.0


def test_fingerprints(spark, tmp_path):
    texts = [prose(1, 80), None, "", "ab", prose(2, 50), prose(1, 80), "one two", prose(1, 70) + " " + prose(3, 200), prose(4, 400), "a b c d e", "a a a a a a a"]
    docs(spark, *texts).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r for r in syncmers.op1_syncmer_fingerprints(spark, str(tmp_path)).collect()}
    order = sorted(range(len(texts)), reverse=True)
    show = lambda sketch: "".join(f"{x:08x}" for x in sketch)
    for k, i in enumerate(order):
        own, other = texts[i] or "", texts[order[(k + 1) % len(order)]] or ""
        cut = len(own) // 3
        edited = own[: len(own) - cut] + other[:cut]
        r, sketch = found[i], plain_sketch(own)
        assert (r["n_chars"], r["edited_sha256"]) == (len(own), hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (show(sketch), show(plain_sketch(edited)))
        assert r["near_edited"] == pytest.approx(plain_likeness(sketch, plain_sketch(edited))) and r["near_next"] == pytest.approx(plain_likeness(sketch, plain_sketch(other)))
    assert found[0]["fingerprint"] == found[5]["fingerprint"] != found[4]["fingerprint"]
    assert syncmers.fingerprints(docs(spark, "a").limit(0)).count() == 0


def test_documents_without_ids_are_each_others_next(spark):
    texts = [f"t{i}" for i in range(60)]
    ids = [None if i % 2 else i // 8 for i in range(60)]
    rows = syncmers.with_next(docs(spark, *texts, ids=ids).select("doc_id", "text"), ["text"]).collect()
    order = sorted(zip(ids, texts), key=lambda p: (p[0] is not None, p[0] or 0, xx(p[1])), reverse=True)
    assert {r["text"]: r["next_text"] for r in rows} == {a[1]: b[1] for a, b in zip(order, order[1:] + order[:1])} and len(rows) == 60


def test_passages_match_at_their_shift(spark):
    a, b = prose(3, 60), prose(4, 40)
    left, right = docs(spark, a, ids=[1]), docs(spark, f"{b} {a}", ids=[2])
    (best,) = syncmers.anchor_matches(left, right).orderBy(F.desc("n")).limit(1).collect()
    assert (best["left_id"], best["right_id"], best["shift"]) == (1, 2, 40) and best["n"] > 10


def test_anchors_of_an_edited_text_stay_in_place(spark):
    """Against plain loops: what stands before the first word that differs agrees; the query has the same columns."""
    words = prose(6, 90).split()
    rows = [(" ".join(words), " ".join(words[:50] + ["other"] + words[51:])), (" ".join(words), " ".join(words)), (" ".join(words), " ".join(words[1:])), ("", "a b"), ("a b", "a b"), ("a b", "")]
    df = spark.createDataFrame(rows, "a string, b string")
    df = syncmers.with_anchors(syncmers.with_anchors(df, "a", "x"), "b", "y")
    together, moved = syncmers.in_place("x", "y")
    for r in df.select("x", "y", together.alias("n"), moved.alias("first")).collect():
        x, y = list(r["x"]), list(r["y"])
        assert r["n"] == sum(p is not None and p == q for p, q in zip(x, y))
        assert r["first"] == next((i for i, p in enumerate(x) if p is not None and (i >= len(y) or y[i] != p)), None)
    first = df.select(moved.alias("first")).collect()
    assert 50 - syncmers.K < first[0]["first"] <= 60 and first[1]["first"] is None and first[2]["first"] < 10


def test_urls(spark):
    pages = spark.createDataFrame([(1, "HTTP://Www.Example.com/en/x?q"), (2, "https://a.example.com/en/"), (3, "http://b.com"), (4, "http://b.com/"), (5, "x.net/fr/"), (6, None), (7, "ftp://x.net/fr/1#a"), (8, "http://notexample.com/en/"), (9, "http://bad.org/1"), (None, "http://good.org/")], "page_id long, url string")
    labels = spark.createDataFrame([(9, 0)] + [(4, 1), (4, 0), (8, 1), (None, 1)], "doc_id long, quality int")
    found = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_reputation.judge_urls(pages, labels).collect()}
    assert found[1] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert found[2] == ("a.example.com", "/en/", "example.com/en/", "block")
    assert found[3][:3] == ("b.com", "", None) and found[4][2:] == ("com/", "allow")
    assert found[5][:3] == ("", "", None) and found[6][:3] == ("", "", None) and found[7][2:] == ("net/fr/", "block") and found[8][2] == "com/"
    assert len(found) == 10


def test_hosts_are_shrunk_to_their_parents(spark):
    hosts = spark.createDataFrame([("a.bad.org", 50, 0), ("b.bad.org", 0, 0), ("c.fine.org", 50, 50), ("d.fine.org", 1, 0)], "host string, n long, good long")
    mean = {r["host"]: r["mean"] for r in url_reputation.reputation(hosts).collect()}
    assert mean["a.bad.org"] < mean["b.bad.org"] < mean["d.fine.org"] < mean["c.fine.org"] and mean["d.fine.org"] > 0.4


def test_registered_domains_by_a_list_of_suffixes(spark):
    hosts = spark.createDataFrame([("a.b.co.uk",), ("b.co.uk",), ("co.uk",), ("x.y.org",), ("org",), ("",)], "host string")
    listed = spark.createDataFrame([("co.uk",), ("uk",), ("org",)], "suffix string")
    found = {r["host"]: (r["domain"], r["suffix"]) for r in url_reputation.with_parents(hosts, listed).collect()}
    assert found == {"a.b.co.uk": ("b.co.uk", "co.uk"), "b.co.uk": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "x.y.org": ("y.org", "org"), "org": ("org", "org"), "": ("", "")}
    plain = {r["host"]: (r["domain"], r["suffix"]) for r in url_reputation.with_parents(hosts).collect()}
    assert plain["a.b.co.uk"] == ("co.uk", "uk") and plain["x.y.org"] == ("y.org", "org") and plain[""] == ("", "")


def test_chats(spark):
    events = [(1, 0, "message", "user", "hi <|end|> \\l", None), (1, 1, "message", "assistant", "", None), (1, 2, "delta", None, "He", None), (1, 3, "delta", None, "llo", None), (1, 4, "message", "user", None, None), (1, 5, "edit", None, "hi!", 0), (1, 6, "regenerate", None, "", 1), (1, 7, "delta", None, "Again", 1), (None, 0, None, None, "x", None)]
    found = {r["conv_id"]: r for r in chat.format_chats(spark.createDataFrame(events, "conv_id int, seq int, kind string, role string, text string, target int")).select("*", chat.read_back(F.col("formatted")).alias("back")).collect()}
    assert [(t["role"], t["text"], t["learn"]) for t in found[1]["back"]] == [("user", "hi!", False), ("assistant", "Again", True), ("user", "", False)]
    s = found[1]["loss_spans"][0]
    assert found[1]["formatted"][s["start"] : s["start"] + s["length"]] == "Again" and found[None]["n_turns"] == 1


@pytest.mark.parametrize("text", ["</s>[INST] ok [/INST]", "<|turn|>user<|text|>x<|end|>", "\\l\\b\\\\<<", "", "é\n<"])
def test_texts_survive_the_template(spark, text):
    rows = spark.createDataFrame([(1, 0, r, text) for r in ("user", "assistant", "<|learn|>")], "conv_id int, turn int, role string, text string")
    (r,) = chat.format_chats(chat.as_events(rows)).select(chat.read_back(F.col("formatted")).alias("back")).collect()
    assert sorted((t["role"], t["text"]) for t in r["back"]) == sorted((x, text) for x in ("user", "assistant", "<|learn|>"))


def hits(doc, items):
    import re

    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    low = lambda x: word.findall((x or "").translate({c: c + 32 for c in range(65, 91)}))
    w, hit, names = low(doc), set(), set()
    for name, text in items:
        x = low(text)
        for i in range(len(x) - 9) if len(x) >= 10 else [0][: len(x)]:
            want = x[i : i + 10]
            for s in range(len(w) - len(want) + 1):
                if w[s : s + len(want)] == want:
                    hit |= set(range(s, s + len(want)))
                    names.add("" if name is None else str(name))
    return len(w), len(hit), sorted(names)


def test_decontamination(spark):
    item = prose(5, 30)
    parts = item.split()
    items = [(1, item), (2, "Short Item here"), (3, None), (None, " ".join(parts[3:14])), (4, "É été " * 8), (5, "a a a a a a a a a a a")]
    texts = [f"x {item.upper()} y", " ".join(parts[5:15]), " ".join(parts[5:14]), "say: SHORT, item-here!", None, "", "É été " * 7, "é été " * 7, "a " * 13, "b " + "a " * 9, " ".join(parts[:12] + ["z"] + parts[12:])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {r["doc_id"]: (r["n_words"], r["n"], sorted({h["item_id"] for h in r["hits"]})) for r in decontaminate.contamination(docs(spark, *texts), bench).withColumn("n", F.size(decontaminate.hit_words("hits"))).collect()}
    assert found == {i: hits(x, items) for i, x in enumerate(texts)}
    assert decontaminate.contamination(docs(spark, "a b"), bench.limit(0)).first()["hits"] == []
    assert decontaminate.contamination(docs(spark, "a b").limit(0), bench).count() == 0
    ids = [None, 4, None, 4, None, None, 4, None, 4, None, None]
    again = decontaminate.with_hits(docs(spark, *texts, ids=ids).withColumn("hits", F.lit(1)).withColumn("words", F.col("text")), bench)
    assert {r["row"]["text"]: (r["n_words"], sorted({h["item_id"] for h in r["hits"]})) for r in again.collect() if r["row"]["text"]} == {x: (n, names) for x in texts if x for n, _, names in [hits(x, items)]}


def groups(texts):
    sets = []
    for x in texts:
        w = (x or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set())
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = label[i], label[j]
                label = [min(a, b) if k in (a, b) else k for k in label]
    return {i: (len(s), label[i]) for i, s in enumerate(sets)}


def test_similar_groups(spark):
    rng = np.random.default_rng(9)
    base = prose(6, 120).split()
    texts = [" ".join(base), None, "", "a b", "A  b", "a b c d e", prose(7, 60)]
    for _ in range(25):  # a star: alike to the base more than to each other
        w = list(base)
        for k in rng.integers(0, 120, 3):
            w[k] = f"w{rng.integers(10**6)}"
        texts.append(" ".join(w))
    texts += [" ".join(base), " ".join(base[:60] + prose(8, 60).split())]
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similar_groups(docs(spark, *texts)).collect()}
    assert found == groups(texts)


def test_rows_without_an_id_link_documents(spark):
    base = prose(31, 100).split()
    near = lambda *places: " ".join(w if k not in places else f"x{k}" for k, w in enumerate(base))
    # the row without an id is alike to both others, which are not alike to each other
    texts, ids = [near(5, 20), near(), near(70, 90), near(), prose(32, 50), None, None, " "], [1, None, 2, None, None, None, 9, 9]
    assert groups([texts[0], texts[2]])[1][1] == 1 and groups([texts[0], texts[1]])[1][1] == groups([texts[1], texts[2]])[1][1] == 0
    found = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["n_shingles"]), r["component_id"]) for r in jaccard.similar_groups(docs(spark, *texts, ids=ids)).collect())
    assert [c for _, c in found if c is not None] == [1, 1, 9, 9, 1, 1] and len(found) == 8
    left = sorted((r["text"] or "", r["doc_id"] or 0) for r in jaccard.one_of_each(docs(spark, *texts, ids=ids)).collect())
    assert left == sorted([(texts[0], 1), (prose(32, 50), 0), ("", 0), ("", 9), (" ", 9)])


def test_one_of_repeated_rows_stays(spark):
    a = prose(33, 30)
    same = docs(spark, a, a, a, a + " end", "", "", ids=[3, 3, None, 3, 3, 3])
    assert sorted(r["text"] for r in jaccard.one_of_each(same).collect()) in (["", "", a], ["", "", a + " end"])
    assert jaccard.one_of_each(same).columns == same.columns


def test_sizes_that_may_be_alike_are_in_neighbouring_bands():
    for n in [*range(1, 3000), 10**5, 10**6 + 7]:
        most = 100 * n // jaccard.PERCENT
        low, high = (int(np.searchsorted(jaccard.EDGES, x, "right")) for x in (n, most))
        assert high - low <= 1
    sizes = np.arange(1, 500)
    for n, low, whole in zip(sizes.tolist(), jaccard.low_prefix_length(sizes).tolist(), jaccard.prefix_length(sizes).tolist()):
        # with another set that is not smaller, this many are common at least
        least = min(c for c in range(n + 1) if 100 * c >= 75 * (n + n - c))
        assert low == n - least + 1 <= whole


def test_bit_counts_never_rule_out_what_is_alike():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a = set(rng.integers(0, 1 << 63, rng.integers(1, 900)).tolist())
        b = {x for x in a if rng.random() < 0.9} | set(rng.integers(0, 1 << 63, rng.integers(0, 60)).tolist()) or {1}
        maps = []
        for x in (a, b):
            hashes, sizes = np.array(sorted(x), np.uint64), np.array([len(x)])
            maps.append(jaccard.bitmaps(hashes, sizes, jaccard.map_longs(sizes))[0])
        assert jaccard.most_in_common(len(a), len(b), *maps) >= len(a & b)


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 100), (50, 60), (60, 50)], "a long, b long")
    assert {(r["node"], r["component"]) for r in components.components(links).collect()} == {(i, 0) for i in range(41)} | {(50, 50), (60, 50)}


def kept_bytes(texts):
    data = [(x or "").encode() for x in texts]
    count = {}
    for t in data:
        for i in range(len(t) - 199):
            count[t[i : i + 200]] = count.get(t[i : i + 200], 0) + 1
    out = []
    for t in data:
        gone = bytearray(len(t))
        for i in range(len(t) - 199):
            if count[t[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        out.append(bytes(c for c, g in zip(t, gone) if not g))
    return out


@pytest.mark.parametrize("hot_least", [2, 5, 64])
def test_repeated_spans(spark, hot_least):
    p, q = prose(10, 60), prose(14, 45)
    texts = [p, f"{prose(11, 40)} {p[20:260]} {prose(12, 40)}", "ab" * 150, "x" * 201, "y" * 200, None, "", "é" * 150, p[:199], prose(13, 50)]
    texts += [f"{prose(20 + i, 30)} {q[i:]} {prose(60 + i, 30)}" for i in range(12)] + [q] * 3
    ids = [None if i % 5 == 0 else i // 2 for i in range(len(texts))]
    found = suffix_dedup.without_repeats(docs(spark, *texts, ids=ids).repartition(5), hot_least).collect()
    assert sorted(((r["doc_id"] is None, r["doc_id"]), bytes(r["kept"])) for r in found if r["doc_id"] is not None) == sorted(((i is None, i), k) for i, k in zip(ids, kept_bytes(texts)) if i is not None)
    assert sorted(bytes(r["kept"]) for r in found) == sorted(kept_bytes(texts))
    for r in found:
        assert r["n_bytes"] == len(r["kept"]) + sum(x["stop"] - x["start"] for x in r["spans"]) and all(a["stop"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:]))


def test_merge_of_runs():
    rng = np.random.default_rng(1)
    runs = [sorted(bytes(rng.integers(97, 99, rng.integers(0, 9)).tolist()) for _ in range(n)) for n in (0, 7, 30, 1, 12)]
    coded = [suffix_dedup.decode_run(*suffix_dedup.front_code(x)) for x in runs]
    out = list(suffix_dedup.merge_runs(coded))
    assert [x for _, x, _ in out] == sorted(x for r in runs for x in r)
    assert all(k == suffix_dedup.common(a, b, 0) for (_, a, _), (k, b, _) in zip(out, out[1:]))


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@pytest.mark.parametrize("most", [1, 2, 3])
def test_banded_distance(most):
    rng = np.random.default_rng(most)
    pairs = []
    for _ in range(500):
        x = bytes(rng.integers(97, 100, rng.integers(0, 12)).tolist())
        y = bytearray(x)
        for _ in range(rng.integers(0, 4)):
            i = int(rng.integers(0, len(y) + 1))
            y[i : i + int(rng.integers(0, 2))] = bytes(rng.integers(97, 100, rng.integers(0, 2)).tolist())
        pairs.append((x, bytes(y)))
    found = line_dedup.within([a for a, _ in pairs], [b for _, b in pairs], most)
    assert found.tolist() == [edits(a, b) <= most for a, b in pairs]


def test_lines(spark):
    a, b = "this is the first long line of all", "and this is quite another long line"
    texts = [f"{a}\n{b}\nok", f"{a}\nok\n{b[:9]}{b[10:]}", f"x{a}\n{a[:-1]}!", None, "", f"{a}  \n{a[1:]}", f"{a}zz"]
    seen, expected = [], {}
    for k, t in enumerate(texts):
        kept = []
        for line in (t or "").encode().split(b"\n"):
            long = len(line.strip()) >= line_dedup.Limits.min_bytes
            if not (long and any(edits(line, x) <= line_dedup.Limits.least for x in seen)):
                kept.append(line)
            if long:
                seen.append(line)
        expected[k] = b"\n".join(kept).decode()
    found = line_dedup.without_lines(docs(spark, *texts))
    assert {r["doc_id"]: r["text"] for r in found.collect()} == expected and set(found.columns) == {"doc_id", "text", "node", "score", "n_lines", "n_removed"}


def test_lines_of_rows_with_equal_or_no_ids(spark):
    a, b, c = "the first line that is long enough", "omega, the second and unique line of it", "yet another line, of the fourth row only"
    texts, ids = [a, f"{a}\n{b}", f"{a}\n{b}", f"{c}\n{a}", None, f"{c}!\nok", f"{c}!\nok"], [5, 5, None, None, 5, 2, 2]
    rows = docs(spark, *texts, ids=ids).withColumn("n_lines", F.lit(1)).withColumn("line_nos", F.lit(2))
    found = line_dedup.with_lines_left(rows).collect()
    left = [line for r in found for line in r["left"].split("\n")]
    # of every line one place is left, in the first row that has it, and of the two last ones in one row
    assert sorted(x for x in left if len(x) > 2) == sorted([a, b, c]) and left.count("ok") == 2
    for r in found:
        n = len((r["row"]["text"] or "").split("\n"))
        assert r["n_lines"] == n and r["n_removed"] == n - (len(r["left"].split("\n")) if r["left"] or not r["n_removed"] else 0)
    assert {r["row"]["doc_id"] for r in found if a in r["left"]} == {None}
    assert line_dedup.without_lines(rows).columns == ["doc_id", "text", "node", "score", "line_nos", "n_lines", "n_removed"]


def test_a_group_of_near_copies(spark):
    """More lines than the first rounds ask, most of them near to some earlier one and far from others."""
    rng = np.random.default_rng(12)
    base = prose(40, 14)
    lines = []
    for k in range(60):
        x = list(base)
        for i in rng.integers(0, len(x), rng.integers(0, 6)):
            x[i] = "#@$%&"[k % 5]
        lines.append("".join(x))
    lines = list(dict.fromkeys(lines))
    expected, seen = {}, []
    for k, line in enumerate(lines):
        expected[k] = "" if any(edits(line, x) <= max(1, min(len(line) // 20, len(x) // 20, 4)) for x in seen) else line
        seen.append(line)
    assert 5 < sum(map(bool, expected.values())) < len(lines) - 10
    assert {r["doc_id"]: r["text"] for r in line_dedup.without_lines(docs(spark, *lines).repartition(4)).collect()} == expected


def test_a_worker_gives_back_what_it_has_freed(spark):
    def held(batches):
        yield from batches
        blocks = [np.ones(12_000) for _ in range(2000)]  # each too small for a mapping of its own
        common.kept("above them", lambda: np.ones(12_000))
        del blocks

    def size(batches):
        for batch in batches:
            with open("/proc/self/statm") as f:
                yield pa.RecordBatch.from_arrays([pa.array([int(f.read().split()[1]) * 4096 / 1e6])], ["mb"])

    one = spark.range(0, 1, 1, 1)
    first = one.mapInArrow(size, "mb double").first()[0]
    one.mapInArrow(common.lean(held), "id long").collect()
    assert one.mapInArrow(size, "mb double").first()[0] < first + 100


def test_only_near_pairs_of_a_group_are_rows(spark, monkeypatch):
    """Words put into one line at many places: all pairs share segments and are near by their letters; the askers fill several cells."""
    base, lines = prose(41, 20)[:200], []
    for k in range(70):
        at = 1 + 17 * k % 190
        lines.append(base[:at] + ("wxyz", "vvvvu", "q")[k % 3] + base[at:])
    far = [k for k, x in enumerate(lines) if not any(edits(x, y) <= 4 for y in lines[:k])]
    made, real = [], line_dedup.near_pairs
    monkeypatch.setattr(line_dedup, "CELL", 16)
    monkeypatch.setattr(line_dedup, "near_pairs", lambda pairs, *more: made.append(pairs.count()) or real(pairs, *more))
    kept = {r["doc_id"]: r["text"] for r in line_dedup.without_lines(docs(spark, *lines)).collect()}
    assert kept == {k: x if k in far else "" for k, x in enumerate(lines)} and 20 < len(far) < 60
    near = sum(edits(lines[k], y) <= 4 for k in range(70) for y in lines[:k])
    assert 0 < made[-1] <= near


def test_signatures_bound_the_edits(spark):
    """Whatever is within some edits may be near; most of what is far apart may not."""
    rng = np.random.default_rng(8)
    lines = ["".join("abcdefgh語"[i] for i in rng.integers(0, 9, rng.integers(1, 70))) for _ in range(40)] + ["ab" * 30, "ab" * 31, "", "a", "a" * 300]
    raw = np.frombuffer("".join(lines).encode("utf-32-le"), "<u4")
    known = line_dedup.signatures(raw, np.array([len(x) for x in lines])).view(np.int64).tolist()
    pairs = [(i, j, known[i], known[j], edits(lines[i], lines[j])) for i in range(len(lines)) for j in range(len(lines))]
    rows = spark.createDataFrame(pairs, "i int, j int, a array<long>, b array<long>, e int")
    may = lambda e: line_dedup.may_be_near(F.col("a"), F.col("b"), e)
    assert rows.filter(~may(F.col("e"))).count() == 0
    assert rows.filter((F.col("e") > 12) & may(F.lit(4))).count() < 0.02 * rows.filter("e > 12").count()


def test_near_copies_of_lines(spark):
    rng = np.random.default_rng(5)
    letters = [*"abcdefg hijk", "é", "ж", "語", "😀"]
    lines = []
    for n in [9, 12, 20, 24, 38, 39, 40, 41, 58, 59, 60, 61, 78, 79, 80, 82, 120, 300]:
        base = [letters[k] for k in rng.integers(0, len(letters), n)]
        lines.append("".join(base))
        for most in range(1, 7):
            x = list(base)
            for _ in range(most):
                i = int(rng.integers(0, len(x)))
                x[i : i + int(rng.integers(0, 2))] = [letters[k] for k in rng.integers(0, len(letters), rng.integers(0, 2))]
            lines.append("".join(x))
    order = rng.permutation(len(lines)).tolist()
    said = [lines[k] for k in order]
    seen, expected, near = [], {}, 0
    for k, line in enumerate(said):
        long = len(line.encode().strip()) >= line_dedup.Limits.min_bytes
        some = [edits(line, x) for x in seen if edits(line, x) <= max(1, min(min(len(line), len(x)) // 20, 4))] if long else []
        near += bool(some) and min(some) > 1
        expected[k] = "" if some else line
        seen += [line] * long
    assert near > 10
    assert {r["doc_id"]: r["text"] for r in line_dedup.without_lines(docs(spark, *said)).collect()} == expected


def test_quality_learns_and_holds_out(spark):
    good = [prose(i, 60) for i in range(60)]
    bad = [prose(100 + i, 60).upper().replace(" ", "!! ") for i in range(60)]
    table = docs(spark, *good, *bad, None, "")
    labels = spark.createDataFrame([(i, int(i < 60), 0) for i in range(120)] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    network = quality.fit(table, labels)
    rows = quality.score(table, network, "p").withColumn("out", quality.held_out(F.col("doc_id"))).collect()
    assert all(r["out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    right = [(r["p"] >= 0.5) == (r["doc_id"] < 60) for r in rows if r["out"] and r["doc_id"] < 120]
    assert len(right) > 20 and sum(right) >= 0.95 * len(right)
    assert quality.train([], []).score([b"x"])[0] == 0.5
    whole = [quality.Network.score(network, [x.encode()])[0] for x in good[:3]]
    assert np.allclose(whole, network.score([x.encode() for x in good[:3]]), atol=1e-5)


def network_of(kind, seed=0):
    rng = np.random.default_rng(seed)
    shapes = {"filters": (quality.IN, quality.FILTERS), "dense": (quality.FILTERS, quality.HIDDEN), "out": (2 * quality.HIDDEN,), "shift": (quality.FILTERS,), "dense_shift": (quality.HIDDEN,), "out_shift": (1,)}
    return quality.Network(0.5, {k: rng.normal(0, 0.2, s).astype(kind) for k, s in shapes.items()})


def test_gradients_are_those_of_the_loss():
    network, rng = network_of(np.float64), np.random.default_rng(1)
    data = [bytes(rng.integers(0, 256, n).astype(np.uint8)) for n in (0, 3, 300, 1000, 70_000)]
    labels = np.array([0, 1, 1, 0, 1.0])

    def loss():
        p = network.score(data)
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    found = network.gradients(data, labels)
    for name, w in network.weights.items():
        for _ in range(6):
            i = tuple(rng.integers(0, n) for n in w.shape)
            old, step = w[i], 1e-6
            w[i] = old + step
            up = loss()
            w[i] = old - step
            down = loss()
            w[i] = old
            assert found[name][i] == pytest.approx((up - down) / (2 * step), abs=1e-6)


def test_the_network_against_plain_loops():
    network = network_of(np.float64, 5)
    w, text = network.weights, "A plain text, seen byte by byte. " * 20
    data = text.encode() + bytes(quality.BLOCK)
    n = (len(text.encode()) + quality.WIDTH) // quality.BLOCK + 1
    blocks = []
    for b in range(n):
        places = [data[at : at + quality.WIDTH].ljust(quality.WIDTH, b"\0") for at in range(b * quality.BLOCK, (b + 1) * quality.BLOCK, quality.STRIDE)]
        places = places[:-1] if b == n - 1 else places  # the last place would see another document
        outputs = [np.concatenate([quality.VECTORS[c] for c in p]) @ w["filters"] for p in places]
        blocks.append(np.maximum(np.max(outputs, 0) + w["shift"], 0))
    chunks = [np.maximum(blocks[i], blocks[min(i + 1, n - 1)]) for i in range(n)]
    dense = [np.maximum(c @ w["dense"] + w["dense_shift"], 0) for c in chunks]
    logit = np.concatenate([np.max(dense, 0), np.mean(dense, 0)]) @ w["out"] + w["out_shift"]
    assert network.score([text.encode()])[0] == pytest.approx(1 / (1 + np.exp(-logit[0])))


def test_scores_do_not_depend_on_the_batch():
    rng = np.random.default_rng(0)
    shapes = {"filters": (quality.IN, quality.FILTERS), "dense": (quality.FILTERS, quality.HIDDEN), "out": (2 * quality.HIDDEN,), "shift": (quality.FILTERS,), "dense_shift": (quality.HIDDEN,), "out_shift": (1,)}
    network = quality.Network(0.5, {k: rng.normal(0, 0.2, s).astype(np.float32) for k, s in shapes.items()})
    said = [b"", b"abc", b"", b"\xff" * 300, b"abc", b"x" * 247, b"HELLO", b"x" * 248, b"", b"Q" * 600]
    alone = [network.score([x])[0] for x in said]
    for _ in range(5):
        order = rng.permutation(len(said)).tolist()
        assert np.allclose(network.score([said[i] for i in order]), [alone[i] for i in order], atol=1e-6)


def test_labels_of_held_out_rows_do_not_matter(spark):
    table = docs(spark, *[prose(i, 20) for i in range(40)])
    flip = lambda on: spark.createDataFrame([(i, int(i % 2 == 0) ^ int(on and zlib.crc32(str(i).encode()) % 3 == 1)) for i in range(40)], "doc_id long, quality int")
    a, b = (quality.fit(table, flip(on)) for on in (False, True))
    assert a.score([b"abc"])[0] == b.score([b"abc"])[0]


def test_empty_tables(spark, vocabulary):
    none = docs(spark, "a").limit(0)
    assert jaccard.similar_groups(none).count() == suffix_dedup.without_repeats(none).count() == line_dedup.without_lines(none).count() == jaccard.one_of_each(none).count() == 0
    assert token_store.summary(token_store.write_blocks(none, vocabulary, 1)).count() == 0
    network = quality.fit(none, spark.createDataFrame([], "doc_id long, quality int"))
    assert quality.score(none, network).count() == 0 and quality.score(docs(spark, "a", None), network).select("score").distinct().count() == 1
    assert url_reputation.judge_urls(spark.createDataFrame([], "page_id long, url string"), spark.createDataFrame([], "doc_id long, quality int")).count() == 0
    assert chat.format_chats(chat.as_events(spark.createDataFrame([], "conv_id long, turn int, role string, text string"))).count() == 0


def test_a_column_called_score_is_replaced(spark):
    assert quality.score(docs(spark, "a", None), quality.Network(0.25)).select("doc_id", "text", "node", "score").collect()[0]["score"] == 0.25


def test_select_of_ranges():
    rng = np.random.default_rng(2)
    for n, top in ((0, 1), (1, 5), (700, 9), (3000, 2**40), (2500, 20_000)):
        v = np.sort(rng.integers(0, top, n))
        coded = token_store.EliasFano.from_bytes(token_store.EliasFano.build(v).to_bytes())
        for _ in range(20):
            a = int(rng.integers(0, n + 1))
            b = int(rng.integers(a, n + 1))
            assert coded.select_range(a, b).tolist() == v[a:b].tolist()


def test_tables_that_are_not_read_any_more_are_deleted(spark):
    kept, gone = (common.stored(spark.range(3), "t") for _ in range(2))
    files = gone.inputFiles()
    common.forget(gone)
    assert files and not any(os.path.exists(x.removeprefix("file://").removeprefix("file:")) for x in files) and kept.count() == 3
