"""The operators that write archives, manifests and samples, on small tables against plain code."""

import gzip
import hashlib
import json
import math
import re
import zlib
from base64 import b32encode
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lectio.llm import importance, merkle, warc

PAGES = "page_id long, url string, html string, name string, first long"


def pages(spark, *rows):
    """Columns beyond page_id, url and html have names that the operator uses itself."""
    return spark.createDataFrame([(*x, "n", 5) for x in rows], PAGES)


ODD_PAGES = [(3, "http://a/\r\nX: y", "<p>é</p>"), (1, "http://b/", "<p>é</p>"), (2, None, None), (7, "http://ж/", ""), (None, "u", "<p>é</p>"), (None, "u", "alone"), (None, "v", "alone"), (5, "w", "x" * 70_000), (9, "z", "twice"), (9, "z", "twice"), (8, "y", "single")]


def expected_records(rows, least=0):
    """(page_id, payload, type, refers_to) of each row."""
    groups, out = {}, []
    for i, (page_id, _, html) in enumerate(rows):
        groups.setdefault(html or "", []).append((page_id is None, page_id or 0, i))
    for html, members in groups.items():
        members.sort()
        first = rows[members[0][2]][0]
        for k, (_, _, i) in enumerate(members):
            plain = k == 0 or len(html.encode()) < least
            out.append((rows[i][0], html, "response" if plain else "revisit", None if plain else first))
    return sorted(out, key=repr)


@pytest.mark.parametrize("sizes, least", [(warc.Sizes(), 0), (warc.Sizes(file_bytes=700, least_bytes=20, least_shards=3), 6)])
def test_archives_hold_every_page_once(spark, tmp_path, sizes, least):
    folder = f"file:{tmp_path}/w"
    warc.write_archives(pages(spark, *ODD_PAGES), folder, sizes, least)
    found = warc.read_archives(spark, folder).collect()
    payload = {r["payload_digest"]: bytes(r["payload"]).decode() for r in found if r["record_type"] == "response"}
    got = [(r["page_id"], payload[r["payload_digest"]], r["record_type"], r["refers_to"]) for r in found]
    assert sorted(got, key=repr) == expected_records(ODD_PAGES, least)
    for r in found:
        data = payload[r["payload_digest"]].encode()
        assert r["payload_bytes"] == len(data) and r["payload_digest"] == b32encode(hashlib.sha1(data).digest()).decode()
    with pytest.raises(ValueError, match="committed"):
        warc.write_archives(pages(spark, *ODD_PAGES), folder)
    files = {x.name: x.read_bytes() for x in (tmp_path / "w").glob("shard-*")}
    assert not list((tmp_path / "w").glob("_temporary*")) and {r["file"] for r in warc.manifest(spark, folder).collect()} == set(files)
    assert (len(files) > 3) == (least > 0)
    # the same bytes whatever the partitions, and files of a size unless one record is larger
    warc.write_archives(pages(spark, *ODD_PAGES).repartition(5), f"file:{tmp_path}/v", sizes, least)
    assert files == {x.name: x.read_bytes() for x in (tmp_path / "v").glob("shard-*")}
    for name, data in files.items():
        text = gzip.decompress(data)
        assert text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") and name.encode() in text and b"\r\nX: y" not in text
        assert len(data) <= sizes.file_bytes or text.count(b"WARC-Type") == 2


def test_records_keep_the_order_of_page_id(spark, tmp_path):
    warc.write_archives(spark.createDataFrame([(i * 7919 % 500, "u", f"{i}" * (i % 9)) for i in range(500)], "page_id long, url string, html string"), str(tmp_path / "w"), warc.Sizes(file_bytes=4000, least_bytes=50, least_shards=7))
    ids = []
    for f in sorted((tmp_path / "w").glob("shard-*")):
        ids += map(int, re.findall(rb"WARC-Page-ID: (\d+)", gzip.decompress(f.read_bytes())))
    assert ids == list(range(500))


def test_damaged_and_unfinished_archives_are_noticed(spark, tmp_path):
    folder = tmp_path / "w"
    warc.write_archives(pages(spark, (1, "u", "abc"), (2, "u", "abd")), str(folder))
    (file,) = folder.glob("shard-*")
    whole = file.read_bytes()
    file.write_bytes(whole[:-20])
    with pytest.raises(Exception, match="cut off|not the file"):
        warc.read_archives(spark, str(folder)).collect()
    member = warc.record(1, "u", b"abc", None, False)
    with pytest.raises(ValueError, match="not what its header says"):
        warc.parsed(gzip.decompress(member).replace(b"\r\n\r\nabc", b"\r\n\r\nabx"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        warc.read_archives(spark, str(tmp_path / "none"))
    warc.write_archives(pages(spark, (1, "u", "x")).limit(0), str(tmp_path / "empty"))
    assert warc.read_archives(spark, str(tmp_path / "empty")).count() == 0


def plain_h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(nodes):
    """Levels from the leaves to the root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([plain_h(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 513, 700])
def test_positions_are_the_order_of_completion(n):
    """A plain walk that writes a node when its last child is written."""
    levels = plain_tree([str(i) for i in range(n)])
    order = []

    def walk(level, i):
        if level:
            for k in range(8 * i, min(8 * i + 8, len(levels[level - 1]))):
                walk(level - 1, k)
        order.append((level, i))

    walk(len(levels) - 1, 0)
    assert merkle.height(n) == len(levels) - 1
    assert [merkle.position(level, i, n) for level, i in order] == list(range(len(order)))
    assert [x.decode() for x in merkle.append([x.encode() for x in levels[0]], merkle.height(n))] == [levels[level][i] for level, i in order]


LEAVES = "doc_id long, lang string, leaf string, claimed string, node long"


def test_manifest_against_plain_trees(spark):
    """Languages of one, some and more than 512 leaves, null ids and languages, equal rows, wrong claims."""
    rows = [(i * 7919 % 1200, "b", plain_h(str(i)), plain_h("x" if i % 3 == 0 else str(i)), 1) for i in range(1200)]
    rows += [(i, None, plain_h(f"n{i}"), plain_h(f"n{i}"), 1) for i in range(9)] + [(0, "ж", plain_h("z"), plain_h("z"), 1)] + [(None, "a", plain_h("q"), plain_h("q"), 1)] * 2 + [(4, "a", plain_h("r"), plain_h("s"), 1)]
    made = merkle.manifest(spark.createDataFrame(rows, LEAVES).repartition(5))
    found = merkle.checked(made.log, made.leaves, made.subroots).join(made.subroots.drop("path"), "tree")
    found = {(r["doc_id"], r["lang"], r["leaf"]): r for r in found.collect()}
    place = lambda r: (r[0] is not None, r[0] or 0, r[2])
    langs = [None, *sorted({r[1] for r in rows if r[1] is not None}, key=lambda x: x.encode())]
    trees = {x: sorted((r for r in rows if r[1] == x), key=place) for x in langs}
    levels = {x: plain_tree([r[2] for r in trees[x]]) for x in langs}
    top = plain_tree([levels[x][-1][0] for x in langs])
    assert len(found) == len({(r[0], r[1], r[2]) for r in rows})
    for k, x in enumerate(langs):
        for i, r in enumerate(trees[x]):
            at, own, path = i, r[3], []
            for floor, number in ((levels[x], i), (top, k)):
                at = number
                for level in floor[:-1]:
                    run = level[at - at % 8 : at - at % 8 + 8]
                    path += run[: at % 8] + run[at % 8 + 1 :]
                    own = plain_h(*run[: at % 8], own, *run[at % 8 + 1 :])
                    at //= 8
            got = found[r[0], x, r[2]]
            assert (got["subroot"], got["root"], got["folded_root"]) == (levels[x][-1][0], top[-1][0], own)
            if not (r[0] is None and x == "a"):  # of equal rows one is the first
                assert got["proof_sha256"] == plain_h(*path)
            assert (own == got["root"]) == (r[2] == r[3])
    logged = merkle.positions(made.log)
    for tree, x in enumerate(langs):
        nodes = [(r["position"], r["level"], r["number"], r["digest"]) for r in logged.filter(F.col("tree") == tree).collect()]
        assert sorted(p for p, *_ in nodes) == list(range(sum(map(len, levels[x]))))
        assert all(levels[x][level][i] == d and merkle.position(level, i, len(trees[x])) == p for p, level, i, d in nodes)
    missing = merkle.checked(made.log, spark.createDataFrame([(0, 10_000, "c"), (0, 9, "c")], "tree long, number long, claimed string"), made.subroots)
    assert [r["folded_root"] for r in missing.collect()] == [None, None]


def test_no_leaves(spark):
    made = merkle.manifest(spark.createDataFrame([], LEAVES))
    assert merkle.checked(made.log, made.leaves, made.subroots).count() == made.subroots.count() == merkle.positions(made.log).count() == 0


def test_leaves_take_nulls_and_bytes(spark):
    df = spark.createDataFrame([(1, None, "ж", None, "aÉ"), (None, "s", None, 3, None)], "doc_id long, source string, lang string, n_chars long, text string")
    assert [r[0] for r in df.select(merkle.document_leaf(F.col("text"))).collect()] == [plain_h("1:1", "-", "2:ж", "-", "3:aÉ"), plain_h("-", "1:s", "-", "1:3", "-")]


WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_features(text, longest=2):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return len(words), [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def plain_sample(docs, target, draw):
    crc = lambda f: zlib.crc32(f.encode()) % draw.buckets
    own = [plain_features(x, draw.longest) for _, x in docs]
    s, t = Counter(crc(f) for _, fs in own for f in fs), Counter(crc(f) for x in target for f in plain_features(x, draw.longest)[1])
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (total_s + draw.buckets) / ((s[b] + 1) * (total_t + draw.buckets)))) for b in s}
    rows = []
    for (doc_id, _), (n_words, fs) in zip(docs, own):
        weight = sum(gain[crc(f)] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{draw.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words])
    able = sorted((r for r in rows if r[4] >= draw.least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = Counter()
    for i, r in enumerate(able[: draw.percent * len(able) // 100]):
        r.append(i + 1)
    return sorted(((r[0], r[1], r[2], r[3], r[5] if len(r) > 5 else None) for r in rows), key=repr)


@pytest.mark.parametrize("draw", [importance.Draw(buckets=50, least_words=3, percent=40), importance.Draw(longest=3, buckets=7, least_words=1, percent=100, seed=1), importance.Draw(percent=0), importance.Draw(least_words=2, percent=35, buckets=1)])
def test_samples_against_plain_code(spark, draw):
    words = ["The", "cat", "été", "ÉTÉ", "x1", "dog", "İ", "日本", "a"]
    docs = [(i, " ".join(words[(i * k + k * k) % 9] for k in range(i % 13)) + "-,") for i in range(60)]
    docs += [(60, None), (61, ""), (None, "cat dog a cat"), (None, "cat dog a cat"), (62, "cat dog a " * 400), (63, "the cat"), (63, "the cat"), (63, "the cat")]
    target = ["the cat and the dog", None, "", "日本 x1"]
    df = spark.createDataFrame([(i, x, 1, "y", 2) for i, x in docs], "doc_id long, text string, score long, buckets string, rank int").repartition(5)
    found = importance.resampled(df, spark.createDataFrame([(i, x) for i, x in enumerate(target)], "item_id long, text string"), draw)
    assert sorted(((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in found.collect()), key=repr) == plain_sample(docs, target, draw)


def test_empty_corpus_and_target(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert importance.resampled(docs.limit(0), items).count() == 0
    assert importance.resampled(docs, items).first()["weight"] == plain_sample([(1, "a b")], [], importance.Draw())[0][2]


@pytest.mark.parametrize("k", [1, 2, 3, 4, 5, 6, 7])
def test_cutoff_counts_exactly(spark, k):
    rows = [(5, 1), (5, 9), (5, 9), (7, 3), (5, None), (2, 0), (5, -4)]
    order = sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1] or 0))
    assert importance.cutoff(spark.createDataFrame(rows, "score long, doc_id long"), k) == order[k - 1]
