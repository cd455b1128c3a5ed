"""Token files, BPE lexicon and WARC archives: exact round trips."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm.edge import ODD, documents, prose
from tillworks.llm import bpe_lexicon, common, pretokens, token_files, warc

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
#: Characters on which tools disagree, and pieces of special tokens.
TRICKY = "'sdtrevlm <|>endoftext \t\n\u0085\x1c²½٣ªºßÉéñ…’–_12aBZ İ́中ȺǅKſ "


def tricky_texts(n):
    r = random.Random(5)
    return ["".join(r.choice(TRICKY) for _ in range(r.randint(0, 30))) for _ in range(n)] + ["<|endoftext|>", "a<|startoftext|>b", "don't we'll I'VE"]


@pytest.fixture(scope="module")
def by_bytes():
    return Tokenizer.from_file(BYTES)


@pytest.fixture(scope="module")
def by_words():
    return Tokenizer.from_file(WORDS)


def test_byte_ids_are_the_librarys(by_bytes):
    coder = token_files.coder(BYTES, 2)
    for t in [*tricky_texts(5000), *[t or "" for _, t in ODD]]:
        assert np.frombuffer(coder.ids(t), "<u4").tolist() == [*by_bytes.encode(t, add_special_tokens=False).ids, 2]


def test_token_files(spark, folder, by_bytes):
    rows = [*ODD, *[(100 + i, prose(i, 50)) for i in range(60)]]
    files = token_files.write(documents(spark, *rows).repartition(4), folder, BYTES, 2)
    found = token_files.read(spark, files, folder).collect()
    wanted = sorted((i is None, i or 0, np.array([*by_bytes.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()) for i, t in rows)
    got = sorted((r.start, r) for r in found)
    assert [(r.doc_id is None, r.doc_id or 0) for _, r in got] == [(a, b) for a, b, _ in wanted]
    start = 0
    for at, r in got:
        assert at == start
        start += r.n_tokens
    assert sorted((r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in found) == sorted((i, len(x) // 4, zlib.crc32(x)) for _, i, x in wanted)


def test_single_documents(spark, folder, by_bytes):
    text = prose(3, 30)
    files = token_files.write(documents(spark, (1, text), (2, "")), folder, BYTES, 2).collect()
    dictionary = open(f"{folder}/dictionary", "rb").read()
    docs = {int(f.doc_ids[i]): f.ids(i).tolist() for f in (token_files.TokenFile(r.file, dictionary) for r in files) for i in range(len(f))}
    assert docs == {1: [*by_bytes.encode(text, add_special_tokens=False).ids, 2], 2: [2]}
    with pytest.raises(ValueError):
        token_files.TokenFile(files[0].file, b"another")


def test_no_documents_no_files(spark, folder):
    files = token_files.write(documents(spark, *ODD).limit(0), folder, BYTES, 2)
    assert files.count() == 0 and token_files.read(spark, files, folder).count() == 0


def test_lexicon_holds_its_words_only():
    words = {w: [i, i + 1][: 1 + i % 2] for i, w in enumerate({p for k in range(30) for p in bpe_lexicon.pieces(prose(k, 40))} | {"é", "a", "ab", "éa"})}
    lexicon = bpe_lexicon.Lexicon(bpe_lexicon.compile_lexicon(words))
    assert all(lexicon.find(w) == ids for w, ids in words.items())
    assert [lexicon.find(w) for w in ("", "zz", "rive", "riversx", "é" * 3)] == [None] * 5
    assert bpe_lexicon.Lexicon(bpe_lexicon.compile_lexicon({})).find("a") is None


def test_lexicon_counts_words_of_all_texts(spark, tmp_path):
    """Words of texts outside the settled code points are in the lexicon like others."""
    rows = documents(spark, *enumerate(["λόγος λόγος и слово €", "слово x €", "plain words", "plain words"]))
    bpe_lexicon.build_lexicon(rows, WORDS, f"{tmp_path}/lexicon", 100)
    lexicon = bpe_lexicon.Lexicon(common.read_file(f"{tmp_path}/lexicon"))
    greek = [w for w in bpe_lexicon.counted_chunks("λόγος слово", WORDS)]
    assert len(greek) == 2 and all(lexicon.find(w) == bpe_lexicon.Merges(WORDS).ids(w) for w in [*greek, "€", "plain", "words"])
    assert lexicon.find("x") is None


def test_lexicon_is_minimal():
    """Words that share their ends share states: as many states as distinct sets of ends."""
    words = [a + b for a in ("re", "un", "over") for b in ("do", "doing", "done")]
    lexicon = bpe_lexicon.Lexicon(bpe_lexicon.compile_lexicon({w: [1] for w in words}))
    prefixes = {w[:i] for w in words for i in range(len(w) + 1)}
    ends = {frozenset(w[len(p):] for w in words if w.startswith(p)) for p in prefixes}
    assert lexicon.n_states == len(ends)


def test_merges_are_the_librarys(by_words):
    merges = bpe_lexicon.Merges(WORDS)
    for word in ["a", "the", "unbelievably", "é", "12", "!?", "x" * 300, "zq" * 40, *[p for k in range(20) for p in bpe_lexicon.pieces(prose(k, 30))]]:
        for piece in bpe_lexicon.pieces(word):
            assert merges.ids(piece) == by_words.encode(piece, add_special_tokens=False).ids


def test_words_of_one_beginning_walk_it_once(tmp_path):
    """The place of a beginning is remembered, and only if words of the lexicon have it."""
    words = {"river": [1], "rivers": [2, 3], "riv": [4], "é": [5], "über": [6]}
    lexicon = bpe_lexicon.Lexicon(bpe_lexicon.compile_lexicon(words))
    steps = []
    walk = lexicon._walk
    lexicon._walk = lambda labels, *at: steps.append(labels) or walk(labels, *at)
    assert [lexicon.find(w) for w in (*words, *words)] == [*words.values()] * 2
    assert steps.count(b"rive") == 1 and steps.count("übe".encode()) == 1
    assert [lexicon.find(w) for w in ("", "r", "rive", "riverx", "zzzz", "über!")] == [None] * 6
    assert {*lexicon.heads} <= {w.encode()[:i] for w in words for i in range(bpe_lexicon.HEAD + 1)}


def test_batches_of_all_kinds_decode_as_the_library(by_words, tmp_path):
    """Names are joined for a whole batch; texts that spell a special token keep the library's text."""
    merges = bpe_lexicon.Merges(WORDS)
    (tmp_path / "lexicon").write_bytes(bpe_lexicon.compile_lexicon({"the": merges.ids("the")}))
    coder = bpe_lexicon.WordCoder(WORDS, f"{tmp_path}/lexicon")
    special = ["<|endoftext|>", "a <|startoftext|> b"]
    for texts in ([None, ""], ["the tills", None, "λόγος the"], [*special, "the tills", ""], special):
        rows = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
        for r in next(bpe_lexicon._encoded(iter([rows]), coder, 0)).to_pylist():
            ids = by_words.encode(r["text"] or "", add_special_tokens=False).ids
            assert r["ids"] == ids and r["decoded"] == by_words.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("most", [0, 5, 20_000])
def test_bpe_is_the_librarys(spark, folder, by_words, most):
    rows = [*ODD, *[(200 + i, t) for i, t in enumerate(tricky_texts(600))]]
    frame = documents(spark, *rows).repartition(3)
    bpe_lexicon.build_lexicon(frame, WORDS, f"{folder}/lexicon", most)
    coded = bpe_lexicon.encode(frame, WORDS, f"{folder}/lexicon").collect()
    assert len(coded) == len(rows)
    for r in coded:
        ids = by_words.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == ids and r.decoded == by_words.decode(ids, skip_special_tokens=False)
    assert bpe_lexicon.encode(frame.limit(0), WORDS, f"{folder}/lexicon").count() == 0


def test_coder_goes_with_its_task(tmp_path, monkeypatch):
    """Not lasting: nothing of the coder stays in the worker, however the task ends; the ids are the same."""
    monkeypatch.setattr(bpe_lexicon, "_coders", {})
    texts = ["the tills of the town", "the town's tills, Ärger", None, ""]
    merges = bpe_lexicon.Merges(WORDS)
    (tmp_path / "lexicon").write_bytes(bpe_lexicon.compile_lexicon({w: merges.ids(w) for w in ("the", "town")}))
    rows = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])

    def coded(**named):
        return bpe_lexicon._encode(iter([rows, rows]), WORDS, f"{tmp_path}/lexicon", 0, **named)

    kept = [b.to_pylist() for b in coded(remembered=bpe_lexicon.REMEMBERED, lasting=True)]
    assert len(bpe_lexicon._coders) == 1
    assert [b.to_pylist() for b in coded(remembered=2, lasting=False)] == kept
    assert bpe_lexicon._coders == {}
    broken = coded(remembered=2, lasting=False)
    assert next(broken).to_pylist() == kept[0] and len(bpe_lexicon._coders) == 1
    broken.close()
    assert bpe_lexicon._coders == {}


def test_memo_forgets_what_is_not_used():
    made = []
    memo = pretokens.Memo(lambda p: made.append(p) or p * 2, 2)
    assert [memo[p] for p in "abcabca"] == [p * 2 for p in "abcabca"]
    assert len(memo) <= 2 and len(memo.older) <= 2 and set(made) == set("abc")


PAGES = "page_id bigint, url string, html string, record_type string"
BIG = "<p>" + prose(4, 300) + "é</p>"


def pages(spark, *rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], PAGES)


SOME_PAGES = [
    (1, "http://a.example.com/x?y=1#z", BIG), (5, "http://b.example.com/", BIG), (3, None, BIG), (2, "https://a.example.com:8080/x", "small"),
    (4, "not a url\n\ttab", "small"), (6, "http://a.example.com/x?y=1", None), (7, "http://c/", ""), (None, "http://d/", BIG), (8, "http://e/", BIG + "!"),
    (8, "http://e/", BIG + "!"), (9, "http://e/", "x" * 1000), (10, "http://e/", "é" * 500), (11, "http://e/", "é" * 500), (12, "http://f/", "é" * 499),
    (13, "http://f/", "é" * 499), (-4, "http://f/", "neg"),
]


def test_warc_round_trip(spark, folder):
    frame = pages(spark, *SOME_PAGES).repartition(3)
    keys = warc.archive(spark, frame, folder)
    found = warc.look_up(keys, f"{folder}/directory").collect()
    last = {}
    for i, _, h in SOME_PAGES:
        if i is not None:
            last[h or ""] = max(i, last.get(h or "", i))
    expected = []
    for i, _, h in SOME_PAGES:
        data = (h or "").encode()
        revisit = len(data) >= 1000 and i != last[h]
        expected.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", last[h] if revisit else None))
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted((tuple(r)[:5] for r in found), key=key) == sorted(expected, key=key)


def test_index_finds_single_captures(spark, folder, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    monkeypatch.setattr(warc, "SECTION_BLOCKS", 2)
    many = [(i, f"http://www.h{i % 7}.example.com/p/{i % 4}", f"page {i}") for i in range(200)]
    warc.archive(spark, pages(spark, *many).repartition(4), folder)
    index = warc.CaptureIndex(f"{folder}/directory")
    found = index.find("com,example,h3,www)/p/1")
    pages_found = sorted(int(warc.parse(warc.gzip.decompress(warc.fetch(a, at, n)))[0]["WARC-Record-ID"][10:-1]) for _, a, at, n in found)
    assert pages_found == [i for i in range(200) if i % 7 == 3 and i % 4 == 1]
    assert index.find("com,example,h3,www)/p/9") == [] == index.find("")


@pytest.mark.parametrize("files", [1, 3])
def test_directory_is_searched_by_range_reads(folder, monkeypatch, files):
    """Against a plain search; keys repeat over blocks, sections and nearly files."""
    monkeypatch.setattr(warc, "BLOCK_LINES", 4)
    monkeypatch.setattr(warc, "SECTION_BLOCKS", 3)
    keys = sorted(f"com,h{i % 37:02d})/ {i // 2 % 90:020d}" for i in range(2000))
    roots, cut = [], [0, *[next(k for k in range(2000 * i // files, 2000) if keys[k] != keys[k - 1]) for i in range(1, files)], 2000]
    for number, (low, high) in enumerate(zip(cut, cut[1:])):
        monkeypatch.setattr(warc.TaskContext, "get", lambda n=number: type("Task", (), {"partitionId": lambda self: n})())
        rows = [(k, 1, "a", i, 9) for i, k in enumerate(keys[low:high], low)]
        step = 7
        batches = (warc.batch(warc.CAPTURES, *map(list, zip(*rows[i:i + step]))) for i in range(0, len(rows), step))
        roots += [tuple(r.values()) for b in warc._write_blocks(batches, folder) for r in b.to_pylist()]
    out = warc.NewFile(f"{folder}/directory")
    out.write(warc._lines(roots))
    out.close()
    tries = [*sorted(set(keys)), "", "com,h05)/", "zzz", *reversed(sorted(set(keys))[::7])]
    index = warc.CaptureIndex(f"{folder}/directory")
    for low in tries:
        for high in (low, low[:-1] + "~", low + "~"):
            assert [x[2] for x in index.between(low, high)] == [i for i, k in enumerate(keys) if low <= k <= high]
    one = warc.CaptureIndex(f"{folder}/directory")
    assert len(list(one.between(keys[1000], keys[1000]))) == keys.count(keys[1000]) and one.reads <= 12


def test_keys(spark):
    urls = ["http://User.Example.COM:80/A?b#c", "", None, "//x.y/z", "mailto"]
    frame = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in frame.select(warc.reversed_host_key(F.col("u"))).collect()] == ["com,example,user)/A?b", ")", ")", ")//x.y/z", "mailto)"]


def test_no_pages(spark, folder):
    keys = warc.archive(spark, pages(spark, *SOME_PAGES).limit(0), folder)
    assert warc.look_up(keys, f"{folder}/directory").count() == 0


def test_shared_files_lie_where_spark_tables_do(spark, folder, monkeypatch):
    monkeypatch.setattr(common, "fresh_path", lambda spark, name: f"{folder}/{name}")
    uri = common.shared_file(spark, "x")
    assert uri.startswith("file:/")
    out = common.NewFile(f"{uri}/y")
    out.write(b"abc")
    out.close()
    assert common.read_file(f"{folder}/x/y") == b"abc"


def test_hadoop_schemes(monkeypatch):
    asked = []
    monkeypatch.setattr(common, "fs", type("Fs", (), {"FileSystem": type("F", (), {"from_uri": staticmethod(asked.append)})}))
    for uri in ("s3a://bucket/a b", "s3n://bucket/a", "hdfs://name:8020/a", "gs://bucket/a"):
        common.open_store(uri)
    assert asked == ["s3://bucket/a b", "s3://bucket/a", "hdfs://name:8020/a", "gs://bucket/a"]
    monkeypatch.undo()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.open_store("ofs://cluster/a")
