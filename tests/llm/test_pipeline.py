"""The pipeline stage by stage against its operators' rules, by brute force."""

import re

import corpus_pipeline
import pytest
from llm.edge import ODD, documents, prose
from llm.test_codecs import WORDS
from llm.test_near import plain_classes
from llm.test_texts import plain_counts, plain_spans
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.01"


def plain(text):
    return " ".join(re.findall(r"\w+", (text or "").lower()))


@pytest.fixture(scope="module")
def results(spark):
    """Every stage's documents on the given tables, written and read again."""
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.stored(stage(spark, out[-1], SF), "stage"))
    return [frame.collect() for frame in out]


def test_stages_and_columns(results):
    assert [len(f) > 0 for f in results] == [True] * 6
    assert all(f[0].__fields__ == results[0][0].__fields__ for f in results[1:5])
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "MinHash near-dedup", "benchmark decontamination", "secret scans", "BPE encoding and decoding"]


def test_quality(results, spark):
    kept = {r.doc_id for r in results[1]}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean_lost = 0
    for r in results[0]:
        n = plain_counts(r.text)
        failed = n[0] < 50 or 100 * n[4] > 50 * n[0]
        assert not (failed and r.doc_id in kept)
        clean_lost += labels.get(r.doc_id) == 1 and not failed and r.doc_id not in kept
        assert not (labels.get(r.doc_id) == 0 and r.doc_id in kept)
    assert clean_lost <= 0.02 * len(results[0])


def test_near_copies(results):
    classes = dict(plain_classes([(r.doc_id, r.text) for r in results[1]]))
    assert {r.doc_id for r in results[2]} == {i for i, c in classes.items() if i == c}


def test_benchmark(results, spark):
    items = [plain(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert {r.doc_id for r in results[3]} == {r.doc_id for r in results[2] if not any(b in plain(r.text) for b in items)}


def test_secrets(results):
    before = {r.doc_id: r for r in results[3]}
    assert len(results[4]) == len(before)
    for r in results[4]:
        old = before[r.doc_id].text
        assert plain_spans(r.text) == [] and r.n_chars == len(r.text)
        assert plain_spans(old) or r.text == old


def test_tokens(results):
    library, texts = Tokenizer.from_file(WORDS), {r.doc_id: r.text for r in results[4]}
    assert len(results[5]) == len(texts)
    for r in results[5]:
        assert r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids)


def test_odd_documents(spark):
    docs = documents(spark, *ODD, (40, prose(40, 90) + ' password = "hunter2hunter2"')).select("doc_id", "text", "lang", "source", "n_chars")
    for empty in (False, True):
        frame = docs.limit(0) if empty else docs
        for _, stage in corpus_pipeline.STAGES:
            frame = corpus_pipeline.stored(stage(spark, frame, SF), "odd")
        found = {r.doc_id for r in frame.collect()}
        assert found == (set() if empty else found) and (empty or {5, 40} <= found)
