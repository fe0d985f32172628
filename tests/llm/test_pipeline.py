"""The whole pipeline on a small table: what each stage keeps, what it hands on, and the packed pieces."""

import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from usageloom.llm import quality, toxicity
from usageloom.llm.common import read_table

SMALL = "/root/testdata/sf0.001"


def shingles(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def one_of_each_group(docs):
    sets = {i: shingles(t) for i, t in docs.items()}
    home = {i: i for i in docs}
    for a in docs:
        for b in docs:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                old, new = max(home[a], home[b]), min(home[a], home[b])
                home = {i: new if h == old else h for i, h in home.items()}
    return {i: t for i, t in docs.items() if home[i] == i}


@pytest.fixture(scope="module")
def ran(spark):
    """The documents that go into each stage and the rows that come out of the last, as ``run`` hands them on."""
    seen = []
    stages = list(corpus_pipeline.STAGES)

    def watched(stage):
        def run(session, docs, folder):
            seen.append((docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}))
            return stage(session, docs, folder)
        return run

    corpus_pipeline.STAGES[:] = [(name, watched(stage)) for name, stage in stages]
    try:
        rows = corpus_pipeline.run(spark, SMALL).collect()
    finally:
        corpus_pipeline.STAGES[:] = stages
    return seen, rows


def test_stages_are_in_the_order_dealt():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "toxicity", "exact_dedup", "near_dedup", "packing"]


def test_every_stage_hands_on_whole_documents(spark, ran):
    seen, _ = ran
    original = read_table(spark, SMALL, "documents")
    texts = {r["doc_id"]: r["text"] for r in original.collect()}
    for columns, docs in seen:
        assert columns == original.columns
        assert all(texts[i] == t for i, t in docs.items())
    sizes = [len(docs) for _, docs in seen]
    assert sizes[0] == len(texts) and sizes == sorted(sizes, reverse=True) and sizes[-1] > len(texts) // 3


def test_quality_and_toxicity_keep_what_their_verdicts_say(spark, ran):
    (_, first), (_, second), (_, third), *_ = ran[0]
    labels = read_table(spark, SMALL, "labels")
    documents = read_table(spark, SMALL, "documents")
    good = {r["doc_id"] for r in quality.quality_report(documents, labels).filter("kept").collect()}
    assert set(second) == good & set(first)
    machine = toxicity.train(documents.join(spark.createDataFrame([(i,) for i in second], "doc_id long"), "doc_id"), labels)
    known = toxicity.Buckets()
    clean = {i for i, t in second.items() if machine.score(toxicity.buckets_of(t or "", known)) < toxicity.CUT}
    assert set(third) == clean


def test_both_deduplications_equal_plain_loops(ran):
    _, _, (_, before), (_, between), (_, after) = ran[0]
    first = {}
    for i in sorted(before):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", before[i] or ""), i)
    assert set(between) == set(first.values())
    assert after == one_of_each_group(between)


def test_pieces_are_those_of_the_documents_left(ran):
    seen, rows = ran
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = set()
    for i, text in seen[-1][1].items():
        ids = plain.encode(text or "", add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at:at + 4096]
            expected.add((i, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows} == expected and len(rows) == len(expected)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 4096
