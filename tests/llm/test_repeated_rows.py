"""Rows that come twice, and very long texts."""

import numpy as np
import pytest

import corpus_pipeline
from tradewind.llm import common, minhash, suffixes


def test_near_duplicates_leave_one_row_of_an_id(spark):
    a, b = (" ".join(f"{w}{i}" for i in range(200)) for w in "ab")
    rows = [(1, a, "x"), (1, a, "x"), (2, b, "y"), (3, a, "z"), (None, a, None), (None, a, None), (4, None, None), (4, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = sorted(map(tuple, minhash.drop_near_duplicates(frame).collect()), key=str)
    assert got == sorted([(1, a, "x"), (2, b, "y"), (None, a, None), (None, a, None), (4, None, None)], key=str)


def test_a_document_loaded_twice_keeps_its_text(spark):
    docs = common.table(spark, "/root/testdata/sf0.001", "documents")
    stages = dict(corpus_pipeline.STAGES)
    once = stages["minhash_near_dedup"](spark, docs, "")
    twice = stages["minhash_near_dedup"](spark, docs.unionByName(docs), "")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    left = {r.doc_id: r.text for r in stages["suffix_array_dedup"](spark, once, "").collect()}
    again = {r.doc_id: r.text for r in stages["suffix_array_dedup"](spark, twice, "").collect()}
    assert left == again


@pytest.mark.parametrize("size", [700, 5000])
def test_blocks_of_a_long_text_have_all_anchors(monkeypatch, size):
    """Every window has one anchor in its reach, and equal windows have it at the same offset."""
    length, pick = 40, np.random.default_rng(3)
    data = pick.integers(97, 101, size).astype(np.uint8)
    data[size // 2 : size // 2 + 120] = data[:120]
    at = np.array([0, 300, size])

    def offsets():
        _, text, anchor, first, last = suffixes._anchors(data, at, length)
        return {w: (t, p - w) for t, p, f, g in zip(text, anchor, first, last) for w in range(f, g + 1)}

    whole = offsets()
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", 64)
    assert offsets() == whole and len(whole) == sum(s - length + 1 for s in (300, size - 300))
