"""The pipeline, each stage on its own input, against plain versions."""

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from brute import components, cut_characters, least_edits, plain, repeated_bytes
from conftest import SMALL
from pyspark.sql import functions as F

from tallyhouse.llm import byte_bpe, decontaminate, quality_classifier
from tallyhouse.llm.text import read, text_crc

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def plain_run(spark, docs, labels, benchmark):
    """(id, text) rows after each of the first four stages, then id and ids."""
    model = quality_classifier.fit(docs, labels, text_crc("doc_id") % 5 != 0)
    scores = quality_classifier.score(docs.withColumn("doc_id", F.struct("doc_id", "text")), model).collect()
    rows = sorted((r.doc_id.doc_id, r.doc_id.text) for r in scores if r.score >= 0.3)
    yield rows
    members, sets = components(rows)
    rows = [row for i, row in enumerate(rows) if not sets[i] or i == min(members[i])]
    yield rows
    rows = [(i, t and cut_characters(t, gone)) for (i, t), gone in zip(rows, repeated_bytes(rows))]
    yield rows
    wanted = decontaminate.Passages.of(benchmark)
    passages = [(c.tobytes().decode("utf-32-le"), int(k)) for c, k in zip(wanted.codes, wanted.budget)]
    rows = [(i, t) for i, t in rows if not any(
        p in plain(t or "") or near(p, plain(t or ""), k) for p, k in passages)]
    yield rows
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                 mergeable_ranks=byte_bpe.load_ranks(RANKS).ranks)
    yield [(i, np.array(encoding.encode_ordinary(t or ""), "<u4").tobytes()) for i, t in rows]


def near(passage, text, budget):
    """Whether the passage stands in the text with at most that many edits. One of ``budget + 1`` equal parts
    of it stands there without an edit, which saves most alignments."""
    size = len(passage) // (budget + 1)
    parts = [passage[k * size:(k + 1) * size] for k in range(budget + 1)]
    return size > 0 and any(p in text for p in parts) and least_edits(passage, text) <= budget


def test_every_stage_equals_its_plain_version(spark):
    docs, labels = read(spark, SMALL, "documents"), read(spark, SMALL, "labels")
    benchmark = [(r.item_id, r.text) for r in read(spark, SMALL, "benchmark").collect()]
    columns = docs.columns
    for (name, stage), expected in zip(corpus_pipeline.STAGES, plain_run(spark, docs, labels, benchmark)):
        docs = stage(spark, docs, SMALL).cache()
        got = docs.collect()
        if docs.columns == columns:
            assert sorted((r.doc_id, r.text) for r in got) == expected, name
            assert name != "suffix-array dedup" or all(r.n_chars == len(r.text) for r in got)
        else:
            assert sorted((r.doc_id, bytes(r.ids)) for r in got) == expected
            assert all(r.n_tokens == len(r.ids) // 4 for r in got)
    assert {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, SMALL).collect()} == {
        r.doc_id: r.n_tokens for r in got}


@pytest.mark.parametrize("rows", ["odd", "none"])
def test_stages_take_odd_rows(spark, frame, odd_rows, rows):
    docs = frame(odd_rows if rows == "odd" else [])
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL).cache()
        found = docs.collect()
        assert docs.columns == columns or name == corpus_pipeline.STAGES[-1][0]
        assert len(found) <= len(odd_rows) if rows == "odd" else not found
    assert rows == "none" or {1, 2, 3} <= {r.doc_id for r in found}
