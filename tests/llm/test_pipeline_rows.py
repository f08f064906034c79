"""Each pipeline stage on rows without a doc_id, repeated rows, several texts under one doc_id, and odd columns."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
import pytest

from crowdpulse.llm.frames import BATCH_BYTES, batched
from crowdpulse.llm.quality_model import quality_scores
from crowdpulse.llm.quality_rules import rules
from crowdpulse.llm.queries import table, trusted

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept_id long, row_number int, h string"


@pytest.fixture(scope="module")
def stages():
    import corpus_pipeline

    return dict(corpus_pipeline.STAGES)


def _rows(found):
    return Counter((r.doc_id, r.text) for r in found.collect())


def _mixed(spark, sf_dir):
    """The documents, every third without a doc_id, some twice, some under one doc_id."""
    rows = []
    for i, r in enumerate(table(spark, sf_dir, "documents").orderBy("doc_id").collect()):
        doc_id = None if i % 3 == 0 else 7 if i % 10 == 1 else r.doc_id
        row = (doc_id, r.text, r.lang, r.source, r.n_chars, 1, 2, "x")
        rows += [row] * (3 if i % 8 == 0 else 1)
    rows += [(None, None, None, None, None, None, None, None), (1 << 40, "", "en", None, 0, 1, 1, "")]
    return spark.createDataFrame(rows, SCHEMA)


def test_refused_texts_go_whatever_their_doc_id(spark, sf_dir, stages):
    docs = _mixed(spark, sf_dir)
    found = stages["quality classifier"](spark, docs, sf_dir)
    assert found.columns == docs.columns
    kept = _rows(found)
    assert set(kept) < set(_rows(docs)) and all(n == _rows(docs)[key] for key, n in kept.items())
    # Texts of labelled documents with one text each make the model, as in the stage.
    assert None in {doc_id for doc_id, _ in kept} and None in {d for d, _ in set(_rows(docs)) - set(kept)}
    # Rows of one text share its verdict, with and without doc_id.
    by_text = {}
    for key in _rows(docs):
        by_text.setdefault(key[1], set()).add(key in kept)
    assert all(len(v) == 1 for v in by_text.values())

    judged = stages["quality rules"](spark, docs, sf_dir)
    assert judged.columns == docs.columns
    passed = _rows(judged)
    by_text = {}
    for key, n in _rows(docs).items():
        assert passed[key] in (0, n)
        by_text.setdefault(key[1], set()).add(key in passed)
    assert all(len(v) == 1 for v in by_text.values()) and (None, None) not in passed
    assert any(doc_id is None for doc_id, _ in passed)


def test_one_row_of_each_group_stays(spark, sf_dir, stages):
    text = " ".join(f"word{i}" for i in range(60))
    near = text + " more"
    other = " ".join(f"thing{i}" for i in range(40))
    rows = [(1, text)] * 5 + [(2, text)] * 3 + [(None, text)] * 4 + [(3, near), (None, near)]
    rows += [(None, other)] * 4 + [(9, other), (5, "a b"), (5, "c d"), (5, "c d"), (6, ""), (None, ""), (None, None)]
    docs = spark.createDataFrame([(d, t, "en", "s", 1, 1, 1, "k") for d, t in rows], SCHEMA)
    found = stages["MinHash near-dedup"](spark, docs, sf_dir)
    assert found.columns == docs.columns
    want = {(1, text): 1, (9, other): 1, (5, "a b"): 1, (5, "c d"): 1, (6, ""): 1, (None, ""): 1, (None, None): 1}
    assert _rows(found) == want


def test_every_stage_of_odd_and_empty_tables(spark, sf_dir, stages):
    docs = _mixed(spark, sf_dir)
    for name, stage in stages.items():
        empty = stage(spark, docs.limit(0), sf_dir)
        assert empty.count() == 0
        if name != "best-fit packing":
            assert empty.columns == docs.columns
    safe = stages["secret scans"](spark, docs, sf_dir)
    assert safe.columns == docs.columns and safe.count() == docs.count()
    packed = stages["best-fit packing"](spark, docs, sf_dir)
    starts = packed.where("piece = 0").groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in starts} == {
        r.doc_id: r["count"] for r in docs.groupBy("doc_id").count().collect()
    }


def test_verdicts_of_plain_tables_are_the_operators(spark, sf_dir, stages):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    good = {r.doc_id for r in quality_scores(docs, labels).where("predicted = 1").collect()}
    assert {r.doc_id for r in stages["quality classifier"](spark, docs, sf_dir).collect()} == good
    clean = {r.doc_id for r in rules(docs, trusted(labels)).where("kept").collect()}
    assert {r.doc_id for r in stages["quality rules"](spark, docs, sf_dir).collect()} == clean


def test_texts_come_to_python_in_small_batches(spark, sf_dir, stages):
    """Whatever their length; a batch of 10,000 rows of this table would be 160 MB in executor and worker."""
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(limit, None)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], names=["size", "n"])

    docs = spark.range(0, 4_000, 1, 1).selectExpr("id AS doc_id", "repeat(format_string('w%d ', id), 2000) AS text")
    try:
        spark.conf.unset(limit)
        found = batched(docs, sizes, "size long, n long").collect()
        assert sum(r.n for r in found) == 4_000
        assert max(r.size for r in found) < BATCH_BYTES + (64 << 10)

        # The stages that hand texts to Python set the limit; one of the session's own is left.
        small = docs.limit(3)
        for name in ("quality classifier", "MinHash near-dedup", "secret scans", "best-fit packing"):
            spark.conf.unset(limit)
            stages[name](spark, small, sf_dir)
            assert spark.conf.get(limit) == str(BATCH_BYTES), name
        spark.conf.set(limit, str(1 << 20))
        found = batched(docs, sizes, "size long, n long").collect()
        assert max(r.size for r in found) < (1 << 20) + (64 << 10)
    finally:
        spark.conf.unset(limit) if before is None else spark.conf.set(limit, before)
