"""The quality model and the rules' verdict against plain computations on one machine."""

from __future__ import annotations

import math
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from crowdpulse.llm import quality_model as model
from crowdpulse.llm import quality_rules
from crowdpulse.llm.frames import ROWS_READ, cut, few_rows_read
from crowdpulse.llm.queries import table, trusted

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _monotone(values, weights):
    """Isotonic regression by its min-max formula, without pooling."""
    sums, total = np.concatenate([[0], np.cumsum(values * weights)]), np.concatenate([[0], np.cumsum(weights)])
    n = len(values)
    mean = lambda a, b: (sums[b + 1] - sums[a]) / (total[b + 1] - total[a])
    return np.array([max(min(mean(a, b) for b in range(i, n)) for a in range(i + 1)) for i in range(n)])


def _by_hand(texts, labels):
    """Scores of all texts by the same model, from whole matrices."""
    fold = {i: zlib.crc32(str(i).encode()) % 4 for i in texts}
    stats = {i: model.statistics(text) for i, text in texts.items()}
    known = [i for i in texts if i in labels and fold[i] != 2]
    rows = np.array([stats[i] for i in known])
    deviation = rows.std(axis=0)
    features = model.Features(rows.mean(axis=0), np.where(deviation > 1e-9, deviation, 1.0))
    x, y, own = features(rows), np.array([labels[i] for i in known], dtype=float), np.array([fold[i] for i in known])

    def solved(some, strength):
        shrink = np.diag([strength] * model.FEATURES + [1e-9])
        return np.linalg.solve(x[some].T @ x[some] + shrink, x[some].T @ y[some])

    def error(strength):
        return sum(((x[own == f] @ solved(own != f, strength) - y[own == f]) ** 2).sum() for f in (0, 1, 3))

    strength = min(model.RIDGES, key=error)
    raw = np.zeros(len(known))
    for f in (0, 1, 3):
        raw[own == f] = x[own == f] @ solved(own != f, strength)
    steps = np.round(np.clip(raw, -1, 2) * model.GRID).astype(int)
    knots = np.unique(steps)
    weight = np.array([(steps == k).sum() for k in knots], dtype=float)
    levels = _monotone(np.array([y[steps == k].mean() for k in knots]), weight)
    final = solved(np.ones(len(known), dtype=bool), strength)
    out = {}
    for i, values in stats.items():
        score = np.clip(features(values[None, :]) @ final, -1, 2)[0]
        level = np.interp(score, knots / model.GRID, levels)
        out[i] = min(1.0, max(0.0, 0.998 * level + 0.002 * (score + 1) / 3))
    return out


def test_quality_scores_equal_whole_matrices(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    known = {r.doc_id: r.quality for r in labels.collect()}
    want = _by_hand(texts, known)
    found = model.quality_scores(docs.repartition(5), labels).collect()
    assert len(found) == len(want)
    # Sums in another order move a raw score across a thousandth now and then.
    far = [r.doc_id for r in found if abs(r.score - want[r.doc_id]) > 1e-3]
    assert len(far) <= len(want) // 50
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)


def test_isotonic_equals_the_min_max_formula():
    rng = np.random.default_rng(4)
    for n in (1, 2, 7, 40):
        values, weights = rng.random(n), rng.integers(1, 9, n).astype(float)
        assert np.allclose(model.isotonic(values, weights), _monotone(values, weights))


def test_log_ratios_equal_a_plain_count(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    target = {r.doc_id for r in trusted(labels).collect()}
    texts = {r.doc_id: WORD.findall(r.text or "") for r in docs.collect()}
    pairs = {(w, None) for words in texts.values() for w in words}
    pairs |= {pair for words in texts.values() for pair in zip(words, words[1:])}
    frame = spark.createDataFrame(sorted(pairs, key=repr), "a string, b string")
    hashed = F.when(F.col("b").isNull(), F.xxhash64("a")).otherwise(F.xxhash64("a", "b"))
    bucket = {
        (r.a, r.b): r.h % quality_rules.BUCKETS for r in frame.select("a", "b", hashed.alias("h")).collect()
    }
    grams = {
        i: [bucket[w, None] for w in words] + [bucket[pair] for pair in zip(words, words[1:])]
        for i, words in texts.items()
    }
    raw, aim = Counter(), Counter()
    for i, found in grams.items():
        raw.update(found)
        if i in target:
            aim.update(found)
    share = sum(aim.values()) / sum(raw.values())
    smooth = quality_rules.SMOOTH
    ratio = {
        b: round(math.log((aim[b] + smooth) / (raw[b] * share + smooth)) * 1_000_000) / 1_000_000 for b in raw
    }
    rows = quality_rules.rules(docs, trusted(labels)).collect()
    assert len(rows) == len(texts)
    for row in rows:
        found = grams[row.doc_id]
        mean = sum(ratio[b] for b in found) / len(found) if found else 0.0
        assert abs(row.log_ratio - mean) < 1e-5
        if abs(mean - quality_rules.THRESHOLD) > 1e-5:
            assert row.kept == (not row.base_failed and mean >= quality_rules.THRESHOLD)


def test_features_of_many_rows_are_made_a_few_at_a_time():
    """The same numbers as at once, without holding several arrays of their size beside them."""
    n, d = 20_001, len(model.STATISTICS)
    stats = np.random.default_rng(5).normal(size=(n, d))
    features = model.Features(stats.mean(axis=0), stats.std(axis=0))
    tracemalloc.start()
    found = features(stats)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 1.3 * found.nbytes
    rng = np.random.default_rng(20_11)
    weights = rng.normal(size=(d, model.FEATURES)) / np.sqrt(d)
    shift = rng.uniform(0, 2 * np.pi, size=model.FEATURES)
    z = np.clip((stats - features.mean) / features.scale, -5, 5)
    assert np.allclose(found[:, :-1], np.sqrt(2 / model.FEATURES) * np.cos(z @ weights + shift), rtol=0, atol=1e-12)
    assert (found[:, -1] == 1).all() and features(stats[:0]).shape == (0, model.FEATURES + 1)


def test_texts_are_read_a_few_rows_at_once(spark, tmp_path, monkeypatch):
    """While their statistics are made, not after; a limit of the session's own is left."""
    limit = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(limit, None)
    spark.range(0, 1_000, 1, 1).selectExpr("id AS doc_id", "repeat('some words ', id) AS text").write.parquet(f"{tmp_path}/documents")
    docs = spark.read.parquet(f"{tmp_path}/documents")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 AS int) AS quality")
    held = []

    def noted(df):
        held.append(spark.conf.get(limit, None))
        return cut(df)

    monkeypatch.setattr(model, "cut", noted)
    try:
        spark.conf.unset(limit)
        scores = model.quality_scores(docs, labels)
        assert held[0] == str(ROWS_READ) and held[1:] == [None] and spark.conf.get(limit, None) is None
        found = {r.doc_id: r.score for r in scores.collect()}
        assert len(found) == 1_000
        with pytest.raises(ZeroDivisionError), few_rows_read(spark):
            1 / 0
        assert spark.conf.get(limit, None) is None

        held.clear()
        spark.conf.set(limit, "1000")
        assert {r.doc_id: r.score for r in model.quality_scores(docs, labels).collect()} == found
        assert held == ["1000", "1000"] and spark.conf.get(limit) == "1000"
    finally:
        spark.conf.unset(limit) if before is None else spark.conf.set(limit, before)
