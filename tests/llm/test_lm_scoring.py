from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from perkflow.llm import lm_scoring
from perkflow.llm.queries import QUERIES
from tests.llm.conftest import sentence


def brute(docs, target, others=()):
    """Scores by plain Python with the formula of the module; `others` are scored but not counted."""
    texts = {i: "".join(c if c.isalnum() else " " for c in (t or "").lower()).split() for i, t in [*docs, *others]}
    corpus = [i for i, _ in docs]
    size = len({w for i in corpus for w in texts[i]}) + 1

    def pairs(words):
        return zip([None, *words], words)

    def model(ids):
        unigram = Counter(w for i in ids for w in texts[i])
        counts = Counter(p for i in ids for p in pairs(texts[i]))
        number, opened, direct = sum(unigram.values()), {}, {}
        for (a, _), n in counts.items():
            opened[a] = opened.get(a, 0) + n
        opened = {a: max(unigram[a], n) for a, n in opened.items()}
        for (a, b), n in counts.items():
            direct[a, b] = max(n - lm_scoring.DISCOUNT, 0) / max(opened[a], 1)
        used = Counter()
        for (a, _), p in direct.items():
            used[a] += p

        def loss(a, b):
            back = max(1 - used[a], 1e-9) * (unigram[b] + 1) / (number + size)
            return -math.log(back + direct.get((a, b), 0))

        return loss

    losses = model([i for i in corpus if i in set(target)]), model(corpus)
    return {
        i: tuple(sum(f(a, b) for a, b in pairs(t)) / len(t) for f in losses) if t else (None, None)
        for i, t in texts.items()
    }


@pytest.mark.parametrize("block, part", [(1 << 21, 1 << 20), (3_000, 2_000), (200, 50_000)])
def test_query_equals_brute_force(spark, sf_dir, monkeypatch, block, part):
    """With the shipped parameters and with many blocks and parts."""
    monkeypatch.setattr(lm_scoring, "BLOCK_WORDS", block)
    monkeypatch.setattr(lm_scoring, "PART_WORDS", part)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1").collect()
    wanted = brute(docs, [r.doc_id for r in labels])
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    target = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1")
    rows = lm_scoring.score(frame, lm_scoring.train(frame, target)).collect()
    assert len(rows) == len(docs)
    for row in rows:
        assert (row.loss_target, row.loss_background) == pytest.approx(wanted[row.doc_id], abs=1e-9)
        assert row.ce_diff == pytest.approx(row.loss_target - row.loss_background)
    if block == 200:
        query = {r.doc_id: r.ce_diff for r in QUERIES["op1_lm_scoring"](spark, sf_dir).collect()}
        assert query == {r.doc_id: None if r.ce_diff is None else pytest.approx(r.ce_diff, abs=1e-6) for r in rows}


def test_documents_outside_the_corpus_are_scored_and_not_counted(spark, make_docs, rng, monkeypatch):
    monkeypatch.setattr(lm_scoring, "BLOCK_WORDS", 100)
    docs = [(i, sentence(rng, 40)) for i in range(30)]
    others = [(100 + i, docs[i][1] + " " + sentence(rng, 10)) for i in range(9)] + [(200, "never seen before")]
    corpus, new = (make_docs([(i, t, None) for i, t in rows]) for rows in (docs, others))
    scorer = lm_scoring.train(corpus, corpus.filter("doc_id < 8"))
    wanted = brute(docs, range(8), others)
    found = lm_scoring.score(new, scorer).collect()
    assert sorted(r.doc_id for r in found) == [i for i, _ in others]
    for row in found:
        assert (row.loss_target, row.loss_background) == pytest.approx(wanted[row.doc_id], abs=1e-9)


def test_many_targets_are_joined_without_a_broadcast(spark, make_docs, rng, monkeypatch):
    docs = [(i, sentence(rng, 30)) for i in range(40)]
    frame = make_docs([(i, t, None) for i, t in docs])
    monkeypatch.setattr(lm_scoring, "MOST_IDS", 3)
    wanted = brute(docs, range(20))
    for row in lm_scoring.score(frame, lm_scoring.train(frame, frame.filter("doc_id < 20"))).collect():
        assert (row.loss_target, row.loss_background) == pytest.approx(wanted[row.doc_id], abs=1e-9)


def test_packed_arrays_come_back(rng):
    arrays = [np.arange(70_000, dtype=np.int64) - 5, np.zeros(0, np.int32), np.array([True, False]), np.array([1 << 63], np.uint64)]
    for before, after in zip(arrays, lm_scoring.unpacked(lm_scoring.packed(*arrays))):
        assert before.dtype == after.dtype and (before == after).all()
    assert len(lm_scoring.packed(arrays[0])) < 20_000


def test_target_like_documents_score_low(spark, make_docs, rng):
    def text(words):
        return " ".join(rng.choice(words) for _ in range(60))

    near, far = "red green blue the of".split(), "cat dog cow the of".split()
    docs = make_docs([(i, text(near if i % 2 else far), None) for i in range(200)])
    target = docs.filter("doc_id % 4 = 1").select("doc_id", "score")
    found = {r.doc_id: r.ce_diff for r in lm_scoring.score(docs, lm_scoring.train(docs, target)).collect()}
    assert max(v for i, v in found.items() if i % 2) < min(v for i, v in found.items() if i % 2 == 0)


def test_losses_sum_to_one(spark, make_docs):
    """Over the vocabulary and one unknown word, after every word of it."""
    corpus = make_docs([(1, "a b a b c", None), (2, "b c a a", None)])
    scorer = lm_scoring.train(corpus, corpus.filter("doc_id = 1").select("doc_id"))
    words = ["a", "b", "c", "zzz"]
    texts = words + [f"{v} {w}" for v in words for w in words]
    found = {r.doc_id: r for r in lm_scoring.score(make_docs([(i, t, None) for i, t in enumerate(texts)]), scorer).collect()}
    for which in ("loss_target", "loss_background"):
        for v in range(4):
            alone = found[v][which]
            total = sum(math.exp(alone - 2 * found[4 + 4 * v + w][which]) for w in range(4))
            assert total == pytest.approx(1, abs=1e-9)


def test_nulls_repeats_long_texts_empty_tables_and_extra_columns(spark, make_docs):
    docs = make_docs([(1, "a b", None), (1, "a b", None), (None, "a", None), (2, None, None), (3, "..", None), (4, "a b c " * 60_000, None)])
    nobody = docs.limit(0).select("doc_id")
    out = lm_scoring.score(docs, lm_scoring.train(docs, nobody))
    assert out.columns == ["doc_id", "n_tokens", "loss_target", "loss_background", "ce_diff"]
    rows = out.collect()
    assert sorted((r.n_tokens for r in rows)) == [0, 0, 1, 2, 2, 180_000]
    assert all((r.ce_diff is None) == (r.n_tokens == 0) for r in rows)
    empty = docs.limit(0)
    assert lm_scoring.score(empty, lm_scoring.train(empty, nobody)).count() == 0
    repeated = docs.select("doc_id").union(docs.select("doc_id"))
    assert lm_scoring.score(docs, lm_scoring.train(docs, repeated)).count() == 6


def test_rare_words_and_bigrams_take_part_at_every_size(spark, make_docs, monkeypatch):
    monkeypatch.setattr(lm_scoring, "BLOCK_WORDS", 3_000)
    common = [(i, "a b c d " * 500, None) for i in range(100, 160)]
    docs = [(1, "rare topic here", None), (2, "other topic there", None), *common]
    frame = make_docs(docs)
    found = lm_scoring.score(frame, lm_scoring.train(frame, frame.filter("doc_id = 1").select("doc_id"))).collect()
    wanted = brute([d[:2] for d in docs], [1])
    assert len(found) == len(docs)
    for row in found:
        assert (row.loss_target, row.loss_background) == pytest.approx(wanted[row.doc_id], abs=1e-9)
    losses = {r.doc_id: r.loss_background for r in found}
    assert len({round(losses[i], 9) for i in (1, 2)}) == 1 and losses[1] < 12
    assert {r.doc_id for r in found if r.ce_diff == min(x.ce_diff for x in found)} == {1}


def test_blocks_stay_and_answers_move(spark, make_docs, rng):
    docs = make_docs([(i, sentence(rng, 30), None) for i in range(40)])
    scorer = lm_scoring.train(docs, docs.limit(3))
    with lm_scoring._by_block(lm_scoring._blocks(lm_scoring._marked(scorer), True, True), "blocks") as blocks:
        known = lm_scoring.answers(lm_scoring._asked_pairs(blocks, 2), 1).filter("block is not null")
        joined = lm_scoring._with_pairs(blocks, known, 2)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(block") == 1 and joined.count() == blocks.count()
