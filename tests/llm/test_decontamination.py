from __future__ import annotations

import numpy as np
import pytest

from perkflow.llm import decontamination
from perkflow.llm.queries import QUERIES
from tests.llm.conftest import sentence


def spread(rng, words, share):
    """The words with a share of them replaced, left out or doubled."""
    words = list(words)
    for _ in range(int(share * len(words))):
        at = rng.randrange(len(words))
        words[at : at + 1] = rng.choice([["edited"], [], [words[at], "added"]])
    return words


def bench(spark, items):
    schema = "item_id int, text string, doc_id long"
    return spark.createDataFrame([(i, t, 1) for i, t in items], schema)


def distance(item, text):
    """Fewest edits between the item and any run of words of the text."""
    row = [0] * (len(text) + 1)
    for i, word in enumerate(item, 1):
        new = [i]
        for j, other in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (word != other)))
        row = new
    return min(row)


def test_query_equals_brute_force(spark, sf_dir):
    found = QUERIES["op4_decontamination"](spark, sf_dir).collect()
    words = lambda t: "".join(c if c.isalnum() else " " for c in t.lower()).split()
    docs = [(r.doc_id, words(r.text)) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r.item_id, words(r.text)) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    wanted = set()
    for number, text in docs:
        known = set(text)
        for item_id, item in items:
            most = int(0.2 * len(item))
            if len(set(item) - known) <= most and distance(item, text) <= most:
                wanted.add((number, item_id))
    assert {(r.doc_id, r.item_id) for r in found} == wanted and len(found) == len(wanted)


@pytest.mark.parametrize(("share", "recall"), [(0.0, 1.0), (0.1, 0.99), (0.2, 0.93)])
def test_recall_under_edits(rng, share, recall):
    items = [(i, sentence(rng, rng.randint(13, 60)).split()) for i in range(120)]
    codes = {}

    def hashed(words):
        return np.array([codes.setdefault(w, hash(w) & (1 << 62) - 1) for w in words], np.uint64)

    index = decontamination.build_index([(i, hashed(w)) for i, w in items], decontamination.STRIDE)
    docs = [
        hashed(sentence(rng, rng.randint(0, 200) + 1).split() + spread(rng, w, share) + sentence(rng, 50).split())
        for _, w in items
    ]
    found = decontamination.matches(docs, index)
    hits = [any(row[0] == i for row in rows) for (i, _), rows in zip(items, found)]
    assert np.mean(hits) >= recall


def test_edits_are_exact(rng):
    for _ in range(60):
        item = [rng.randrange(6) for _ in range(rng.randint(1, 8))]
        text = [rng.randrange(6) for _ in range(rng.randint(0, 20))]
        found, _ = decontamination.edits(np.array(item), np.array(text, np.int64))
        assert found == distance(item, text)


def test_edge_cases(spark, make_docs, rng):
    long, item = sentence(rng, 60_000), sentence(rng, 30)
    items = [(1, item), (2, item), (3, "short one"), (4, None), (5, "!!"), (6, "word")]
    docs = make_docs([(1, f"{long} {item} {long}", None), (2, None, None), (3, "", None), (None, item, None),
                      (4, "a SHORT, one.", None), (4, "a SHORT, one.", None), (5, "no match here", None)])
    found = decontamination.contamination(docs, bench(spark, items))
    assert found.columns == ["doc_id", "item_id", "word_start", "edits", "n_words"]
    pairs = sorted(((r.doc_id, r.item_id, r.word_start, r.edits) for r in found.collect()), key=repr)
    assert pairs == sorted(
        [(1, 1, 60_000, 0), (1, 2, 60_000, 0), (None, 1, 0, 0), (None, 2, 0, 0), (4, 3, 1, 0), (4, 3, 1, 0)], key=repr)
    kept = decontamination.uncontaminated(docs, bench(spark, items))
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 5]
    assert decontamination.contamination(docs, bench(spark, [])).count() == 0
    assert decontamination.contamination(docs.limit(0), bench(spark, items)).count() == 0


def test_blocks_of_items(spark, make_docs, rng, monkeypatch):
    monkeypatch.setattr(decontamination, "ITEMS", 3)
    items = [(i, sentence(rng, 20 if i % 2 else 6)) for i in range(10)]
    docs = make_docs([(i, t + " " + sentence(rng, 30), None) for i, t in items])
    found = decontamination.contamination(docs, bench(spark, items)).collect()
    assert {(i, i) for i, _ in items} <= {(r.doc_id, r.item_id) for r in found}


@pytest.mark.parametrize("end", ["first", "last"])
@pytest.mark.parametrize("size", [300, 700])
def test_long_items_with_all_edits_gathered_at_one_end(rng, end, size):
    def words(n):
        return np.array([rng.getrandbits(62) for _ in range(n)], np.uint64)

    items = [(i, words(size)) for i in range(30)]
    most = size // 5
    index = decontamination.build_index(items, decontamination.STRIDE)
    docs = []
    for _, item in items:
        kept = item[most:] if end == "first" else item[:-most]
        new = [words(most), kept] if end == "first" else [kept, words(most)]
        docs += [np.concatenate([words(rng.randint(1, 50)), *new, words(20)]), np.concatenate([words(7), kept])]
    found = decontamination.matches(docs, index)
    assert [[row[0] for row in rows] for rows in found] == [[i // 2] for i in range(60)]


def test_blocks_of_words(spark, rng, monkeypatch):
    monkeypatch.setattr(decontamination, "WORDS", 50)
    items = [(i, sentence(rng, n)) for i, n in enumerate([20, 20, 20, 300, 5, 20])]
    blocks = list(decontamination.item_blocks(bench(spark, items)))
    assert [[i for i, _ in block] for block in blocks] == [[4], [0, 1], [2], [3], [5]]
