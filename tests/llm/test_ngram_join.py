from __future__ import annotations

from itertools import combinations

import numpy as np
import pytest

from perkflow.llm import ngram_join
from perkflow.llm.common import components
from perkflow.llm.queries import QUERIES
from tests.llm.conftest import sentence


def brute(rows):
    """(class_id, n_links) per row by comparing all pairs of shingle sets."""
    def parts(text):
        words = "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()
        n = min(5, len(words))
        return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()

    sets = [parts(text) for _, text in rows]
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and both >= 0.8 * len(sets[a] | sets[b]):
            links[a] += 1
            links[b] += 1
            root[find(a)] = find(b)
    low = {}
    for i, (number, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), number), number)
    return sorted((rows[i][0], low[find(i)], links[i]) for i in range(len(rows)))


def edited(rng, text, changes):
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = "edit" + str(rng.randrange(9))
    return " ".join(words)


def test_query_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = QUERIES["op2_ngram_join"](spark, sf_dir).collect()
    assert sorted(map(tuple, found)) == brute([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("block", [512, 16])
def test_large_groups_in_blocks_lose_no_link(make_docs, rng, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    base = sentence(rng, 150)
    rows = [(i, edited(rng, base, rng.randint(0, 2))) for i in range(80)]
    rows += [(100 + i, base) for i in range(40)] + [(200 + i, sentence(rng, rng.randint(1, 60))) for i in range(60)]
    found = ngram_join.similarity_join(make_docs([(i, t, "en") for i, t in rows])).collect()
    assert sorted(map(tuple, found)) == brute(rows)


def test_edge_cases(make_docs, rng):
    long = sentence(rng, 30_000)
    rows = [(1, ""), (2, None), (3, "..."), (4, "One two"), (5, "one, TWO!"), (6, "one two three"),
            (7, long), (8, edited(rng, long, 5)), (9, "a b c d e"), (9, "a b c d e"), (10, "a b c d e")]
    found = ngram_join.similarity_join(make_docs([(i, t, None) for i, t in rows]))
    assert found.columns == ["doc_id", "class_id", "n_links"]
    assert sorted(map(tuple, found.collect())) == [
        (1, 1, 0), (2, 2, 0), (3, 3, 0), (4, 4, 1), (5, 4, 1), (6, 6, 0), (7, 7, 1), (8, 7, 1),
        (9, 9, 2), (9, 9, 2), (10, 9, 2)]
    none = ngram_join.similarity_join(make_docs([(None, "x y", None), (4, "x y", None), (None, "z", None)]))
    assert sorted(map(tuple, none.collect()), key=repr) == [(4, 4, 1), (None, 4, 1), (None, None, 0)]
    assert ngram_join.similarity_join(make_docs([])).count() == 0


def test_pruning_follows_the_posterior():
    least = ngram_join.least_matches()
    assert list(least) == list(range(16, 129, 16)) and all(least[n] < 0.8 * n for n in least)
    rng = np.random.default_rng(0)
    one = rng.integers(0, 256, 128).astype(np.uint8)
    near, far = one.copy(), rng.integers(0, 256, 128).astype(np.uint8)
    near[rng.choice(128, 24, replace=False)] ^= 1
    assert ngram_join.surviving(one, np.stack([near, far, one])).tolist() == [0, 2]


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 30)] + [(50, i) for i in range(51, 90)] + [(7, 3), (7, 7)]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.id: r.component_id for r in found} == {i: 1 for i in range(1, 31)} | {i: 50 for i in range(50, 90)}


def test_rows_that_repeat_an_id_with_other_texts_all_link(make_docs, rng):
    one, two = sentence(rng, 100), sentence(rng, 100)
    rows = [(1, one), (1, two), (2, one), (3, two), (4, edited(rng, one, 2)), (5, edited(rng, two, 2))]
    found = ngram_join.similarity_join(make_docs([(i, t, None) for i, t in rows])).collect()
    assert sorted(map(tuple, found)) == brute(rows) and {r.n_links for r in found} == {2}


def test_one_row_of_each_class_stays_and_no_text_is_lost(make_docs, rng):
    """Rows that repeat an id with other texts, and rows without id."""
    a, b, c = (sentence(rng, 40) for _ in range(3))
    rows = [(1, a), (2, a), (2, b), (None, a), (None, c), (None, c), (7, None), (8, ""), (8, ""), (None, "..")]
    docs = make_docs([(i, t, "en") for i, t in rows])
    kept = ngram_join.first_of_each_class(docs)
    assert kept.columns == docs.columns
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert found == sorted([(1, a), (2, b), (None, c), (7, None), (8, ""), (None, "..")], key=repr)
    assert ngram_join.first_of_each_class(docs.limit(0)).count() == 0


def test_rows_without_id_link_and_name_no_class(make_docs, rng):
    base = sentence(rng, 60)
    near = edited(rng, base, 1)
    rows = [(None, base), (5, near), (None, near), (None, "alone here"), (None, "alone here")]
    found = ngram_join.similarity_join(make_docs([(i, t, "en") for i, t in rows])).collect()
    assert sorted(map(tuple, found), key=repr) == sorted([(None, 5, 2), (5, 5, 2), (None, 5, 2), (None, None, 1), (None, None, 1)], key=repr)
