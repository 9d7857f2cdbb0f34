from __future__ import annotations

import zlib

from perkflow.llm import language
from perkflow.llm.queries import QUERIES


def test_held_out_accuracy(spark, sf_dir):
    big = sf_dir.replace("sf0.001", "sf0.01")
    rows = QUERIES["op5_language_id"](spark, big).toPandas()
    docs = spark.read.parquet(f"{big}/documents.parquet").select("doc_id", "lang").toPandas()
    both = rows.merge(docs, on="doc_id")
    assert len(rows) == len(docs)
    fold = rows.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)
    assert (rows.held_out == fold).all() and rows.score.between(0, 1).all()
    held = both[both.held_out]
    assert len(held) > 100 and (held.lang_pred == held.lang).mean() > 0.98


def test_kernel_is_the_normalised_number_of_shared_grams():
    texts, langs = ["abc abd", "xyz xyy", "abx"], ["p", "q", "p"]
    model = language.fit(texts, langs, landmarks=2)
    table = model.letter_ids

    def grams(text):
        return set(language.presence(text, table).nonzero()[0].tolist())

    bags = language.presence("abd", table)[model.features] / len(grams("abd")) ** 0.5
    wanted = len(grams("abd") & grams(texts[0])) / (len(grams("abd")) * len(grams(texts[0]))) ** 0.5
    assert abs((model.landmarks @ bags)[0] - wanted) < 1e-6


def test_whole_long_text_decides():
    texts = ["der und die ist nicht"] * 20 + ["the and of that with"] * 20
    model = language.fit(texts, ["de"] * 20 + ["en"] * 20, landmarks=5)
    long = "the " * 100 + "und die der ist nicht eine " * 50_000
    assert language.predict(model, [long, "", None, "123 !", "THE OF"])[0] == ["de", "und", "und", "und", "en"]
    assert language.predict(model, ["", None])[1] == [0.0, 0.0]


def test_nulls_repeats_empty_tables_and_extra_columns(spark, make_docs):
    docs = make_docs(
        [(i, "der und die ist" if i % 2 else "the and of that", "de" if i % 2 else "en") for i in range(60)]
        + [(None, "der und", None), (3, "der und die ist", None), (99, None, "fr"), (98, "", "de")]
    )
    model = language.train(docs)
    found = {(r.doc_id, r.lang_pred) for r in language.identify(docs, model).collect()}
    assert {(None, "de"), (3, "de"), (99, "und"), (98, "und"), (2, "en")} <= found
    empty = language.train(docs.limit(0))
    assert {r.lang_pred for r in language.identify(docs, empty).collect()} == {"und"}
    assert language.identify(docs.limit(0), model).count() == 0


def test_labels_of_the_held_out_fold_teach_nothing(make_docs):
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    docs = make_docs([(i, "abc def", "xx") for i in held] + [(i, "ghi jkl", "yy") for i in range(400) if i not in held])
    assert language.train(docs).languages == ["yy"]


def test_languages_with_many_letters_are_told_apart():
    # Two languages with the same number of letters, none of which is among the commonest of the sample.
    scripts = {"p": range(0x4E00, 0x4E00 + 400), "q": range(0x5E00, 0x5E00 + 400)}
    fixed = "".join(chr(0x0430 + i) * 40 for i in range(31)) + "".join(chr(0x0561 + i) * 40 for i in range(31))

    def text(lang, seed):
        letters = scripts[lang]
        return fixed + " " + "".join(chr(letters[(seed * 7 + i * 11) % 400]) for i in range(120))

    texts = [(text(lang, seed), lang) for seed in range(20) for lang in "pq"]
    model = language.fit([t for t, _ in texts], [lang for _, lang in texts], landmarks=5)
    held = [(text(lang, seed), lang) for seed in range(100, 120) for lang in "pq"]
    assert language.predict(model, [t for t, _ in held])[0] == [lang for _, lang in held]


def test_long_texts_go_piece_by_piece(monkeypatch):
    table = language.letter_table()
    text = "Der Fluß fließt, und ÉTÉ revient! 漢字かな " * 40
    whole = language.presence(text, table)
    monkeypatch.setattr(language, "_PIECE", 7)
    assert (language.presence(text, table) == whole).all()


def test_text_ids(spark):
    rows = [(f"doc-{i}", "der und die ist" if i % 2 else "the and of that", "de" if i % 2 else "en") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, lang string")
    assert {r.lang_pred for r in language.identify(docs, language.train(docs)).collect()} == {"de", "en"}
