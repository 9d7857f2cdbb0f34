from __future__ import annotations

from perkflow.llm import license_scan
from perkflow.llm.queries import QUERIES
from tests.llm.conftest import sentence


def test_query_finds_the_lines(spark, sf_dir):
    big = sf_dir.replace("sf0.001", "sf0.01")
    found = QUERIES["op7_license_scan"](spark, big).collect()
    lines = {
        "Licensed under the Apache License, Version 2.0.": "apache-2.0",
        "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0",
        "Released under the MIT License.": "mit",
        "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0",
    }
    wanted = sorted(
        (r.doc_id, n, lines[line])
        for r in spark.read.parquet(f"{big}/documents.parquet").collect()
        for n, line in enumerate(r.text.split("\n"))
        if line in lines
    )
    assert sorted((r.doc_id, r.line_no, r.license) for r in found) == wanted and wanted


def one(text):
    return license_scan.Scanner(license_scan.WORDINGS).scan(text)


def test_each_wording_finds_itself(rng):
    for name, texts in license_scan.WORDINGS.items():
        for number, text in enumerate(texts):
            found = one(text.upper())
            assert (found[0], found[3]) == (name, 0), text
            assert one(f"{sentence(rng, 30)} {text} {sentence(rng, 30)}")[0] == name
            assert 0 < found[2] < 1 and number >= 0


def test_wording_differences_decide():
    assert one("This work is licensed under the GNU General Public License, version 2.")[0] == "gpl-2.0"
    assert one("Licensed under CC BY-SA 4.0.")[0] == "cc-by-sa-4.0"
    assert one("Licensed under the new MIT License.")[:1] + one("Licensed under the new MIT License.")[3:4] == ("mit", 1)
    assert one("You need a licence to drive this car on the roads of the town") is None
    assert one("") is None and one("...") is None


def test_nulls_repeats_long_texts_empty_tables_and_extra_columns(spark, make_docs, rng):
    line = "Released under the MIT License."
    long = "\n".join([sentence(rng, 40)] * 3000 + [line, "", line])
    docs = make_docs([(1, line, None), (1, line, None), (None, line, None), (2, None, None), (3, "", None), (4, long, None),
                      (5, f"text\r\n{line}\r\n", None)])
    out = license_scan.scan(docs)
    assert out.columns == ["doc_id", "line_no", "license", "wording", "saved", "differences", "first_word"]
    found = sorted(((r.doc_id, r.line_no) for r in out.collect()), key=repr)
    assert found == sorted([(1, 0), (1, 0), (None, 0), (4, 3000), (4, 3002), (5, 1)], key=repr)
    assert license_scan.scan(docs.limit(0)).count() == 0


def test_wordings_wrapped_over_lines_with_comment_markers():
    scanner = license_scan.Scanner(license_scan.WORDINGS)
    for name, texts in license_scan.WORDINGS.items():
        for number, text in enumerate(texts):
            words = text.split()
            lines = [" * " + " ".join(words[i : i + 6]) for i in range(0, len(words), 6)]
            found = scanner.scan_text("/*\n" + "\n".join(lines) + "\n */\nint main;")
            assert [(f[0], f[1], f[2], f[4], f[5]) for f in found] == [(1, name, number, 0, 0)]


def test_every_wording_of_a_text_without_line_breaks(rng):
    texts = [(name, text) for name, all_of in license_scan.WORDINGS.items() for text in all_of]
    text = " ".join(f"{sentence(rng, 80)} {wording}" for _, wording in texts)
    found = license_scan.Scanner(license_scan.WORDINGS).scan_text(text)
    assert [f[1] for f in found] == [name for name, _ in texts] and {f[4] for f in found} == {0}
    both = "Licensed under the MIT License. Licensed under the Apache License, Version 2.0."
    assert [f[1] for f in license_scan.Scanner(license_scan.WORDINGS).scan_text(both)] == ["mit", "apache-2.0"]


def edited(rng, words, changes):
    """Words with so many of them changed, left out or joined by another one."""
    words = list(words)
    for at in sorted(rng.sample(range(len(words)), changes), reverse=True):
        kind = rng.randrange(3)
        words[at : at + 1] = [[f"w{rng.randrange(99)}"], [], [words[at], f"w{rng.randrange(99)}"]][kind]
    return words


def test_compression_keeps_what_the_exact_differences_confirm(rng):
    """Recall of the bound on saved bytes, over all wordings with up to all differences allowed."""
    scanner = license_scan.Scanner(license_scan.WORDINGS, least_saved=-1.0)
    tried = kept = out = 0
    for wording in scanner.known:
        text = license_scan._WORD.findall(license_scan.WORDINGS[wording.name][wording.number].lower())
        for _ in range(25):
            run = edited(rng, text, rng.randint(0, wording.most))
            words = sentence(rng, 30).split() + run + sentence(rng, 30).split()
            for saved, found, low, high in scanner.ranked(words):
                true = bool(license_scan.runs_of(found, license_scan._codes(words[low:high])))
                tried += true
                kept += true and saved >= license_scan.LEAST_SAVED
                out += not true and saved < license_scan.LEAST_SAVED
    assert tried > 1000 and kept / tried >= 0.99


def test_scan_equals_brute_force_over_all_wordings(spark, sf_dir, rng):
    """On the given texts and on planted ones; a wording may only be missing where a better one overlaps."""
    scanner = license_scan.Scanner(license_scan.WORDINGS)
    texts = [r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    for wording in scanner.known:
        words = license_scan._WORD.findall(license_scan.WORDINGS[wording.name][wording.number].lower())
        texts.append(" ".join([sentence(rng, 20), *edited(rng, words, wording.most), sentence(rng, 20)]))
    lost = total = 0
    for text in texts:
        words = license_scan._WORD.findall(text.lower())
        every = [
            (n, low, high) for n, w in enumerate(scanner.known) for _, low, high in license_scan.runs_of(w, license_scan._codes(words))
        ] if len(words) < 3000 else []
        taken = [(p.start, p.end) for p in scanner.confirmed(words)]
        total += len(every)
        lost += sum(all(high <= a or b <= low for a, b in taken) for _, low, high in every)
    assert total > 50 and lost <= 0.01 * total


def test_wordings_without_a_cue_word_are_found():
    assert one("Released under CC BY 4.0.")[:2] + one("Released under CC BY 4.0.")[3:4] == ("cc-by-4.0", 0, 1)
    assert one("Distributed under CC BY-SA 4.0.")[0] == "cc-by-sa-4.0"


def test_repeated_notices_take_linear_time():
    import time

    scanner = license_scan.Scanner(license_scan.WORDINGS)
    notice = "This work is licensed under the GNU General Public License, version 3. "
    start = time.perf_counter()
    assert len(scanner.scan_text(notice * 400)) == 400
    few = time.perf_counter() - start
    start = time.perf_counter()
    assert len(scanner.scan_text(notice * 1600)) == 1600
    assert time.perf_counter() - start < 8 * few + 0.5
