from __future__ import annotations

import hashlib
import io
import struct
from pathlib import Path

import pytest
import zstandard as zstd

from perkflow.llm import warc
from perkflow.llm.queries import QUERIES

SCHEMA = "page_id long, url string, html string, digest string, payload string, record_type string"


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "d", "p", "t") for i, u, h in rows], SCHEMA)


def expected(rows):
    """Rows that the contract asks for, by plain Python."""
    first = {}
    for number, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and number is not None:
            first[data] = min(first.get(data, number), number)
    out = []
    for number, _, html in rows:
        data = (html or "").encode()
        other = first.get(data)
        revisit = other is not None and number != other
        out.append((number, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", other if revisit else None))
    return sorted(out, key=repr)


def test_query_round_trip(spark, sf_dir):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op9_warc"](spark, sf_dir).collect()), key=repr) == expected(rows)


def test_edge_cases(spark):
    long, same = "é" * 400_000, "x" * 100
    rows = [(3, "http://a/", same), (2, None, same), (9, "u\r\nWARC-Type: evil", same), (4, "é b", "x" * 99), (5, "e", "x" * 99),
            (6, "e", None), (7, "e", ""), (8, "e", long), (10, "e", long), (11, "e", "\r\n\r\nWARC/1.1"), (None, "n", same),
            (2, None, same), (None, None, "z" * 300)]
    out = warc.round_trip(pages_of(spark, rows))
    assert out.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, out.collect()), key=repr) == expected(rows)
    assert warc.round_trip(pages_of(spark, [])).count() == 0


def test_payloads_and_urls_come_back(spark, tmp_path):
    rows = [(i, f"http://h/{i}?q=a b", f"<p>{i} häuser " + "w " * 80) for i in range(300)]
    folder = str(tmp_path / "archive")
    manifest = warc.write_archives(pages_of(spark, rows), folder)
    found = warc.read_archives(manifest, folder).filter("record_type = 'response'").collect()
    assert {r.page_id: bytes(r.payload).decode() for r in found} == {i: h for i, _, h in rows}
    assert {r.target_uri for r in found} == {u.replace(" ", "%20") for _, u, _ in rows}
    assert sum(r.records for r in manifest.collect()) == 300
    start = Path(manifest.first().path).read_bytes()
    assert struct.unpack("<I", start[:4])[0] == 0x184D2A5D  # the dictionary leads


def test_archives_are_split_by_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    rows = [(i, "u", hashlib.sha256(str(i).encode()).hexdigest() * 8) for i in range(60)]
    folder = str(tmp_path / "archive")
    manifest = warc.write_archives(pages_of(spark, rows).coalesce(1), folder)
    assert manifest.count() > 5
    assert warc.read_archives(manifest, folder).filter("record_type = 'response'").count() == 60


def archive(*records, dictionary=b"", squeeze=False):
    used = zstd.ZstdCompressionDict(dictionary) if dictionary else None
    press = zstd.ZstdCompressor(dict_data=used)
    lead = zstd.ZstdCompressor().compress(dictionary) if squeeze else dictionary
    return (warc.dictionary_frame(lead) if dictionary else b"") + b"".join(map(press.compress, records))


def good(payload=b"hello"):
    return warc.record(7, "http://x/", payload, hashlib.sha256(payload).hexdigest(), None, False)


@pytest.mark.parametrize("squeeze", [False, True])
def test_dictionaries_plain_and_compressed(squeeze):
    dictionary = b"a dictionary of raw bytes for records " * 3
    data = archive(good(), good(b"b"), dictionary=dictionary, squeeze=squeeze)
    assert [warc.parse(d)["payload"] for _, d in warc.frames(io.BytesIO(data))] == [b"hello", b"b"]


@pytest.mark.parametrize(
    ("change", "reason"),
    [
        (lambda d: d.replace(b"WARC/1.1", b"HTTP/1.1", 1), "version"),
        (lambda d: d.replace(b"WARC-Date: ", b"X-Date: "), "missing headers: WARC-Date"),
        (lambda d: d + b"x", "declared"),
        (lambda d: d[:-4] + b"abcd", "declared"),
        (lambda d: d.replace(b"hello", b"hallo"), "digest"),
        (lambda d: d.replace(b"Content-Length: 5", b"Content-Length: 6"), "payload of 5 bytes"),
        (lambda d: d.replace(b"sha256:", b"md5:"), "declared|SHA-256"),
        (lambda d: d.replace(b"WARC-Date: ", b"WARC-Date "), "colon|missing"),
    ],
)
def test_broken_records_say_why(change, reason):
    with pytest.raises(ValueError, match=reason):
        warc.parse(change(good()))


def test_errors_become_rows(spark, tmp_path):
    whole = archive(good(), good(b"x").replace(b"WARC-Date", b"X"), good(b"y"))
    (tmp_path / "a.warc.zst").write_bytes(whole)
    (tmp_path / "b.warc.zst").write_bytes(archive(good(), good())[:-5])
    (tmp_path / "c.warc.zst").write_bytes(b"")
    (tmp_path / "d.warc.zst").write_bytes(b"no archive at all")
    names = spark.createDataFrame([(str(tmp_path / f"{n}.warc.zst"),) for n in "abcd"], "path string")
    rows = warc.read_archives(names, str(tmp_path)).collect()
    found = {(Path(r.path).name[0], r.position, r.error is None) for r in rows}
    assert found == {("a", 0, True), ("a", 1, False), ("a", 2, True), ("b", 0, True), ("b", 1, False), ("d", 0, False)}


def test_the_dictionary_sample_does_not_follow_the_tasks(spark, monkeypatch):
    """The driver gets the dictionary; pages are gathered in one task, as many with 64 tasks as with 8."""
    from perkflow.llm import warc

    rows = [(i, f"u{i}", f"<p>page {i % 700} " + "words of a page " * 40) for i in range(1400)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    gathered = []
    real = warc.learned
    monkeypatch.setattr(warc, "learned", lambda sample, fit: gathered.append(sample.count()) or real(sample, fit))
    found = {warc.train_dictionary(pages.repartition(n)) for n in (8, 64)}
    assert len(found) == 1 and gathered == [warc.SAMPLE_PAGES] * 2


def test_paths_without_a_scheme_are_those_of_spark(spark, tmp_path):
    from perkflow.llm import warc
    from perkflow.sources import files

    assert files.qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    assert warc._store(f"file:{tmp_path}")[1] == warc._store(f"file://{tmp_path}")[1] == str(tmp_path)
