import base64
import gzip
import hashlib
from pathlib import Path

import pytest

from inkstrata.llm import warc

SCHEMA = "page_id bigint, url string, html string, digest string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "own") for i, u, h in rows], SCHEMA).repartition(3)


def digest(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


ROWS = [
    (5, "http://a/", "<p>same</p>"),
    (2, "http://b/\r\nx: y", "<p>same</p>"),
    (9, None, "<p>same</p>"),
    (1, "http://c/", "é€😀" * 50_000),
    (3, "http://d/", "WARC/1.1\r\nWARC-Type: x\r\n\r\n" * 10 + "WARC/1.1"),
    (4, "http://e/", None),
    (6, "http://f/", ""),
    (7, "http://g/", "\r\n\r\nends with breaks\r\n\r\n\r\n"),
    (7, "http://g/", "\r\n\r\nends with breaks\r\n\r\n\r\n"),
    (8, "http://h/", "é€😀" * 50_000),
    (10, "http://x/WARC/1.1", "the mark in a header"),
    (11, "http://x/WARC/1.1\r\nWARC-Type: %41 WARC/1.1", "the mark in a header"),
]


def read(spark, path, rows, **options):
    warc.write_archives(pages(spark, rows), path, **options)
    return sorted((tuple(r) for r in warc.read_archives(spark, path).collect()), key=str)


@pytest.mark.parametrize("chunk", [10, 1000, 64 << 10])
def test_round_trip(spark, tmp_path, chunk):
    got = read(spark, str(tmp_path / "out"), [(i, u, h if chunk > 10 else (h or "")[:500]) for i, u, h in ROWS], chunk=chunk)
    want = []
    for i, _, h in ROWS:
        text = (h or "") if chunk > 10 else (h or "")[:500]
        first = min(j for j, _, g in ROWS if (g or "") == (h or ""))
        kind = "response" if i == first else "revisit"
        want.append((str(i), len(text.encode()), digest(text), kind, None if i == first else str(first)))
    assert got == sorted(want, key=str)


def test_small_payloads_may_all_be_responses(spark, tmp_path):
    got = read(spark, str(tmp_path / "out"), ROWS, least=100)
    assert [r[0] for r in got if r[3] == "revisit"] == ["8"]


def test_ids_of_any_characters_come_back(spark, tmp_path):
    ids = ["a", "WARC/1.1", "x\r\nWARC/1.1", "%41%", "é\x7f", " b "]
    rows = spark.createDataFrame([(i, None, f"payload {n % 5}") for n, i in enumerate(ids)], "page_id string, url string, html string")
    warc.write_archives(rows, str(tmp_path / "out"))
    got = {r.page_id: r.refers_to for r in warc.read_archives(spark, str(tmp_path / "out")).collect()}
    assert set(got) == set(ids) and got[max(" b ", "a")] == min(" b ", "a")


def test_rows_without_an_id_and_empty_table(spark, tmp_path):
    got = read(spark, str(tmp_path / "a"), [(None, "u", "x"), (1, "u", "x"), (None, "u", "x")])
    assert sorted(r[3] for r in got) == ["response"] * 3 and sorted(map(str, (r[0] for r in got))) == ["1", "None", "None"]
    assert read(spark, str(tmp_path / "b"), []) == []


def test_files_are_archives(spark, tmp_path):
    warc.write_archives(pages(spark, ROWS[:3]), str(tmp_path / "out"))
    data = b"".join(gzip.decompress(p.read_bytes()) for p in Path(tmp_path / "out").glob("part-*"))
    records = data.split(b"WARC/1.1\r\n")[1:]
    assert len(records) == 3
    for record in records:
        head, _, body = record.partition(b"\r\n\r\n")
        size = int(dict(line.split(b": ", 1) for line in head.split(b"\r\n"))[b"Content-Length"])
        assert body[size:] == b"\r\n\r\n"


def test_damage_is_noticed(spark, tmp_path):
    warc.write_archives(pages(spark, [(1, "u", "payload")]), str(tmp_path / "out"))
    path = next(Path(tmp_path / "out").glob("part-*.gz"))
    text = gzip.decompress(path.read_bytes()).replace(b"payload", b"damaged")
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.warc").write_bytes(text)
    with pytest.raises(Exception, match="does not match"):
        warc.read_archives(spark, str(tmp_path / "bad")).collect()
