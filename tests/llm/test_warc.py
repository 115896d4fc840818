"""Archives: what is written is read back, with the right records referring to each other."""

import hashlib
import io
import struct
from pathlib import Path

import pytest
import zstandard
from pyspark.sql import functions as F

from claimledger.llm import warc
from claimledger.llm.common import table
from tests.conftest import SMALL

LONG = "<html>" + "long enough to be referred to " * 10


@pytest.fixture
def pages(spark):
    kinds = "page_id long, url string, html string, payload string, first long, file string"
    return lambda rows: spark.createDataFrame([(*r, "p", 1, "f") for r in rows], kinds)


def round_trip(pages, folder):
    files = warc.write_archives(pages, str(folder))
    return files, warc.read_archives(files).collect()


def test_round_trip(pages, tmp_path):
    rows = [(9, "http://a/", LONG), (3, "http://b/", LONG), (7, None, LONG), (1, "http://c/%41\r\nX: 日本 ", "short"), (2, "", "short")]
    rows += [(4, "u", None), (5, "u", ""), (6, "u", "é" * 50), (8, "u", "é" * 50), (10, "u", "x" * 99), (11, "u", "x" * 99)]
    rows += [(100 + i, "many", LONG + "\r\n\r\nWARC/1.1\r\n") for i in range(300)] + [(12, "big", "日本 big " * 400_000)]
    files, got = round_trip(pages(rows), tmp_path)
    assert files.agg(F.sum("records")).first()[0] == len(rows) == len(got)
    given = {r[0]: r for r in rows}
    for row in got:
        _, url, html = given[row.page_id]
        data = (html or "").encode()
        assert (row.url, row.payload_bytes, row.payload_digest) == (url, len(data), hashlib.sha256(data).hexdigest())
        least = min(r[0] for r in rows if (r[2] or "") == (html or "")) if len(data) >= 100 else row.page_id
        assert (row.record_type, row.refers_to) == (("response", None) if least == row.page_id else ("revisit", least))
        assert row.payload == (data if row.record_type == "response" else None)
    assert {r.page_id: r.refers_to for r in got if r.page_id in (6, 8, 10, 11)} == {6: None, 8: 6, 10: None, 11: None}


def test_repeated_and_missing_ids(pages, tmp_path):
    rows = [(5, "a", LONG), (5, "a", LONG), (6, "b", LONG), (None, "c", LONG), (None, "d", LONG + "!"), (None, "d", LONG + "!"), (None, None, None)]
    _, got = round_trip(pages(rows), tmp_path)
    told = sorted(((r.page_id, r.record_type, r.refers_to) for r in got), key=repr)
    assert told == sorted(
        [(5, "response", None)] * 2 + [(6, "revisit", 5), (None, "revisit", 5)] + [(None, "response", None)] * 3, key=repr
    )


def test_an_empty_table(pages, tmp_path):
    files, got = round_trip(pages([]), tmp_path)
    assert files.count() == 0 and got == []


def test_format_of_a_file(spark, tmp_path):
    """A leading skippable frame with the dictionary, and then one frame for each record."""
    files = warc.write_archives(table(spark, SMALL, "pages"), f"file://{tmp_path}")
    for name, count, size in files.collect():
        data = Path(name.removeprefix("file:")).read_bytes()
        assert len(data) == size
        magic, length = struct.unpack("<II", data[:8])
        assert magic == warc.DICTIONARY_MAGIC
        known = zstandard.ZstdCompressionDict(data[8 : 8 + length])
        assert known.dict_id()
        rest, seen = data[8 + length :], 0
        while rest:
            assert zstandard.get_frame_parameters(rest).dict_id == known.dict_id()
            one = zstandard.ZstdDecompressor(dict_data=known).decompressobj()
            text = one.decompress(rest)
            assert text.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and text.endswith(b"\r\n\r\n")
            rest, seen = one.unused_data, seen + 1
        assert seen == count
    assert not [p for p in tmp_path.iterdir() if p.name.startswith(".")]


def test_files_end_at_a_size(pages, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 5000)
    files, got = round_trip(pages([(i, "u", f"{i} {LONG}") for i in range(200)]).coalesce(1), tmp_path)
    assert len(got) == 200 and files.count() > 10


def test_files_of_failed_attempts_are_not_read(pages, tmp_path):
    files = warc.write_archives(pages([(1, "u", LONG)]), str(tmp_path))
    (tmp_path / "left.warc.zst").write_bytes(b"left by an attempt that failed")
    assert [r.page_id for r in warc.read_archives(files).collect()] == [1]


def test_damage_is_noticed():
    good = warc.record(1, "u", b"payload", hashlib.sha256(b"payload").hexdigest(), None)
    assert [r[2] for r in warc.parse(io.BytesIO(good + good))] == [b"payload"] * 2
    for bad in (good.replace(b"payload", b"paymoad"), good[:-1], good[:40], good.replace(b"WARC/1.1", b"WARC/9.9")):
        with pytest.raises(warc.ArchiveError):
            list(warc.parse(io.BytesIO(bad)))
