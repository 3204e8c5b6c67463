import base64
import gzip
import hashlib
import io
import pathlib

import pytest
from pyspark.sql import types as T
from tapeline.llm import shared, warc

ROWS = [(1, "same", "u1"), (2, "same", None), (3, None, "u\r\n3"), (4, "", "u4"), (5, "é" * 50_000, "u5"), (7, "same", "u7"),
        (None, "same", "u"), (8, "one", "u8"), (8, "one", "u8"), (9, "two\r\n\r\nparts", "u9")]


def expected(rows, least=0):
    out = []
    for key, text, _ in rows:
        raw = (text or "").encode()
        leader = max(k for k, t, _ in rows if k is not None and (t or "") == (text or "")) if len(raw) >= least else key
        revisit = key is not None and key < leader
        out.append((key, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", leader if revisit else None))
    return sorted(map(str, out))


def pages(spark, rows):
    return spark.createDataFrame(rows, "path long, doc string, uri string").selectExpr("*", "'clash' AS digest", "1 AS leader")


@pytest.mark.parametrize("roll,least,many", [(1, 0, 10**6), (10**6, 0, 10**6), (300, 4, 0)])
def test_round_trip(spark, tmp_path, monkeypatch, roll, least, many):
    monkeypatch.setattr(warc, "MANY_ROWS", many)
    folder = f"file://{tmp_path}/a"
    manifest = warc.write_archives(pages(spark, ROWS).repartition(3), folder, uri="uri", revisit_from=least, roll_bytes=roll).collect()
    assert sum(m.records for m in manifest) == len(ROWS)
    if roll == 1:
        assert len(manifest) == len(ROWS)
    got = warc.read_archives(spark, folder, kind=T.LongType()).collect()
    assert sorted(str(tuple(r)) for r in got) == expected(ROWS, least)
    assert not (pathlib.Path(tmp_path) / "a/_temporary").exists()


def test_bytes_are_deterministic_and_plain_warc(spark, tmp_path):
    files = []
    for name in ("a", "b"):
        warc.write_archives(pages(spark, ROWS).repartition(4 if name == "a" else 2), f"{tmp_path}/{name}", uri="uri")
        parts = sorted((tmp_path / name).glob("*.warc.gz"))
        files.append(b"".join(gzip.decompress(p.read_bytes()) for p in parts))
    assert files[0] == files[1]
    text = files[0]
    while text:  # any reader can go by Content-Length
        head, _, rest = text.partition(b"\r\n\r\n")
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        n = int(fields[b"Content-Length"])
        assert head.startswith(b"WARC/1.1\r\n") and rest[n : n + 4] == b"\r\n\r\n"
        assert fields[b"WARC-Block-Digest"] == b"sha1:" + base64.b32encode(hashlib.sha1(rest[:n]).digest())
        text = rest[n + 4 :]


def test_damage_is_found(spark, tmp_path):
    warc.write_archives(pages(spark, ROWS), f"{tmp_path}/a")
    part = sorted((tmp_path / "a").glob("*.warc.gz"))[0]
    raw = bytearray(part.read_bytes())
    raw[-30] ^= 1
    part.write_bytes(raw)
    with pytest.raises(Exception):
        warc.read_archives(spark, f"{tmp_path}/a").collect()


def test_stray_files_are_not_read(spark, tmp_path):
    warc.write_archives(pages(spark, ROWS[:2]), f"{tmp_path}/a")
    (tmp_path / "a" / "part-009999-00000.warc.gz").write_bytes(b"left by a lost task")
    assert warc.read_archives(spark, f"{tmp_path}/a").count() == 2


def test_empty_table(spark, tmp_path):
    assert warc.write_archives(pages(spark, []), f"{tmp_path}/a").collect() == []
    assert warc.read_archives(spark, f"{tmp_path}/a").collect() == []


def test_header_values_round_trip():
    for value in ("plain", "a\r\nb", " edge ", "100%", "%0A", ""):
        assert warc._from_line(warc.one_line(value)) == value
    raw = warc.record("x", "u", b"p", 1, warc.base32_sha1(b"p"), None)
    (fields, block), = warc.records_of(io.BytesIO(warc.member(raw)))
    assert fields["WARC-Type"] == "response" and block.endswith(b"\r\n\r\np")


def test_shared_folder_is_the_sessions(spark):
    assert shared.shared_folder(spark).startswith("file:")
