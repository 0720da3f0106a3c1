import base64
import hashlib
import io
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest
import zstandard
from llm_helpers import SMALL

from raremine.llm import warc


def brute(rows, least=0):
    sets = defaultdict(list)
    for page, _, html in rows:
        sets[html or ""].append(page)
    for html, pages in sets.items():
        raw = html.encode()
        top = max((p for p in pages if p is not None), default=None)
        first = True
        for p in sorted(pages, key=lambda p: (p is not None, p or 0), reverse=True):
            revisit = not first and len(raw) >= least
            first = False
            yield (p, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                   "revisit" if revisit else "response", top if revisit else None)


@pytest.fixture(scope="module")
def pages(spark):
    t = pq.read_table(f"{SMALL}/pages.parquet").to_pylist()
    rows = [(r["page_id"], r["url"], r["html"]) for r in t]
    rows += [(900, "u\r\nv é", t[0]["html"]), (901, None, None), (902, "", ""), (None, "x", t[1]["html"]), (None, "y", "only null"),
             (5, t[5]["url"], t[5]["html"]), (950, "a", "twice"), (950, "a", "twice"), (940, "b", "twice"), (951, "big", "<p>é\r\n\r\n" * 40_000)]
    return rows, spark.createDataFrame([(a, b, c, 1) for a, b, c in rows],
                                       "page_id long, url string, html string, page int").repartition(3)


@pytest.mark.parametrize("least", [0, 100])
def test_round_trip_against_brute_force(pages, least):
    rows, df = pages
    out = warc.archive_round_trip(df, least_bytes=least).collect()
    assert Counter(tuple(r) for r in out) == Counter(brute(rows, least))


def test_archives_hold_payloads_and_urls(spark, pages, tmp_path):
    rows, df = pages
    files = warc.write_archives(df, f"file://{tmp_path}", file_bytes=20_000)
    assert files.count() > 2
    back = warc.read_archives(files, f"file://{tmp_path}", payloads=True).collect()
    sent = Counter((c or "").encode() for _, _, c in rows)
    assert {bytes(r.payload) for r in back if r.record_type == "response"} == set(sent)
    assert Counter(r.url for r in back if r.page == "900") == Counter(["u%0D%0Av%20é"])


def test_file_format():
    records = [warc.encode_record(str(i), f"http://a/{i}", (b"<p>some shared words and markup %d</p>" % i) * 60, None, False) for i in range(300)]
    store = type("S", (), {"open_output_stream": lambda self, p: buffer})()
    buffer = io.BytesIO()
    buffer.close_, buffer.close = buffer.close, lambda: None
    w = warc.ArchiveWriter(store, "x")
    for r in records:
        w.add(r)
    w.close()
    raw = buffer.getvalue()
    assert int.from_bytes(raw[:4], "little") == warc.DICT_FRAME
    size = int.from_bytes(raw[4:8], "little")
    fitted = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(raw[8:8 + size]))
    first = zstandard.ZstdDecompressor(dict_data=fitted).decompressobj()
    assert first.decompress(raw[8 + size:]) == records[0] and first.unused_data
    assert [r["page"] for r in warc.iterate_archive(io.BytesIO(raw))] == [str(i) for i in range(300)]
    for broken in (raw[:-3], raw[:-40] + bytes(40), raw[:9 + size] + b"\xff" + raw[10 + size:]):
        with pytest.raises(warc.ArchiveError):
            list(warc.iterate_archive(io.BytesIO(broken)))


def test_validation_of_records():
    good = warc.encode_record("1", "u", b"abc", None, False)
    assert warc.decode_record(good)["payload"] == b"abc"
    for bad in (good[:-1], good.replace(b"abc", b"abd"), good.replace(b"WARC/1.1", b"WARK/1.1"),
                good.replace(b"Content-Length: 3", b"Content-Length: 4"), b"", good.replace(b"response\r\nWARC-R", b"other\r\nWARC-R")):
        with pytest.raises(warc.ArchiveError):
            warc.decode_record(bad)


def test_empty(spark, pages):
    assert warc.archive_round_trip(pages[1].limit(0)).count() == 0
