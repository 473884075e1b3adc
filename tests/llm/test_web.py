import io
import zlib

import pytest
from pyspark.sql import functions as F

from wayspan.llm import urls, warc

PAGES = [
    (5, "http://a.example.net/en/1", "x" * 100),
    (2, "https://www.Example.com:80/de/", "x" * 100),
    (9, "HTTP://b.example.net/fr?q#f", "x" * 100),
    (7, "http://example.org/fr/2", "y" * 99),
    (8, "http://example.org", "y" * 99),
    (1, None, None),
    (3, "no scheme", ""),
    (4, "ftp://evil-net/en/", "é" * 60),
    (6, "https://u@example.com./x//", "é" * 60),
    (10, "https://www.example.com/x", "é" * 60),
    (10, "https://www.example.com/x", "é" * 60),
    (None, "a://b://c/d", "é" * 60),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "c", "k") for p in PAGES], "page_id long, url string, html string, digest string, key string").repartition(3)


def test_round_trip(pages):
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.read_archives(warc.archive(pages)).collect()), key=lambda r: (r[0] is None, r[0] or 0))
    assert got == [(1, 0, "response", None), (2, 100, "response", None), (3, 0, "response", None), (4, 120, "response", None), (5, 100, "revisit", 2), (6, 120, "revisit", 4), (7, 99, "response", None), (8, 99, "response", None), (9, 100, "revisit", 2), (10, 120, "revisit", 4), (10, 120, "revisit", 4), (None, 120, "revisit", 4)]


def test_empty(pages):
    assert warc.read_archives(warc.archive(pages.where("false"))).count() == 0


def records(raw):
    """A WARC reader of its own: (fields in lower case, block) of each record of an inflated archive."""
    out, at = [], 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        first, *lines = raw[at:end].decode().split("\r\n")
        assert first == "WARC/1.1"
        fields = {}
        for line in lines:
            name, value = line.split(":", 1)
            assert name.lower() not in fields
            fields[name.lower()] = value.strip()
        size = int(fields["content-length"])
        out.append((fields, raw[end + 4 : end + 4 + size]))
        assert raw[end + 4 + size : end + 8 + size] == b"\r\n\r\n"
        at = end + 8 + size
    return out


def test_archives_for_other_readers(spark, tmp_path):
    """Required fields, unique ids, urls, HTTP blocks, one gzip member a record, and archives of bounded size."""
    import gzip
    import hashlib
    import json
    import re
    from pathlib import Path

    rows = [(i, f"http://h/ä {i}\n", f"page {i % 7} " * 40) for i in range(60)] + [(None, None, "x"), (None, None, "x"), (99, "", "y" * 500_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    folder = f"file://{tmp_path}/out"
    done = warc.normalise(warc.write_monolithic(warc.decided(pages).coalesce(1), folder, "2020-02-03T04:05:06Z", 4000)).collect()
    assert len(done) > 4 and sum(r.records for r in done) == 63
    seen = []
    for r in done:
        name = r.path.removeprefix("file://")
        data, entries = Path(name).read_bytes(), list(map(json.loads, Path(name.removesuffix(".warc.gz") + ".idx").read_text().splitlines()))
        parsed = records(gzip.decompress(data))
        assert len(parsed) == len(entries) == r.records and sum(e["length"] for e in entries) == len(data)
        for (fields, block), e in zip(parsed, entries, strict=True):
            assert records(gzip.decompress(data[e["offset"] : e["offset"] + e["length"]])) == [(fields, block)]
            assert fields["warc-date"] == e["date"] == "2020-02-03T04:05:06Z" and fields["warc-target-uri"] == e["uri"] and fields["warc-record-id"] == e["id"]
            assert re.fullmatch(r"<urn:uuid:[0-9a-f-]{36}>", fields["warc-record-id"]) and fields["content-type"].startswith("application/http")
            if fields["warc-type"] == "response":
                head, _, body = block.partition(b"\r\n\r\n")
                assert head.startswith(b"HTTP/1.1 200") and "sha256:" + hashlib.sha256(body).hexdigest() == fields["warc-payload-digest"]
            else:
                assert block == b"" and fields["warc-profile"] and fields["x-refers-to-page-id"]
            seen.append((fields["warc-record-id"], fields["warc-target-uri"]))
    assert len({i for i, _ in seen}) == 63
    assert {u for _, u in seen} == {f"http://h/ä%20{i}%0A" for i in range(60)} | {"urn:page:", "urn:page:99"}


def test_members_and_index(spark, tmp_path):
    import json

    raw = [warc.record(i, f"http://h/{i}", bytes([i]) * (i * 1000), "d", None, str(i)) for i in range(1, 40)]
    (tmp_path / "a.warc.gz").write_bytes(_gzip(b"".join(raw)))
    path, n = warc.normalise_file(f"file://{tmp_path}/a.warc.gz", "t1")
    assert n == 39
    data = (tmp_path / "a.members.warc.gz").read_bytes()
    for line, want in zip((tmp_path / "a.members.idx").read_text().splitlines(), raw, strict=True):
        e = json.loads(line)
        assert zlib.decompress(data[e["offset"] : e["offset"] + e["length"]], 31) == want
    assert b"".join(warc.inflate(io.BytesIO(data))) == b"".join(raw)
    assert warc.normalise_file(f"file://{tmp_path}/a.warc.gz", "t2") == (path, n)


def _gzip(data):
    z = zlib.compressobj(3, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def test_cut_off_archive(tmp_path):
    (tmp_path / "b.warc.gz").write_bytes(_gzip(warc.record(1, "", b"x" * 50, "d", None, "1")[:-20]))
    with pytest.raises(ValueError, match="cut off"):
        warc.normalise_file(f"file://{tmp_path}/b.warc.gz", "t")


def test_rules(pages, spark):
    none = spark.createDataFrame([], "key string")
    got = {r.page_id: r[1:] for r in urls.judge(pages, none).where("page_id is not null").collect()}
    assert got[5] == ("a.example.net", "/en/1", "example.net/en/", "allow")
    assert got[2] == ("www.example.com:80", "/de/", None, "allow")
    assert got[9] == ("b.example.net", "/fr", "net/", "block")
    assert got[7] == ("example.org", "/fr/2", "org/fr/", "allow")
    assert got[8] == ("example.org", "", None, "allow")
    assert got[1] == got[3] == ("", "", None, "allow")
    assert got[4] == ("evil-net", "/en/", None, "allow")


def test_listed(pages, spark):
    got = {r.page_id: r.verdict for r in urls.judge(pages, urls.often_named(pages)).collect()}
    assert got[6] == got[10] == "block" and got[4] == "allow" and got[None] == "allow"
    assert {r.key for r in urls.often_named(pages).collect()} == {"example.com/x"}


def test_bloom_has_no_false_negatives_and_few_false_positives(spark):
    listed = spark.range(3000).select(F.concat(F.lit("in"), "id").alias("key"))
    other = spark.range(3000).select(F.concat(F.lit("out"), "id").alias("key"))
    blocks = urls.block_count(3000)
    f = urls.bloom(listed, blocks)
    assert f.count() <= blocks
    assert urls.possible_hits(listed, f, blocks).count() == 3000
    assert urls.possible_hits(other, f, blocks).count() < 300
    both = listed.unionByName(other).unionByName(listed)
    for most in (urls.MAX_BLOCKS, 4):  # too small a filter passes more, the join still decides
        assert urls.listed_hits(both, listed, most=most).count() == 3000
