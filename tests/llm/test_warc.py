import gzip

import pytest
from cases import SMALL, sha

from cartwheel.llm import warc

SCHEMA = "page_id long, url string, html string, body string, record string, digest string"


def messy(spark):
    big, small = "<p>é</p>" * 40, "tiny"
    rows = [
        (5, "http://a/ b", big), (2, "http://a/2", big), (9, None, big), (None, "http://n", big), (3, "", None), (4, "http://4", ""),
        (6, "http://6", small), (7, "http://7", small), (8, "http://8", "x\r\n\r\nWARC/1.1\r\n\nfiledesc://x 1 2\n" * 20), (10, "http://10", "long " * 200_000),
        (8, "http://8", "x\r\n\r\nWARC/1.1\r\n\nfiledesc://x 1 2\n" * 20), (-3, "http://-3", "y" * 99), (-4, "http://-4", "y" * 99),
    ]
    return spark.createDataFrame([(*r, "b", "r", "d") for r in rows], SCHEMA).repartition(3)


def brute(pairs):
    first = {}
    for i, html in sorted(pairs, key=lambda p: (p[0] is None, p[0] or 0)):
        first.setdefault(html or "", i)
    out = []
    for i, html in pairs:
        body = (html or "").encode()
        to = first[html or ""] if len(body) >= 100 else i
        out.append((i, len(body), sha(body), "response" if to == i else "revisit", None if to == i else to))
    return sorted(out, key=repr)


@pytest.mark.parametrize("kind", ["messy", "small", "empty"])
def test_pages_through_both_formats(spark, kind):
    pages = {"messy": lambda: messy(spark), "small": lambda: spark.read.parquet(f"{SMALL}/pages.parquet"), "empty": lambda: messy(spark).limit(0)}[kind]()
    got = sorted((tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in warc.pages_to_warc(pages).collect()), key=repr)
    assert got == brute([(r.page_id, r.html) for r in pages.collect()])


@pytest.mark.parametrize("version", [1, 2])
def test_arc_header_lines_by_version(version):
    blocks = [b"one\n\nhttp://x 1.2.3.4 20200101000000 text/html 3\n", b"", b"\n"]
    content = warc.arc_version_block(version, "f.arc", "20200101000000") + b"\n"
    content += b"".join(warc.arc_record(version, b, url="http://u/ v", ip="1.2.3.4", date="20200101000000", mime="text/html") + b"\n" for b in blocks)
    got = list(warc.parse_arc(content))
    assert [r.block for r in got] == blocks and {r.version for r in got} == {version}
    assert {r.fields["url"] for r in got} == {"http://u/%20v"} and tuple(got[0].fields) == warc.ARC_FIELDS[version]


def test_a_header_line_of_the_other_version_is_an_error():
    content = warc.arc_version_block(1, "f.arc", "20200101000000") + b"\n" + warc.arc_record(2, b"x", url="u") + b"\n"
    with pytest.raises(ValueError, match="5 fields"):
        list(warc.parse_arc(content))


def test_warc_records_name_each_other(spark):
    folder = warc.scratch(spark, "warc-test")
    html = "<html>" + "same " * 50
    pages = spark.createDataFrame([(4, "http://4", html), (2, "http://2", html)], "page_id long, url string, html string")
    warc.write_arc(pages, folder + "/arc")
    warc.arc_to_warc(spark, [folder + "/arc/v1", folder + "/arc/v2"], folder + "/warc")
    files = spark.read.format("binaryFile").load(folder + "/warc").collect()
    content = b"".join(gzip.decompress(bytes(r.content)) for r in files)
    records = {r.headers["WARC-Type"]: r for r in warc.parse_warc(content)}
    assert records["revisit"].headers["WARC-Refers-To"] == records["response"].headers["WARC-Record-ID"]
    assert records["response"].headers["WARC-Date"] == "2020-01-01T00:00:00Z"
    assert records["response"].headers["WARC-Payload-Digest"] == "sha256:" + sha(html)
    assert records["response"].headers["WARC-Block-Digest"] == "sha256:" + sha(records["response"].block)


def test_a_url_that_looks_like_a_version_block(spark):
    rows = [(1, "filedesc://x 1 2", "a"), (2, "filedesc:", "b" * 200), (3, "http://3", "b" * 200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.pages_to_warc(pages).collect())
    assert got == [(1, 1, "response", None), (2, 200, "response", None), (3, 200, "revisit", 2)]


def test_a_file_without_a_version_block_is_an_error():
    with pytest.raises(ValueError, match="version block"):
        list(warc.parse_arc(warc.arc_record(1, b"x", url="u") + b"\n"))


def test_archives_are_bounded_and_whole(spark):
    folder, most = warc.scratch(spark, "bounded"), 2_000
    pages = messy(spark).coalesce(1)
    warc.write_arc(pages, folder + "/arc", archive_bytes=most)
    warc.arc_to_warc(spark, [folder + "/arc/v1", folder + "/arc/v2"], folder + "/warc", archive_bytes=most)
    arcs, warcs = ([gzip.decompress(bytes(r.content)) for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder + kind).collect()] for kind in ("/arc", "/warc"))
    assert len(arcs) > 3 and len(warcs) > 3
    for files, parse in ((arcs, warc.parse_arc), (warcs, warc.parse_warc)):
        counts = [len(list(parse(content))) for content in files]
        assert sum(counts) == pages.count() and all(n == 1 or len(content) < most + 500 for n, content in zip(counts, files, strict=True))
    assert sorted(map(repr, warc.pages_to_warc(pages, archive_bytes=most).drop("record_id").collect())) == sorted(map(repr, warc.pages_to_warc(pages).drop("record_id").collect()))
