import hashlib
import io
import zipfile

import pytest

from adloom.llm import warc
from adloom.llm.warc import Package, archived, open_package, parse_records, read_packages, record, spans, write_packages

PAGES = "page_id long, url string, html string, digest string, path string, record_type string"


def package_of(data):
    return Package(lambda offset, size: data[offset : offset + size], len(data))


def zipped(members, comment=b"", force=False):
    sink = io.BytesIO()
    with zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED) as package:
        for name, data in members.items():
            with package.open(name, "w", force_zip64=force) as member:
                member.write(data)
        package.comment = comment
    return sink.getvalue()


@pytest.mark.parametrize("force", [False, True])
@pytest.mark.parametrize("comment", [b"", b"PK\x05\x06" + b"x" * 40])
def test_directory(force, comment):
    members = {"a.txt": b"hello", "dir/b.bin": bytes(range(256)) * 3, "empty": b""}
    package = package_of(zipped(members, comment, force))
    assert package.members.keys() == members.keys()
    for name, data in members.items():
        assert package.range(name, 0, package.members[name].size) == data
    assert package.range("dir/b.bin", 10, 5) == bytes(range(10, 15))


def test_zip64_directory(monkeypatch):
    """As if the archive were too large for the short fields."""
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 20)
    data = zipped({"first": b"a" * 50, "second": b"b" * 60}, force=True)
    assert b"PK\x06\x06" in data and b"PK\x06\x07" in data
    package = package_of(data)
    assert package.range("second", 0, 60) == b"b" * 60 and package.members["first"].size == 50


def test_no_archive():
    with pytest.raises(ValueError):
        package_of(b"no archive at all")
    sink = io.BytesIO()
    with zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED) as package:
        package.writestr("a", b"x" * 100)
    with pytest.raises(ValueError):
        package_of(sink.getvalue()).start("a")


def test_records_round_trip():
    import gzip

    payloads = [b"", b"<p>\r\n\r\nWARC/1.1\r\n</p>", "é漢".encode(), b"x" * 5000]
    data = b"".join(
        gzip.compress(record(i or None, "http://a b/\r\nX: y", p, hashlib.sha1(p).digest(), 7 if i == 3 else None)) for i, p in enumerate(payloads)
    )
    got = list(parse_records(data))
    assert [g.page_id for g in got] == [None, 1, 2, 3]
    assert [g.payload for g in got] == [*payloads[:3], b""]
    assert got[3].fields["warc-type"] == "revisit" and got[3].fields["x-refers-to-page-id"] == "7"
    assert "\r" not in got[0].fields["warc-target-uri"] and "x" not in got[0].fields
    with pytest.raises(ValueError):
        list(parse_records(data[:-10]))


def expected(rows):
    tops = {}
    for page_id, _, html, *_ in rows:
        if page_id is not None:
            tops[html or ""] = max(page_id, tops.get(html or "", page_id))
    out = []
    for page_id, _, html, *_ in rows:
        body = (html or "").encode()
        revisit = len(body) >= 1000 and tops.get(html or "") not in (None, page_id)
        top = tops[html] if revisit else None
        out.append((page_id, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", top))
    return sorted(out, key=repr)


def test_awkward_pages(spark, tmp_path):
    big, other = "é" * 500, "z" * 999
    rows = [
        (1, "http://a", big), (2, None, big), (3, "u\n", big), (3, "u", big), (None, "n", big), (4, "x", other), (5, "x", other),
        (6, "x", None), (7, "x", ""), (None, None, "y" * 2000), (None, "q", "y" * 2000), (8, "long", "<p>" + "long " * 500_000),
    ]
    pages = spark.createDataFrame([(*r, "d", "p", "t") for r in rows], PAGES)
    manifest = write_packages(pages.repartition(3), str(tmp_path))
    got = sorted((tuple(r) for r in read_packages(manifest).collect()), key=repr)
    assert got == expected(rows)
    with zipfile.ZipFile(manifest.first().path) as package:  # another reader agrees
        assert package.testzip() is None and package.namelist() == [warc.DATA, warc.INDEX]


def test_spans_cover_the_records_once(spark, sf_dir, tmp_path):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    manifest = write_packages(pages.repartition(4), str(tmp_path))
    found = spans(manifest, 20_000).collect()
    assert len(found) > len(manifest.collect())
    for path in {r.path for r in found}:
        package = open_package(path)
        ends = package.start(warc.DATA)
        for r in sorted((r for r in found if r.path == path), key=lambda r: r.offset):
            assert r.offset == ends
            ends += r.size
        assert ends == package.start(warc.DATA) + package.members[warc.DATA].size


def test_no_pages(spark):
    assert archived(spark, spark.createDataFrame([], PAGES)).count() == 0


def test_records_are_cut_from_a_span_in_linear_time(monkeypatch):
    import gzip
    import time

    from adloom.llm import warc

    def span(n):
        return b"".join(gzip.compress(warc.record(i, f"http://h/{i}", b"payload %d" % i, b"x" * 20, None), 1, mtime=0) for i in range(n))

    def seconds(data, n):
        start = time.perf_counter()
        assert [r.page_id for r in warc.parse_records(data)] == list(range(n))
        return time.perf_counter() - start

    small, large = span(500), span(8000)
    seconds(small, 500)
    assert seconds(large, 8000) < 16 * 4 * max(seconds(small, 500), 0.002)
    for fed in (1, 3, 100):
        monkeypatch.setattr(warc, "FED", fed)
        assert len(list(warc.parse_records(span(20)))) == 20
    import pytest

    with pytest.raises(ValueError, match="cut off"):
        list(warc.parse_records(small[:-5]))
