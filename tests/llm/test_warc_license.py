"""WARC round trip and licence scan."""
import base64
import gzip
import hashlib
import io
import json
import os
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tablewise.llm import licenses, queries, warc

from .conftest import make_docs

SF = "/root/testdata/sf0.01"


def brute_pages(rows):
    groups = defaultdict(list)
    for page, html in rows:
        groups[(html or "").encode()].append(page)
    out = []
    for payload, ids in groups.items():
        known = [i for i in ids if i is not None]
        first = min(known) if known else None
        sha = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out += [(i, len(payload), sha, "response" if i == first else "revisit", None if i == first else first)
                for i in ids]
    return sorted(out, key=str)


def got(df):
    return sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()],
                  key=str)


def test_warc_real(spark):
    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    want = brute_pages(rows)
    assert got(queries.QUERIES["op6_warc"](spark, SF)) == want


def test_warc_awkward(spark):
    rows = [(1, None, "http://a/\r\nX: y"), (2, "", None), (3, "a\r\n\r\nWARC/1.1\r\n\r\n", "http://é/ü?q= 1"),
            (4, "same"), (5, "same"), (5, "same"), (4, "same"), (None, "same"), (None, "alone"), (7, "x" * 3_000_000),
            (8, "😀"), (9, "x" * 3_000_000), (10, "\x00\x01")]
    df = spark.createDataFrame([(*r, None)[:3] for r in rows], "page_id long, html string, url string")
    df = df.withColumns({c: F.lit(1) for c in ("sha", "first", "payload", "archive", "same")}).repartition(3)
    assert got(warc.round_trip(df)) == brute_pages([r[:2] for r in rows])
    assert warc.round_trip(df.limit(0)).collect() == []


def archive(rows):
    return b"".join(warc.record(i, "http://x/", p, False, None) for i, p in rows)


def test_warc_odd_ids_and_long_urls(spark):
    """Ids with line ends or nothing in them come back; an URL may be any length."""
    rows = [("x\r\ny", "u", "<p>1"), ("", "u", "<p>2"), (None, "u", "<p>3"), ("é %41 <>", "u", "<p>1"), ("z" * 3000, None, "<p>2")]
    rows += [(f"p{i}", "data:text/html," + "é=" * 50_000 + "x" * 300_000, f"<q>{i}") for i in range(12)]
    pages = spark.createDataFrame(rows, "page_id string, url string, html string")
    got = {r.page_id: r for r in warc.round_trip(pages).collect()}
    assert set(got) == {r[0] for r in rows}
    assert got["x\r\ny"].refers_to is None or got["x\r\ny"].refers_to == "é %41 <>"
    assert got["é %41 <>"].refers_to in (None, "x\r\ny") and got["z" * 3000].refers_to == ""


def test_normalise_one_stream_and_many_members():
    rows = [(i, os.urandom(i * 5000) + b"\r\n\r\n") for i in range(40)]
    whole = gzip.compress(archive(rows))
    many = b"".join(gzip.compress(archive(rows[i:i + 7])) for i in range(0, 40, 7))
    for data in (whole, many):
        out = io.BytesIO()
        index = warc.normalise(io.BytesIO(data), out, "t")
        raw = out.getvalue()
        assert [x["id"] for x in index] == [f"<urn:x-page:{i}>" for i, _ in rows]
        assert sum(x["length"] for x in index) == len(raw)
        assert gzip.decompress(raw) == archive(rows)
        for x, (i, payload) in zip(index, rows, strict=True):
            member = raw[x["offset"]:x["offset"] + x["length"]]
            assert warc.parse(member, "t")["payload_digest"] == warc.payload_digest(payload)
            assert warc.parse(member, "t")["page_id"] == str(i)
    assert warc.normalise(io.BytesIO(b""), io.BytesIO(), "t") == []
    assert warc.normalise(io.BytesIO(gzip.compress(b"")), io.BytesIO(), "t") == []


def test_damaged_archives_raise():
    data = gzip.compress(archive([(1, b"payload" * 1000)]))
    with pytest.raises((ValueError, Exception)):
        warc.normalise(io.BytesIO(data[:-20]), io.BytesIO(), "t")
    cut = gzip.compress(archive([(1, b"payload" * 1000)])[:-100])
    with pytest.raises(ValueError, match="cut"):
        warc.normalise(io.BytesIO(cut), io.BytesIO(), "t")
    with pytest.raises(ValueError, match="no end"):
        warc.normalise(io.BytesIO(gzip.compress(b"x" * 3_000_000)), io.BytesIO(), "t")


def test_files_on_disk(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://p/{i}", f"page {i % 5}") for i in range(50)],
                                  "page_id long, url string, html string").repartition(4)
    made = warc.write_archives(pages, f"{tmp_path}/a")
    assert sum(r.records for r in made.collect()) == 50
    warc.normalise_archives(made, f"{tmp_path}/a", f"{tmp_path}/b").collect()
    names = sorted(os.listdir(f"{tmp_path}/b"))
    assert not any(n.startswith(".") for n in names) and any(n.endswith(".idx") for n in names)
    total = 0
    for n in names:
        if n.endswith(".gz"):
            index = [json.loads(x) for x in open(f"{tmp_path}/b/{n}.idx")]
            raw = open(f"{tmp_path}/b/{n}", "rb").read()
            for x in index:
                assert gzip.decompress(raw[x["offset"]:x["offset"] + x["length"]]).startswith(b"WARC/1.1\r\n")
            total += len(index)
    assert total == 50


def test_license_real(spark):
    notices = {text: name for name, text in licenses.KNOWN if "\n" not in text}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    found = {r.doc_id: r for r in queries.QUERIES["op2_license"](spark, SF).collect()}
    assert len(found) == len(docs)
    for d in docs:
        want = [notices[x.strip()] for x in (d.text or "").split("\n") if x.strip() in notices]
        assert found[d.doc_id].n_notices == len(want)
        assert found[d.doc_id].notices == ",".join(sorted(set(want)))
    assert any(r.n_notices for r in found.values())


def test_license_awkward(spark, awkward):
    mit = next(t for n, t in licenses.KNOWN if n == "MIT" and t.startswith("MIT License"))
    odd = "Copyright (c) 2020 A. Person\n" + mit.upper().replace("LICENSE", "LICENCE").replace(",", " ,").replace("\n", " \n\t")
    rows = [*awkward, (900, mit), (901, odd), (902, mit + " and more"), (903, "x\nreleased under the MIT licence!\ny"),
            (904, "Licensed under CC BY-NC 4.0\nSPDX-License-Identifier: MIT"), (905, "License"), (906, "...")]
    df = make_docs(spark, rows, extra=["license", "_at", "_lines", "digest", "notices"])
    out = licenses.scan_licenses(df)
    res = out.collect()
    assert len(res) == len(rows) and "_at" in out.columns
    by = {r.doc_id: (r.license, r.notices, r.n_notices) for r in res}
    assert by[900][0] == by[901][0] == "MIT" and by[902][0] is None
    assert by[903] == (None, "MIT", 1) and by[904] == (None, "CC-BY-NC-4.0,MIT", 2)
    assert by[905] == by[906] == by[100] == (None, "", 0)
    assert licenses.scan_licenses(make_docs(spark, [])).collect() == []
    empty = licenses.known_licenses(spark).limit(0)
    assert {r.license for r in licenses.scan_licenses(df, empty).collect()} == {None}


def test_license_whole_texts(spark):
    names = ["Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "BSL-1.0", "Zlib", "Unlicense",
             "BSD-2-Clause", "BSD-3-Clause"]
    text = {n: (licenses.TEXTS / f"{n}.txt").read_text("utf-8") for n in names}
    rows = [*enumerate(text.values())]
    want = [*names]
    for name, form in [
        ("BSD-3-Clause", "BSD 3-Clause License\n\nCopyright (c) 2020, A. Person\nAll rights reserved.\n\n" + text["BSD-3-Clause"]),
        ("BSD-2-Clause", "Copyright 2020 A. Person\n" + " ".join(text["BSD-2-Clause"].split())),
        ("Apache-2.0", text["Apache-2.0"].split("END OF TERMS")[0]),
        ("MIT", "The MIT License (MIT)\n" + next(t for n, t in licenses.KNOWN if "\n" in t).removeprefix("MIT License")),
        ("Apache-2.0", "Copyright 2020 A. Person\n\n" + licenses.HEADERS[0][1]),
        ("GPL-3.0", next(t for n, t in licenses.HEADERS if n == "GPL-3.0")),
        (None, text["Zlib"] + "\nand more"),
    ]:
        rows.append((len(rows), form))
        want.append(name)
    found = {r.doc_id: r.license for r in licenses.scan_licenses(make_docs(spark, rows)).collect()}
    assert [found[i] for i in range(len(rows))] == want


def test_license_notices_of_any_wording(spark):
    known = licenses.known_licenses(spark, [("PD", "Public domain"), ("ARR", "All rights reserved."),
                                            ("CC-BY-4.0", "Released under CC BY 4.0."), ("MIT", "Licensed under the MIT License.")])
    rows = [(1, "x\n  PUBLIC -- domain!\ny"), (2, "All rights reserved"), (4, "Public domains\nall rights"),
            (3, "a\nReleased under Creative Commons Attribution 4.0\nb"),
            (5, "a\nLicensed " + " .-" * 5000 + " under the MIT License")]
    found = {r.doc_id: (r.notices, r.n_notices) for r in licenses.scan_licenses(make_docs(spark, rows), known).collect()}
    assert found == {1: ("PD", 1), 2: ("ARR", 1), 3: ("CC-BY-4.0", 1), 4: ("", 0), 5: ("MIT", 1)}
    bare = known.select("license", "digest")
    assert {r.doc_id for r in licenses.scan_licenses(make_docs(spark, rows), bare).collect() if r.n_notices} == {1, 2, 3, 5}
