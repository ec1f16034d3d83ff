import base64
import hashlib

import pytest
import zstandard

import __spark_entry__ as entry
from orderlens.llm import warc

BIG = "<p>the same page</p>" * 20
PAGES = [
    (1, "http://a/1", BIG), (2, "http://a/2", BIG), (2, "http://a/2", BIG), (3, None, None), (4, "u", ""),
    (5, "u", ""), (None, "u", BIG), (6, "a\r\nWARC-Type: x", "ü" * 49), (7, "b", "ü" * 49), (8, "c", "ü" * 50),
    (9, "d", "ü" * 50), (None, "e", "z" * 200), (None, "f", "z" * 200), (10, "g", "long " * 400_000),
    (11, "h", "\r\n\r\nWARC/1.1\r\n\r\n" * 10), (12, "i", BIG),
]


def plain(rows):
    first = {}
    for key, _, html in rows:
        body = (html or "").encode()
        if len(body) >= 100 and key is not None:
            first[body] = min(first.get(body, key), key)
    result = []
    for key, _, html in rows:
        body = (html or "").encode()
        other = first.get(body)
        later = other is not None and other != key
        kind = "revisit" if later else "response"
        result.append((key, len(body), hashlib.sha256(body).hexdigest(), kind, other if later else None))
    return result


def order(rows):
    return sorted(rows, key=str)


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(*r, "x", "y") for r in PAGES]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, digest string, first_copy string")


def written(pages, **options):
    digest, first = warc.first_copy_names(pages)
    marked = warc.with_first_copies(pages, "html", "page_id", digest, first)
    return warc.archives(marked, "html", "page_id", "url", digest, first, **options)


@pytest.mark.parametrize("size", [1, 3000, warc.ARCHIVE_BYTES])
def test_round_trip_of_odd_pages(pages, size):
    rows = warc.records(written(pages.repartition(2), archive_size=size)).collect()
    number = lambda v: None if v in (None, "null") else int(v)
    got = [(number(r.record_id), r.payload_bytes, r.payload_digest, r.record_type, number(r.refers_to)) for r in rows]
    assert order(got) == order(plain(PAGES))
    bodies = {hashlib.sha256((h or "").encode()).hexdigest(): (h or "").encode() for _, _, h in PAGES}
    assert all(bytes(r.payload) == bodies[r.payload_digest] for r in rows if r.record_type == "response")
    assert all(r.payload is None for r in rows if r.record_type == "revisit")


def test_empty_table(pages):
    assert warc.records(written(pages.limit(0))).count() == 0


def test_query_equals_plain(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/pages.parquet").select("page_id", "url", "html").collect()]
    got = entry.queries()["op8_warc"](spark, small).collect()
    assert order(tuple(r) for r in got) == order(plain(rows))


def many(n=60):
    return [
        warc.record_bytes(str(i), f"http://a/{i}", hashlib.sha256(b).hexdigest(), b, None)
        for i in range(n) for b in [f"<html>page {i} with words that all pages share {i * i}</html>".encode() * 3]
    ]


def test_archive_is_one_frame_per_record_after_a_dictionary():
    raw = many()
    content = warc.archive_bytes(raw)
    assert content[:4] == bytes.fromhex("5d2a4d18")
    size = int.from_bytes(content[4:8], "little")
    assert size > 0 and list(warc.frames(content)) == raw
    held = zstandard.ZstdCompressionDict(content[8 : 8 + size])
    rest, seen = content[8 + size :], []
    while rest:
        one = zstandard.ZstdDecompressor(dict_data=held).decompressobj()
        seen.append(one.decompress(rest))
        rest = one.unused_data
    assert seen == raw


@pytest.mark.parametrize("spoil", [
    lambda c: c[:-3], lambda c: c[4:], lambda c: c[:6], lambda c: c + b"more",
    lambda c: c[:-20] + bytes([c[-20] ^ 255]) + c[-19:], lambda c: c[: 8 + int.from_bytes(c[4:8], "little") // 2],
])
def test_spoilt_archives_are_refused(spoil):
    with pytest.raises(warc.BadArchive):
        list(map(warc.parse_record, warc.frames(spoil(warc.archive_bytes(many())))))


@pytest.mark.parametrize("old, new", [
    (b"WARC/1.1", b"WARC/0.9"), (b"Content-Length: ", b"Content-Length: 1"), (b"sha256:", b"sha256:0"),
    (b"WARC-Type: response", b"WARC-Type: revisit"), (b"WARC-Type: response\r\n", b""), (b"page 1 ", b"page 2 "),
    (b"Content-Type: ", b"Content-Type "), (b"<urn:page:", b"urn:page:"), (b"Content-Type", b"WARC-Type"),
    (b"text/html", b"text/\xff"), (b"Content-Length: ", b"Content-Length: -"),
])
def test_bad_records_are_refused(old, new):
    raw = many(2)[1]
    assert warc.parse_record(raw)["record_id"] == "1" and old in raw
    with pytest.raises(warc.BadArchive):
        warc.parse_record(raw.replace(old, new, 1))


def test_clashing_column_names(spark, pages):
    """Columns named like every helper column stay as they are."""
    for name in ("_d", "_first", "_k", "_n", "_part", "_copies", "_same_digest", "_least_key"):
        pages = pages.withColumn(name, warc.F.lit(name))
    rows = warc.records(written(pages)).collect()
    number = lambda v: None if v is None else int(v)
    got = [(number(r.record_id), r.payload_bytes, r.payload_digest, r.record_type, number(r.refers_to)) for r in rows]
    assert order(got) == order(plain(PAGES))


def test_any_text_is_a_key(spark):
    keys = ["null", None, "", "a>b", "x\r\nWARC-Type: y", " ü %41 "]
    pages = spark.createDataFrame([(k, "u", f"{i}" * 200) for i, k in enumerate(keys)], "page_id string, url string, html string")
    read = warc.records(written(pages)).select(warc.key_of("record_id", "string").alias("k"), "payload").collect()
    assert {(r.k, bytes(r.payload)) for r in read} == {(k, f"{i}".encode() * 200) for i, k in enumerate(keys)}


def standard(kind, block, version="1.1", uid="1", **headers):
    """A record as other tools write it."""
    named = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:uuid:{uid}>", "WARC-Date": "2020-01-01T00:00:00Z"}
    named |= {k.replace("_", "-"): v for k, v in headers.items()} | {"Content-Length": str(len(block))}
    head = "".join(f"{k}: {v}\r\n" for k, v in named.items())
    return f"WARC/{version}\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


HTTP = {"Content_Type": "application/http; msgtype=response"}
BODY = b"<html>hello</html>"
ANSWER = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + BODY


def base32(method, data):
    return f"{method}:" + base64.b32encode(hashlib.new(method, data).digest()).decode()


@pytest.mark.parametrize("version", ["1.0", "1.1"])
def test_standard_records(version):
    told = {"WARC_Payload_Digest": base32("sha1", BODY), "WARC_Block_Digest": base32("sha1", ANSWER)}
    got = warc.parse_record(standard("response", ANSWER, version, WARC_Target_URI="http://a/", **HTTP, **told))
    assert got == {
        "record_id": "urn:uuid:1", "record_type": "response", "target_uri": "http://a/", "payload": BODY,
        "payload_digest": hashlib.sha256(BODY).hexdigest(), "payload_bytes": len(BODY), "refers_to": None,
    }
    for kind in ("warcinfo", "metadata", "resource", "conversion", "anything"):
        other = warc.parse_record(standard(kind, b"a: b\r\n", version, Content_Type="application/warc-fields"))
        assert (other["record_type"], other["payload"]) == (kind, b"a: b\r\n")
    asked = warc.parse_record(standard("request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", version, **HTTP))
    assert (asked["payload"], asked["payload_bytes"]) == (b"", 0)
    again = warc.parse_record(standard(
        "revisit", b"HTTP/1.1 200 OK\r\n\r\n", version, WARC_Profile=warc.REVISIT_PROFILE,
        WARC_Refers_To="<urn:uuid:0>", WARC_Payload_Digest="sha1:ABC", **HTTP,
    ))
    assert (again["refers_to"], again["payload"], again["payload_bytes"], again["payload_digest"]) == (
        "urn:uuid:0", None, None, "sha1:ABC",
    )


def test_digests_that_do_not_fit():
    for wrong in ({"WARC_Payload_Digest": base32("sha1", ANSWER)}, {"WARC_Block_Digest": base32("md5", BODY)}):
        with pytest.raises(warc.BadArchive):
            warc.parse_record(standard("response", ANSWER, **HTTP, **wrong))
    coded = ANSWER.replace(b"\r\n\r\n", b"\r\nTransfer-Encoding: chunked\r\n\r\n", 1)
    assert warc.parse_record(standard("response", coded, **HTTP, WARC_Payload_Digest=base32("sha1", b"other")))
    assert warc.parse_record(standard("response", ANSWER, **HTTP, WARC_Payload_Digest="blake9:abc"))


@pytest.mark.parametrize("packed", [False, True])
def test_dictionaries_of_others(packed):
    raw = [standard("response", ANSWER + b"%d" % i, uid=str(i), **HTTP) for i in range(50)]
    held = zstandard.train_dictionary(2000, raw * 20).as_bytes()
    packer = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(held))
    first = zstandard.ZstdCompressor().compress(held) if packed else held
    note = (0x184D2A50).to_bytes(4, "little") + (3).to_bytes(4, "little") + b"abc"
    content = warc.SKIPPABLE + len(first).to_bytes(4, "little") + first + note + b"".join(map(packer.compress, raw))
    assert list(warc.frames(content)) == raw
    with pytest.raises(warc.BadArchive):
        list(warc.frames(content + note[:-1]))


def test_archive_without_a_dictionary():
    raw = many(3)
    plain_packer = zstandard.ZstdCompressor()
    assert list(warc.frames(b"".join(map(plain_packer.compress, raw)))) == raw
    with pytest.raises(warc.BadArchive):
        list(warc.frames(b""))
