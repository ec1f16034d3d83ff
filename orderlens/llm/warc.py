"""WARC archives in Zstandard frames with a dictionary.

An archive is the bytes of one `.warc.zst` file: a skippable frame that holds the
dictionary, then one frame per record.  `archives` writes the payloads of a table as
archives, `records` reads archives back frame by frame and checks each record.  It also
reads archives of others: WARC 1.0 and 1.1, all record types, digests by any usual
method, a dictionary that is compressed itself, and frames without a dictionary.

Archives are rows of a table (name, content), because on a cluster only Spark writes
to the shared store; `content` is the file as it is.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.columns import free_name

# Fixed values of the formats.
SKIPPABLE = 0x184D2A5D.to_bytes(4, "little")
FRAME = 0xFD2FB528.to_bytes(4, "little")
VERSION = b"WARC/1.1"
VERSIONS = (b"WARC/1.0", b"WARC/1.1")
DIGESTS = ("md5", "sha1", "sha256", "sha512")
NO_KEY = "<urn:page-without-key:>"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Payload bytes after which an archive is closed.
ARCHIVE_BYTES = 16_000_000
#: Payload bytes from the start of an archive that its dictionary is made from, its
#: size, and the payloads that are too few or too small for one.
SAMPLE_BYTES = 1_000_000
DICTIONARY_BYTES = 32_768
LEAST_SAMPLES = 16
LEAST_DEDUPLICATED = 100
_LEVEL = 3

RECORD_FIELDS = (
    "record_id string, record_type string, target_uri string, payload_digest string, "
    "payload_bytes bigint, refers_to string, payload binary"
)


class BadArchive(ValueError):
    """An archive or a record of it is not as the format wants it."""


# --- writing -----------------------------------------------------------------


def with_first_copies(
    pages: DataFrame, payload: str, key: str, digest: str, first: str,
    least_bytes: int = LEAST_DEDUPLICATED,
) -> DataFrame:
    """Add the payload's SHA-256 and, for a later copy, the least key with that payload.

    Payloads of fewer than `least_bytes` bytes have no copies.  Of rows with equal
    keys and payloads none is a copy of another.  A null key sorts last and is never
    referred to.
    """
    content = F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit("")).cast("binary")
    marked = pages.withColumn(digest, F.sha2(content, 256))
    counted = pages.select(F.sha2(content, 256).alias("_d"), F.col(f"`{key}`").alias("_k"), F.octet_length(content).alias("_n"))
    same, least = free_name(marked, "_same_digest"), free_name(marked, "_least_key")
    # The second grouping column leaves the join a shuffle of its own, so that adaptive
    # execution can split a payload with very many copies.
    shared = (
        counted.filter(F.col("_n") >= least_bytes)
        .groupBy("_d", F.xxhash64("_d").alias("_part"))
        .agg(F.min("_k").alias("_first"), F.count(F.lit(1)).alias("_copies"))
        .filter("_copies > 1 AND _first IS NOT NULL")
        .select(F.col("_d").alias(same), F.col("_first").alias(least))
    )
    joined = marked.join(shared, F.col(digest) == F.col(same), "left")
    later = ~F.col(least).eqNullSafe(F.col(f"`{key}`"))
    return joined.withColumn(first, F.when(F.col(least).isNotNull() & later, F.col(least))).drop(same, least)


def record_bytes(
    record_id: str | None, uri: str, digest: str, payload: bytes, refers_to: str | None
) -> bytes:
    """One record: a response with its payload, or a revisit that names an earlier one."""
    name = NO_KEY if record_id is None else f"<urn:page:{quote(record_id, safe='')}>"
    kind, block = ("response", payload) if refers_to is None else ("revisit", b"")
    headers = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", name),
        ("WARC-Target-URI", "".join(uri.split())),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Payload-Length", str(len(payload))),
        ("Content-Type", "text/html"),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        headers += [("WARC-Refers-To", f"<urn:page:{quote(refers_to, safe='')}>"), ("WARC-Profile", REVISIT_PROFILE)]
    head = "".join(f"{name}: {value}\r\n" for name, value in headers)
    return VERSION + b"\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def archive_bytes(raw: list[bytes]) -> bytes:
    """The archive of some records."""
    sample, size = [], 0
    for r in raw:
        if size >= SAMPLE_BYTES:
            break
        sample.append(r)
        size += len(r)
    content = b""
    if len(sample) >= LEAST_SAMPLES:
        try:
            content = zstandard.train_dictionary(DICTIONARY_BYTES, sample).as_bytes()
        except zstandard.ZstdError:  # records too small or too much alike to learn from
            content = b""
    dictionary = zstandard.ZstdCompressionDict(content) if content else None
    packer = zstandard.ZstdCompressor(level=_LEVEL, dict_data=dictionary, write_checksum=True)
    parts = [SKIPPABLE, len(content).to_bytes(4, "little"), content]
    parts += [packer.compress(r) for r in raw]
    return b"".join(parts)


def archives(
    pages: DataFrame, payload: str, key: str, uri: str, digest: str, first: str,
    archive_size: int = ARCHIVE_BYTES,
) -> DataFrame:
    """(content): archives of the rows, each task's rows in order; lazy.

    A null payload or address is an empty one.  A null key has a record id
    of its own, which is read as a null.
    """
    text = F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(f"`{key}`").cast("string").alias("id"),
        F.coalesce(F.col(f"`{uri}`").cast("string"), F.lit("")).alias("uri"),
        F.col(f"`{digest}`").alias("digest"),
        text.alias("payload"),
        F.col(f"`{first}`").cast("string").alias("first"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, size = [], 0
        for batch in batches:
            columns = [batch.column(i) for i in range(5)]
            for i in range(batch.num_rows):
                record = record_bytes(*(c[i].as_py() for c in columns))
                raw.append(record)
                size += len(record)
                if size >= archive_size:
                    yield pa.record_batch({"content": pa.array([archive_bytes(raw)], pa.binary())})
                    raw, size = [], 0
        if raw:
            yield pa.record_batch({"content": pa.array([archive_bytes(raw)], pa.binary())})

    return rows.mapInArrow(write, "content binary")


# --- reading -----------------------------------------------------------------


def frames(content: bytes) -> Iterator[bytes]:
    """The decoded frames of an archive, with the dictionary from its first frame.

    The dictionary may be a Zstandard frame itself.  An archive that starts with a record
    has no dictionary; skippable frames after the first are skipped.
    """
    view = memoryview(content)
    at, held = 0, b""
    if bytes(view[:4]) == SKIPPABLE:
        at = _skipped(view, at)
        held = bytes(view[8:at])
    elif bytes(view[:4]) != FRAME:
        raise BadArchive("neither a dictionary frame nor a record at the start")
    try:
        if held[:4] == FRAME:
            held = zstandard.ZstdDecompressor().decompressobj().decompress(held)
        reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(held) if held else None)
    except zstandard.ZstdError as error:
        raise BadArchive(f"the dictionary can't be decoded: {error}") from error
    while at < len(view):
        magic = bytes(view[at : at + 4])
        if magic[1:] == SKIPPABLE[1:] and magic[0] >> 4 == SKIPPABLE[0] >> 4:
            at = _skipped(view, at)
            continue
        if magic != FRAME:
            raise BadArchive(f"no frame at byte {at}")
        end = _frame_end(view, at)
        try:
            yield reader.decompressobj().decompress(view[at:end])
        except zstandard.ZstdError as error:
            raise BadArchive(f"the frame at byte {at} can't be decoded: {error}") from error
        at = end


def _skipped(view: memoryview, at: int) -> int:
    """The end of a skippable frame."""
    end = at + 8 + int.from_bytes(view[at + 4 : at + 8], "little")
    if at + 8 > len(view) or end > len(view):
        raise BadArchive("a skippable frame is cut short")
    return end


def _frame_end(view: memoryview, at: int) -> int:
    """The end of a frame, found by its block headers, without decoding it."""
    try:
        shape = zstandard.get_frame_parameters(view[at : at + 18])
        at += zstandard.frame_header_size(view[at : at + 18])
    except zstandard.ZstdError as error:
        raise BadArchive(f"a bad frame header at byte {at}: {error}") from error
    last = False
    while not last:
        head = int.from_bytes(view[at : at + 3], "little")
        last, kind, size = head & 1, head >> 1 & 3, head >> 3
        at += 3 + (1 if kind == 1 else size)
        if at > len(view) or kind == 3:
            raise BadArchive("a frame is cut short")
    at += 4 * shape.has_checksum
    if at > len(view):
        raise BadArchive("a frame's checksum is cut short")
    return at


def parse_record(raw: bytes) -> dict:
    """The fields of one record; raises BadArchive if it is not well formed.

    The payload is the block; of an HTTP message, what follows its headers.  A revisit has
    none.  `payload_digest` is the payload's SHA-256 in hex; of a revisit with a digest by
    another method, the digest with its label.  `payload_bytes` of a revisit is null if it
    doesn't say.  Ids that `record_bytes` did not write are given without their brackets.
    """
    head, blank, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not blank or lines[0] not in VERSIONS:
        raise BadArchive("a record has no version line or no end of its headers")
    named = _headers(lines[1:])
    try:
        length, kind, record_id = int(named["content-length"]), named["warc-type"], _page(named["warc-record-id"])
        told = int(named["warc-payload-length"]) if "warc-payload-length" in named else None
        refers_to = _page(named["warc-refers-to"]) if "warc-refers-to" in named else None
    except (KeyError, ValueError) as error:
        raise BadArchive(f"a header is missing or malformed: {error}") from error
    block, end = rest[:length], rest[length:]
    if length < 0 or len(block) != length or end != b"\r\n\r\n":
        raise BadArchive("a block is not as long as its header says")
    if not _fits(named.get("warc-block-digest", ""), block):
        raise BadArchive("a block does not fit its digest")
    digest = named.get("warc-payload-digest", "")
    if kind == "revisit":
        if "warc-profile" not in named:
            raise BadArchive("a revisit has no profile")
        payload, size, digest = None, told, digest.removeprefix("sha256:") or None
    else:
        payload, coded = _payload(named.get("content-type", ""), block)
        # Of a body in transfer coding, or cut by its writer, digests are taken differently.
        if not (coded or "warc-truncated" in named) and not (told in (None, len(payload)) and _fits(digest, payload)):
            raise BadArchive("a payload does not fit its length or digest")
        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
    return {
        "record_id": record_id,
        "record_type": kind,
        "target_uri": named.get("warc-target-uri", ""),
        "payload_digest": digest,
        "payload_bytes": size,
        "refers_to": refers_to if kind == "revisit" else None,
        "payload": payload,
    }


def _headers(lines: list[bytes]) -> dict[str, str]:
    named: dict[str, str] = {}
    for line in lines:
        try:
            name, colon, value = line.decode().partition(":")
        except UnicodeDecodeError as error:
            raise BadArchive(f"a header is not UTF-8: {error}") from error
        name = name.lower()
        # The one header that a record may repeat.
        if not colon or name in named and name != "warc-concurrent-to":
            raise BadArchive("a header has no colon or is given twice")
        named[name] = value.strip()
    return named


def _payload(content_type: str, block: bytes) -> tuple[bytes, bool]:
    """The payload, and whether it is in a transfer coding."""
    if not content_type.lower().startswith("application/http"):
        return block, False
    head, _, body = block.partition(b"\r\n\r\n")
    return body, b"\r\ntransfer-encoding:" in head.lower()


def _fits(labelled: str, data: bytes) -> bool:
    """Whether a digest, in hex or base32, is that of the data; so are none and unknown methods."""
    method, _, value = labelled.partition(":")
    method = method.lower().replace("-", "")
    if method not in DIGESTS:
        return True
    found = hashlib.new(method, data).digest()
    return value.lower() == found.hex() or value.upper().rstrip("=") == base64.b32encode(found).decode().rstrip("=")


def _page(urn: str) -> str | None:
    """The key in a record id; None for that of a null key."""
    if not (urn.startswith("<") and urn.endswith(">") and len(urn) > 2):
        raise ValueError(urn)
    if urn == NO_KEY:
        return None
    return unquote(urn[len("<urn:page:") : -1]) if urn.startswith("<urn:page:") else urn[1:-1]


def records(found: DataFrame, content: str = "content", payloads: bool = True) -> DataFrame:
    """The records of archives, one row each. A bad archive or record ends the job.

    Every record is decoded and checked in any case; without `payloads` the column
    is null, and the bytes stay out of later steps.
    """
    names = [f.split(" ")[0] for f in RECORD_FIELDS.split(", ")]
    types = [pa.binary() if n == "payload" else pa.int64() if n == "payload_bytes" else pa.string() for n in names]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0):
                part, size = [], 0
                for raw in frames(value.as_py()):
                    record = parse_record(raw)
                    size += len(record["payload"] or b"")
                    part.append(record if payloads else record | {"payload": None})
                    if size > ARCHIVE_BYTES // 4:
                        yield _batch(part, names, types)
                        part, size = [], 0
                if part:
                    yield _batch(part, names, types)

    return found.select(content).mapInArrow(rows, RECORD_FIELDS)


def _batch(part: list[dict], names: list[str], types: list) -> pa.RecordBatch:
    return pa.record_batch([pa.array([r[n] for r in part], t) for n, t in zip(names, types)], names)


def key_of(column: str, like: str) -> Column:
    """A record id or reference as a key of type `like`."""
    return F.col(column).cast(like)


def first_copy_names(pages: DataFrame) -> tuple[str, str]:
    """Names for the digest and the first copy that `pages` does not use."""
    return free_name(pages, "digest"), free_name(pages, "first_copy")
