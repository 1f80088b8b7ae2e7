"""WARC records: their text, and a reader of compressed files."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

_NAMESPACE = uuid.UUID("8f0a1a0c-6a2e-5c55-9b0e-2d1c6f1f5a11")
_PRINTABLE = "".join(chr(c) for c in range(0x21, 0x7F))
#: Names of the format.
_VERSION = b"WARC/1.1"
_IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id: int | None, url: str | None, content: str, copy: int) -> str:
    """The id of a page's record: equal in every run."""
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page_id}|{url}|{content}|{copy}')}>"


def sha1_label(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _uri(page_id: int | None, url: str | None) -> str:
    """The address without what can't stand in a header line."""
    return quote(url, safe=_PRINTABLE) if url else f"urn:page:{page_id if page_id is not None else ''}"


def _record(headers: list[tuple[str, str]], block: bytes, level: int) -> bytes:
    """One record as a gzip member of its own (without a time stamp, so equal records are equal bytes)."""
    head = _VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers).encode() + b"\r\n"
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(head) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def info_record(name: str, date: str, level: int = 6) -> bytes:
    block = b"format: WARC File Format 1.1\r\n"
    return _record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(_NAMESPACE, name)}>"),
                    ("WARC-Date", date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields"),
                    ("Content-Length", str(len(block)))], block, level)


def page_record(page_id: int | None, url: str | None, content: str, copy: int, payload: bytes, date: str,
                refers: tuple[int | None, str | None] | None = None, level: int = 6) -> bytes:
    """A page as a response, or as a revisit of the response of page ``refers`` = (id, url) with that payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers else http + payload
    headers = [("WARC-Type", "revisit" if refers else "response"), ("WARC-Record-ID", record_id(page_id, url, content, copy)),
               ("WARC-Date", date), ("WARC-Target-URI", _uri(page_id, url))]
    if page_id is not None:
        headers.append(("X-Page-ID", str(page_id)))
    if refers:
        headers += [("WARC-Profile", _IDENTICAL), ("WARC-Refers-To", record_id(*refers, content, 0)),
                    ("WARC-Refers-To-Target-URI", _uri(*refers)), ("WARC-Refers-To-Date", date)]
        if refers[0] is not None:
            headers.append(("X-Refers-To-Page-ID", str(refers[0])))
    headers += [("WARC-Payload-Digest", sha1_label(payload)), ("WARC-Block-Digest", sha1_label(block)),
                ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return _record(headers, block, level)


def members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The records of a compressed file, one at a time."""
    unpacker, parts = zlib.decompressobj(31), []
    while data := stream.read(chunk):
        while data:
            parts.append(unpacker.decompress(data))
            data = unpacker.unused_data
            if unpacker.eof:
                yield b"".join(parts)
                unpacker, parts = zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("the file ends inside a record")


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of a record, its digest and length checked."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0].encode() != _VERSION:
        raise ValueError(f"not a record: {lines[0][:40]}")
    headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    size = int(headers["content-length"])
    block = rest[:size]
    if len(block) != size or rest[size:] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    if headers.get("warc-block-digest", sha1_label(block)) != sha1_label(block):
        raise ValueError("a record's block digest is wrong")
    return headers, block


def page_of(headers: dict[str, str], block: bytes) -> tuple:
    """page_id, url, payload_bytes, payload_digest (lower-case hex), record_type, refers_to and payload (null for revisits)."""
    http, _, payload = block.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])
    kind = headers["warc-type"]
    if kind == "response":
        if headers["warc-payload-digest"] != sha1_label(payload) or int(fields["Content-Length"]) != len(payload):
            raise ValueError("a payload's digest or length is wrong")
    digest = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:")).hex()
    page, to = headers.get("x-page-id"), headers.get("x-refers-to-page-id")
    return (None if page is None else int(page), headers["warc-target-uri"], int(fields["Content-Length"]), digest, kind,
            None if to is None else int(to), payload if kind == "response" else None)
