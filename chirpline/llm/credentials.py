"""Secret scan with structural confirmation.

Three patterns give base spans, whatever they hold. Runs of base64 and hex
are candidates only: they are decoded, and reported if what comes out is a
secret in its own right, that is a private key whose encoding parses down to
its fields with all nested lengths right, or a signed token whose header,
claims and signature length agree.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chirpline.llm.common import blocks, text_or_empty

# The base patterns, the group whose length counts, and its least length.
BASE = {
    "assign": (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.I, 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 0, 16),
    "hex": (r"[0-9a-f]{32,}", 0, 0, 32),
}

# Spans that start together are in this order.
KINDS = (*BASE, "private_key", "encrypted_key", "signed_token")

SPANS = "array<struct<kind: string, start: long, stop: long>>"

_BASE = [(kind, re.compile(pattern, flags), group, least) for kind, (pattern, flags, group, least) in BASE.items()]
_MARKER = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]{0,40})-----")
# A run may go on over line ends, as long as its lines are long; the last one may be short.
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{40,}(?:\r?\n[A-Za-z0-9+/_-]{40,})*(?:\r?\n[A-Za-z0-9+/_-]+)?={0,2}")
_HEX = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){24,}(?![0-9A-Fa-f])")
_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])(e[w-z][A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)")
_LEGACY = re.compile(r"DEK-Info: *([A-Z0-9-]+),([0-9A-Fa-f]+)")

# Bytes of a signature by algorithm; those of RSA have the length of the modulus.
SIGNATURE_BYTES = {
    "HS256": {32}, "HS384": {48}, "HS512": {64}, "ES256": {64}, "ES256K": {64}, "ES384": {96}, "ES512": {132}, "EdDSA": {64, 114},
    **dict.fromkeys(("RS256", "RS384", "RS512", "PS256", "PS384", "PS512"), {128, 256, 384, 512, 1024}),
}
# DER tags, the prefix of password-based encryption identifiers, and the start of an OpenSSH key.
INTEGER, OCTETS, IDENTIFIER, SEQUENCE = 0x02, 0x04, 0x06, 0x30
PASSWORD_BASED = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))
OPENSSH = b"openssh-key-v1\0"

# How often an encoding may lie within another.
MOST_LAYERS = 3


class Malformed(ValueError):
    """Bytes that are not what their lengths say."""


def element(data: bytes, at: int, end: int) -> tuple[int, int, int]:
    """Tag, start and stop of the content of the DER element at ``at``, which must lie before ``end``."""
    if at + 2 > end:
        raise Malformed
    tag, size, at = data[at], data[at + 1], at + 2
    if size & 0x80:
        n = size & 0x7F
        if not 1 <= n <= 4 or at + n > end:
            raise Malformed
        size, at = int.from_bytes(data[at : at + n]), at + n
        if size < 0x80 or size < 1 << 8 * (n - 1):  # DER takes the shortest form
            raise Malformed
    if at + size > end:
        raise Malformed
    return tag, at, at + size


def children(data: bytes, at: int, end: int) -> list[tuple[int, int, int]]:
    """The elements that fill ``at`` to ``end`` exactly."""
    found = []
    while at < end:
        found.append(element(data, at, end))
        at = found[-1][2]
    return found


def _number(data: bytes, part: tuple[int, int, int]) -> int:
    tag, start, stop = part
    if tag != INTEGER or start == stop:
        raise Malformed
    return int.from_bytes(data[start:stop], signed=True)


def _algorithm(data: bytes, part: tuple[int, int, int]) -> bytes:
    tag, start, stop = part
    inner = children(data, start, stop) if tag == SEQUENCE else []
    if not inner or inner[0][0] != IDENTIFIER or len(inner) > 2:
        raise Malformed
    return data[inner[0][1] : inner[0][2]]


def der_key(data: bytes, whole: bool = True) -> tuple[str, int]:
    """Kind and length of the private key that ``data`` begins with; it must be all of it if ``whole``.

    Known are RSA and DSA keys, elliptic-curve keys, PKCS 8 keys with any of
    these or with a raw key inside, and encrypted PKCS 8 keys.
    """
    tag, start, stop = element(data, 0, len(data))
    if tag != SEQUENCE or (whole and stop != len(data)):
        raise Malformed
    parts = children(data, start, stop)
    tags = [x[0] for x in parts]
    if tags == [SEQUENCE, OCTETS]:
        if not _algorithm(data, parts[0]).startswith(PASSWORD_BASED) or parts[1][2] - parts[1][1] < 16:
            raise Malformed
        return "encrypted_key", stop
    if len(parts) < 2 or tags[0] != INTEGER:
        raise Malformed
    version = _number(data, parts[0])
    if tags[1:3] == [SEQUENCE, OCTETS] and version in (0, 1) and all(x & 0xC0 == 0x80 for x in tags[3:]):
        _algorithm(data, parts[1])
        inner = data[parts[2][1] : parts[2][2]]
        if inner[:1] == bytes([SEQUENCE]):
            der_key(inner)
        else:
            kind, _, end = element(inner, 0, len(inner))
            if kind not in (OCTETS, INTEGER) or end != len(inner) or len(inner) < 18:
                raise Malformed
        return "private_key", stop
    if tags[1] == OCTETS and version == 1 and 16 <= parts[1][2] - parts[1][1] <= 66 and all(x & 0xC0 == 0x80 for x in tags[2:]):
        return "private_key", stop
    numbers = tags[1:9] if tags[9:] == [SEQUENCE] else tags[1:]
    if set(numbers) == {INTEGER} and version in (0, 1) and len(numbers) in (5, 8):
        # a modulus or prime of 512 bits at least, and nothing negative or nought
        if parts[1][2] - parts[1][1] >= 64 and all(_number(data, x) > 0 for x in parts[1 : 1 + len(numbers)]):
            return "private_key", stop
    raise Malformed


def openssh_key(data: bytes) -> tuple[str, int]:
    """Kind and length of the OpenSSH private key that ``data`` begins with."""
    if not data.startswith(OPENSSH):
        raise Malformed
    at = len(OPENSSH)

    def number(at: int) -> int:
        if at + 4 > len(data):
            raise Malformed
        return int.from_bytes(data[at : at + 4])

    def field(at: int) -> tuple[bytes, int]:
        stop = at + 4 + number(at)
        if stop > len(data):
            raise Malformed
        return data[at + 4 : stop], stop

    cipher, at = field(at)
    _, at = field(at)
    _, at = field(at)
    n, at = number(at), at + 4
    if not 1 <= n <= 64:
        raise Malformed
    for _ in range(n):
        public, at = field(at)
        if len(public) < 8 or 4 + int.from_bytes(public[:4]) > len(public):
            raise Malformed
    secret, at = field(at)
    if not secret or len(secret) % 8:
        raise Malformed
    if cipher == b"none":
        if secret[:4] != secret[4:8]:
            raise Malformed
        return "private_key", at
    return "encrypted_key", at


def _decoded(run: str) -> bytes:
    """Base64 or its variant for addresses, padded or not; what is too much at the end is left off."""
    run = "".join(run.split()).rstrip("=").replace("-", "+").replace("_", "/")
    run = run[: len(run) - 1] if len(run) % 4 == 1 else run
    return base64.b64decode(run + "=" * (-len(run) % 4))


def key_in(data: bytes, layers: int = MOST_LAYERS) -> tuple[str, int] | None:
    """Kind and length of the private key that ``data`` begins with, armoured or not, also within another encoding."""
    if len(data) < 48:
        return None
    try:
        if data[0] == SEQUENCE:
            return der_key(data, whole=False)
        if data.startswith(OPENSSH):
            return openssh_key(data)
    except Malformed:
        return None
    if layers and data.startswith((b"-----BEGIN ", b"M", b"LS0t", b"b3Blbn")):
        text = data.decode("latin-1")
        for kind, start, stop in keys_of(text, layers - 1):
            if start == 0:
                return kind, stop
    return None


def armoured(label: str, body: str) -> str | None:
    """The kind of key between two markers, or none if it is not what the label says."""
    if not label.endswith("PRIVATE KEY"):
        return None
    if legacy := _LEGACY.search(body):  # encrypted as a whole: what can be checked is the size of its blocks
        block = 8 if "DES" in legacy[1] else 16
        data = _try(_decoded, body[legacy.end() :])
        return "encrypted_key" if data and len(data) % block == 0 and len(legacy[2]) == 2 * block else None
    data = _try(_decoded, body.replace("\\r", " ").replace("\\n", " "))
    if not data:
        return None
    try:
        return (openssh_key(data) if label.startswith("OPENSSH") else der_key(data))[0]
    except Malformed:
        return None


def _try(decode, run: str) -> bytes | None:
    try:
        return decode(run)
    except (ValueError, binascii.Error):
        return None


def keys_of(text: str, layers: int = MOST_LAYERS) -> list[tuple[str, int, int]]:
    """``kind, start, stop`` of the private keys in a text: between markers, or bare in base64 or hex."""
    found = []
    opened = None
    for marker in _MARKER.finditer(text):
        if marker[1] == "BEGIN":
            opened = marker
        elif opened and opened[2] == marker[2]:
            if kind := armoured(marker[2], text[opened.end() : marker.start()]):
                found.append((kind, opened.start(), marker.end()))
            opened = None
    places = iter(found[:])
    inside = next(places, None)
    bare = []
    runs = chain(((x, False) for x in _BASE64.finditer(text)), ((x, True) for x in _HEX.finditer(text)))
    for run, is_hex in sorted(runs, key=lambda x: x[0].start()):
        while inside and inside[2] <= run.start():
            inside = next(places, None)
        if inside and inside[1] <= run.start():
            continue
        data = _try(bytes.fromhex if is_hex else _decoded, run[0])
        key = key_in(data, layers) if data else None
        if key:
            digits = 2 * key[1] if is_hex else -(-key[1] * 4 // 3)
            bare.append((key[0], run.start(), _after(text, run.start(), run.end(), digits)))
    return sorted(found + bare, key=lambda x: x[1])


def _after(text: str, start: int, stop: int, digits: int) -> int:
    """Where the first ``digits`` digits of a run end, with the padding that follows them."""
    at = start
    while at < stop and digits:
        digits -= text[at] not in "\r\n"
        at += 1
    while at < stop and text[at] == "=":
        at += 1
    return at


def signed_tokens(text: str) -> list[tuple[str, int, int]]:
    """Tokens of three parts: a header that names an algorithm, claims, and a signature of the length it makes."""
    found = []
    for token in _TOKEN.finditer(text):
        try:
            header, claims = (json.loads(_decoded(x)) for x in (token[1], token[2]))
            known = SIGNATURE_BYTES.get(header["alg"]) if isinstance(header, dict) and isinstance(header.get("alg"), str) else None
            if known and isinstance(claims, dict) and len(_decoded(token[3])) in known:
                found.append(("signed_token", token.start(), token.end()))
        except (ValueError, RecursionError):
            continue
    return found


def spans(text: str) -> list[tuple[str, int, int]]:
    """``kind, start, stop`` of all that is found in a text, in code points, by start and then as ``KINDS`` lists them."""
    found = [
        (kind, x.start(), x.end())
        for kind, pattern, group, least in _BASE
        for x in pattern.finditer(text)
        if x.end(group) - x.start(group) >= least
    ]
    found += keys_of(text) + signed_tokens(text)
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def find_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, spans``, an array of ``kind, start, stop``.

    Places are code points of the whole text, ``stop`` exclusive. Null and
    empty texts have no spans. Rows that repeat have rows of their own; other
    columns are not looked at. Spans of different kinds may overlap; of one
    kind they do not. An empty table gives no rows. One pass without a
    shuffle, and time in proportion to the text, whatever its length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            for block in blocks(batch, "text"):
                found = [[dict(zip(("kind", "start", "stop"), x, strict=True)) for x in spans(y)] for y in block.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(found, kind)], ["doc_id", "spans"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id long, spans {SPANS}")


def listed(found: Column) -> Column:
    """Spans as ``kind:start:stop``, joined by commas."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ",")


def secret_digests(docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` out of ``find_secrets``."""

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda x: x["kind"].isin(*kinds))

    return find_secrets(docs).select(
        "doc_id",
        *(F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in BASE),
        F.sha2(listed(of(*BASE)), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
