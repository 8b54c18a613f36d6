"""Secrets in texts: three plain patterns, and keys and tokens confirmed by what they decode to.

The plain patterns are assignments to password-like names, access keys and long hex runs. Besides,
every base64 or hex run that can begin a key is decoded and parsed: a DER private key must nest its
lengths exactly, down to version, algorithm and key parts; an OpenSSH key must be a chain of
length-prefixed strings; a signed token must have a JSON header that names an algorithm, a JSON
payload and a signature as long as that algorithm makes it. The declared lengths, not the run, say
where a key ends; base64 may be wrapped over lines. What doesn't parse isn't reported.

One pass over whole texts without a shuffle; every text is judged by itself.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# The plain patterns, and the least length of what they find (of the value, for assignments).
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE, LEAST_ACCESS = 6, 20
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "rsa_key", "dsa_key", "ec_key", "pkcs8_key", "encrypted_key", "openssh_key", "signed_token")

# Fixed values of the formats: how encodings begin, object identifiers, signature lengths.
SSH_MAGIC = b"openssh-key-v1\0"
ENCRYPTION_OIDS = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))
SIGNATURES = {
    "HS256": {32},
    "HS384": {48},
    "HS512": {64},
    "RS256": {128, 256, 384, 512, 1024},
    "RS384": {128, 256, 384, 512, 1024},
    "RS512": {128, 256, 384, 512, 1024},
    "PS256": {128, 256, 384, 512, 1024},
    "PS384": {128, 256, 384, 512, 1024},
    "PS512": {128, 256, 384, 512, 1024},
    "ES256": {64},
    "ES256K": {64},
    "ES384": {96},
    "ES512": {132},
    "EdDSA": {64, 114},
}
# A DER sequence begins M and A to P in base64; the others are the OpenSSH magic and "-----BEGIN".
BASE64 = re.compile(r"(?:(?<![A-Za-z0-9+/_-])|(?<=\\n))(?:M[A-P]|b3BlbnNzaC1rZXktdjE|LS0tLS1CRUdJTi)[A-Za-z0-9+/_-]{10,}")
HEX_KEY = re.compile(r"(?<![0-9A-Fa-f])(?:30|6[Ff]70656[Ee]7373682[Dd]6[Bb]65792[Dd]7631)[0-9A-Fa-f]{20,}")
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])(e[w-z][A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)")
LINE = re.compile(r"[A-Za-z0-9+/_-]+")
WRAP = re.compile(r"(?:\r?\n|\\r\\n|\\n)[\t\x20]*(?=[A-Za-z0-9+/_-])")
LONGEST_KEY = 4 + 0xFFFF  # bytes of a sequence whose length has two bytes; no private key is longer

Span = tuple[int, str, int]  # start, kind, end


def _element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the contents of the DER element at ``at``; None if it doesn't fit."""
    if at + 2 > end:
        return None
    tag, size, at = data[at], data[at + 1], at + 2
    if size >= 0x80:
        more = size - 0x80
        if more not in (1, 2) or at + more > end:
            return None
        size, at = int.from_bytes(data[at : at + more], "big"), at + more
        if size < (0x80, 0x100)[more - 1]:
            return None  # a longer form than needed
    return (tag, at, at + size) if at + size <= end else None


def _elements(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill ``data[at:end]`` exactly."""
    found = []
    while at < end:
        one = _element(data, at, end)
        if one is None:
            return None
        found.append(one)
        at = one[2]
    return found


def der_key(data: bytes) -> tuple[str, int] | None:
    """Kind and length of the DER private key that ``data`` begins with."""
    whole = _element(data, 0, len(data))
    if whole is None or whole[0] != 0x30:
        return None
    parts = _elements(data, whole[1], whole[2])
    if not parts:
        return None
    tags = [tag for tag, _, _ in parts]
    value = [data[start:end] for _, start, end in parts]

    def names_algorithm(place: int) -> bytes | None:
        inner = _elements(data, parts[place][1], parts[place][2])
        return data[inner[0][1] : inner[0][2]] if inner and inner[0][0] == 0x06 else None

    kind = None
    if set(tags) == {0x02} and value[0] == b"\0" and all(value):
        if len(tags) == 9 and len(value[1]) >= 32:
            kind = "rsa_key"
        elif len(tags) == 6 and len(value[1]) >= 32:
            kind = "dsa_key"
    elif tags[:3] == [0x02, 0x30, 0x04] and value[0] in (b"\0", b"\1") and set(tags[3:]) <= {0xA0, 0xA1, 0x81}:
        if names_algorithm(1) and value[2]:
            kind = "pkcs8_key"
    elif tags[:2] == [0x02, 0x04] and value[0] == b"\1" and 16 <= len(value[1]) <= 72:
        if len(tags) > 2 and set(tags[2:]) <= {0xA0, 0xA1}:
            kind = "ec_key"
    elif tags == [0x30, 0x04] and value[1] and (names_algorithm(0) or b"").startswith(ENCRYPTION_OIDS):
        kind = "encrypted_key"
    return (kind, whole[2]) if kind else None


def ssh_key(data: bytes) -> tuple[str, int] | None:
    """Kind and length of the OpenSSH private key that ``data`` begins with."""
    at = len(SSH_MAGIC)

    def string() -> bytes | None:
        nonlocal at
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data):
            return None
        at += 4 + size
        return data[at - size : at]

    if not data.startswith(SSH_MAGIC) or any(string() is None for _ in range(3)):
        return None
    keys, at = int.from_bytes(data[at : at + 4], "big"), at + 4
    if not 1 <= keys <= 16:
        return None
    for _ in range(keys):
        public = string()
        if not public or int.from_bytes(public[:4], "big") > len(public) - 4:
            return None
    return ("openssh_key", at) if string() else None


def _key(data: bytes) -> tuple[str, int] | None:
    return der_key(data) or ssh_key(data)


def _wrapped(text: str, at: int, most: int) -> list[tuple[int, int]]:
    """Where the base64 characters lie that begin at ``at`` and go on over line ends, ``most`` at least."""
    lines, size = [], 0
    while size < most:
        line = LINE.match(text, at)
        if line is None:
            break
        lines.append(line.span())
        size += line.end() - at
        wrap = WRAP.match(text, line.end())
        if wrap is None:
            break
        at = wrap.end()
    return lines


def _decoded(characters: str) -> bytes:
    characters = characters[: len(characters) - (len(characters) % 4 == 1)]
    padded = characters.replace("-", "+").replace("_", "/") + "=" * (-len(characters) % 4)
    return base64.b64decode(padded)


def _declared(data: bytes) -> int:
    """The bytes that the DER key at the start of ``data`` takes by its own word; 0 if it can't be one."""
    more = max(data[1] - 0x80, 0)
    if data[1] == 0x80 or more > 2:
        return 0
    inner = data[2 + more : 6 + more]
    version = inner[:2] == b"\2\1" and inner[2] < 2 and inner[3] in (0x02, 0x04, 0x30)
    algorithm = inner[0] == 0x30 and inner[2] == 0x06
    size = int.from_bytes(data[2 : 2 + more], "big") if more else data[1]
    return 2 + more + size if version or algorithm else 0


def _base64_key(text: str, at: int) -> Span | None:
    head, most = _decoded(text[at : at + 12]), LONGEST_KEY * 4 // 3 + 4
    if head[0] == 0x30:
        most = -(-_declared(head) * 4 // 3)
    lines = _wrapped(text, at, most)
    characters = "".join(text[a:b] for a, b in lines)
    if head[0] == 0x30:
        if not most or len(characters) < most:
            return None
        characters = characters[:most]
    data = _decoded(characters)
    found, length = _key(data), 0
    if found:
        kind, length = found
    elif data.startswith(b"-----BEGIN"):  # an armoured key, encoded once more
        inner = next(_base64_keys(data.decode("latin-1"), armoured=True), None)
        if inner is None:
            return None
        kind, length = inner[1], len(data)
    else:
        return None
    left = -(-length * 4 // 3)
    for start, end in lines:
        if left <= end - start:
            end = start + left
            return at, kind, end + len(re.compile("={0,2}").match(text, end)[0])
        left -= end - start
    return None


def _base64_keys(text: str, armoured: bool = False) -> Iterator[Span]:
    at = 0
    while candidate := BASE64.search(text, at):
        nested = armoured and candidate[0].startswith("LS0")
        found = None if nested else _base64_key(text, candidate.start())
        if found:
            yield found
        at = found[2] if found else candidate.end()


def _hex_keys(text: str) -> Iterator[Span]:
    for candidate in HEX_KEY.finditer(text):
        digits = candidate[0][: 2 * LONGEST_KEY]
        found = _key(binascii.unhexlify(digits[: len(digits) // 2 * 2]))
        if found:
            yield candidate.start(), found[0], candidate.start() + 2 * found[1]


def _signed_tokens(text: str) -> Iterator[Span]:
    for candidate in TOKEN.finditer(text):
        try:
            header, payload = json.loads(_decoded(candidate[1])), json.loads(_decoded(candidate[2]))
            signature = _decoded(candidate[3])
        except (ValueError, RecursionError):  # not base64, not UTF-8, not JSON
            continue
        if isinstance(header, dict) and isinstance(payload, dict) and isinstance(header.get("alg"), str):
            if len(signature) in SIGNATURES.get(header["alg"], ()):
                yield candidate.start(), "signed_token", candidate.end()


def secrets_in(text: str) -> list[Span]:
    """All spans of one text, by start and then kind, in code points."""
    found = [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    found += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    found += [*_base64_keys(text), *_hex_keys(text), *_signed_tokens(text)]
    return sorted(found, key=lambda span: (span[0], KINDS.index(span[1])))


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span, overlapping ones as one, replaced by the kind of its first."""
    pieces, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            pieces += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*pieces, text[at:]])


def secret_spans(column: Column) -> Column:
    """An array of ``(kind, start, end)`` per text: code points, end exclusive, by start and then by ``KINDS``.

    Null and empty texts have none. Every text is searched whole.
    """

    @F.arrow_udf("array<struct<kind string, start long, end long>>")
    def run(texts: pa.Array) -> pa.Array:
        ends, spans = [0], []
        for text in texts:
            spans += secrets_in(text.as_py() or "")
            ends.append(len(spans))
        parts = [pa.array([s[k] for s in spans], t) for k, t in ((1, pa.string()), (0, pa.int64()), (2, pa.int64()))]
        return pa.ListArray.from_arrays(
            pa.array(ends, pa.int32()), pa.StructArray.from_arrays(parts, ["kind", "start", "end"])
        )

    return run(column)


def masked_text(column: Column) -> Column:
    """The texts with their secrets replaced by ``[kind]``; null stays null."""

    @F.arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        whole = texts.to_pylist()
        return pa.array([t and masked(t, secrets_in(t)) for t in whole], pa.string())

    return run(column)


def joined(spans: Column) -> Column:
    """Spans as text: ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
