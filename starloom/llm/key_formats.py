"""Byte formats that hold private keys or signed tokens: each reader confirms every length before it answers."""

from __future__ import annotations

import base64
import binascii
import json

#: DER tags.
INTEGER, BITS, OCTETS, OID, SEQUENCE, CONTEXT_0, CONTEXT_1 = 0x02, 0x03, 0x04, 0x06, 0x30, 0xA0, 0xA1
#: Object identifiers as DER has them: RSA, elliptic curve and Ed25519 keys; password-based encryption; PKCS#7 data.
RSA, CURVE, ED25519 = bytes.fromhex("2a864886f70d010101"), bytes.fromhex("2a8648ce3d0201"), bytes.fromhex("2b6570")
PASSWORD_BASED = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))
PKCS7 = bytes.fromhex("2a864886f70d0107")
SSH_MAGIC = b"openssh-key-v1\0"
#: Bytes of a signature by algorithm.
SIGNATURE_BYTES = {
    "HS256": (32,), "HS384": (48,), "HS512": (64,), "ES256": (64,), "ES256K": (64,), "ES384": (96,), "ES512": (132,), "EdDSA": (64, 114),
    **dict.fromkeys(("RS256", "RS384", "RS512", "PS256", "PS384", "PS512"), (128, 256, 384, 512, 1024)),
}

Part = tuple[int, int, int]  # tag, first byte of the content, byte after it


def part_at(data: bytes, at: int, end: int) -> Part | None:
    """The tag, length and content at ``at``, if the length is written the shortest way and fits before ``end``."""
    if at + 2 > end:
        return None
    tag, size, at = data[at], data[at + 1], at + 2
    if size >= 0x80:
        more = size & 0x7F
        if not 1 <= more <= 4 or at + more > end:
            return None
        size, at = int.from_bytes(data[at: at + more], "big"), at + more
        if size < 0x80 or size >> 8 * (more - 1) == 0:
            return None
    return (tag, at, at + size) if at + size <= end else None


def parts(data: bytes, at: int, end: int) -> list[Part]:
    """What lies between ``at`` and ``end``, if it fills that exactly; nothing otherwise."""
    out = []
    while at < end:
        one = part_at(data, at, end)
        if one is None:
            return []
        out.append(one)
        at = one[2]
    return out


def declared(head: bytes) -> int:
    """Bytes that a key beginning with ``head`` says it takes: a sequence that opens with a version or another sequence; 0 otherwise."""
    if len(head) < 2 or head[0] != SEQUENCE:
        return 0
    more = head[1] & 0x7F if head[1] >= 0x80 else 0
    if more > 4 or head[1] == 0x80 or len(head) < 5 + more:
        return 0
    first = head[2 + more: 5 + more]
    if first[0] != SEQUENCE and not (first[0] == INTEGER and first[1] == 1 and first[2] <= 3):
        return 0
    return 2 + more + (int.from_bytes(head[2: 2 + more], "big") if more else head[1])


def _integers(data: bytes, inner: list[Part], version: tuple[int, ...]) -> bool:
    """All integers in their shortest form and positive, the first one a version."""
    if not inner or any(t != INTEGER or b <= a for t, a, b in inner):
        return False
    short = all(b - a == 1 or not (data[a] == 0 and data[a + 1] < 0x80) for _, a, b in inner)
    return short and all(data[a] < 0x80 for _, a, _ in inner) and int.from_bytes(data[inner[0][1]: inner[0][2]], "big") in version


def _elliptic(data: bytes, inner: list[Part]) -> bool:
    if len(inner) < 2 or inner[0][0] != INTEGER or data[inner[0][1]: inner[0][2]] != b"\x01" or inner[1][0] != OCTETS:
        return False
    marked = {CONTEXT_0: (OID, SEQUENCE), CONTEXT_1: (BITS,)}
    return 20 <= inner[1][2] - inner[1][1] <= 66 and all(
        t in marked and len(own := parts(data, a, b)) == 1 and own[0][0] in marked[t] for t, a, b in inner[2:])


def der_key(data: bytes) -> str | None:
    """The kind of private key that ``data`` is as a whole, read by its nested lengths."""
    whole = part_at(data, 0, len(data))
    if whole is None or whole[0] != SEQUENCE or whole[2] != len(data):
        return None
    inner = parts(data, whole[1], whole[2])
    tags = [t for t, _, _ in inner]
    if len(inner) in (9, 10) and _integers(data, inner[:9], (0, 1)):
        # a modulus of 512 bits at least, then exponents and primes about half as long as it
        size = [b - a for _, a, b in inner[:9]]
        return "rsa" if size[1] >= 64 and size[4] * 2 <= size[1] + 8 and tags[9:] in ([], [SEQUENCE]) else None
    if len(inner) == 6 and _integers(data, inner, (0,)):
        return "dsa" if inner[1][2] - inner[1][1] >= 64 else None
    if _elliptic(data, inner):
        return "ec"
    if tags[:3] == [INTEGER, SEQUENCE, OCTETS] and data[inner[0][1]: inner[0][2]] in (b"\x00", b"\x01"):
        kind = parts(data, inner[1][1], inner[1][2])
        held = data[inner[2][1]: inner[2][2]]
        if not kind or kind[0][0] != OID or not held:
            return None
        name = data[kind[0][1]: kind[0][2]]
        if name == RSA:
            return "pkcs8" if der_key(held) == "rsa" else None
        if name == CURVE:
            return "pkcs8" if der_key(held) == "ec" else None
        if name == ED25519:
            return "pkcs8" if held[:2] == b"\x04\x20" and len(held) == 34 else None
        return "pkcs8" if len(held) >= 16 and parts(held, 0, len(held)) else None
    if tags == [SEQUENCE, OCTETS]:
        kind = parts(data, inner[0][1], inner[0][2])
        named = kind and kind[0][0] == OID and data[kind[0][1]: kind[0][2]].startswith(PASSWORD_BASED)
        return "pkcs8-encrypted" if named and inner[1][2] - inner[1][1] >= 16 else None
    if tags[:2] == [INTEGER, SEQUENCE] and data[inner[0][1]: inner[0][2]] == b"\x03":
        kind = parts(data, inner[1][1], inner[1][2])
        return "pkcs12" if kind and kind[0][0] == OID and data[kind[0][1]: kind[0][2]].startswith(PKCS7) and len(kind) == 2 else None
    return None


def ssh_key(data: bytes) -> int:
    """Bytes that the OpenSSH private key at the front of ``data`` takes, 0 if there is none."""
    if not data.startswith(SSH_MAGIC):
        return 0
    at = len(SSH_MAGIC)

    def string() -> bytes | None:
        nonlocal at
        size = int.from_bytes(data[at: at + 4], "big")
        if at + 4 + size > len(data):
            return None
        own, at = data[at + 4: at + 4 + size], at + 4 + size
        return own

    cipher, method, options = string(), string(), string()
    if None in (cipher, method, options) or not cipher.isascii() or at + 4 > len(data):
        return 0
    keys, at = int.from_bytes(data[at: at + 4], "big"), at + 4
    if not 1 <= keys <= 16 or any(not string() for _ in range(keys)):
        return 0
    held = string()
    if not held or len(held) < 16 or len(held) % 8:
        return 0
    # without a cipher both check numbers can be read, and are the same
    return at if cipher != b"none" or held[:4] == held[4:8] else 0


def unbase64(text: str) -> bytes | None:
    """Bytes of base64 text of either alphabet, with or without its padding."""
    text = text.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _document(text: str) -> dict | None:
    found = unbase64(text)
    try:
        value = json.loads(found) if found else None
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def signed_token(pieces: list[str]) -> str | None:
    """The algorithm of a signed (three pieces) or encrypted (five) token, if header and lengths agree."""
    header = _document(pieces[0])
    name = header.get("alg") if header else None
    if not isinstance(name, str) or not name:
        return None
    if len(pieces) == 5:
        iv, tag = unbase64(pieces[2]), unbase64(pieces[4])
        return f"jwe {name}" if isinstance(header.get("enc"), str) and iv and tag and len(iv) in (12, 16) and len(tag) in (16, 24, 32) else None
    signature = unbase64(pieces[2])
    if not signature or unbase64(pieces[1]) is None:
        return None
    return f"jws {name}" if len(signature) in SIGNATURE_BYTES.get(name, (len(signature),) if len(signature) >= 16 else ()) else None
