"""Secret scan with structural confirmation.

Pattern matches (assignments, access keys, hex runs) are the base findings.  On top of
them every base64 or hex run is decoded and its structure parsed: DER key encodings
with nested lengths that must tile exactly, OpenSSH private key containers with their
counted fields, and signed tokens whose header and claims are JSON objects.  Only a
run whose structure holds is reported as a key or a token.  Lines of a key are joined
before, also where their ends are escaped; a key under an RFC 1421 encryption header has
no structure that shows, so its header and its length in cipher blocks are checked.

Map-only: a row needs nothing but its own text.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# The base patterns (ASCII classes; letters of the keyword in either case).
_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
BASE_KINDS = ("assign", "access", "hex")
# Kinds that the structural check adds, in their order after the base kinds.
ADDED_KINDS = ("pem_key", "der_key", "ssh_key", "jwt")
_RANK = {k: i for i, k in enumerate(BASE_KINDS + ADDED_KINDS)}

_PEM = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----((?:[^-]|-(?!----))*+)-----END \1-----")
_DEK = re.compile(r"DEK-Info:\s*[A-Z0-9-]+,\s*([0-9A-Fa-f]+)")
_JWT = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]+)\.(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
_RUN = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
# runs over line ends, which may be escaped as in JSON; the letter of an escape isn't part of the run
_LINE_END = r"[\x20\t]*+(?:(?:\\++[rn]|[\r\n])[\x20\t]*+)++"
_BLOCK = re.compile(r"(?:(?<=\\[nr])|(?<![A-Za-z0-9+/_-])(?!(?<=\\)[nr]))[A-Za-z0-9+/_-]{40,}+"
                    rf"(?:{_LINE_END}[A-Za-z0-9+/_-]++)*+={{0,2}}")
_BLOCK_LINE = re.compile(rf"{_LINE_END}|([A-Za-z0-9+/_-]++)")
_SSH_HEAD = base64.b64encode(b"openssh-key-v1\x00").decode()
_HEX_RUN = re.compile(r"(?:[0-9A-Fa-f]{2}){24,}")

SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """(tag, body) of each element if definite lengths tile ``data`` exactly, else None."""
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > len(data) or data[at] == 0:
                return None
            size = int.from_bytes(data[at:at + n], "big")
            at += n
        if at + size > len(data):
            return None
        items.append((tag, data[at:at + size]))
        at += size
    return items


def is_der_private_key(data: bytes) -> bool:
    """One SEQUENCE over the whole of ``data`` whose parts are those of a private key."""
    top = der_items(data)
    if not top or len(top) != 1 or top[0][0] != 0x30:
        return False
    parts = der_items(top[0][1])
    if not parts:
        return False
    tags = [t for t, _ in parts]
    if len(parts) >= 9 and tags[:9] == [0x02] * 9:  # RSA: version and eight integers
        return int.from_bytes(parts[1][1], "big") > int.from_bytes(parts[4][1], "big") > 1
    if len(parts) >= 6 and tags[:6] == [0x02] * 6 and parts[0][1] == b"\x00":  # DSA
        return True
    if tags[:3] == [0x02, 0x30, 0x04]:  # PKCS#8: version, algorithm, key
        algorithm = der_items(parts[1][1])
        return bool(algorithm) and algorithm[0][0] == 0x06
    if tags[:2] == [0x02, 0x04] and parts[0][1] == b"\x01":  # elliptic curve: version 1, key
        return len(parts[1][1]) >= 16
    if tags == [0x30, 0x04]:  # encrypted PKCS#8
        algorithm = der_items(parts[0][1])
        return bool(algorithm) and algorithm[0][0] == 0x06
    return False


def is_openssh_key(data: bytes) -> bool:
    """Container with its magic and counted fields: cipher, kdf, options, count, public, private."""
    magic = b"openssh-key-v1\x00"
    if not data.startswith(magic):
        return False
    at, fields = len(magic), 0
    for i in range(6):
        if at + 4 > len(data):
            return False
        size = int.from_bytes(data[at:at + 4], "big")
        at += 4
        if i == 3:  # number of keys
            if size != 1:
                return False
            continue
        if at + size > len(data):
            return False
        at += size
        fields += 1
    return fields == 5 and at == len(data)


def from_base64(run: str) -> bytes | None:
    """Decoded bytes of a base64 or base64url run, with or without padding."""
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def key_kind(data: bytes | None) -> str | None:
    if not data:
        return None
    if is_openssh_key(data):
        return "ssh_key"
    return "der_key" if is_der_private_key(data) else None


def is_pem_key(body: str) -> bool:
    """Whether the text between the BEGIN and END lines is a key, or an encrypted one by its header and length.

    Line ends may be escaped; RFC 1421 headers are left out.
    """
    lines = re.split(r"(?:\\+[rn]|[\r\n])+", body.replace("\\/", "/"))
    first = max((i + 1 for i, x in enumerate(lines) if ":" in x), default=0)
    data = from_base64("".join("".join(lines[first:]).split()))
    if any(x.split() == ["Proc-Type:", "4,ENCRYPTED"] for x in lines[:first]):
        vector = next((m[1] for x in lines[:first] if (m := _DEK.match(x.strip()))), "")
        block = len(vector) // 2  # the vector is one block of the cipher
        return block in (8, 16) and bool(data) and len(data) >= 32 and len(data) % block == 0
    return key_kind(data) is not None


def claimed_size(head: str) -> int | None:
    """Bytes of the DER element or OpenSSH container that begins ``head`` (base64), by its own lengths."""
    if head.startswith("M"):  # SEQUENCE
        data = from_base64(head[:8]) or b""
        if len(data) < 6:
            return None
        n = data[1] & 0x7F if data[1] & 0x80 else 0
        return 2 + n + int.from_bytes(data[2:2 + n], "big") if 1 <= n <= 4 else 2 + data[1] if not n else None
    if head.startswith(_SSH_HEAD):
        data, at = from_base64(head[:len(head) // 4 * 4]) or b"", 15
        for i in range(6):
            if at + 4 > len(data) + 2:
                return None
            at += 4 + (int.from_bytes(data[at:at + 4], "big") if i != 3 else 0)
        return at
    return None


def wrapped_keys(text: str) -> list[tuple[int, int, str]]:
    """Keys in base64 lines without BEGIN and END: from a line's start, as long as they say, to a line's end."""
    found = []
    for m in _BLOCK.finditer(text):
        lines = [x.span() for x in _BLOCK_LINE.finditer(text, m.start(), m.end()) if x[1]]
        run = "".join(text[a:b] for a, b in lines)
        at, starts, ends = 0, [], {}
        for a, b in lines:
            starts.append((at, a))
            at += b - a
            ends[at] = b
        ends[at] = m.end()  # with its padding
        done = 0
        for at, start in starts:
            if at < done or run[at] != "M" and not run.startswith(_SSH_HEAD, at):
                continue
            size = claimed_size(run[at:at + 8] if run[at] == "M" else run[at:])
            end = at + -(-size * 4 // 3) if size else 0
            if end in ends and (kind := key_kind(from_base64(run[at:end]))):
                found.append((start, ends[end], kind))
                done = end
    return found


def is_signed_token(header: str, claims: str) -> bool:
    """Header names its algorithm and both parts are JSON objects."""
    parts = []
    for part in (header, claims):
        try:
            parts.append(json.loads((from_base64(part) or b"").decode()))
        except (ValueError, RecursionError):
            return False
    return all(isinstance(p, dict) for p in parts) and isinstance(parts[0].get("alg"), str)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base findings, code points, end exclusive."""
    found = [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[1]) >= 8]
    found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return found


def confirmed_spans(text: str) -> list[tuple[int, int, str]]:
    """Runs whose decoded structure is a key or a signed token."""
    found = [(m.start(), m.end(), "pem_key") for m in _PEM.finditer(text)
             if is_pem_key(m[2])]
    inside = [(a, b) for a, b, _ in found]
    for m in _JWT.finditer(text):
        if is_signed_token(m[1], m[2]):
            found.append((m.start(), m.end(), "jwt"))
    for m in _RUN.finditer(text):
        kind = key_kind(from_base64(m[0]))
        if kind and not any(a <= m.start() < b for a, b in inside):
            found.append((m.start(), m.end(), kind))
    found += [(a, b, kind) for a, b, kind in wrapped_keys(text) if not any(x <= a < y for x, y in inside)]
    for m in _HEX_RUN.finditer(text):
        kind = key_kind(bytes.fromhex(m[0]))
        if kind:
            found.append((m.start(), m.end(), kind))
    return sorted(set(found))


def joined(spans: list[tuple[int, int, str]]) -> str:
    """kind:start:end by start, then kind as listed."""
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], _RANK[s[2]], s[1])))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Findings of every whole text, one row per row of ``docs``.

    Null text counts as empty (no findings); repeated rows are scanned each; a null id
    stays null; other columns are left out.  A failing base match is dropped and not
    retried from a later start.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                base = base_spans(text or "")
                more = confirmed_spans(text or "")
                counts = [sum(k == kind for _, _, k in base) for kind in BASE_KINDS]
                rows.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + more)))
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]),
                 *(pa.array(c, pa.string()) for c in columns[3:])],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    src = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return src.mapInArrow(run, SCHEMA)
