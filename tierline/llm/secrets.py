"""Secrets in texts: patterns, and candidates confirmed by their structure.

Beside the plain patterns (assign, access, hex), runs of base64 or hex are decoded, and a span is reported only if the bytes
parse: DER keys whose nested lengths fill their parents exactly, SSH keys whose length-prefixed fields do, and tokens whose
signed header is a JSON object that names its algorithm. Where a key of base64 ends, its own lengths tell: what follows it on
the next line (the end mark of a PEM file, or prose) may look like base64 too.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import give_back

#: In the order in which spans that start together are told.
KINDS = ("assign", "access", "hex", "token", "der", "ssh")
_ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ASSIGN_WORDS = ("passw", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: A run is matched whole, so a run of fewer characters holds no longer one.
_HEX = re.compile(r"[0-9a-f]{24,}")
#: Parts of base64 with dots between them, matched once; a token begins at the first "eyJ" ('{"') of a part.
_PARTS = re.compile(r"[A-Za-z0-9_.-]+")
#: What parts two lines: an end of line, as such or escaped as in JSON, and what stands before each line where it is indented, quoted
#: or commented.
_END = r"(?:\r?\n|(?:\\r)?\\n)[ \t>#*|]*"
#: Base64 of at least 32 characters, also over lines as in key files, beginning behind an escape and not inside it; and hex of either case.
_BASE64 = re.compile(rf"(?:(?<!\\)|(?<=\\n))[A-Za-z0-9+/_-]{{32,}}(?:{_END}[A-Za-z0-9+/_-]+)*={{0,2}}")
_LINE_END = re.compile(_END)
#: The marks of PEM files begin and end so; with spaces in their place, a key may stand beside them on one line.
_DASHES = re.compile(r"-{5,}")
_HEX_RUN = re.compile(r"(?:[0-9A-Fa-f]{2}){24,}")
#: Object identifiers of key algorithms, as DER has them: RSA, EC, Ed25519, X25519, Ed448, X448, DSA, RSA-PSS, DH; and of the
#: encryption of keys: PBES2, PBES1 with MD5 or SHA-1 and DES, and of PKCS #12 with triple DES, two-key triple DES and RC2.
_KEY_OIDS = {
    bytes.fromhex(x) for x in (
        "2a864886f70d010101", "2a8648ce3d0201", "2b6570", "2b656e", "2b6571", "2b656f", "2a8648ce380401", "2a864886f70d01010a", "2a864886f70d010301",
        "2a864886f70d01050d", "2a864886f70d010503", "2a864886f70d01050a", "2a864886f70d010c0103", "2a864886f70d010c0104", "2a864886f70d010c0105",
    )
}
#: Kinds of public keys and the number of their fields, the name included.
_SSH_FIELDS = {b"ssh-rsa": 3, b"ssh-dss": 5, b"ssh-ed25519": 2, b"ecdsa-sha2-nistp256": 3, b"ecdsa-sha2-nistp384": 3, b"ecdsa-sha2-nistp521": 3, b"sk-ssh-ed25519@openssh.com": 3, b"sk-ecdsa-sha2-nistp256@openssh.com": 4}
_SSH_PRIVATE = b"openssh-key-v1\0"
#: (at, size) to so many bytes of a key, or fewer where it ends.
Read = Callable[[int, int], bytes]


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tag and content of the items that fill data exactly; None if they do not."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size & 0x80:
            more = size & 0x7F
            if not 1 <= more <= 4 or at + more > len(data):
                return None
            size, at = int.from_bytes(data[at : at + more], "big"), at + more
            if size < 0x80 or (more > 1 and size < 1 << 8 * (more - 1)):
                return None
        if at + size > len(data):
            return None
        out.append((tag, data[at : at + size]))
        at += size
    return out


def is_der_key(data: bytes) -> bool:
    """PKCS #1 and SEC 1 private keys, PKCS #8 keys and subject public keys."""
    outer = der_items(data)
    if not outer or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    items = der_items(outer[0][1])
    if not items:
        return False
    tags = [t for t, _ in items]
    if tags == [2] * 9 and items[0][1] in (b"\0", b"\1"):  # the nine numbers of an RSA key
        return True
    if tags[:2] == [2, 4] and items[0][1] == b"\1" and len(items) <= 4 and all(t in (0xA0, 0xA1) and der_items(c) for t, c in items[2:]):
        return len(items[1][1]) in (28, 32, 48, 66)
    lead = items[1:] if tags[0] == 2 and items[0][1] in (b"\0", b"\1") else items
    if not lead or lead[0][0] != 0x30:
        return False
    algorithm = der_items(lead[0][1])
    if not algorithm or algorithm[0][0] != 6 or algorithm[0][1] not in _KEY_OIDS:
        return False
    return len(lead) > 1 and lead[1][0] in (3, 4) and len(lead[1][1]) > 16


def is_ssh_key(data: bytes) -> bool:
    """A public key blob, or a private key file of the OpenSSH form, to the last byte."""
    return ssh_key_end(lambda at, size: data[at : at + size], len(data)) == len(data) > 0


def _field_ends(read: Read, at: int, most: int, total: int) -> list[int]:
    """Where the length-prefixed fields from at on end, most of them, as far as they are whole."""
    out: list[int] = []
    while at + 4 <= total and len(out) < most:
        at += 4 + int.from_bytes(read(at, 4), "big")
        if at > total:
            break
        out.append(at)
    return out


def ssh_key_end(read: Read, total: int, begin: int = 0) -> int | None:
    """Where the key at begin ends, by its own nested lengths; None if they do not parse. Only lengths and names are read."""
    if read(begin, len(_SSH_PRIVATE)) != _SSH_PRIVATE:
        n = _SSH_FIELDS.get(read(begin + 4, min(64, int.from_bytes(read(begin, 4), "big"))))
        ends = _field_ends(read, begin, n, total) if n else []
        return ends[-1] if ends and len(ends) == n else None
    # Cipher, key derivation and its options; the number of keys; each public key; all private ones in one padded field.
    ends = _field_ends(read, begin + len(_SSH_PRIVATE), 3, total)
    if len(ends) < 3:
        return None
    at = ends[2] + 4
    for _ in range(int.from_bytes(read(ends[2], 4), "big")):
        whole = _field_ends(read, at, 1, total)
        if not whole or read(at + 4, 4) == _SSH_PRIVATE[:4] or ssh_key_end(read, whole[0], at + 4) != whole[0]:
            return None
        at = whole[0]
    whole = _field_ends(read, at, 1, total)
    size = whole[0] - at - 4 if whole else 0
    return whole[0] if at > ends[2] + 4 and size > 0 and size % 8 == 0 else None


def _base64(run: str) -> bytes | None:
    plain = re.sub(r"[\r\n=]", "", run).replace("-", "+").replace("_", "/")
    if len(plain) % 4 == 1:
        return None
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def is_signed_token(token: str) -> bool:
    """Header and claims are JSON objects and the header names its algorithm; unless that is none, there is a signature."""
    parts = token.split(".")
    raw = [_base64(x) if x else b"" for x in parts]
    if None in raw[:2]:
        return False
    try:
        header, claims = json.loads(raw[0]), json.loads(raw[1])
    except (ValueError, RecursionError):
        return False
    if not isinstance(header, dict) or not isinstance(claims, dict) or not isinstance(header.get("alg"), str):
        return False
    return header["alg"].lower() == "none" or raw[2] not in (None, b"")


def _chars(size: int) -> int:
    """Characters of base64 of so many bytes, without padding."""
    return -(-size * 4 // 3)


def _reader(plain: str, begin: int) -> Read:
    """Bytes of the base64 that starts at begin, decoded where they are asked for."""

    def read(at: int, size: int) -> bytes:
        low = begin + at // 3 * 4
        own = plain[low : low + (at % 3 + size + 2) // 3 * 4]
        return (_base64(own[: len(own) - (len(own) % 4 == 1)]) or b"")[at % 3 : at % 3 + size]

    return read


def _key_at(plain: str, at: int, edges: dict[int, int]) -> tuple[str, int] | None:
    """Kind and end of the key that starts at a place of plain and ends at one of edges; None if there is none."""
    if plain[at] == "M":  # a sequence: its length is in its first bytes
        head = _base64(plain[at : at + 8]) or b""
        if len(head) < 2 or head[0] != 0x30:
            return None
        more = head[1] & 0x7F if head[1] & 0x80 else 0
        if more > 4:
            return None
        end = at + _chars(2 + more + (int.from_bytes(head[2 : 2 + more], "big") if more else head[1]))
        if end not in edges or _reader(plain, at)(2 + more, 1) not in (b"\x02", b"\x30"):
            return None
        return ("der", end) if is_der_key(_base64(plain[at:end]) or b"") else None
    if not plain.startswith(("AAAA", "b3BlbnNzaC1rZXktdjEA"), at):
        return None
    rest = len(plain) - at
    size = ssh_key_end(_reader(plain, at), (rest - (rest % 4 == 1)) * 3 // 4)
    end = at + _chars(size) if size else -1
    return ("ssh", end) if end in edges else None


def _tokens(text: str) -> Iterator[tuple[int, int]]:
    """Where signed tokens begin and end: three parts, of which the first holds "eyJ". Each part is looked at once."""
    for run in _PARTS.finditer(text):
        parts = run[0].split(".") if "eyJ" in run[0] else []
        at, n = run.start(), 0
        while n + 2 < len(parts):
            from_ = parts[n].find("eyJ")
            size = 3
            if from_ >= 0 and len(parts[n]) > from_ + 3 and parts[n + 1] and is_signed_token(".".join((parts[n][from_:], *parts[n + 1 : n + 3]))):
                yield at + from_, at + sum(map(len, parts[n : n + 3])) + 2
            else:
                size = 1
            at += sum(len(p) + 1 for p in parts[n : n + size])
            n += size


def _keys_of_run(run: re.Match) -> Iterator[tuple[int, str, int]]:
    """Keys in a run of base64, from the start of a line to the end of a line."""
    body = run[0].rstrip("=")
    ends = [(x.start(), x.end()) for x in _LINE_END.finditer(body)]
    lines = list(zip([0, *(b for _, b in ends)], [*(a for a, _ in ends), len(body)], strict=True))
    plain = "".join(body[a:b] for a, b in lines).replace("-", "+").replace("_", "/")
    starts, edges, at = [], {}, 0
    for a, b in lines:
        starts.append((at, run.start() + a))
        at += b - a
        edges[at] = run.start() + b
    edges[at] = run.end()  # with padding
    done = 0
    for at, place in starts:
        found = _key_at(plain, at, edges) if at >= done else None
        if found:
            kind, done = found
            yield place, kind, edges[done]


def base_spans(text: str) -> list[tuple[int, str, int]]:
    out = []
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        out += [(m.start(), "assign", m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), "access", m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), "hex", m.end()) for m in _HEX.finditer(text)]
    return out


def confirmed_spans(text: str) -> list[tuple[int, str, int]]:
    out = []
    if "eyJ" in text:
        out += [(a, "token", b) for a, b in _tokens(text)]
    keys = {}
    for x in (text, _DASHES.sub(lambda m: " " * len(m[0]), text)) if "-----" in text else (text,):
        keys |= {span[0]: span for m in _BASE64.finditer(x) for span in _keys_of_run(m)}
    out += keys.values()
    for m in _HEX_RUN.finditer(text):
        data = bytes.fromhex(m[0])
        kind = "der" if is_der_key(data) else "ssh" if is_ssh_key(data) else None
        if kind:
            out.append((m.start(), kind, m.end()))
    return out


def find_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of all secrets, in code points, by start and then kind."""
    return sorted(base_spans(text) + confirmed_spans(text), key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


def scan_secrets(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key and spans, an array of (kind, start, end), for each row of df; null text: no spans. Rows stay where they are.

    The text is scanned whole, whatever its length. Equal rows give equal rows; an empty table gives an empty result; other
    columns are not read, whatever their names.
    """
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[{"kind": k, "start": a, "end": b} for a, k, b in find_spans(x)] if x else [] for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(span))], names=[key, "spans"])
        give_back()

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key), F.col(text)).mapInArrow(run, f"`{key}` {kind}, spans array<struct<kind: string, start: long, end: long>>")
