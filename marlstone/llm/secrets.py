"""Secret scans with structural confirmation.

Three base patterns give spans (assignments, access keys, hex runs). Beyond them,
runs that may be base64 or hex are decoded, and a span is added only if what comes
out parses: a DER private or public key whose nested lengths fit, an OpenSSH key
blob whose length fields fit, armoured key blocks, or a signed token whose header
and payload are JSON objects with an algorithm. Runs may be wrapped over lines, and
line breaks may be written as escapes.

Defined results: a null or empty text has no spans; texts of any length are
scanned whole; a repeated row has its spans again; overlapping spans of different
kinds all stay, and ties on the start follow the order of KINDS; an empty table
gives an empty result. Only the id and the text are read.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shipping import ship

#: Kinds in the order in which spans with the same start are listed: the base kinds, then the confirmed ones.
KINDS = ("assign", "access", "hex", "armour", "der_key", "ssh_key", "signed_token")
BASE = KINDS[:3]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
ARMOUR = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*(?:PRIVATE|PUBLIC) KEY)-----([^-]*)-----END \1-----")
RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}={0,2}")
HEX_RUN = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){32,}(?![0-9A-Fa-f])")
TOKEN = re.compile(r"(?<![A-Za-z0-9_.-])([A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)(?![A-Za-z0-9_-])(?!\.[A-Za-z0-9_-])")
#: A line break as an escape, of a string once or several times quoted.
ESCAPED = re.compile(r"\\+[nr]")
#: The first line of a wrapped run of base64 or hex that may be a key, and each line after it.
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])(?:M[A-P]|AAAA|b3Bl)[A-Za-z0-9+/_-]{6,}(?=[ \t]*[\r\n])")
NEXT = re.compile(r"[ \t]*[\r\n]\s*([A-Za-z0-9+/_-]+)(={0,2})")
HEX_WRAPPED = re.compile(r"(?<![0-9A-Fa-f])(?:30|000000|6[fF]70656[eE])[0-9A-Fa-f]{12,}(?=[ \t]*[\r\n])")
HEX_NEXT = re.compile(r"[ \t]*[\r\n]\s*([0-9A-Fa-f]+)(?![0-9A-Za-z])()")


def _decoded(run: str) -> bytes | None:
    """Bytes of base64 in either alphabet, padded or not; None if it is neither."""
    run = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(run) % 4 == 1:
        return None
    try:
        return base64.b64decode(run + "=" * (-len(run) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, start, end) of the DER element at ``at``; None unless its length is well formed and fits."""
    if at + 2 > end:
        return None
    tag, first, at = data[at], data[at + 1], at + 2
    if first < 0x80:
        size = first
    else:
        n = first & 0x7F
        if not 1 <= n <= 4 or at + n > end:
            return None
        size, at = int.from_bytes(data[at : at + n], "big"), at + n
        if size < 0x80:
            return None
    return (tag, at, at + size) if at + size <= end else None


#: Elements of the largest key layout (an RSA key of several primes), and fields of the largest key blob.
MOST_ELEMENTS, MOST_FIELDS = 10, 64


def _children(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    out = []
    while at < end:
        if len(out) == MOST_ELEMENTS or (one := _element(data, at, end)) is None:
            return None
        out.append(one)
        at = one[2]
    return out


def is_der_key(data: bytes) -> bool:
    """A SEQUENCE that fills the data and holds a known key layout."""
    top = _element(data, 0, len(data))
    if top is None or top[0] != 0x30 or top[2] != len(data) or not (inside := _children(data, top[1], top[2])):
        return False
    tags = [x[0] for x in inside]
    big = lambda x: x[2] - x[1] >= 16
    if len(inside) >= 9 and tags[:9] == [0x02] * 9 and inside[0][2] - inside[0][1] == 1 and big(inside[1]):
        return True  # RSA private key
    if tags == [0x02] * 6 and big(inside[1]):
        return True  # DSA private key
    if tags == [0x02, 0x02] and big(inside[0]):
        return True  # RSA public key
    if tags[:3] == [0x02, 0x30, 0x04] and (ids := _children(data, *inside[1][1:])) and ids[0][0] == 0x06:
        return True  # wrapped private key
    if tags[:2] == [0x02, 0x04] and inside[0][2] - inside[0][1] == 1 and data[inside[0][1]] == 1 and big(inside[1]) and all(t in (0xA0, 0xA1) for t in tags[2:]):
        return True  # elliptic-curve private key
    if tags == [0x30, 0x03] and (ids := _children(data, *inside[0][1:])) and ids[0][0] == 0x06 and big(inside[1]):
        return True  # wrapped public key
    return bool(tags == [0x30, 0x04] and (ids := _children(data, *inside[0][1:])) and ids[0][0] == 0x06 and big(inside[1]))  # encrypted private key


def is_ssh_key(data: bytes) -> bool:
    """The container of a private key, or a public key whose fields fill the data."""
    magic = b"openssh-key-v1\0"
    private = data.startswith(magic)
    at, n, name = len(magic) if private else 0, 0, b""
    while at < len(data):
        if at + 4 > len(data) or n == MOST_FIELDS:
            return False
        size = int.from_bytes(data[at : at + 4], "big")
        if private and n == 3:  # the number of keys, not a length
            return 1 <= size <= 16 and _fields_fit(data, at + 4)
        if at + 4 + size > len(data):
            return False
        if n == 0 and not private:
            if size >= 64:
                return False
            name = data[at + 4 : at + 4 + size]
        at, n = at + 4 + size, n + 1
    return not private and n >= 2 and name.startswith((b"ssh-", b"ecdsa-sha2-", b"sk-ssh-", b"sk-ecdsa-"))


def _fields_fit(data: bytes, at: int) -> bool:
    n = 0
    while at < len(data):
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 > len(data) or at + 4 + size > len(data) or n == MOST_FIELDS:
            return False
        at, n = at + 4 + size, n + 1
    return n >= 2


def _json_object(run: str) -> dict | None:
    try:
        got = json.loads(_decoded(run) or b"")
    except (ValueError, RecursionError):
        return None
    return got if isinstance(got, dict) else None


def _is_token(header: str, payload: str) -> bool:
    got = _json_object(header)
    return got is not None and isinstance(got.get("alg"), str) and _json_object(payload) is not None


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = []
    if ":" in text or "=" in text:
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return out


#: Fields of public keys by the start of their name; of others two are awaited.
SSH_FIELDS = ((b"ssh-rsa", 3), (b"ssh-dss", 5), (b"ecdsa-sha2-", 3), (b"sk-ssh-", 3), (b"sk-ecdsa-", 4))


def _key_size(data: bytes) -> int:
    """Length of the key that ``data`` begins, or one beyond ``data`` that it has at least; 0 if it begins none."""
    if data[:1] == b"\x30" and len(data) > 5:
        n = data[1] & 0x7F
        if data[1] < 0x80:
            return 2 + n
        return 2 + n + int.from_bytes(data[2 : 2 + n], "big") if 1 <= n <= 4 else 0
    private = data[:6] == b"openss"
    if not private and not (data[:3] == b"\0\0\0" and data[4:6] in (b"ss", b"ec", b"sk")):
        return 0
    at, k, fields = (15, 0, 4) if private else (0, 0, 2)
    while k < fields:
        if at + 4 > len(data):
            return at + 4
        size = int.from_bytes(data[at : at + 4], "big")
        if private and k == 3:  # the number of keys, then each public one and the private ones
            fields, size = 5 + size, 0
            if not 5 < fields <= 21:
                return 0
        at, k = at + 4 + size, k + 1
        if at > len(data):
            return at
        if k == 1 and not private:
            fields = next((n for name, n in SSH_FIELDS if data[4:at].startswith(name)), 2)
    return at


class Decoded:
    """Bytes of a stretch of a run of base64 or hex. Only what is asked for is decoded, so that a look at lengths and tags
    costs the same in a stretch of any size."""

    def __init__(self, run: str, begin: int, chars: int, hexed: bool):
        self.run, self.begin, self.hexed = run, begin, hexed
        self.size = chars // 2 if hexed else chars * 6 // 8
        self.end = begin + (2 * self.size if hexed else chars - (chars % 4 == 1))

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, at):
        if isinstance(at, int):
            return self[at : at + 1][0]
        start, stop, _ = at.indices(self.size)
        if stop <= start:
            return b""
        if self.hexed:
            return bytes.fromhex(self.run[self.begin + 2 * start : self.begin + 2 * stop])
        first = start // 3
        part = _decoded(self.run[self.begin + 4 * first : min(self.end, self.begin + 4 * -(-stop // 3))]) or b""
        return part[start - 3 * first : stop - 3 * first]

    def startswith(self, prefix: bytes) -> bool:
        return self[: len(prefix)] == prefix


def _wrapped_spans(text: str, first: re.Pattern, following: re.Pattern, hexed: bool) -> list[tuple[str, int, int]]:
    """Keys over two or more lines, which end where their own lengths say. The lines of a wrapped run are read once; a line that
    may begin a key says how long the key is, and the run says whether a line ends there."""
    out = []
    at, bits = 0, 4 if hexed else 6
    while m := first.search(text, at):
        lines, ends, at = [m.span()], [m.end()], m.end()
        while line := following.match(text, at):
            at = line.end()
            lines.append(line.span(1))
            ends.append(at)
            if line[2]:  # nothing follows the padding
                break
        run = "".join(text[a:b] for a, b in lines)
        upto = [0]  # characters of the run before each line
        for a, b in lines:
            upto.append(upto[-1] + b - a)
        k = 0
        while k < len(lines) - 1:
            begin, k = k, k + 1
            if begin and not first.match(text, lines[begin][0]):
                continue
            need = -(-8 * _key_size(Decoded(run, upto[begin], len(run) - upto[begin], hexed)) // bits)
            last = bisect_left(upto, upto[begin] + need)
            if not need or last - begin < 2 or last > len(lines) or upto[last] - upto[begin] != need:
                continue
            data = Decoded(run, upto[begin], need, hexed)
            if is_der_key(data) or is_ssh_key(data):
                out.append(("der_key" if data[0] == 0x30 else "ssh_key", lines[begin][0], ends[last - 1]))
                k = last
    return out


def confirmed_spans(text: str) -> list[tuple[str, int, int]]:
    out = []
    if "\\" in text:  # breaks as long as their escapes, so that places stay
        text = ESCAPED.sub(lambda m: "\n".rjust(len(m[0])), text)
    if "-----BEGIN " in text:
        for m in ARMOUR.finditer(text):
            body = "".join(line for line in m[2].splitlines() if ":" not in line)
            data = _decoded("".join(body.split()))
            if data and (is_der_key(data) or is_ssh_key(data)):
                out.append(("armour", *m.span()))
    for m in RUN.finditer(text):
        if (data := _decoded(m[0])) is not None:
            if data[:1] == b"\x30" and is_der_key(data):
                out.append(("der_key", *m.span()))
            elif (data[:4] == b"\0\0\0\x07" or data[:3] == b"\0\0\0" or data[:8] == b"openssh-") and is_ssh_key(data):
                out.append(("ssh_key", *m.span()))
    for m in HEX_RUN.finditer(text):
        data = bytes.fromhex(m[0])
        if is_der_key(data):
            out.append(("der_key", *m.span()))
        elif is_ssh_key(data):
            out.append(("ssh_key", *m.span()))
    if "\n" in text or "\r" in text:
        out += _wrapped_spans(text, WRAPPED, NEXT, False)
        out += _wrapped_spans(text, HEX_WRAPPED, HEX_NEXT, True)
    if "." in text:
        out += [("signed_token", *m.span()) for m in TOKEN.finditer(text) if _is_token(m[1], m[2])]
    return out


_RANK = {kind: i for i, kind in enumerate(KINDS)}


def in_order(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], _RANK[s[0]], s[2]))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, findings: array of struct(kind, start, end)) of every row, in code points, end exclusive; one narrow pass."""
    ship(docs.sparkSession)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def scan(batches):
        for batch in batches:
            found = [in_order(base_spans(t) + confirmed_spans(t)) if t else [] for t in batch.column(1).to_pylist()]
            rows = [[{"kind": k, "start": a, "end": b} for k, a, b in spans] for spans in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], names=["id", "findings"])

    id_kind = docs.schema[id_col].dataType.simpleString()
    got = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(scan, f"id {id_kind}, findings array<struct<kind:string,start:int,end:int>>")
    return got.withColumnRenamed("id", id_col)


def secret_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and digests of the findings of every row."""
    found = F.col("findings")
    base = F.filter(found, lambda s: s["kind"].isin(*BASE))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")
    return find_secrets(docs, id_col, text_col).select(id_col, *(count(k).alias(f"n_{k}") for k in BASE), F.sha2(joined(base), 256).alias("base_sha256"), joined(found).alias("spans"))
