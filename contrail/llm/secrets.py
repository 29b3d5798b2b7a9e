"""Secret scans with structural confirmation.

Three base kinds come from patterns: ``assign`` (a named credential with a
value of 8 or more characters), ``access`` (an access key id of 16 or more)
and ``hex`` (32 or more hexadecimal digits). Two further kinds are reported
only after the bytes behind the characters have been decoded and parsed:

``key``  base64 (also wrapped over lines, or of a whole PEM block), hex (also
         with colons) or a PEM block (also without its last line) that decodes to
         a private key: DER whose nested lengths fill the bytes exactly and whose
         members are those of PKCS#1, PKCS#8, SEC1 or DSA, or the length-prefixed
         OpenSSH format;
``jwt``  a signed token whose header decodes to a JSON object naming ``alg``
         and whose payload decodes to a JSON object. It begins where no character
         of a token stands before, or behind an escaped line end.

A wrapped key's own length says how many characters it has, so what follows on the next
line does not matter; keys of more than ``MAX_KEY`` bytes, which no encoding in use
reaches, are sought on one line only. Every pattern is possessive and begins at
the edge of a run, so the time is in proportion to the text.

Defined results: a NULL or empty text has no spans; repeated rows are scanned
each on their own; a NULL id is kept; extra input columns are ignored; an empty
table gives an empty result. Texts are scanned whole, whatever their length.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from contrail.llm.common import by_value, cells, digest_of_spans

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "key", "jwt")

# On ASCII-lower-cased bytes: the value's class holds both cases of every letter.
ASSIGN = re.compile(rb"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
                    rb"([a-z0-9+/_.=-]+)")
ACCESS = re.compile(rb"AKIA[A-Z0-9]{12,}")
HEX = re.compile(rb"[0-9a-f]{32,}")
_B64 = rb"[A-Za-z0-9+/_-]"
#: Line ends within a key: real or escaped.
_WRAP = rb"(?:\r?\n|(?:\\r)?\\n)[\x20\t]*+"
BASE64_KEY = re.compile(rb"(?<![A-Za-z0-9+/_-])(?:M" + _B64 + rb"{31,}+|b3BlbnNzaC1rZXkt" + _B64
                        + rb"{24,}+)={0,2}")
#: How the members of every known private key begin: a version, or the names of a cipher.
INNER = re.compile(rb"\x30(?:[\x00-\x7f]|\x81.|\x82..|\x83...|\x84....)(?:\x02\x01[\x00\x01]|\x30)",
                   re.DOTALL)
PADDING = re.compile(rb"={0,2}")
PEM64 = re.compile(rb"(?<![A-Za-z0-9+/_-])LS0tLS1CRUdJTi" + _B64 + rb"++(?:" + _WRAP + _B64
                   + rb"{16,}+)*+(?:" + _WRAP + _B64 + rb"++)?+={0,2}")
LINE = re.compile(_B64 + rb"++")
BREAK = re.compile(_WRAP)
HEX_KEY = re.compile(rb"(?:30|6[fF]70656[eE]7373682[dD]6[bB]65792[dD])[0-9a-fA-F]{62,}+")
HEX_PAIRS = re.compile(rb"(?<![0-9a-fA-F:])30(?::(?:" + _WRAP
                       + rb")?+[0-9a-fA-F]{2}(?![0-9a-fA-F])){31,}+")
PEM = re.compile(rb"-----BEGIN (?:[A-Z0-9]+ ){0,4}PRIVATE KEY-----")
PEM_END = re.compile(rb"-----END (?:[A-Z0-9]+ ){0,4}PRIVATE KEY-----")
JWT = re.compile(rb"(?:(?<![A-Za-z0-9_-])|(?<=\\[nrt]))e[yw][A-Za-z0-9_-]{6,}+\.[A-Za-z0-9_-]{2,}+\."
                 rb"[A-Za-z0-9_-]*+")
OPENSSH = b"openssh-key-v1\x00"
#: More levels, members of one value and bytes than any private key has.
MAX_NESTING = 16
MAX_MEMBERS = 64
MAX_KEY = 1 << 14

SPANS = "array<struct<kind:string,start:bigint,end:bigint,detail:string>>"


def decode64(data: bytes) -> bytes | None:
    data = data.rstrip(b"=").replace(b"-", b"+").replace(b"_", b"/")
    if len(data) % 4 == 1:
        return None
    try:
        return base64.b64decode(data + b"=" * (-len(data) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def members(data: bytes, at: int, end: int, depth: int = 0) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of the DER values that fill data[at:end] exactly, else None."""
    found = []
    while at < end:
        if at + 2 > end:
            return None
        tag, length, at = data[at], data[at + 1], at + 2
        if length >= 0x80:
            n = length & 0x7F
            if not 1 <= n <= 4 or at + n > end:
                return None
            length, at = int.from_bytes(data[at:at + n], "big"), at + n
            if length < 0x80 or length < 1 << 8 * (n - 1):
                return None  # not the shortest form
        if tag & 0x1F == 0x1F or at + length > end:
            return None
        if tag & 0x20 and (depth >= MAX_NESTING
                           or members(data, at, at + length, depth + 1) is None):
            return None
        found.append((tag, at, at + length))
        if len(found) > MAX_MEMBERS:
            return None
        at += length
    return found


def der_key(data: bytes) -> str | None:
    """The name of the private-key encoding that ``data`` is, if any."""
    top = members(data, 0, len(data)) if data[:1] == b"\x30" else None
    if not top or len(top) != 1:
        return None
    inner = members(data, top[0][1], top[0][2])
    tags = [m[0] for m in inner]
    number = lambda m: int.from_bytes(data[m[1]:m[2]], "big")
    if tags[:1] == [0x02]:
        version = number(inner[0])
        if version <= 1 and len(tags) >= 9 and set(tags[:9]) == {0x02}:
            return "pkcs1"
        if version == 0 and tags == [0x02] * 6:
            return "dsa"
        if version <= 1 and tags[1:3] == [0x30, 0x04]:
            names = members(data, inner[1][1], inner[1][2])
            return "pkcs8" if names and names[0][0] == 0x06 else None
        if version == 1 and tags[1:2] == [0x04] and set(tags[2:]) <= {0xA0, 0xA1}:
            return "sec1"
    if tags == [0x30, 0x04]:
        names = members(data, inner[0][1], inner[0][2])
        if names and [n[0] for n in names] == [0x06, 0x30]:
            return "pkcs8-encrypted"
    return None


def openssh_size(data: bytes) -> int | None:
    """The bytes of the OpenSSH key that ``data`` begins with: magic, cipher, kdf, options, key
    count, then that many public keys and one secret part."""
    if not data.startswith(OPENSSH):
        return None
    at = len(OPENSSH)

    def block() -> bytes | None:
        nonlocal at
        if at + 4 > len(data):
            return None
        n = int.from_bytes(data[at:at + 4], "big")
        if at + 4 + n > len(data):
            return None
        at += 4 + n
        return data[at - n:at]

    if not block() or not block() or block() is None or at + 4 > len(data):
        return None
    count, at = int.from_bytes(data[at:at + 4], "big"), at + 4
    if not 1 <= count <= 64 or any(not block() for _ in range(count)) or not block():
        return None
    return at


def openssh_key(data: bytes) -> str | None:
    return "openssh" if openssh_size(data) == len(data) else None


def key_format(data: bytes | None) -> str | None:
    return (der_key(data) or openssh_key(data)) if data else None


def pem_key(body: bytes) -> str | None:
    """``body``: what stands between the two PEM lines, real or escaped line ends."""
    body = body.replace(b"\\r", b"").replace(b"\\n", b"\n")
    lines = [x.strip() for x in body.split(b"\n")]
    encrypted = any(x.startswith(b"Proc-Type:") and b"ENCRYPTED" in x for x in lines)
    data = decode64(b"".join(x for x in lines if x and b":" not in x))
    if encrypted and data and len(data) % 8 == 0:
        return "pem-encrypted"
    return key_format(data)


def der_size(head: bytes) -> int | None:
    """The bytes of the DER sequence that begins with ``head`` (six bytes or more)."""
    if head[:1] != b"\x30" or len(head) < 6:
        return None
    if head[1] < 0x80:
        return 2 + head[1]
    n = head[1] & 0x7F
    return 2 + n + int.from_bytes(head[2:2 + n], "big") if 1 <= n <= 4 else None


def unwrapped(run: bytes) -> bytes | None:
    """The bytes of base64 over several lines, without what a last single character holds."""
    chars = BREAK.sub(b"", run).rstrip(b"=")
    return decode64(chars[:len(chars) - (len(chars) % 4 == 1)])


def chars_from(raw: bytes, at: int, need: int) -> bytes:
    """The base64 characters from ``at`` on over line ends: ``need``, or those there are."""
    part = raw[at:at + need + need // 2 + 64]
    for end in (b"\\r\\n", b"\\n", b"\r\n"):
        part = part.replace(end, b"\n")
    return LINE.match(b"".join([x.lstrip(b" \t") for x in part.split(b"\n")]), 0, need)[0]


def wrapped_key(raw: bytes, at: int) -> tuple[str, int] | None:
    """(format, end) of the key in base64 that begins at ``at`` and goes on over line ends."""
    head = decode64(raw[at:at + 28]) or b""
    size = der_size(head)
    if size is None and head.startswith(OPENSSH) and head[15:18] == b"\0\0\0" and head[18]:
        run = chars_from(raw, at, 4 * MAX_KEY // 3)
        size = openssh_size(decode64(run[:len(run) - (len(run) % 4 == 1)]) or b"")
    elif size is None or not INNER.match(head):
        return None
    if size is None or size > MAX_KEY:
        return None
    need, end = (size * 4 + 2) // 3, at
    chars = chars_from(raw, at, need)
    detail = key_format(decode64(chars)) if len(chars) == need else None
    if detail is None:
        return None
    while need:  # where the last of these characters stands
        gap = BREAK.match(raw, end)
        end = gap.end() if gap else end
        line = LINE.match(raw, end, end + need)
        need, end = need - len(line[0]), line.end()
    return detail, end + len(PADDING.match(raw, end)[0])


def encoded_pem(data: bytes | None) -> str | None:
    """The format of the PEM block that decoded base64 holds."""
    begin = PEM.search(data or b"")
    end = PEM_END.search(data, begin.end()) if begin else None
    return pem_key(data[begin.end():end.start()]) if end else None


def jwt_alg(token: bytes) -> str | None:
    head, payload = token.split(b".")[:2]
    try:
        header, claims = (json.loads(decode64(x) or b"") for x in (head, payload))
    except (ValueError, RecursionError):
        return None
    if not isinstance(header, dict) or not isinstance(claims, dict):
        return None
    return header["alg"] if isinstance(header.get("alg"), str) else None


def scan(raw: bytes | None) -> list[tuple[str, int, int, str | None]]:
    """(kind, start, end, detail) in code points, by start, then kind as in ``KINDS``."""
    if not raw:
        return []
    found: list[tuple[str, int, int, str | None]] = []
    for m in ASSIGN.finditer(raw.lower()):
        if m.end(1) - m.start(1) >= 8:
            found.append(("assign", m.start(), m.end(), None))
    found += [("access", m.start(), m.end(), None) for m in ACCESS.finditer(raw)]
    found += [("hex", m.start(), m.end(), None) for m in HEX.finditer(raw)]
    pems: list[tuple[int, int]] = []
    ends = list(PEM_END.finditer(raw)) if (begins := list(PEM.finditer(raw))) else []
    for m, following in zip(begins, [*(b.start() for b in begins), len(raw)][1:], strict=False):
        i = bisect.bisect_left(ends, m.end(), key=lambda e: e.start())
        if i < len(ends) and ends[i].start() < following:
            detail, end = pem_key(raw[m.end():ends[i].start()]), ends[i].end()
        else:  # no last line: the key's own length ends it
            gap = BREAK.match(raw, m.end())
            detail, end = (wrapped_key(raw, gap.end()) if gap else None) or (None, 0)
        if detail:
            found.append(("key", m.start(), end, detail))
            pems.append((m.start(), end))

    def inside(m: re.Match) -> bool:
        i = bisect.bisect_right(pems, (m.start(), len(raw) + 1)) - 1
        return i >= 0 and m.start() < pems[i][1]

    upto = 0  # the end of the last wrapped key, whose further lines are no keys of their own
    for m in BASE64_KEY.finditer(raw):
        if inside(m) or m.start() < upto:
            continue
        detail, end = key_format(decode64(m[0])), m.end()
        if detail is None:
            detail, end = wrapped_key(raw, m.start()) or (None, 0)
        if detail:
            found.append(("key", m.start(), end, detail))
            upto = end
    for m in PEM64.finditer(raw):
        if detail := encoded_pem(unwrapped(m[0])):
            found.append(("key", m.start(), m.end(), detail))
    for m in HEX_KEY.finditer(raw):
        if len(m[0]) % 2 == 0 and (detail := key_format(bytes.fromhex(m[0].decode()))):
            found.append(("key", m.start(), m.end(), detail))
    for m in HEX_PAIRS.finditer(raw):
        if detail := key_format(bytes.fromhex(BREAK.sub(b"", m[0]).replace(b":", b"").decode())):
            found.append(("key", m.start(), m.end(), detail))
    for m in JWT.finditer(raw):
        if detail := jwt_alg(m[0]):
            found.append(("jwt", m.start(), m.end(), detail))
    if not found:
        return []
    found.sort(key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    if raw.isascii():
        return found
    points, last, total = {}, 0, 0  # every span begins and ends beside an ASCII character
    for at in sorted({x for s in found for x in s[1:3]}):
        total += len(raw[last:at].decode("utf-8", "replace"))
        points[at], last = total, at
    return [(k, points[a], points[b], d) for k, a, b, d in found]


def _scan_batch(texts):
    import pyarrow as pa

    return pa.array([[dict(zip(("kind", "start", "end", "detail"), s, strict=True))
                      for s in scan(raw)] for raw in cells(texts)],
                    type=pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()),
                                             ("end", pa.int64()), ("detail", pa.string())])))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id and ``spans``, an array of
    (kind, start, end, detail), code points, end exclusive."""
    spans = arrow_udf(_scan_batch, SPANS)
    return docs.select(F.col(id_col), spans(F.col(text_col)).alias("spans"))


def secret_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and hashes of the spans, as the op1 query returns them."""
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    count = lambda kind: F.size(F.filter(
        "spans", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        F.col(id_col), *(count(k).alias(f"n_{k}") for k in BASE_KINDS),
        F.sha2(digest_of_spans(base), 256).alias("base_sha256"),
        digest_of_spans(F.col("spans")).alias("spans"),
        *(count(k).alias(f"n_{k}") for k in KINDS[len(BASE_KINDS):]))


by_value(__name__)
