"""Secret scan with structural confirmation.

Fixed patterns give the base kinds.  Beside them, long runs without white space are taken as
candidates and *parsed* before anything is reported: a signed token needs a base64url header
that is JSON with an ``alg`` and a payload that is JSON; a key needs base64 or hex that decodes
to DER whose nested lengths add up and whose first members are those of a private key, or to
the length-prefixed fields of an OpenSSH key.  Armoured keys are confirmed by their body in the
same way, also where their line breaks are escapes (JSON) or parts of a quoted text.  Keys without
armour may be broken into lines: their own length tells how many characters belong to them.
Base64 or hex that decodes to an armoured key counts as one.

Null and empty texts have no spans.  A text of any length is read a fixed number of times: lines of encoded characters are
gathered once for all places where a key may begin, and lengths are read in place.  Repeated rows give repeated results, rows without an id
keep a null id, an empty table gives an empty result, and columns other than the two that are
named play no part.  Spans count code points, ends are exclusive.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_right

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import map_batches, slices, utf8

# Base patterns, with the least length of group 2 or of the match.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}
#: order of kinds whose spans start at the same place; the last three are the method's own
KINDS = ("assign", "access", "hex", "jwt", "key", "pem")

KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
PART = re.compile(rb"[A-Za-z0-9_-]+")
ENCODED = re.compile(rb"[A-Za-z0-9+/_-]{40,}={0,2}")
HEX_KEY = re.compile(rb"[0-9a-fA-F]{64,}")
MARK = re.compile(rb"-----(BEGIN|END) ([A-Z ]*PRIVATE KEY)-----")
BODY = re.compile(rb"""[A-Za-z0-9+/=\s:,."'\\-]*""")
#: what may stand between two lines: white space, its escapes, a line that goes on, the ends of quoted parts
BREAK = re.compile(rb"""(?:["']\s*+(?:[+.,]\s*+)?["']|\s|\\++[nrt]?)++""")
BASE64, BASE16 = re.compile(rb"[A-Za-z0-9+/_-]+"), re.compile(rb"[0-9a-fA-F]+")
#: where encoded DER or an encoded OpenSSH key may begin, and a longer encoded text
START64, START16 = re.compile(rb"M[A-I]"), re.compile(rb"30")
SSH64, SSH16 = re.compile(rb"b3BlbnNzaC1rZXktdjEA"), re.compile(rb"6[fF]70656[eE]7373682[dD]6")
TEXT64, TEXT16 = re.compile(rb"[A-Za-z0-9+/_-]{16}"), re.compile(rb"[0-9a-fA-F]{32}")
ESCAPED = re.compile(rb"\\[nrt]")
#: what is left of five encoded dashes in any alignment, in one piece or two
DASHES64, DASHES16 = (b"LS0", b"S0t", b"0tL", b"tLS"), (b"2d2d", b"d2d2")
#: first bytes of the DER of a private key: its length, then a version or an algorithm
HEAD = re.compile(rb"\x30(?:[\x00-\x7f]|\x81.|\x82..|\x83...|\x84....)(?:\x02\x01[\x00\x01]|\x30(?:[\x00-\x7f]|\x81.|\x82..)\x06)", re.DOTALL)
OPENSSH = b"openssh-key-v1\0"
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def decoded(candidate: bytes) -> bytes | None:
    """Bytes of a base64 or base64url text, with or without padding."""
    plain = candidate.rstrip(b"=").translate(bytes.maketrans(b"-_", b"+/"))
    if len(plain) % 4 == 1:
        return None
    try:
        return base64.b64decode(plain + b"=" * (-len(plain) % 4), validate=True)
    except binascii.Error:
        return None


def signed_token(candidate: bytes) -> bool:
    """A header with an algorithm and a payload, both JSON objects, and a signature unless there is no algorithm."""
    header, payload, signature = candidate.split(b".")
    try:
        head, body = (json.loads(decoded(x) or b"null") for x in (header, payload))
    except ValueError:
        return False
    if not isinstance(head, dict) or not isinstance(body, dict) or not isinstance(head.get("alg"), str):
        return False
    return bool(signature) and decoded(signature) is not None or head["alg"].lower() == "none"


def der(data: bytes, at: int, stop: int) -> tuple[int, int, int] | None:
    """Tag, first and last byte of the DER value at a place, or None if its length does not fit."""
    if at + 2 > stop:
        return None
    tag, size, at = data[at], data[at + 1], at + 2
    if size & 0x80:
        k = size & 0x7F
        if not 1 <= k <= 4 or at + k > stop or data[at] == 0:
            return None
        size, at = int.from_bytes(data[at : at + k], "big"), at + k
        if size < 0x80:
            return None
    return (tag, at, at + size) if at + size <= stop else None


def members(data: bytes, at: int, stop: int) -> list[tuple[int, int, int]] | None:
    """The values between two places, or None if they do not fill them exactly."""
    found = []
    while at < stop:
        value = der(data, at, stop)
        if value is None:
            return None
        found.append(value)
        at = value[2]
    return found


def private_key(data: bytes) -> bool:
    """DER of a PKCS#1, SEC 1 or PKCS#8 (also encrypted) private key, or the fields of an OpenSSH key."""
    if data[:15] == OPENSSH:
        at = 15
        for _ in range(3):  # cipher, key derivation, its options
            size = int.from_bytes(data[at : at + 4], "big")
            at += 4 + size
            if at + 4 > len(data):
                return False
        return int.from_bytes(data[at : at + 4], "big") >= 1
    outer = der(data, 0, len(data))
    if outer is None or outer[0] != 0x30 or outer[2] != len(data):
        return False
    parts = members(data, outer[1], outer[2])
    if not parts or len(parts) < 2:
        return False
    tags = [t for t, _, _ in parts]
    if tags[0] == 0x30:  # encrypted PKCS#8: algorithm, then one octet string
        inner = members(data, *parts[0][1:])
        return tags == [0x30, 0x04] and bool(inner) and inner[0][0] == 0x06
    if tags[0] != 0x02 or parts[0][2] - parts[0][1] != 1:
        return False
    version = data[parts[0][1]]
    if tags[1] == 0x30 and len(tags) >= 3 and tags[2] == 0x04:  # PKCS#8
        inner = members(data, *parts[1][1:])
        return version <= 1 and bool(inner) and inner[0][0] == 0x06
    if tags[1] == 0x04:  # SEC 1
        return version == 1 and all(t in (0xA0, 0xA1) for t in tags[2:])
    return version <= 1 and len(tags) >= 6 and all(t == 0x02 for t in tags[:6])  # PKCS#1 and DSA


def signed_tokens(run: bytes) -> list[tuple[int, int]]:
    """Places of signed tokens: parts joined by single dots, of which two begin as encoded JSON objects do."""
    found, reach = [], 0
    parts = [(m.start(), m.end()) for m in PART.finditer(run)] if b".eyJ" in run else []
    for (a, b), (c, d), after in zip(parts, parts[1:], [*parts[2:], (-1, -1)]):
        if c != b + 1 or run[b] != 46 or not run.startswith(b"eyJ", c) or d - c < 4 or run[d : d + 1] != b".":
            continue
        first = run.find(b"eyJ", max(a, reach), b)
        if first < 0 or b - first < 4:
            continue
        stop = after[1] if after[0] == d + 1 else d + 1
        reach = stop
        if signed_token(run[first:stop]):
            found.append((first, stop))
    return found


def confirmed(run: bytes, at: int) -> list[tuple[str, int, int]]:
    """Signed tokens and keys inside one run without white space."""
    found = [("jwt", at + a, at + b) for a, b in signed_tokens(run)]
    for m in HEX_KEY.finditer(run):
        if len(m[0]) % 2 == 0 and private_key(bytes.fromhex(m[0].decode())):
            found.append(("key", at + m.start(), at + m.end()))
    for m in ENCODED.finditer(run):
        data = decoded(m[0])
        if data and private_key(data):
            found.append(("key", at + m.start(), at + m.end()))
    return found


def gathered(text: bytes, at: int, line: re.Pattern) -> tuple[bytes, list[int], list[int]]:
    """The encoded characters from a place on, over line breaks, and of each line its first character's number and place."""
    parts, numbers, places, n = [], [], [], 0
    while m := line.match(text, at):
        parts.append(m[0])
        numbers.append(n)
        places.append(m.start())
        n += len(m[0])
        gap = BREAK.match(text, m.end())
        if not gap:
            break
        at = gap.end()
    return b"".join(parts), numbers, places


class Chain:
    """The encoded lines from a place on, read once; later places in them are places of the same chain."""

    def __init__(self, text: bytes, at: int, line: re.Pattern) -> None:
        self.line = line
        self.chars, self.numbers, self.places = gathered(text, at, line)
        self.stop = self.places[-1] + len(self.chars) - self.numbers[-1] if self.places else at

    def number(self, at: int) -> int | None:
        """Number of the character at a place of the text, if it is one of the chain's."""
        i = bisect_right(self.places, at) - 1
        n = self.numbers[i] + at - self.places[i] if i >= 0 else -1
        end = self.numbers[i + 1] if i + 1 < len(self.numbers) else len(self.chars)
        return n if i >= 0 and n < end else None

    def place(self, number: int) -> int:
        i = bisect_right(self.numbers, number) - 1
        return self.places[i] + number - self.numbers[i]


class Bytes:
    """What a chain says from one character on; only what is asked for is decoded."""

    def __init__(self, chain: Chain, first: int, size: int | None = None) -> None:
        self.chain, self.first = chain, first
        left = len(chain.chars) - first
        most = left // 2 if chain.line is BASE16 else left * 3 // 4
        self.size = most if size is None else min(size, most)

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, at: int | slice) -> int | bytes:
        a, b, _ = (at if isinstance(at, slice) else slice(at, at + 1)).indices(self.size)
        if self.chain.line is BASE16:
            out = bytes.fromhex(self.chain.chars[self.first + 2 * a : self.first + 2 * max(a, b)].decode())
        else:
            lo, hi = a // 3 * 4, -(-max(a, b) // 3) * 4
            chars = self.chain.chars[self.first + lo : self.first + hi]
            out = (decoded(chars[: len(chars) - (len(chars) % 4 == 1)]) or b"")[a - lo // 4 * 3 :][: max(0, b - a)]
        return out if isinstance(at, slice) else out[0]


def plain_bytes(chars: bytes, line: re.Pattern) -> bytes:
    """What whole groups of encoded characters say, with the part of a last group that makes bytes."""
    if line is BASE16:
        return bytes.fromhex(chars[: len(chars) // 2 * 2].decode())
    return decoded(chars[: len(chars) - (len(chars) % 4 == 1)]) or b""


def openssh_size(data: bytes | Bytes) -> int | None:
    """Bytes of an OpenSSH key, by the lengths of its fields."""
    at, count = len(OPENSSH), 3
    for k in range(5):  # cipher, key derivation, its options; the number of keys; then each and the private part
        if k == 3:
            count, at = int.from_bytes(data[at : at + 4], "big"), at + 4
            if not 1 <= count <= len(data):
                return None
            continue
        for _ in range({4: count + 1}.get(k, 1)):
            if at + 4 > len(data):
                return None
            at += 4 + int.from_bytes(data[at : at + 4], "big")
    return at if at <= len(data) else None


def broken_key(text: bytes, at: int, chain: Chain) -> int | None:
    """Where the encoded key that starts at a place ends, if there is one; it may be broken into lines.

    Lengths are read one after another where they stand, so a text that only looks like a key at many places costs no more.
    """
    first = chain.number(at)
    if first is None:
        return None
    data = Bytes(chain, first)
    head = data[:36]
    if head.startswith(OPENSSH):
        size = openssh_size(data)
    elif HEAD.match(head):
        size = head[1] + 2 if head[1] < 0x80 else int.from_bytes(head[2 : 2 + head[1] - 0x80], "big") + 2 + head[1] - 0x80
    else:
        return None
    if size is None or size > len(data) or not private_key(Bytes(chain, first, size)):
        return None
    need = 2 * size if chain.line is BASE16 else (4 * size + 2) // 3
    stop = chain.place(first + need - 1) + 1
    while chain.line is BASE64 and stop < len(text) and text[stop] == 61:
        stop += 1
    return stop


def armoured(text: bytes) -> list[tuple[int, int]]:
    """Places of armoured private keys whose body is one. An end mark belongs to the last begin mark, if both have one name."""
    found, begin = [], None
    for m in MARK.finditer(text) if b"-----END " in text else ():
        if m[1] == b"BEGIN":
            begin = m
            continue
        if begin is None or begin[2] != m[2]:
            begin = None
            continue
        first, begin = begin, None
        if not BODY.fullmatch(text, first.end(), m.start()):
            continue
        raw = body = text[first.end() : m.start()]
        if b"\\" in body or b'"' in body or b"'" in body:
            body = re.sub(rb"\\++u00([0-9a-fA-F]{2})", lambda x: bytes.fromhex(x[1].decode()), body)
            body = re.sub(rb"\\++[nrt]", b"\n", body).replace(b"\\", b"")
            body = re.sub(rb"""["']\s*+(?:[+.,]\s*+)?["']""", b"\n", body)
        data = decoded(b"".join(b"".join(x for x in body.split(b"\n") if b":" not in x).split()))
        if data and (b"ENCRYPTED" in raw or private_key(data)):
            found.append((first.start(), m.end()))
    return found


def merged(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Starts and stops of the union of spans, rising."""
    starts: list[int] = []
    stops: list[int] = []
    for a, b in sorted(spans):
        if stops and a <= stops[-1]:
            stops[-1] = max(stops[-1], b)
        else:
            starts.append(a)
            stops.append(b)
    return starts, stops


def inside(spans: tuple[list[int], list[int]], a: int, b: int) -> bool:
    """Whether a stretch lies inside one of the merged spans."""
    k = bisect_right(spans[0], a) - 1
    return k >= 0 and b <= spans[1][k]


def encoded_armour(text: bytes, low: bytes) -> list[tuple[int, int]]:
    """Places of base64 or hex, in one or more lines, that say an armoured private key."""
    found = []
    for pattern, line, group in ((TEXT64, BASE64, 4), (TEXT16, BASE16, 2)):
        if not (any(x in text for x in DASHES64) if line is BASE64 else any(x in low for x in DASHES16)):
            continue
        at = 0
        while m := pattern.search(text, at):
            chars, numbers, places = gathered(text, m.start() + (ESCAPED.match(text, m.start() - 1) is not None if m.start() else 0), line)
            at = places[-1] + len(chars) - numbers[-1]
            for r in range(group):  # words in front may belong to the first line's group
                data = plain_bytes(chars[r:], line)
                for a, b in armoured(data) if b"-----BEGIN " in data else ():
                    b += len(data[b:]) - len(data[b:].lstrip())
                    first, last = (2 * a, 2 * b - 1) if line is BASE16 else (4 * a // 3, (4 * b + 2) // 3 - 1)
                    i, k = (bisect_right(numbers, x + r) - 1 for x in (first, last))
                    stop = places[k] + last + r - numbers[k] + 1
                    while line is BASE64 and stop < len(text) and text[stop] == 61:
                        stop += 1
                    found.append((places[i] + first + r - numbers[i], stop))
    return found


def broken_keys(text: bytes, skip: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Places of encoded keys, in one or more lines, that do not start in a place to skip."""
    found, aside = [], merged(skip)
    for patterns, line in (((START64, SSH64), BASE64), ((START16, SSH16), BASE16)):
        for pattern in patterns:
            reach, chain = 0, None
            for m in pattern.finditer(text):
                at = m.start()
                if at < reach or at and line.match(text, at - 1, at) and text[at - 1] not in b"-_" and not ESCAPED.match(text, max(0, at - 2)):
                    continue
                if inside(aside, at, at + 1):
                    continue
                if chain is None or at >= chain.stop or chain.number(at) is None:
                    chain = Chain(text, at, line)
                stop = broken_key(text, at, chain)
                if stop is not None:
                    found.append((at, stop))
                    reach = stop
    return found


def spans_of(text: bytes, runs: list[tuple[int, int]] | None = None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all spans of a UTF-8 text, in code points, by start and kind.

    ``runs`` are its stretches of 16 bytes or more without white space, if they are known already.
    """
    found: list[tuple[str, int, int]] = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    for a, b in long_runs([text])[0] if runs is None else runs:
        run = text[a:b]
        for kind, pattern in (("access", ACCESS), ("hex", HEX)):
            found += [(kind, a + m.start(), a + m.end()) for m in pattern.finditer(run) if len(m[0]) >= LEAST[kind]]
        if b - a >= 40:
            found += confirmed(run, a)
    pem = armoured(text) if b"-----BEGIN " in text else []
    pem += encoded_armour(text, low)
    keys = broken_keys(text, pem)
    whole = merged(keys)
    found = [x for x in found if x[0] != "key" or not inside(whole, x[1], x[2])]  # a first line by itself
    found = list(dict.fromkeys([*found, *(("key", *x) for x in keys), *(("pem", *x) for x in pem)]))
    if found and not text.isascii():
        points = np.cumsum((np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80)
        place = lambda i: int(points[i - 1]) if i else 0
        found = [(k, place(a), place(b)) for k, a, b in found]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def long_runs(texts: list[bytes], least: int = 16) -> list[list[tuple[int, int]]]:
    """Per text its stretches of ``least`` bytes or more without white space."""
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    joined = b"\n".join([b"", *texts, b""])
    gaps = np.flatnonzero(SPACE[np.frombuffer(joined, dtype=np.uint8)])
    at = np.flatnonzero(np.diff(gaps) > least)
    starts = np.cumsum([1, *(len(t) + 1 for t in texts)])
    which = np.searchsorted(starts, gaps[at] + 1, side="right") - 1
    for k, a, b in zip(which.tolist(), (gaps[at] + 1).tolist(), gaps[at + 1].tolist()):
        first = int(starts[k])
        out[k].append((a - first, b - first))
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts, base digest and all spans (kind:start:end, comma-joined) of every row."""

    def start():
        def scan(rows: dict):
            raw = utf8(rows["text"])
            for a, b in slices(raw):
                spans = [spans_of(t, r) for t, r in zip(raw[a:b], long_runs(raw[a:b]))]
                yield {
                    "doc_id": rows["doc_id"][a:b],
                    "n_assign": [sum(k == "assign" for k, _, _ in s) for s in spans],
                    "n_access": [sum(k == "access" for k, _, _ in s) for s in spans],
                    "n_hex": [sum(k == "hex" for k, _, _ in s) for s in spans],
                    "base_sha256": [hashlib.sha256(joined([x for x in s if x[0] in LEAST]).encode()).hexdigest() for s in spans],
                    "spans": [joined(s) for s in spans],
                }

        return scan

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_batches(source, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string", start)


def redact(docs: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """The same rows and columns, with every secret in ``text`` replaced by a mark; overlapping spans become one.

    ``n_chars``, if there is such a column, follows the new text.
    """

    def clean(value: str | None, runs) -> str | None:
        spans = spans_of(value.encode("utf-8", "surrogatepass"), runs) if value else []
        if not spans:
            return value
        parts, at = [], 0
        for _, a, b in spans:
            if a >= at:
                parts += [value[at:a], mark]
            at = max(at, b)
        return "".join([*parts, value[at:]])

    def run(batches):
        for batch in batches:
            i = batch.schema.get_field_index(text)
            values = batch.column(i).to_pylist()
            raw = utf8(values)
            new: list = []
            for a, b in slices(raw):
                new += [clean(v, r) for v, r in zip(values[a:b], long_runs(raw[a:b]))]
            import pyarrow as pa

            yield batch.set_column(i, batch.schema.field(i), pa.array(new, batch.schema.field(i).type))

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
