"""Personal data: format-preserving pseudonyms by a keyed Feistel permutation.

Values are found by pattern and validated: card numbers by Luhn digit, IBANs by
their remainder, social security numbers and addresses by range, dates by the
calendar.  A validated value is a number in the finite set of its format; a
keyed Feistel network permutes that set (walking on until the image is in it), and the image is
written in the same format, with its check digits.  Equal values get equal
pseudonyms in every document, different values different ones, and whoever has
the key can invert the map.  Anything that fails validation is left as it is.

Not looked for, so left in the text: secrets without a digit (passwords of letters) or without
a name such as token before them; phone numbers with neither + nor a bracketed area code
(212-555-0123); dates with the month as a word (12 March 1990) or a year outside 1900 to 2099; names and addresses of people.

Values are equal if they are written alike: the same date in another format, a phone number with and without its
country code, or an address in other case is another value with a pseudonym of its own.

Null and empty texts have no values and stay as they are; repeated rows are
treated alike; a very long text is searched whole, a match at a time; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import datetime as dt
import functools
import hashlib
import re
import string
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
STRETCH = 256  # characters of a secret permuted together


@dataclass(frozen=True)
class Feistel:
    """A permutation of range(size) under a key and a format name."""

    key: bytes
    name: str
    size: int

    @property
    def half(self) -> int:
        return max(1, ((self.size - 1).bit_length() + 1) // 2)

    def _round(self, k: int, value: int) -> int:
        data = b"%s|%d|%d|%d" % (self.name.encode(), self.size, k, value)
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=16).digest(), "big") & ((1 << self.half) - 1) if self.half <= 128 else self._wide(data)

    def _wide(self, data: bytes) -> int:
        digest = hashlib.shake_256(self.key + data).digest((self.half + 7) // 8)
        return int.from_bytes(digest, "big") & ((1 << self.half) - 1)

    def _once(self, x: int, order: range) -> int:
        low = (1 << self.half) - 1
        a, b = x >> self.half, x & low
        for k in order:
            if order.step == 1:
                a, b = b, a ^ self._round(k, b)
            else:
                a, b = b ^ self._round(k, a), a
        return a << self.half | b

    def _walk(self, x: int, order: range) -> int:
        if not 0 <= x < self.size:
            raise ValueError("outside the format")
        x = self._once(x, order)
        while x >= self.size:
            x = self._once(x, order)
        return x

    def forward(self, x: int) -> int:
        return self._walk(x, range(ROUNDS))

    def back(self, x: int) -> int:
        return self._walk(x, range(ROUNDS - 1, -1, -1))


def luhn_digit(digits: str) -> str:
    """The check digit to put after ``digits``."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 - i % 2)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _iban_rest(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def _to_number(text: str) -> tuple[int, int]:
    """(place of ``text`` among the strings with its pattern of digits, capitals and small letters; their number)."""
    value, size = 0, 1
    for c in text:
        kind = next((k for k in (string.digits, string.ascii_uppercase, string.ascii_lowercase) if c in k), None)
        if kind:
            value, size = value * len(kind) + kind.index(c), size * len(kind)
    return value, size


def _to_text(value: int, like: str) -> str:
    out = []
    for c in reversed(like):
        kind = next((k for k in (string.digits, string.ascii_uppercase, string.ascii_lowercase) if c in k), None)
        if kind:
            value, digit = divmod(value, len(kind))
            c = kind[digit]
        out.append(c)
    return "".join(reversed(out))


def _alike(name: str, key: bytes, text: str, inverse: bool) -> str:
    """Every digit and letter of ``text`` permuted together within its class; all else stays."""
    value, size = _to_number(text)
    f = Feistel(key, name, size)
    return _to_text(f.back(value) if inverse else f.forward(value), text) if size > 1 else text


Permute = Callable[[bytes, str, bool], str | None]
KINDS: dict[str, tuple[str, Permute]] = {}


def kind(name: str, pattern: str) -> Callable[[Permute], Permute]:
    def add(f: Permute) -> Permute:
        KINDS[name] = (pattern, f)
        return f

    return add


@kind("email", r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]{1,64}@(?:[A-Za-z0-9\-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])")
def _email(key: bytes, text: str, inverse: bool) -> str | None:
    """The local part; the domain stays."""
    local, at, domain = text.rpartition("@")
    return _alike("email", key, local, inverse) + at + domain


@kind("secret", r"(?i:(?<![A-Za-z])(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)(?:\s{0,2}[=:]\s{0,2}[\"']?))(?=[A-Za-z0-9+/_.\-]*[0-9])[A-Za-z0-9+/_\-]{16,}(?:\.[A-Za-z0-9+/_\-]+)*={0,2}")
def _secret(key: bytes, text: str, inverse: bool) -> str | None:
    """The value after the name, to its end; hexadecimal digits stay hexadecimal.  A value longer than ``STRETCH`` is permuted in stretches of that, each with a key of its own."""
    end = len(text.rstrip("="))
    at = max(text.rfind(c, 0, end) for c in "=:\"' \t\n\r\f\v") + 1
    name, value, padding = text[:at], text[at:end], text[end:]
    digits = next((d for d in ("0123456789abcdef", "0123456789ABCDEF") if set(value) <= set(d)), None)
    out = []
    for k in range(0, len(value), STRETCH):
        part, more = value[k : k + STRETCH], f"/{k}" if k else ""
        if not digits:
            out.append(_alike(f"secret{more}", key, part, inverse))
            continue
        f, n = Feistel(key, f"hex{more}", 16 ** len(part)), int(part, 16)
        image = format(f.back(n) if inverse else f.forward(n), f"0{len(part)}x")
        out.append(image if digits[-1] == "f" else image.upper())
    return name + "".join(out) + padding


@kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
def _iban(key: bytes, text: str, inverse: bool) -> str | None:
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34 or _iban_rest(plain) != 1:
        return None
    body = _alike("iban" + plain[:2], key, plain[4:], inverse)
    fresh = f"{plain[:2]}{98 - _iban_rest(plain[:2] + '00' + body):02d}{body}"
    chars = iter(fresh)
    return "".join(c if c == " " else next(chars) for c in text)


@kind("date", r"(?<![0-9A-Za-z./\-])(?:(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/(?:19|20)[0-9]{2}|[0-9]{1,2}\.[0-9]{1,2}\.(?:19|20)[0-9]{2})(?![0-9A-Za-z])")
def _date(key: bytes, text: str, inverse: bool) -> str | None:
    """Days from 1900 to 2099.  With slashes month first; day first where only that is a date."""
    sep = next(c for c in "-/." if c in text)
    a, b, c = map(int, text.split(sep))
    order = "ymd" if sep == "-" else "dmy" if sep == "." or (a > 12 >= b) else "mdy"
    found = dict(zip(order, (a, b, c), strict=True))
    try:
        day = dt.date(found["y"], found["m"], found["d"])
    except ValueError:
        return None
    first = dt.date(1900, 1, 1)
    f = Feistel(key, f"date{sep}{order}", (dt.date(2100, 1, 1) - first).days)
    n = (day - first).days
    while True:  # where only day first is possible, the image must be such a date too
        n = f.back(n) if inverse else f.forward(n)
        image = first + dt.timedelta(n)
        if not (order == "dmy" and sep == "/" and image.day <= 12):
            break
    padded = all(len(x) == 2 for x in text.split(sep)[:2]) or sep == "-"
    show = {"y": str(image.year), "m": f"{image.month:02d}" if padded else str(image.month), "d": f"{image.day:02d}" if padded else str(image.day)}
    return sep.join(show[x] for x in order)


@kind("ssn", r"(?<![0-9A-Za-z\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z\-])")
def _ssn(key: bytes, text: str, inverse: bool) -> str | None:
    area, group, serial = map(int, text.split("-"))
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    n = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    f = Feistel(key, "ssn", 898 * 99 * 9999)
    n, serial = divmod(f.back(n) if inverse else f.forward(n), 9999)
    area, group = divmod(n, 99)
    return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


@kind("card", r"(?<![0-9A-Za-z.\-])[0-9](?:[ \-]?[0-9]){12,18}(?![0-9A-Za-z])(?!\.[0-9])")
def _card(key: bytes, text: str, inverse: bool) -> str | None:
    """The first digit stays, the last is the new check digit."""
    digits = re.sub(r"[^0-9]", "", text)
    if luhn_digit(digits[:-1]) != digits[-1]:
        return None
    body = digits[0] + _alike("card", key, digits[1:-1], inverse)
    chars = iter(body + luhn_digit(body))
    return "".join(next(chars) if c.isdigit() else c for c in text)


@kind("phone", r"(?<![0-9A-Za-z+])\+[1-9][0-9]{0,2}(?:[ .\-]?\(?[0-9]{2,4}\)?){2,5}(?![.\-]?[0-9])|(?<![0-9A-Za-z(])\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])")
def _phone(key: bytes, text: str, inverse: bool) -> str | None:
    """All digits after the country code; numbers under +1 have eleven."""
    code = re.match(r"\+[1-9][0-9]{0,2}(?=[ .(\-])|\+1|\+[2-9][0-9]", text)
    head = code[0] if code else ""
    n = sum(c.isdigit() for c in text) + (0 if code else 1)
    if n != 11 if head in ("", "+1") else not 8 <= n <= 15:
        return None
    return head + _alike("phone" + head, key, text[len(head) :], inverse)


@kind("ip", r"(?<![0-9A-Za-z.\-])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z])(?!\.[0-9])")
def _ip(key: bytes, text: str, inverse: bool) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or (p[0] == "0" and p != "0") for p in parts):
        return None
    f, n = Feistel(key, "ip", 1 << 32), int.from_bytes(bytes(map(int, parts)), "big")
    return ".".join(map(str, (f.back(n) if inverse else f.forward(n)).to_bytes(4, "big")))


@functools.lru_cache(maxsize=1)
def _pattern() -> re.Pattern:
    return re.compile("|".join(f"(?P<{name}>{pattern})" for name, (pattern, _) in KINDS.items()))


@functools.lru_cache(maxsize=len(KINDS))
def _pattern_of(name: str) -> re.Pattern:
    return re.compile(KINDS[name][0])


#: A text without any of these cannot hold a value.
_HINT = re.compile(r"[@0-9]")


def _validated(text: str, m: re.Match, key: bytes, inverse: bool) -> tuple[str, int, int, str] | None:
    """The longest valid value at the start of a match: all of it, or less by words (the next value may follow a blank)."""
    name, end = m.lastgroup, m.end()
    while end > m.start():
        if end == m.end() or _pattern_of(name).fullmatch(text, m.start(), end):
            image = KINDS[name][1](key, text[m.start() : end], inverse)
            if image is not None:
                return name, m.start(), end, image
        end = text.rfind(" ", m.start(), end)
    return None


def spans(text: str | None, key: bytes, inverse: bool = False) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, pseudonym) of every validated value; after a match that fails, the search goes on inside it."""
    if not text or not _HINT.search(text):
        return []
    out, at = [], 0
    while m := _pattern().search(text, at):
        found = _validated(text, m, key, inverse)
        if found:
            out.append(found)
        at = found[2] if found else m.start() + 1
    return out


def replaced(text: str | None, found: list[tuple[str, int, int, str]]) -> str | None:
    if not found:
        return text
    parts, at = [], 0
    for _, a, b, image in found:
        parts += [text[at:a], image]
        at = b
    return "".join([*parts, text[at:]])


def pseudonymise(documents: DataFrame, key: bytes, inverse: bool = False) -> DataFrame:
    """(doc_id, text, n_values, spans) of every document.  No shuffle."""
    if not 1 <= len(key) <= 64:
        raise ValueError("the key needs 1 to 64 bytes")
    kept = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("pseudonym", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found = [spans(t, key, inverse) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([replaced(t, f) for t, f in zip(texts, found, strict=True)], pa.string()), pa.array([len(f) for f in found], pa.int64()),
                 pa.array([[dict(zip(("kind", "start", "end", "pseudonym"), s, strict=True)) for s in f] for f in found], kept)],
                ["doc_id", "text", "n_values", "spans"],
            )

    schema = "doc_id long, text string, n_values long, spans array<struct<kind:string,start:int,end:int,pseudonym:string>>"
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def digest(found: DataFrame) -> DataFrame:
    n = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", "n_values", *(n(k) for k in KINDS), "text")
