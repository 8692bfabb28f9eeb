"""Personal data: format-preserving Feistel pseudonyms.

Numbers and dates that pass their format's check are written as a number below
the count of valid values of that format, put through a keyed permutation of
those numbers, and written back in the same format.  So a pseudonym is as
valid and as long as the value, equal values have equal pseudonyms in every
document, different values have different ones, and who holds the key can
turn them back.

The permutation is a balanced Feistel network with keyed BLAKE2 rounds over
the next even number of bits, walked until it returns below the count.
"""

from __future__ import annotations

import re
from datetime import date, timedelta
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import quoted

ROUNDS = 10
FIRST, LAST = date(1900, 1, 1), date(2099, 12, 31)


class Permutation:
    """Keyed permutations of 0 .. size - 1, another one for each tag."""

    def __init__(self, key: bytes, inverse: bool = False):
        if not 16 <= len(key) <= 64:
            raise ValueError("the key must have 16 to 64 bytes")
        self.key, self.inverse = key, inverse

    def _round(self, tag: bytes, i: int, half: int, x: int) -> int:
        size = (half + 7) // 8
        data = bytes([i]) + len(tag).to_bytes(2, "big") + tag + x.to_bytes(size, "big")
        out = b""
        while len(out) < size:
            out += blake2b(data + len(out).to_bytes(2, "big"), key=self.key, digest_size=min(64, max(16, size))).digest()
        return int.from_bytes(out[:size], "big") & (1 << half) - 1

    def _network(self, tag: bytes, half: int, x: int) -> int:
        left, right = x >> half, x & (1 << half) - 1
        if self.inverse:
            for i in reversed(range(ROUNDS)):
                left, right = right ^ self._round(tag, i, half, left), left
        else:
            for i in range(ROUNDS):
                left, right = right, left ^ self._round(tag, i, half, right)
        return left << half | right

    def walk(self, tag: str, x: int, size: int) -> int:
        if size < 2:
            return x
        half, tag = ((size - 1).bit_length() + 1) // 2, f"{tag}/{size}".encode()
        x = self._network(tag, half, x)
        while x >= size:
            x = self._network(tag, half, x)
        return x


def _mixed(permutation: Permutation, tag: str, digits: list[int], sizes: list[int]) -> list[int]:
    """Digits below ``sizes`` as one number, permuted, as digits again."""
    x, size = 0, 1
    for d, n in zip(digits, sizes):
        x, size = x * n + d, size * n
    x = permutation.walk(tag, x, size)
    out = []
    for n in reversed(sizes):
        x, d = divmod(x, n)
        out.append(d)
    return out[::-1]


def _refill(value: str, digits: list[int]) -> str:
    """``value`` with its digits replaced, separators as they are."""
    new = iter(digits)
    return "".join(str(next(new)) if c.isdecimal() else c for c in value)


def check_digit(digits: list[int]) -> int:
    """The digit that makes the number pass the Luhn check."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        total += d if i % 2 else 2 * d - 9 * (d > 4)
    return -total % 10


def card(value: str, p: Permutation) -> str | None:
    d = [int(c) for c in value if c.isdecimal()]
    if not 13 <= len(d) <= 19 or check_digit(d[:-1]) != d[-1] or len(set(d)) == 1:
        return None
    new = _mixed(p, "card", d[:-1], [10] * (len(d) - 1))
    return _refill(value, [*new, check_digit(new)])


def phone(value: str, p: Permutation) -> str | None:
    """7 to 15 digits; a country code stays."""
    country = len(re.match(r"(?:\+\d{1,3}(?=\D))?", value)[0])
    d = [int(c) for c in value[country:] if c.isdecimal()]
    if not 7 <= len(d) <= 15:
        return None
    return value[:country] + _refill(value[country:], _mixed(p, "phone", d, [10] * len(d)))


def ipv4(value: str, p: Permutation) -> str | None:
    """Each part keeps its count of digits."""
    parts = value.split(".")
    if any(int(x) > 255 or x != str(int(x)) for x in parts):
        return None
    least = [(0, 10, 100)[len(x) - 1] for x in parts]
    new = _mixed(p, "ipv4", [int(x) - n for x, n in zip(parts, least)], [(10, 90, 156)[len(x) - 1] for x in parts])
    return ".".join(str(x + n) for x, n in zip(new, least))


def ssn(value: str, p: Permutation) -> str | None:
    area, group, serial = map(int, value.split("-"))
    if not (0 < area < 900 and area != 666 and group and serial):
        return None
    new = _mixed(p, "ssn", [area - 1 - (area > 666), group - 1, serial - 1], [898, 99, 9999])
    return f"{new[0] + 1 + (new[0] + 1 >= 666):03}-{new[1] + 1:02}-{new[2] + 1:04}"


def day(value: str, p: Permutation) -> str | None:
    """Valid calendar days of 1900 to 2099: year first; with slashes and hyphens month first, else day first."""
    separator = re.search(r"\D", value)[0]
    parts = value.split(separator)
    orders = ((0, 1, 2),) if len(parts[0]) == 4 else ((2, 0, 1), (2, 1, 0)) if separator in "/-" else ((2, 1, 0), (2, 0, 1))
    for n, order in enumerate(orders):
        if (old := _read(parts, order)) is not None:
            return _same_width(old, parts, order, orders[:n], separator, p)
    return None


def _read(parts: list[str], order: tuple[int, ...]) -> date | None:
    try:
        d = date(*(int(parts[i]) for i in order))
    except ValueError:
        return None
    return d if FIRST <= d <= LAST else None


def _same_width(old: date, parts: list[str], order: tuple[int, ...], before: tuple, separator: str, p: Permutation) -> str:
    """The permuted day, one that no order ``before`` reads as another; without leading zeros one whose parts have as many digits."""
    short = any(len(x) == 1 for x in parts)
    widths = [len(x) for x in parts]

    def written(d: date) -> list[str]:
        out = [""] * 3
        for v, i in zip((d.year, d.month, d.day), order):
            out[i] = f"{v:0{widths[i]}}"
        return out

    def fits(d: date) -> bool:
        return (not short or all(len(str(v)) == widths[i] for v, i in zip((d.year, d.month, d.day), order))) and all(
            _read(written(d), o) is None for o in before)

    new = old
    while True:  # a walk on the cycle of a valid day returns to valid days
        new = FIRST + timedelta(p.walk("day", (new - FIRST).days, (LAST - FIRST).days + 1))
        if fits(new):
            break
    return separator.join(written(new))


def letters(value: str, p: Permutation, tag: str = "email") -> str:
    """ASCII letters and digits permuted within their kind at each place, all else as it is."""
    kinds = [next((k for k in ("az", "AZ", "09") if k[0] <= c <= k[1]), "") for c in value]
    at = [i for i, k in enumerate(kinds) if k]
    sizes = [10 if kinds[i] == "09" else 26 for i in at]
    out = list(value)
    new = _mixed(p, tag, [ord(value[i]) - ord(kinds[i][0]) for i in at], sizes)
    for i, d in zip(at, new):
        out[i] = chr(ord(kinds[i][0]) + d)
    return "".join(out)


#: Characters permuted together at most: a number of so many digits is soon handled.
TOGETHER = 64


def email(value: str, p: Permutation) -> str | None:
    """The part before the sign is permuted (the domain is its tag), a long one in pieces."""
    local, domain = value.rsplit("@", 1)
    tag = domain.lower() if len(domain) < 256 else blake2b(domain.lower().encode()).hexdigest()
    pieces = [local[i:i + TOGETHER] for i in range(0, len(local), TOGETHER)]
    return "".join(letters(x, p, f"email{n or ''}@{tag}") for n, x in enumerate(pieces)) + "@" + domain


OUTSIDE, DOMAIN = re.compile(r"[^\w.%+-]"), re.compile(r"@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}")


def addresses(text: str):
    """(start, end) of the e-mail addresses: from each sign back to what can't be in one, and on over a domain.

    Every character is looked at once or twice, however long the runs are.
    """
    free = 0  # what stands before belongs to the sign or address before
    at = text.find("@")
    while at >= 0:
        before = text[free:at]
        start = at - len(OUTSIDE.split(before)[-1])
        domain = DOMAIN.match(text, at) if start < at else None
        free = domain.end() if domain else at + 1
        if domain:
            yield start, free
        at = text.find("@", free)


def secret(value: str, p: Permutation) -> str | None:
    """Hexadecimal digits; letters keep their case (lower, unless one is upper)."""
    digits = "0123456789ABCDEF" if re.search("[A-F]", value) else "0123456789abcdef"
    if re.search("[a-f]", value) and re.search("[A-F]", value):
        return None
    return "".join(digits[d] for d in _mixed(p, "secret", [int(c, 16) for c in value], [16] * len(value)))


#: Kinds in order of priority: name, pattern (or what yields places), function.
KINDS = (
    ("email", addresses, email),
    ("secret", re.compile(r"(?i:token|secret|password|api[_-]?key)\s*[=:]\s*[\"']?([0-9A-Fa-f]{24,128})(?![0-9A-Za-z])"), secret),
    ("ipv4", re.compile(r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)"), ipv4),
    ("day", re.compile(r"(?<![\d./-])(?:\d{4}([-/.])\d{1,2}\1\d{1,2}|\d{1,2}([-/.])\d{1,2}\2\d{4})(?![\d/-])"), day),
    ("ssn", re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"), ssn),
    ("card", re.compile(r"(?<![\d+])(?:\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{4}([ -])\d{6}\2\d{5}|\d{13,19})(?!\d)"), card),
    ("phone", re.compile(r"(?<![\w+])\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
                         r"|(?<![\w+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){1,4}(?!\d)"
                         r"|(?<![\w.+-])(?:\(?\d{3}\)[ .-]?|\(?\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])"), phone),
)
ANY = re.compile(r"[0-9@]")


def replaced(text: str | None, p: Permutation) -> tuple[str | None, list[dict]]:
    """The text with its pseudonyms (null: nothing found), and what was replaced where."""
    if not text or not ANY.search(text):
        return None, []
    found: list[tuple[int, int, str, str]] = []
    rest = text  # what has been found is blotted out, so that no later kind runs into it
    for kind, pattern, function in KINDS:
        if kind == "email" and "@" not in text:
            continue
        group, before = 1 if kind == "secret" else 0, len(found)
        places = pattern(rest) if callable(pattern) else (m.span(group) for m in pattern.finditer(rest))
        for s, e in places:
            if (new := function(rest[s:e], p)) is not None:
                found.append((s, e, kind, new))
        if len(found) > before:
            parts, at = [], 0
            for s, e, _, _ in found[before:]:
                parts += (rest[at:s], "\0" * (e - s))
                at = e
            rest = "".join([*parts, rest[at:]])
    if not found:
        return None, []
    out, at = [], 0
    for s, e, _, new in sorted(found):
        out += (text[at:s], new)
        at = e
    return "".join([*out, text[at:]]), [{"kind": k, "start": s, "end": e} for s, e, k, _ in sorted(found)]


FOUND = pa.struct([("text", pa.string()), ("found", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()),
                                                                        ("end", pa.int64())])))])


def pseudonyms(text: Column, key: bytes, inverse: bool = False) -> Column:
    """Struct of ``text`` (null where nothing was found) and ``found`` (kind, start, end)."""
    p = (key, inverse)

    @F.arrow_udf("struct<text:string,found:array<struct<kind:string,start:bigint,end:bigint>>>")
    def replace(texts: pa.Array) -> pa.Array:
        permutation = Permutation(*p)
        pairs = [replaced(t, permutation) for t in texts.to_pylist()]
        return pa.array([{"text": t, "found": f} for t, f in pairs], FOUND)

    return replace(text)


def pseudonymise(docs: DataFrame, key: bytes, text: str = "text", inverse: bool = False, found: str | None = "found") -> DataFrame:
    """``docs`` with pseudonyms in the text, and ``found``: array of kind, start, end (null: not returned).

    Pseudonyms are as long as the values, so offsets hold for the text before
    and after.  With ``inverse`` they are turned back.  Null and empty texts
    stay as they are; repeated rows get equal results; a column named like
    ``found`` is replaced.
    """
    names = [c for c in docs.columns if not found or c.lower() != found.lower()]
    row = F.struct(*[quoted(c) for c in docs.columns]).alias("row")
    out = docs.select(row, pseudonyms(quoted(text), key, inverse).alias("p"))
    columns = [F.coalesce("p.text", F.col("row")[c]).alias(c) if c == text else F.col("row")[c].alias(c) for c in names]
    return out.select(*columns, *([F.col("p.found").alias(found)] if found else []))
