"""Personal data replaced by format-preserving pseudonyms from keyed Feistel networks.

A value is found by its pattern, validated (checksum, calendar, ranges), turned into a number
within the set of all values of its format, permuted there under the key, and written back
with its own separators. So a valid card number stays valid, a date stays a date, lengths
and letter cases stay, and equal values get equal pseudonyms in all documents, whatever
their separators. The permutation is a bijection: whoever has the key can undo it.

Everything happens inside the row of the text: no shuffle, no table of values. Null texts
stay null and empty ones empty, both with no span. Repeated rows get equal results; other
columns are ignored. Long digit runs that are no valid card number are permuted among the
invalid ones of their length.
"""

from __future__ import annotations

import datetime
import hashlib
import ipaddress
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerclock.llm.cluster import map_arrow

ROUNDS = 8

_DIGITS = "0123456789"
_LOWER = "abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()
# Dates are permuted within these years, ends exclusive.
_ERAS = ((1, 1000), (1000, 1900), (1900, 2100), (2100, 10000))

# Kinds in the order in which they claim their place, with their patterns.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
    "date": (
        r"(?<![\d./-])(?:\d{4}-\d{1,2}-\d{1,2}|\d{4}/\d{1,2}/\d{1,2}|\d{4}\.\d{2}\.\d{2}"
        r"|\d{1,2}[./-]\d{1,2}[./-]\d{4})(?![\d/-]|\.\d)"
    ),
    "ip": (
        r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d)"
        r"|(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:]|\.\d)"
    ),
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\d+-])\d(?:[ -]?\d){11,18}(?![\d-])",
    # Groups of any size after a country code; national ones in groups of three and four, in
    # pairs, after a leading 0, five and five, and ten or eleven digits on end.
    "phone": (
        r"\+\d(?:(?:[ ./-]|[ .-]?\(|\)[ ./-]?)?\d){6,14}(?!\d)"
        r"|(?<![\d.])(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?![ -]?\d)"
        r"|(?<![\w.,+/-])0\d(?:[ .-]\d{2}){4}(?![ .-]?\d)"
        r"|(?<![\w.,+/-])(?:\(0\d{1,4}\)[ /-]?|0\d{1,4}[ /-])\d{2,8}(?:[ -]\d{2,8}){0,3}(?![ /.-]?\d)"
        r"|(?<![\w.,+/-])[6-9]\d{4}[ -]\d{5}(?![ /.-]?\d)"
        r"|(?<![\w.,+/-])(?:[2-9]\d{9}|1[2-9]\d{9}|0\d{8,10})(?![\w/-]|[.,]\d)"
    ),
}
KINDS = tuple(PATTERNS)
_COMPILED = {kind: re.compile(pattern, re.ASCII) for kind, pattern in PATTERNS.items()}
# Numbers with a country code claim their place before digit runs do.
_INTERNATIONAL = re.compile(PATTERNS["phone"].split("|(?<!")[0], re.ASCII)
_PASSES = [x for x in _COMPILED.items() if x[0] != "card" and x[0] != "phone"]
_PASSES += [("phone", _INTERNATIONAL), ("card", _COMPILED["card"]), ("phone", _COMPILED["phone"])]

# Country codes of one and two digits; all others have three.
_SHORT_CODES = re.compile(
    r"[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]", re.ASCII
)
# First digits of national numbers, as the patterns tell them apart.
_LEADS = re.compile(r"(0)|(1[01])|(1)|([2-5])|([6-9])")

IBAN_LENGTHS = {
    code[:2]: int(code[2:])
    for code in (
        "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27"
        " DK18 DO28 EE20 EG29 ES24 FI18 FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22"
        " IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19"
        " MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31"
        " SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30"
    ).split()
}
_ANY = re.compile(r"\d\D{0,3}\d|@|:[0-9A-Fa-f]{0,4}:")


class Feistel:
    """A keyed permutation of the numbers below ``size``, one for each ``name``."""

    def __init__(self, key: bytes):
        self._key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, name: str, size: int, i: int, half: int, below: int) -> int:
        data = f"{name}:{size}:{i}:{half}".encode()
        need = (below.bit_length() + 7) // 8 + 8
        digest = b""
        while len(digest) < need:
            mark = len(digest).to_bytes(4, "big")
            digest += hashlib.blake2b(mark + data, key=self._key).digest()
        return int.from_bytes(digest[:need], "big") % below

    def permuted(self, value: int, size: int, name: str, inside: Callable = lambda x: True) -> int:
        """The image of ``value``; walks on until the image is below ``size`` and ``inside``."""
        if size < 2:
            return value
        left_size = 1 << (size - 1).bit_length() // 2
        right_size = 1 << ((size - 1).bit_length() + 1) // 2
        while True:
            left, right = value % left_size, value // left_size
            sizes = [left_size, right_size]
            for i in range(ROUNDS):
                left = (left + self._round(name, size, i, right, sizes[0])) % sizes[0]
                left, right, sizes = right, left, sizes[::-1]
            value = left + right * sizes[0]
            if value < size and inside(value):
                return value


def _alphabet(c: str) -> str:
    for letters in (_DIGITS, _LOWER, _UPPER):
        if c in letters:
            return letters
    return ""


def permuted_text(cipher: Feistel, text: str, name: str) -> str:
    """``text`` with digits and letters permuted, each within its class; the rest stays."""
    value, size = 0, 1
    for c in text:
        letters = _alphabet(c)
        if letters:
            value, size = value * len(letters) + letters.index(c), size * len(letters)
    value = cipher.permuted(value, size, name + ":" + re.sub(r"[^\W_]", "x", text))
    out = []
    for c in reversed(text):
        letters = _alphabet(c)
        if letters:
            value, place = divmod(value, len(letters))
            c = letters[place]
        out.append(c)
    return "".join(reversed(out))


def luhn_digit(digits: str) -> str:
    """The check digit that makes ``digits`` plus it valid."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return str(-total % 10)


def _luhn_valid(digits: str) -> bool:
    return luhn_digit(digits[:-1]) == digits[-1]


def _refilled(shape: str, characters: str) -> str:
    """``shape`` with its letters and digits replaced one by one."""
    rest = iter(characters)
    return "".join(next(rest) if c.isalnum() else c for c in shape)


def _email(cipher: Feistel, found: str) -> str:
    local, _, domain = found.rpartition("@")
    name, dot, top = domain.rpartition(".")
    return permuted_text(cipher, local, "local") + "@" + (
        permuted_text(cipher, name, "domain") + dot + top
    )


def _iban_check(country: str, rest: str) -> int:
    number = "".join(str(int(c, 36)) for c in rest + country + "00")
    return 98 - int(number) % 97


def _iban(cipher: Feistel, found: str) -> str | None:
    """Of its country's length, or else as long as the checksum and whole words allow."""
    ends = [i for i in range(len(found), 14, -1) if i == len(found) or found[i] == " "]
    for end in ends:
        part = found[:end]
        plain = part.replace(" ", "")
        country, check, rest = plain[:2], plain[2:4], plain[4:]
        if not 15 <= len(plain) <= 34 or (
            end < len(found) and len(plain) != IBAN_LENGTHS.get(country, len(plain))
        ):
            continue
        if _iban_check(country, rest) == int(check):
            rest = permuted_text(cipher, rest, "iban" + country)
            return _refilled(part, f"{country}{_iban_check(country, rest):02d}{rest}")
    return None


def _day_class(day: datetime.date) -> tuple[int, bool]:
    """Dates of a class can all be written in the same widths and orders."""
    return (day.day > 9) + (day.day > 12), day.month > 9


def _date(cipher: Feistel, found: str) -> str | None:
    """Year first, and day first or else month first when only that is a date."""
    parts = re.split("[./-]", found)
    for order in ["ymd"] if len(parts[0]) == 4 else ["dmy", "mdy"]:
        year, month, day = (int(parts[order.index(c)]) for c in "ymd")
        try:
            old = datetime.date(year, month, day)
        except ValueError:
            continue
        low, high = next(x for x in _ERAS if year < x[1])
        first = datetime.date(low, 1, 1).toordinal()
        size = datetime.date(high - 1, 12, 31).toordinal() + 1 - first
        same = lambda x: _day_class(datetime.date.fromordinal(first + x)) == _day_class(old)
        new = datetime.date.fromordinal(
            first + cipher.permuted(old.toordinal() - first, size, f"date:{low}", same)
        )
        values = {"y": new.year, "m": new.month, "d": new.day}
        digits = "".join(f"{values[c]:0{len(x)}d}" for c, x in zip(order, parts, strict=True))
        return _refilled(found, digits)
    return None


def _ip(cipher: Feistel, found: str) -> str | None:
    """Among the addresses whose parts have as many digits."""
    if ":" in found:
        return _ip6(cipher, found)
    parts = found.split(".")
    if max(map(int, parts)) > 255 or any(len(x) > 1 and x[0] == "0" for x in parts):
        return None
    ranges = [(0, 10), (10, 100), (100, 256)]
    value, size = 0, 1
    for part in parts:
        low, high = ranges[len(part) - 1]
        value, size = value * (high - low) + int(part) - low, size * (high - low)
    value = cipher.permuted(value, size, "ip" + "".join(str(len(x)) for x in parts))
    new = []
    for part in reversed(parts):
        low, high = ranges[len(part) - 1]
        value, place = divmod(value, high - low)
        new.append(str(place + low))
    return ".".join(reversed(new))


def _ip6(cipher: Feistel, found: str) -> str | None:
    """Without a digit it takes three groups, else it may be a name in a program."""
    try:
        ipaddress.IPv6Address(found)
    except ValueError:
        return None
    groups = [x for x in found.split(":") if x]
    plain = "".join(groups)
    told = lambda x: len(groups) > 2 or any(c in _DIGITS for c in x)
    if len(groups) < 2 or not told(plain):
        return None
    n = len(plain)
    shape = re.sub("[^:]", "x", found)
    new = cipher.permuted(int(plain, 16), 16**n, "ip6" + shape, lambda x: told(f"{x:0{n}x}"))
    text = f"{new:0{n}x}"
    return _refilled(found, text.upper() if re.search("[A-F]", found) else text)


def _valid_ssn(digits: str) -> bool:
    area, group, serial = digits[:3], digits[3:5], digits[5:]
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


def _ssn(cipher: Feistel, found: str) -> str | None:
    digits = found.replace("-", "")
    if not _valid_ssn(digits):
        return None
    new = cipher.permuted(int(digits), 10**9, "ssn", lambda n: _valid_ssn(f"{n:09d}"))
    return _refilled(found, f"{new:09d}")


def _phone(cipher: Feistel, found: str) -> str | None:
    """Country codes stay; national numbers keep the class of their first digit."""
    digits = re.sub(r"\D", "", found)
    if not 7 <= len(digits) <= 15:
        return None
    if found[0] != "+":
        lead = _LEADS.match(digits).lastindex
        n = len(digits)
        same = lambda x: _LEADS.match(f"{x:0{n}d}").lastindex == lead
        return _refilled(found, f"{cipher.permuted(int(digits), 10**n, 'phone', same):0{n}d}")
    if digits[0] in "17" and len(digits) > 11:  # always ten digits after these codes
        whole = re.match(r"\+(?:\D*\d){11}(?!\d)", found)
        if whole:
            found, digits = whole[0], digits[:11]
    code = _SHORT_CODES.match(digits)
    kept = code.end() if code else 3
    rest = digits[kept:]
    new = cipher.permuted(int(rest), 10 ** len(rest), "phone" + digits[:kept])
    return _refilled(found, digits[:kept] + f"{new:0{len(rest)}d}")


def _card(cipher: Feistel, found: str) -> str:
    digits = re.sub(r"\D", "", found)
    n = len(digits)
    if n >= 13 and _luhn_valid(digits):
        body = f"{cipher.permuted(int(digits[:-1]), 10 ** (n - 1), f'card{n}'):0{n - 1}d}"
        return _refilled(found, body + luhn_digit(body))
    other = lambda x: n < 13 or not _luhn_valid(f"{x:0{n}d}")
    return _refilled(found, f"{cipher.permuted(int(digits), 10**n, f'digits{n}', other):0{n}d}")


_REPLACERS = {
    "email": _email,
    "iban": _iban,
    "date": _date,
    "ip": _ip,
    "ssn": _ssn,
    "phone": _phone,
    "card": _card,
}


def pseudonymised(cipher: Feistel, text: str) -> tuple[str, list[tuple[int, int, str]]]:
    """(new text, (start, end, kind) of what was replaced, places in the old text)."""
    if not _ANY.search(text):
        return text, []
    found: list[tuple[int, int, str, str]] = []
    for kind, pattern in _PASSES:
        edges = [0, *(x for a, b, _, _ in sorted(found) for x in (a, b)), len(text)]
        for at, end in zip(edges[::2], edges[1::2], strict=True):
            while match := pattern.search(text, at, end):
                new = _REPLACERS[kind](cipher, match[0])
                if new is not None:  # as long as what it replaces, which may be less than the match
                    at = match.start() + len(new)
                    found.append((match.start(), at, kind, new))
                else:
                    at = match.start() + 1 if kind == "iban" else match.end()
    out, last = [], 0
    for a, b, _, new in sorted(found):
        out += [text[last:a], new]
        last = b
    return "".join([*out, text[last:]]), [(a, b, kind) for a, b, kind, _ in sorted(found)]


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))


def pseudonymise(
    docs: DataFrame, secret: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, text, spans) of every row: the text with pseudonyms, and what was replaced."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cipher = Feistel(secret.encode())
        for batch in batches:
            texts, spans = [], []
            for value in batch.column(1).to_pylist():
                new, found = pseudonymised(cipher, value) if value else (value, [])
                texts.append(new)
                spans.append([{"start": a, "end": b, "kind": k} for a, b, k in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(spans, SPANS)],
                [key, "text", "spans"],
            )

    rows = docs.select(F.col(key), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    return map_arrow(
        rows,
        kernel,
        f"`{key}` {kind}, text string, spans array<struct<start:long,end:long,kind:string>>",
    )


def digest(found: DataFrame) -> DataFrame:
    """(doc_id, text, the number of spans, and of each kind)."""
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}")
        for kind in KINDS
    ]
    return found.select("doc_id", "text", F.size("spans").cast("long").alias("n_spans"), *counts)
