"""Format-preserving Feistel pseudonyms for validated numbers, dates and mail addresses."""

from __future__ import annotations

import datetime
import hashlib
import math
import re
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame

from millrace.llm.common import narrow, per_text

ROUNDS = 8


class Feistel:
    """A keyed permutation of 0 .. n-1 for any n.

    Unbalanced Feistel rounds over the two digits of a number in mixed radix
    (a, b) with a * b just above n; results from n on are permuted again until
    one is below (cycle walking), so it stays a permutation.
    """

    def __init__(self, key: bytes):
        self.key = key

    def _round(self, kind: str, n: int, i: int, half: int) -> int:
        told = f"{kind}|{n}|{i}|{half}".encode()
        return int.from_bytes(hashlib.blake2b(told, key=self.key, digest_size=32).digest(), "big")

    def permute(self, kind: str, n: int, value: int, allowed: Callable[[int], bool] | None = None) -> int:
        """The image of ``value``; ``allowed`` narrows the permutation to a part of the range."""
        if n < 2:
            return value
        a = math.isqrt(n - 1) + 1
        b = -(-n // a)
        while True:
            left, right = divmod(value, b)
            for i in range(0, ROUNDS, 2):
                left = (left + self._round(kind, n, i, right)) % a
                right = (right + self._round(kind, n, i + 1, left)) % b
            value = left * b + right
            if value < n and (allowed is None or allowed(value)):
                return value


def luhn_digit(payload: str) -> str:
    """The digit that makes ``payload`` and it a valid card number."""
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _refill(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced in order."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in shape)


def _card(feistel: Feistel, found: str) -> str | None:
    digits = re.sub(r"\D", "", found)
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1]:
        return None
    size = len(digits) - 1
    payload = str(feistel.permute("card", 10**size, int(digits[:-1]))).zfill(size)
    return _refill(found, payload + luhn_digit(payload))


def _letters(feistel: Feistel, kind: str, text: str) -> str:
    """Permute digits, lower and upper case letters of ``text`` in their places, as one number."""
    sets = [("0", 10) if c in "0123456789" else ("a", 26) if "a" <= c <= "z" else ("A", 26) if "A" <= c <= "Z" else None for c in text]
    n = value = 0
    n = 1
    for c, s in zip(text, sets):
        if s:
            n, value = n * s[1], value * s[1] + ord(c) - ord(s[0])
    value = feistel.permute(f"{kind}:{''.join(s[0] if s else c for c, s in zip(text, sets))}", n, value)
    out = []
    for c, s in zip(reversed(text), reversed(sets)):
        if s:
            value, d = divmod(value, s[1])
            c = chr(ord(s[0]) + d)
        out.append(c)
    return "".join(reversed(out))


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def _iban(feistel: Feistel, found: str) -> str | None:
    """Written in one run or in groups of four, whose spaces stay."""
    text = found.replace(" ", "")
    if not 15 <= len(text) <= 34 or _mod97(text[4:] + text[:4]) != 1:
        return None
    body = _letters(feistel, "iban" + text[:2], text[4:])
    new = iter(f"{text[:2]}{98 - _mod97(body + text[:2] + '00'):02d}{body}")
    return "".join(c if c == " " else next(new) for c in found)


def _ssn_ok(value: int) -> bool:
    area, group, serial = value // 10**6, value // 10**4 % 100, value % 10**4
    return area not in (0, 666) and area < 900 and group > 0 and serial > 0


def _ssn(feistel: Feistel, found: str) -> str | None:
    value = int(found.replace("-", ""))
    if not _ssn_ok(value):
        return None
    return _refill(found, str(feistel.permute("ssn", 10**9, value, _ssn_ok)).zfill(9))


# fixed values: calling codes of one and two digits; all others have three
CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98"
_CODES = frozenset(CODES.split())


def _phone(feistel: Feistel, found: str) -> str | None:
    """The digits behind the calling code permute, in whatever notation; a number without a code has that of North America."""
    digits = re.sub(r"\D", "", found)
    code = next((digits[:n] for n in (1, 2) if digits[:n] in _CODES), digits[:3]) if found[0] == "+" else ""
    rest = digits[len(code) :]
    if not 7 <= len(digits) <= 15 or len(rest) < 6:
        return None
    return _refill(found, code + str(feistel.permute(f"phone+{code or 1}", 10 ** len(rest), int(rest))).zfill(len(rest)))


def _address(feistel: Feistel, found: str) -> str | None:
    parts = found.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    value = feistel.permute("ip", 1 << 32, int.from_bytes(bytes(map(int, parts)), "big"))
    return ".".join(map(str, value.to_bytes(4, "big")))


_FIRST = datetime.date(1900, 1, 1)
_DAYS = (datetime.date(2100, 1, 1) - _FIRST).days


def _date(feistel: Feistel, found: str) -> str | None:
    """Year first, else month first where that is a date, else day first. Days permute within 1900 to 2099.

    Dates that only read day first stay so: their day stays over 12.
    """
    mark = "-" if "-" in found else "/" if "/" in found else "."
    parts = found.split(mark)
    year_first = len(parts[0]) == 4
    orders = ["ymd"] if year_first else ["dmy"] if mark == "." else ["mdy", "dmy"]
    for order in orders:
        value = {k: int(p) for k, p in zip(order, parts)}
        try:
            day = (datetime.date(value["y"], value["m"], value["d"]) - _FIRST).days
        except ValueError:
            continue
        if not 0 <= day < _DAYS:
            continue
        late = order == "dmy" and mark != "."
        allowed = (lambda v: (_FIRST + datetime.timedelta(v)).day > 12) if late else None
        new = _FIRST + datetime.timedelta(feistel.permute("late" if late else "date", _DAYS, day, allowed))
        told = {"y": f"{new.year:04d}", "m": f"{new.month:02d}", "d": f"{new.day:02d}"}
        return mark.join(told[k] for k in order)
    return None


def _mail(feistel: Feistel, found: str) -> str:
    """Names that differ in case alone stay alike: the case is that of the letters found."""
    name, _, host = found.partition("@")
    new = _letters(feistel, "mail", name.lower())
    return "".join(n.upper() if c.isupper() else n for n, c in zip(new, name)) + "@" + host


#: (kind, pattern, what becomes of a match: None if it is not valid); a value ends at anything but a letter, a digit or its own marks
KINDS = [
    ("mail", r"(?<![A-Za-z0-9.%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", _mail),
    ("date", r"(?<![A-Za-z0-9.-])(?:\d{4}-\d{2}-\d{2}(?!(?!T\d)[A-Za-z0-9]|-|\.\d)"
             r"|(?<!/)(?:\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![A-Za-z0-9/-]|\.\d))", _date),
    ("ip", r"(?<![A-Za-z0-9.])\d{1,3}(?:\.\d{1,3}){3}(?![A-Za-z0-9]|\.\d)", _address),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])", _iban),
    ("ssn", r"(?<![A-Za-z0-9-])\d{3}-\d{2}-\d{4}(?![A-Za-z0-9-])", _ssn),
    ("card", r"(?<![A-Za-z0-9.-])\d(?:[ -]?\d){12,18}(?![A-Za-z0-9-])", _card),
    ("phone", r"(?<![A-Za-z0-9+.])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?![A-Za-z0-9])"
              r"|(?<![A-Za-z0-9+.-])\(\d{3}\) ?\d{3}[ .-]\d{4}(?![A-Za-z0-9])|(?<![A-Za-z0-9+.-])\d{3}[.-]\d{3}[.-]\d{4}(?![A-Za-z0-9-])", _phone),
]
_ANY = re.compile("|".join(f"(?P<{kind}>{pattern})" for kind, pattern, _ in KINDS), re.ASCII)
_EACH = [(kind, re.compile(pattern, re.ASCII)) for kind, pattern, _ in KINDS]
#: kinds written in groups, a part of which may be the whole value
_GROUPED = {"iban": re.compile(" "), "card": re.compile("[ -]"), "phone": re.compile("[ .-]")}
_GROUP = re.compile(r"[^A-Za-z0-9]*[A-Za-z0-9]+")
_ACTIONS = {kind: action for kind, _, action in KINDS}
_HINT = re.compile(r"[\d@]")


class Pseudonyms:
    """Replace every valid match in a text; equal values become equal pseudonyms."""

    def __init__(self, key: bytes):
        feistel = Feistel(key)
        self.of = lru_cache(1 << 16)(lambda kind, found: _ACTIONS[kind](feistel, found))

    def __call__(self, text: str) -> tuple[str, int]:
        if not _HINT.search(text):
            return text, 0
        n, out, at = 0, [], 0
        match = _ANY.search(text)
        while match:
            start, end = match.span()
            new = self.of(match.lastgroup, match.group())
            if new is None:
                new, end = self._others(text, start)
            out.append(text[at:start])
            out.append(text[start:end] if new is None else new)
            n, at = n + (new is not None), end
            match = _ANY.search(text, end)
        return "".join(out) + text[at:], n

    def _others(self, text: str, start: int) -> tuple[str | None, int]:
        """What else begins where a match has failed: each kind in turn, whole or up to a mark between its groups, the longest first.

        Without any the search goes on behind the first group, as a later one may begin a value.
        """
        for kind, pattern in _EACH:
            match = pattern.match(text, start)
            if not match:
                continue
            found = match.group()
            cuts = [m.start() for m in _GROUPED[kind].finditer(found)] if kind in _GROUPED else []
            for cut in [len(found), *reversed(cuts)]:
                new = self.of(kind, found[:cut]) if cut else None
                if new is not None:
                    return new, start + cut
        return None, _GROUP.match(text, start).end()


def pseudonymise(df: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, n_replaced) of every row.

    Mail addresses, calendar dates, IPv4 addresses, IBANs (mod 97), US social
    security numbers, card numbers (Luhn) and phone numbers are mapped by a
    permutation keyed with ``key`` onto values of the same kind and format that
    pass the same check, so equal values stay equal in all documents and
    different ones stay different. What fails its check, such as a number of
    16 digits with a wrong check digit, is left as it is; where one kind fails,
    the others are tried at the same place, and of several groups the longest
    part from the first group that passes counts. A value stands by itself:
    one directly beside a letter or digit is part of a longer word and stays,
    but for the T of a time behind a date. Equal phone numbers with and without
    marks, and mail names in other case, get equal pseudonyms. The key is at most 64
    bytes. Whole texts are searched; a null text counts as empty, a null id
    stays null, repeated rows are returned repeated, other columns are not read.
    """
    secret = key.encode()

    return per_text(
        narrow(df, id_col, text_col, raw=False), {"text": "string", "n_replaced": "bigint"}, lambda: Pseudonyms(secret)
    )
