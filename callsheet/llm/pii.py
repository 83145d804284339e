"""PII: format-preserving Feistel pseudonyms.

Values are found in whole texts, validated, and replaced by a keyed
permutation of their own format: card numbers stay card numbers with a right
check digit, dates stay dates, addresses stay addresses. A permutation maps
equal values to equal pseudonyms in every document and different values to
different ones, whatever separators they are written with.

No value is its own pseudonym: a value goes to the next one in a keyed order
of all values of its format, which is one cycle.

Kinds: e-mail (name permuted within the letters of its own scripts, equal for
upper and lower case; host kept), card number (check digit right), telephone
number with a + or separators, IPv4 address, IPv6 address of four groups and
more, US social security number, IBAN (mod 97 right), calendar dates from 1900
to 2099. What fails its validation stays.

The key is the caller's secret, or the setting ``SETTING``; without either a
random one holds for the application, so nobody can undo its pseudonyms and
links end with it.

Defined results: null text stays null, empty text empty; n_values is then 0;
repeated rows are replaced one by one; an empty table gives an empty result;
extra columns stay, but ``n_values`` is replaced.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import ipaddress
import re
import secrets
from collections.abc import Callable, Iterator
from functools import cache
from math import isqrt

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut_batches, kept_by, ship

ROUNDS = 8
SETTING = "spark.callsheet.pii.secret"  # a name that Spark hides in its listings
_own_keys: dict[str, bytes] = {}


class Feistel:
    """A keyed permutation of 0 .. n - 1 for any n, by an unbalanced Feistel network and cycle walking."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, tweak: str, i: int, n: int, half: int) -> int:
        h = hashlib.blake2b(f"{tweak}/{i}/{n}/{half}".encode(), key=self.key, digest_size=16)
        return int.from_bytes(h.digest(), "big")

    def once(self, x: int, n: int, tweak: str) -> int:
        a = isqrt(n - 1) + 1
        b = -(-n // a)
        left, right = divmod(x, b)  # left < a, right < b
        for i in range(ROUNDS):
            if i % 2:
                right = (right + self._round(tweak, i, n, left)) % b
            else:
                left = (left + self._round(tweak, i, n, right)) % a
        return left * b + right

    def back(self, x: int, n: int, tweak: str) -> int:
        """The value that ``once`` takes to x."""
        a = isqrt(n - 1) + 1
        b = -(-n // a)
        left, right = divmod(x, b)
        for i in reversed(range(ROUNDS)):
            if i % 2:
                right = (right - self._round(tweak, i, n, left)) % b
            else:
                left = (left - self._round(tweak, i, n, right)) % a
        return left * b + right

    def permute(self, x: int, n: int, tweak: str, allowed: Callable[[int], bool] = lambda _: True) -> int:
        """The next allowed value after x in the network's order of 0 .. n - 1, taken as a ring.

        A permutation of the allowed values, and x itself only where it is the one allowed.
        """
        if n < 2:
            return x
        place = x
        while (place := self.once(place, n, tweak)) >= n:
            pass
        while True:
            place = (place + 1) % n
            y = place
            while (y := self.back(y, n, tweak)) >= n:
                pass
            if allowed(y):
                return y


def _digits(text: str) -> str:
    return re.sub(r"\D", "", text)


def _refill(shape: str, digits: str) -> str:
    """The shape with its digits replaced in order."""
    it = iter(digits)
    return "".join(next(it) if c in "0123456789" else c for c in shape)


def luhn_digit(body: str) -> str:
    total = 0
    for i, c in enumerate(reversed(body)):
        d = int(c) * (2 - i % 2)
        total += d - 9 * (d > 9)
    return str(-total % 10)


def _iban_rest(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


_LOW, _HIGH = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()
_BLOCK = 256  # code points among which a letter beyond ASCII is permuted: those of its script's table


def _simple_case(c: str) -> bool:
    return len(c.upper()) == 1 and c.upper() != c and c.upper().lower() == c


@cache
def _alphabet(kind: str) -> str:
    """The characters that one of them may become: ASCII letters, digits, or a block's letters that have, or
    haven't, an upper case."""
    if kind in ("a", "0"):
        return "abcdefghijklmnopqrstuvwxyz" if kind == "a" else "0123456789"
    first, cased = int(kind[1:]) * _BLOCK, kind[0] == "c"
    letters = (chr(x) for x in range(max(first, 0x80), first + _BLOCK) if chr(x).isalpha())
    return "".join(c for c in letters if (_simple_case(c) if cased else c.lower() == c and not _simple_case(c)))


def _kind(c: str) -> str | None:
    """The alphabet of a character in lower case; None: it stays."""
    if c.isascii():
        return "a" if c.isalpha() else "0" if c.isdigit() else None
    if not c.isalpha() or c.lower() != c:
        return None
    return f"{'c' if _simple_case(c) else 'l'}{ord(c) // _BLOCK}"


_EMAIL = re.compile(r"(?<![\w.%+-])([\w%+-]+(?:\.[\w%+-]+)*)(@(?:[^\W_](?:(?:[^\W_]|-)*[^\W_])?\.)+[^\W\d_]{2,})(?![\w-])")
_IPV6 = re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{1,4}:(?::?[0-9A-Fa-f]{1,4}:?){2,7})(?![\w:.])")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,4})?)(?![A-Za-z0-9])")
_NUMBER = re.compile(
    r"(?<![0-9A-Za-z_.+-])(?:"
    r"(?P<ip>[0-9]{1,3}(?:\.[0-9]{1,3}){3})(?!\.?[0-9])"
    r"|(?P<iso>(?:19|20)[0-9]{2}(?P<s1>[-/.])[0-9]{1,2}(?P=s1)[0-9]{1,2})(?!(?P=s1)?[0-9])"
    r"|(?P<day>[0-9]{1,2}(?P<s2>[-/.])[0-9]{1,2}(?P=s2)(?:19|20)[0-9]{2})(?![0-9])"
    r"|(?P<ssn>[0-9]{3}-[0-9]{2}-[0-9]{4})(?!-?[0-9])"
    r"|(?P<card>[0-9]{4}(?P<s3>[ -])[0-9]{4}(?P=s3)[0-9]{4}(?P=s3)[0-9]{4}|3[47][0-9]{2}[ -][0-9]{6}[ -][0-9]{5}|[0-9]{13,19})(?![0-9])"
    r"|(?P<us>(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4})(?![-.]?[0-9])"
    r")|(?<![0-9+])(?P<intl>\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4})(?![0-9])")


class Pseudonyms:
    """Finds, validates and replaces values of one text after another."""

    def __init__(self, key: bytes):
        self.feistel = Feistel(key)

    def digits(self, text: str, kind: str, allowed: Callable[[str], bool] = lambda _: True) -> str:
        n = len(text)
        to = self.feistel.permute(int(text), 10 ** n, f"{kind}{n}", lambda x: allowed(str(x).zfill(n)))
        return str(to).zfill(n)

    def email(self, name: str) -> str:
        """The permutation is of the name in lower case; a letter's case is put back at its place."""
        low = [c.lower() if _simple_case(c.lower()) else c for c in name]
        kinds = [_kind(c) for c in low]
        size, x = 1, 0
        for c, k in zip(low, kinds, strict=True):
            if k:
                letters = _alphabet(k)
                size, x = size * len(letters), x * len(letters) + letters.index(c)
        x = self.feistel.permute(x, size, "email" + ",".join(k or "-" for k in kinds))
        out = []
        for c, was, k in zip(reversed(name), reversed(low), reversed(kinds), strict=True):
            if k:
                x, i = divmod(x, len(_alphabet(k)))
                c = _alphabet(k)[i].upper() if c != was else _alphabet(k)[i]
            out.append(c)
        return "".join(reversed(out))

    def card(self, shape: str) -> str | None:
        d = _digits(shape)
        if luhn_digit(d[:-1]) != d[-1] or len(set(d)) == 1:
            return None
        body = self.digits(d[:-1], "card", lambda b: len(set(b + luhn_digit(b))) > 1)
        return _refill(shape, body + luhn_digit(body))

    def phone(self, shape: str) -> str | None:
        d = _digits(shape)
        if not 8 <= len(d) <= 15:
            return None
        code = len(re.match(r"\+([0-9]*)", shape + "")[1]) if shape.startswith("+") and re.match(r"\+[0-9]{1,3}[^0-9]", shape) else 0
        return _refill(shape, d[:code] + self.digits(d[code:], "phone"))

    def ip(self, shape: str) -> str | None:
        parts = shape.split(".")
        if any(int(p) > 255 or p != str(int(p)) for p in parts):
            return None
        x = self.feistel.permute(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, "ip")
        return ".".join(map(str, x.to_bytes(4, "big")))

    def ip6(self, shape: str) -> str | None:
        """Written in full, as the compressed form tells where zeros are."""
        try:
            x = int(ipaddress.IPv6Address(shape))
        except ValueError:
            return None
        return ipaddress.IPv6Address(self.feistel.permute(x, 1 << 128, "ip6")).exploded

    def ssn(self, shape: str) -> str | None:
        def valid(d: str) -> bool:
            return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"
        d = _digits(shape)
        return _refill(shape, self.digits(d, "ssn", valid)) if valid(d) else None

    def iban(self, shape: str) -> str | None:
        text = shape.replace(" ", "")
        if not 15 <= len(text) <= 34 or _iban_rest(text) != 1:
            return None
        d = _digits(text[4:])
        if len(d) < 6:
            return None
        body = _refill(text[4:], self.digits(d, "iban" + re.sub("[0-9]", "0", text[:2] + text[4:])))
        check = str(98 - _iban_rest(f"{text[:2]}00{body}")).zfill(2)
        new = iter(text[:2] + check + body)
        return "".join(c if c == " " else next(new) for c in shape)

    def _date(self, day: dt.date | None, kind: str, allowed: Callable[[dt.date], bool] = lambda _: True) -> dt.date | None:
        if day is None or not _LOW <= day.toordinal() <= _HIGH:
            return None
        x = self.feistel.permute(day.toordinal() - _LOW, _HIGH - _LOW + 1, kind, lambda n: allowed(dt.date.fromordinal(_LOW + n)))
        return dt.date.fromordinal(_LOW + x)

    def iso(self, shape: str) -> str | None:
        sep = shape[4]
        parts = shape.split(sep)
        to = self._date(_calendar(*parts), "date")
        if to is None:
            return None
        wide = 2 if all(len(p) == 2 for p in parts[1:]) else 1
        return f"{to.year:04d}{sep}{to.month:0{wide}d}{sep}{to.day:0{wide}d}"

    def day(self, shape: str) -> str | None:
        """Month first where that is a date, else day first; each permutes among its own."""
        sep = re.search(r"[^0-9]", shape)[0]
        a, b, y = shape.split(sep)
        if to := self._date(_calendar(y, a, b), "date"):
            first, second = to.month, to.day
        elif to := self._date(_calendar(y, b, a), "date", lambda x: x.day > 12):
            first, second = to.day, to.month
        else:
            return None
        return f"{first:02d}{sep}{second:02d}{sep}{to.year:04d}"

    def replace(self, text: str | None) -> tuple[str | None, int]:
        """The text with its values replaced, and how many."""
        if not text:
            return text, 0
        made = 0

        def put(match: re.Match, new: str | None) -> str:
            nonlocal made
            made += new is not None and new != match[0]
            return match[0] if new is None else new

        if "@" in text:
            text = _EMAIL.sub(lambda m: put(m, self.email(m[1]) + m[2]), text)
        if not _ANY_DIGIT.search(text):
            return text, made
        if text.count(":") > 2:
            text = _IPV6.sub(lambda m: put(m, self.ip6(m[0])), text)

        def numbers(part: str) -> str:
            taken = [m.span() for m in _EMAIL.finditer(part)] if "@" in part else []

            def number(m: re.Match) -> str:
                if any(a <= m.start() < b for a, b in taken):
                    return m[0]
                kind = next(k for k in ("ip", "iso", "day", "ssn", "card", "us", "intl") if m[k] is not None)
                return put(m, getattr(self, {"us": "phone", "intl": "phone"}.get(kind, kind))(m[0]))

            return _NUMBER.sub(number, part)

        out, at = [], 0
        for m in _IBAN.finditer(text):
            if new := self.iban(m[0]):
                out += numbers(text[at:m.start()]), put(m, new)
                at = m.end()
        return "".join((*out, numbers(text[at:]))), made


_ANY_DIGIT = re.compile("[0-9]")


def _calendar(y: str, m: str, d: str) -> dt.date | None:
    try:
        return dt.date(int(y), int(m), int(d))
    except ValueError:
        return None


def application_key(spark: SparkSession) -> bytes:
    """The secret of the setting, else a random one that holds for this application."""
    said = spark.conf.get(SETTING, None)
    if said:
        return said.encode()
    return _own_keys.setdefault(spark.sparkContext.applicationId, secrets.token_bytes(32))


def pseudonymised(docs: DataFrame, key: bytes) -> DataFrame:
    """The documents with the values in ``text`` replaced, and in n_values how many were."""
    if not key:
        raise ValueError("pseudonyms need a key")
    ship(docs.sparkSession)
    cut_batches(docs.sparkSession)

    @F.pandas_udf("text string, n_values int")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        kept_by("pii")
        names = Pseudonyms(key)
        for texts in batches:
            yield pd.DataFrame([names.replace(t) for t in texts], columns=["text", "n_values"])

    out = docs.withColumn("_pii", run(F.col("text").cast("string")))
    return out.withColumns({"text": F.col("_pii.text"), "n_values": F.col("_pii.n_values")}).drop("_pii")
