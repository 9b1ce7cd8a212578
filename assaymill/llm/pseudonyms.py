"""Format-preserving pseudonyms for personal numbers, dates and addresses.

Values are found by shape and then validated (card numbers and bank accounts by their check
digits, dates by the calendar, addresses and phone numbers by their ranges). Each valid
value is replaced by a keyed permutation of itself within its format: a Feistel network
over the value's number, walked until it lands in the domain again. Punctuation, spacing
and length stay; check digits are made anew. Equal values give equal pseudonyms in all
documents, different ones different pseudonyms, and ``Pseudonyms(key).undo`` restores them.
No table of values is kept, so nothing is shared between tasks but the key.

Defined cases: a null text stays null with no values found; an empty one stays empty.
Overlapping shapes: the leftmost wins, at the same place the first kind listed. Where other
digits or words follow a value, its end is sought among the ends of the groups: a card's by the
usual groups, an account's by its country, else the longest that is valid. In such runs an
irregular card is told by its check digit alone, which one in ten numbers passes. Repeated
rows each get their row; columns beyond the named ones are carried as they are.
"""

from __future__ import annotations

import calendar
import hashlib
import hmac
import math
import re
from collections.abc import Callable, Iterator
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame

from assaymill.llm.common import small_batches

ROUNDS = 10
KINDS = ("email", "iban", "card", "ssn", "date", "ip", "phone")
FIRST_YEAR, YEARS = 1900, 200

# Shapes; each is validated before it counts. A digit run is only taken whole.
SHAPES = re.compile(r"""(?x)
    (?P<email>(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![\w-]))
  | (?P<iban>\b[A-Z]{2}\d{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b)
  | (?P<date>(?<![\d/.-])(?:\d{4}([-/.])\d{1,2}\4\d{1,2}|\d{1,2}([-/.])\d{1,2}\5\d{4})(?![\d/-]))
  | (?P<ip>(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d.]))
  | (?P<phone>(?<![\w+])\+\d{1,3}[\x20.-]?(?:\(\d{1,4}\)|\d{1,4})(?:[\x20.-]?\d{2,4}){2,4}(?!\d)
      | (?<![\w(])(?:\(\d{3}\)\x20?|\d{3}[\x20.-])\d{3}[\x20.-]\d{4}(?![\d-]))
  | (?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))
  | (?P<card>(?<![\d.])(?<!\D-)\d(?:[\x20-]?\d){12,18}(?!\d))
""".replace(r"\4", "(?P=_y)").replace(r"\5", "(?P=_d)").replace(
    r"\d{4}([-/.])", r"\d{4}(?P<_y>[-/.])").replace(r"\d{1,2}([-/.])", r"\d{1,2}(?P<_d>[-/.])"))


RUN = re.compile(r"[0-9]+(?:[ -][0-9]+){0,24}")
DIGITS = re.compile(r"[0-9]+")
CARD_GROUPS = ((4, 4, 4, 4), (4, 6, 5), (4, 6, 4))
IBAN_LENGTHS = {x[:2]: int(x[2:]) for x in """
    AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18
    FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21
    LY25 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27
    ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20""".split()}

# Every shape has a digit or an @; around them it reaches no further than this.
TRIGGER = re.compile(r"[0-9]+|@")
BEFORE, AFTER, LOCAL = 6, 48, 66
DOMAIN = re.compile(r"[A-Za-z0-9.-]*")


def _places(text: str) -> Iterator[tuple[int, int]]:
    """The stretches of a text that can hold a value, apart from each other and in order."""
    low = high = -1
    for m in TRIGGER.finditer(text):
        if m[0] == "@":
            first, last = m.start() - LOCAL, DOMAIN.match(text, m.end()).end() + 1
        else:
            first, last = m.start() - BEFORE, m.end() + AFTER
        first = max(0, first)
        if first > high:
            if high >= 0:
                yield low, high
            low = first
        low, high = min(low, first), max(high, last)
    if high >= 0:
        yield low, high


def luhn(digits: str) -> int:
    """The sum modulo 10 that is 0 for a valid number."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10


def _iban_number(country: str, check: str, account: str) -> int:
    return int("".join(str(int(c, 36)) for c in account + country + check))


class Pseudonyms:
    def __init__(self, key: bytes):
        self.key = key
        self._kinds: dict[str, Callable[[str, int], str | None]] = {
            k: getattr(self, f"_{k}") for k in KINDS}

    @cached_property
    def _base(self):
        return hmac.new(self.key, digestmod=hashlib.sha256)

    def _round(self, tweak: str, i: int, value: int) -> int:
        mac = self._base.copy()
        mac.update(f"{tweak}|{i}|{value}".encode())
        return int.from_bytes(mac.digest(), "big")

    def permute(self, value: int, size: int, tweak: str, sign: int = 1) -> int:
        """A keyed permutation of range(size); ``sign`` -1 undoes it."""
        if size < 2:
            return value
        a = math.isqrt(size - 1) + 1
        b = -(-size // a)  # value = left * b + right, left below a, right below b
        tweak = f"{tweak}|{size}"
        while True:
            left, right = divmod(value, b)
            for i in range(ROUNDS) if sign > 0 else reversed(range(ROUNDS)):
                if i % 2 == 0:
                    left = (left + sign * self._round(tweak, i, right)) % a
                else:
                    right = (right + sign * self._round(tweak, i, left)) % b
            value = left * b + right
            if value < size:  # else outside: walk on along the cycle
                return value

    def _digits(self, digits: str, tweak: str, sign: int) -> str:
        n = len(digits)
        return str(self.permute(int(digits), 10**n, f"{tweak}{n}", sign)).zfill(n) if n else ""

    @staticmethod
    def _filled(shape: str, symbols: str) -> str:
        """``shape`` with its digits replaced in order."""
        rest = iter(symbols)
        return "".join(next(rest) if c.isdigit() else c for c in shape)

    def _card(self, value: str, sign: int) -> str | None:
        digits = re.sub(r"\D", "", value)
        if luhn(digits) or not digits.strip("0"):
            return None
        new = digits
        while True:
            body = self._digits(new[:-1], "card", sign)
            new = body + str(-luhn(body + "0") % 10)
            # A longer number stays one that begins, or does not begin, with a card of 16 digits.
            if len(new) <= 16 or (luhn(new[:16]) == 0) == (luhn(digits[:16]) == 0):
                return self._filled(value, new)

    def _ssn(self, value: str, sign: int) -> str | None:
        def valid(x: int) -> bool:
            area, group, serial = x // 10**6, x // 10**4 % 100, x % 10**4
            return area not in (0, 666) and area < 900 and group > 0 and serial > 0

        number = int(value.replace("-", ""))
        if not valid(number):
            return None
        while not valid(number := self.permute(number, 10**9, "ssn", sign)):
            pass
        return self._filled(value, f"{number:09d}")

    def _phone(self, value: str, sign: int) -> str | None:
        country = re.match(r"\+\d{1,3}(?=\D)", value)
        kept = country[0] if country else value[:2] if value[0] == "+" else ""
        digits = re.sub(r"\D", "", value[len(kept):])
        if not 7 <= len(digits) <= 14:
            return None
        return kept + self._filled(value[len(kept):], self._digits(digits, f"phone{kept}", sign))

    def _ip(self, value: str, sign: int) -> str | None:
        parts = value.split(".")
        if any(int(p) > 255 or len(p) > 1 and p[0] == "0" for p in parts):
            return None
        number = self.permute(int.from_bytes(bytes(map(int, parts)), "big"), 2**32, "ip", sign)
        return ".".join(map(str, number.to_bytes(4, "big")))

    def _date(self, value: str, sign: int) -> str | None:
        a, b, c = re.split(r"[-/.]", value)
        mark = value[len(a)]
        year_first = len(a) == 4
        wide = len(b) == 2 and len(c if year_first else a) == 2
        # Day and month: by the format, or the order that is a date; day first if both are.
        orders = [(a, b, c)] if year_first else [(c, b, a), (c, a, b)]
        for rank, (y, m, d) in enumerate(orders):
            y, m, d = int(y), int(m), int(d)
            if FIRST_YEAR <= y < FIRST_YEAR + YEARS and 1 <= m <= 12 and 1 <= d <= calendar.monthrange(y, m)[1]:
                break
        else:
            return None
        # Days up to 12 could be read as months: each class is permuted within itself, so that
        # the pseudonym is read in the same order and can be undone. So are one-digit days and months.
        low = not year_first and d <= 12
        shape = f"{year_first}{rank}{low}{wide}{mark}" + ("" if wide else f"{len(str(d))}{len(str(m))}{len(b)}")
        number = (y - FIRST_YEAR) * 372 + (m - 1) * 31 + d - 1
        while True:
            number = self.permute(number, YEARS * 372, f"date{shape}", sign)
            y2, m2, d2 = FIRST_YEAR + number // 372, number // 31 % 12 + 1, number % 31 + 1
            if d2 > calendar.monthrange(y2, m2)[1] or (not year_first and (d2 <= 12) != low):
                continue
            if not wide and (len(str(d2)), len(str(m2))) != (len(str(d)), len(str(m))):
                continue
            break
        fields = (y2, m2, d2) if year_first else (d2, m2, y2) if rank == 0 else (m2, d2, y2)
        return mark.join(str(x).zfill(len(old)) for x, old in zip(fields, (a, b, c)))

    def _iban(self, value: str, sign: int) -> str | None:
        plain = value.replace(" ", "")
        country, check, account = plain[:2], plain[2:4], plain[4:]
        if not 15 <= len(plain) <= 34 or _iban_number(country, check, account) % 97 != 1:
            return None
        digits = "".join(c for c in account if c.isdigit())
        body = self._filled(account, self._digits(digits, f"iban{country}", sign))
        check = f"{98 - _iban_number(country, '00', body) % 97:02d}"
        rest = iter(country + check + body)
        return "".join(c if c == " " else next(rest) for c in value)

    def _email(self, value: str, sign: int) -> str | None:
        local, _, domain = value.partition("@")
        if ".." in value or local[-1] == ".":
            return None
        # Letters and digits of the local part are permuted as one number of mixed bases.
        bases = [26 if c.isalpha() else 10 if c.isdigit() else 1 for c in local]
        number, size = 0, 1
        for c, base in zip(local, bases):
            if base > 1:
                number = number * base + (ord(c.lower()) - 97 if base == 26 else int(c))
                size *= base
        shape = "".join("a" if b == 26 else "0" if b == 10 else c for b, c in zip(bases, local))
        number = self.permute(number, size, f"email{shape}@{domain.lower()}", sign)
        out = []
        for c, base in zip(reversed(local), reversed(bases)):
            if base > 1:
                number, digit = divmod(number, base)
                c = str(digit) if base == 10 else chr((65 if c.isupper() else 97) + digit)
            out.append(c)
        return "".join(reversed(out)) + "@" + domain

    @staticmethod
    def _card_ends(text: str, start: int, high: int) -> Iterator[int]:
        """Where a card that begins at ``start`` may end, the likeliest first."""
        run = RUN.match(text, start, high)
        spans = [m.span() for m in DIGITS.finditer(text, start, run.end())] if run else []
        sizes = [j - i for i, j in spans]

        def valid(first: int, last: int) -> bool:
            digits = re.sub("[ -]", "", text[spans[first][0]:spans[last][1]])
            return not luhn(digits) and bool(digits.strip("0"))

        def regular(first: int) -> int | None:
            """The last group of a card in one of the usual forms."""
            if 13 <= sizes[first] <= 19 and valid(first, first):
                return first
            for form in CARD_GROUPS:
                last = first + len(form) - 1
                if tuple(sizes[first:last + 1]) == form and valid(first, last):
                    return last
            return None

        if spans and (last := regular(0)) is not None:
            yield spans[last][1]
        # Not into a later card of the usual form.
        stop = next((i for i in range(1, len(spans)) if regular(i) is not None), len(spans))
        for last in range(stop - 1, -1, -1):
            if 13 <= sum(sizes[:last + 1]) <= 19:
                yield spans[last][1]

    def _ends(self, kind: str, text: str, start: int, end: int, high: int) -> Iterator[int]:
        """Where a value that begins at ``start`` may end, the likeliest first."""
        if kind == "card":
            yield from self._card_ends(text, start, high)
        elif kind == "iban":
            ends = [end, *(i for i in range(end - 1, start, -1) if text[i] == " ")]
            length = IBAN_LENGTHS.get(text[start:start + 2])
            yield from sorted(ends, key=lambda i: i - start - text.count(" ", start, i) != length)
        elif kind == "phone":
            yield from (m.end() for m in reversed(list(DIGITS.finditer(text, start, end))))
        else:
            yield end

    def _read(self, kind: str, text: str, start: int, end: int, high: int, sign: int) -> tuple[str | None, int]:
        """The new value for the one of this kind that begins at ``start``, and where that ends."""
        for end in self._ends(kind, text, start, end, high):
            value = text[start:end]
            if value.isascii() and (new := self._kinds[kind](value, sign)) is not None:
                return new, end
        return None, start + 1

    def replace(self, text: str, sign: int = 1) -> tuple[str, dict[str, int]]:
        """The text with every valid value replaced, and how many of each kind there were."""
        counts = dict.fromkeys(KINDS, 0)
        out, done = [], 0
        for low, high in _places(text):
            at = low
            while m := SHAPES.search(text, at, high):
                kind, start = m.lastgroup, m.start()
                new, at = self._read(kind, text, start, m.end(), high, sign)
                if new is None and kind != "card":
                    kind = "card"
                    new, at = self._read(kind, text, start, m.end(), high, sign)
                if new is not None:
                    counts[kind] += 1
                    out += text[done:start], new
                    done = at
        return "".join((*out, text[done:])), counts

    def undo(self, text: str) -> str:
        return self.replace(text, -1)[0]


def pseudonymise(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """``docs`` with values in ``text`` replaced, and a map ``pii`` of kind to number found."""
    small_batches(docs.sparkSession)
    at = docs.columns.index(text)
    name = "pii"
    while name in docs.columns:
        name += "_"

    def run(batches):
        own = Pseudonyms(key)
        for batch in batches:
            texts, found = [], []
            for value in batch.column(at):
                value = value.as_py()
                value, counts = own.replace(value) if value else (value, {})
                texts.append(value)
                found.append([(k, n) for k, n in counts.items() if n])
            field = batch.schema.field(at)
            yield batch.set_column(at, field, pa.array(texts, field.type)).append_column(
                name, pa.array(found, pa.map_(pa.string(), pa.int32())))

    kinds = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    return docs.mapInArrow(run, f"{kinds}, `{name}` map<string,int>")
