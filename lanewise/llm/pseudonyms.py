"""Format-preserving pseudonyms for personal data, by keyed Feistel permutations.

Every kind of value (card, account, phone, address, date, ...) is a set of numbers.  A
Feistel network keyed by the kind permutes a power of two; walking its cycle until the
result is a valid value again makes it a permutation of the valid values.  So a valid value
becomes a valid value of the same form, equal values become equal values in every document,
different ones different, and who has the key can go back.
"""

import re
from collections.abc import Callable, Iterator
from datetime import date
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import text_values

_ROUNDS = 8
_FIRST_DAY = date(1900, 1, 1).toordinal()
_DAYS = date(2099, 12, 31).toordinal() - _FIRST_DAY + 1
#: Character classes that are permuted, by their first character.
_RADIX = {"0": 10, "A": 26, "a": 26}
_LAST = {"0": "9", "A": "Z", "a": "z"}


class Permutation:
    """A keyed permutation of 0 .. size - 1, one for each kind of value."""

    def __init__(self, key: bytes, kind: str, size: int):
        self.size, self.half = size, max(1, ((size - 1).bit_length() + 1) // 2)
        self.mask = (1 << self.half) - 1
        self.hash = blake2b(f"{kind}:{size}".encode(), key=key, digest_size=(self.half + 7) // 8)

    def _round(self, number: int, value: int) -> int:
        state = self.hash.copy()
        state.update(bytes([number]) + value.to_bytes((self.half + 7) // 8, "big"))
        return int.from_bytes(state.digest(), "big") & self.mask

    def _once(self, value: int, back: bool) -> int:
        left, right = value >> self.half, value & self.mask
        for number in reversed(range(_ROUNDS)) if back else range(_ROUNDS):
            if back:
                left, right = right ^ self._round(number, left), left
            else:
                left, right = right, left ^ self._round(number, right)
        return left << self.half | right

    def __call__(self, value: int, valid: Callable[[int], bool] = lambda _: True, back: bool = False) -> int:
        """Walk from a valid value to the next valid one."""
        while True:
            value = self._once(value, back)
            if value < self.size and valid(value):
                return value


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _refill(text: str, digits: str) -> str:
    """``text`` with its digits replaced in order."""
    new = iter(digits)
    return "".join(next(new) if c in "0123456789" else c for c in text)


def luhn_digit(payload: str) -> str:
    total = 0
    for i, c in enumerate(reversed(payload)):
        n = int(c) * (2 if i % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return str(-total % 10)


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


class Pseudonyms:
    """Replaces values in texts; ``back`` undoes it."""

    def __init__(self, key: bytes, back: bool = False):
        self.key, self.back, self.made = key, back, {}

    def _permute(self, kind: str, size: int, value: int, valid=lambda _: True) -> int:
        made = self.made.get((kind, size))
        if made is None:
            made = self.made[kind, size] = Permutation(self.key, kind, size)
        return made(value, valid, self.back)

    def _number(self, kind: str, digits: str, valid=lambda _: True) -> str:
        width = len(digits)
        value = self._permute(kind, 10**width, int(digits), lambda v: valid(str(v).zfill(width)))
        return str(value).zfill(width)

    def _alike(self, kind: str, text: str) -> str:
        """The letters A-Z, a-z and the digits permuted together, each within its class; other
        characters stay.  Texts with the classes of their characters in other places are
        other sets, so no two values get one pseudonym."""
        first = [next((a for a in "0Aa" if a <= c <= _LAST[a]), c) for c in text]
        radix = [_RADIX.get(a, 1) for a in first]
        value, size = 0, 1
        for c, a, r in zip(text, first, radix, strict=True):
            value, size = value * r + ord(c) - ord(a), size * r
        if size == 1:
            return text
        value, made = self._permute(f"{kind} {''.join(a if a in _RADIX else '.' for a in first)}", size, value), []
        for a, r in zip(reversed(first), reversed(radix), strict=True):
            value, digit = divmod(value, r)
            made.append(chr(ord(a) + digit))
        return "".join(reversed(made))

    # One method per kind: the new text of a match, or None where it is no valid value.

    def cards(self, run: str) -> list[tuple[int, int, str]]:
        """Start, stop and new text of the card numbers in a run of digits.

        A number begins and ends where a group of digits does, its groups have three digits
        or more and one kind of sign between them; at each place the longest that passes the
        check is taken.
        """
        at = [i for i, c in enumerate(run) if c in "0123456789"]
        begins = [n for n, i in enumerate(at) if n == 0 or at[n - 1] != i - 1]
        ends = {n for n, i in enumerate(at) if n + 1 == len(at) or at[n + 1] != i + 1}
        found, after = [], 0
        for first in begins:
            for length in range(19, 12, -1):
                last = first + length - 1
                if first < after or last not in ends:
                    continue
                text = run[at[first] : at[last] + 1]
                groups = re.split("[ -]", text)
                if len({c for c in text if c in " -"}) > 1 or len(groups) > 1 and min(map(len, groups)) < 3:
                    continue
                digits = "".join(groups)
                if luhn_digit(digits[:-1]) == digits[-1]:
                    payload = digits[0] + self._number("card", digits[1:-1])
                    found.append((at[first], at[last] + 1, _refill(text, payload + luhn_digit(payload))))
                    after = last + 1
                    break
        return found

    def iban(self, m: re.Match) -> str | None:
        text = m[0].replace(" ", "")
        country, account = text[:2], text[4:]
        if not 15 <= len(text) <= 34 or _mod97(account + text[:4]) != 1:
            return None
        account = self._alike("iban " + country, account)
        new = iter(country + f"{98 - _mod97(account + country + '00'):02d}" + account)
        return "".join(c if c == " " else next(new) for c in m[0])

    def email(self, m: re.Match) -> str | None:
        local, _, domain = m[0].rpartition("@")
        return f"{self._alike('email', local)}@{domain}"

    def ip(self, m: re.Match) -> str | None:
        parts = m[0].split(".")
        if any(int(p) > 255 or str(int(p)) != p for p in parts):
            return None
        value = self._permute("ip", 1 << 32, int.from_bytes(bytes(map(int, parts)), "big"))
        return ".".join(map(str, value.to_bytes(4, "big")))

    def social(self, m: re.Match) -> str | None:
        def valid(d: str) -> bool:
            return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"

        digits = _digits(m[0])
        return _refill(m[0], self._number("social", digits, valid)) if valid(digits) else None

    def phone(self, m: re.Match) -> str | None:
        code = m["code"] or m["plus"] or ""
        rest = m[0][len(code) :]
        digits = _digits(rest)
        if not 7 <= len(digits) <= 14:
            return None
        return code + _refill(rest, self._number("phone", digits))

    def date(self, m: re.Match) -> str | None:
        """Year first, or day.month.year, or month/day/year; day/month/year where no month
        comes first.

        All forms share one permutation of the days, so equal dates stay equal.  A
        day/month/year whose new day could be read as a month is written year first.
        """
        parts = re.split(r"[-/.]", m[0])
        sign = m[0][4] if len(parts[0]) == 4 else m[0][len(parts[0])]
        numbers = list(map(int, parts))
        if len(parts[0]) == 4:
            order = (0, 1, 2)
        elif sign in "-." or numbers[0] > 12:
            order = (2, 1, 0)
        else:
            order = (2, 0, 1)
        try:
            day = date(*(numbers[i] for i in order)).toordinal() - _FIRST_DAY
        except ValueError:
            return None
        if not 0 <= day < _DAYS:
            return None
        found = date.fromordinal(self._permute("date", _DAYS, day) + _FIRST_DAY)
        if sign == "/" and order == (2, 1, 0) and found.day <= 12:
            order = (0, 1, 2)
        made = [0, 0, 0]
        for place, number in zip(order, (found.year, found.month, found.day), strict=True):
            made[place] = number
        return sign.join(str(n).zfill(4 if n > 31 else 2) for n in made)

    def secret(self, m: re.Match) -> str | None:
        text = m["secret"] or m["access"]
        start = m.start("secret" if m["secret"] else "access") - m.start()
        return m[0][:start] + self._alike("secret", text) + m[0][start + len(text) :]

    def replace(self, text: str | None) -> tuple[str | None, list[dict]]:
        """The text with all values replaced, and kind, start and stop of each in the
        original."""
        if not text or not (_HINT.search(text) or _NAMED.search(text)):
            return text, []
        found: list[dict] = []
        return self._searched(_VALUES, text, 0, found), found

    def _searched(self, values: re.Pattern, text: str, base: int, found: list[dict]) -> str:
        def new(m: re.Match) -> str:
            start = base + m.start()
            if values is _VALUES and m["card"] is not None:
                # What is between the card numbers of a run may hold other values.
                made, at = [], 0
                for first, stop, number in [*self.cards(m[0]), (len(m[0]), None, "")]:
                    made += [self._searched(_OTHERS, m[0][at:first], start + at, found), number]
                    if stop is not None:
                        found.append({"kind": "card", "start": start + first, "stop": start + stop})
                        at = stop
                return "".join(made)
            kind = next((name for name in _KINDS if m[name] is not None), "secret")
            made = getattr(self, kind)(m)
            if made is None:
                return m[0]
            found.append({"kind": kind, "start": start, "stop": base + m.end()})
            return made

        return values.sub(new, text)


#: Every value has one of these; only secrets can do without a digit.
_HINT = re.compile(r"[0-9@]")
_NAMED = re.compile(r"(?i:password|passwd|token|secret|api[_-]?key)|AKIA")
_KINDS = ("email", "iban", "ip", "date", "social", "phone")
_CARD = r"|(?<!\w)(?P<card>[0-9](?:[ -]?[0-9]){12,})(?!\w)"
_PATTERN = (
    r"""(?<![\w.+%-])(?P<email>[A-Za-z0-9][\w.+%-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})
    |(?<![A-Za-z0-9])(?P<iban>[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])
    |(?<![\w.])(?P<ip>[0-9]{1,3}(?:\.[0-9]{1,3}){3})(?!\w|\.[0-9])
    |(?<![\w/-])(?P<date>[0-9]{4}(?P<dash>[-/.])[0-9]{2}(?P=dash)[0-9]{2}|[0-9]{2}(?P<slash>[-/.])[0-9]{2}(?P=slash)[0-9]{4})(?![\w/-])
    |(?<![\w-])(?P<social>[0-9]{3}-[0-9]{2}-[0-9]{4})(?![\w-])
    |(?<![\w+])(?P<phone>(?P<code>\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ ]?|(?(code)[0-9]{2,4}[ .-]|[0-9]{3}[.-]))[0-9]{3,4}(?:[ .-][0-9]{2,4}){1,2}(?![\w-])
      |(?P<plus>(?>\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9][0-9]{2})))
       (?:[ .-]?[0-9]{7,13}|[ .-][0-9]{1,5}[ .-][0-9]{5,9}|[ .-][0-9](?:[ .-][0-9]{2}){4})(?!\w|\.[0-9]))
    CARD
    |(?:(?i:password|passwd|token|secret|api[_-]?key)["']?\s*[=:]\s*["']?(?P<secret>[A-Za-z0-9]{12,64})(?![A-Za-z0-9])
      |(?<![A-Z0-9])AKIA(?P<access>[A-Z0-9]{16})(?![A-Za-z0-9]))"""
)
_VALUES = re.compile(_PATTERN.replace("CARD", _CARD), re.VERBOSE)
_OTHERS = re.compile(_PATTERN.replace("CARD", ""), re.VERBOSE)


def pseudonymise(docs: DataFrame, key: bytes, text: str = "text", back: bool = False) -> DataFrame:
    """All rows and columns of ``docs`` with ``text`` pseudonymised, and ``pii``.

    ``pii`` (replaced if present) lists kind, start and stop of every value in the original
    text.  Card numbers must pass Luhn's check, IBANs mod 97, dates the calendar, addresses
    and social security numbers their ranges; others stay as they are.  Null and empty texts
    stay; whole texts are searched; equal rows stay equal.  ``key`` (16 to 64 bytes) is the
    caller's secret; ``back`` turns pseudonyms into the originals again.
    """
    if not 16 <= len(key) <= 64:
        raise ValueError("the key must have 16 to 64 bytes")
    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))

    @F.arrow_udf("struct<text: string, pii: array<struct<kind: string, start: int, stop: int>>>")
    def replaced(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = Pseudonyms(key, back)
        for column in columns:
            texts, found = [], []
            for value in text_values(column):
                new, own = names.replace(value)
                texts.append(new)
                found.append(own)
            yield pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(found, spans)], ["text", "pii"])

    out = docs.withColumn("__replaced", replaced(F.col(text)))
    return out.withColumns({text: F.col("__replaced.text"), "pii": F.col("__replaced.pii")}).drop("__replaced")
