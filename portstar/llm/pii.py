"""Format-preserving pseudonyms for personal data (keyed Feistel permutations).

Found values are checked (calendar dates, octets up to 255, Luhn digits, lengths) and replaced by
another value of the same format: digits stay digits, hex stays hex, letters keep their case,
separators stay, a date stays a date, a card number that meets the Luhn check still meets it. Each
format is a finite set numbered 0..N-1; the set is permuted by a keyed Feistel network with cycle
walking, so the mapping is one-to-one within the format, depends only on key and value, and equal
values stay linked across documents. The permutation is a shift seen through the network
(``E^-1(E(x) + 1)``), which has no fixed point: no value is replaced by itself. With the key,
:func:`reveal` restores the text.

Kinds: e-mail addresses (the local part), IPv4 addresses, telephone numbers, card numbers (13 to 19
digits that start with 2 to 6 and meet the Luhn check), IBANs with right check digits, social security
numbers, ISO dates, dates with day and month in either order, hex tokens of 32 to 64 digits. Long
numbers that validate as none of these stay as they are.

An address is found from its ``@``: the local part is the whole run of letters and digits of any
script, marks and ``_ % + - .`` to the left of it, however long. Texts are scanned in linear time.

Defined results. Null text stays null with no values; an empty text stays empty. Texts are scanned
whole. Repeated rows get equal results. Extra columns travel along whatever their names. Empty table:
no rows.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache
from math import isqrt

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portstar.llm.common import packed, table

ROUNDS = 8
DEMO_KEY = b"pseudonym-key-1"

# Repetitions before a test that may fail are bounded, so that long runs are scanned in linear time.
_FORMATS = r"""
  (?P<token>(?<![0-9A-Za-z])[0-9A-Fa-f]{32,64}(?![0-9A-Za-z]))
| (?P<ip>(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9]))
| (?P<iso>(?<![0-9\-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9\-]))
| (?P<dmy>(?<![0-9/.])[0-9]{1,2}(?:/[0-9]{1,2}/|[.][0-9]{1,2}[.]|/[0-9]{1,2}[.]|[.][0-9]{1,2}/)[0-9]{4}(?![0-9]))
| (?P<ssn>(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-]))
| (?P<phone>(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .\-]?\(?[0-9]{1,4}\)?(?:[ .\-]?[0-9]{2,4}){2,4}
           |\(?[0-9]{3}\)?[ .\-][0-9]{3}[ .\-][0-9]{4})(?![0-9]))
"""
# Candidates that only their check digits tell from other numbers.
_CHECKED = r"""
| (?P<iban>(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![0-9A-Za-z]))
| (?P<number>(?<![0-9])[0-9](?:[ \-]?[0-9]){12,}(?![0-9]))
"""
_PATTERN = re.compile(_FORMATS, re.X)
_CANDIDATES = re.compile(_FORMATS + _CHECKED, re.X)
_DOMAIN = re.compile(r"(?:[\w\-]{1,63}\.){1,9}[^\W\d_]{2,24}")
LONG_LOCAL = 64                # characters; longer local parts are permuted as strings


class Permuter:
    """A keyed permutation without fixed points on 0..n-1 for any n >= 2."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _f(self, tweak: bytes, i: int, x: int, m: int) -> int:
        width = (m.bit_length() + 71) // 8
        data = b"%s|%d|%d|%d" % (tweak, i, m, x)
        out, k = b"", 0
        while len(out) < width:
            out += hashlib.blake2b(data + b"|%d" % k, key=self.key, digest_size=32).digest()
            k += 1
        return int.from_bytes(out[:width], "big") % m

    def _network(self, x: int, n: int, tweak: bytes, back: bool) -> int:
        a_mod = isqrt(n - 1) + 1
        b_mod = -(-n // a_mod)
        while True:                                   # cycle walking: stay below n
            a, b = divmod(x, b_mod)
            for i in (reversed(range(ROUNDS)) if back else range(ROUNDS)):
                sign = -1 if back else 1
                if i % 2:
                    b = (b + sign * self._f(tweak, i, a, b_mod)) % b_mod
                else:
                    a = (a + sign * self._f(tweak, i, b, a_mod)) % a_mod
            x = a * b_mod + b
            if x < n:
                return x

    def permute(self, x: int, n: int, tweak: bytes, back: bool = False) -> int:
        if n < 2:
            return x
        y = (self._network(x, n, tweak, False) + (-1 if back else 1)) % n
        return self._network(y, n, tweak, True)

    def within(self, x: int, n: int, tweak: bytes, ok: Callable[[int], bool], back: bool) -> int:
        """The same on the subset of 0..n-1 that meets ``ok`` (walk on until one does)."""
        y = self.permute(x, n, tweak, back)
        while not ok(y):
            y = self.permute(y, n, tweak, back)
        return y


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits_back(shape: str, digits: str) -> str:
    it = iter(digits)
    return "".join(next(it) if "0" <= c <= "9" else c for c in shape)


def _digits(p: Permuter, s: str, tweak: bytes, back: bool) -> str:
    d = re.sub("[^0-9]", "", s)
    y = p.permute(int(d), 10 ** len(d), tweak + b"%d" % len(d), back)
    return _digits_back(s, str(y).zfill(len(d)))


def _phone(p, s, back):
    m = re.match(r"\+[0-9]{1,3}(?=[ .\-(])", s)       # the country code stays
    head = m.group() if m else ""
    n = len(re.sub("[^0-9]", "", s))
    if n < 7:
        return None
    if n > 15:                                        # a number that follows is none of its groups
        cut = max(s.rfind(c, 0, len(s)) for c in " .-")
        return None if cut <= len(head) else _joined(_phone(p, s[:cut], back), s[:cut], s[cut:], p, back)
    return head + _digits(p, s[len(head):], b"phone" + head.encode(), back)


def _joined(new, old, rest, p, back):
    return (old if new is None else new) + _CANDIDATES.sub(lambda m: _KINDS[m.lastgroup](p, m.group(), back) or m.group(), rest)


def _card(digits: str) -> bool:
    return 13 <= len(digits) <= 19 and "2" <= digits[0] <= "6" and luhn(digits)


def _number(p, s, back):
    """The card numbers among the groups of a run of digits; the rest stays."""
    groups = [(m.start(), m.end()) for m in re.finditer("[0-9]+", s)]
    out, done, i = [], 0, 0
    while i < len(groups):
        found, digits = None, ""
        for j in range(i, len(groups)):
            digits += s[slice(*groups[j])]
            if len(digits) > 19:
                break
            if _card(digits):
                found = j, digits                     # the longest that validates
        if found is None:
            i += 1
            continue
        j, d = found
        n = len(d) - 1                                # permute the payload, renew the check digit
        x = (int(d[0]) - 2) * 10 ** (n - 1) + int(d[1:n])
        y = str(p.permute(x, 5 * 10 ** (n - 1), b"card%d" % n, back) + 2 * 10 ** (n - 1))
        new = next(y + c for c in "0123456789" if luhn(y + c))
        start, end = groups[i][0], groups[j][1]
        out += [s[done:start], _digits_back(s[start:end], new)]
        done, i = end, j + 1
    return "".join(out) + s[done:] if out else None


def _iban_check(country: str, body: str) -> int:
    return 98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97


def _iban(p, s, back):
    """Letters and digits after the check digits, each in its kind; the check digits follow."""
    ends = [m.start() for m in re.finditer("(?= |$)", s)]
    for end in reversed(ends):                        # words in capitals may follow
        flat = s[:end].replace(" ", "")
        country, check, body = flat[:2], flat[2:4], flat[4:]
        if not 15 <= len(flat) <= 34 or f"{_iban_check(country, body):02d}" != check:
            continue
        kinds = ["0" if c.isdigit() else "A" for c in body]
        x, n = 0, 1
        for c, k in zip(body, kinds):
            r = 10 if k == "0" else 26
            x, n = x * r + ord(c) - ord(k), n * r
        y, new = p.permute(x, n, b"iban" + (country + "".join(kinds)).encode(), back), []
        for k in reversed(kinds):
            y, v = divmod(y, 10 if k == "0" else 26)
            new.append(chr(ord(k) + v))
        body = "".join(reversed(new))
        it = iter(f"{country}{_iban_check(country, body):02d}{body}")
        return "".join(c if c == " " else next(it) for c in s[:end]) + s[end:]
    return None


def _ip(p, s, back):
    octets = [int(x) for x in s.split(".")]
    if max(octets) > 255 or any(len(x) > 1 and x[0] == "0" for x in s.split(".")):
        return None
    y = p.permute(int.from_bytes(bytes(octets), "big"), 1 << 32, b"ip", back)
    return ".".join(str(x) for x in y.to_bytes(4, "big"))


_FIRST, _LAST = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()


def _day(p, d: dt.date, back) -> dt.date:
    x, n = d.toordinal(), dt.date.max.toordinal()
    if _FIRST <= x <= _LAST:                          # usual years stay usual years
        return dt.date.fromordinal(_FIRST + p.permute(x - _FIRST, _LAST - _FIRST + 1, b"day", back))
    return dt.date.fromordinal(1 + p.within(
        x - 1, n, b"far", lambda v: not _FIRST <= v + 1 <= _LAST, back))


def _iso(p, s, back):
    try:
        return _day(p, dt.date.fromisoformat(s), back).isoformat()
    except ValueError:
        return None


def _dmy(p, s, back):
    """Day first where that is a date, else month first. The lengths of both fields stay, so one-digit
    fields permute among dates that have them."""
    first, second = re.split("[/.]", s)[:2]
    at = len(first), len(first) + 1 + len(second)
    year = int(s[-4:])
    for swapped in (False, True):
        day, month = (second, first) if swapped else (first, second)
        try:
            d = dt.date(year, int(month), int(day))
        except ValueError:
            continue

        def fits(v: dt.date) -> bool:
            return ((len(day) == 2 or v.day < 10) and (len(month) == 2 or v.month < 10)
                    and (not swapped or v.day > 12))

        new = _day(p, d, back)
        while not fits(new):
            new = _day(p, new, back)
        a, b = f"{new.day:0{len(day)}d}", f"{new.month:0{len(month)}d}"
        return f"{b if swapped else a}{s[at[0]]}{a if swapped else b}{s[at[1]]}{new.year:04d}"
    return None


@lru_cache(maxsize=4096)
def _alphabet(c: str) -> str:
    """The characters that may stand for this one: of ASCII its kind, else those of its category in
    its block of 64 code points. Marks and signs stand for themselves."""
    if c.isascii():
        return ("0123456789" if c.isdigit() else "abcdefghijklmnopqrstuvwxyz" if c.islower()
                else "ABCDEFGHIJKLMNOPQRSTUVWXYZ" if c.isupper() else c)
    if not c.isalnum():
        return c
    kind, start = unicodedata.category(c), ord(c) & ~63
    return "".join(x for x in map(chr, range(start, start + 64)) if unicodedata.category(x) == kind and x.isalnum())


def _permute_string(p: Permuter, local: str, alphabets: list[str], tweak: bytes, back: bool) -> str:
    """A string of any length, in linear time: a Feistel network over its two halves, whose round
    function is a keyed stream of places in the characters' alphabets. As in ``Permuter.permute``, the
    permutation is a step of one seen through the network."""
    x = [a.index(c) for a, c in zip(alphabets, local)]
    half = len(x) // 2

    def rounds(x: list[int], order, sign: int) -> list[int]:
        for i in order:
            keep, move = (slice(half), slice(half, None)) if i % 2 else (slice(half, None), slice(half))
            seed = hashlib.blake2b(b"%s|%d|" % (tweak, i) + b",".join(b"%d" % v for v in x[keep]), key=p.key).digest()
            stream = hashlib.shake_256(seed).digest(8 * len(x[move]))
            x[move] = [(v + sign * int.from_bytes(stream[8 * j:8 * j + 8], "big")) % len(a)
                       for j, (v, a) in enumerate(zip(x[move], alphabets[move]))]
        return x

    x = rounds(x, range(ROUNDS), 1)
    for i in reversed(range(len(x))):                 # plus or minus one, with carries
        x[i] = (x[i] + (-1 if back else 1)) % len(alphabets[i])
        if x[i] != (len(alphabets[i]) - 1 if back else 0):
            break
    x = rounds(x, reversed(range(ROUNDS)), -1)
    return "".join(a[v] for a, v in zip(alphabets, x))


def _local(p: Permuter, local: str, domain: str, back: bool) -> str | None:
    """Letters and digits of the local part, each in its alphabet, numbered in mixed radix."""
    alphabets = [_alphabet(c) for c in local]
    if all(len(a) < 2 for a in alphabets):
        return None
    kinds = "".join("0" if a[0] == "0" else "a" if a[0] in "aA" else a[0] for a in alphabets)
    tweak = b"mail" + kinds.encode() + domain.lower().encode()
    if len(local) > LONG_LOCAL:
        return _permute_string(p, local, alphabets, hashlib.blake2b(tweak).digest(), back)
    x, n = 0, 1
    for a, c in zip(alphabets, local):
        x, n = x * len(a) + a.index(c), n * len(a)
    y, out = p.permute(x, n, tweak, back), []
    for a in reversed(alphabets):
        y, v = divmod(y, len(a))
        out.append(a[v])
    return "".join(reversed(out))


def _in_local(text: str, i: int) -> bool:
    c = text[i]
    return (c.isalnum() or c in "_%+-." or not c.isascii() and unicodedata.category(c)[0] == "M"
            or c in "'\u2019" and 0 < i and text[i - 1].isalnum() and text[i + 1].isalnum())


def addresses(text: str) -> list[tuple[int, int, int]]:
    """``(start, at, end)`` of the e-mail addresses of a text, found from each ``@``."""
    found, done = [], 0
    at = text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at + 1)
        if m is not None:
            start = at
            while start > done and _in_local(text, start - 1):
                start -= 1
            if start < at:
                found.append((start, at, m.end()))
                done = m.end()
        done = max(done, at + 1)
        at = text.find("@", done)
    return found


def _token(p, s, back):
    n = len(s)
    y = format(p.permute(int(s, 16), 16 ** n, b"hex%d" % n, back), f"0{n}x")
    return y.upper() if s != s.lower() else y


_KINDS: dict[str, Callable] = {
    "token": _token, "ip": _ip, "iso": _iso, "dmy": _dmy, "iban": _iban,
    "ssn": lambda p, s, back: _digits(p, s, b"ssn", back), "phone": _phone, "number": _number}


@lru_cache(maxsize=8)
def _permuter(key: bytes) -> Permuter:
    return Permuter(key)


def replace_all(text: str, key: bytes, back: bool = False) -> tuple[str, list[str]]:
    """The text with every validated value permuted, and the kinds found, in order."""
    p, kinds, out, done = _permuter(key), [], [], 0

    def one(m: re.Match) -> str:
        new = _KINDS[m.lastgroup](p, m.group(), back)
        if new is None:
            return m.group()
        kinds.append(m.lastgroup)
        return new

    for start, at, end in addresses(text):
        new = _local(p, text[start:at], text[at + 1:end], back)
        out.append(_CANDIDATES.sub(one, text[done:start]))
        if new is not None:
            kinds.append("email")
        out.append((text[start:at] if new is None else new) + text[at:end])
        done = end
    out.append(_CANDIDATES.sub(one, text[done:]))
    return "".join(out), kinds


def reveal(text: str, key: bytes) -> str:
    """Inverse of the replacement for whoever holds the key."""
    return replace_all(text, key, back=True)[0]


def pseudonymise(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """``__row, text, kinds``: texts with pseudonyms and the kinds of the values replaced.

    Only texts with a digit or an at sign travel to Python.
    """
    @F.pandas_udf("text string, kinds array<string>")
    def swap(texts: pd.Series) -> pd.DataFrame:
        done = [(None, []) if t is None else replace_all(t, key) for t in texts]
        return pd.DataFrame(done, columns=["text", "kinds"])

    d = packed(docs)
    t = F.col(f"__row.`{text}`")
    d = d.withColumn("__new", swap(F.when(t.rlike("[0-9@]"), t)))
    return d.select("__row", F.coalesce("__new.text", t).alias("text"), F.col("__new.kinds").alias("kinds"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return pseudonymise(docs, DEMO_KEY).select(
        "__row.doc_id", "text", F.size("kinds").alias("n_values"),
        F.array_join("kinds", ",").alias("kinds"))
