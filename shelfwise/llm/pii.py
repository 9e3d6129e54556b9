"""Format-preserving pseudonyms of personal data by a keyed Feistel permutation.

A value is validated (check digits, calendar, number ranges), ranked among all values of its kind
and format, permuted there under a key and written back in its own separators, case and padding.
Ranks do not depend on separators, so one card number or date has one pseudonym in all documents,
whichever way it is written, and check digits hold again. No value is its own pseudonym.

Kinds, the earlier one holding where spans overlap: email, iban, card, ssn, phone, ip, date.
"""

from __future__ import annotations

import datetime
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfwise.llm.arrow import over_texts, sliced, table

ROUNDS = 8
SHORTEST = len("8.8.8.8")  # of all kinds made of digits
KINDS = ("email", "iban", "card", "ssn", "phone", "ip", "date")
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()

# Islands of digits and what may stand between them; the kinds made of digits are looked for in these.
_ISLAND = re.compile(r"[+(]?\d[\d+ ()./-]*")
_EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])([A-Za-z0-9._%+-]++)@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_CARD = re.compile(r"(?<![\w.])(?:\d{13,19}|\d{4} \d{4} \d{4} \d{4}(?: \d{3})?|\d{4}-\d{4}-\d{4}-\d{4}(?:-\d{3})?|\d{4}([ -])\d{6}\1\d{4,5})(?![\w]|[.-]\d)")
_SSN = re.compile(r"(?<![\w-])(\d{3})([- ])(\d{2})\2(\d{4})(?![\w]|-\d)")
_PHONE = re.compile(r"(?<![\w.])(?:(\+\d{1,3})[ .-]?)?(?:\((\d{3})\)[ .-]?|(\d{3})[ .-])(\d{3})[ .-]?(\d{4})(?![\w]|[.-]\d)")
_PHONE_INTERNATIONAL = re.compile(r"(?<![\w.])(\+\d{1,3})[ .-]?(\d(?:[ .-]?\d){6,11})(?![\w]|[.-]\d)")
_IP = re.compile(r"(?<![\w.-])(\d{1,3})\.(\d{1,3})\.(\d{1,3})\.(\d{1,3})(?![\w]|\.\d)")
_DATE = re.compile(r"(?<![\w./-])(?:(\d{4})([-/.])(\d{1,2})\2(\d{1,2})|(\d{1,2})([-/.])(\d{1,2})\6(\d{4}))(?![\w]|[./-]\d)")

_IBAN_LENGTH = {c[:2]: int(c[2:]) for c in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 GB22 GE22 GI23 "
    "GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MR27 MT31 MU30 "
    "NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SD18 SE24 SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20").split()}


class Permutation:
    """Keyed permutations of 0 to n - 1 without fixed points, by Feistel rounds and cycle walking."""

    def __init__(self, key: bytes):
        self.key = key

    def _round(self, kind: str, n: int, i: int, half: int) -> int:
        said, bits = f"{kind}/{n}/{i}/{half}".encode(), n.bit_length() // 2 + 1
        if bits <= 64:
            return int.from_bytes(blake2b(said, key=self.key, digest_size=16).digest(), "big")
        # As many blocks as make 64 bits more than the wider half has.
        blocks = (blake2b(said + b"/%d" % b, key=self.key, digest_size=64).digest() for b in range((bits + 64) // 512 + 1))
        return int.from_bytes(b"".join(blocks), "big")

    def _walk(self, kind: str, n: int, x: int, rounds: range, sign: int) -> int:
        low = 1 << ((n - 1).bit_length() + 1) // 2  # left half below ``high``, right half below ``low``
        high = -(-n // low)
        while True:
            left, right = divmod(x, low)
            for i in rounds:
                if i % 2:
                    left = (left + sign * self._round(kind, n, i, right)) % high
                else:
                    right = (right + sign * self._round(kind, n, i, left)) % low
            x = left * low + right
            if x < n:
                return x

    def __call__(self, kind: str, n: int, x: int) -> int:
        """Pseudonym of ``x``: one place on in the keyed order of 0 to n - 1."""
        place = self._walk(kind, n, x, range(ROUNDS), 1)
        return self._walk(kind, n, (place + 1) % n, range(ROUNDS - 1, -1, -1), -1)


def refilled(pattern: str, symbols: str) -> str:
    """``pattern`` with its letters and digits replaced in turn, letters in the case they had."""
    new = iter(symbols)
    return "".join((s.upper() if c.isupper() else s) if c.isalnum() and (s := next(new)) else c for c in pattern)


def permuted_symbols(permute: Permutation, kind: str, symbols: str) -> str:
    """Digits for digits and letters for letters (lower case), ranked by mixed radix."""
    radix, rank, n = [10 if c.isdigit() else 26 for c in symbols], 0, 1
    for c, r in zip(symbols, radix):
        rank, n = rank * r + (int(c) if r == 10 else ord(c) - 97), n * r
    shape = "".join("9" if r == 10 else "a" for r in radix)
    rank, out = permute(f"{kind}/{shape}", n, rank), []
    for r in reversed(radix):
        rank, digit = divmod(rank, r)
        out.append(str(digit) if r == 10 else chr(97 + digit))
    return "".join(reversed(out))


def luhn_digit(payload: str) -> str:
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _only(text: str) -> str:
    return "".join(c for c in text if c.isalnum())


def _email(m: re.Match, permute: Permutation) -> str | None:
    local = m.group(1)
    symbols = _only(local).lower()
    return refilled(local, permuted_symbols(permute, "email", symbols)) + m.group()[len(local) :] if symbols else None


def _iban(m: re.Match, permute: Permutation) -> str | None:
    plain = m.group().replace(" ", "")
    check = lambda body: int("".join(str(int(c, 36)) for c in body)) % 97
    if not 15 <= len(plain) <= 34 or check(plain[4:] + plain[:4]) != 1:
        return None
    body = permuted_symbols(permute, "iban" + plain[:2], plain[4:].lower()).upper()
    return refilled(m.group(), f"{plain[:2]}{98 - check(body + plain[:2] + '00'):02d}{body}")


def _iban_of_country(m: re.Match, permute: Permutation) -> str | None:
    """IBANs of the length of their country, which go before others: one check in 97 holds by chance."""
    return _iban(m, permute) if len(m.group().replace(" ", "")) == _IBAN_LENGTH.get(m.group()[:2]) else None


def _card(m: re.Match, permute: Permutation) -> str | None:
    digits = _only(m.group())
    if luhn_digit(digits[:-1]) != digits[-1] or not digits.strip("0"):
        return None
    payload = permuted_symbols(permute, "card", digits[:-1])
    return refilled(m.group(), payload + luhn_digit(payload))


def _ssn(m: re.Match, permute: Permutation) -> str | None:
    area, group, serial = int(m[1]), int(m[3]), int(m[4])
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    place = area - 1 - (area > 666)  # 898 areas
    rank = permute("ssn", 898 * 99 * 9999, (place * 99 + group - 1) * 9999 + serial - 1)
    place, rest = divmod(rank, 99 * 9999)
    area = place + 1 + (place >= 665)
    return f"{area:03d}{m[2]}{rest // 9999 + 1:02d}{m[2]}{rest % 9999 + 1:04d}"


def _phone(m: re.Match, permute: Permutation) -> str | None:
    country = m[1] or ""
    rest = m.group()[len(country) :]
    symbols = _only(rest)
    # A national number is the same with and without the country code before it.
    return country + refilled(rest, permuted_symbols(permute, "phone", symbols))


def _ip(m: re.Match, permute: Permutation) -> str | None:
    parts = [int(p) for p in m.groups()]
    if max(parts) > 255 or any(len(p) > 1 and p[0] == "0" for p in m.groups()):
        return None
    rank = permute("ip", 1 << 32, int.from_bytes(bytes(parts), "big"))
    return ".".join(map(str, rank.to_bytes(4, "big")))


def _date(m: re.Match, permute: Permutation) -> str | None:
    """Year first, or last with the day before the month unless only the other order is a date (always month first with '/')."""
    if m[1]:
        fields, order = (m[1], m[3], m[4]), "ymd"
    else:
        fields, order = (m[5], m[7], m[8]), "mdy" if m[6] == "/" else "dmy"
    orders = [order] if m[1] else [order, order[1] + order[0] + "y"]
    for order in orders:
        value = dict(zip(order, map(int, fields)))
        try:
            day = datetime.date(value["y"], value["m"], value["d"]).toordinal()
        except ValueError:
            continue
        if not FIRST_DAY <= day <= LAST_DAY:
            return None
        new = datetime.date.fromordinal(FIRST_DAY + permute("date", LAST_DAY - FIRST_DAY + 1, day - FIRST_DAY))
        value = {"y": new.year, "m": new.month, "d": new.day}
        sign = m[2] or m[6]
        # A two-figure field stays one; a one-figure field stays unpadded.
        return sign.join(str(value[k]).zfill(len(f) if len(f) > 1 else 1) for k, f in zip(order, fields))
    return None


_BY_DIGITS: tuple[tuple[str, re.Pattern, Callable], ...] = (
    ("card", _CARD, _card), ("ssn", _SSN, _ssn), ("phone", _PHONE, _phone), ("phone", _PHONE_INTERNATIONAL, _phone),
    ("ip", _IP, _ip), ("date", _DATE, _date))


def readings(pattern: re.Pattern, text: str, found: re.Match) -> Iterator[re.Match]:
    """A match and the shorter ones that end before a space in it, since what follows a value may look like its end."""
    yield found
    for end in range(found.end() - 1, found.start(), -1):
        if text[end] == " " and (m := pattern.fullmatch(text, found.start(), end)):
            yield m


Span = tuple[int, int, str, str]


def spans(text: str, permute: Permutation) -> list[Span]:
    """(start, end, kind, pseudonym) of the personal data of a text, in order and without overlaps."""
    def with_kind(known: list[Span], kind: str, pattern: re.Pattern, value: Callable, pos: int, end: int) -> list[Span]:
        """``known``, in order, and the values of a kind that overlap none of them."""
        starts, new = [s[0] for s in known], []
        while found := pattern.search(text, pos, end):
            pos = found.start() + 1  # a value may begin within what is none
            for m in readings(pattern, text, found):
                before = bisect_left(starts, m.end())
                if before and known[before - 1][1] > m.start():
                    continue
                if (said := value(m, permute)) is not None:
                    new.append((m.start(), m.end(), kind, said))
                    pos = m.end()
                    break
        return sorted(known + new) if new else known

    whole: list[Span] = []
    if "@" in text:
        whole = with_kind(whole, "email", _EMAIL, _email, 0, len(text))
    for value in (_iban_of_country, _iban):
        whole = with_kind(whole, "iban", _IBAN, value, 0, len(text))
    starts, found = [s[0] for s in whole], []
    for island in _ISLAND.finditer(text):
        a, b = island.span()
        if b - a < SHORTEST:
            continue
        end = min(b + 2, len(text))
        first = bisect_left(starts, a)
        first -= bool(first) and whole[first - 1][1] > a
        near = held = whole[first : bisect_left(starts, end)]
        for kind, pattern, value in _BY_DIGITS:
            near = with_kind(near, kind, pattern, value, a, end)
        if near is not held:
            found += [s for s in near if s[2] not in ("email", "iban")]
    return sorted(whole + found)


def pseudonymised(text: str, permute: Permutation) -> tuple[str, list[int]]:
    """The text with pseudonyms, and how many values of each kind were replaced."""
    found, out, at = spans(text, permute), [], 0
    counts = dict.fromkeys(KINDS, 0)
    for a, b, kind, new in found:
        out += [text[at:a], new]
        at = b
        counts[kind] += 1
    return ("".join([*out, text[at:]]) if found else text), list(counts.values())


def pseudonyms(docs: DataFrame, key: bytes, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, n_email, n_iban, ...): every whole text with its personal data replaced, and counts by kind.

    ``key`` decides the pseudonyms; keep it secret and use one for a corpus. A null text stays null,
    an empty one empty, with counts of 0; rows are kept one for one; other columns are ignored.
    """
    def replaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        permute = Permutation(key)
        for batch in batches:
            texts, counts = [], []
            for t in batch.column("text").to_pylist():
                new, n = (None, [0] * len(KINDS)) if t is None else pseudonymised(t, permute)
                texts.append(new)
                counts.append(n)
            numbers = np.array(counts, np.int64).reshape(-1, len(KINDS))
            yield table(doc_id=batch.column("doc_id"), text=pa.array(texts, pa.string()), **{f"n_{k}": pa.array(numbers[:, i]) for i, k in enumerate(KINDS)})

    return over_texts(docs, replaced, "doc_id long, text string, " + ", ".join(f"n_{k} long" for k in KINDS), id, text)


def with_pseudonyms(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """The rows with all their columns, ``text`` replaced as by ``pseudonyms``."""
    def replaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        permute = Permutation(key)
        for batch in sliced(batches, text):
            at = batch.schema.get_field_index(text)
            texts = [None if t is None else pseudonymised(t, permute)[0] for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(replaced, docs.schema)
