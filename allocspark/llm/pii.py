"""Pseudonyms for personal data that keep the format of what they stand for.

A value is found by its pattern, checked (check digits, calendar, ranges) and mapped to a number in
the domain of valid values of its format. Where a number in groups fails its check because other
numbers or words stand beside it, the parts of it that begin and end with a group are tried. A keyed Feistel network permutes that domain, and the
permuted number is written back in the same format. Equal values get equal pseudonyms under one
key, in any document, so they stay linked; without the key they can't be told. Nothing is stored
and rows are independent, so nothing shuffles.
"""

from __future__ import annotations

import bisect
import datetime
import functools
import hashlib
import ipaddress
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from allocspark.llm.common import replace_columns, schema_with

#: For tests and trials; a production run passes its own secret.
TRIAL_KEY = b"format-preserving pseudonyms"
ROUNDS = 8
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
RESULTS = ["n_replaced", "kinds"]


def permute(value: int, size: int, key: bytes, tweak: bytes) -> int:
    """A keyed permutation of 0 .. size - 1: a Feistel network over a * b >= size, with cycle walking."""
    if size < 2:
        return value
    a = max(2, round(size ** 0.5)) if size < 1 << 52 else 1 << (size.bit_length() + 1) // 2
    b = -(-size // a)
    while True:
        left, right = value // b, value % b
        for turn in range(ROUNDS):
            part = right if turn % 2 == 0 else left
            width = (part.bit_length() + 7) // 8 or 1
            digest = hashlib.blake2b(tweak + bytes([turn]) + part.to_bytes(width, "big"), key=key, digest_size=32).digest()
            number = int.from_bytes(digest, "big")
            if turn % 2 == 0:
                left = (left + number) % a
            else:
                right = (right + number) % b
        value = left * b + right
        if value < size:
            return value


class Cipher:
    """Permutes values of one kind; remembers what it has computed, within bounds."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()
        self.known: dict[tuple[str, str], str | None] = {}

    def mixed(self, values: list[int], sizes: list[int], tweak: str) -> list[int]:
        """Permutes a number written in mixed radix, as the digits and letters of a value are."""
        number, total = 0, 1
        for value, size in zip(values, sizes):
            number, total = number * size + value, total * size
        number = permute(number, total, self.key, f"{tweak}:{','.join(map(str, sizes))}".encode())
        result = []
        for size in reversed(sizes):
            number, rest = divmod(number, size)
            result.append(rest)
        return result[::-1]

    def letters(self, text: str, tweak: str) -> str:
        """Letters of a case to letters of that case, digits to digits; all else stays."""
        places, values, alphabets = [], [], []
        for place, char in enumerate(text):
            for alphabet in (LOWER, UPPER, DIGITS):
                if char in alphabet:
                    places.append(place)
                    values.append(alphabet.index(char))
                    alphabets.append(alphabet)
        shape = "".join("a" if c in LOWER else "A" if c in UPPER else "0" if c in DIGITS else c for c in text)
        result = list(text)
        for place, alphabet, value in zip(places, alphabets, self.mixed(values, [len(a) for a in alphabets], f"{tweak}:{shape}")):
            result[place] = alphabet[value]
        return "".join(result)

    def digits(self, text: str, new: str) -> str:
        """``text`` with its digits replaced, in order, by those of ``new``."""
        fresh = iter(new)
        return "".join(next(fresh) if c in DIGITS else c for c in text)

    def replace(self, kind: str, text: str) -> str | None:
        """The pseudonym of a value, None if it isn't valid for its kind."""
        if (kind, text) not in self.known:
            if len(self.known) > 200_000:
                self.known.clear()
            self.known[kind, text] = KINDS[kind][1](self, text)
        return self.known[kind, text]


def luhn_digit(payload: str) -> str:
    total = 0
    for place, char in enumerate(reversed(payload)):
        value = int(char) * (2 if place % 2 == 0 else 1)
        total += value - 9 * (value > 9)
    return str(-total % 10)


def _card(cipher: Cipher, text: str) -> str | None:
    """13 to 19 digits with a right check digit; the first, its network, stays."""
    found = re.sub(r"\D", "", text)
    if not 13 <= len(found) <= 19 or luhn_digit(found[:-1]) != found[-1] or len(set(found)) == 1:
        return None
    middle = cipher.mixed([int(c) for c in found[1:-1]], [10] * (len(found) - 2), "card")
    payload = found[0] + "".join(map(str, middle))
    return cipher.digits(text, payload + luhn_digit(payload))


def _long_number(cipher: Cipher, text: str) -> str | None:
    """A plain number of a card's length with a wrong check digit, as scans and typing give: its
    digits are permuted, and the wrong check digit keeps its distance from the right one."""
    found = re.sub(r"\D", "", text)
    if len(found) not in (15, 16) or found[0] not in "3456" or len(set(found)) == 1:
        return None
    wrong = int(found[-1]) - int(luhn_digit(found[:-1]))
    middle = cipher.mixed([int(c) for c in found[1:-1]], [10] * (len(found) - 2), "card")
    payload = found[0] + "".join(map(str, middle))
    return cipher.digits(text, payload + str((int(luhn_digit(payload)) + wrong) % 10))


def _phone(cipher: Cipher, text: str) -> str | None:
    """A ten-digit number; the country code stays, area and exchange stay valid where they are."""
    prefix = re.match(r"(?:\+\d{1,3}[ .-]?|1[ .-])?", text)[0]
    found = [int(c) for c in text[len(prefix):] if c in DIGITS]
    low = [2 if found[i] > 1 else 0 for i in (0, 3)]
    bases = [low[0], 0, 0, low[1], 0, 0, 0, 0, 0, 0]
    sizes = [8 if low[0] else 2, 10, 10, 8 if low[1] else 2, 10, 10, 10, 10, 10, 10]
    fresh = cipher.mixed([d - b for d, b in zip(found, bases)], sizes, "phone")
    return prefix + cipher.digits(text[len(prefix):], "".join(str(d + b) for d, b in zip(fresh, bases)))


def _international(cipher: Cipher, text: str) -> str | None:
    """+ and 8 to 15 digits in groups; the first group, the country, stays."""
    found = re.sub(r"\D", "", text)
    country = re.match(r"\+\d{1,3}", text)[0]
    rest = text[len(country):]
    digits = [int(c) for c in rest if c in DIGITS]
    if not 8 <= len(found) <= 15 or len(digits) < 6:
        return None
    return country + cipher.digits(rest, "".join(map(str, cipher.mixed(digits, [10] * len(digits), "international"))))


def _ipv4(cipher: Cipher, text: str) -> str | None:
    octets = text.split(".")
    if any(len(o) > 1 and o[0] == "0" or int(o) > 255 for o in octets):
        return None
    address = ipaddress.IPv4Address(text)
    if address.is_loopback or address.is_unspecified or int(address) == 0xFFFFFFFF:
        return None
    return ".".join(map(str, cipher.mixed([int(o) for o in octets], [256] * 4, "ipv4")))


def _ssn(cipher: Cipher, text: str) -> str | None:
    """Area 001-899 without 666, group 01-99, number 0001-9999."""
    area, group, number = map(int, text.split("-"))
    if not 1 <= area <= 899 or area == 666 or not group or not number:
        return None
    area, group, number = cipher.mixed([area - 1 - (area > 666), group - 1, number - 1], [898, 99, 9999], "ssn")
    area += 1
    return f"{area + (area >= 666):03d}-{group + 1:02d}-{number + 1:04d}"


def _iban(cipher: Cipher, text: str) -> str | None:
    """Country stays, the account is permuted, the check digits are computed anew."""
    plain = text.replace(" ", "")

    def rest(value: str) -> int:
        return int("".join(str(int(c, 36)) for c in value)) % 97

    if not 15 <= len(plain) <= 34 or rest(plain[4:] + plain[:4]) != 1:
        return None
    account = cipher.letters(plain[4:], "iban" + plain[:2])
    fresh = iter(plain[:2] + f"{98 - rest(account + plain[:2] + '00'):02d}" + account)
    return "".join(" " if c == " " else next(fresh) for c in text)


def _email(cipher: Cipher, text: str) -> str | None:
    """Name and the labels of the host are permuted by letter kind; the last label stays."""
    name, host = text.rsplit("@", 1)
    labels = host.split(".")
    return f"{cipher.letters(name, 'name')}@{'.'.join([*(cipher.letters(l, 'host') for l in labels[:-1]), labels[-1]])}"


def _secret(cipher: Cipher, text: str) -> str | None:
    """What stands behind ``=`` or ``:``, or after the fixed beginning of a key."""
    prefix = re.match(r"(?:AKIA|ASIA|ghp_|sk-|(?:password|passwd|pwd|token|secret|api[_-]?key)\s*[=:]\s*[\"']?)", text, re.I)[0]
    return prefix + cipher.letters(text[len(prefix):], "secret")


def _date(cipher: Cipher, text: str) -> str | None:
    """A day of 1900 to 2099; day first where that is a date, else month first."""
    parts = re.split(r"([./-])", text)
    first, second, third = parts[0], parts[2], parts[4]
    orders = ["ymd"] if len(first) == 4 else ["dmy", "mdy"]
    for order in orders:
        named = dict(zip(order, (int(first), int(second), int(third))))
        try:
            day = datetime.date(named["y"], named["m"], named["d"]).toordinal()
        except ValueError:
            continue
        if not FIRST_DAY <= day <= LAST_DAY:
            return None
        # Month first are only the days past the twelfth, and they stay among themselves.
        days, places = _days(order)
        fresh = datetime.date.fromordinal(days[permute(places[day], len(days), cipher.key, f"date:{order}".encode())])
        values = {"y": fresh.year, "m": fresh.month, "d": fresh.day}
        padded = [str(values[k]).zfill(len(p)) for k, p in zip(order, (first, second, third))]
        return padded[0] + parts[1] + padded[1] + parts[3] + padded[2]
    return None


@functools.lru_cache(maxsize=3)
def _days(order: str) -> tuple[list[int], dict[int, int]]:
    """Days that are read in ``order``, and their places."""
    days = [d for d in range(FIRST_DAY, LAST_DAY + 1) if order != "mdy" or datetime.date.fromordinal(d).day > 12]
    return days, {day: place for place, day in enumerate(days)}


#: kind -> (pattern, pseudonym or None); earlier kinds win where two match at a place.
KINDS: dict[str, tuple[str, Callable[[Cipher, str], str | None]]] = {
    "email": (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,62})\.)+[A-Za-z]{2,24}(?![A-Za-z0-9])", _email),
    "secret": (r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])|(?:ghp_|sk-)[A-Za-z0-9]{20,}"
               r"|(?i:password|passwd|pwd|token|secret|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?[A-Za-z0-9+/_.-]{6,})", _secret),
    "iban": (r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", _iban),
    "ipv4": (r"(?<![\w.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\w]|\.\d)", _ipv4),
    "date": (r"(?<![\w./-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{4}\.\d{2}\.\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}-\d{1,2}-\d{4})(?![\w/-]|\.\d)", _date),
    "ssn": (r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", _ssn),
    "phone": (r"(?<![\w+.-])(?:\+\d{1,3}[ .-]?|1[ .-])?(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-]|\.\d)", _phone),
    "card": (r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?!\w|-(?!\d{1,4}(?![\w-]))|\.\d)", _card),
    "number": (r"(?<![\w.-])\d{15,16}(?![\w-]|\.\d)", _long_number),
    "international": (r"(?<![\w+])\+\d{1,3}(?:[ .-]?\(?\d{1,5}\)?){2,6}(?![\w-]|\.\d)", _international),
}
_PATTERNS = {kind: re.compile(pattern) for kind, (pattern, _) in KINDS.items()}
#: Every pattern has one of these within it, so a text without them is passed by.
_ANY = re.compile(r"[\d@]|AKIA|ASIA|ghp_|sk-|(?i:pass|pwd|token|secret|api)")
#: Kinds of which parts are tried, with the pattern that such a part has to match where it begins.
_PARTS = {"iban": _PATTERNS["iban"], "card": re.compile(KINDS["card"][0].removeprefix(r"(?<![\w.-])")), "international": _PATTERNS["international"]}
_GROUP = re.compile(r"[A-Za-z0-9]+")
IBAN_LENGTHS = {country: int(length) for length, countries in (entry.split(":") for entry in (
    "15:NO 16:BE 18:DK,FI,FK,FO,GL,NL,SD 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,MN,XK 21:CH,HR,LI,LV 22:BG,BH,CR,DE,GB,GE,IE,ME,RS,VA "
    "23:AE,GI,IL,IQ,OM,SO,TL 24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,TN,VG 25:LY,PT,ST 26:IS,TR 27:BI,DJ,FR,GR,IT,MC,MR,SM "
    "28:AL,AZ,BY,CY,DO,GT,HN,HU,LB,NI,PL,SV 29:BR,EG,PS,QA,UA 30:JO,KW,MU,YE 31:MT,SC 32:LC 33:RU").split()) for country in countries.split(",")}
#: First digits and usual lengths of the card networks.
_NETWORKS = re.compile(
    r"(?:(?:4\d{3}|5\d{3}|222[1-9]|22[3-9]\d|2[3-6]\d\d|27[01]\d|2720|6011|64[4-9]\d|65\d\d|67\d\d|62\d\d|35\d\d)\d{12}"
    r"|3[47]\d{13}|3(?:0[0-59]|[689]\d)\d{11})")


def _spans(kind: str, text: str, match: re.Match) -> Iterator[int]:
    """Ends of what may be the value that begins where ``match`` does: the match's own and those of
    its groups, the longest first; of an IBAN the one that its country fixes before all."""
    start, last = match.span()
    if kind not in _PARTS:
        yield last
        return
    ends = [group.end() for group in _GROUP.finditer(text, start, last)]
    if kind == "iban" and text[start:start + 2] in IBAN_LENGTHS:
        length = IBAN_LENGTHS[text[start:start + 2]]
        yield from (end for end in ends if len(text[start:end].replace(" ", "")) == length)
        yield last
        return
    yield last
    for end in reversed(ends):
        yield end + (text[end:end + 1] == ")")


def _is_card(text: str) -> bool:
    """Whether part of a longer stretch is written or begins like a card, and is no chance find in a
    row of small numbers: in groups of three digits or more but for the last, or a network's."""
    return all(len(group) > 2 for group in re.split("[ -]", text)[:-1]) or bool(_NETWORKS.fullmatch(re.sub(r"\D", "", text)))


def _find(cipher: Cipher, kind: str, text: str, taken: list[tuple[int, int, str, str]]) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, pseudonym) of the kind's values, in order, that overlap with none in ``taken``,
    which is in order and without overlaps. Each value begins behind the one before."""
    pattern, inner = _PATTERNS[kind], _PARTS.get(kind)
    match, tried, found = pattern.search(text), 0, []
    while match:
        start, last = match.span()
        at = None
        for end in _spans(kind, text, match):
            if kind == "card" and (start < tried or end < last) and not _is_card(text[start:end]):
                continue
            place = bisect.bisect_left(taken, (end,))  # the last that begins before ``end`` ends last
            if place and taken[place - 1][1] > start:
                continue
            fresh = cipher.replace(kind, text[start:end])
            if fresh is not None:
                found.append((start, end, kind, fresh))
                at = end
                break
        if at is not None or not inner:
            match = pattern.search(text, last if at is None else at)
            continue
        # Nothing begins here: go on one group later.
        tried = max(tried, last)
        groups = _GROUP.finditer(text, start + (kind == "international"), last)
        next(groups)
        at = next((group.start() for group in groups), last)
        match = (inner.match(text, at) if at < last else None) or pattern.search(text, at)
    return found


def pseudonymise(cipher: Cipher, text: str | None) -> tuple[str | None, list[tuple[int, int, str]]]:
    """(text with pseudonyms, spans of the values in the given text)."""
    if not text or not _ANY.search(text):
        return text, []
    found: list[tuple[int, int, str, str]] = []
    for kind in KINDS:
        found = sorted([*found, *_find(cipher, kind, text, found)])
    parts, at = [], 0
    for start, end, _, fresh in found:
        parts += [text[at:start], fresh]
        at = end
    return "".join([*parts, text[at:]]), [(start, end, kind) for start, end, kind, _ in found]


def pseudonymise_column(df: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """Every row of ``df`` with pseudonyms in ``text_col``, n_replaced and kinds (sorted, distinct).

    A null text stays null, an empty or clean one stays as it is, with n_replaced 0 and no kinds.
    Values that fail their check are left. Rows are independent; input columns named like a result
    column are replaced.
    """
    kept = replace_columns(df, RESULTS)
    at = [c.lower() for c in kept.columns].index(text_col.lower())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cipher = Cipher(key)
        for batch in batches:
            found = [pseudonymise(cipher, text) for text in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array([text for text, _ in found], batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([len(spans) for _, spans in found], pa.int64()),
                 pa.array([sorted({kind for _, _, kind in spans}) for _, spans in found], pa.list_(pa.string()))],
                names=[*batch.schema.names, *RESULTS])

    return kept.mapInArrow(run, schema_with(kept, n_replaced="long", kinds="array<string>"))
