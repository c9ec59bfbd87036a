"""Personal data: format-preserving pseudonyms by keyed Feistel permutations.

What is found and validated is replaced by another value of the same format:
card numbers (Luhn), phone numbers, IPv4 addresses, social security numbers,
IBANs (mod 97), dates of the calendar, mail addresses, and secrets (assigned
passwords, keys and tokens, cloud access keys, private key blocks). Each kind
has its own key, and the replacement is a permutation of the values of its
format, so equal values stay equal across documents, and different ones
different, without any table of pseudonyms: the operator is one pass.

The permutation is a balanced Feistel network over the range of the format, with
cycle walking where the range is no power of two or a value would be invalid. Long
secrets are permuted in pieces, each shifted by what the one before it became.
Time is linear in a text, whatever it holds.

The key is the caller's (`session_key`: the session setting `KEY_SETTING`, else one
drawn at random for the running application, which is written nowhere). Whoever has
it can undo the pseudonyms; without the setting they link within one application
only.

Null text stays null, texts without findings stay as they are. Repeated rows get
equal texts. An empty table gives none. Other columns are untouched.
"""

from __future__ import annotations

import datetime
import hashlib
import re
import secrets
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellframe.llm.common import map_arrow, map_columns

#: Session setting of the key, any text; the same key gives the same pseudonyms.
KEY_SETTING = "spark.cellframe.pii.key"
ROUNDS = 8
# Letters and digits that are permuted as one number.
PIECE = 256

_drawn: dict[str, bytes] = {}


def session_key(spark: SparkSession) -> bytes:
    """The key of this session or, where none is set, of this application."""
    given = spark.conf.get(KEY_SETTING, None)
    if given:
        return hashlib.sha256(given.encode()).digest()
    return _drawn.setdefault(spark.sparkContext.applicationId, secrets.token_bytes(32))


class Permutation:
    """A keyed permutation of 0 .. size - 1."""

    def __init__(self, key: bytes, name: str, size: int):
        self.size = size
        self.half = max(1, ((size - 1).bit_length() + 1) // 2)
        self.mask = (1 << self.half) - 1
        self.state = hashlib.blake2b(key=key[:64], person=name.encode()[:16].ljust(16))
        self.bytes = (self.half + 7) // 8

    def _round(self, number: int, side: int) -> int:
        state = self.state.copy()
        state.update(bytes([number]) + side.to_bytes(self.bytes, "little"))
        digest = state.digest()
        while len(digest) < self.bytes:
            digest += hashlib.blake2b(digest).digest()
        return int.from_bytes(digest[: self.bytes], "little") & self.mask

    def forward(self, value: int) -> int:
        while True:
            left, right = value >> self.half, value & self.mask
            for number in range(ROUNDS):
                left, right = right, left ^ self._round(number, right)
            value = left << self.half | right
            if value < self.size:
                return value

    def backward(self, value: int) -> int:
        while True:
            left, right = value >> self.half, value & self.mask
            for number in reversed(range(ROUNDS)):
                left, right = right ^ self._round(number, left), left
            value = left << self.half | right
            if value < self.size:
                return value


_permutations: dict[tuple[bytes, str, int], Permutation] = {}


def permuted(
    key: bytes, name: str, size: int, value: int,
    valid: Callable[[int], bool] | None = None,
) -> int:
    """The pseudonym of a value of a format; walks on past invalid ones."""
    found = (key, name, size)
    if found not in _permutations:
        if len(_permutations) > 10_000:
            _permutations.clear()
        _permutations[found] = Permutation(*found)
    permutation = _permutations[found]
    while True:
        value = permutation.forward(value)
        if valid is None or valid(value):
            return value


# Alphabets whose characters are exchanged among themselves.
_CLASSES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_PLACE = {c: (len(a), i, a) for a in _CLASSES for i, c in enumerate(a)}


def spelled(key: bytes, name: str, text: str) -> str:
    """Permute letters and digits, each among its kind; the rest stays."""
    out, before = [], ""
    for start in range(0, len(text), PIECE):
        before = _spelled(key, name, text[start : start + PIECE], before)
        out.append(before)
    return "".join(out)


def _spelled(key: bytes, name: str, text: str, before: str) -> str:
    """One piece; what the piece before it became shifts its value."""
    size, value = 1, 0
    for c in text:
        if c in _PLACE:
            base, place, _ = _PLACE[c]
            size, value = size * base, value * base + place
    if before:
        value = (value + int.from_bytes(hashlib.blake2b(before.encode()).digest() * 6)) % size
    value = permuted(key, f"{name}{size.bit_length()}", size, value)
    out = []
    for c in reversed(text):
        if c in _PLACE:
            base, _, alphabet = _PLACE[c]
            value, place = divmod(value, base)
            c = alphabet[place]
        out.append(c)
    return "".join(reversed(out))


def luhn(digits: str) -> bool:
    """The check digit of card numbers."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _refill(template: str, digits: str) -> str:
    """Put digits into the places of a template's digits."""
    left = iter(digits)
    return "".join(next(left) if c.isdigit() else c for c in template)


def card(key: bytes, found: re.Match) -> str | None:
    text = found[0]
    digits = re.sub(r"\D", "", text)
    if not 13 <= len(digits) <= 19 or not luhn(digits):
        return None
    n = len(digits) - 1
    body = str(permuted(key, f"card{n}", 10**n, int(digits[:-1]))).zfill(n)
    check = next(c for c in "0123456789" if luhn(body + c))
    return _refill(text, body + check)


def phone(key: bytes, found: re.Match) -> str | None:
    """North American numbers: area code and exchange start with 2 to 9."""
    text = found["local"]
    digits = re.sub(r"\D", "", text)
    if digits[0] in "01" or digits[3] in "01":
        return None

    def valid(n: int) -> bool:
        return n >= 2 * 10**9 and n // 10**6 % 10 >= 2

    other = str(permuted(key, "phone", 10**10, int(digits), valid))
    return found[0][: -len(text)] + _refill(text, other)


def international(key: bytes, found: re.Match) -> str | None:
    """+ country code and number: the digits after the code change."""
    digits = re.sub(r"\D", "", found["rest"])
    if not 6 <= len(digits) <= 13:
        return None
    n = len(digits)
    other = str(permuted(key, f"intl{n}", 10**n, int(digits))).zfill(n)
    return found["code"] + _refill(found["rest"], other)


def address(key: bytes, found: re.Match) -> str | None:
    """IPv4 with octets up to 255."""
    octets = [int(x) for x in found[0].split(".")]
    if max(octets) > 255:
        return None
    value = int.from_bytes(bytes(octets), "big")
    return ".".join(map(str, permuted(key, "ipv4", 1 << 32, value).to_bytes(4, "big")))


def _ssn_valid(value: int) -> bool:
    area, group, serial = value // 10**6, value // 10**4 % 100, value % 10**4
    return 0 < area < 900 and area != 666 and group > 0 and serial > 0


def ssn(key: bytes, found: re.Match) -> str | None:
    value = int(found[0].replace("-", "").replace(" ", ""))
    if not _ssn_valid(value):
        return None
    other = str(permuted(key, "ssn", 10**9, value, _ssn_valid)).zfill(9)
    return _refill(found[0], other)


def _iban_rest(code: str) -> int:
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97


def iban(key: bytes, found: re.Match) -> str | None:
    code = found[0].replace(" ", "")
    if not 15 <= len(code) <= 34 or _iban_rest(code) != 1:
        return None
    body = spelled(key, f"iban{code[:2]}", code[4:])
    check = 98 - _iban_rest(code[:2] + "00" + body)
    other = iter(f"{code[:2]}{check:02d}{body}")
    return "".join(c if c == " " else next(other) for c in found[0])


_FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2100, 1, 1).toordinal() - _FIRST_DAY


def date(key: bytes, found: re.Match) -> str | None:
    """Days of 1900 to 2099, written y-m-d, d.m.y, d/m/y or m/d/y.

    In d/m/y and m/d/y order the day of a month above 12 tells the two apart;
    otherwise m/d/y is taken. A time may follow y-m-d after a T.
    """
    first, mark, second, _, third = found.group("a", "mark", "b", "mark2", "c")
    numbers = [int(first), int(second), int(third)]
    if len(first) == 4:
        order = (0, 1, 2)
    elif mark == "." or numbers[0] > 12:
        order = (2, 1, 0)
    else:
        order = (2, 0, 1)
    try:
        day = datetime.date(*(numbers[i] for i in order)).toordinal() - _FIRST_DAY
    except ValueError:
        return None
    if not 0 <= day < _DAYS:
        return None
    day_first = mark != "." and len(first) != 4 and numbers[0] > 12

    def valid(n: int) -> bool:  # a day above 12 must go on telling the order
        return not day_first or datetime.date.fromordinal(_FIRST_DAY + n).day > 12

    other = datetime.date.fromordinal(
        _FIRST_DAY + permuted(key, "date", _DAYS, day, valid)
    )
    parts = ["", "", ""]
    for place, number in zip(order, (other.year, other.month, other.day)):
        parts[place] = f"{number:04d}" if number > 31 else f"{number:02d}"
    return parts[0] + mark + parts[1] + mark + parts[2]


def mail(key: bytes, found: re.Match) -> str:
    """The name and all labels of the domain but the last change."""
    name, domain = found[0].split("@", 1)
    labels, _, top = domain.rpartition(".")
    return f"{spelled(key, 'mail', name)}@{spelled(key, 'domain', labels)}.{top}"


def secret(key: bytes, found: re.Match) -> str:
    return found["lead"] + spelled(key, "secret", found["secret"])


def access_key(key: bytes, found: re.Match) -> str:
    return found[0][:4] + spelled(key, "access", found[0][4:])


def key_block(key: bytes, found: re.Match) -> str:
    return found["head"] + spelled(key, "block", found["body"]) + found["tail"]


_DIGIT_EDGE = r"(?<![\w.+-]){}(?![\w-]|\.\d)"

_MAIL = re.compile(
    r"[A-Za-z0-9][A-Za-z0-9._%+-]*+@(?:[A-Za-z0-9-]++\.)+[A-Za-z]{2,}")
_BEFORE_AT = re.compile(r"[^A-Za-z0-9._%+-]")
_FIRST_OF_MAIL = re.compile(r"[A-Za-z0-9]")


def mails(text: str) -> Iterator[re.Match]:
    """Addresses, looked for from each @ back to the start of its run of characters."""
    done = 0
    at = text.find("@")
    while at >= 0:
        # Back in steps that double, so that a long run is read about twice.
        start, step = at, 64
        while start > done:
            low = max(done, start - step)
            stops = [m.end() for m in _BEFORE_AT.finditer(text, low, start)]
            if stops:
                start = stops[-1]
                break
            start, step = low, 2 * step
        first = _FIRST_OF_MAIL.search(text, start, at)
        found = first and _MAIL.match(text, first.start())
        done = found.end() if found else at + 1
        if found:
            yield found
        at = text.find("@", done)


_BLOCK = re.compile(
    r"(?P<head>-----BEGIN [A-Z ]*+(?<=PRIVATE KEY)-----)(?P<body>.*?)"
    r"(?P<tail>-----END [A-Z ]*+(?<=PRIVATE KEY)-----)", re.S)
_BLOCK_TAIL = re.compile(r"-----END [A-Z ]*+(?<=PRIVATE KEY)-----")


def key_blocks(text: str) -> Iterator[re.Match]:
    """Key blocks, up to the last tail: no head before it goes without one."""
    if "PRIVATE KEY-----" not in text:
        return
    last = 0
    for last_tail in _BLOCK_TAIL.finditer(text):
        last = last_tail.end()
    yield from _BLOCK.finditer(text, 0, last)


# Kinds in order: what an earlier kind replaced is not looked at again.
Finder = Callable[[str], Iterator[re.Match]]
KINDS: list[tuple[str, Finder, Callable[[bytes, re.Match], str | None]]] = [
    ("key_block", key_blocks, key_block),
    ("secret", re.compile(
        r"(?P<lead>(?:\b|(?<=_))(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|"
        r"access[_-]?key|auth[_-]?key|client[_-]?secret)\b[\"']?\s*[:=]\s*[\"']?)"
        r"(?P<secret>[^\s\"',;]{6,})", re.I).finditer, secret),
    ("access_key", re.compile(r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b").finditer, access_key),
    ("mail", mails, mail),
    ("iban", re.compile(
        r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b").finditer, iban),
    ("card", re.compile(_DIGIT_EDGE.format(r"\d(?:[ -]?\d){12,18}")).finditer, card),
    ("ipv4", re.compile(_DIGIT_EDGE.format(r"\d{1,3}(?:\.\d{1,3}){3}")).finditer, address),
    ("date", re.compile(
        r"(?<![\w./-])(?P<a>\d{4}|\d{1,2})(?P<mark>[-./])(?P<b>\d{1,2})(?P<mark2>(?P=mark))"
        r"(?P<c>(?<=\d{4}[-./]\d{2}[-./])\d{1,2}|(?<=\d{4}[-./]\d[-./])\d{1,2}|\d{4})"
        r"(?:(?![\w/-]|\.\d)|(?<!\d{4})(?=T\d))").finditer, date),
    ("ssn", re.compile(_DIGIT_EDGE.format(r"\d{3}([- ])\d{2}\1\d{4}")).finditer, ssn),
    ("phone", re.compile(
        r"(?<![\w.-])(?:\+?1[ .-]?)?(?P<local>(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4})"
        r"(?![\w-]|\.\d)").finditer, phone),
    ("international", re.compile(
        r"(?<![\w.+-])(?P<code>\+[2-9]\d{0,2})(?P<rest>(?:[ .-]?\(?\d{1,4}\)?){2,6})"
        r"(?![\w-])").finditer, international),
]

# A text without any of these holds nothing of any kind: a condition of every pattern
# above. Numbers may stand as single digits (8.8.8.8, spaced cards), keys without any.
_ANY = re.compile(r"\d|@|A[KS]IA|PRIVATE KEY|(?i:pass|pwd|secret|token|key)")


def pseudonymise(text: str, key: bytes) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms and the spans (kind, start, length) in the new text."""
    if not _ANY.search(text):
        return text, []
    taken: list[tuple[int, int, str, str]] = []
    for kind, finder, replace in KINDS:
        # Both sides are in order of their places: one sweep finds what overlaps.
        new, at = [], 0
        for found in finder(text):
            start, end = found.span()
            while at < len(taken) and taken[at][1] <= start:
                at += 1
            if at < len(taken) and taken[at][0] < end:
                continue
            other = replace(key, found)
            if other is not None:
                new.append((start, end, kind, other))
        if new:
            taken = sorted(taken + new)
    if not taken:
        return text, []
    out, spans, at, size = [], [], 0, 0
    for start, end, kind, other in taken:
        out += [text[at:start], other]
        size += start - at
        spans.append((kind, size, len(other)))
        size += len(other)
        at = end
    out.append(text[at:])
    return "".join(out), spans


def pseudonymise_documents(docs: DataFrame, key: bytes | None = None) -> DataFrame:
    """(doc_id, text, n_found, kinds): whole texts, one pass, nothing shuffled.

    `kinds` lists the findings as kind:start:length in the new text, in order. `key`
    is that of the session unless given.
    """
    key = key or session_key(docs.sparkSession)

    def run(ids: list, texts: list) -> list[list]:
        done = [(None, []) if t is None else pseudonymise(t, key) for t in texts]
        return [
            ids, [t for t, _ in done], [len(s) for _, s in done],
            [[f"{k}:{a}:{n}" for k, a, n in s] for _, s in done],
        ]

    return map_columns(
        docs.select("doc_id", "text"),
        "doc_id long, text string, n_found int, kinds array<string>",
        run,
    )


def replace_texts(docs: DataFrame, key: bytes | None = None) -> DataFrame:
    """The same table with pseudonymised texts; every other column as it is. `key` is
    that of the session unless given."""
    key = key or session_key(docs.sparkSession)
    kind = docs.schema["text"].dataType
    place = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            texts = [
                None if t is None else pseudonymise(t, key)[0]
                for t in batch.column(place).to_pylist()
            ]
            columns = list(batch.columns)
            columns[place] = pa.array(texts, batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return map_arrow(docs, run, docs.schema).withColumn("text", F.col("text").cast(kind))
