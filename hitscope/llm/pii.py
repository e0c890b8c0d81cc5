"""Personal data under format-preserving pseudonyms.

Numbers and dates that pass a check (the Luhn sum, the octets of an address, a
calendar day, ...) are permuted within their format by a keyed Feistel network, so
the pseudonym passes the same check, and equal values get equal pseudonyms in all documents
without any table of values. Separators and length stay. Cards are 13 to 19 digits with a Luhn sum, in one
piece or grouped as on a card; digits in other groups, part of a longer run of groups or without that sum
are left alone. Not covered: IPv6 addresses, names, passwords and keys, numbers of phones without any separator,
dates with one-digit days or months.
"""

import datetime
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from hitscope.llm.common import id_and_text, sliced

_ROUNDS = 8
_EPOCH, _DAYS = datetime.date(1900, 1, 1).toordinal(), datetime.date(2100, 1, 1).toordinal() - datetime.date(1900, 1, 1).toordinal()

#: What may be personal, by kind; groups of digits are validated afterwards.
_FORMS = re.compile(
    r"(?P<email>(?<![\w.+-])[A-Za-z0-9](?:[\w.+-]{0,62}[A-Za-z0-9])?@[A-Za-z0-9](?:[A-Za-z0-9-]{0,62}\.)+[A-Za-z]{2,18}(?![\w-]))"
    r"|(?P<ip>(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d))"
    r"|(?P<date>(?<![\w./-])(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?!(?!T\d)[\w/-]|\.\d))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<phone>(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?![\w-])"
    r"|(?<![\w+])\+\d{1,3}[ .-]\d{2,4}(?:[ .-]\d{2,4}){2,3}(?![\w-])"
    r"|(?<![\w+.-])(?:1[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4}(?![\w-]|\.\d))"
    r"|(?P<iban>(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w))"
    r"|(?P<card>(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-]))",
    re.ASCII,
)
_GROUP = re.compile(r"\w+", re.ASCII)
# How the digits of a card are grouped where they are.
_CARD_GROUPS = ([4, 4, 4, 4], [4, 4, 4, 4, 3], [4, 6, 5], [4, 6, 4])
_FOURS = re.compile(r"\d{4}(?:[ -]\d{4})+", re.ASCII)
_FOUR_BEFORE, _FOUR_BEHIND = re.compile(r"(?<!\d)\d{4}[ -]\Z", re.ASCII), re.compile(r"[ -]\d{4}(?!\d)", re.ASCII)
#: Characters of a run of groups of four beyond which it is a table, not cards.
_LONGEST_RUN = 200


def _round(key: bytes, tweak: bytes, number: int, half: int, size: int) -> int:
    text = b"%b|%d|%d" % (tweak, number, half)
    return int.from_bytes(hashlib.blake2b(text, key=key, digest_size=16).digest(), "big") % size


def permute(value: int, size: int, key: bytes, tweak: bytes, inverse: bool = False) -> int:
    """A keyed permutation of range(size): a Feistel network over a * b >= size, walked until it falls inside."""
    if size < 2:
        return value
    b = int(size**0.5)
    while b * b < size:
        b += 1
    a = -(-size // b)
    while True:
        left, right = divmod(value, b)
        # Halves keep their own moduli: odd rounds move the right one, even ones the left.
        for number in reversed(range(_ROUNDS)) if inverse else range(_ROUNDS):
            sign = -1 if inverse else 1
            if number % 2:
                right = (right + sign * _round(key, tweak, number, left, b)) % b
            else:
                left = (left + sign * _round(key, tweak, number, right, a)) % a
        value = left * b + right
        if value < size:
            return value


def luhn(digits: str) -> int:
    """The digit that completes *digits* to a Luhn sum."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        n = int(digit) * (2 - place % 2)
        total += n - 9 if n > 9 else n
    return -total % 10


def _fill(form: str, digits: str) -> str:
    """*form* with its digits replaced, in order."""
    rest = iter(digits)
    return "".join(next(rest) if c.isdigit() else c for c in form)


def _permuted_digits(digits: str, key: bytes, tweak: bytes, inverse: bool) -> str:
    return str(permute(int(digits), 10 ** len(digits), key, tweak + b"%d" % len(digits), inverse)).zfill(len(digits))


def _iban_check(country: str, rest: str) -> int:
    return 98 - int("".join(str(int(c, 36)) for c in rest + country) + "00") % 97


def _permuted_account(body: str, key: bytes, tweak: bytes, inverse: bool) -> str:
    """Digits and letters are permuted as one number each; their places stay."""
    digits, letters = "".join(c for c in body if c.isdigit()), [c for c in body if not c.isdigit()]
    new_digits = _permuted_digits(digits, key, tweak, inverse) if digits else ""
    number = 0
    for c in letters:
        number = number * 26 + ord(c) - 65
    number = permute(number, 26 ** len(letters), key, tweak + b"a%d" % len(letters), inverse)
    new_letters = []
    for _ in letters:
        number, c = divmod(number, 26)
        new_letters.append(chr(65 + c))
    digit, letter = iter(new_digits), iter(new_letters[::-1])
    return "".join(next(digit) if c.isdigit() else next(letter) for c in body)


def pseudonym(kind: str, value: str, key: bytes, inverse: bool = False) -> str | None:
    """The pseudonym of a value of the given kind, None if the value does not pass its check."""
    tweak = kind.encode()
    digits = "".join(c for c in value if c.isdigit())
    if kind == "email":
        local, _, domain = value.partition("@")
        out = []
        alphabet = "abcdefghijklmnopqrstuvwxyz"
        # Letters and digits are permuted as one number each, so the shape of the address stays.
        letters = [c for c in local if c.isalpha()]
        if not letters and not digits:
            return None
        number = 0
        for c in letters:
            number = number * 26 + alphabet.index(c.lower()) if c.lower() in alphabet else number * 26
        size = 26 ** len(letters)
        number = permute(number, size, key, tweak + b"%d" % len(letters), inverse)
        for _ in letters:
            number, c = divmod(number, 26)
            out.append(alphabet[c])
        own_digits = "".join(c for c in local if c.isdigit())
        own_digits = _permuted_digits(own_digits, key, tweak + b"n", inverse) if own_digits else ""
        new, rest = iter(out[::-1]), iter(own_digits)
        return "".join(next(new) if c.isalpha() else next(rest) if c.isdigit() else c for c in local) + "@" + domain
    if kind == "ip":
        parts = value.split(".")
        if any(int(p) > 255 or len(p) > 1 and p[0] == "0" for p in parts):
            return None
        number = permute(sum(int(p) << 8 * i for i, p in enumerate(reversed(parts))), 1 << 32, key, tweak, inverse)
        return ".".join(str(number >> 8 * i & 255) for i in (3, 2, 1, 0))
    if kind == "date":
        forms = ["%Y%m%d"] if value[4] == "-" else ["%d%m%Y", "%m%d%Y"] if value[2] == "/" else ["%d%m%Y"]
        for form in forms:  # month first only where day first is impossible
            try:
                first = datetime.datetime.strptime(digits, form).date()
                break
            except ValueError:
                continue
        else:
            return None
        date = first.toordinal() - _EPOCH
        if not 0 <= date < _DAYS:
            return None
        new = datetime.date.fromordinal(permute(date, _DAYS, key, tweak, inverse) + _EPOCH)
        while form == "%m%d%Y" and new.day <= 12:  # stay among the dates that are read month first
            new = datetime.date.fromordinal(permute(new.toordinal() - _EPOCH, _DAYS, key, tweak, inverse) + _EPOCH)
        return _fill(value, new.strftime(form))
    if kind == "ssn":
        valid = lambda d: d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"
        if not valid(digits):
            return None
        digits = _permuted_digits(digits, key, tweak, inverse)
        while not valid(digits):
            digits = _permuted_digits(digits, key, tweak, inverse)
        return _fill(value, digits)
    if kind == "phone":
        country = re.match(r"\+(\d{1,3})", value)
        kept = len(country[1]) if country else 0
        if not 7 <= len(digits) - kept <= 12:
            return None
        return _fill(value, digits[:kept] + _permuted_digits(digits[kept:], key, tweak, inverse))
    if kind == "iban":
        body = "".join(c for c in value[4:] if c.isalnum())
        if not 11 <= len(body) <= 30 or int(digits[:2]) != _iban_check(value[:2], body):
            return None
        body = _permuted_account(body, key, tweak + value[:2].encode(), inverse)
        rest = iter(f"{_iban_check(value[:2], body):02d}{body}")
        return value[:2] + "".join(next(rest) if c.isalnum() else c for c in value[2:])
    if kind == "card":
        groups, marks = re.split("[ -]", value), set(re.findall("[ -]", value))
        if len(marks) > 1 or (len(groups) > 1 and [len(g) for g in groups] not in _CARD_GROUPS):
            return None
        if not 13 <= len(digits) <= 19 or int(digits[-1]) != luhn(digits[:-1]):
            return None
        body = _permuted_digits(digits[:-1], key, tweak + b"0", inverse)
        return _fill(value, body + str(luhn(body)))
    raise ValueError(f"unknown kind: {kind}")


def pseudonymise(text: str, key: bytes) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and (kind, start, end) of what they replaced, in characters of *text*."""
    found, out, done = [], [], 0
    for kind, start, stop, new in _found(text, key, 0, len(text)):
        found.append((kind, start, stop))
        out += [text[done:start], new]
        done = stop
    return "".join([*out, text[done:]]), found


def _found(text: str, key: bytes, start: int, stop: int):
    """(kind, start, end, pseudonym) in order, from a stretch of the text.

    A match that fails its check may hold a valid value: its longest valid part
    from group to group is taken, or else the search goes on at its next group.
    """
    while match := _FORMS.search(text, start, stop):
        kind, low, high = match.lastgroup, match.start(), match.end()
        new = pseudonym(kind, match[0], key)
        if new is not None and kind == "card" and _in_longer_run(text, low, high):
            new = None
        if new is None:
            part = _valid_part(kind, match, key) if kind in ("card", "iban") else None
            if part is None:
                groups = _GROUP.finditer(match[0])
                next(groups)
                following = next(groups, None)
                start = low + following.start() if following else high
                continue
            low, high, new = part
            yield from _found(text, key, match.start(), low)
        yield kind, low, high, new
        start = high


def _in_longer_run(text: str, low: int, high: int) -> bool:
    """Whether groups of four digits go on beside those of a card, as in a table of numbers; several cards in a row are none."""
    if not _FOURS.fullmatch(text, low, high):
        return False
    first, last = low, high
    while low - first < _LONGEST_RUN and _FOUR_BEFORE.search(text, max(0, first - 6), first):
        first -= 5
    while last - high < _LONGEST_RUN and _FOUR_BEHIND.match(text, last):
        last += 5
    if (first, last) == (low, high):
        return False
    quads = [re.sub("[ -]", "", text[i : i + 19]) for i in range(first, last, 20)]
    whole = (last - first + 1) % 20 == 0 and (low - first) % 20 == 0 and last - first < _LONGEST_RUN
    return not (whole and all(int(q[-1]) == luhn(q[:-1]) for q in quads))


def _valid_part(kind: str, match: re.Match, key: bytes) -> tuple[int, int, str] | None:
    """The longest part of a match, from group to group, that passes the check of its kind."""
    groups = [g.span() for g in _GROUP.finditer(match[0])]
    if kind == "iban":  # an account begins with its country
        parts = [(groups[0][0], b) for _, b in groups]
    else:
        parts = [(a, b) for i, (a, _) in enumerate(groups) for _, b in groups[i:]]
    for a, b in sorted(parts, key=lambda p: (p[0] - p[1], p[0])):
        if kind == "card" and _in_longer_run(match.string, match.start() + a, match.start() + b):
            continue
        new = pseudonym(kind, match[0][a:b], key)
        if new is not None:
            return match.start() + a, match.start() + b, new
    return None


def pseudonymise_documents(docs: DataFrame, key: bytes) -> DataFrame:
    """``doc_id, n_found, text, spans`` of every row: its whole text with pseudonyms, and what was replaced.

    A NULL text is empty; rows are treated one by one, whatever their id, so
    repeats give repeats. *spans* are (kind, start, end) in characters of the original.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches):
        for batch in sliced(batches, "text"):
            done = [pseudonymise(t, key) for t in batch.column("text").to_pylist()]
            spans = [[dict(zip(("kind", "start", "stop"), s)) for s in found] for _, found in done]
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in spans], pa.int64()),
                    pa.array([t for t, _ in done], pa.string()),
                    pa.array(spans, kind),
                ],
                ["doc_id", "n_found", "text", "spans"],
            )

    schema = "doc_id long, n_found long, text string, spans array<struct<kind:string,start:long,stop:long>>"
    return id_and_text(docs).mapInArrow(run, schema)
