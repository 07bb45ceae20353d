"""Pseudonyms of the same format for personal numbers, dates and mail names.

A value is found by a pattern, validated (check digits, calendar, ranges), taken as a
number within its format, and moved by a keyed permutation of all such numbers: a Feistel
network over the next even number of bits, walked on until it is back in the range. Equal
values get equal pseudonyms in all documents, whatever signs stand between their digits;
different values never get the same; and whoever has the key can go back.

A date is moved among those of the same two centuries whose day and month lie in the same
classes (`DAYS`, `MONTHS`), so it can be written with as many digits and in the same order
as the original, however that was written, and is read the same way again. The smallest
class of a block of years holds 1,800 dates.
"""

import datetime
import hashlib
import re

import pyarrow as pa
from pyspark.sql import functions as F

from pricetide.llm.shipping import map_batches

ROUNDS = 10
ROWS_AT_ONCE = 500
#: Days of one digit, those that can be months as well, and those that cannot; months by their digits.
DAYS, MONTHS = (range(1, 10), range(10, 13), range(13, 32)), (range(1, 10), range(10, 13))
#: A date stays within its block of years, of which one begins with 1900.
YEARS, FIRST_YEAR = 200, 1900
_SOURCES = {
    "email": r"(?<![\w.+-])[\w.+-]+(?=@[\w-]+(?:\.[\w-]+)+)",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "ip": r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\w|\.\d)",
    "date": r"(?<![\w.])(?:\d{4}-\d{2}-\d{2}|\d{1,2}(?P<sep>[./-])\d{1,2}(?P=sep)\d{4})(?!(?!T\d)\w)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": r"(?<![\w.])(?:\+1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[. -])\d{3}[. -]\d{4}(?!\w)",
    "card": r"(?<![\w.])\d(?:[ -]?\d){12,18}(?!\w)",
}
PATTERN = re.compile("|".join(f"(?P<{kind}>{source})" for kind, source in _SOURCES.items()))
PATTERNS = {kind: re.compile(source) for kind, source in _SOURCES.items()}
_GROUP = re.compile(r"\w+")
_DIGIT_GROUPS = re.compile(r"\d+(?:[ -]\d+)*(?!\w)")
CARD_DIGITS = range(13, 20)
_WORTH_A_LOOK = re.compile(r"\d|@")


class Permutation:
    """A keyed permutation of the numbers from 0 to size - 1."""

    def __init__(self, key, kind, size):
        self.size = size
        self.half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
        self.mask = (1 << self.half) - 1
        self.key = hashlib.blake2b(f"{kind}:{size}".encode(), key=hashlib.sha256(key).digest(), digest_size=32).digest()

    def _round(self, number, value):
        data = number.to_bytes(1, "big") + value.to_bytes((self.half + 7) // 8, "big")
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=32).digest(), "big") & self.mask

    def __call__(self, value):
        while True:
            left, right = value >> self.half, value & self.mask
            for number in range(ROUNDS):
                left, right = right, left ^ self._round(number, right)
            value = left << self.half | right
            if value < self.size:
                return value

    def back(self, value):
        while True:
            left, right = value >> self.half, value & self.mask
            for number in reversed(range(ROUNDS)):
                left, right = right ^ self._round(number, left), left
            value = left << self.half | right
            if value < self.size:
                return value


def luhn_digit(digits):
    """The check digit that belongs behind `digits`."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        doubled = int(digit) * (2 if place % 2 == 0 else 1)
        total += doubled - 9 * (doubled > 9)
    return str(-total % 10)


def iban_check(country, account):
    """The two check digits of an account number."""
    text = account + country + "00"
    return f"{98 - int(''.join(str(int(c, 36)) for c in text)) % 97:02d}"


def is_date(year, month, day):
    try:
        datetime.date(year, month, day)
    except ValueError:
        return False
    return True


def like(template, signs, kinds=str.isalnum):
    """`template` with its signs of a kind replaced by `signs` in order."""
    signs = iter(signs)
    return "".join(next(signs) if kinds(c) else c for c in template)


def card_spans(text, match, end):
    """("card", start, stop) of what may be a card number among the groups of digits from a match on.

    One group alone comes first, then groups of four digits or more but for the last, last
    the match as it is. Groups begin among the match's own; a number begins and ends with one.
    """
    run = _DIGIT_GROUPS.match(text, match.start(), min(end, match.end() + 2 * CARD_DIGITS.stop))
    groups = [g.span() for g in _GROUP.finditer(text, match.start(), max(match.end(), run.end() if run else 0))]
    many = []
    for i, (start, stop) in enumerate(groups):
        if start >= match.end():
            break
        digits = 0
        for a, b in groups[i:]:
            digits += b - a
            if digits in CARD_DIGITS:
                if a == start:
                    yield "card", start, stop
                else:
                    many.append((start, b))
            if digits >= CARD_DIGITS.stop or b - a < 4:
                break
    yield from (("card", start, stop) for start, stop in sorted(many, key=lambda x: (x[0], -x[1])))
    yield "card", match.start(), match.end()


class Pseudonyms:
    """Finds values in texts and replaces them; `back` undoes it."""

    def __init__(self, key, kinds=("email", "iban", "ip", "date", "ssn", "phone", "card"), undo=False):
        self.key, self.kinds, self.undo, self.permutations = key, set(kinds), undo, {}

    def move(self, kind, size, value):
        known = self.permutations.get((kind, size))
        if known is None:
            known = self.permutations[kind, size] = Permutation(self.key, kind, size)
        return known.back(value) if self.undo else known(value)

    def email(self, text):
        """Letters and digits of the name before the @; case and other signs stay."""
        size, value, radixes = 1, 0, []
        for c in text:
            if c.isascii() and c.isalnum():
                radix = 10 if c.isdigit() else 26
                radixes.append((radix, c))
                value, size = value * radix + (int(c) if radix == 10 else ord(c.lower()) - 97), size * radix
        if not radixes:
            return None
        shape = "".join("9" if r == 10 else "a" for r, _ in radixes)
        value, out = self.move("email" + shape, size, value), []
        for radix, c in reversed(radixes):
            value, digit = divmod(value, radix)
            sign = str(digit) if radix == 10 else chr(97 + digit)
            out.append(sign.upper() if c.isupper() else sign)
        return like(text, reversed(out), lambda c: c.isascii() and c.isalnum())

    def iban(self, text):
        plain = text.replace(" ", "")
        country, check, account = plain[:2], plain[2:4], plain[4:]
        if not 15 <= len(plain) <= 34 or iban_check(country, account) != check:
            return None
        size, value = 1, 0
        for c in account:
            radix = 10 if c.isdigit() else 26
            value, size = value * radix + (int(c) if radix == 10 else ord(c) - 65), size * radix
        shape = "".join("9" if c.isdigit() else "A" for c in account)
        value, out = self.move("iban" + country + shape, size, value), []
        for c in reversed(shape):
            value, digit = divmod(value, 10 if c == "9" else 26)
            out.append(str(digit) if c == "9" else chr(65 + digit))
        account = "".join(reversed(out))
        return like(text, country + iban_check(country, account) + account)

    def ip(self, text):
        parts = [int(p) for p in text.split(".")]
        if max(parts) > 255 or any(len(p) > 1 and p[0] == "0" for p in text.split(".")):
            return None
        value = self.move("ip", 1 << 32, int.from_bytes(bytes(parts), "big"))
        return ".".join(map(str, value.to_bytes(4, "big")))

    def date(self, text):
        """The date in the order and with the zeros of the original."""
        parts = re.split(r"\D", text)
        order = "ymd" if len(parts[0]) == 4 else "dmy"
        if "/" in text and int(parts[0]) <= 12 < int(parts[1]):
            order = "mdy"  # only so is it a date at all
        found = dict(zip(order, map(int, parts)))
        made = self.moved_date(found["y"], found["m"], found["d"])
        if made is None:
            return None
        return like(text, "".join(f"{made[c]:0{len(part)}d}" for c, part in zip(order, parts)), str.isdigit)

    def moved_date(self, year, month, day):
        """{"y", "m", "d"} of the pseudonym, None where there is no such date.

        The permutation is of all triples of the classes and is walked on until a triple is in the calendar.
        """
        if not is_date(year, month, day):
            return None
        block = (year - FIRST_YEAR) // YEARS
        first = FIRST_YEAR + block * YEARS
        days = next(r for r in DAYS if day in r)
        months = next(r for r in MONTHS if month in r)
        value = ((year - first) * len(months) + months.index(month)) * len(days) + days.index(day)
        kind = f"date {block} {months[0]} {days[0]}"
        while True:
            value = self.move(kind, YEARS * len(months) * len(days), value)
            rest, day = divmod(value, len(days))
            year, month = divmod(rest, len(months))
            made = {"y": first + year, "m": months[month], "d": days[day]}
            if is_date(made["y"], made["m"], made["d"]):
                return made

    def ssn(self, text):
        area, group, serial = (int(p) for p in text.split("-"))
        if area in (0, 666) or area >= 900 or not group or not serial:
            return None
        areas = 898  # 1 to 899 without 666
        value = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
        value, serial = divmod(self.move("ssn", areas * 99 * 9999, value), 9999)
        area, group = divmod(value, 99)
        return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"

    def phone(self, text):
        digits = "".join(c for c in text if c.isdigit())
        country, digits = digits[:-10], digits[-10:]
        if digits[0] < "2" or digits[3] < "2":
            return None
        area, rest = divmod(int(digits), 10**7)
        value = (area - 200) * 8 * 10**6 + rest - 2 * 10**6
        area, rest = divmod(self.move("phone", 800 * 8 * 10**6, value), 8 * 10**6)
        made = f"{area + 200:03d}{rest + 2 * 10**6:07d}"
        return like(text, country + made, str.isdigit)

    def card(self, text):
        digits = "".join(c for c in text if c.isdigit())
        if luhn_digit(digits[:-1]) != digits[-1] or not int(digits):
            return None
        body = f"{self.move('card', 10 ** (len(digits) - 1), int(digits[:-1])):0{len(digits) - 1}d}"
        return like(text, body + luhn_digit(body), str.isdigit)

    def values(self, text, at, end):
        """(kind, start, stop, pseudonym) of the values between two places, in their order.

        Where nothing that begins with a match is valid, the search goes on behind its first
        group of signs, so a value beside other numbers or words is found too.
        """
        while match := PATTERN.search(text, at, end):
            at = max(match.start() + 1, getattr(_GROUP.match(text, match.start(), match.end()), "end", int)())
            first = match.lastgroup if match.lastgroup != "sep" else "date"
            for value in self.spans(text, match, first, end):
                kind, start, stop = value
                made = getattr(self, kind)(text[start:stop]) if kind in self.kinds else None
                if made is not None:
                    yield from self.values(text, match.start(), start)
                    yield kind, start, stop, made
                    at = stop
                    break

    def spans(self, text, match, first, end):
        """(kind, start, stop) of what may be a value at a match, the likeliest first."""
        kinds = list(_SOURCES)
        for kind in kinds[kinds.index(first) :]:
            found = match if kind == first else PATTERNS[kind].match(text, match.start(), end)
            if found and kind == "card":
                yield from card_spans(text, found, end)
            elif found:
                yield kind, found.start(), found.end()
                if kind == "iban":
                    for group in reversed(list(_GROUP.finditer(text, found.start(), found.end()))[:-1]):
                        yield kind, found.start(), group.end()

    def replace(self, text):
        """(text with pseudonyms, [(kind, first sign, value, pseudonym)])."""
        if not text or not _WORTH_A_LOOK.search(text):
            return text, []
        found, out, end = [], [], 0
        for kind, start, stop, made in self.values(text, 0, len(text)):
            out += [text[end:start], made]
            end = stop
            found.append((kind, start, text[start:stop], made))
        return ("".join(out) + text[end:] if found else text), found


SCHEMA = "doc_id long, text string, values array<struct<kind: string, start: int, pseudonym: string>>"
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text", pa.string()),
        ("values", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("pseudonym", pa.string())]))),
    ]
)


def pseudonymised(docs, secret, text="text", key="doc_id", undo=False):
    """Every row of `docs` with its personal values replaced: doc_id, text, values.

    `values` names the kind, the place in the original text (in code points) and the
    pseudonym of each. Found are mail names, IBANs, IPv4 addresses, dates of the years 1
    to 9999, social security, North American telephone and payment card numbers; what does
    not validate stays as it is. With `undo` and the same secret the originals come back,
    unless signs beside a pseudonym happen to make another valid number with it.

    A null text stays null, an empty one empty. Rows with a repeated or null id are treated
    like others; extra columns are not looked at. No rows give no rows.
    """

    def run(batches):
        names = Pseudonyms(secret, undo=undo)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                done = [names.replace(x) for x in part.column(1).to_pylist()]
                values = [[{"kind": k, "start": s, "pseudonym": p} for k, s, _, p in found] for _, found in done]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([x for x, _ in done], pa.string()), pa.array(values, _ARROW.field(2).type)],
                    schema=_ARROW,
                )

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_batches(rows, run, SCHEMA)
