"""Format-preserving pseudonyms for personal numbers, dates, addresses and secrets.

A found value is validated, its variable part becomes one number inside the set of values
of its format, and a keyed Feistel network permutes that set (cycle walking keeps the
result inside). Separators and fixed parts stay, check digits are recomputed, so the text
still holds a valid value of the same kind; equal values have equal pseudonyms in all
documents, different values different ones. Without the key nothing can be turned back;
``restore`` turns pseudonyms back with it.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from array import array
from bisect import bisect_left
from collections.abc import Callable, Iterator
from datetime import date, timedelta
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.llm.common import documents

ROUNDS = 8
#: The session setting with the secret key.
KEY_SETTING = "spark.tickerloom.pii.key"
#: Public, so it hides nothing: for tests and provided tables, where no key is set.
DEMONSTRATION_KEY = b"tickerloom demonstration key"
#: Characters permuted as one number; a longer secret is cut into even blocks.
BLOCK = 128

# Character classes and date bounds of the formats.
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_HEX = "0123456789abcdef"
_FIRST_DAY, _DAYS = date(1900, 1, 1), 73_049          # 1900-01-01 to 2099-12-31
_IBAN_LENGTHS = dict(zip(*[iter(
    "AD 24 AE 23 AL 28 AT 20 AZ 28 BA 20 BE 16 BG 22 BH 22 BR 29 BY 28 CH 21 CR 22 CY 28 CZ 24 DE 22 DK 18 DO 28 EE 20 "
    "EG 29 ES 24 FI 18 FO 18 FR 27 GB 22 GE 22 GI 23 GL 18 GR 27 GT 28 HR 21 HU 28 IE 22 IL 23 IQ 23 IS 26 IT 27 JO 30 "
    "KW 30 KZ 20 LB 28 LC 32 LI 21 LT 20 LU 20 LV 21 LY 25 MC 27 MD 24 ME 22 MK 19 MR 27 MT 31 MU 30 NL 18 NO 15 PK 24 "
    "PL 28 PS 29 PT 25 QA 29 RO 24 RS 22 SA 24 SC 31 SE 24 SI 19 SM 27 ST 25 SV 28 TL 23 TN 24 TR 26 UA 29 VA 22 VG 24 "
    "XK 20".split())] * 2))
# Written months by language; a name of two lists belongs to the first, in both directions.
_MONTH_LISTS = {
    "en": "january february march april may june july august september october november december",
    "en short": "jan feb mar apr may jun jul aug sep oct nov dec",
    "en sept": "- - - - - - - - sept - - -",
    "de": "januar februar märz april mai juni juli august september oktober november dezember",
    "fr": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
    "es": "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre",
}
_MONTHS: dict[str, tuple[str, int]] = {}
for _style, _names in _MONTH_LISTS.items():
    for _number, _name in enumerate(_names.split(), 1):
        if _name != "-":
            _MONTHS.setdefault(_name, (_style, _number))


class Feistel:
    """A keyed permutation of range(size) for every (format, size)."""

    def __init__(self, key: bytes):
        self._key = hashlib.blake2b(key, digest_size=32).digest()

    def permute(self, value: int, size: int, kind: str, inverse: bool = False) -> int:
        if size < 2:
            return value
        half = max(1, ((size - 1).bit_length() + 1) // 2)
        mask = (1 << half) - 1
        while True:
            left, right = value >> half, value & mask
            for n in reversed(range(ROUNDS)) if inverse else range(ROUNDS):
                if inverse:
                    left, right = right ^ self._round(left, n, kind, half, size), left
                else:
                    left, right = right, left ^ self._round(right, n, kind, half, size)
            value = left << half | right
            if value < size:
                return value

    def _round(self, part: int, n: int, kind: str, half: int, size: int) -> int:
        width = (half + 7) // 8
        data = f"{kind}|{size}|{n}|{part:x}".encode()
        digest = hashlib.blake2b(data, digest_size=width, key=self._key).digest()
        return int.from_bytes(digest, "big") & ((1 << half) - 1)


Permute = Callable[[int, int, str], int]


def _refill(shape: str, new: str, member: Callable[[str], bool] = str.isdigit) -> str:
    """``shape`` with its member characters replaced in order; separators stay."""
    fresh = iter(new)
    return "".join(next(fresh) if member(ch) else ch for ch in shape)


def luhn_digit(payload: str) -> str:
    total = 0
    for at, ch in enumerate(reversed(payload)):
        doubled = int(ch) * (2 if at % 2 == 0 else 1)
        total += doubled - 9 if doubled > 9 else doubled
    return str(-total % 10)


def _card(text: str, permute: Permute) -> str | None:
    digits = re.sub(r"\D", "", text)
    if not 13 <= len(digits) <= 19 or digits[0] == "0" or luhn_digit(digits[:-1]) != digits[-1]:
        return None
    # The first digit names the network and stays.
    width = len(digits) - 2
    inner = f"{permute(int(digits[1:-1]), 10 ** width, f'card{digits[0]}'):0{width}}"
    payload = digits[0] + inner
    return _refill(text, payload + luhn_digit(payload))


def _phone(text: str, permute: Permute) -> str | None:
    digits = re.sub(r"\D", "", text)
    lead, own = (digits[:-10], digits[-10:])
    if lead not in ("", "1") or own[0] == "0":
        return None
    own = f"{permute(int(own) - 10 ** 9, 9 * 10 ** 9, 'phone') + 10 ** 9}"
    return _refill(text, lead + own)


def _international(text: str, permute: Permute) -> str | None:
    digits = re.sub(r"\D", "", text)
    if not 9 <= len(digits) <= 15 or digits[0] == "0":
        return None
    width = len(digits) - 2
    return _refill(text, digits[:2] + f"{permute(int(digits[2:]), 10 ** width, 'dialled' + digits[:2]):0{width}}")


def _ssn(text: str, permute: Permute) -> str | None:
    area, group, serial = (int(part) for part in text.split("-"))
    if area in (0, 666) or area >= 900 or group == 0 or serial == 0:
        return None
    areas = area - 1 - (area > 666)
    value = permute((areas * 99 + group - 1) * 9999 + serial - 1, 898 * 99 * 9999, "ssn")
    rest, serial = divmod(value, 9999)
    areas, group = divmod(rest, 99)
    area = areas + 1 + (areas + 1 >= 666)
    return f"{area:03}-{group + 1:02}-{serial + 1:04}"


def _ip(text: str, permute: Permute) -> str | None:
    parts = text.split(".")
    if any(int(part) > 255 or part != str(int(part)) for part in parts):
        return None
    return str(ipaddress.IPv4Address(permute(int(ipaddress.IPv4Address(text)), 1 << 32, "ip")))


def _iban_check(country: str, account: str) -> str:
    spelled = "".join(str(int(ch, 36)) for ch in account + country + "00")
    return f"{98 - int(spelled) % 97:02}"


def _iban(text: str, permute: Permute) -> str | None:
    plain = text.replace(" ", "")
    country, account = plain[:2], plain[4:]
    if _iban_check(country, account) != plain[2:4]:
        return None
    digits = "".join(ch for ch in account if ch.isdigit())
    fresh = f"{permute(int(digits), 10 ** len(digits), 'iban' + country):0{len(digits)}}"
    account = _refill(account, fresh)
    return _refill(text, country + _iban_check(country, account) + account, str.isalnum)


def _email(text: str, permute: Permute) -> str | None:
    local, _, host = text.rpartition("@")
    # Letters of a host say where mail goes; together with the local part they name a person.
    fresh = _by_class(local, permute, lambda shape: f"mail{shape}@{host.lower()}")
    return None if fresh is None else f"{fresh}@{host}"


def _by_class(own: str, permute: Permute, kind: Callable[[str], str]) -> str | None:
    """ASCII letters become letters of the same case, digits digits; other characters stay."""
    classes = [_LETTERS if ch in _LETTERS else _LETTERS.upper() if ch in _LETTERS.upper()
               else "0123456789" if ch in "0123456789" else None for ch in own]
    size, value = 1, 0
    for ch, members in zip(own, classes):
        if members:
            size, value = size * len(members), value * len(members) + members.index(ch)
    if size < 2:
        return None
    shape = "".join("a" if m == _LETTERS else "A" if m == _LETTERS.upper() else "0" if m else ch
                    for ch, m in zip(own, classes))
    value = permute(value, size, kind(shape))
    out = []
    for ch, members in zip(reversed(own), reversed(classes)):
        if members:
            value, at = divmod(value, len(members))
            ch = members[at]
        out.append(ch)
    return "".join(reversed(out))


def _blocks(text: str) -> Iterator[str]:
    """A text of any length in even blocks, so that work stays linear."""
    count = -(-len(text) // BLOCK)
    cuts = [len(text) * n // count for n in range(count + 1)]
    return (text[a:b] for a, b in zip(cuts, cuts[1:]))


def _secret(text: str, permute: Permute) -> str | None:
    lowered = text.lower()
    fresh = "".join(f"{permute(int(block, 16), 16 ** len(block), 'hex'):0{len(block)}x}" for block in _blocks(lowered))
    return fresh.upper() if text != lowered else fresh


def _token(found: re.Match, permute: Permute) -> str | None:
    """An access key: its prefix says whose it is and stays."""
    prefix, own = found["p"], found["own"]
    if not any(ch.isdigit() for ch in own):
        return None             # a hyphenated word
    return prefix + "".join(_by_class(block, permute, lambda shape: f"key{prefix}{shape}") or block
                            for block in _blocks(own))


def _ip6(found: re.Match, permute: Permute) -> str | None:
    """The digits of an address in the form it is written, in letters of one case; fewer than
    four groups name no host."""
    text = found.group()
    if text not in (text.lower(), text.upper()):
        return None
    try:
        ipaddress.IPv6Address(text)
    except ValueError:
        return None
    digits = text.replace(":", "")
    if sum(map(bool, text.split(":"))) < 4:
        return None
    shape = re.sub("[^:]", "x", text)
    fresh = f"{permute(int(digits, 16), 16 ** len(digits), 'ip6' + shape):0{len(digits)}x}"
    return _refill(text, fresh.upper() if any(ch in "ABCDEF" for ch in digits) else fresh, lambda ch: ch != ":")


_WRITTEN = {
    "ymd": re.compile(r"(?P<y>(?:19|20)\d\d)(?P<s>[-/.])(?P<m>\d\d)(?P=s)(?P<d>\d\d)"),
    "dmy": re.compile(r"(?P<d>\d{1,2})(?P<s>[-/.])(?P<m>\d{1,2})(?P=s)(?P<y>(?:19|20)\d\d)"),
}
# Days whose number no month has: only these can be told apart when the month is written first.
_LATE = [n for n in range(_DAYS) if (_FIRST_DAY + timedelta(days=n)).day > 12]


def _date(text: str, permute: Permute) -> str | None:
    """Day first, unless only month first makes a date; a pseudonym is read the same way."""
    for order, pattern in _WRITTEN.items():
        if not (found := pattern.fullmatch(text)):
            continue
        year, month, day = int(found["y"]), int(found["m"]), int(found["d"])
        month_first = order == "dmy" and month > 12
        if month_first:
            month, day = day, month
        try:
            at = (date(year, month, day) - _FIRST_DAY).days
        except ValueError:
            return None
        if month_first:
            at = _LATE[permute(bisect_left(_LATE, at), len(_LATE), "date month first")]
        else:
            at = permute(at, _DAYS, "date")
        fresh = _FIRST_DAY + timedelta(days=at)
        width = 1 if min(len(found["m"]), len(found["d"])) == 1 else 2
        parts = {"y": f"{fresh.year}", "m": f"{fresh.month:0{width}}", "d": f"{fresh.day:0{width}}"}
        shown = order if order == "ymd" else "mdy" if month_first else "dmy"
        return found["s"].join(parts[x] for x in shown)
    return None


@cache
def _written_days(style: str, only: str) -> array:
    """Days whose month the list names; "0" for days with a leading zero, "er" for first days."""
    months = {month for own, month in _MONTHS.values() if own == style}
    days = ((n, _FIRST_DAY + timedelta(days=n)) for n in range(_DAYS))
    return array("i", (n for n, day in days if day.month in months
                       and (not only or day.day < (10 if only == "0" else 2))))


def _ordinal(day: int) -> str:
    return "th" if day in (11, 12, 13) else {1: "st", 2: "nd", 3: "rd"}.get(day % 10, "th")


def _written_date(found: re.Match, permute: Permute) -> str | None:
    """A date with its month as a word: language, case, order and signs stay."""
    name, day, suffix = found["m"], found["d"], found["o"] or ""
    style, month = _MONTHS[name.lower()]
    if suffix and suffix != "er" and suffix.lower() != _ordinal(int(day)):
        return None
    only = "er" if suffix == "er" else "0" if day[0] == "0" else ""
    days = _written_days(style, only)
    try:
        at = bisect_left(days, n := (date(int(found["y"]), month, int(day)) - _FIRST_DAY).days)
    except ValueError:
        return None
    if at == len(days) or days[at] != n:
        return None
    fresh = _FIRST_DAY + timedelta(days=days[permute(at, len(days), f"date {style} {only}")])
    named = next(x for x, place in _MONTHS.items() if place == (style, fresh.month))
    named = named.upper() if name.isupper() else named.capitalize() if name[0].isupper() else named
    shown = f"{fresh.day:02}" if only == "0" else f"{fresh.day}"
    if suffix and suffix != "er":
        suffix = _ordinal(fresh.day).upper() if suffix.isupper() else _ordinal(fresh.day)
    changed = {"m": named, "d": shown, "o": suffix, "y": f"{fresh.year}"}
    out, done = [], found.start()
    for part in sorted((x for x in changed if found[x]), key=found.start):
        out += [found.string[done:found.start(part)], changed[part]]
        done = found.end(part)
    return "".join([*out, found.string[done:found.end()]])


# Tried in this order at every place; a place that one format refuses is offered to the next.
_FORMATS: tuple[tuple[str, str, Callable[[str, Permute], str | None]], ...] = (
    ("date", r"(?:(?:19|20)\d\d([-/.])\d\d\1\d\d|\d{1,2}([-/.])\d{1,2}\2(?:19|20)\d\d)"
     # Another date may follow, as the end of a range.
     r"(?:(?=[/-](?:(?:19|20)\d\d([-/.])\d\d\3\d\d|\d{1,2}([-/.])\d{1,2}\4(?:19|20)\d\d)(?!\d))|(?![\d./-]*\d))", _date),
    ("ip", r"\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)", _ip),
    ("ssn", r"\d{3}-\d{2}-\d{4}(?![-\d])", _ssn),
    ("card", r"\d(?:[ -]?\d){12,18}(?![-\d])", _card),
    ("phone", r"(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![-\d])", _phone),
    ("phone", r"\+[1-9]\d{0,2}(?:[ .()-]{0,2}\d){7,12}(?!\d)", _international),
)
_NUMBERS = tuple((kind, re.compile(pattern), change) for kind, pattern, change in _FORMATS)
# Where a number may begin: not inside a word, a number or an id. A comma parts fields, also
# behind a digit; a point behind a digit does not. Behind a slash, see _in_path.
_STARTS = re.compile(r"(?<![\w+-])(?<!\d\.)[+(]?\d(?=[\d .()/-]{5})")
_ONE_CARD = re.compile(r"\d{13,19}(?!\d)|\d{4}(?:[ -]\d{4}){3}(?!\d)")
_DIGIT = re.compile(r"[0-9]")
_BEHIND = re.compile(r"(?:[ ,;]{1,3}|[/\u2013-])(?=[+(\d])")
_EMAIL = re.compile(r"(?<![\w.+-])[A-Za-z0-9](?:[\w.+-]{0,62}[A-Za-z0-9])?@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![\w-])",
                    re.ASCII)
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_NAMES = "|".join(sorted(_MONTHS, key=len, reverse=True))
_YEAR = r"(?P<y>(?:19|20)\d\d)(?!\d|[.,]\d)"
_WRITTEN_DATES = (
    re.compile(rf"(?<!\w)(?<!\d[./-])(?P<d>\d{{1,2}})(?P<o>st|nd|rd|th|er)?(?:\.? (?:of |de )?|-)(?P<m>{_NAMES})"
               rf"(?:[.,]{{0,2}} (?:del? )?|-){_YEAR}", re.IGNORECASE),
    re.compile(rf"(?<!\w)(?P<m>{_NAMES})\.? (?P<d>\d{{1,2}})(?P<o>st|nd|rd|th)?,? {_YEAR}", re.IGNORECASE),
)
_HEX_SECRET = re.compile(r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)(?![0-9A-Za-z])")
_TOKEN = re.compile(r"(?<![\w-])(?:(?P<p>(?:AKIA|ASIA)(?=[0-9A-Z]{16}(?![\w-]))"
                    r"|(?:sk-|ghp_|gho_|xox[bp]-)(?=[\w-]{20}))(?P<own>[\w-]+))", re.ASCII)
_IP6 = re.compile(r"(?<![\w:.])[0-9A-Fa-f:]{8,}[0-9A-Fa-f](?!\w)")


def _in_path(text: str, slash: int) -> bool:
    """Whether the slash belongs to a path or address, not to "tel/..." or a list."""
    # Back to the nearest sign; an earlier slash ends the search, so slashes share the work.
    for at in range(slash - 1, -1, -1):
        if text[at] in "/.\\":
            return True
        if text[at].isspace():
            break
    return False


class Pseudonymizer:
    """``replace(text)``: the text with pseudonyms, and how many of each kind."""

    def __init__(self, key: bytes, inverse: bool = False):
        feistel = Feistel(key)
        self._permute = lambda value, size, kind: feistel.permute(value, size, kind, inverse)

    def replace(self, text: str) -> tuple[str, dict[str, int]]:
        counts: dict[str, int] = {}
        if "@" in text:
            text = self._sub(_EMAIL, "email", lambda found, permute: _email(found.group(), permute), text, counts)
        if not _DIGIT.search(text):
            return text, counts
        text = self._ibans(text, counts)
        text = self._sub(_TOKEN, "secret", _token, text, counts)
        if "::" in text or text.count(":") >= 7:
            text = self._sub(_IP6, "ip", _ip6, text, counts)
        text = self._sub(_HEX_SECRET, "secret", lambda found, permute: _secret(found.group(), permute), text, counts)
        for pattern in _WRITTEN_DATES:
            text = self._sub(pattern, "date", _written_date, text, counts)
        return self._numbers(text, counts), counts

    def _ibans(self, text: str, counts: dict[str, int]) -> str:
        """A match may hold what follows the account: its country says how long it is."""
        out, done, at = [], 0, 0
        while found := _IBAN.search(text, at):
            own, at = found.group(), found.start() + 4
            places = [n for n, ch in enumerate(own) if ch != " "]
            length = int(_IBAN_LENGTHS.get(own[:2], len(places)))
            if len(places) > length and not own[places[length - 1] + 1].isalnum():
                own = own[:places[length - 1] + 1]
            if (fresh := _iban(own, self._permute)) is not None:
                counts["iban"] = counts.get("iban", 0) + 1
                out += [text[done:found.start()], fresh]
                done = at = found.start() + len(own)
        return "".join([*out, text[done:]])

    def _sub(self, pattern: re.Pattern, kind: str, change, text: str, counts: dict[str, int]) -> str:
        def one(found: re.Match) -> str:
            fresh = change(found, self._permute)
            if fresh is None:
                return found.group()
            counts[kind] = counts.get(kind, 0) + 1
            return fresh

        return pattern.sub(one, text)

    def _numbers(self, text: str, counts: dict[str, int]) -> str:
        out, done, at = [], 0, 0
        while found := _STARTS.search(text, at):
            # A value right behind another one starts at once, whatever stands before it.
            start: int | None = found.start()
            at, first = found.end(), True
            while start is not None:
                end, fresh = self._number_at(text, start, counts, first)
                first = False
                if fresh is None:
                    break
                out += [text[done:start], fresh]
                done = at = end
                behind = _BEHIND.match(text, end)
                start = behind and behind.end()
        return "".join([*out, text[done:]])

    def _number_at(self, text: str, start: int, counts: dict[str, int], first: bool) -> tuple[int, str | None]:
        slash = first and text[start - 1:start] == "/"
        if slash and _in_path(text, start - 1):
            return start, None
        for kind, pattern, change in _NUMBERS:
            match = pattern.match(text, start)
            if match and slash and kind == "date" and ("/" in match.group() or text[start - 2:start - 1].isdigit()):
                continue            # part of a longer row of numbers, or of a path
            fresh = match and change(match.group(), self._permute)
            if kind == "card" and match and fresh is None:
                match, fresh = self._shorter_card(text, match)
            if fresh is not None:
                counts[kind] = counts.get(kind, 0) + 1
                return match.end(), fresh
        return start, None

    def _shorter_card(self, text: str, match: re.Match) -> tuple[re.Match | None, str | None]:
        """Two numbers may follow each other: also try the first group of unbroken digits."""
        alone = _ONE_CARD.match(text, match.start())
        if alone and alone.end() < match.end():
            return alone, _card(alone.group(), self._permute)
        return None, None


def session_key(spark: SparkSession) -> bytes:
    """The key of this session (``spark.tickerloom.pii.key``). Where none is set it is the public
    demonstration key: texts then have pseudonyms that anyone can turn back."""
    given = spark.conf.get(KEY_SETTING, None)
    return given.encode() if given else DEMONSTRATION_KEY


def pseudonymize(docs: DataFrame, key: bytes,
                 carry: tuple[str, ...] = (), inverse: bool = False) -> DataFrame:
    """(doc_id, text, found, carry...): every text with its personal values replaced.

    ``found`` maps kinds to how many values were replaced. A NULL text becomes empty; rows
    are independent, so repeats and ties change nothing.
    """

    def change(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = Pseudonymizer(key, inverse)
        for batch in stream:
            texts, found = [], []
            for value in batch.column(1):
                text, counts = worker.replace(value.as_py())
                texts.append(text)
                found.append(list(counts.items()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, batch.column(1).type),
                 pa.array(found, pa.map_(pa.string(), pa.int32())), *batch.columns[2:]],
                names=["doc_id", "text", "found", *carry])

    kept = documents(docs, *carry)
    schema = kept.select("doc_id", "text").withColumn(
        "found", F.lit(None).cast("map<string,int>")).schema
    for name in carry:
        schema = schema.add(kept.schema[name])
    return kept.mapInArrow(change, schema)


def restore(docs: DataFrame, key: bytes) -> DataFrame:
    """Pseudonyms turned back, given the key."""
    return pseudonymize(docs, key, inverse=True)
