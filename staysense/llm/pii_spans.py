"""Personal data (operator 11): patterns propose spans, checksums confirm them, words nearby adjust the score.

Every kind has a pattern that proposes, a check that refuses or confirms (Luhn for cards, mod-97 for
bank accounts, mod-11 for health numbers, ranges and calendars for the others) and a score.
A confirmed span gains ``CONFIRMED``, words of the kind within ``BEFORE`` code points in front or ``AFTER``
behind gain ``NEARBY``, words that speak against it (version, invoice, ...) lose as much.  The base kinds (email, ip,
card, phone) are always kept if their check passes; the others from a score of ``KEEP``, where no base span is.  Of
added spans that overlap, the one of higher score stays, on ties the earlier, then the one listed first.

The patterns run in Arrow batches: Python's engine is not recursive, and every pattern here passes over
a text in time proportional to its length (an address is looked for around its ``@``, an ip in whole chains
of numbers and dots).  The added kinds all hold digits and are looked for only within ``MARGIN`` code points of one.
No shuffle; a lost task reads its rows again.

Defined results: a null text is an empty text and has no spans; repeated rows give repeated results, other
columns are ignored, an empty table gives an empty result.  Places are code points, the end exclusive.
"""

from __future__ import annotations

import ipaddress
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import date

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
CONFIRMED, NEARBY, KEEP = 0.3, 0.3, 0.5
BEFORE, AFTER, MARGIN = 48, 24, 48
AGAINST = frozenset("version versions release build invoice order article isbn issn serial part port".split())

_EMAIL_REST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_CHAIN = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]++")
_WORD = re.compile(r"[^\W\d_]+")


# ------------------------------------------------------------------ checksums
def luhn(digits: str) -> bool:
    """Every second digit from the right counts double, less nine if above nine; the sum ends in zero."""
    odd, even = digits[::-1][::2], digits[::-1][1::2]
    return (sum(map(int, odd)) + sum(2 * d - 9 * (d > 4) for d in map(int, even))) % 10 == 0


def mod97(account: str) -> bool:
    """The first four characters behind the rest, letters as 10 to 35: one more than a multiple of 97."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def mod11(digits: str) -> bool:
    """Ten digits, weights 10 down to 1: a multiple of eleven."""
    return sum(w * int(d) for w, d in zip(range(10, 0, -1), digits)) % 11 == 0


def _plain(s: str) -> str:
    return "".join(c for c in s if c.isascii() and c.isalnum())


def _is_date(s: str) -> bool:
    a, b, c = (int(x) for x in re.split(r"[./-]", s))
    for y, m, d in ((a, b, c), (c, b, a), (c, a, b)):
        try:
            if 1900 <= date(y, m, d).year <= 2100:
                return True
        except ValueError:
            continue
    return False


def _is_ipv6(s: str) -> bool:
    try:
        ipaddress.IPv6Address(s)
    except ValueError:
        return False
    return sum(1 for g in s.split(":") if g) >= 4 and any(c.isdigit() for c in s)


# ------------------------------------------------------------------ base kinds
def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, from their ``@``."""
    done, at = 0, text.find("@")
    while at >= 0:
        rest = _EMAIL_REST.match(text, at)
        if rest:
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                yield start, rest.end()
                done = rest.end()
        at = text.find("@", at + 1)


def ips(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of four numbers joined by dots, each at most 255: fours of a chain, in order."""
    for chain in _CHAIN.finditer(text):
        parts = chain.group().split(".")
        start = chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(x := p.lstrip("0")) < 4 and int(x or 0) <= 255 for p in four):
                yield start, end
            start = end + 1


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 8 <= sum(c in "0123456789" for c in m.group()) <= 15:
            yield m.span()


_BASE_FINDERS = {"email": emails, "ip": ips, "card": cards, "phone": phones}
_BASE_WORDS = {"email": "mail email e-mail contact courriel adresse correo", "ip": "ip host address server adresse",
               "card": "card visa mastercard amex credit debit karte carte tarjeta",
               "phone": "phone tel telephone call mobile fax cell telefon handy téléphone teléfono móvil"}
_BASE_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.5, "phone": 0.6}
_BASE_CHECKED = {"card"}


# ------------------------------------------------------------------ added kinds
@dataclass(frozen=True)
class Kind:
    """``least``: score without check or words; ``check`` refuses what it does not confirm; ``sure``: it confirms."""

    name: str
    pattern: str
    least: float
    words: str
    check: Callable[[str], bool] | None = None
    sure: bool = False


def _short_card(s: str) -> bool:
    d = _plain(s)
    return 12 <= len(d) <= 15 and luhn(d)


def _local_phone(s: str) -> bool:
    return 7 <= sum(c.isdigit() for c in s) <= 15


KINDS = (
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])", 0.3,
         "iban bank account konto compte cuenta banque", lambda s: mod97(_plain(s)), True),
    Kind("short_card", r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){11,14}(?![\x20-]?[0-9])", 0.1, _BASE_WORDS["card"] + " diners", _short_card, True),
    Kind("ssn", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", 0.3, "ssn social security"),
    Kind("health_number", r"(?<![0-9])[0-9]{3}\x20[0-9]{3}\x20[0-9]{4}(?![0-9])", 0.05, "nhs health patient",
         lambda s: mod11(_plain(s)), True),
    Kind("ipv6", r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])", 0.3, _BASE_WORDS["ip"], _is_ipv6, True),
    Kind("mac", r"(?<![0-9A-Za-z:-])[0-9A-Fa-f]{2}([:-])(?:[0-9A-Fa-f]{2}\1){4}[0-9A-Fa-f]{2}(?![0-9A-Za-z:-])", 0.6, "mac device"),
    Kind("birth_date", r"(?<![0-9./-])(?:[0-9]{1,2}([./-])[0-9]{1,2}\1[0-9]{4}|[0-9]{4}-[0-9]{2}-[0-9]{2})(?![0-9./-])", 0.2,
         "born birth birthday dob geboren geburtsdatum né née naissance nacido nacida nacimiento", _is_date),
    Kind("local_phone", r"(?<![0-9+./-])\(?[0-9]{2,5}\)?(?:[\x20./-][0-9]{2,8}){1,4}(?![0-9])", 0.2, _BASE_WORDS["phone"], _local_phone),
)
_ORDER = {k: i for i, k in enumerate([*BASE, *(k.name for k in KINDS)])}
_COMPILED = [(k, re.compile(k.pattern), frozenset(k.words.split())) for k in KINDS]
_NEAR_BASE = {k: frozenset(w.split()) for k, w in _BASE_WORDS.items()}


def _adjusted(score: float, text: str, start: int, end: int, words: frozenset) -> float:
    near = {*_WORD.findall(text[max(0, start - BEFORE):start].lower()), *_WORD.findall(text[end:end + AFTER].lower())}
    score += NEARBY * (not near.isdisjoint(words)) - NEARBY * (not near.isdisjoint(AGAINST))
    return round(min(1.0, max(0.0, score)), 3)


def _stretches(text: str) -> Iterator[tuple[int, int]]:
    """What lies within ``MARGIN`` of a digit, in stretches that do not touch."""
    low = high = -1
    for m in _DIGITS.finditer(text):
        if m.start() - MARGIN > high:
            if high >= 0:
                yield low, min(high, len(text))
            low = max(0, m.start() - MARGIN)
        high = m.end() + MARGIN
    if high >= 0:
        yield low, min(high, len(text))


def _confirmed(kind: Kind, text: str, start: int, end: int) -> int | None:
    """The end of the longest part from ``start``, cut at blanks, that the check does not refuse."""
    while kind.check and not kind.check(text[start:end]):
        if kind.name != "iban" or (end := text.rfind(" ", start, end)) < start + 15:
            return None
    return end


def find(text: str) -> list[tuple[str, int, int, float, bool]]:
    """(kind, start, end, score, base) of a text, by kind as listed and start."""
    spans = []
    for kind, finder in _BASE_FINDERS.items():
        least = _BASE_SCORE[kind] + CONFIRMED * (kind in _BASE_CHECKED)
        spans += [(kind, s, e, _adjusted(least, text, s, e, _NEAR_BASE[kind]), True) for s, e in finder(text)]
    added = []
    for low, high in _stretches(text):
        for kind, pattern, words in _COMPILED:
            for m in pattern.finditer(text, low, high):
                end = _confirmed(kind, text, m.start(), m.end())
                if end is not None:
                    score = _adjusted(kind.least + CONFIRMED * kind.sure, text, m.start(), end, words)
                    if score >= KEEP:
                        added.append((-score, m.start(), _ORDER[kind.name], end, kind.name))
    if added:
        taken = sorted((s, e) for _, s, e, _, _ in spans)
        spans += _free(sorted(added), taken)
    return sorted(spans, key=lambda x: (_ORDER[x[0]], x[1]))


def _free(added: list[tuple], taken: list[tuple[int, int]]) -> Iterator[tuple[str, int, int, float, bool]]:
    """Added spans, best first, that touch nothing taken; both by marks on a line of places."""
    import bisect
    base_starts, reach = [s for s, _ in taken], []
    for _, e in taken:
        reach.append(max(e, reach[-1] if reach else 0))
    own_starts: list[int] = []
    own_ends: list[int] = []
    for score, start, _, end, kind in added:
        i = bisect.bisect_left(base_starts, end)        # base spans that begin in front of the end
        if i and reach[i - 1] > start:
            continue
        j = bisect.bisect_left(own_starts, end)         # spans taken here do not overlap: the last one reaches farthest
        if j and own_ends[j - 1] > start:
            continue
        own_starts.insert(j, start)
        own_ends.insert(j, end)
        yield kind, start, end, -score, False


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("base", pa.bool_())])
_SHAPE = "spans array<struct<kind:string,start:int,end:int,score:double,base:boolean>>"


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str | None = None) -> DataFrame:
    """doc_id and ``spans`` of each row; with ``mark`` also ``redacted``, the text with ``mark`` and the kind for each span."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    shape = f"doc_id {dict(rows.dtypes)['doc_id']}, {_SHAPE}" + (", redacted string" if mark is not None else "")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):        # few results at a time
                ids, texts = (c.slice(at, 256) for c in batch.columns)
                texts = texts.to_pylist()
                found = [find(t) for t in texts]
                spans = pa.array([[dict(zip(("kind", "start", "end", "score", "base"), x)) for x in spans] for spans in found],
                                 pa.list_(_SPAN))
                more = [pa.array([redacted(t, x, mark) for t, x in zip(texts, found)], pa.string())] if mark is not None else []
                yield pa.RecordBatch.from_arrays([ids, spans, *more], names=["doc_id", "spans", "redacted"][:2 + len(more)])

    return rows.mapInArrow(read, shape)


def redacted(text: str, spans: list[tuple], mark: str) -> str:
    """``text`` with every span replaced; spans that overlap are replaced together, named after the first."""
    out, done = [], 0
    for kind, start, end, *_ in sorted(spans, key=lambda x: (x[1], -x[2])):
        if start >= done:
            out += [text[done:start], f"{mark}{kind}"]
        done = max(done, end)
    return "".join(out) + text[done:]


def spans_text(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))


def digest(scanned: DataFrame) -> DataFrame:
    """Counts of the base kinds, SHA-256 of the base spans, all spans, and how many the method added."""
    def count(kind):
        return F.size(F.filter("spans", lambda x: x["base"] & (x["kind"] == kind))).cast("long")

    base = F.filter("spans", lambda x: x["base"])
    return scanned.select("doc_id", *[count(k).alias(f"n_{k}") for k in BASE], F.sha2(spans_text(base), 256).alias("base_sha256"),
                          spans_text(F.col("spans")).alias("spans"), (F.size("spans") - F.size(base)).cast("long").alias("n_added"))
