"""Personal data by anchor expansion.

One Aho-Corasick automaton finds anchors: at-signs, schemes, identifier cues, and the
short digit patterns every number of interest contains.  From an anchor a local parser of its
kind expands the boundaries left and right and validates what it finds.  Each parser
remembers where its last match ended, so a text is read once however many anchors it has.

Base kinds, leftmost and non-overlapping, a match that fails its check dropped:
``email``; ``ip`` (four parts of at most 255); ``card`` (14 to 19 digits passing Luhn);
``phone`` (a plus sign and 10 to 15 digits).  The method adds, where no base span lies:

* email: addresses with letters outside ASCII, and written out with (at) or [at], (dot) or [dot];
* ip: version 6 addresses with a double colon;
* phone: 7 to 15 digits after ``tel:`` or a cue word;
* account: after a cue word, an IBAN with a right remainder, or a number of 6 to 20 digits.

Positions are code points, ends exclusive.  Null text counts as empty and has no spans.  Whole texts are
read, whatever their length; repeated rows each give their spans; an empty table gives an empty
result.  Other columns pass through; those named like a new one are replaced.
"""

from __future__ import annotations

import functools
import ipaddress
import itertools
import re
from collections.abc import Iterable

import ahocorasick
from pyspark.sql import DataFrame

from meteora.llm.common import with_text_columns

# Fixed values.
KINDS = ("email", "ip", "card", "phone", "account")
BASE_KINDS = KINDS[:4]
PHONE_CUES = ("phone", "telephone", "tel", "mobile", "fax", "téléphone", "teléfono", "telefon")
ACCOUNT_CUES = ("account", "acct", "a/c", "iban", "konto", "compte", "cuenta")
AT_SIGNS = ("(at)", "[at]")
DIGITS = "0123456789"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE_RUN = re.compile(r"[ ().0-9-]+")
_WIDE_DOMAIN = re.compile(r"[^\W_](?:[\w-]*[^\W_])?(?:\.[^\W_](?:[\w-]*[^\W_])?)*\.[^\W\d_]{2,}")
_SPELT_DOMAIN = re.compile(r" ?[A-Za-z0-9-]+(?: ?(?:\(dot\)|\[dot\]|\.) ?[A-Za-z0-9-]+)+")
_HEX_END = re.compile(r"[0-9A-Fa-f:.]*")
_CUE_GAP = re.compile(r"(?: ?(?:number|no|nr|num|#))?[ .:#=-]{0,4}")
_LOCAL_PHONE = re.compile(r"[+(]?[0-9](?:[ ().0-9/-]{0,28}[0-9])?")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){10,30}")
_NUMBER = re.compile(r"[0-9](?:[ -]?[0-9]){5,19}(?![0-9])")


def luhn(digits: str) -> bool:
    """Every second digit from the right doubled, its digits added: the sum ends in 0."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def iban(text: str) -> bool:
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _anchors() -> Iterable[tuple[str, str]]:
    yield "@", "email"
    for a, b in itertools.product(DIGITS, DIGITS):
        yield f"{a}.{b}", "ip"
        for gap in ("", " ", "-"):
            yield f"{a}{gap}{b}", "card"
    for a in DIGITS:
        yield f"+{a}", "phone"
    yield "::", "ip6"
    for kind, cues in (("spelt", AT_SIGNS), ("phone cue", PHONE_CUES), ("account cue", ACCOUNT_CUES)):
        for cue in cues:
            for form in {cue, cue.upper(), cue.capitalize()}:
                yield form, kind
    yield "tel:", "scheme"


@functools.lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for text, kind in _anchors():
        found.add_word(text, (len(text), kind))
    found.make_automaton()
    return found


class _Reader:
    """The parsers over one text; ``done`` holds where each kind's last match ended."""

    def __init__(self, text: str):
        self.text = text
        self.done = dict.fromkeys(("email", "ip", "card", "phone", "ip6"), 0)
        self.base: list[tuple[int, int, int]] = []  # start, kind's number, end
        self.more: list[tuple[int, int, int]] = []

    def _keep(self, kind: str, start: int, end: int, base: bool = True) -> None:
        (self.base if base else self.more).append((start, KINDS.index(kind), end))

    # base kinds
    def email(self, at: int) -> None:
        text, start, least = self.text, at, self.done["email"]
        while start > least and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            self._keep("email", start, m.end())
            self.done["email"] = m.end()
        else:
            self.wide_email(at)

    def ip(self, at: int) -> None:
        if at < self.done["ip"]:
            return
        text, start = self.text, at
        while start > self.done["ip"] and text[start - 1] in DIGITS:
            start -= 1
        m = _NUMBERS.match(text, start)
        self.done["ip"] = m.end()
        parts, where = m.group().split("."), start
        for i in range(0, len(parts) - 3, 4):
            four = parts[i: i + 4]
            size = sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in four):
                self._keep("ip", where, where + size)
            where += size + 1

    def card(self, at: int) -> None:
        if at < self.done["card"]:
            return
        m = _CARD.match(self.text, at)
        self.done["card"] = m.end()
        # 19 digits have at most 18 separators
        if m.end() - at <= 37:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                self._keep("card", at, m.end())

    def phone(self, at: int) -> None:
        m = _PHONE_RUN.match(self.text, at + 2)
        if not m:
            return
        run = m.group()
        last = len(run.rstrip(" ().-")) - 1
        if last < 1:
            return
        if 10 <= 1 + sum(c in DIGITS for c in run) <= 15:
            self._keep("phone", at, at + 3 + last)

    # what the method adds
    def wide_email(self, at: int) -> None:
        text, start = self.text, at
        least = max(self.done["email"], at - 64)
        while start > least and (text[start - 1] in _LOCAL or text[start - 1].isalnum()):
            start -= 1
        m = _WIDE_DOMAIN.match(text, at + 1, at + 254) if start < at else None
        if m and not m.group().isascii():
            self._keep("email", start, m.end(), base=False)

    def spelt(self, at: int, size: int) -> None:
        text, to = self.text, at
        if to and text[to - 1] == " ":
            to -= 1
        start = to
        while start > max(0, to - 64) and text[start - 1] in _LOCAL:
            start -= 1
        m = _SPELT_DOMAIN.match(text, at + size, at + size + 254) if start < to else None
        if m:
            self._keep("email", start, m.end(), base=False)

    def ip6(self, at: int) -> None:
        text, start, least = self.text, at, max(self.done["ip6"], at - 40)
        if at < least:
            return
        while start > least and (text[start - 1] in "0123456789abcdefABCDEF:"):
            start -= 1
        end = self.done["ip6"] = _HEX_END.match(text, at, at + 42).end()
        if (start and text[start - 1].isalnum()) or text[end: end + 1].isalnum():
            return
        value = text[start:end].rstrip(".")
        try:
            address = ipaddress.IPv6Address(value)
        except ValueError:
            return
        if address.packed.count(0) < 14:  # more than one group is set
            self._keep("ip", start, start + len(value), base=False)

    def after_cue(self, kind: str, at: int, size: int, scheme: bool = False) -> None:
        text, end = self.text, at + size
        if at and text[at - 1].isalnum():
            return
        if not scheme:
            gap = _CUE_GAP.match(text, end, end + 16)
            if gap.end() == end:
                return
            end = gap.end()
        if kind == "account":
            m = _IBAN.match(text, end)
            while m and not iban(m.group()):  # a longer run of capitals and digits than the number
                cut = m.end() - 1
                m = _IBAN.match(text, end, cut) if cut > end else None
            m = m or _NUMBER.match(text, end)
            if m:
                self._keep("account", end, m.end(), base=False)
            return
        m = _LOCAL_PHONE.match(text, end)
        if m and 7 <= sum(c in DIGITS for c in m.group()) <= 15:
            self._keep("phone", end, m.end(), base=False)

    def read(self) -> None:
        parsers = {"email": self.email, "ip": self.ip, "card": self.card, "phone": self.phone, "ip6": self.ip6}
        for end, (size, kind) in _automaton().iter(self.text):
            at = end + 1 - size
            if kind in parsers:
                parsers[kind](at)
            elif kind == "spelt":
                self.spelt(at, size)
            else:
                self.after_cue("account" if kind == "account cue" else "phone", at, size, kind == "scheme")

    def spans(self) -> tuple[list, list]:
        """Base spans, and all spans: an added one must not touch another."""
        self.base.sort()
        every = list(self.base)
        if self.more:
            ends, reach = [], 0
            for s, _, e in self.base:
                reach = max(reach, e)
                ends.append((s, reach))
            i, last, before = 0, 0, 0
            for start, kind, end in sorted(set(self.more), key=lambda x: (x[0], -x[2], x[1])):
                while i < len(ends) and ends[i][0] < end:
                    before = ends[i][1]
                    i += 1
                if start >= last and before <= start:
                    every.append((start, kind, end))
                    last = end
            every.sort()
        return self.base, every


def find(text: str) -> tuple[list, list]:
    """Base spans and all spans of one text, each as (start, kind's number, end), in order."""
    reader = _Reader(text)
    reader.read()
    return reader.spans()


def _joined(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def masked(text: str, spans: list) -> str:
    """``text`` with every span replaced by its kind in angle brackets; of overlapping ones the first."""
    out, at = [], 0
    for s, k, e in spans:
        if s >= at:
            out += [text[at:s], f"<{KINDS[k]}>"]
        at = max(at, e)
    return "".join([*out, text[at:]])


FIELDS = [*((f"n_{k}", "bigint") for k in BASE_KINDS), ("base_spans", "string"), ("spans", "string")]


def with_spans(docs: DataFrame, keep_text: bool = True, mask: bool = False) -> DataFrame:
    """``docs`` with the counts of base spans, ``base_spans`` and ``spans`` (kind:start:end, comma-joined), and
    with ``mask`` the ``masked`` text."""
    def make():
        def f(texts):
            strings = texts.to_pylist()
            found = [find(t) for t in strings]
            counts = [[sum(k == i for _, k, _ in base) for base, _ in found] for i in range(len(BASE_KINDS))]
            out = [*counts, [_joined(base) for base, _ in found], [_joined(every) for _, every in found]]
            return [*out, [masked(t, every) for t, (_, every) in zip(strings, found, strict=True)]] if mask else out
        return f
    return with_text_columns(docs, FIELDS + ([("masked", "string")] if mask else []), make, keep_text=keep_text)
