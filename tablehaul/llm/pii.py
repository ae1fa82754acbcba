"""Personal data in texts, also where it is disguised, with offsets of the source text.

Patterns find e-mail addresses, IP addresses, card and phone numbers. Then transducers rewrite
the text: look-alike and full-width characters become ASCII, invisible ones vanish, decimal digits of any script and spelled
digits become digits, and disguised "at" and "dot" (words or signs, in brackets, between underscores or
spaced out) become their signs. Each rewritten character
remembers the source characters it stands for, so what the patterns find in the rewritten text
is mapped back to spans of the source. Only spans whose text was rewritten are added.

All searches take time in proportion to the text. Defined results: a null text counts as empty
and has no spans. Texts of any length are searched whole. Offsets are code points, ends
exclusive; spans are ordered by start, then by kind as in KINDS, then by end. Rows are searched
each for itself, so repeated rows get equal spans; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.common import id_and_text, map_texts

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3,}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def emails(text: str) -> list[tuple[int, int]]:
    """``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, searched from each @."""
    out, free = [], 0
    if "@" not in text:
        return out
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            out.append((start, m.end()))
            free = m.end()
    return out


def ips(text: str) -> list[tuple[int, int]]:
    """Four dotted numbers, taken in fours from each chain of numbers; each at most 255."""
    out = []
    for m in _NUMBERS.finditer(text):
        at, parts = m.start(), m[0].split(".")
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in four):
                out.append((at, end))
            at = end + 1
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def cards(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append(m.span())
    return out


def phones(text: str) -> list[tuple[int, int]]:
    if "+" not in text:
        return []
    return [m.span() for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m[0])) <= 15]


FINDERS = {"email": emails, "ip": ips, "card": cards, "phone": phones}


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the patterns in the text as it is, ordered."""
    if not _DIGIT.search(text) and "@" not in text:
        return []
    return _ordered((kind, s, e) for kind, find in FINDERS.items() for s, e in find(text))


def _ordered(spans) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


# ---- rewriting with offsets -----------------------------------------------------------


@dataclass(frozen=True)
class Mapped:
    """A rewritten text; character i stands for the source characters start[i] to end[i]."""

    text: str
    start: list[int]
    end: list[int]

    @classmethod
    def of(cls, text: str) -> Mapped:
        return cls(text, list(range(len(text))), list(range(1, len(text) + 1)))

    def rewritten(self, pattern: re.Pattern, replace) -> Mapped:
        """Replace each match by ``replace(match)``; None leaves it."""
        text, start, end, last = [], [], [], 0
        for m in pattern.finditer(self.text):
            new = replace(m)
            if new is None:
                continue
            a, b = m.span()
            text += [self.text[last:a], new]
            start += self.start[last:a] + [self.start[a]] * len(new)
            end += self.end[last:a] + [self.end[b - 1]] * len(new)
            last = b
        if not last:
            return self
        return Mapped(
            "".join([*text, self.text[last:]]), start + self.start[last:], end + self.end[last:]
        )


#: Letters of other scripts that look like Latin ones, and full stops of other scripts.
LOOK_ALIKE = dict(
    zip(
        "аеорсухіјѕԁԛԝһАВЕКМНОРСТХІЈЅαονικρτυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧօսհոⲟⲣⲥꓳꓑꓚꓰ",
        "aeopcyxijsdqwhABEKMHOPCTXIJSaovikptuxABEZHIKMNOPTYXouhnopcOPCE",
        strict=True,
    )
) | dict.fromkeys("。｡۔।", ".")
#: Characters whose names say which Latin letter they show; where Unicode has a plain form, NFKC tells.
_NAMED = re.compile(
    r"LATIN LETTER SMALL CAPITAL ([A-Z])|LATIN SMALL LETTER (?:SCRIPT|DOTLESS) ([A-Z])"
    r"|(?:NEGATIVE |PARENTHESIZED )?(?:CIRCLED |SQUARED |PARENTHESIZED )?LATIN (?:CAPITAL|SMALL) LETTER ([A-Z])"
    r"|REGIONAL INDICATOR SYMBOL LETTER ([A-Z])"
)


@lru_cache(maxsize=1 << 16)
def _plain_character(c: str) -> str | None:
    """What a character beyond ASCII is rewritten to; None for those that stay."""
    if c in LOOK_ALIKE:
        return LOOK_ALIKE[c]
    if unicodedata.category(c) == "Cf":  # joiners, marks of direction, soft hyphens and the like
        return ""
    digit = unicodedata.digit(c, None)
    if digit is not None:
        return str(digit)
    folded = unicodedata.normalize("NFKC", c)
    if folded.isascii() and len(folded) == 1:
        return folded
    named = _NAMED.fullmatch(unicodedata.name(c, ""))
    return next(filter(None, named.groups())).lower() if named else None


@lru_cache(maxsize=1 << 12)
def _any_of(characters: frozenset[str]) -> re.Pattern:
    return re.compile("[" + "".join(map(re.escape, sorted(characters))) + "]")


def _odd(text: str) -> re.Pattern | None:
    """Finds the characters of the text that are rewritten, if it has any."""
    if text.isascii():
        return None
    odd = frozenset(c for c in set(text) if c > "\x7f" and _plain_character(c) is not None)
    return _any_of(odd) if odd else None


_SPELLED = {
    word: str(value)
    for words in (
        "zero one two three four five six seven eight nine",
        "null eins zwei drei vier fünf sechs sieben acht neun",
        "cero uno dos tres cuatro cinco seis siete ocho nueve",
        "zéro un deux trois quatre cinq six sept huit neuf",
    )
    for value, word in enumerate(words.split())
} | {"oh": "0"}
_WORD = "(?:" + "|".join(sorted(_SPELLED, key=len, reverse=True)) + ")"
_AT, _DOT = "(?:at|arroba|chez|ät)", "(?:dot|punto|point|punkt)"
_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
#: The same words between underscores, and either the words or the signs in brackets.
_IN_AT, _IN_DOT = rf"(?:{_AT}|@)", rf"(?:{_DOT}|\.)"
#: Spelled digits; they count beside another one, a digit or a dot, and the patterns decide.
_RUN = re.compile(rf"\b{_WORD}\b(?:[ -]{_WORD}\b)*", re.IGNORECASE)
_SPLIT = re.compile("[ -]")
_PLUS = re.compile(r"\bplus (?=[0-9])", re.IGNORECASE)
_ANY_DOT = rf"(?: {_DOT} | ?{_OPEN} ?{_IN_DOT} ?{_CLOSE} ?|_{_DOT}_| \. |\.)"
_BEFORE = re.compile(rf"(?:[0-9][ -]?|{_ANY_DOT})\Z", re.IGNORECASE)
_AFTER = re.compile(rf"[ -]?[0-9]|{_ANY_DOT}[A-Za-z0-9]", re.IGNORECASE)
#: The longest that _BEFORE needs to see.
_NEAR = 12


def _digits(m: re.Match) -> str | None:
    words = _SPLIT.split(m[0])
    a, b = m.span()
    if len(words) == 1 and not _BEFORE.search(m.string[max(0, a - _NEAR) : a]) and not _AFTER.match(m.string, b):
        return None
    digits = [_SPELLED.get(w.casefold()) for w in words]
    return None if None in digits else "".join(digits)


#: "(a)" counts only close between an address's parts.
_BRACKETED_AT = re.compile(
    rf" ?{_OPEN} ?{_IN_AT} ?{_CLOSE} ?"
    rf"|(?<=[A-Za-z0-9_%+-]){_OPEN}a{_CLOSE}(?=[A-Za-z0-9-]++(?:\.| ?{_OPEN} ?{_IN_DOT} ?{_CLOSE}))",
    re.IGNORECASE,
)
_BRACKETED_DOT = re.compile(rf" ?{_OPEN} ?{_IN_DOT} ?{_CLOSE} ?", re.IGNORECASE)
#: Words between underscores make an address only where both are there: at, then dot.
_UNDERSCORED = re.compile(
    rf"(?<=[A-Za-z0-9])_{_AT}_(?=[A-Za-z0-9-]++(?:(?:_{_DOT}_|\.)[A-Za-z0-9-]++)*_{_DOT}_[A-Za-z0-9])", re.IGNORECASE
)
_UNDERSCORED_DOT = re.compile(rf"_{_DOT}_", re.IGNORECASE)
#: Addresses with a space between all their characters, or around their signs.
_SPACED_LETTERS = re.compile(r"(?<!\s[A-Za-z0-9._%+-] )(?<!\S)(?:[A-Za-z0-9._%+-] ){2,}+@(?: [A-Za-z0-9.-]){3,}(?![^\s.,;:!?])")
_SPACED_SIGNS = re.compile(r"(?<=[A-Za-z0-9_%+-]) @ (?=[A-Za-z0-9-]++(?: \. [A-Za-z0-9-]++)+)")
_SPACED_DOT = re.compile(r" \. ")
_SPACE = re.compile(" ")
_BARE_DOT = re.compile(rf" {_DOT} ", re.IGNORECASE)
#: A bare "at" counts only where a disguised dot follows in the domain, after real ones or none.
_BARE_AT = re.compile(
    rf"(?<=[A-Za-z0-9_%+-]) {_AT} (?=[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+"
    rf"(?: {_DOT} | ?{_OPEN} ?{_DOT} ?{_CLOSE} ?)[A-Za-z0-9-])",
    re.IGNORECASE,
)
#: Bare dots are rewritten around an @ and between numbers. Labels before an @ are matched as
#: a whole chain, with an @ behind it or not, so that no chain is looked at twice.
_DOTTED_DOMAIN = re.compile(rf"@[A-Za-z0-9-]++(?:(?: {_DOT} |\.)[A-Za-z0-9-]++)++", re.IGNORECASE)
_DOTTED_LOCAL = re.compile(
    rf"(?<![A-Za-z0-9_%+-])[A-Za-z0-9_%+-]++(?: {_DOT} [A-Za-z0-9_%+-]++)++@?+", re.IGNORECASE
)
_DOTTED_NUMBER = re.compile(rf"(?<=[0-9]) {_DOT} (?=[0-9])", re.IGNORECASE)
_DISGUISED = re.compile(
    rf"{_OPEN} ?(?:{_AT}|{_DOT}|[@.]|a) ?{_CLOSE}| {_DOT} |_{_DOT}_| @ ", re.IGNORECASE
)


def _inside(mapped: Mapped, pattern: re.Pattern, what: re.Pattern, new: str) -> Mapped:
    """Rewrite ``what`` inside those of the pattern's matches only that hold an @."""
    inside = [m.span() for m in pattern.finditer(mapped.text) if "@" in m[0]]
    if not inside:
        return mapped
    spans = iter(inside)
    state = [next(spans)]

    def replace(m):
        while state[0] is not None and state[0][1] <= m.start():
            state[0] = next(spans, None)
        return new if state[0] is not None and state[0][0] <= m.start() else None

    return mapped.rewritten(what, replace)


_UNDERSCORED_DOMAIN = re.compile(rf"@[A-Za-z0-9-]++(?:(?:_{_DOT}_|\.)[A-Za-z0-9-]++)++", re.IGNORECASE)
_SPACED_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?: \. [A-Za-z0-9-]++)++")


def _signs(out: Mapped) -> Mapped:
    """Disguised signs in their own form."""
    at, dot = (lambda m: "@"), (lambda m: ".")
    if " @ " in out.text:
        out = _inside(out, _SPACED_LETTERS, _SPACE, "")
        out = _inside(out.rewritten(_SPACED_SIGNS, at), _SPACED_DOMAIN, _SPACED_DOT, ".")
    if "_" in out.text:
        out = _inside(out.rewritten(_UNDERSCORED, at), _UNDERSCORED_DOMAIN, _UNDERSCORED_DOT, ".")
    out = out.rewritten(_BRACKETED_AT, at).rewritten(_BARE_AT, at).rewritten(_BRACKETED_DOT, dot)
    for pattern in (_DOTTED_DOMAIN, _DOTTED_LOCAL):
        out = _inside(out, pattern, _BARE_DOT, ".")
    return out.rewritten(_DOTTED_NUMBER, dot)


def rewritten(text: str) -> Mapped | None:
    """The text after all transducers, or None where none has anything to do."""
    odd, disguised = _odd(text), _DISGUISED.search(text)
    run = any(_digits(m) is not None for m in _RUN.finditer(text))
    if not (odd or run or disguised):
        return None
    out = Mapped.of(text)
    if odd:
        out = out.rewritten(odd, lambda m: _plain_character(m[0]))
    out = out.rewritten(_RUN, _digits).rewritten(_PLUS, lambda m: "+")
    return _signs(out) if odd or disguised else out


def all_spans(text: str, plain: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The plain spans and those that only the rewritten text shows."""
    mapped = rewritten(text)
    if mapped is None:
        return plain
    found = set(plain)
    for kind, s, e in plain_spans(mapped.text):
        a, b = mapped.start[s], mapped.end[e - 1]
        if text[a:b] != mapped.text[s:e]:
            found.add((kind, a, b))
    return _ordered(found)


def find_personal_data(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and spans (array of kind, start, end, plain).

    ``plain`` says whether the text as it is matches.
    """

    def made(texts):
        out = []
        for text in texts:
            plain = plain_spans(text or "")
            known = set(plain)
            out.append(
                [
                    {"kind": k, "start": s, "end": e, "plain": (k, s, e) in known}
                    for k, s, e in all_spans(text or "", plain)
                ]
            )
        return {"spans": out}

    return map_texts(
        id_and_text(df, id_col, text_col),
        made,
        "spans array<struct<kind:string,start:bigint,end:bigint,plain:boolean>>",
    )


def personal_data_digest(df: DataFrame, **options) -> DataFrame:
    """Per row: id, counts of plain spans by kind, base_sha256 of the plain spans, all spans."""
    joined = lambda spans: F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ","
    )
    plain = F.filter("spans", lambda x: x["plain"])
    count = lambda kind: F.size(F.filter(plain, lambda x: x["kind"] == kind)).cast("long")
    return find_personal_data(df, **options).select(
        "id",
        *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(plain), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
