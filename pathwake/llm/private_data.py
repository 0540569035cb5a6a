"""Personal data by anchor expansion.

One Aho-Corasick automaton finds the anchors in a text: at-signs, plus signs, digits, URL schemes
and identifier cues. A parser of the anchor's kind expands it to its boundaries and checks it:
addresses, numbers with their check digits, accounts. An anchor inside what its kind has already
consumed is passed over, so spans of a kind are leftmost and do not overlap.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from itertools import product

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed by the contract: kinds and their patterns. The others are this method's own.
BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("iban", "account", "login")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# What stands between a cue and its number; possessive, so that blanks are passed once.
_BETWEEN = r"(?:[:#=]++\s*+)?"
_IBAN = re.compile(rf"\s*+{_BETWEEN}([A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]{{1,4}}){{3,8}})(?![A-Za-z0-9])")
_NUMBER = re.compile(rf"\s*+(?:(?<=\s)(?:number|no\.?|nr\.?|id)\s*+)?{_BETWEEN}([0-9](?:[\x20-]?[0-9]){{5,17}})(?![0-9])", re.I)
# A password may hold at-signs: the last one before a host ends it.
_LOGIN = re.compile(r"([^\s/@:]+:[^\s/]+)@[A-Za-z0-9.-]+")
CUES = {"iban": "iban", "account": "account", "acct": "account", "ssn": "account", "passport": "account", "://": "login"}

_SCANNED = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_more long"
Span = tuple[int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def iban_valid(text: str) -> bool:
    code = text.replace(" ", "")
    if not 15 <= len(code) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


# A parser takes (text, anchor start, anchor end, end of the kind's last match) and gives the
# match consumed and whether it counts, or None.
def _email(text: str, at: int, _: int, last: int) -> tuple[Span, bool] | None:
    found = _DOMAIN.match(text, at)
    if not found:
        return None
    start = at
    while start > last and text[start - 1] in _LOCAL:
        start -= 1
    return ((start, found.end()), True) if start < at else None


def _ip(text: str, at: int, _: int, last: int) -> tuple[Span, bool] | None:
    # Inside a run of digits nothing matches that did not match at its start.
    if at > last and "0" <= text[at - 1] <= "9":
        return None
    found = _IP.match(text, at)
    if not found:
        return None
    parts = found.group().split(".")
    return found.span(), all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts)


def _card(text: str, at: int, _: int, last: int) -> tuple[Span, bool] | None:
    found = _CARD.match(text, at)
    if not found:
        return None
    digits = _digits(found.group())
    return found.span(), 16 <= len(digits) <= 19 and luhn(digits)


def _phone(text: str, at: int, _: int, last: int) -> tuple[Span, bool] | None:
    found = _PHONE.match(text, at)
    return (found.span(), 8 <= len(_digits(found.group())) <= 15) if found else None


def _iban(text: str, _: int, end: int, last: int) -> tuple[Span, bool] | None:
    found = _IBAN.match(text, end)
    if not found:
        return None
    # Groups may run on into following words: the longest valid head is the account.
    start, stop = found.span(1)
    while stop > start and not iban_valid(text[start:stop]):
        stop -= 1
    return ((start, stop), True) if stop > start else None


def _account(text: str, _: int, end: int, last: int) -> tuple[Span, bool] | None:
    found = _NUMBER.match(text, end)
    return (found.span(1), True) if found else None


def _login(text: str, _: int, end: int, last: int) -> tuple[Span, bool] | None:
    found = _LOGIN.match(text, end)
    return (found.span(1), True) if found else None


PARSERS: dict[str, Callable[[str, int, int, int], tuple[Span, bool] | None]] = {
    "email": _email, "ip": _ip, "card": _card, "phone": _phone, "iban": _iban, "account": _account, "login": _login,
}


def _automaton() -> ahocorasick.Automaton:
    anchors: dict[str, tuple[str, ...]] = {"@": ("email",), "+": ("phone",)}
    anchors |= {d: ("ip", "card") for d in "0123456789"}
    for cue, kind in CUES.items():  # in every mixture of cases
        anchors |= {"".join(letters): (kind,) for letters in product(*({c, c.upper()} for c in cue))}
    automaton = ahocorasick.Automaton()
    for word, kinds in anchors.items():
        automaton.add_word(word, (len(word), kinds))
    automaton.make_automaton()
    return automaton


_built: ahocorasick.Automaton | None = None


def find(text: str) -> dict[str, list[Span]]:
    """Spans by kind, in code points; kinds without spans are missing."""
    global _built
    if _built is None:
        _built = _automaton()
    found: dict[str, list[Span]] = {}
    last = dict.fromkeys(PARSERS, 0)
    for final, (size, kinds) in _built.iter(text):
        at = final + 1 - size
        for kind in kinds:
            if at < last[kind]:
                continue
            match = PARSERS[kind](text, at, final + 1, last[kind])
            if match and match[0][0] >= last[kind]:
                last[kind] = match[0][1]
                if match[1]:
                    found.setdefault(kind, []).append(match[0])
    return found


def listed(found: dict[str, list[Span]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in found.get(k, ()))


def _scan(texts: pa.Array) -> pa.Array:
    rows = []
    for text in texts:
        found = find(text.as_py() or "")
        base = listed(found, BASE_KINDS)
        rows.append({
            **{f"n_{k}": len(found.get(k, ())) for k in BASE_KINDS},
            "base_sha256": hashlib.sha256(base.encode()).hexdigest(),
            "spans": listed(found, BASE_KINDS + MORE_KINDS),
            "n_more": sum(len(found.get(k, ())) for k in MORE_KINDS),
        })
    return pa.array(rows, pa.struct([
        *[(f"n_{k}", pa.int64()) for k in BASE_KINDS], ("base_sha256", pa.string()), ("spans", pa.string()), ("n_more", pa.int64()),
    ]))


def scan(text: Column) -> Column:
    """struct(n_email, n_ip, n_card, n_phone, base_sha256, spans, n_more) of a text column."""
    return F.arrow_udf(_scan, _SCANNED)(text.cast("string"))


def private_data(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id and the columns of :func:`scan`.

    Defined for every input: null reads as empty and has no spans; repeated rows give equal
    rows; an empty table gives an empty result; columns other than doc_id and text are not
    read. A text of any length is searched whole, in time proportional to it, and a task holds
    one batch of texts.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), scan(F.col("text")).alias("s")).select("doc_id", "s.*")


def redact(text: Column) -> Column:
    """The text with every span replaced by ``[kind]``; null stays null."""
    return F.arrow_udf(_redact, "string")(text.cast("string"))


def _redact(texts: pa.Array) -> pa.Array:
    out = []
    for value in texts:
        text = value.as_py()
        if text is not None:
            spans = sorted((a, b, k) for k, found in find(text).items() for a, b in found)
            parts, done = [], 0
            for a, b, kind in spans:
                if a >= done:
                    parts += [text[done:a], f"[{kind}]"]
                done = max(done, b)
            text = "".join(parts) + text[done:]
        out.append(text)
    return pa.array(out, pa.string())
