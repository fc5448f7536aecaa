"""Operator 3: format-preserving Feistel pseudonyms for personal data.

Method: a value found in the text is validated (Luhn for cards, mod 97 for IBANs, octets for
addresses, the calendar for dates, ...), read as a number in its format's own range, moved by a
keyed Feistel permutation of that range, and written back in the same format and length. So
equal values get equal pseudonyms in all documents, different ones never collide, and the key's
holder can reverse it (``pseudonym(..., inverse=True)``). Check digits are computed anew, so the
pseudonym of a valid card or IBAN is valid.

Kinds: email, iban, card, ssn, date, ip, phone; and secret: access keys and the values of
password/token/secret/key assignments, permuted within their characters' classes.
A number that fails its validation is not personal data and stays.

Each text is changed on its own, whole; no shuffle. Defined results: NULL stays NULL, empty stays
empty, a text without such values is returned as it is; repeated rows get equal texts; other
columns are kept as they are.
"""

from __future__ import annotations

import re
from datetime import date, timedelta
from hashlib import blake2b
from math import isqrt, prod

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from voltframe.llm.common import map_batches, pick, table

#: Default key; a real run passes its own secret.
KEY = b"voltframe-demo-key"
ROUNDS = 8
KINDS = ("email", "iban", "card", "ssn", "date", "ip", "phone", "secret")

#: Stretches that may hold a value: words with a digit or @, and following words with a digit or
#: of up to four capitals (an IBAN's groups may be letters only).
_HOT = re.compile(r"(?<!\S)[^\s0-9@]*[0-9@]\S*(?:[ \t]+(?:[^\s0-9@]*[0-9]\S*|[A-Z]{1,4}(?![A-Za-z])\S*))*")
#: ASCII classes: a letter of another script beside a value is no part of it.
_VALUE = re.compile(r"""
  (?P<email>(?<![\w.+%-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}(?![A-Za-z0-9]))
 |(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))
 |(?P<card>(?<![\w.+-])[0-9](?:[ -]?[0-9]){12,18}(?![\w]|[.-][0-9]))
 |(?P<ssn>(?<![\w.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w]|[.-][0-9]))
 |(?P<date>(?<![\w./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4})(?![\w]|[./-][0-9]))
 |(?P<ip>(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w]|\.[0-9]))
 |(?P<phone>(?<![\w.])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}|(?:\([0-9]{3}\)[ ]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4})(?![\w]|[.-][0-9]))
""", re.X | re.A)
#: The length of an IBAN by its country.
_IBAN_LENGTH = {c: int(n) for n, cs in (x.split(":") for x in (
    "15:NO 16:BE 18:DK,FI,FK,FO,GL,NL,SD 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,MN,XK 21:CH,HR,LI,LV 22:BG,BH,CR,DE,GB,GE,IE,ME,RS,VA 23:AE,GI,IL,IQ,OM,SO,TL "
    "24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,TN,VG 25:LY,PT,ST 26:IS,TR 27:BI,DJ,FR,GR,IT,MC,MR,SM 28:AL,AZ,BY,CY,DO,GT,HU,LB,NI,PL,SV 29:BR,EG,PS,QA,UA "
    "30:JO,KW,MU,YE 31:MT,SC 32:LC 33:RU").split()) for c in cs.split(",")}
_SECRET_HINTS = ("AKIA", "ASIA", "password", "passwd", "token", "secret", "key", "Password", "PASSWORD", "Token", "TOKEN", "Secret", "SECRET", "Key", "KEY")
_SECRET = re.compile(r"""(?P<head>(?<![A-Za-z0-9])(?:AKIA|ASIA)(?=[A-Z0-9]{16}(?![A-Za-z0-9]))
 |(?i:(?<![A-Za-z0-9])(?:password|passwd|token|secret|key)["']?[ ]?[=:][ ]?["']?(?=[^\s"']*[0-9])))(?P<body>[^\s"',;]{6,})""", re.X)

_FIRST, _DAYS = date(1900, 1, 1), (date(2100, 1, 1) - date(1900, 1, 1)).days


def permute(x: int, size: int, key: bytes, tweak: str, inverse: bool = False) -> int:
    """A keyed permutation of range(size): Feistel rounds over two halves a x b >= size, walked
    on until the value is in range again."""
    if size < 2:
        return x
    a = isqrt(size - 1) + 1
    b = -(-size // a)

    def mix(r: int, half: int, modulus: int) -> int:
        return int.from_bytes(blake2b(f"{tweak}|{size}|{r}|{half}".encode(), key=key[:64], digest_size=16 + modulus.bit_length() // 8).digest(), "big") % modulus

    while True:
        lo, hi = x % a, x // a
        for r in reversed(range(ROUNDS)) if inverse else range(ROUNDS):
            sign = -1 if inverse else 1
            if r % 2 == 0:
                lo = (lo + sign * mix(r, hi, a)) % a
            else:
                hi = (hi + sign * mix(r, lo, b)) % b
        x = hi * a + lo
        if x < size:
            return x


_CLASSES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def _chars(text: str, key: bytes, tweak: str, inverse: bool, classes=_CLASSES) -> str:
    """Permute a string within its pattern: each digit or letter stays of its class, the rest stays."""
    of = [next((c for c in classes if ch in c), ch) for ch in text]
    x = 0
    for ch, c in zip(text, of):
        x = x * len(c) + c.index(ch)
    x = permute(x, prod(len(c) for c in of), key, tweak + "|" + "".join("x" if len(c) > 1 else c for c in of), inverse)
    out = []
    for c in reversed(of):
        x, r = divmod(x, len(c))
        out.append(c[r])
    return "".join(reversed(out))


def _fill(pattern: str, chars: str) -> str:
    """``chars`` in the places of the letters and digits of ``pattern``."""
    it = iter(chars)
    return "".join(next(it) if ch.isalnum() else ch for ch in pattern)


def luhn_digit(digits: str) -> str:
    """The check digit that makes ``digits`` + it valid."""
    total = sum(sum(divmod(2 * int(d), 10)) if i % 2 == 0 else int(d) for i, d in enumerate(reversed(digits)))
    return str(-total % 10)


def _iban_check(country: str, rest: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in rest + country + '00')) % 97:02d}"


def _email(v, key, inv):
    name, _, host = v.partition("@")
    labels = host.split(".")
    return _chars(name, key, "email-name", inv) + "@" + ".".join([*(_chars(x, key, "email-host", inv) for x in labels[:-1]), labels[-1]])


def _is_iban(c: str) -> bool:
    return 15 <= len(c) <= 34 and c[2:4] == _iban_check(c[:2], c[4:])


def _registered(v: str) -> str | None:
    """The valid IBAN of its country's length that the groups ``v`` begin with."""
    starts = (v[:m.end()] for m in re.finditer("[A-Z0-9]+", v))
    return next((s for s in starts if len(c := s.replace(" ", "")) == _IBAN_LENGTH.get(v[:2]) and _is_iban(c)), None)


def _iban_of(v: str) -> str | None:
    """The IBAN that the groups ``v`` begin with: of its country's length; else, if no later group
    begins such a one, any that is all of them or those before the first of letters only."""
    if (known := _registered(v)) or any(_registered(v[m.end():]) for m in re.finditer(" (?=[A-Z]{2}[0-9]{2})", v)):
        return known
    return next((s for s in (v, re.match("[A-Z0-9]+(?: [A-Z]*[0-9][A-Z0-9]*)*", v).group()) if _is_iban(s.replace(" ", ""))), None)


def _iban(v, key, inv):
    c = v.replace(" ", "")
    if not _is_iban(c):
        return None
    rest = _chars(c[4:], key, "iban" + c[:2], inv)
    return _fill(v, c[:2] + _iban_check(c[:2], rest) + rest)


def _card(v, key, inv):
    d = re.sub(r"\D", "", v)
    if d[-1] != luhn_digit(d[:-1]) or len(set(d)) == 1:
        return None
    body = _chars(d[:-1], key, "card", inv)
    return _fill(v, body + luhn_digit(body))


def _ssn(v, key, inv):
    if v[:3] in ("000", "666") or v[0] == "9" or v[4:6] == "00" or v[7:] == "0000":
        return None
    areas = [a for a in range(1, 900) if a != 666]
    x = (areas.index(int(v[:3])) * 99 + int(v[4:6]) - 1) * 9999 + int(v[7:]) - 1
    x, serial = divmod(permute(x, len(areas) * 99 * 9999, key, "ssn", inv), 9999)
    area, group = divmod(x, 99)
    return f"{areas[area]:03d}-{group + 1:02d}-{serial + 1:04d}"


def _date(v, key, inv):
    d = re.findall(r"\d+", v)
    iso = len(d[0]) == 4
    for y, m, day in [(d[0], d[1], d[2])] if iso else [(d[2], d[1], d[0]), (d[2], d[0], d[1])]:
        try:
            n = (date(int(y), int(m), int(day)) - _FIRST).days
        except ValueError:
            continue
        if not 0 <= n < _DAYS:
            return None
        new = _FIRST + timedelta(days=permute(n, _DAYS, key, "date", inv))
        order = (f"{new:%Y}", f"{new:%m}", f"{new:%d}") if iso else (f"{new:%d}", f"{new:%m}", f"{new:%Y}")
        if not iso and m == d[0]:
            order = (order[1], order[0], order[2])
        return _fill(v, "".join(order))
    return None


def _ip(v, key, inv):
    parts = v.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    low, size = {1: 0, 2: 10, 3: 100}, {1: 10, 2: 90, 3: 156}
    x = 0
    for p in parts:
        x = x * size[len(p)] + int(p) - low[len(p)]
    x = permute(x, prod(size[len(p)] for p in parts), key, "ip" + ",".join(str(len(p)) for p in parts), inv)
    out = []
    for p in reversed(parts):
        x, r = divmod(x, size[len(p)])
        out.append(str(r + low[len(p)]))
    return ".".join(reversed(out))


def _phone(v, key, inv):
    code = re.match(r"\+\d{1,3}(?=\D)|\+\d|", v).group()
    rest = v[len(code):]
    if not 7 <= len(re.sub(r"\D", "", rest)) <= 15:
        return None
    digits = _chars(re.sub(r"\D", "", rest), key, "phone" + code, inv)
    return code + _fill(rest, digits)


_KINDS = {"email": _email, "iban": _iban, "card": _card, "ssn": _ssn, "date": _date, "ip": _ip, "phone": _phone}


def pseudonym(kind: str, value: str, key: bytes = KEY, inverse: bool = False) -> str | None:
    """The value's pseudonym in its own format; None if it isn't valid."""
    return _chars(value, key, "secret", inverse) if kind == "secret" else _KINDS[kind](value, key, inverse)


def protect(text: str, key: bytes = KEY, inverse: bool = False) -> tuple[str, list[str]]:
    """The text with every valid value replaced, and the kinds replaced."""
    found: list[str] = []

    def stretch(hot: re.Match) -> str:
        s, out, at, start = hot.group(), [], 0, 0
        while m := _VALUE.search(s, start):
            kind = m.lastgroup
            old = _iban_of(m.group()) if kind == "iban" else m.group()
            new = old and pseudonym(kind, old, key, inverse)
            if new is None:
                start = m.start() + 4 if kind == "iban" else m.end()      # what follows an IBAN's head may be another value
            else:
                found.append(kind)
                out += [s[at:m.start()], new]
                at = start = m.start() + len(old)
        return "".join([*out, s[at:]])

    def values(part: str) -> str:
        return _HOT.sub(stretch, part)

    out, at = [], 0
    for m in _SECRET.finditer(text) if any(h in text for h in _SECRET_HINTS) else ():
        out += [values(text[at:m.start()]), m["head"], pseudonym("secret", m["body"], key, inverse)]
        found.append("secret")
        at = m.end()
    out.append(values(text[at:]))
    return "".join(out), found


def pseudonymise(docs: DataFrame, key: bytes = KEY, prefix: str = "") -> DataFrame:
    """``docs`` with ``text`` replaced, and ``pii_kinds`` (sorted, comma-joined, repeated per value)
    and ``n_pii`` added (with ``prefix``)."""
    types = {f.name: f.dataType.simpleString() for f in docs.schema}

    def run(b: pa.RecordBatch) -> dict:
        done = [(None, []) if t is None else protect(t, key) for t in b.column("text").to_pylist()]
        return {c: b.column(c) for c in types} | {"text": [t for t, _ in done], f"{prefix}pii_kinds": [",".join(sorted(k)) for _, k in done], f"{prefix}n_pii": [len(k) for _, k in done]}

    return map_batches(docs, run, ", ".join(f"`{c}` {t}" for c, t in types.items()) + f", {prefix}pii_kinds string, {prefix}n_pii long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(pick(table(spark, sf_dir, "documents"), doc_id="long", text="string"))
