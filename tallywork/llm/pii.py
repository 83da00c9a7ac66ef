"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score."""

from __future__ import annotations

import base64
import ipaddress
import json
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.llm.common import field

# The kinds in the order that breaks ties of position; the first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "ip6", "secret", "jwt", "pem")
BASE = KINDS[:4]
THRESHOLD = 0.5  # least score of a span outside the base kinds
CONTEXT = 40  # characters looked at before and after a span

# What a confirmed pattern is worth alone, and the words nearby that speak for a kind.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.3, "ip6": 0.6, "secret": 0.4, "jwt": 0.9, "pem": 0.9}
_KNOWN = 0.9  # a secret of a known format
WORDS = {
    # English, German, French, Spanish
    "email": ("mail", "contact", "write to", "kontakt", "schreiben an", "courriel", "écrire à", "correo", "escribir a"),
    "ip": ("ip", "host", "server", "address", "adresse", "serveur", "servidor", "dirección"),
    "card": ("card", "credit", "visa", "payment", "karte", "kreditkarte", "zahlung", "carte", "paiement", "tarjeta", "crédito", "pago"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "telefon", "anruf", "handy", "téléphone", "appeler", "teléfono", "llamar", "móvil"),
    "iban": ("iban", "account", "bank", "transfer", "konto", "überweisung", "compte", "banque", "virement", "cuenta", "banco", "transferencia"),
    "ssn": ("ssn", "social security", "tax id", "taxpayer", "steuernummer", "sozialversicherung", "sécurité sociale", "seguridad social"),
    "ip6": ("ip", "ipv6", "host", "server", "address", "adresse", "serveur", "servidor", "dirección"),
    "secret": (
        "token", "secret", "password", "passwd", "pwd", "passphrase", "api key", "apikey", "api_key", "access key", "access_key", "auth",
        "bearer", "credential", "credentials", "private key", "kennwort", "passwort", "geheimnis", "schlüssel", "mot de passe", "secrète", "clé",
        "contraseña", "clave", "secreto", "jeton", "client_secret", "secret_key", "access_token", "auth_token", "aws_secret_access_key",
    ),
    "jwt": ("token", "bearer", "jwt", "authorization"),
    "pem": ("key", "ssh", "tls", "schlüssel", "clé", "clave"),
}
AGAINST = ("version", "isbn", "example number", "order no", "part no", "checksum", "commit", "sha1", "sha256", "md5")
_GAIN, _LOSS = 0.3, 0.2
# Length of an account number by its country code.
IBAN_LENGTHS = {
    code: n
    for n, codes in (
        (15, "NO"), (16, "BE"), (18, "DK FI FK FO GL NL SD"), (19, "MK SI"), (20, "AT BA EE KZ LT LU MN XK"), (21, "CH HR LI LV"),
        (22, "BG BH CR DE GB GE IE ME RS VA"), (23, "AE GI IL IQ OM SO TL"), (24, "AD CZ ES MD PK RO SA SE SK TN VG"), (25, "LY PT ST"),
        (26, "IS TR"), (27, "BI DJ FR GR IT MC MR SM"), (28, "AL AZ BY CY DO GT HN HU LB NI PL SV"), (29, "BR EG PS QA UA"),
        (30, "JO KW MU YE"), (31, "MT SC"), (32, "LC"), (33, "RU"),
    )
    for code in codes.split()
}

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A digit run cannot begin a match in its middle that it does not begin at its start.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")

_TWO_DIGITS = re.compile(r"[0-9][\x20().:-]?[0-9]")
_IP6 = re.compile(r"(?<![0-9A-Za-z:.])(?=[0-9A-Fa-f:]*:[0-9A-Fa-f:]*:)[0-9A-Fa-f:]{3,39}(?![0-9A-Za-z:])")
# Formats of keys that services issue.
_FORMATS = re.compile(r"(?<![0-9A-Za-z_])(?:AKIA[0-9A-Z]{16}|ASIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|xox[abprs]-[0-9A-Za-z-]{20,}|sk_live_[0-9A-Za-z]{24,}|AIza[0-9A-Za-z_-]{35})(?![0-9A-Za-z_])")
# a colon or equals sign, and a value in quotes or up to a blank
_ASSIGNED = re.compile(r"[:=]>?\x20?(?:\"([^\"\s]{8,200})\"|'([^'\s]{8,200})'|([^\s\"',;]{8,200}))")
_JWT = re.compile(r"(?<![0-9A-Za-z_-])eyJ[0-9A-Za-z_-]{8,}\.eyJ[0-9A-Za-z_-]{4,}\.[0-9A-Za-z_-]{16,}(?![0-9A-Za-z_-])")
_PEM = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----[A-Za-z0-9+/=\s:,-]{1,20000}?-----END \1-----")
ENTROPY = 3.0  # bits a character of an assigned secret has at least
_NAMED = 32  # characters before a value in which the name of a secret stands

_SPANS = "array<struct<kind:string,start:int,end:int,score:double,value:string>>"


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Personal data of every row: (doc_id, spans), spans by start and kind, as (kind, start, end, score, value).

    Offsets count code points, ends are exclusive. Base kinds (email, ip, card, phone) are leftmost
    non-overlapping matches per kind that pass their check; they stay whatever their score. Account
    numbers confirmed by mod 97, social security numbers, IPv6 addresses and secrets are further kinds, kept from a score of 0.5. A secret is a
    key of a known format, a signed token whose header decodes, a private key block, or a value of ENTROPY bits a
    character with digits and letters that is assigned to a name for a secret, in one of four languages.
    A score is the pattern's worth, raised by words that go with the kind and lowered by words that go
    with other numbers, looked for within 40 characters. The scan is linear in the text, however long;
    NULL and empty texts have no spans; every row is scanned on its own, so repeated rows repeat; other
    columns are ignored. There is no shuffle.
    """

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["spans"] = [[dict(zip(("kind", "start", "end", "score", "value"), s, strict=True)) for s in spans_of(t)] for t in batch["text"]]
            yield batch[["doc_id", "spans"]]

    rows = docs.select(field(id_col).cast("string").alias("doc_id"), F.coalesce(field(text_col).cast("string"), F.lit("")).alias("text"))
    found = rows.mapInPandas(scan, f"doc_id string, spans {_SPANS}")
    return found.select(F.col("doc_id").cast("long"), "spans")


def personal_data_digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of their spans, all spans as text, and their number."""

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))))

    def of(*kinds):
        return F.filter("spans", lambda s: s.kind.isin(*kinds))

    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE]
    base = of(*BASE)
    digests = F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    return found.select("doc_id", *counts, *digests, F.size("spans").cast("long").alias("n_all"))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    rest = 0
    for c in iban[4:] + iban[:4]:
        for d in str(int(c, 36)):
            rest = (rest * 10 + int(d)) % 97
    return rest == 1


def spans_of(text: str) -> list[tuple[str, int, int, float, str]]:
    """All spans of one text."""
    proposed = list(_emails(text)) if "@" in text else []
    secrets = list(_secrets(text))
    if not _TWO_DIGITS.search(text):  # no other kind does without
        return _kept(text, proposed, secrets)
    proposed += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(int(p[-3:]) < 256 and not p[:-3].strip("0") for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            proposed.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdecimal() for c in m[0]) <= 15:
                proposed.append(("phone", m.start(), m.end()))
    proposed += _ibans(text)
    proposed += [("ssn", m.start(), m.end()) for m in _SSN.finditer(text)]
    return _kept(text, proposed, secrets)


def _kept(text: str, proposed: list[tuple[str, int, int]], secrets: list[tuple[str, int, int, float]]) -> list[tuple[str, int, int, float, str]]:
    scored = [(k, a, b, _score(k, text, a, b), text[a:b]) for k, a, b in proposed]
    kept = [s for s in scored if s[0] in BASE or s[3] >= THRESHOLD]
    kept += [(k, a, b, worth, text[a:b]) for k, a, b, worth in secrets if worth >= THRESHOLD]
    return sorted(kept, key=lambda s: (s[1], KINDS.index(s[0])))


def _secrets(text: str) -> Iterator[tuple[str, int, int, float]]:
    """Secrets and IPv6 addresses with their scores; a value is reported once, by its most certain kind."""
    taken: list[tuple[int, int]] = []

    def free(a: int, b: int) -> bool:
        if any(x < b and a < y for x, y in taken):
            return False
        taken.append((a, b))
        return True

    if "-----BEGIN " in text:
        for m in _PEM.finditer(text):
            if free(*m.span()):
                yield "pem", *m.span(), _score("pem", text, *m.span())
    if "eyJ" in text:
        for m in _JWT.finditer(text):
            if _has_header(m[0]) and free(*m.span()):
                yield "jwt", *m.span(), _score("jwt", text, *m.span())
    for m in _FORMATS.finditer(text):
        if (not m[0].startswith("gh") or github_checksum(m[0])) and free(*m.span()):
            yield "secret", *m.span(), _KNOWN
    if ":" in text or "=" in text:
        for m in _ASSIGNED.finditer(text):
            start, end = next(m.span(i) for i in (1, 2, 3) if m[i] is not None)
            if not looks_random(text[start:end]):
                continue
            name = text[max(0, m.start() - _NAMED) : m.start()].casefold()
            if _has(name, WORDS["secret"]) and free(start, end):
                yield "secret", start, end, _score("secret", text, start, end)
        if "::" in text or text.count(":") > 5:
            for m in _IP6.finditer(text):
                if _is_ip6(m[0]) and free(*m.span()):
                    yield "ip6", *m.span(), _score("ip6", text, *m.span())


def looks_random(value: str) -> bool:
    """At least 8 characters, digits beside letters, and ENTROPY bits a character."""
    if len(value) < 8 or not re.search("[0-9]", value) or not re.search("[A-Za-z]", value):
        return False
    counts = Counter(value)
    bits = -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values())
    return bits >= min(ENTROPY, 0.8 * math.log2(len(value)))


def github_checksum(token: str) -> bool:
    """The last six characters are the CRC-32 of the characters before them, in base 62."""
    body = token.partition("_")[2]
    value = 0
    for c in body[-6:]:
        value = value * 62 + (ord(c) - 48 if c.isdigit() else ord(c) - 55 if c.isupper() else ord(c) - 61)
    return value == zlib.crc32(body[:-6].encode())


def _has_header(token: str) -> bool:
    """The first part of a signed token is JSON that names an algorithm."""
    head = token.split(".")[0]
    try:
        return "alg" in json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except (ValueError, TypeError):
        return False


def _is_ip6(value: str) -> bool:
    try:
        return ipaddress.IPv6Address(value).compressed not in ("::", "::1") and any(c in "0123456789" for c in value)
    except ValueError:
        return False


def _emails(text: str) -> Iterator[tuple[str, int, int]]:
    """Leftmost non-overlapping addresses: a local part never crosses an @, so each @ is tried once."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and (text[start - 1] in "._%+-" or (text[start - 1].isascii() and text[start - 1].isalnum())):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield "email", start, end
        at = text.find("@", max(at + 1, end))


def _ibans(text: str) -> Iterator[tuple[str, int, int]]:
    """Leftmost non-overlapping account numbers: a match may run on into words that follow, so it ends at the word
    edge that gives the length of its country, or at the last edge where mod 97 holds if the country is unknown."""
    at = 0
    while m := _IBAN.search(text, at):
        length = IBAN_LENGTHS.get(m[0][:2])
        ends = [m.end(), *(i for i in range(m.end() - 1, m.start(), -1) if text[i] == " ")]
        numbers = [(end, text[m.start() : end].replace(" ", "")) for end in ends]
        end = next((end for end, n in numbers if (len(n) == length if length else len(n) >= 15) and mod97(n)), None)
        if end:
            yield "iban", m.start(), end
        at = end or m.start() + 1


def _score(kind: str, text: str, start: int, end: int) -> float:
    near = f"{text[max(0, start - CONTEXT) : start]} {text[end : end + CONTEXT]}".casefold()
    score = SCORES[kind] + _GAIN * _has(near, WORDS[kind]) - _LOSS * _has(near, AGAINST)
    return round(min(1.0, max(0.0, score)), 3)


def _has(near: str, words: tuple[str, ...]) -> bool:
    return any(re.search(rf"(?<!\w){re.escape(w)}(?!\w)", near) for w in words)
