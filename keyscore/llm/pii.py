"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust a score."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyscore.llm.common import query, table, texts

#: Kinds in the order in which spans that start together are listed.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "national_id", "account")

#: What follows the @ of an address.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
NATIONAL_ID = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
ACCOUNT = re.compile(r"(?<![0-9A-Za-z.+-])[0-9]{8,12}(?![0-9A-Za-z-]|\.[0-9])")

#: Words that raise the score of a kind if one of them stands within CONTEXT code points before the span or
#: half as many behind it; fixed values.
CONTEXT_WORDS = {
    "email": ("email", "e-mail", "mail", "contact", "correo", "courriel"),
    "ip": ("ip", "address", "host", "server", "adresse"),
    "card": ("card", "visa", "credit", "tarjeta", "carte", "karte"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "telefono", "appel"),
    "iban": ("iban", "bank", "account", "konto", "cuenta", "compte"),
    "national_id": ("ssn", "social", "security", "passport", "national", "identity"),
    "account": ("account", "acct", "customer", "member", "konto", "cuenta", "compte", "passport", "licence", "license"),
}
#: Words that lower the score of every kind.
DOUBT_WORDS = ("example", "sample", "test", "version", "invoice", "isbn", "order", "dummy")
#: Score of a pattern's match before checksum and context.
PATTERN_SCORE = {"email": 0.7, "ip": 0.6, "card": 0.5, "phone": 0.6, "iban": 0.3, "national_id": 0.4, "account": 0.2}
CHECKSUM_BONUS, CONTEXT_BONUS, DOUBT_MALUS = 0.45, 0.35, 0.25
CONTEXT = 48
WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = int(d) * (1 + place % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Letters count as 10 to 35, the first four places go to the end, and the rest of the number by 97 is 1."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def find_emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses. Each @ is looked at once, so a long run of address characters costs no more."""
    done, at = 0, text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > done and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
                start -= 1
            if start < at:
                yield start, domain.end()
                done = domain.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The spans of the four base kinds that their checks let pass, by kind."""
    found = []
    if "@" in text:
        found += [("email", a, b) for a, b in find_emails(text)]
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(digits_of(m[0])) <= 15:
                found.append(("phone", m.start(), m.end()))
    return found


def context_score(text: str, kind: str, start: int, end: int) -> float:
    """What the words within reach add to a span's score."""
    near = text[max(0, start - CONTEXT) : start] + " " + text[end : end + CONTEXT // 2]
    words = set(WORD.findall(near.translate(LOWER)))
    return CONTEXT_BONUS * (not words.isdisjoint(CONTEXT_WORDS[kind])) - DOUBT_MALUS * (not words.isdisjoint(DOUBT_WORDS))


def find_spans(text: str, threshold: float = 0.5) -> list[tuple[str, int, int, float, bool]]:
    """All spans as (kind, start, end, score, base), by start, then kind.

    Base spans always stay; their score only says how sure they are. The kinds that the method adds stay
    from ``threshold`` on: an IBAN by its mod-97 check, the others by the words nearby. An added span that
    overlaps a base span is left out.
    """
    base = base_spans(text)
    taken = sorted((a, b) for _, a, b in base)
    out = []
    for kind, a, b in base:
        score = PATTERN_SCORE[kind] + (CHECKSUM_BONUS if kind == "card" else 0.0) + context_score(text, kind, a, b)
        out.append((kind, a, b, round(min(max(score, 0.0), 1.0), 3), True))
    for kind, pattern in (("iban", IBAN), ("national_id", NATIONAL_ID), ("account", ACCOUNT)):
        for m in pattern.finditer(text):
            a, b = m.span()
            score = PATTERN_SCORE[kind] + context_score(text, kind, a, b)
            if kind == "iban":
                value = m[0].replace(" ", "")
                while len(value) > 15 and not mod97(value):  # words in capitals may follow the number
                    cut = m[0].rfind(" ", 0, b - a)
                    if cut < 0:
                        break
                    b = a + cut
                    value = m[0][:cut].replace(" ", "")
                if len(value) < 15 or not mod97(value):
                    continue
                score += CHECKSUM_BONUS
            if score >= threshold and not any(x < b and a < y for x, y in taken):
                out.append((kind, a, b, round(min(score, 1.0), 3), False))
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(out, key=lambda s: (s[1], order[s[0]], s[2]))


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("base", pa.bool_())])


def detect_pii(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``doc_id`` and ``pii``, an array of (kind, start, end, score, base) in code points, for each row of ``docs``.

    A null or empty text has an empty array; repeated rows and ids give a row each; a null id stays null;
    other columns are not read. A text is read whole, in time linear in its length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("kind", "start", "end", "score", "base")
        for batch in batches:
            spans = [[dict(zip(names, s)) for s in find_spans(t.as_py(), threshold)] for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, pa.list_(SPAN))], ["doc_id", "pii"])

    return texts(docs).mapInArrow(
        run, "doc_id long, pii array<struct<kind:string,start:long,end:long,score:double,base:boolean>>"
    )


def mask_pii(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``doc_id`` and ``text`` with every span replaced by its kind in angle brackets; of overlapping spans the first counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t in batch.column("text"):
                text, parts, done = t.as_py(), [], 0
                for kind, a, b, _, _ in find_spans(text, threshold):
                    if a >= done:
                        parts += [text[done:a], f"<{kind}>"]
                        done = b
                out.append("".join([*parts, text[done:]]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])

    return texts(docs).mapInArrow(run, "doc_id long, text string")


@query("op1_pii")
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect_pii(table(spark, sf_dir, "documents"))
    label = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    base = F.filter("pii", lambda s: s["base"])
    count = lambda kind: F.size(F.filter("pii", lambda s: s["base"] & (s["kind"] == kind))).cast("long")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in BASE_KINDS),
        F.sha2(F.array_join(F.transform(base, label), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("pii", label), ",").alias("spans"),
        F.coalesce(F.array_max(F.transform("pii", lambda s: s["score"])), F.lit(0.0)).alias("top_score"),
    )
