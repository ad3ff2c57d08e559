import hashlib
import random
import re

import pytest

from keyscore.llm import pii

BRUTE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    out = []
    for kind, pattern in BRUTE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            if kind == "card":
                total = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits)))
                if not 14 <= len(digits) <= 19 or total % 10:
                    continue
            out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], pii.BASE_KINDS.index(s[0])))


def test_base_spans_equal_plain_patterns():
    rng = random.Random(5)
    parts = ["a", "b.c", "@", ".", "-", " ", "+", "1", "12", "255", "256", "4111111111111111", "x@y.z", "+49 (30) 12345678", "é", "%", "٣", "00255"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        assert sorted(pii.base_spans(text)) == sorted(brute(text)), text


def test_long_runs_are_linear():
    assert pii.base_spans("a." * 200_000 + "@") == []
    assert len(pii.base_spans("1" * 300_000)) == 0


def test_method_spans():
    text = "His IBAN is DE89 3704 0044 0532 0130 00 and SSN 123-45-6789; account 12345678." + " so" * 30 + " Order 12345678."
    kinds = [s[0] for s in pii.find_spans(text)]
    assert kinds == ["iban", "national_id", "account"]
    assert pii.find_spans("DE88370400440532013000") == []
    assert pii.mod97("GB82WEST12345698765432")


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(
        [(1, "mail a@b.co", "x"), (1, "mail a@b.co", "x"), (2, None, None), (None, "", "y"), (3, "é 10.0.0.1", "z")],
        "doc_id long, text string, pii string",
    )


def test_edge_rows(rows):
    found = sorted((r.doc_id or -1, len(r.pii)) for r in pii.detect_pii(rows).collect())
    assert found == [(-1, 0), (1, 1), (1, 1), (2, 0), (3, 1)]
    assert pii.detect_pii(rows.limit(0)).count() == 0
    assert sorted(r.text for r in pii.mask_pii(rows).collect()) == ["", "", "mail <email>", "mail <email>", "é <ip>"]


def test_query_against_brute_force(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = pii.op1_pii(spark, sf_dir).collect()
    assert len(got) == len(docs)
    for r in got:
        spans = brute(docs[r.doc_id])
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in pii.BASE_KINDS]
        assert {f"{k}:{a}:{b}" for k, a, b in spans} <= set(r.spans.split(","))
