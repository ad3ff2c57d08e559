import random
import re
import zlib
from collections import Counter

import pytest

from keyscore.llm import spelling

SCHEMA = "doc_id long, text string, word string, n int, form string"
UPPER = {o: o + 32 for o in range(65, 91)}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def grouped(counts, times=10):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        top = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = top if top is not None and counts[top] >= times * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return sorted(out, key=repr)


def brute(rows):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return grouped({w: n for w, n in counts.items() if n >= 2})


def rows_of(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def mutated(rng, word, letters):
    at = rng.randrange(len(word))
    return rng.choice((word[:at] + word[at + 1 :], word[:at] + rng.choice(letters) + word[at:], word[:at] + rng.choice(letters) + word[at + 1 :]))


@pytest.mark.parametrize("large", [2, 8, 2048])
def test_pairs_of_words_like_brute_force(spark, monkeypatch, large):
    rng = random.Random(large)
    monkeypatch.setattr(spelling, "TILE", 8)
    words = {"".join(rng.choices("ab", k=rng.randrange(1, 11))) for _ in range(150)}
    words |= {mutated(rng, "straßenbahn", "aßé日𝄞") for _ in range(60)} | {"x" * 500, "x" * 499, "x" * 250 + "y" + "x" * 249}
    counts = {w: rng.choice((1, 2, 20, 300)) for w in words if w}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert rows_of(spelling.group_variants(df, large=large)) == grouped(counts)


def test_texts_like_brute_force(spark):
    rng = random.Random(9)
    base = ["Running", "thinking", "ÉCOLEété", "garçonnet", "windmills", "run", "über", "mountains"]
    rows = []
    for i in range(400):
        words = [rng.choice(base) for _ in range(30)]
        words = [mutated(rng, w, "aeé") if rng.random() < 0.05 else w for w in words]
        rows.append((i, rng.choice((" ", "-", "1", "日")).join(words), "x", 1, "y"))
    assert rows_of(spelling.variants_in(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    assert rows_of(spelling.variants_in(spark.createDataFrame(rows * 2, SCHEMA))) == brute(rows * 2)


def test_null_empty_and_long_texts(spark):
    rows = [(None, None, "", 0, ""), (1, "", "", 0, ""), (2, "short", "", 0, ""), (None, "ordinary ordinary", "", 0, ""), (4, "z" * 300_000 + " " + "z" * 299_999, "", 0, ""), (5, "z" * 300_000 + " " + "z" * 299_999, "", 0, "")]
    assert rows_of(spelling.variants_in(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    assert rows_of(spelling.variants_in(spark.createDataFrame([], SCHEMA))) == []


def test_chain_of_forms(spark):
    counts = {"abcdefg": 10**6, "abcdefh": 10**5, "abcdeih": 10**4, "abcdjih": 1000, "abckjih": 100, "ablkjih": 10, "amlkjih": 1}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = rows_of(spelling.group_variants(df))
    assert got == grouped(counts) and {r[2] for r in got} == {"abcdefg"}
