import hashlib
import random
import re
from collections import Counter

import pytest

from docweave.llm import substring

WORDS = re.compile("[^\x20\x09-\x0d]+").findall


def brute(rows, window=35):
    words = [WORDS(t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = Counter()
    for (i, _), w in zip(rows, words):
        gone = {k for a in range(len(w) - window + 1) if seen[tuple(w[a : a + window])] > 1 for k in range(a, a + window)}
        out[i, len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()] += 1
    return out


@pytest.fixture(scope="module")
def repeats(spark):
    r = random.Random(2)
    passage = [f"p{i}" for i in range(90)]
    word = lambda: r.choice(["the", "of", f"w{r.randrange(4000)}", f"x{r.randrange(50)}", "é", "中"])
    rows = []
    for i in range(150):
        text = [word() for _ in range(r.randrange(0, 120))]
        for _ in range(r.randrange(0, 3)):
            a = r.randrange(0, 50)
            text += passage[a : a + r.randrange(20, 60)] + [word() for _ in range(r.randrange(0, 20))]
        rows.append((i % 140, r.choice([" ", "\n", "\t\x0b "]).join(text)))
    rows += [(500, "a b " * 60), (501, "same " * 35), (502, "same " * 34), (503, "same " * 36), (None, rows[3][1]), (None, rows[4][1]), (None, None), (504, ""), rows[7], rows[7]]
    return spark.createDataFrame([(*x, "s") for x in rows], "doc_id long, text string, words string").repartition(4).cache()


@pytest.mark.parametrize("options", [{}, {"heavy": 20}, {"run": 1, "heavy": 5}, {"run": 35}])
def test_against_brute_force(repeats, options):
    assert Counter(map(tuple, substring.digests(repeats, **options).collect())) == brute([(r.doc_id, r.text) for r in repeats.collect()])


def test_small_batches(repeats, monkeypatch):
    monkeypatch.setattr(substring, "BATCH_BYTES", 2000)
    monkeypatch.setattr(substring, "BUCKET_BYTES", 1000)
    assert Counter(map(tuple, substring.digests(repeats).collect())) == brute([(r.doc_id, r.text) for r in repeats.collect()])


def test_documents(odd, documents, none):
    for docs in (odd, documents):
        assert Counter(map(tuple, substring.digests(docs).collect())) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert substring.digests(none).count() == substring.deduplicated(none).count() == 0


def test_texts(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, "head " + text), (2, text + " tail")], "doc_id long, text string")
    assert {(r.doc_id, r.n_removed, r.kept) for r in substring.deduplicated(docs).collect()} == {(1, 40, "head"), (2, 40, "tail")}
