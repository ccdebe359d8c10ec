"""Operators on documents against brute force, on odd rows and on a small table."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from docweave.llm import mixing, packing, pii, quality, simhash

WORDS = re.compile("[^\x20\x09-\x0d]+").findall


def both(odd, documents):
    return [odd.select(*odd.columns), documents]


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def base_spans(t):
    out = []
    for k, (name, p) in enumerate((("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))):
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m[0])
            if name == "ip" and max(int(x) for x in m[0].split(".")) > 255 or name == "card" and not (12 <= len(d) <= 19 and luhn(d)) or name == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append((m.start(), k, m.end(), name))
    return sorted(out)


@pytest.mark.parametrize("which", [0, 1])
def test_pii(odd, documents, which):
    docs = both(odd, documents)[which]
    texts, rows = Counter((r.doc_id, r.text) for r in docs.collect()), pii.personal_data(docs).collect()
    want, got = Counter(), Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in rows)
    known = {}
    for (i, t), n in texts.items():
        s = base_spans(t or "")
        c = Counter(x[3] for x in s)
        listed = ",".join(f"{k}:{a}:{b}" for a, _, b, k in s)
        want[(i, c["email"], c["ip"], c["card"], c["phone"], hashlib.sha256(listed.encode()).hexdigest())] += n
        known[hashlib.sha256(listed.encode()).hexdigest()] = listed
    assert got == want
    for r in rows:  # base spans stay among all spans
        spans = r.spans.split(",")
        assert {s for s in known[r.base_sha256].split(",") if s} <= set(spans)
    if not which:
        other = {k.split(":")[0] for r in rows for k in r.spans.split(",")}
        assert {"iban", "ssn", "local_phone"} <= other
        assert next(r.spans for r in rows if r.doc_id == 12) == ""  # no context, too low a score


def test_pii_redacts(odd):
    rows = {r.doc_id: r for r in pii.redacted(odd).collect()}
    assert rows[7].text == "mail [EMAIL], [PHONE] [CARD] from [IP] or 1.2.3.256.7"
    assert rows[7].n_chars == len(rows[7].text)
    assert rows[0].text is None and rows[1].text == ""


def quality_rows(t):
    w = WORDS(t or "")
    lines = [x for x in (t or "").split("\n") if WORDS(x)]
    c = Counter(zip(w, w[1:], w[2:]))
    hit = {j for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(hit), failed


@pytest.mark.parametrize("which", [0, 1])
def test_quality(odd, documents, which):
    docs = both(odd, documents)[which]
    rows = quality.quality(docs).collect()
    want = Counter((r.doc_id, *quality_rows(r.text)) for r in docs.collect())
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows) == want
    assert not any(r.kept and r.base_failed for r in rows)
    good = quality.good_documents(docs)
    assert good.columns == docs.columns and good.count() == sum(r.kept for r in rows)


def prose(i, n, every=0):
    """n words without repeats, with a symbol after each of ``every`` words."""
    return " ".join(f"w{(i * 7919 + j * j) % 997}x{j}" + (" #" if every and j % every == 0 else "") for j in range(n))


QUALITY = "doc_id long, text string, lang string, source string"


def test_quality_thresholds(spark):
    """What is usual in one group is too much in another: the same text stays here and goes there."""
    rows = [(i, prose(i, 300), "en", "plain") for i in range(400)] + [(1000 + i, prose(i, 300, 8 + i % 5), "en", "symbols") for i in range(400)]
    same = prose(5000, 600, 9)
    rows += [(5000, same, "en", "plain"), (5001, same, "en", "symbols"), (5002, prose(5002, 600, 1), "en", "symbols")]
    got = {r.doc_id: r.kept for r in quality.quality(spark.createDataFrame(rows, QUALITY), prior=10.0).collect()}
    assert (got[5000], got[5001], got[5002]) == (False, True, False)
    assert all(v for i, v in got.items() if i < 5000)


def test_quality_lower_limit(spark):
    """Word length can be too low as well as too high, by language."""
    long = lambda i, n, k: " ".join(f"{(i * 31 + j) % 9973:05d}"[: 5] + "x" * k for j in range(n))
    rows = [(i, long(i, 200, 4 + (i % 10 == 0)), "de", "a") for i in range(300)] + [(1000 + i, long(i, 200, 1 - (i % 10 == 0)), "en", "a") for i in range(300)]
    rows += [(5000, long(7, 200, 1), "de", "a"), (5001, long(7, 200, 1), "en", "a"), (5002, long(7, 200, 4), "en", "a"), (5003, long(7, 200, 4), "de", "a")]
    got = {r.doc_id: r.kept for r in quality.quality(spark.createDataFrame(rows, QUALITY), prior=1.0).collect()}
    assert [got[5000 + k] for k in range(4)] == [False, True, False, True]


def test_quality_is_not_fixed(documents):
    """Limits differ between groups, and with them the verdicts differ from any one limit for all."""
    m = quality.measures(documents)
    limits = quality.thresholds(m).collect()
    assert len({round(r.max_word_length, 3) for r in limits}) > 0.9 * len(limits)
    for c in ("symbols", "repeats", "dup_lines"):
        assert len({round(r[f"max_{c}"], 6) for r in limits}) > 0.3 * len(limits)


def test_quantiles_are_close(spark):
    """A quantile off a sketch is within its bin of the one off all values, whatever their size."""
    r = np.random.default_rng(3)
    values = np.concatenate([r.integers(0, 100, 300), r.integers(0, 10**6, 300), r.integers(0, 10**12, 301)])
    rows = spark.createDataFrame([(int(v),) for v in values], "v long").selectExpr("'m' as measure", f"v - v % {quality._width('v')} as bin").groupBy("measure", "bin").count().withColumnRenamed("count", "n")
    (got,) = quality._quantiles(rows, []).collect()
    for q, x in ((0.25, got.q25), (0.75, got.q75)):
        want = np.sort(values)[int(np.ceil(q * len(values))) - 1]
        assert abs(x - want) <= max(1, want / 128)


def test_sketches_merge(documents):
    m = quality.measures(documents).cache()
    whole = {(r.lang, r.source, r.measure, r.bin): r.n for r in quality.sketches(m).collect()}
    parts = Counter()
    for k in (0, 1):
        for r in quality.sketches(m.where(f"doc_id % 2 = {k}")).collect():
            parts[(r.lang, r.source, r.measure, r.bin)] += r.n
    assert whole == parts


def brute_fingerprint(t, k=3):
    w = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    w = WORDS(w)
    s = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def brute_components(fps, far):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in combinations(range(len(fps)), 2):
        if bin(fps[i] ^ fps[j]).count("1") <= far:
            root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("which", [0, 1])
def test_simhash(odd, documents, which):
    docs = both(odd, documents)[which]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    fps = [brute_fingerprint(t) for _, t in rows]
    least = defaultdict(list)
    for (i, _), c in zip(rows, comps := brute_components(fps, 2)):
        least[c] += [i] if i is not None else []
    want = Counter((i, f"{f:016x}", min(least[c], default=None)) for (i, _), f, c in zip(rows, fps, comps))
    assert Counter(map(tuple, simhash.near_duplicates(docs).collect())) == want


@pytest.mark.parametrize("far,segments,crowd", [(2, 2, 64), (2, 2, 1), (3, 3, 2), (3, 2, 0), (1, 2, 1), (0, 1, 1)])
def test_simhash_pairs(spark, far, segments, crowd):
    from docweave.llm.common import components

    r = np.random.default_rng(far)
    fps = [0, -1, 1 << 62, -(1 << 63)]
    for c in r.integers(-(1 << 63), 1 << 63, 12).tolist():
        fps += [c ^ int(sum(1 << int(b) for b in set(r.integers(0, 63, k % 5)))) for k in range(12)]
    fps = sorted(set(fps))
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    roots = {x.node: x.root for x in components(simhash.near_pairs(df, far, segments, crowd)).collect()}
    mask = (1 << 64) - 1
    comps, groups = brute_components([f & mask for f in fps], far), defaultdict(list)
    for f, c in zip(fps, comps):
        groups[c].append(f)
    assert {f: roots.get(f, f) for f in fps} == {f: min(g) for g in groups.values() for f in g}


def brute_targets(sizes, weights=(3, 1, 2)):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    full, total = set(), 1.5 * sum(sizes.values())
    while True:
        left = {s: w[s] for s in order if s not in full}
        unit = (total - sum(2 * sizes[s] for s in full)) / sum(left.values()) if left else 0
        over = {s for s in left if unit * w[s] > 2 * sizes[s]}
        if not over:
            return {s: 2.0 * sizes[s] if s in full else unit * w[s] for s in order}
        full |= over


@pytest.mark.parametrize("which", [0, 1])
def test_mixing(odd, documents, which):
    docs = both(odd, documents)[which]
    rows, again = mixing.mix(docs).collect(), mixing.mix(docs.repartition(5)).collect()
    assert Counter(rows) == Counter(again)
    assert Counter((r.doc_id, r.size) for r in rows) == Counter((r.doc_id, len(WORDS(r.text or ""))) for r in docs.collect())
    source, sizes, longest, taken, target = {}, Counter(), Counter(), Counter(), {}
    for r in docs.collect():
        n = len(WORDS(r.text or ""))
        sizes[r.source] += n
        longest[r.source] = max(longest[r.source], n)
        source[r.doc_id, n] = r.source
    want = brute_targets(sizes)
    for r in rows:
        s = source[r.doc_id, r.size]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s]) and 0 <= r.taken <= 2 * r.size
        assert r.size == 0 or r.taken % r.size == 0
        taken[s] += r.taken
    for s in want:
        assert abs(taken[s] - want[s]) <= max(longest[s], 0.05 * want[s])
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    got = Counter()
    for r in mixed.collect():
        got[r.doc_id, r.source] += len(WORDS(r.text or ""))
    want_words = Counter()
    for r in rows:
        want_words[r.doc_id, source[r.doc_id, r.size]] += r.taken
    assert +got == +want_words


def brute_mix(rows, groups):
    """Copies of rows by sorting each stratum by (rank, row); also by u in place of the rank."""
    members = defaultdict(list)
    for r in rows:
        members[r.no_source, r.source_key, r["class"]].append(r)
    by_rank, by_u = {}, {}
    for g in groups:
        own = members.pop((g.no_source, g.source_key, g["class"]))
        for out, value in ((by_rank, lambda r: r.rank), (by_u, lambda r: r.u)):
            for k, r in enumerate(sorted(own, key=lambda r: (value(r), r.row))):
                out[r.row] = g.whole + (k < g.take)
        expected = 0
        for r in own:
            s = (r.weight - g.middle) / g.reach if g.reach else 0
            p = g.f * (1 + g.b * s)
            assert -1e-9 <= p <= 1 + 1e-9
            if p > 0:
                odds = r.u / (1 - r.u) / (p / (1 - p)) if p < 1 else 0
                assert r.rank == pytest.approx(odds / (1 + odds))
            expected += p
        assert g.n_docs == len(own) and abs(g.take - expected) <= 1 + 1e-9
    assert not members
    return by_rank, by_u


@pytest.mark.parametrize("which", [0, 1, 2])
def test_pareto_order(spark, odd, documents, which):
    """The same rows as by sorting; ranks are not their random numbers' order; ties end where the sample does."""
    from pyspark.sql import functions as F

    tied = spark.createDataFrame([(None if i % 2 else 7, "one two two three", "a") for i in range(500)] + [(i, "w " * 50, "b") for i in range(300)], "doc_id long, text string, source string").repartition(7)
    docs = [odd, documents, tied][which]
    rows = mixing._rows(docs, "doc_id", "text", "source", [])
    groups = mixing.strata(rows)
    ranked = mixing._ranked(rows, groups, 7).withColumn("u", mixing.uniform(7, F.col("id"), F.col("size"), F.col("text_hash")))
    by_rank, by_u = brute_mix(ranked.collect(), groups.collect())
    got = {r.row: r.copies for r in mixing.copied(rows).collect()}
    assert got == by_rank
    if which == 1:
        assert sum(by_u[r] != n for r, n in by_rank.items()) > 20


def test_inclusion_follows_weight(spark):
    """Over many seeds documents are taken in proportion to their inclusion probabilities, which grow with their weight."""
    texts = [" ".join(f"w{j % (5 + 2 * (i % 6))}" for j in range(16)) for i in range(120)]
    docs = spark.createDataFrame([(i, t + f" x{i}", "a" if i % 4 else "b") for i, t in enumerate(texts)], "doc_id long, text string, source string").coalesce(1)
    rows = mixing._rows(docs, "doc_id", "text", "source", []).cache()
    total, seeds = Counter(), 40
    groups = mixing.strata(rows).cache()
    p = {}
    for r in mixing._ranked(rows, groups, 0).collect():
        p[r.id] = r.whole + r.f * (1 + r.b * ((r.weight - r.middle) / r.reach if r.reach else 0))
    for seed in range(seeds):
        for r in mixing._ranked(rows, groups, seed).collect():
            total[r.id] += r.whole  # one more for those whose rank is among the first
        by = defaultdict(list)
        for r in mixing._ranked(rows, groups, seed).collect():
            by[r.no_source, r.source_key, r["class"]].append((r.rank, r.row, r.id, r.take))
        for group in by.values():
            for _, _, i, _ in sorted(group)[: group[0][3]]:
                total[i] += 1
    high, low = [i for i in p if p[i] % 1 > 0.6], [i for i in p if 0 < p[i] % 1 < 0.4]
    assert high and low
    for part in (high, low):
        assert np.mean([total[i] / seeds - p[i] for i in part]) == pytest.approx(0, abs=0.06)


@pytest.mark.parametrize("which", [0, 1])
def test_packing(odd, documents, which):
    import public_tokenizers
    from tokenizers import Tokenizer

    docs = both(odd, documents)[which]
    encode = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode
    want = Counter()
    for r in docs.collect():
        ids = np.array([*encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        for no, at in enumerate(range(0, len(ids), 2048)):
            want[r.doc_id, no, at, len(ids[at : at + 2048]), zlib.crc32(ids[at : at + 2048].tobytes())] += 1
    rows = packing.packed(docs, group=300).collect()
    assert Counter(tuple(r)[:5] for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in rows)
    assert len(bins) <= max(-(-total // 2048) * 1.03 + 3, 1)


def test_certificate(spark):
    """Exchange between groups ends close to the bound for all pieces, and the certificate says how close."""
    r = np.random.default_rng(4)
    for sizes, exact in ((r.integers(1, 2049, 6000), False), (np.tile([1024, 1024], 1500), True), (r.integers(1, 300, 5000), True), (np.zeros(0, int), True)):
        docs = spark.createDataFrame([(1, 0, 0, int(n), 7) for n in sizes], packing.PIECES).repartition(5)
        pieces = packing.materialise(docs.selectExpr("*", "monotonically_increasing_id() as row"), "test")
        out = packing.pack(pieces, group=500)
        got = out.collect()
        used = len({x.sequence_id for x in got})
        assert len(got) == len(sizes) and sorted(x.length for x in got) == sorted(sizes.tolist())
        found = packing.certificate(out).collect()
        if not len(sizes):
            assert not found
            continue
        (c,) = found
        assert (c.pieces, c.ids, c.sequences, c.bound) == (len(sizes), sizes.sum(), used, packing.lower_bound(sizes))
        assert c.certified == (used == c.bound) and c.certified >= exact and used <= 1.015 * c.bound + 2


def test_other_tokenizer(spark, documents):
    """A file whose rules of cutting are others gives its own ids too."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    encode = Tokenizer.from_file(path).encode
    docs = documents.limit(40)
    want = Counter((r.doc_id, len(encode(r.text or "", add_special_tokens=False).ids) + 1) for r in docs.collect())
    got = Counter()
    for r in packing.token_pieces(docs, path).collect():
        got[r.doc_id] += r.length
    assert Counter(got.items()) == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=9))
def test_lower_bound(sizes):
    sizes = np.array(sizes, np.int64)
    _, _, n = packing.best_fit_decreasing(sizes, 40)
    best = n
    bins = []

    def place(i):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(sizes):
            best = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + sizes[i] <= 40:
                bins[k] += sizes[i]
                place(i + 1)
                bins[k] -= sizes[i]
        bins.append(sizes[i])
        place(i + 1)
        bins.pop()

    place(0)
    assert packing.lower_bound(sizes, 40) <= best <= n


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([*"abBZ'sdt9# \n\t\x0b\x1c\x85 éÉßİıΣςé中😀ﬀ_-<|>", "<|endoftext|>", "'ll", "²"]), max_size=30).map("".join))
def test_tokenizer(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    global plain, ours
    if "ours" not in globals():
        plain, ours = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), packing.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"), 50)
    for got in ours.batch([text, "", text]):
        assert got == b"" or np.frombuffer(got, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
    assert ours.batch([text])[0] or not plain.encode(text, add_special_tokens=False).ids


def own_columns(df):
    """Rows of a table as they were before, by the number that the clashing columns hold."""
    from conftest import CLASHING

    for r in df.collect():
        key = "null" if r.doc_id is None else str(r.doc_id)
        assert all(r[c] == f"{c}-{key}" for c in CLASHING)
        yield r


def test_clashing_columns(clashing):
    """Operators that hand rows on leave other columns alone whatever they are called, and take the same rows as without them."""
    plain = clashing.select("doc_id", "text", "lang", "source", "n_chars")
    thin = lambda df: Counter((r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in df)
    for operator in (quality.good_documents, lambda d: simhash.one_of_each(d, shingle=5, similarity=0.8), simhash.one_of_each, pii.redacted, mixing.mixed_documents):
        out = operator(clashing)
        assert out.columns == clashing.columns
        assert thin(own_columns(out)) == thin(operator(plain).collect())
    for operator in (quality.quality, simhash.near_duplicates, pii.personal_data, mixing.mix, packing.packed):
        assert Counter(operator(clashing).collect()) == Counter(operator(plain).collect())


def test_many_spans(spark):
    """100,000 spans of one text take seconds, not hours; the same for putting their kinds in their place."""
    import time

    n = 100_000
    text = " ".join(f"10.{i % 250}.{i // 250 % 250}.7" if i % 2 else f"call (555) {i % 900 + 100}-{i % 9000 + 1000}" for i in range(n))
    docs = spark.createDataFrame([(1, text, 5)], "doc_id long, text string, n_chars long")
    began = time.time()
    (r,) = pii.personal_data(docs).collect()
    assert r.n_ip == n // 2 and r.n_other == n // 2
    (r,) = pii.redacted(docs).collect()
    assert r.text == " ".join("[IP]" if i % 2 else "call [LOCAL_PHONE]" for i in range(n)) and r.n_chars == len(r.text)
    assert time.time() - began < 120


def merged(base, more):
    return sorted(base + [e for e in more if not any(b[0] < e[2] and e[0] < b[2] for b in base)])


def test_merged_spans(spark):
    import random

    from pyspark.sql import functions as F

    r = random.Random(2)

    def some(kinds, n):
        out = []
        for _ in range(n):
            a = r.randrange(400)
            out.append((a, r.choice(kinds), a + r.randrange(1, 9), "k", 1.0))
        return out

    pairs = [(some(range(4), r.randrange(40)), some(range(4, 9), r.randrange(40))) for _ in range(60)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], f"i int, base {pii.NONE}, more {pii.NONE}")
    for x in df.select("i", pii._merged(F.col("base"), F.col("more")).alias("all")).collect():
        assert [tuple(e) for e in x["all"]] == merged(*pairs[x.i])


def test_empty_tables(none):
    for df in (pii.personal_data(none), quality.quality(none), simhash.near_duplicates(none), mixing.mix(none), packing.packed(none), pii.redacted(none), quality.good_documents(none), mixing.mixed_documents(none)):
        assert df.count() == 0
