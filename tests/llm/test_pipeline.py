import random
import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from docweave.llm import mixing, packing, pii, simhash


def test_stages(spark, odd, sf_dir):
    docs = odd
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        if name != "packing":
            assert out.columns == docs.columns, name
        out = spark.createDataFrame(out.collect(), out.schema)
        if name == "quality rules":
            assert Counter(out.collect()) <= Counter(docs.collect())
            out = docs  # odd rows are to reach the other stages
        if name == "near-dedup":
            assert Counter(out.collect()) <= Counter(docs.collect())
            assert len({r.text for r in out.collect()}) == out.count()
        docs = out if name != "mixing" else out.cache()


WORDS = re.compile("[^\x20\x09-\x0d]+").findall


def brute_near_copies(rows, least):
    """Kept ids of rows (id, text): the least of each group that links of exact Jaccard similarity make; by an index of shingles."""
    sets = {}
    for i, t in rows:
        w = WORDS((t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) or frozenset([tuple(w)] if w else [])
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    where = defaultdict(list)
    for i, s in sets.items():
        for x in s or [()]:
            where[x].append(i)
    shared = Counter()
    for members in where.values():
        for k, i in enumerate(members):
            for j in members[:k]:
                shared[i, j] += 1
    for (i, j), n in shared.items():
        a, b = sets[i], sets[j]
        if a == b or n >= least * (len(a) + len(b) - n):
            x, y = find(i), find(j)
            root[max(x, y)] = min(x, y)
    return {i for i in root if find(i) == i}


def test_near_dedup_is_exact(documents):
    """The stage keeps what brute force over all pairs keeps."""
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    want = brute_near_copies(rows, 0.8)
    assert len(want) < len(rows)
    assert {r.doc_id for r in simhash.one_of_each(documents, shingle=5, similarity=0.8).collect()} == want


def test_quality_stage(spark, documents, sf_dir):
    """The stage keeps the rows that the query's SQL keeps."""
    from oracle import connect

    from docweave.llm import sql

    found = connect(sf_dir).execute(sql.SQL["op10_quality_rules"])
    at = [d[0] for d in found.description]
    want = {r[at.index("doc_id")] for r in found.fetchall() if r[at.index("kept")]}
    assert {r.doc_id for r in corpus_pipeline.quality_rules(spark, documents, sf_dir).collect()} == want


@pytest.mark.parametrize("which", [0, 1])
def test_redaction(spark, odd, documents, sf_dir, which):
    """Texts with spans cut out one by one, from the end."""
    docs = [odd.where("doc_id is not null").dropDuplicates(["doc_id"]), documents][which]
    spans = {r.doc_id: [(int(a), int(b), k) for k, a, b in (x.split(":") for x in r.spans.split(",") if x)] for r in pii.personal_data(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in corpus_pipeline.personal_data(spark, docs, sf_dir).collect():
        want, at, out = texts[r.doc_id], 0, ""
        for a, b, k in sorted(spans[r.doc_id]):
            if a >= at:
                out += f"{want[at:a]}[{k.upper()}]"
            at = max(at, b)
        assert r.text == (want if want is None else out + want[at:])
        if spans[r.doc_id]:
            assert r.n_chars == len(r.text)


def test_mixing_stage(spark, documents, sf_dir):
    """Each document as often as the query says."""
    want = Counter({r.doc_id: r.taken // r.size for r in mixing.mix(documents).collect() if r.size})
    got = Counter(r.doc_id for r in corpus_pipeline.mix_sources(spark, documents, sf_dir).collect())
    assert +got == +want


@pytest.mark.parametrize("hot", [3, 10_000])
def test_components(spark, monkeypatch, hot):
    """Chains, stars with hubs high and low, and random edges, with and without nodes dealt apart."""
    from docweave.llm import common

    monkeypatch.setattr(common, "HOT", hot)
    r = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + k) for k in range(1, 90)] + [(2000 - k, 2000) for k in range(1, 90)] + [(r.randrange(3000, 3200), r.randrange(3000, 3200)) for _ in range(120)] + [(5, 5)]
    r.shuffle(edges)
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {x.node: x.root for x in common.components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect()}
    assert got == {i: find(i) for i in root if find(i) != i}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_leaves_nothing(spark):
    """When the pipeline is done, only its last table is left in the shared folder."""
    import os
    from urllib.parse import urlparse

    from docweave.sources.shared import shared_folder

    folder = urlparse(shared_folder(spark)).path + "/docweave"
    os.makedirs(folder, exist_ok=True)
    before = set(os.listdir(folder))
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert {x.split("-")[0] + "-" + x.split("-")[1] for x in set(os.listdir(folder)) - before} == {"pipeline-4"}
    assert out.count() > 0


def test_run(spark, sf_dir):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    rows = out.collect()
    assert rows and max(r.offset + r.length for r in rows) <= packing.CAPACITY
    assert Counter(r.doc_id for r in rows if r.piece == 0).most_common(1)[0][1] <= 2


def test_empty(spark, none, sf_dir):
    docs = none
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0


def test_near_copies(spark, documents, monkeypatch):
    """Copies with a word in a hundred changed go, whatever the size of their group; unlike texts stay."""
    monkeypatch.setattr(simhash, "BLOCK", 8)
    monkeypatch.setattr(simhash, "TASK_ROWS", 500)
    r = random.Random(6)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "ru", "te") for b in range(200)]
    texts = {i: [r.choice(words) for _ in range(r.randrange(80, 500))] for i in range(40)}
    rows = [(i, " ".join(t), 0) for i, t in texts.items()]
    for i, t in texts.items():
        for k in range(30 if i == 7 else i % 3):
            t = list(texts[i])
            for place in r.sample(range(len(t)), max(1, len(t) // 100)):
                t[place] = f"changed{k}"
            rows.append((1000 * (i + 1) + k, " ".join(t), 0))
    rows += [(90000, None, 0), (90001, "", 0), (90002, "one", 0), (90003, rows[0][1], 0), (90003, rows[0][1], 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, root int").repartition(3)
    kept = sorted(x.doc_id for x in simhash.one_of_each(docs, shingle=5, similarity=0.8).collect())
    assert [i for i in kept if i < 1000] == list(range(40))
    late = [i for i in kept if 1000 <= i < 90000]
    assert len(late) <= 2 and [i for i in kept if i >= 90000] == [90000, 90002]
    exact = simhash.one_of_each(docs, shingle=5)
    assert exact.where("doc_id = 90003").count() == 0 and exact.columns == docs.columns


def test_threshold(spark, monkeypatch):
    """Pairs whose shingle sets have a similarity of 0.8 or more, from right there up, lose one; pairs below lose none."""
    monkeypatch.setattr(simhash, "TASK_ROWS", 500)
    r = random.Random(8)
    sets = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    rows, alike = [], {}
    for i in range(600):
        a = [f"w{r.randrange(10**6)}" for _ in range(r.choice([8, 30, 100, 300]))]
        b = list(a)
        goal = r.choice([0.72, 0.76, 0.81, 0.82, 0.84, 0.88])
        for k in range(100):
            c = list(b)
            if k == 0 and len(a) == 8:
                c.append("more")  # four of five shingles: 0.8
            else:
                c[r.randrange(len(c))] = f"changed{i}-{k}"
            if len(sets(a) & sets(c)) < goal * len(sets(a) | sets(c)) and not len(a) == 8:
                break
            b = c
            if len(a) == 8:
                break
        if goal < 0.8 and len(a) > 8:
            b = c  # the first one below the goal
        x, y = sets(a), sets(b)
        alike[i] = 5 * len(x & y) >= 4 * len(x | y)
        rows += [(2 * i, " ".join(a)), (2 * i + 1, " ".join(b))]
    assert 200 < sum(alike.values()) < 500
    kept = {x.doc_id for x in simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), shingle=5, similarity=0.8).collect()}
    assert {i for i in alike if 2 * i + 1 not in kept} == {i for i in alike if alike[i]}
    assert all(2 * i in kept for i in alike)
