import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from docweave.llm import chat, embeddings

TURNS = "conv_id long, turn long, role string, text string, pieces string"


def digest(s):
    return hashlib.sha256(s.encode()).hexdigest()


def test_chat(spark, sf_dir):
    nasty = [r"\</s>", "<s></s>", "[INST]", r"[\INST]", r"\\[/INST]\\", "<<SYS>>x<</SYS>>", None, "", "<", "[", "\\", "</s", "/s>", "[INST] [/INST]", r"<\/s>", "ab😀é\n\n"]
    rows = [(1, i, ("user", "assistant", "system", "</s>", None, "a\\")[i % 6], t, "x") for i, t in enumerate(nasty * 2)]
    rows += [(2, 0, "assistant", "same", ""), (2, 0, "assistant", "same", ""), (2, None, "user", None, None), (3, 1, "user", "b", ""), (3, 1, "assistant", "a", ""), (None, None, None, None, None)]
    odd = spark.createDataFrame(rows, TURNS)
    for turns in (odd, spark.read.parquet(f"{sf_dir}/conversations.parquet")):
        convs = defaultdict(list)
        for r in chat.planted(turns).collect():
            convs[r.conv_id].append(((r.turn is not None, r.turn or 0), r.role or "", r.text or ""))
        got = {r.conv_id: r for r in chat.digests(chat.planted(turns)).collect()}
        assert got.keys() == convs.keys()
        for c, t in convs.items():
            t.sort()
            loss = "".join(x for _, role, x in t if role == "assistant")
            r = got[c]
            assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(t), digest("".join(f"{role}\n{x}\n" for _, role, x in t)), len(loss), digest(loss)), c
            assert r.n_examples == sum(role == "assistant" for _, role, _ in t)


def test_chat_examples(spark):
    turns = spark.createDataFrame([(1, 0, "user", "</s>hi"), (1, 1, "assistant", "yo"), (1, 2, "user", "more"), (1, 3, "assistant", "ok")], "conv_id long, turn long, role string, text string")
    rows = sorted(chat.texts(chat.expanded(chat.formatted(turns))).collect(), key=lambda r: r.number)
    assert [r.text for r in rows] == ["<s>[INST]user[/INST]<\\/s>hi</s>[INST]assistant[/INST]yo</s>", "<s>[INST]user[/INST]<\\/s>hi</s>[INST]assistant[/INST]yo</s>[INST]user[/INST]more</s>[INST]assistant[/INST]ok</s>"]
    assert [r.text[r.loss_start : r.loss_end] for r in rows] == ["yo", "ok"] == [r.reply for r in rows]
    assert chat.digests(turns.limit(0)).count() == 0


def brute(rows, least):
    n = len(rows)
    links, root = [0] * n, list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ok = [v is not None and lab is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, lab in rows]
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= least:
                    links[i] += 1
                    links[j] += 1
                    root[find(i)] = find(j)
    low = defaultdict(list)
    for i in range(n):
        low[find(i)] += [rows[i][0]] if rows[i][0] is not None else []
    return Counter((rows[i][0], links[i], c := min(low[find(i)], default=None), rows[i][0] == c) for i in range(n))


def test_vectors(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    monkeypatch.setattr(embeddings, "TASK_ROWS", 200)
    r = np.random.default_rng(3)
    rows = []
    for c in range(6):
        base = r.standard_normal(16)
        rows += [(base + r.standard_normal(16) * s).tolist() for s in (0.05, 0.1, 0.13) for _ in range(12)]
    rows += [[0.0] * 16, None, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [], [1.0, 2.0], [2.0, 4.0], [1.0, 2.0], rows[0], (2 * np.array(rows[0])).tolist()]
    rows = [(i, v, [1, 1, 2, None][i % 4] if i < 200 else 1, "x") for i, v in enumerate(rows)]
    rows += [(5, rows[5][1], rows[5][2], "y"), (None, rows[9][1], rows[9][2], None), (None, None, None, None)]
    got = embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, gid string").repartition(3)).collect()
    f32 = [(i, v and [x if x is None else float(np.float32(x)) for x in v], lab) for i, v, lab, _ in rows]
    want = brute(f32, 0.98)
    miss = want - Counter(tuple(x) for x in got)
    assert sum(miss.values()) <= 0.02 * len(rows) and len(got) == len(rows)
    assert embeddings.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_vectors_recall(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding), r.label) for r in df.collect()]
    want, got = brute(rows, 0.98), Counter(map(tuple, embeddings.near_vectors(df).collect()))
    found, there = sum(x[1] * n for x, n in got.items()), sum(x[1] * n for x, n in want.items())
    assert there * 0.999 <= found <= there and sum((want - got).values()) <= 2


def test_key_plan():
    """Keys grow with the number of vectors, tables with the keys, and the probability of a miss stays."""
    plans = [embeddings.key_plan(n, 0.98) for n in (1, 500, 51_282, 10**6, 10**9)]
    assert plans == sorted(plans) and embeddings.key_plan(51_282, 0.98) == (18, 32)
    for bits, tables in plans:
        same = 1 - np.arccos(0.98) / np.pi
        assert (1 - same**bits) ** tables <= embeddings.MISS
    assert embeddings.key_plan(10**6, 0.5)[1] <= embeddings.MOST_TABLES and embeddings.key_plan(100, 1.0)[1] == 1


def test_recall_at_the_threshold(spark):
    """Of 2,000 pairs that are just at the threshold, among 10,000 other vectors, at most one is missed; none below it links."""
    r = np.random.default_rng(9)
    unit = lambda x: x / np.linalg.norm(x, axis=1)[:, None]
    a = unit(r.standard_normal((2000, 48)))
    turn = unit((x := r.standard_normal((2000, 48))) - (x * a).sum(axis=1)[:, None] * a)
    angle = np.arccos(r.uniform(0.9801, 0.983, 2000))[:, None]
    b = np.cos(angle) * a + np.sin(angle) * turn
    rest = unit(r.standard_normal((10_000, 48)))
    rows = [(i, v.tolist(), 1) for i, v in enumerate(np.concatenate([a, b, rest]))]
    got = {x.vec_id: x for x in embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)).collect()}
    assert sum(got[2000 + i].component_id != i for i in range(2000)) <= 1
    assert all(got[i].n_links == 0 for i in range(4000, 14_000))


def test_estimates_are_unbiased():
    """Over many rotations the estimate's mean is the cosine, and its bounds hold."""
    r = np.random.default_rng(1)
    a = r.standard_normal(32)
    b = a + 0.5 * r.standard_normal(32)
    v = np.array([a, b])
    cos = a @ b / np.linalg.norm(a) / np.linalg.norm(b)
    estimates = []
    for seed in range(300):
        turned, signs, factors, _ = embeddings.encode(v, seed, (18, 32))
        bits = turned.shape[1]
        e = ((2.0 * signs[0] - 1) @ turned[1]) / np.sqrt(bits) / factors[0]
        assert abs(e - cos) <= embeddings.SURE * np.sqrt(1 - factors[0] ** 2) / factors[0] / np.sqrt(bits - 1)
        estimates.append(e)
    assert np.mean(estimates) == pytest.approx(cos, abs=0.01)
