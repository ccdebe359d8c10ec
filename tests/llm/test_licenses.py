import random
from itertools import combinations

from hypothesis import given, settings
from hypothesis import strategies as st

from docweave.llm import licenses


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 12), max_size=9))
def test_longest_increasing(values):
    got = [values[i] for i in licenses.longest_increasing(values)]
    best = max(k for k in range(len(values) + 1) if any(all(a < b for a, b in zip(c, c[1:])) for c in combinations(values, k)))
    assert len(got) == best and all(a < b for a, b in zip(got, got[1:]))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcde"), max_size=12), st.lists(st.sampled_from("abcde"), max_size=12))
def test_align(a, b):
    pairs = licenses.align(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))
    if a == b:
        assert len(pairs) == len(a)


def brute_alignments(a, b, i=0, j=0):
    """All alignments that patience allows: equal ends, then any longest chain of words unique in both, then the gaps."""
    head = []
    while a and b and a[0] == b[0]:
        head.append((i, j))
        a, b, i, j = a[1:], b[1:], i + 1, j + 1
    tail = []
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
        tail.insert(0, (i + len(a), j + len(b)))
    words = [w for w in a if a.count(w) == 1 and b.count(w) == 1]
    places = [(a.index(w), b.index(w)) for w in words]
    chains = [c for k in range(len(places), 0, -1) for c in combinations(places, k) if all(x[1] < y[1] for x, y in zip(c, c[1:]))]
    out = set()
    for chain in [c for c in chains if len(c) == len(chains[0])] or [()]:
        parts, a0, b0 = {()}, 0, 0
        for x, y in [*chain, (len(a), len(b))] if chain else []:
            inside = brute_alignments(a[a0:x], b[b0:y], i + a0, j + b0)
            here = ((i + x, j + y),) if (x, y) in chain else ()
            parts = {p + q + here for p in parts for q in inside}
            a0, b0 = x + 1, y + 1
        out |= {tuple(head) + p + tuple(tail) for p in parts}
    return out


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from("abcdefg"), max_size=8), st.lists(st.sampled_from("abcdefg"), max_size=8))
def test_align_is_patience(a, b):
    assert tuple(licenses.align(a, b)) in brute_alignments(a, b)


def test_whole_texts(spark):
    """Whole licence files with a name and a year filled in, rewrapped, or with a clause left out."""
    import textwrap

    def file(name, drop=""):
        return "Copyright (c) 2020 Jane Roe\n\n" + "\n".join(textwrap.wrap(licenses.TEMPLATES[name].replace(drop, ""), 60)) + "\n\nint main() { return 0; }\n" * 40

    rows = [(0, file("MIT-text")), (1, file("ISC-text").upper()), (2, file("BSD-2-Clause-text")), (3, file("BSD-3-Clause-text")), (4, file("MIT-text", "merge, publish, distribute, "))]
    got = {r.doc_id: {f.license: f.coverage for f in r.finds} for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, name in enumerate(("MIT-text", "ISC-text", "BSD-2-Clause-text", "BSD-3-Clause-text")):
        assert got[i] == {name: 1.0}
    assert 0.97 < got[4]["MIT-text"] < 1


def test_deep_alignment():
    a = [f"w{i}" for i in range(20000)]
    b = [w for i, w in enumerate(a) if i % 3] + ["x"] * 5
    assert len(licenses.align(a, b)) == sum(1 for i in range(20000) if i % 3)


def test_planted(spark):
    """Every template, whole or with words changed, between random words; clean texts have none."""
    r = random.Random(4)
    prose = lambda n: " ".join(r.choice(["the", "of", "license", "under", "public", "version", f"w{r.randrange(900)}"]) for _ in range(n))
    rows, want = [], {}
    for name, text in licenses.TEMPLATES.items():
        for change in (0, 1):
            w = text.split()
            if change and len(w) > 12:
                for i in r.sample(range(1, len(w) - 1), len(w) // 12):
                    w[i] = "zzz"
            want[len(rows)] = name
            rows.append((len(rows), f"{prose(40)}. {' '.join(w)}\n{prose(300)}"))
    clean = len(rows)
    rows += [(len(rows), prose(2000)), (len(rows) + 1, None), (len(rows) + 2, ""), (len(rows) + 3, "Released under the MIT License. " * 3), (None, "Released under the MIT License.")]
    got = {x.doc_id: x for x in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, name in want.items():
        assert got[i].best_license == name or name in {f.license for f in got[i].finds}, (name, got[i])
    assert [got[clean + k].n_licenses for k in range(4)] == [0, 0, 0, 3] and got[None].best_license == "MIT"
    (f,) = got[0].finds
    assert f.end_word - f.first_word == len(licenses.words(licenses.TEMPLATES["Apache-2.0"]))


def test_lines_of_documents(documents, odd, none):
    """The licence lines of the table are found in just the texts that hold them."""
    lines = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0", "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT"}
    want = {(r.doc_id, next((n for x, n in lines.items() if x in r.text), None)) for r in documents.collect()}
    assert {(r.doc_id, r.best_license) for r in licenses.scan(documents).collect()} == want
    assert licenses.digests(odd).count() == odd.count() and licenses.scan(none).count() == 0


def test_every_offset():
    """A stretched notice is found wherever it starts, and the same words of it each time."""
    scanner = licenses.Scanner(licenses.TEMPLATES, 0.8, 1.5)
    for name, template in scanner.templates.items():
        m = len(template)
        middle = m // 2
        notice = template[:middle] + ["zzz"] * (m // 2) + template[middle:]
        for offset in range(2 * m + 1):
            text = " ".join(["qqq"] * offset + notice + ["qqq"] * (3 * m))
            assert (offset, offset + len(notice), name, 1.0) in scanner.finds(text), (name, offset)
