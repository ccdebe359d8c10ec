"""Golden vectors of the scalar functions."""

import difflib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docweave.functions import replies, similarity
from docweave.functions import text as T


def apply(spark, column, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.o for r in df.select("i", column(F.col("v")).alias("o")).orderBy("i").collect()]


FOUR = ["  Foo   'Bar' ", "'abc '", "a ' b", "a`b"]


@pytest.mark.parametrize(
    "column,values,want",
    [
        (T.entity_name, FOUR, ["foo bar", "abc", "a  b", "a`b"]),
        (T.eval_name, FOUR, ["foo bar", "abc ", "a  b", "ab"]),
        (T.slug, ["A+", "Größe", "日本", "C++ & C#", "", " _a _ b_ "], ["a", "gre", "x", "c_c", "x", "a_b"]),
        (T.relation_type, ["works-for", "  ", "2nd of", "über"], ["WORKS_FOR", "REL", "R_2ND_OF", "BER"]),
        (T.file_name, ["Skai TV", "St. Louis", "", "x" * 200], ["Skai_TV", "St._Louis", "doc", "x" * 120]),
        (T.before_dot, ["docred_0000_St._Louis.llm", "abc"], ["docred_0000_St", "abc"]),
        (T.newlines, [" a\r\nb\rc ", "  x "], ["a\nb\nc", "x"]),
        (T.match_text, ["x  foo\r\n bar　"], ["x foo bar"]),
        (T.folded, ["STRAßE"], ["strasse"]),
        (T.folded_exact, ["STRAßE", None], ["strasse", None]),
        (T.file_stem, ["a/b: c  d", "ü-1_.x"], ["a_b_ c d", "ü-1_.x"]),
        (T.domain_name, ["a b/ü"], ["a_b_ü"]),
        (lambda c: T.without_suffix(c, ".chunks", ".extractions"), ["a.chunks.b.chunks"], ["a.b"]),
        (lambda c: T.last_place(c, "\n\n"), ["a\n\nb\n\nc", "abc"], [4, -1]),
        (lambda c: T.preview(c, 5), [" ab\ncdef"], ["ab cd"]),
        (T.greedy_json, ['x {"a":1} y', "none", "[1] {2}"], ['{"a":1}', None, "[1]"]),
        (replies.verdict, ['{"verdict": "supported"}', "no", '{"verdict": "maybe"}', "[1]"], ["SUPPORTED", "UNSURE", "UNSURE", "UNSURE"]),
    ],
)
def test_vectors(spark, column, values, want):
    assert apply(spark, column, values) == want


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(max_size=12), min_size=1, max_size=20))
def test_strip_is_python_strip(spark, values):
    assert apply(spark, T.strip, values) == [v.strip() for v in values]


def test_all_spaces(spark):
    every = "".join(chr(i) for i in range(0x10000) if chr(i).isspace())
    assert apply(spark, T.strip, [every + "a" + every]) == ["a"] and apply(spark, T.one_spaced, ["a" + every + "b"]) == ["a b"]


def test_replies():
    assert replies.first_json('x {"a":1} y') == {"a": 1}
    assert replies.first_json('{"a":1} and {"b":2}') is None
    assert replies.first_json('Note [1]: {"a":1}') == [1]
    assert replies.first_json('[{"a":1}]') == [{"a": 1}]
    assert replies.extraction('{"entities": [{"id": 1, "name": null, "type": "T", "attributes": 3}, 5], "relations": []}') == (True, [("1", "T", "None", "{}", None)], [])
    assert replies.extraction("[1]") == (False, [], [])
    assert replies.segments('[{"start_paragraph": 0, "end_paragraph": "2"}]') == [(0, 2, None)]
    assert replies.segments('[{"start_paragraph": 0}]') is None and replies.segments("{}") is None
    assert replies.same('{"same": 1}') and not replies.same("{}") and not replies.same("[]")


def test_parsed_columns(spark):
    df = spark.createDataFrame([('{"entities": [{"id": "a", "type": "T", "name": "N", "attributes": {"k": 1.0}, "evidence": "e"}], "relations": [{"source_id": "a", "type": "r", "target_id": "a"}]}',), ("junk",), (None,)], "reply string")
    one, two, three = (r.x for r in df.select(replies.parse_extraction(F.col("reply")).alias("x")).collect())
    assert one.ok and one.entities[0].attributes == '{"k": 1.0}' and one.relations[0].evidence is None
    assert not two.ok and not three.ok
    (seg,) = spark.createDataFrame([('[{"start_paragraph": 0, "end_paragraph": 3, "topic": " t "}]',)], "reply string").select(replies.parse_segments(F.col("reply")).alias("s")).collect()
    assert seg.s[0].topic == "t" and seg.s[0].end_paragraph == 3


def test_similarity(spark):
    assert (similarity.ratio("tide", "diet"), similarity.ratio("diet", "tide")) == (0.25, 0.5)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abc", max_size=9), st.text(alphabet="abc", max_size=9))
def test_length_bound(a, b):
    ratio = difflib.SequenceMatcher(None, a, b).ratio()
    assert 2 * min(len(a), len(b)) >= ratio * (len(a) + len(b)) - 1e-9
