"""Entity resolution: mentions to canonical entities, local relations to global ones.

Mentions arrive in the order (row_pos, ent_pos).  With fuzzy matching the
first name of an entity, its leader, decides what joins it:

1. Leaders.  Among the distinct names of a (base, type), in order of first
   occurrence, a name leads unless an earlier leader is similar enough.  Only
   this is sequential, and only over distinct names.
2. Assignment.  A mention whose name leads belongs to that leader; any other
   to the most similar leader that came before the mention, the earlier one on
   ties.  Leaders that are similar enough are scored once for every name, where
   the letters that two names share allow it, and a mention takes a minimum.
3. Folds over each entity's mentions.
"""

from __future__ import annotations

import difflib
import math
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.shared import stored


def named(mentions: DataFrame, strict: bool = True) -> DataFrame:
    """mentions (base, row_pos, ent_pos, chunk_id, id, type, name, attributes, evidence) that have a local id, with norm and ord.

    A mention without type or name can't be filed: an error, or without strict
    left out.
    """
    x = mentions.withColumns({c: T.strip(F.coalesce(c, F.lit(""))) for c in ("id", "type", "name")}).where("id <> ''")
    fine = (F.col("type") != "") & (F.col("name") != "")
    x = x.withColumn("name", F.when(fine, F.col("name")).otherwise(F.raise_error(F.lit("entity without type or name")).cast("string"))) if strict else x.where(fine)
    return x.withColumn("norm", T.entity_name(F.col("name"))).withColumn("ord", F.struct("row_pos", "ent_pos"))


def exact(mentions: DataFrame, strict: bool = True) -> DataFrame:
    """named() with leader, the name that an entity is filed under: its own."""
    return named(mentions, strict).withColumn("leader", F.col("norm"))


#: Distinct names that a task is planned for.
TASK_NAMES = 20_000


#: Leaders of one length up to which all of them are scored by their letters; an index costs more than it saves there.
FEW = 64


class _Index:
    """Leaders of one length by keys, of which names that are similar enough share some, whichever characters differ."""

    def __init__(self, keys: Callable[[str], Iterable]):
        self.keys, self.at, self.places = keys, 0, {}

    def fill(self, numbers: array, norms: list[str]) -> None:
        for i in range(self.at, len(numbers)):
            for key in self.keys(norms[numbers[i]]):
                self.places.setdefault(key, array("i")).append(i)
        self.at = len(numbers)

    def found(self, keys: Iterable) -> np.ndarray:
        """Places of leaders in the order of their numbers, as often as they have these keys."""
        met = [np.frombuffer(p, np.intc) for p in map(self.places.get, keys) if p]
        return np.concatenate(met) if met else np.empty(0, np.intc)


def _grams(name: str, q: int) -> list[str]:
    return [name[i : i + q] for i in range(len(name) - q + 1)]


def _without_one(name: str) -> set[int]:
    """What is left without one character, as hashes; equal hashes of others are only looked at in vain."""
    return {hash(name[:i] + name[i + 1 :]) for i in range(len(name))}


class _Leaders:
    """Leaders of a group so far, and which of them a name can be similar to.

    Matching characters are a common subsequence, so with names of a and b
    characters that match in m at least, a leader has a - m others at most and
    the name b - m.  If either is 1 at most, both share what is left without
    those.  Else each of the leader's others breaks q of its q-grams at most,
    each of the name's q - 1, and the name has all the rest.  Where that leaves
    none, and for a few leaders, all are looked at.  Letters' counts then bound
    the similarity from above.
    """

    def __init__(self, names: list[str], least: float):
        self.least, self.letters = least, {c: i for i, c in enumerate(sorted(set("".join(names))))}
        self.norms: list[str] = []
        self.matchers: list[difflib.SequenceMatcher | None] = []
        self.counts, self.sizes = np.zeros((16, len(self.letters)), np.int32), np.zeros(16, np.int64)
        self.of_length: dict[int, array] = {}
        self.indices: dict[tuple[int, str, int], _Index] = {}

    def count(self, name: str) -> np.ndarray:
        return np.bincount([self.letters[c] for c in name], minlength=len(self.letters)).astype(np.int32) if name else np.zeros(len(self.letters), np.int32)

    def add(self, name: str, count: np.ndarray) -> None:
        n = len(self.norms)
        if n == len(self.sizes):
            self.counts, self.sizes = np.concatenate([self.counts, np.zeros_like(self.counts)]), np.concatenate([self.sizes, np.zeros_like(self.sizes)])
        self.counts[n], self.sizes[n] = count, len(name)
        self.norms.append(name)
        self.matchers.append(None)
        self.of_length.setdefault(len(name), array("i")).append(n)

    def index(self, length: int, kind: str, k: int, keys: Callable[[str], Iterable]) -> _Index:
        index = self.indices.setdefault((length, kind, k), _Index(keys))
        index.fill(self.of_length[length], self.norms)
        return index

    def near(self, name: str, length: int) -> np.ndarray | None:
        """Places of the leaders of a length, by their numbers, that name can be similar to; None for all."""
        least = max(0, math.ceil(self.least * (length + len(name)) / 2 - 1e-9))
        mine, theirs = len(name) - least, length - least
        if min(mine, theirs) < 0:
            return np.empty(0, np.intc)
        if len(self.of_length[length]) <= FEW:
            return None
        if max(mine, theirs) <= 1:
            keys = lambda k: _without_one if k else lambda x: [hash(x)]
            return np.unique(self.index(length, "without", theirs, keys(theirs)).found(keys(mine)(name)))
        # Of the lengths of q-grams the longest of which an eighth must be shared, or any.
        shared = lambda q: length + 1 + mine - q * (1 + theirs + mine)
        most = (length + mine) // (1 + theirs + mine)
        q = next((q for q in range(most, 0, -1) if 8 * shared(q) >= length), most)
        if q < 1:
            return None
        met = self.index(length, "grams", q, lambda x: _grams(x, q)).found(set(_grams(name, q)))
        if not len(met):
            return met
        if len(met) < len(self.of_length[length]) // 8:
            places, times = np.unique(met, return_counts=True)
            return places[times >= shared(q)]
        return np.flatnonzero(np.bincount(met) >= shared(q))

    def close(self, name: str, count: np.ndarray) -> Iterator[tuple[int, float]]:
        """(number, similarity) of the leaders that are similar enough, where the most letters are shared first."""
        if len(self.norms) <= FEW:
            some = np.arange(len(self.norms))
        else:
            met = [(np.frombuffer(numbers, np.intc), self.near(name, length)) for length, numbers in self.of_length.items()]
            some = np.concatenate([numbers if places is None else numbers[places] for numbers, places in met])
            del met  # arrays can't grow while they are looked at
        if not len(some):
            return
        # Letters are few: minima over them are taken a column at a time only where the name has them.
        has = np.flatnonzero(count)
        shared = np.minimum(self.counts[some[:, None], has], count[has]).sum(axis=1)
        bound = 2.0 * shared / np.maximum(self.sizes[some] + len(name), 1)
        fine = bound >= self.least - 1e-9
        some, bound = some[fine], bound[fine]
        for i in some[np.lexsort((some, -bound))].tolist():
            matcher = self.matchers[i]
            if matcher is None:
                # The second sequence is the one that a matcher indexes; the first may change at no cost.
                matcher = self.matchers[i] = difflib.SequenceMatcher(None, "", self.norms[i])
            matcher.set_seq1(name)
            score = matcher.ratio()
            if score >= self.least:
                yield i, score


#: Distinct names up to which a group's short names are found by keys that are kept as they are.
SHORT_NAMES = 20_000


class _ShortLeaders:
    """As _Leaders, for groups of a document's size: names so short that similar ones share what is left without a character of each at most.

    With names of b characters at most, of which two that are similar enough
    have b (2 - 2 least) / (2 - least) others at most, that is where this is
    less than 2.
    """

    @staticmethod
    def fit(names: list[str], least: float) -> bool:
        return len(names) <= SHORT_NAMES and max(map(len, names)) * (2 - 2 * least) < 2 * (2 - least) - 1e-6

    def __init__(self, least: float):
        self.least, self.norms, self.places = least, [], {}

    def count(self, name: str) -> set[str]:
        return {name, *(name[:i] + name[i + 1 :] for i in range(len(name)))}

    def add(self, name: str, keys: set[str]) -> None:
        for key in keys:
            self.places.setdefault(key, []).append(len(self.norms))
        self.norms.append(name)

    def close(self, name: str, keys: set[str]) -> Iterator[tuple[int, float]]:
        """(number, similarity) of the leaders that are similar enough, in any order."""
        for i in {i for key in keys for i in self.places.get(key, ())}:
            leader = self.norms[i]
            most = min(len(name), len(leader)) - (len(name) == len(leader) and name != leader)
            if 2.0 * most >= (self.least - 1e-9) * (len(name) + len(leader)):
                score = difflib.SequenceMatcher(None, name, leader).ratio()
                if score >= self.least:
                    yield i, score


def scored(names: DataFrame, least: float) -> DataFrame:
    """(base, type, norm, leader, score, leader_ord) of distinct names (base, type, norm, ord).

    A leader has one row, itself; any other name one for each leader that is
    similar enough, whichever came first.  Groups of names are dealt over as
    many tasks as their number asks for; a (base, type) is one task's work, as
    its leaders are elected one after the other, and memory holds its names.
    """
    schema = ", ".join(f"{c} {names.schema[f].dataType.simpleString()}" for c, f in (("base", "base"), ("type", "type"), ("norm", "norm"), ("leader", "norm"))) + ", score double, row_pos int, ent_pos int"

    def elect(norms: list[str]) -> Iterator[tuple[int, int, float]]:
        leaders = _ShortLeaders(least) if _ShortLeaders.fit(norms, least) else _Leaders(norms, least)
        places: list[int] = []
        others = []
        for i, name in enumerate(norms):
            count = leaders.count(name)
            if next(leaders.close(name, count), None) is None:
                leaders.add(name, count)
                places.append(i)
            else:
                others.append((i, name, count))
        yield from ((i, i, 1.0) for i in places)
        yield from ((i, places[k], score) for i, name, count in others for k, score in leaders.close(name, count))

    def elect_all(table: pa.Table) -> pa.Table:
        table = table.sort_by([("row_pos", "ascending"), ("ent_pos", "ascending")]).combine_chunks()
        norms = table["norm"].to_pylist()
        groups: dict[tuple, list[int]] = {}
        for i, key in enumerate(zip(table["base"].to_pylist(), table["type"].to_pylist())):
            groups.setdefault(key, []).append(i)
        own, led, scores = array("q"), array("q"), array("d")
        for at in groups.values():
            for i, k, score in elect([norms[i] for i in at]):
                own.append(at[i])
                led.append(at[k])
                scores.append(score)
        own, led = pa.array(np.frombuffer(own, np.int64)), pa.array(np.frombuffer(led, np.int64))
        mine, theirs = table.select(["base", "type", "norm"]).take(own), table.select(["norm", "row_pos", "ent_pos"]).take(led)
        return pa.Table.from_arrays([*mine.columns, theirs["norm"], pa.array(np.frombuffer(scores)), theirs["row_pos"], theirs["ent_pos"]], names=["base", "type", "norm", "leader", "score", "row_pos", "ent_pos"])

    # A document has few names of a type, so many of them share a task rather than each being a call of its own.
    flat = stored(names.select("base", "type", "norm", F.col("ord.row_pos").cast("int").alias("row_pos"), F.col("ord.ent_pos").cast("int").alias("ent_pos")), "names")
    tasks = max(int(names.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-flat.count() // TASK_NAMES))
    # By number, as sizes in bytes, by which Spark puts small partitions together, say nothing of the work.
    out = flat.withColumn("task", F.pmod(F.xxhash64("base", "type"), F.lit(tasks))).repartition(tasks, "task").groupBy("task").applyInArrow(elect_all, schema)
    return out.select("base", "type", "norm", "leader", "score", F.struct("row_pos", "ent_pos").alias("leader_ord"))


def fuzzy(mentions: DataFrame, least: float = 0.92, max_candidates: int = 25, strict: bool = True) -> DataFrame:
    """named() with leader by similarity of at least ``least``, as described above.

    Of the most similar max_candidates leaders only the first one matters, so
    without any (0) names resolve exactly.
    """
    if max_candidates <= 0:
        return exact(mentions, strict)
    x = named(mentions, strict)
    pairs = scored(x.groupBy("base", "type", "norm").agg(F.min("ord").alias("ord")), least)
    found = F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("leader_ord").alias("o"), F.col("leader").alias("l"))).alias("found")
    pairs = pairs.groupBy("base", "type", "norm").agg(found)
    # Sizes are estimated across explodes and from packed files: left to them, mentions would be a broadcast that grows with the input.
    met = x.join(pairs.hint("merge"), ["base", "type", "norm"])
    at = F.struct(F.col("row_pos").cast("int"), F.col("ent_pos").cast("int"))
    best = F.array_min(F.filter("found", lambda c: (c["l"] == F.col("norm")) | (F.struct(c["o"]["row_pos"], c["o"]["ent_pos"]) < at)))
    return met.withColumn("leader", best["l"]).where("leader is not null").select(*x.columns, "leader")


def adjudicated(mentions: DataFrame, same: Callable[[str, str, str | None, str, str | None], bool], high: float = 0.92, low: float = 0.80, strict: bool = True) -> DataFrame:
    """named() with leader, where pairs between low and high are decided by same(type, name, evidence, other name, other evidence).

    Answers depend on what an entity was last seen with, so a (base, type) is
    one sequential fold.
    """
    x = named(mentions, strict)
    flat = x.select(*[c for c in x.columns if c != "ord"])

    def fold(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["row_pos", "ent_pos"])
        leaders = _Leaders(frame["norm"].tolist(), min(low, high))
        number: dict[str, int] = {}
        seen: list[tuple[str, str | None]] = []  # of each leader's entity: best name, last evidence
        out = []
        for r in frame.itertuples(index=False):
            k, count = number.get(r.norm), None
            if k is None:
                count = leaders.count(r.norm)
                score, place = max(((score, -i) for i, score in leaders.close(r.norm, count)), default=(-1.0, 0))
                if score >= high or score >= low and same(r.type, r.name, r.evidence, *seen[-place]):
                    k = -place
            if k is None:
                k = number[r.norm] = len(seen)
                leaders.add(r.norm, count)
                seen.append((r.name, r.evidence))
            else:
                seen[k] = (max(seen[k][0], r.name, key=len), r.evidence)
            out.append(leaders.norms[k])
        return frame.assign(leader=out)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in flat.schema) + ", leader string"
    # By number, as in scored().
    tasks = int(flat.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return flat.repartition(tasks, "base", "type").groupBy("base", "type").applyInPandas(fold, schema).withColumn("ord", F.struct("row_pos", "ent_pos"))


def best_name(name: Column, order: Column) -> Column:
    """The longest name, the first of those."""
    return F.max_by(name, F.struct(F.length(name), -order["row_pos"], -order["ent_pos"]))


def resolved(mentions: DataFrame) -> DataFrame:
    """mentions with their entity's global_id: type and slug of the entity's first name."""
    first = F.min_by("name", "ord").over(Window.partitionBy("base", "type", "leader"))
    return mentions.withColumn("global_id", F.concat("type", F.lit(":"), T.slug(first)))


def _attribute_values(mentions: DataFrame) -> DataFrame:
    """(base, type, leader, key, value): each key's first value that isn't empty, or its last one, as JSON."""
    x = mentions.select("base", "type", "leader", "ord", F.explode(F.expr("cast(try_parse_json(attributes) as map<string,variant>)")).alias("key", "variant")).withColumn("value", F.to_json("variant"))
    empty = F.col("value").isNull() | F.col("value").isin("null", '""', "[]")
    return x.groupBy("base", "type", "leader", "key").agg(F.coalesce(F.min_by(F.when(~empty, F.col("value")), F.when(~empty, F.col("ord"))), F.max_by(F.coalesce("value", F.lit("null")), "ord")).alias("value"))


def _as_object(pairs: Column) -> Column:
    """array<struct<key, value>> as a JSON object, in the order of keys; values are JSON."""
    quoted = lambda key: F.to_json(F.array(key))
    return F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(pairs), lambda p: F.concat(quoted(p["key"]).substr(F.lit(2), F.length(quoted(p["key"])) - 2), F.lit(": "), p["value"])), ", "), F.lit("}"))


def merged_attributes(mentions: DataFrame) -> DataFrame:
    """(base, type, leader, attributes): each key's first value that isn't empty, or its last one, as a JSON object.

    Empty are null, "" and []; 0, false and {} aren't.  Values stay as they are
    written, so numbers keep their form.
    """
    return _attribute_values(mentions).groupBy("base", "type", "leader").agg(_as_object(F.collect_list(F.struct("key", "value"))).alias("attributes"))


def entities(mentions: DataFrame) -> DataFrame:
    """One row per entity of resolved(): (base, global_id, type, name, attributes, mentions, first_ord).

    Mentions and attributes meet in one aggregation.  A join would be planned
    by sizes that are estimated across an explode, far too small, and send the
    attributes of all entities through the driver as a broadcast.
    """
    key = ["base", "type", "leader"]
    entry = F.struct("ord", F.struct("chunk_id", F.col("id").alias("local_entity_id"), F.col("evidence").alias("evidence_entity")).alias("m"))
    x = mentions.select(*key, "global_id", "name", "ord", entry.alias("entry"))
    x = x.unionByName(_attribute_values(mentions).select(*key, F.struct("key", "value").alias("pair")), allowMissingColumns=True)
    listed = F.transform(F.array_sort(F.collect_list("entry")), lambda e: e["m"])
    x = x.groupBy(*key).agg(F.max("global_id").alias("global_id"), best_name(F.col("name"), F.col("ord")).alias("name"), _as_object(F.collect_list("pair")).alias("attributes"), listed.alias("mentions"), F.min("ord").alias("first_ord"))
    return x.select("base", "global_id", "type", "name", "attributes", "mentions", "first_ord")


def entity_names(mentions: DataFrame) -> DataFrame:
    """entities() without what is slow to make: (base, global_id, type, name, first_ord)."""
    x = mentions.groupBy("base", "type", "leader").agg(F.max("global_id").alias("global_id"), best_name(F.col("name"), F.col("ord")).alias("name"), F.min("ord").alias("first_ord"))
    return x.select("base", "global_id", "type", "name", "first_ord")


def relations(rows: DataFrame, mentions: DataFrame) -> DataFrame:
    """Relations between entities: (base, source, type, target, provenance, first_ord).

    rows (base, row_pos, rel_pos, chunk_id, source_id, type, target_id,
    evidence) find their ends among the mentions of their own row; of mentions
    with one local id the last counts.  Rows with blank fields or an unknown
    end are left out.
    """
    local = mentions.groupBy("base", "row_pos", "id").agg(F.max_by("global_id", "ent_pos").alias("gid"))
    x = rows.withColumns({c: T.strip(F.coalesce(c, F.lit(""))) for c in ("type", "source_id", "target_id")}).where("type <> '' and source_id <> '' and target_id <> ''")
    end = lambda c, alias: local.select("base", "row_pos", F.col("id").alias(c), F.col("gid").alias(alias))
    x = x.join(end("source_id", "source"), ["base", "row_pos", "source_id"]).join(end("target_id", "target"), ["base", "row_pos", "target_id"])
    entry = F.struct(F.struct("row_pos", "rel_pos").alias("ord"), F.struct("chunk_id", F.col("evidence").alias("evidence_relation")).alias("p"))
    out = x.groupBy("base", "source", "type", "target").agg(F.array_sort(F.collect_list(entry)).alias("all"))
    return out.select("base", "source", "type", "target", F.transform("all", lambda e: e["p"]).alias("provenance"), F.get("all", F.lit(0))["ord"].alias("first_ord"))


def _with_relations(extractions: DataFrame) -> DataFrame:
    """Slim mentions (base, row_pos, ent_pos, id, type, name), of which the first of each extraction has its chunk_id and relations.

    Without local ids mentions are nothing that relations can name, and go
    before the first is told.
    """
    usable = F.filter("entities", lambda e: T.strip(F.coalesce(e["id"], F.lit(""))) != "")
    # Within the array: beside it, an explode would write them anew for each mention.
    first = lambda i, c: F.when(i == 0, F.col(c)).alias(c)
    slim = F.transform(usable, lambda e, i: F.struct(*(e[c].alias(c) for c in ("id", "type", "name")), first(i, "chunk_id"), first(i, "relations")))
    return extractions.select("base", "row_pos", F.posexplode(slim).alias("ent_pos", "e")).select("base", "row_pos", "ent_pos", "e.*")


def located(extractions: DataFrame, mentions: DataFrame | None = None) -> DataFrame:
    """Relations of extractions, one row each, with their ends: (base, row_pos, rel_pos, chunk_id, source, type, target, and what else relations have).

    What relations() says of blank fields, unknown ends and equal local ids
    holds.  mentions are resolved(); without them names are resolved exactly on
    the way.  All rows of a base meet in one exchange: a base is a document,
    whose size is bounded, and its mentions, rows and relations need no other.
    """
    if mentions is None:
        x = exact(_with_relations(extractions)).select("base", "row_pos", "ent_pos", "id", "type", "name", "leader", "chunk_id", "relations")
        x = resolved(x.where("base is not null").repartition("base").withColumn("ord", F.struct("row_pos", "ent_pos")))
    else:
        x = mentions.select("base", "row_pos", "ent_pos", "id", "global_id").unionByName(extractions.select("base", "row_pos", "chunk_id", "relations"), allowMissingColumns=True)
        x = x.where("base is not null").repartition("base")
    end = F.when(F.col("global_id").isNotNull(), F.struct("ent_pos", "id", "global_id"))
    # The last of equal local ids comes first, where it is found.
    x = x.groupBy("base", "row_pos").agg(F.sort_array(F.collect_list(end), False).alias("ends"), F.collect_list(F.when(F.col("relations").isNotNull(), F.struct("chunk_id", "relations"))).alias("of"))
    x = x.select("base", "row_pos", F.col("ends.id").alias("ids"), F.col("ends.global_id").alias("gids"), F.explode("of").alias("of"))
    own = [f.name for f in extractions.schema["relations"].dataType.elementType.fields if f.name not in ("source_id", "type", "target_id")]
    text = lambda c: T.strip(F.coalesce(c, F.lit("")))
    gid = lambda c: F.get("gids", F.array_position("ids", text(c)).cast("int") - 1)
    ends = lambda r, i: F.struct(i.alias("rel_pos"), gid(r["source_id"]).alias("source"), text(r["type"]).alias("type"), gid(r["target_id"]).alias("target"), *(r[c].alias(c) for c in own))
    x = x.select("base", "row_pos", F.col("of.chunk_id").alias("chunk_id"), F.explode(F.transform("of.relations", ends)).alias("r")).select("base", "row_pos", "chunk_id", "r.*")
    return x.where("type <> '' and source is not null and target is not null")
