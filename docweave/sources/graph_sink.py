"""A graph database as a sink for node and edge tables, behind an interface."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice
from typing import Any, Protocol

from pyspark.sql import DataFrame
from pyspark.sql.types import Row

#: Rows of one request.
BATCH = 1000

#: The label, the key and the constraint that a graph has.
UNIQUE = "CREATE CONSTRAINT entity_global_id IF NOT EXISTS FOR (e:Entity) REQUIRE e.global_id IS UNIQUE"
CLEAR = "MATCH (n) DETACH DELETE n"
NODES = """UNWIND $rows AS row
MERGE (e:Entity {global_id: row.global_id})
SET e += row.properties"""
#: Relationship types can't be parameters; relation_type() leaves letters, digits and _ only.
EDGES = """UNWIND $rows AS row
MATCH (s:Entity {{global_id: row.src}}), (t:Entity {{global_id: row.dst}})
MERGE (s)-[r:{kind}]->(t)
SET {properties}"""


class Sink(Protocol):
    def open(self) -> tuple[Callable[[str, dict[str, Any]], Any], Callable[[], None]]:
        """Called on the driver and once in each partition; gives (run a statement with parameters, close)."""


@dataclass(frozen=True)
class Bolt:
    """A database that speaks Bolt, through its Python driver, which must be installed where tasks run."""

    uri: str
    user: str
    password: str
    database: str

    def __post_init__(self):
        if not self.password:
            raise ValueError("a graph database needs a password")

    def open(self) -> tuple[Callable[[str, dict[str, Any]], Any], Callable[[], None]]:
        import importlib

        driver = importlib.import_module("neo4j").GraphDatabase.driver(self.uri, auth=(self.user, self.password))
        session = driver.session(database=self.database)

        def close() -> None:
            session.close()
            driver.close()

        return lambda statement, parameters: session.run(statement, parameters).consume(), close


def _in_batches(rows: Iterator[Any]) -> Iterator[list[Any]]:
    while part := list(islice(rows, BATCH)):
        yield part


def _send(sink: Sink, statements: Iterator[tuple[str, dict[str, Any]]]) -> None:
    run, close = sink.open()
    try:
        for statement, parameters in statements:
            run(statement, parameters)
    finally:
        close()


def write(nodes: DataFrame, edges: DataFrame, sink: Sink, clear: bool = False, overwrite: bool = True) -> None:
    """Upserts nodes, then edges.  Statements merge, so a task that runs again changes nothing.

    Edges come sorted by type, so that a request has one; without overwrite
    properties that an edge has already stay.
    """
    _send(sink, iter([(UNIQUE, {}), *([(CLEAR, {})] if clear else [])]))
    values = [c for c in edges.columns if c not in ("src", "dst", "rel_type")]
    keep = "r += row.properties" if overwrite else ", ".join(f"r.{c} = coalesce(r.{c}, row.properties.{c})" for c in values)

    def send_nodes(rows: Iterator[Row]) -> None:
        plain = ({"global_id": r.global_id, "properties": {k: v for k, v in r.asDict().items() if k != "global_id"}} for r in rows)
        _send(sink, ((NODES, {"rows": part}) for part in _in_batches(plain)))

    def send_edges(rows: Iterator[Row]) -> None:
        def statements() -> Iterator[tuple[str, dict[str, Any]]]:
            kind, part = None, []
            for r in rows:
                if part and (r.rel_type != kind or len(part) == BATCH):
                    yield EDGES.format(kind=kind, properties=keep), {"rows": part}
                    part = []
                kind = r.rel_type
                part.append({"src": r.src, "dst": r.dst, "properties": {c: r[c] for c in values}})
            if part:
                yield EDGES.format(kind=kind, properties=keep), {"rows": part}

        _send(sink, statements())

    nodes.foreachPartition(send_nodes)
    edges.sortWithinPartitions("rel_type").foreachPartition(send_edges)
