"""Reading of completion replies: JSON inside free text, with the types that the operators expect."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

ENTITIES = "array<struct<id:string,type:string,name:string,attributes:string,evidence:string>>"
RELATIONS = "array<struct<source_id:string,type:string,target_id:string,evidence:string>>"
EXTRACTION = f"struct<ok:boolean,entities:{ENTITIES},relations:{RELATIONS}>"
SEGMENTS = "array<struct<start_paragraph:int,end_paragraph:int,topic:string>>"


def first_json(text: str | None) -> Any:
    """The value between the first opening bracket and the last fitting closing one; None if that isn't JSON."""
    found = re.search(r"\{.*\}|\[.*\]", (text or "").strip(), re.DOTALL)
    try:
        return json.loads(found[0]) if found else None
    except ValueError:
        return None


def _plain(value: dict, key: str) -> str:
    """A field as stripped text: absent is empty, a null that is there reads ``None``."""
    return str(value.get(key, "")).strip()


def _text(value: Any) -> str | None:
    return value if isinstance(value, str) else None


def extraction(reply: str | None) -> tuple[bool, list[tuple], list[tuple]]:
    """(well-formed, entities, relations) of a reply; entries that aren't objects are left out."""
    value = first_json(reply)
    if not isinstance(value, dict) or not isinstance(value.get("entities"), list) or not isinstance(value.get("relations"), list):
        return False, [], []
    attributes = lambda e: json.dumps(e["attributes"] if isinstance(e.get("attributes"), dict) else {}, ensure_ascii=False)
    entities = [(_plain(e, "id"), _plain(e, "type"), _plain(e, "name"), attributes(e), _text(e.get("evidence"))) for e in value["entities"] if isinstance(e, dict)]
    relations = [(_plain(r, "source_id"), _plain(r, "type"), _plain(r, "target_id"), _text(r.get("evidence"))) for r in value["relations"] if isinstance(r, dict)]
    return True, entities, relations


def _batched(of: Callable[[str | None], Any], kind: str) -> Callable[[Column], Column]:
    """of as a column function that takes replies in Arrow batches."""

    @F.pandas_udf(kind)
    def parse(texts: pd.Series) -> pd.Series:
        return pd.Series([of(t) for t in texts], dtype=object)

    return parse


def _extraction_row(reply: str | None) -> dict[str, Any]:
    ok, entities, relations = extraction(reply)
    names = ("id", "type", "name", "attributes", "evidence"), ("source_id", "type", "target_id", "evidence")
    return {"ok": ok, "entities": [dict(zip(names[0], e)) for e in entities], "relations": [dict(zip(names[1], r)) for r in relations]}


def parse_extraction(reply: Column) -> Column:
    """A struct (ok, entities, relations), see extraction()."""

    @F.pandas_udf(EXTRACTION)
    def parse(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_extraction_row(t) for t in texts], columns=["ok", "entities", "relations"])

    return parse(reply)


def segments(reply: str | None) -> list[tuple[int, int, str | None]] | None:
    """Paragraph ranges of a segmentation reply; None unless it is a list of objects with whole numbers."""
    value = first_json(reply)
    if not isinstance(value, list):
        return None
    try:
        return [(int(s.get("start_paragraph")), int(s.get("end_paragraph")), str(s.get("topic", "")).strip() or None) for s in value]
    except (AttributeError, TypeError, ValueError):
        return None


def parse_segments(reply: Column) -> Column:
    names = ("start_paragraph", "end_paragraph", "topic")

    def one(text: str | None) -> list[dict] | None:
        found = segments(text)
        return None if found is None else [dict(zip(names, s)) for s in found]

    return _batched(one, SEGMENTS)(reply)


def answer(text: str | None) -> dict:
    """The object from the first brace to the last one; empty if that isn't one."""
    found = re.search(r"\{.*\}", text or "", re.DOTALL)
    try:
        value = json.loads(found[0]) if found else {}
    except ValueError:
        value = {}
    return value if isinstance(value, dict) else {}


def said(text: str | None) -> str:
    word = str(answer(text).get("verdict", "")).strip().upper()
    return word if word in ("SUPPORTED", "UNSUPPORTED") else "UNSURE"


def verdict(reply: Column) -> Column:
    """SUPPORTED, UNSUPPORTED or UNSURE, the last for anything else."""
    return _batched(said, "string")(reply)


def same(reply: str | None) -> bool:
    """Whether a reply says that two names are one entity."""
    return bool(answer(reply).get("same", False))


def same_column(reply: Column) -> Column:
    return _batched(same, "boolean")(reply)


def domain_schema(reply: str | None) -> dict | None:
    """The domain schema that a reply holds: an object with two lists of types; None if it holds none."""
    value = first_json(reply)
    fine = isinstance(value, dict) and all(isinstance(value.get(k), list) for k in ("entity_types", "relation_types"))
    return value if fine else None
