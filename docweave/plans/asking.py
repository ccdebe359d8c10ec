"""What steps ask completion backends, and what they make of the replies.

Replies are stored before anything is made of them, so that several branches
of a plan, or a task that runs again after them, ask nothing twice.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import replies
from ..functions import text as T
from ..operators import chunking, extraction, validation
from ..operators.completion import Backend, Recorded, complete
from ..sources.settings import Settings
from ..sources.shared import stored

SYSTEM = "Answer with JSON only, without any explanation."


def segment_requests(docs: DataFrame, s: Settings) -> DataFrame:
    """(base, n_paragraphs, prompt) of docs (base, text) with 1 to chunk_max_paragraphs paragraphs."""
    paras = chunking.paragraphs(docs)
    counts = paras.groupBy("base").agg(F.count("*").cast("int").alias("n_paragraphs")).where(F.col("n_paragraphs") <= s.chunk_max_paragraphs)
    entry = F.struct(F.col("idx"), T.preview(F.col("text"), s.chunk_preview).alias("preview"))
    listed = paras.join(counts, "base").groupBy("base", "n_paragraphs").agg(F.to_json(F.array_sort(F.collect_list(entry))).alias("list"))
    return listed.select("base", "n_paragraphs", extraction.prompt("segments", F.col("n_paragraphs"), F.col("list")).alias("prompt"))


def segments(docs: DataFrame, backend: Backend, s: Settings) -> DataFrame:
    """(base, segment_id, para_start, para_end, topic) of the replies about docs (base, text); none for a document without a usable one."""
    requests = segment_requests(docs, s).drop("n_paragraphs")
    got = stored(complete(requests, backend, SYSTEM, s.chunk_temperature, s.extract_max_tokens, attempts=1), "segments")
    found = got.where("reply is not null").select("base", F.posexplode(replies.parse_segments(F.col("reply"))).alias("segment_id", "x"))
    topic = F.nullif(T.strip(F.col("x.topic")), F.lit(""))
    return found.select("base", "segment_id", F.col("x.start_paragraph").alias("para_start"), F.col("x.end_paragraph").alias("para_end"), topic.alias("topic"))


def schema(sample: DataFrame, backend: Backend, s: Settings) -> dict:
    """The domain schema that the reply about a sample (base, text) of documents holds; an error if it holds none."""
    entry = F.struct(F.col("base").alias("title"), "text")
    requests = sample.agg(F.to_json(F.array_sort(F.collect_list(entry))).alias("list")).select(extraction.prompt("schema", F.col("list")).alias("prompt"))
    (got,) = complete(requests, backend, SYSTEM, s.schema_temperature, 4 * s.extract_max_tokens, attempts=1).collect()  # one request
    value = replies.domain_schema(got.reply)
    if value is None:
        raise RuntimeError(f"the reply is not a domain schema: {got.error or 'wrong shape'}")
    return {"_meta": {"llm_backend": backend.name, "llm_model": backend.model, "llm_temperature": s.schema_temperature}, **value}


def extraction_requests(chunks: DataFrame, schema: DataFrame) -> DataFrame:
    """chunks (base, chunk_id, text, topic) with ``prompt`` and ``again``, which mends a reply; schema has one row (text), the domain schema as JSON."""
    text = json.dumps(extraction.compact_schema(json.loads(schema.first().text)), ensure_ascii=False)
    first = extraction.prompt("extract", F.lit(text), F.col("base"), F.col("topic"), F.col("text"))
    return chunks.withColumn("prompt", first).withColumn("again", extraction.prompt("repair", F.lit(text), F.col("text")))


def extractions(chunks: DataFrame, schema: DataFrame, backend: Backend, repairer: Backend | None, s: Settings) -> tuple[DataFrame, DataFrame]:
    """(extractions, dead letters) of what extraction_requests() asks about."""
    requests = extraction_requests(chunks, schema)
    # The second request isn't known before the first has failed, so it travels along with it.
    mark = "\x00"
    both = requests.select("base", "chunk_id", F.concat("prompt", F.lit(mark), "again").alias("prompt")) if repairer else requests.select("base", "chunk_id", "prompt")
    repair = (lambda prompt, error: prompt.partition(mark)[2].replace("{error}", error, 1)) if repairer else None
    shape = lambda reply: replies.extraction(reply)[0]
    asked = complete(both, _first_part(backend, mark), SYSTEM, s.extract_temperature, s.extract_max_tokens, s.extract_max_retries, shape, repair, repairer, s.extract_sleep_sec, parallelism=s.extract_parallelism if s.extract_parallelism > 1 else 0)
    got = stored(asked.drop("prompt"), "extraction-replies")
    meta = [F.lit(backend.name).alias("llm_backend"), F.lit(backend.model).alias("llm_model")]
    now = T.utc_now().alias("extracted_at")
    good, bad = extraction.split_failures(got)
    parsed = good.select("base", "chunk_id", replies.parse_extraction(F.col("reply")).alias("x"))
    rows = parsed.where("x.ok").select("base", F.col("chunk_id").alias("row_pos"), "chunk_id", "x.entities", "x.relations", *meta, F.lit(s.extract_temperature).alias("llm_temperature"), now)
    # A recorded reply of the wrong shape fails only here.
    odd = parsed.where("not x.ok").select("base", "chunk_id", F.lit("the reply doesn't have the shape asked for").alias("error"), F.lit(None).cast("string").alias("repair_error"))
    dead = bad.select("base", "chunk_id", "error", "repair_error").unionByName(odd)
    return rows, dead.select("*", *meta, F.lit(repairer.model if repairer else None).cast("string").alias("repaired_with"), now)


class _First:
    """A backend that is asked the part of a prompt before a mark."""

    def __init__(self, backend: Backend, mark: str):
        self.backend, self.mark, self.name, self.model = backend, mark, backend.name, backend.model

    def open(self) -> Callable[[str, str, float, int], str]:
        call = self.backend.open()
        return lambda system, prompt, temperature, tokens: call(system, prompt.partition(self.mark)[0], temperature, tokens)


def _first_part(backend: Backend, mark: str) -> Backend:
    return backend if isinstance(backend, Recorded) else _First(backend, mark)


def judge(backend: Backend, temperature: float = 0.0, pause: float = 0.0) -> Callable[[str, str, str | None, str, str | None], bool]:
    """For resolution.adjudicated(): whether two names are one entity, by a backend that each task opens once."""
    opened: dict[str, Callable] = {}

    def same(kind: str, name: str, evidence: str | None, other: str, other_evidence: str | None) -> bool:
        import time

        if not opened:
            opened["call"] = backend.open()
        reply = opened["call"](SYSTEM, extraction.PROMPTS["same"] % (kind, name, evidence or "", other, other_evidence or ""), temperature, 60)
        if pause > 0:
            time.sleep(pause)
        return replies.same(reply)

    return same


ENTRY = ["base", "source", "type", "target", "prov_pos"]


def _verdict_prompt() -> Column:
    return extraction.prompt("verdict", F.col("source"), F.col("type"), F.col("target"), F.col("evidence_relation"), F.col("chunk_text"))


def verdict_requests(rows: DataFrame) -> DataFrame:
    """(ENTRY, prompt) of the rows of validation.statuses() that a backend is asked about."""
    return validation.to_escalate(rows).select(*ENTRY, _verdict_prompt().alias("prompt"))


def hashed(rows: DataFrame) -> DataFrame:
    """rows of validation.statuses() with prompt_sha256, null where nothing is asked, in place of the chunk's text."""
    return rows.withColumn("prompt_sha256", F.when(validation.escalates(), F.sha2(_verdict_prompt().cast("binary"), 256))).drop("chunk_text")


def verdicts(rows: DataFrame, backend: Backend, s: Settings) -> DataFrame:
    """rows of validation.statuses() with llm_support_status where the backend is asked; a call that fails leaves it null.

    Recorded replies are joined in the same pass, to rows of hashed() too.
    """
    if isinstance(backend, Recorded):
        x = rows if "prompt_sha256" in rows.columns else hashed(rows)
        # Rows that nothing is asked about have no key; they are dealt out by keys that no reply has.
        x = x.withColumn("prompt_sha256", F.coalesce("prompt_sha256", F.hex(F.xxhash64(*ENTRY))))
        x = x.join(backend.replies.select("prompt_sha256", "reply"), "prompt_sha256", "left")
        return x.withColumn("llm_support_status", F.when(F.col("reply").isNotNull(), replies.verdict(F.col("reply")))).drop("prompt_sha256", "reply")
    asked = complete(verdict_requests(rows), backend, SYSTEM, s.validate_temperature, s.validate_max_tokens, attempts=1, pause=s.validate_sleep_sec)
    got = stored(asked.drop("prompt"), "verdicts").select(*ENTRY, F.when(F.col("reply").isNotNull(), replies.verdict(F.col("reply"))).alias("llm_support_status"))
    return rows.join(got, ENTRY, "left")
