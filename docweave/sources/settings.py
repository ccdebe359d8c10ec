"""Settings of all steps, from environment variables."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields

TRUE = ("1", "true", "yes", "y", "on")

#: Field -> variable, where that isn't the field's name in capitals (fixed values).
VARIABLES = {
    "data_raw": "DATA_RAW_DIR", "data_processed": "DATA_PROCESSED_DIR", "pdf_engine": "PDF_EXTRACT_ENGINE", "chunk_dir": "CHUNK_OUTPUT_DIR", "chunk_size": "CHUNK_SIZE_CHARS", "chunk_overlap": "CHUNK_OVERLAP_CHARS",
    "chunk_subchunks": "CHUNK_LLM_SUBCHUNK_ENABLE", "chunk_subchunk_size": "CHUNK_LLM_SUBCHUNK_SIZE_CHARS", "chunk_subchunk_overlap": "CHUNK_LLM_SUBCHUNK_OVERLAP_CHARS", "chunk_max_paragraphs": "CHUNK_LLM_MAX_PARAGRAPHS", "chunk_preview": "CHUNK_LLM_PREVIEW_CHARS", "chunk_temperature": "CHUNK_LLM_TEMPERATURE", "chunk_backend": "CHUNK_LLM_BACKEND",
    "chunk_suffix_rule": "CHUNK_OUTPUT_SUFFIX_RULE", "chunk_suffix_llm": "CHUNK_OUTPUT_SUFFIX_LLM", "chunk_suffix_fallback": "CHUNK_OUTPUT_SUFFIX_LLM_FALLBACK", "schema_dir": "SCHEMA_OUTPUT_DIR", "schema_alias": "SCHEMA_OUTPUT_ALIAS", "schema_backend": "SCHEMA_LLM_BACKEND", "schema_max_chars": "SCHEMA_MAX_CHARS_PER_DOC",
    "extract_input": "EXTRACT_INPUT_DIR", "extract_dir": "EXTRACT_OUTPUT_DIR", "extract_schema": "EXTRACT_SCHEMA_PATH", "extract_backend": "EXTRACT_LLM_BACKEND", "extract_errors": "EXTRACT_ERROR_DIR", "extract_strict": "EXTRACT_SCHEMA_STRICT", "extract_repair": "EXTRACT_REPAIR_ENABLE",
    "resolve_input": "RESOLVE_INPUT_DIR", "resolve_dir": "RESOLVE_OUTPUT_DIR", "resolve_backend": "RESOLVE_LLM_BACKEND", "validate_input": "VALIDATE_INPUT_DIR", "validate_chunks": "VALIDATE_CHUNK_DIR", "validate_dir": "VALIDATE_OUTPUT_DIR", "validate_backend": "VALIDATE_LLM_BACKEND",
    "graph_uri": "NEO4J_URI", "graph_user": "NEO4J_USER", "graph_password": "NEO4J_PASSWORD", "graph_database": "NEO4J_DATABASE", "graph_overwrite": "GRAPH_OVERWRITE_REL_PROPERTIES", "graph_clear": "GRAPH_CLEAR_DB",
}


@dataclass(frozen=True)
class Settings:
    """Defaults are fixed values; see from_env()."""

    data_raw: str = "data/raw"
    data_processed: str = "data/processed"
    pdf_engine: str = "pdfplumber"
    pdf_max_pages: int = 0
    pdf_min_chars: int = 0
    pdf_overwrite: bool = False
    log_level: str = "INFO"
    chunk_mode: str = "rule"
    chunk_dir: str = "data/processed/chunks"
    chunk_overwrite: bool = False
    chunk_size: int = 4000
    chunk_overlap: int = 300
    chunk_max_doc_chars: int = 0
    chunk_max_chunks: int = 5000
    chunk_backend: str = "openrouter"
    chunk_max_paragraphs: int = 120
    chunk_preview: int = 160
    chunk_temperature: float = 0.0
    chunk_subchunks: bool = True
    chunk_subchunk_size: int = 4000
    chunk_subchunk_overlap: int = 300
    chunk_suffix_rule: str = "rule"
    chunk_suffix_llm: str = "llm"
    chunk_suffix_fallback: str = "llm_fallback_rule"
    schema_dir: str = "data/schemas"
    schema_alias: str = ""
    schema_backend: str = "openrouter"
    schema_temperature: float = 0.0
    schema_sample_docs: int = 3
    schema_max_chars: int = 12000
    schema_overwrite: bool = False
    schema_model: str = ""
    extract_input: str = "data/processed/chunks"
    extract_dir: str = "output/extractions"
    extract_schema: str = ""
    extract_backend: str = "openrouter"
    extract_temperature: float = 0.0
    extract_model: str = ""
    extract_overwrite: bool = False
    extract_max_chunks: int = 0
    extract_sleep_sec: float = 0.0
    extract_errors: str = "output/errors"
    extract_strict: bool = True
    extract_repair: bool = True
    extract_repair_model: str = ""
    extract_max_retries: int = 2
    extract_max_tokens: int = 900
    extract_parallelism: int = 1
    resolve_input: str = "output/extractions"
    resolve_dir: str = "output/resolved"
    resolve_overwrite: bool = False
    resolve_sim_high: float = 0.92
    resolve_sim_low: float = 0.80
    resolve_max_candidates: int = 25
    resolve_use_llm: bool = False
    resolve_backend: str = "openrouter"
    resolve_model: str = ""
    resolve_temperature: float = 0.0
    resolve_sleep_sec: float = 0.0
    validate_input: str = "output/resolved"
    validate_chunks: str = "data/processed/chunks"
    validate_dir: str = "output/validated"
    validate_overwrite: bool = False
    validate_case_insensitive: bool = True
    validate_max_relations: int = 0
    validate_max_provenances: int = 0
    validate_use_llm: bool = False
    validate_backend: str = "openrouter"
    validate_model: str = ""
    validate_temperature: float = 0.0
    validate_max_tokens: int = 120
    validate_sleep_sec: float = 0.0
    graph_uri: str = "bolt://127.0.0.1:7687"
    graph_user: str = "neo4j"
    graph_password: str = ""
    graph_database: str = "neo4j"
    graph_entities_file: str = ""
    graph_relations_file: str = ""
    graph_entities_dir: str = ""
    graph_relations_dir: str = ""
    graph_min_support_ratio: float = 0.6
    graph_accept_llm_supported: bool = True
    graph_max_provenance: int = 5
    graph_max_mention_samples: int = 3
    graph_overwrite: bool = True
    graph_clear: bool = False

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> Settings:
        """Values of set variables; what follows a # is a comment; what can't be read is the default."""
        env = os.environ if env is None else env
        out = {}
        for f in fields(cls):
            raw = env.get(VARIABLES.get(f.name, f.name.upper()))
            if raw is not None:
                out[f.name] = coerced(raw, f.default)
        return cls(**out)


def coerced(raw: str, default):
    """raw as the default's type."""
    value = raw.partition("#")[0].strip()
    if not value:
        return default
    if isinstance(default, bool):
        return value.lower() in TRUE
    try:
        return type(default)(value)
    except ValueError:
        return default


def one_of(folder: str, file: str, what: str) -> str:
    """A folder if given, else a file; an error if neither is."""
    if not (folder or file):
        raise ValueError(f"neither a folder nor a file is set for {what}")
    return folder or file
