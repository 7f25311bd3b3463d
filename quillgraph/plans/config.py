"""Settings of a run: defaults, then the environment, then a `.env` mapping; names in any case."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields, replace


# Names and defaults of the settings that are read.
@dataclass(frozen=True)
class Settings:
    input_dir: str = "input"
    output_dir: str = "output"
    prompts_dir: str = "system_prompts"
    embeddings_model: str = "hashed-words"
    chunk_size: int = 1200
    chunk_overlap: int = 150
    plantuml_cli: str | None = None
    llm_base_url: str = "http://127.0.0.1:1234/v1"
    llm_api_key: str = "api_key"
    llm_model: str = "model"
    llm_temperature: float = 0.0
    self_consistency_samples: int = 3
    normalize_whitespace: bool = True
    transliterate_text: bool = True
    full_ingestion: bool = False
    full_ingestion_batch_size: int = 5
    reuse_full_ingestion_cache: bool = True
    resume_from_cache: bool = False
    resume_allow_hash_mismatch: bool = False
    resume_require_full_ingestion: bool = True
    resume_skip_pipeline_if_complete: bool = False
    persist_vector_index: bool = True
    reuse_vector_index: bool = True
    diagram_format: str = "plantuml"
    graphviz_render: bool = False
    graphviz_engine: str = "dot"
    io_link_similarity_threshold: float = 0.62
    max_candidate_edges: int = 200
    name_similarity_threshold: float = 0.9
    use_llm_deduper: bool = False
    llm_similarity_band: float = 0.1
    llm_deduper_max_checks: int = 25


def _read(text: str, like: object) -> object:
    if isinstance(like, bool):
        if (low := text.strip().lower()) in ("1", "true", "yes", "on", "t", "y"):
            return True
        if low in ("0", "false", "no", "off", "f", "n"):
            return False
        raise ValueError(f"not a truth value: {text}")
    return type(like)(text) if isinstance(like, (int, float)) else text


def load(env: Mapping[str, str] | None = None, dotenv: str | None = None) -> Settings:
    """Settings from NAME=value lines of `dotenv` and from the environment, which wins."""
    given: dict[str, str] = {}
    for line in (dotenv or "").splitlines():
        if "=" in line and not line.lstrip().startswith("#"):
            k, _, v = line.partition("=")
            given[k.strip().lower()] = v.strip().strip("'\"")
    given |= {k.lower(): v for k, v in (os.environ if env is None else env).items()}
    out = Settings()
    return replace(out, **{f.name: _read(given[f.name], getattr(out, f.name)) for f in fields(out) if f.name in given})
