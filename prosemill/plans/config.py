"""Configuration of a whole run, from YAML or a dictionary."""

import warnings
from dataclasses import dataclass, field, fields
from pathlib import Path

from ..functions import language

from ..operators.dedup import DedupConfig
from ..operators.ingest import IngestConfig
from ..operators.quality import TRAINED, FilterConfig
from ..operators.tokenize import TokenizeConfig

# configuration keys that have another name in the dataclasses
_RENAMED = {"add_special_tokens": "parse_special"}
# keys that other implementations need and this one has no use for, with the reason
_WITHOUT_EFFECT = {
    "max_lsh_items": "every document is compared, however many there are",
    "batch_size": "Spark sizes its batches", "num_workers": "the cluster has its own number",
    "num_proc": "the cluster has its own number", "scheduler": "Spark schedules",
}


@dataclass(frozen=True)
class RunConfig:
    ingestion: IngestConfig = field(default_factory=IngestConfig)
    filtering: FilterConfig = field(default_factory=FilterConfig)
    deduplication: DedupConfig = field(default_factory=DedupConfig)
    tokenization: TokenizeConfig = field(default_factory=TokenizeConfig)
    output_file: str = "data/processed/cleaned_dataset.jsonl"
    processed_dir: str = "data/processed/tokenized/"
    compute_counts: bool = True
    single_file: bool = False  # merge the cleaned export into one file
    order_by: tuple = ()  # document order for keep-first, if not that of the content ids
    fail_on_malformed: bool = False  # stop if a line of the input is no JSON; else count it


def _section(cls, values: dict | None):
    """The dataclass from its section; warns of keys that have no effect."""
    known = {f.name for f in fields(cls)}
    values = {_RENAMED.get(k, k): v for k, v in (values or {}).items()}
    for key in sorted(set(values) - known):
        warnings.warn(f"{key} has no effect: {_WITHOUT_EFFECT.get(key, 'unknown key')}")
    return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in values.items() if k in known})


def from_dict(values: dict) -> RunConfig:
    ingestion = _section(IngestConfig, values.get("ingestion"))
    if not ingestion.input_path:
        raise ValueError("the ingestion section needs an input_path")
    paths = values.get("paths") or {}
    own = ("compute_counts", "single_file", "order_by", "fail_on_malformed")
    sections = ("ingestion", "filtering", "deduplication", "tokenization", "paths")
    for key in sorted(set(values) - {*own, *sections}):
        warnings.warn(f"{key} has no effect: unknown key")
    for key in sorted(set(paths) - {"output_file", "processed_dir"}):
        warnings.warn(f"paths.{key} has no effect: unknown key")
    filtering = dict(values.get("filtering") or {})
    scorer, model = filtering.get("language_scorer", "stopword"), filtering.get("language_model_path")
    if model and scorer == "stopword":
        raise ValueError(
            f"no scorer is named for the language model {model}: use {TRAINED!r} for a trained one, or register one "
            "with language.SCORERS.register, and name it as language_scorer")
    if scorer != TRAINED and scorer not in language.SCORERS:
        raise ValueError(f"language_scorer {scorer!r} is not registered")
    return RunConfig(
        ingestion=ingestion,
        filtering=_section(FilterConfig, filtering),
        deduplication=_section(DedupConfig, values.get("deduplication")),
        tokenization=_section(TokenizeConfig, values.get("tokenization")),
        **{k: paths[k] for k in ("output_file", "processed_dir") if k in paths},
        **{k: tuple(values[k]) if k == "order_by" else values[k] for k in own if k in values},
    )


def load_config(path: str, root: str | None = None) -> RunConfig:
    """Read YAML; a relative path counts from ``root`` (the working directory if not
    given). A missing file raises FileNotFoundError."""
    import yaml

    full = Path(root or ".") / path
    if not full.exists():
        raise FileNotFoundError(f"no configuration file at {full}")
    return from_dict(yaml.safe_load(full.read_text()) or {})
