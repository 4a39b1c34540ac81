"""User settings, validated where they are created."""

from __future__ import annotations

from dataclasses import dataclass, field

from finetide.errors import DataError

# Names users already have in their configurations. The defaults of the classes
# below are fixed values too.
FORMATS = ("jsonl", "csv", "parquet", "candidates")
METHODS = ("sft", "lora", "qlora", "dpo", "ppo", "grpo")
SPLIT_NAMES = ("train", "validation", "test")


def is_preference(method: str) -> bool:
    """Only preference training reads prompt/chosen/rejected; all others read text."""
    if method not in METHODS:
        raise DataError(f"unknown method {method!r}, expected one of {METHODS}", "method")
    return method == "dpo"


@dataclass(frozen=True)
class Filters:
    min_length: int = 10
    max_length: int = 4096
    dedup_threshold: float = 0.95  # the similarity of near copies; without ``near_copies`` duplicates are exact
    min_quality_score: float = 0.0
    near_copies: bool = False  # also drop texts that are similar by ``dedup_threshold``

    def __post_init__(self) -> None:
        if self.min_length < 1 or self.max_length < 1:
            raise DataError("length limits must be at least 1", "filters")
        for name in ("dedup_threshold", "min_quality_score"):
            if not 0.0 <= getattr(self, name) <= 1.0:
                raise DataError(f"{name} must be between 0 and 1", f"filters.{name}")

    @property
    def similarity(self) -> float | None:
        """The similarity from which texts count as copies; None: only equal ones do."""
        return self.dedup_threshold if self.near_copies else None


@dataclass(frozen=True)
class SplitSpec:
    train_split: float = 0.9
    seed: int = 42

    def __post_init__(self) -> None:
        if not 0.0 < self.train_split < 1.0:
            raise DataError("train_split must lie strictly between 0 and 1", "train_split")


@dataclass(frozen=True)
class DatasetSpec:
    path: str
    format: str = "jsonl"
    text_column: str = "text"
    prompt_column: str | None = None
    response_column: str | None = None
    chosen_column: str | None = None
    rejected_column: str | None = None
    streaming: bool = False  # refused by the batch plans: such a dataset goes to the streaming package
    max_rows: int | None = None
    schema: str | None = None  # DDL for JSONL; saves the pass that infers one
    multiline: bool = False  # CSV cells may hold line breaks; costs the splitting of files
    partitions: int | None = None  # deals the rows out over so many tasks after reading

    def __post_init__(self) -> None:
        if self.format not in FORMATS:
            raise DataError(f"unsupported format {self.format!r}", "dataset.format")
        if self.max_rows is not None and self.max_rows < 1:
            raise DataError("max_rows must be at least 1", "dataset.max_rows")
        if self.partitions is not None and self.partitions < 1:
            raise DataError("partitions must be at least 1", "dataset.partitions")


@dataclass(frozen=True)
class GenerationSpec:
    n_samples: int = 100
    seed_prompts: str | None = None
    backend: str = "self_instruct"
    model: str | None = None
    filters: Filters = field(default_factory=Filters)

    def __post_init__(self) -> None:
        if self.n_samples < 1:
            raise DataError("n_samples must be at least 1", "synthetic.n_samples")
