"""Stage parameters.  Plain frozen records; defaults are the usual production settings."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from .functions import fixed


@dataclass(frozen=True)
class MessageOptions:
    role_keep: str = "user"
    min_chars: int = 10
    drop_trivial: bool = True
    trivial_messages: tuple[str, ...] = ("ок", "да", "нет", "спасибо", "понял")
    deduplicate: bool = True
    build_modeling_text: bool = True
    modeling_max_tokens: int | None = None
    modeling_strip_stopwords: bool = True
    flags: Mapping[str, str] = field(default_factory=lambda: dict(fixed.DOMAIN_FLAGS))


@dataclass(frozen=True)
class UnitOptions:
    mode: str = "merged_messages"
    max_messages: int = 2
    max_gap_minutes: int = 15
    # (chat, user) groups above either are cut into slices and scanned in parallel.
    hot_group_rows: int = 500_000
    hot_group_bytes: int = 256 << 20
    # Rows and bytes of text one slice of a hot group holds at most, about.
    slice_rows: int = 200_000
    slice_bytes: int = 64 << 20


@dataclass(frozen=True)
class EmbeddingOptions:
    provider: str = "hashing"
    model: str = "hashing-64"
    batch_size: int = 64
    texts_per_task: int = 50_000
    # Texts embedded between two commits of the cache: what a lost job costs at most.
    texts_per_wave: int = 5_000_000
    max_text_chars: int | None = None
    strip_null_bytes: bool = True
    # Anything else that changes the vectors (e.g. their width) belongs to the cache key.
    provider_params: tuple[str, ...] = ()

    @property
    def identity(self) -> tuple[object, ...]:
        return (self.provider, self.model, *self.provider_params, self.max_text_chars, self.strip_null_bytes)


@dataclass(frozen=True)
class TopicOptions:
    backend: str = "simple"  # or "density"
    components: int = 5
    # How the density backend reduces vectors: "pca", or "neighbours" (eigenvectors of the graph of so many neighbours).
    reduction: str = "pca"
    n_neighbours: int = 15
    # How the density backend finds topics: "varying" (any density) or "grid" (cells of one width).
    clustering: str = "varying"
    cell_width: float = 0.15
    min_cluster_size: int = 20
    min_samples: int = 5
    ngram_min: int = 1
    ngram_max: int = 2
    min_df: int | float = 5
    nr_topics: int | None = None
    representative_examples: int = 12
    keyword_top_n: int = 10
    reduce_outliers: bool = True
    reduce_outliers_strategy: str = "embeddings"  # or "c-tf-idf"


@dataclass(frozen=True)
class EnrichmentOptions:
    enabled: bool = True
    model: str = "mock"
    max_examples_per_topic: int = 12
    temperature: float = 0.0


@dataclass(frozen=True)
class ReportOptions:
    top_n_topics: int = 30
    top_n_examples: int = 15
    growth_periods: int = 4
    figure_topics: int = 15
