"""Option records for each stage (defaults follow the documented config)."""

from __future__ import annotations

from dataclasses import dataclass, field

# Default custom stop words of the documented configuration.
DEFAULT_CUSTOM_STOPWORDS = ("um", "uh", "like", "you know", "i mean", "actually")


@dataclass(frozen=True)
class TextOptions:
    """Cleaning and token filtering options."""

    remove_stopwords: bool = True
    lemmatize: bool = True
    min_word_length: int = 3
    remove_numbers: bool = True
    # None means Spark's built-in English list (StopWordsRemover default).
    stopwords: tuple[str, ...] | None = None
    custom_stopwords: tuple[str, ...] = DEFAULT_CUSTOM_STOPWORDS
    # Optional: drop multi-word custom stop phrases from the text before
    # tokenising (off by default: a phrase can never match a single token).
    remove_stop_phrases: bool = False


@dataclass(frozen=True)
class SentimentOptions:
    """Model and label thresholds (inclusive, see A6)."""

    model: str = "vader"
    positive_threshold: float = 0.05
    negative_threshold: float = -0.05

    def __post_init__(self):
        if self.model.lower() != "vader":
            raise ValueError(f"unsupported sentiment model {self.model!r}; only 'vader' rules exist")


@dataclass(frozen=True)
class TopicOptions:
    """Vocabulary filter and LDA settings."""

    algorithm: str = "lda"
    num_topics: int = 5
    passes: int = 10
    min_df: int = 5
    max_df: float = 0.9
    max_vocab: int | None = None
    batch_share: float = 0.25
    top_terms: int = 20
    min_prob: float = 0.01
    seed: int = 42
    coherence_window: int = 110

    def __post_init__(self):
        if self.algorithm.lower() != "lda":
            raise ValueError(f"unsupported topic algorithm {self.algorithm!r}; only 'lda'")


@dataclass(frozen=True)
class ReportOptions:
    """Report settings."""

    highlight_count: int = 5
    save_format: str = "md"
    include_enrichment: bool = True
    generated_at: str = "1970-01-01 00:00:00"


@dataclass(frozen=True)
class EnrichOptions:
    """Prompt budget (None: whole texts; ``compat`` cuts at 4000 as the reference does) and completion settings."""

    content_chars: int | None = None
    temperature: float = 0.3
    max_tokens: int = 1000
    system_prompt: str | None = None
    compat: bool = False
    partitions: int | None = None
    #: prompts in one call, calls a second of the whole job (None: no limit), calls more for a failed prompt
    batch_size: int = 16
    requests_per_second: float | None = None
    retries: int = 2
    backoff_seconds: float = 1.0
    #: characters of session data in one progress prompt; replies merged at a time
    part_chars: int = 12_000
    fan_in: int = 8
    extra: dict = field(default_factory=dict)
