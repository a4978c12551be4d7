"""Run settings, default noise lists and default keyword lexicons."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

Lexicons = Mapping[str, Mapping[str, Sequence[str]]]

# Default noise lists.
STOPWORDS = (
    "the", "and", "or", "a", "to", "of", "for", "in", "on", "with",
    "is", "it", "this", "that", "my", "your", "you", "me", "we", "our",
)
PLATFORM_WORDS = (
    "fyp", "tiktok", "viral", "trend", "like", "share", "subscribe", "duet", "stitch", "follow",
)

# Default keyword lexicons, family -> label -> keywords.
DEFAULT_LEXICONS: Lexicons = {
    "content_domain": {
        "beauty": ["makeup", "skincare", "grwm", "lipstick"],
        "sports": ["game", "match", "football", "basketball", "soccer"],
        "food": ["recipe", "cook", "kitchen", "restaurant"],
        "music": ["song", "album", "tour", "concert"],
    },
    "vibe": {
        "positive": ["love", "great", "fun", "happy"],
        "neutral": ["okay", "normal", "alright"],
        "negative": ["bad", "sad", "angry"],
    },
    "commercial": {
        "ad": ["sponsored", "ad", "partner", "promo"],
        "shop": ["buy", "sale", "discount", "link"],
    },
    "role": {
        "creator": ["creator", "influencer", "vlogger"],
        "professional": ["doctor", "lawyer", "chef", "teacher"],
    },
    "format": {
        "tutorial": ["tutorial", "how", "guide", "learn"],
        "review": ["review", "opinion", "rating"],
        "challenge": ["challenge", "trend", "hashtagchallenge"],
    },
    "time": {
        "seasonal": ["summer", "winter", "spring", "fall", "holiday"],
        "event": ["2024", "2025", "newyear", "christmas"],
    },
    "sentiment": {
        "positive": ["love", "great", "amazing", "good", "happy"],
        "negative": ["hate", "bad", "terrible", "sad"],
    },
}


MAX_TERMS_LIMIT = 100_000


@dataclass(frozen=True)
class NoiseLists:
    """Words left out of the topic and lexicon views; compared in lower case."""

    stopwords: tuple[str, ...] = STOPWORDS
    platform: tuple[str, ...] = PLATFORM_WORDS

    def __post_init__(self) -> None:
        for name in ("stopwords", "platform"):
            words = dict.fromkeys(word.lower() for word in getattr(self, name))
            object.__setattr__(self, name, tuple(words))

    @property
    def all_words(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(self.stopwords + self.platform))


@dataclass(frozen=True)
class Settings:
    """Everything a run can be tuned with. ``run_id`` is stamped on every stage's rows."""

    run_id: str = "run"
    english_only: bool = True
    language_threshold: float = 0.5
    clustering_k: int = 25
    kmeans_starts: int = 10
    random_seed: int = 7
    embedding_dims: int = 64
    max_terms: int = 5000
    min_anchor_coverage: float = 0.2
    max_anchor_garbage: float = 0.25
    insufficient_topic_threshold: int = 5
    hashtag_weight: float = 1.5
    text_view_version: str = "views.v1"
    rules: str = "documented"
    lexicons: Lexicons = field(default_factory=lambda: DEFAULT_LEXICONS)
    noise: NoiseLists = field(default_factory=NoiseLists)
    # Rows that repeat an id: "stop" the run, or "keep_one" (the earliest, then the least by all values).
    repeated_ids: str = "stop"
    # Parts that stages of ids are dealt out to; by default the session's number of shuffle partitions.
    stage_buckets: int | None = None
    # Values that a summary tracks to find frequent ones, so that others need not be counted; 0 counts all.
    summary_values: int = 0

    def __post_init__(self) -> None:
        # The vocabulary and the basis of its terms come to the driver.
        if not 1 <= self.max_terms <= MAX_TERMS_LIMIT:
            raise ValueError(f"max_terms must be from 1 to {MAX_TERMS_LIMIT}")
        if self.repeated_ids not in ("stop", "keep_one"):
            raise ValueError('repeated_ids must be "stop" or "keep_one"')

    @property
    def hashtag_repeat(self) -> int:
        """How often a hashtag counts in lexicon scoring: half-even rounding, at least once."""
        return max(1, round(self.hashtag_weight))

    def as_dict(self) -> dict:
        return asdict(self)
