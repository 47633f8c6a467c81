"""Topic settings. Plain dataclasses: how they are loaded is the caller's business."""

from __future__ import annotations

from dataclasses import dataclass, field

# Defaults of the landing process.
MIN_FLUSH_SECONDS = 30
MAX_FLUSH_SECONDS = 300
METADATA_POLL_SECONDS = 10
PROGRESS_THRESHOLD = 0.5
MAX_BATCH_BYTES = 64 * 1024 * 1024
SAFETY_FACTOR = 0.65
EMA_ALPHA = 0.3
EXPORT_BYTES = 128 * 1024 * 1024
EXPORT_AGE_MINUTES = 60


@dataclass(frozen=True)
class TopicSettings:
    name: str
    table: str
    min_flush_seconds: int = MIN_FLUSH_SECONDS
    max_flush_seconds: int = MAX_FLUSH_SECONDS
    metadata_poll_seconds: int = METADATA_POLL_SECONDS
    progress_threshold: float = PROGRESS_THRESHOLD
    max_batch_bytes: int = MAX_BATCH_BYTES
    average_record_bytes: int = 1024
    # Least number of tasks that read a micro-batch: splits a hot partition.
    min_read_tasks: int | None = None
    reader_options: dict[str, str] = field(default_factory=dict)
