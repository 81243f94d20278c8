"""Thresholds of the operators, as frozen parameter sets. Times are in milliseconds unless named otherwise."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ClipRules:
    # fixed values: clip lengths, trust and padding limits
    target_ms: int = 8000
    min_ms: int = 3000
    max_ms: int = 14000
    abs_max_ms: int = 16000
    min_words: int = 3
    source_trust: float = 0.60
    clip_consensus_review: float = 0.55
    first_gap_ms: int = 240
    last_gap_ms: int = 300
    pre_pad_ms: int = 120
    post_pad_ms: int = 150


@dataclass(frozen=True)
class Budget:
    """When a pack is closed: before an item that would take it past soft_max once it holds target, or at hard_max."""

    target: int
    soft_max: int
    hard_max: int
    item_cost: int


# fixed values: the four packing presets
REVIEW_PARTS = Budget(40_000, 50_000, 60_000, 1)
TASKS_V1 = Budget(40_000, 55_000, 55_000, 450)
TASKS_V2 = Budget(30_000, 42_000, 42_000, 300)
REVIEW_PACKS = Budget(45_000, 55_000, 55_000, 0)

BUCKET_MS = 30_000
CLIPS = ClipRules()
KEEP = ("KEEP_AUTO", "KEEP_WHISPER_PRIMARY")
LABELS = (
    "KEEP_CANDIDATE",
    "DROP_FRAGMENT",
    "BROKEN_TEXT",
    "WEIRD_PHRASE",
    "PARALINGUISTIC",
    "STUTTER_OR_REPEAT",
    "PHONETIC_CROWDING_RISK",
    "NEED_CONTEXT",
)
