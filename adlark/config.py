"""Settings of the marketplace pipeline; the defaults fit the test tables, whose events span January 2024."""

from __future__ import annotations

from dataclasses import dataclass

#: Event types of the domain.
HARD_CONTACTS = ("view_phone", "contact_chat", "contact_zalo", "contact_sms")
OTHER_CONTACT = "other_interaction"
POSITIVE_EVENTS = (*HARD_CONTACTS, OTHER_CONTACT)


@dataclass(frozen=True)
class Config:
    train_start: str = "2024-01-01"
    train_end: str = "2024-01-28"
    cutoff: str = "2024-01-20"
    gt_start: str = "2024-01-21"
    gt_end: str = "2024-01-28"
    hard_weight: float = 3.0
    other_weight: float = 1.0
    popularity_days: int = 14
    recency_days: int = 7
    lookback_days: int = 21
    half_life_days: float = 14.0
    min_pair: int = 2
    neighbours: int = 50
    seed_cap: int = 100
    top_global: int = 500
    top_category: int = 200
    top_cell: int = 100
    quotas: tuple[int, int, int, int, int] = (50, 80, 30, 20, 20)
    pool: int = 200
    final_k: int = 10
    neg_per_pos: int = 10
    seller_cap: int = 2
    cap_penalty: float = 0.5
    fresh_days: int = 7
    fresh_boost: float = 1.10


DEFAULT = Config()
#: Candidates and features for test users as of the end of training.
PREDICT = Config(cutoff=DEFAULT.train_end)
#: Fixed value: what stands for an unknown name.
UNKNOWN = "Không xác định"
#: Fixed value: from this first posting on a seller is new.
NEW_SELLER_FROM = "2023-12-10"
