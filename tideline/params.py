"""Every tunable number of the pipeline in one frozen object.

Nothing in the package reads the clock: the run time is always the explicit
``as_of`` argument, so a run can be repeated with the same result.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime


@dataclass(frozen=True)
class Campaign:
    """One past bulk campaign table that becomes rows of the training frame."""

    table: str
    campaign: str
    segment: str
    win_start: datetime
    win_end: datetime
    default_anchor: datetime
    has_premium: bool = True
    has_quote_age: bool = True


@dataclass(frozen=True)
class PastOffer:
    """A past campaign as a span with its offer; ``offer`` None reads the row's own offer."""

    table: str
    label: str
    start: datetime
    end: datetime
    offer: float | None = None


@dataclass(frozen=True)
class ControlBand:
    """Natural control: people scored like the campaign but ranked below its cut."""

    table: str
    campaign: str
    segment: str
    min_quote_age: int
    first_rank: int
    last_rank: int
    win_start: datetime
    win_end: datetime
    default_anchor: datetime
    ranked_table: str | None = None  # campaign table that also receives its rank


@dataclass(frozen=True)
class Params:
    # Daily volume, caps, cooldown
    max_n: int = 400
    min_n: int = 100
    min_p: float = 0.015
    cooldown_days: int = 7
    guard_days: int = 7
    clicker_share: float = 0.2
    prev_sent_share: float = 0.3
    control_n: int = 100
    # Quota profile of the pick
    quota_n: int = 100
    quota_control_n: int = 50
    fresh_min_p: float = 0.005
    fresh_lead_ages: tuple[str, ...] = ("0-3d", "4-7d")
    # Offer rule
    offer_floor: int = 7
    offer_step: float = 3.0
    offer_ceiling: int = 17
    premium_ratio: float = 0.97
    lead_offer: int = 10
    # Ages and look-backs in days
    quote_max_age: int = 365
    lead_max_age: int = 15
    split_days: int = 45
    episode_gap_days: int = 45
    disconnected_days: int = 90
    dealership_days: int = 2
    count_days: int = 30
    history_days: int = 180
    discount_reach_days: int = 181
    discount_count_days: int = 28
    phone_first_days: int = 1
    undeliverable_days: int = 180
    undeliverable_codes: tuple[int, ...] = (63003, 63024)
    local_hours: int = 2
    status_late_days: int = 30
    # training
    min_days_observed: int = 7
    min_test_clicks: int = 40
    c_grid: tuple[float, ...] = (0.03, 0.1, 0.3)
    folds: int = 5
    min_frequency: int = 100
    max_iter: int = 500
    tol: float = 1e-10
    newton_iter: int = 100
    # The driver solves systems of up to so many slots; wider models go to Spark ML
    newton_slots: int = 500
    # Promotion gate
    gate_min_auc: float = 0.65
    gate_tolerance: float = 0.01
    gate_min_clicks: int = 30
    self_check_tolerance: float = 1e-3
    # Fixed value: numbers that can receive a message, matched on the whole person key
    mobile_pattern: str = "[67][0-9]{8}|8[1-4][0-9]{7}"
    # Hash salts, they keep a person's arm the same for life
    arm_salt: str = "holdout_v1"
    keep_salt: str = "control_keep_v1"
    order_salt: str = "control_order_v1"
    # Settings of one installation; the defaults suit the bundled queries
    number_prefix: str = "+27"
    click_prefix: str = "CAMP"
    sales_campaign_ids: tuple[str, ...] = ()
    bad_names: tuple[str, ...] = ()
    bad_phones: tuple[str, ...] = ()
    always_on_tables: tuple[str, ...] = ()
    past_campaign_tables: tuple[str, ...] = ()
    last_campaign_tables: tuple[str, ...] = ()
    last_campaign_date: date | None = None
    campaigns: tuple[Campaign, ...] = ()
    control_band: ControlBand | None = None
    past_offers: tuple[PastOffer, ...] = ()
    # (label, campaign): the "messaged in label" flag counts for rows of that campaign only
    flag_only_for: tuple[tuple[str, str], ...] = ()
    history_start: datetime | None = None
    # Behaviour switches (the quota profile turns both on)
    block_undeliverable: bool = False
    require_mobile: bool = False
    # Plan settings
    constant_weights: bool = False
    optional_features: bool = False
    timeline_bucket: str = "day"
    model_name: str = "model_v"
