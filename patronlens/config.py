"""Parameters and fixed column orders of the feature jobs."""

from __future__ import annotations

import calendar
from dataclasses import dataclass
from datetime import date

# --- Fixed values: column names and their order in the two feature tables -----------------
PAIR_KEY = ["user_id", "seller_id"]

PAIR_COLUMNS = [
    "u_m_c_cnt", "u_m_p_cnt", "u_m_p_i_cnt", "u_m_r_cnt", "u_m_f_cnt", "um_act_d",
    "avg_span_act_um", "total_action_count", "c_ratio", "p_ratio", "f_ratio",
]

USER_COLUMNS = [
    "ttl_c", "ttl_p", "ttl_f", "dis_c", "dis_p", "dis_f", "mer_c", "mer_p", "mer_f",
    "cat_c", "cat_p", "cat_f", "brand_c", "brand_p", "brand_f",
    "ttl_act_d", "u_c_d_cnt", "u_p_d_cnt", "u_f_d_cnt",
    "u_p_m_ratio", "avg_span_actions", "avg_span_purchase", "last_span",
]

SELLER_COLUMNS = [
    "ttl_item", "ttl_cat", "ttl_brand", "c_cnt", "p_cnt", "f_cnt", "c_u_cnt", "p_u_cnt", "f_u_cnt",
]

PROFILE_COLUMNS = ["age_range", "gender"]

BASIC_PAIR_COLUMNS = [
    "u_m_c_cnt", "u_m_p_cnt", "u_m_f_cnt", "um_act_d", "avg_span_act_um",
    "c_ratio", "p_ratio", "total_action_count", "f_ratio",
]

BASIC_USER_COLUMNS = [
    "ttl_c", "ttl_p", "ttl_f", "dis_c", "dis_p", "dis_f", "mer_c", "mer_p", "mer_f",
    "cat_c", "cat_p", "cat_f", "ttl_act_d", "avg_span_actions", "avg_span_purchase", "last_span",
]

BASIC_SELLER_COLUMNS = ["c_cnt", "p_cnt", "f_cnt", "c_u_cnt", "p_u_cnt", "f_u_cnt"]

# Profile defaults.
UNKNOWN_AGE = "0"
UNKNOWN_GENDER = "2"
# ------------------------------------------------------------------------------------------

SEMANTICS = ("reference", "corrected")


@dataclass(frozen=True)
class FeatureConfig:
    """Everything that differs between data sets, and the choice of semantics.

    ``semantics="reference"`` keeps the established results, quirks included.
    ``"corrected"`` drops them: one row per label row, no month or click gate, and the
    unknown-gender code for users without a profile. ``restrict_to_labels=False`` lets the
    user and seller blocks see the whole log rather than the labelled pairs only.
    ``on_bad_day="fail"`` stops where an action that is looked at has a day that cannot be read;
    by default such a day is missing.
    """

    year: int = 2014
    months: tuple[int, ...] = (5, 6, 7, 8, 9, 10, 11)
    cutoff: date = date(2014, 11, 11)
    click: int = 0
    purchase: int = 2
    favourite: int = 3
    semantics: str = "reference"
    restrict_to_labels: bool = True
    on_bad_day: str = "null"

    def __post_init__(self) -> None:
        if self.on_bad_day not in ("null", "fail"):
            raise ValueError("on_bad_day must be 'null' or 'fail'")
        if self.semantics not in SEMANTICS:
            raise ValueError(f"semantics must be one of {SEMANTICS}, not {self.semantics!r}")
        if not self.months:
            raise ValueError("at least one month is needed")
        if not self.restrict_to_labels and self.semantics == "reference":
            raise ValueError("restrict_to_labels=False needs semantics='corrected'")

    @property
    def corrected(self) -> bool:
        return self.semantics == "corrected"

    def month_names(self) -> list[tuple[int, str]]:
        return [(m, calendar.month_abbr[m].lower()) for m in self.months]

    def month_columns(self) -> list[str]:
        names = [name for _, name in self.month_names()]
        per_action = [f"{name}_{a}_cnt" for name in names for a in "cpf"]
        return per_action + [f"{name}_tt" for name in names]

    def full_columns(self) -> list[str]:
        """The wide table: 76 columns with the default seven months."""
        return (
            PAIR_KEY + PAIR_COLUMNS + USER_COLUMNS + self.month_columns()
            + SELLER_COLUMNS + PROFILE_COLUMNS + ["label"]
        )

    def basic_columns(self) -> list[str]:
        """The earlier, narrower table: 64 columns with the default seven months."""
        return (
            PAIR_KEY + ["label"] + BASIC_PAIR_COLUMNS + BASIC_USER_COLUMNS + self.month_columns()
            + BASIC_SELLER_COLUMNS + PROFILE_COLUMNS
        )
