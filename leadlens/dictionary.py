"""Field dictionaries, filter criteria and job settings.

Every operator takes a ``FieldDictionary`` instead of hard-coded column names, so the same
code runs on the contact table and on any other labelled fact table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from types import MappingProxyType


#: Levels a categorical column may have: their order and codes are made in one task or the driver.
MAX_LEVELS = 10_000


class DatasetError(ValueError):
    """The input does not have the name, columns or labels an operator needs."""


@dataclass(frozen=True)
class FieldDictionary:
    """Roles, declared orders and descriptions of the columns of one table."""

    categoricals: tuple[str, ...]
    numerics: tuple[str, ...]
    target: str | None = None
    id: str | None = None
    id_type: str = "bigint"
    positive: str = "yes"
    negative: str = "no"
    unknown: str = "unknown"
    columns: tuple[str, ...] = ()
    orders: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    descriptions: Mapping[str, tuple[str, str]] = field(default_factory=dict)

    def __post_init__(self):
        object.__setattr__(self, "orders", MappingProxyType(dict(self.orders)))
        object.__setattr__(self, "descriptions", MappingProxyType(dict(self.descriptions)))
        if not self.columns:
            named = (self.id, *self.numerics, *self.categoricals, self.target)
            object.__setattr__(self, "columns", tuple(c for c in named if c))

    def required(self, labelled: bool) -> tuple[str, ...]:
        return tuple(c for c in self.columns if labelled or c != self.target)

    def title(self, column: str) -> str:
        return self.descriptions.get(column, (column, ""))[0]


@dataclass(frozen=True)
class FilterCriteria:
    """Allowed values per categorical column and closed ranges per numeric column."""

    categorical: Mapping[str, Sequence[str]] = field(default_factory=dict)
    numeric: Mapping[str, tuple[float, float] | None] = field(default_factory=dict)


@dataclass(frozen=True)
class Config:
    """Business and training settings."""

    seed: int = 42
    test_size: float = 0.2
    include_duration: bool = False
    high_frequency_threshold: int = 6
    never_contacted: int = 999
    folds: int = 3
    cost_per_call: float = 10.0
    revenue_per_sale: float = 100.0
    logistic_iterations: int = 1000
    forest_trees: int = 200
    boosted_a_rounds: int = 200
    boosted_b_rounds: int = 300
    parallel_fits: int = 4
    fit_rows: int = 0  # how many training rows a job may fit on, of each label its share, chosen by hash of the id; 0: all


# Labels, tokens, column roles and declared orders of the contact table.
CONTACTS = FieldDictionary(
    id="id",
    target="subscribe",
    positive="yes",
    negative="no",
    unknown="unknown",
    categoricals=(
        "job", "marital", "education", "default", "housing", "loan", "contact", "month", "day_of_week", "poutcome",
    ),
    numerics=(
        "age", "duration", "campaign", "pdays", "previous", "emp_var_rate", "cons_price_index", "cons_conf_index",
        "lending_rate3m", "nr_employed",
    ),
    columns=(
        "id", "age", "job", "marital", "education", "default", "housing", "loan", "contact", "month", "day_of_week",
        "duration", "campaign", "pdays", "previous", "poutcome", "emp_var_rate", "cons_price_index", "cons_conf_index",
        "lending_rate3m", "nr_employed", "subscribe",
    ),
    orders={
        "month": ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"),
        "day_of_week": ("mon", "tue", "wed", "thu", "fri"),
        "education": (
            "unknown", "illiterate", "basic.4y", "basic.6y", "basic.9y", "high.school", "professional.course",
            "university.degree",
        ),
        "subscribe": ("no", "yes"),
    },
    descriptions={
        "id": ("Contact key", "one number per contact row, without meaning of its own"),
        "age": ("Age", "age in years"),
        "job": ("Occupation", "kind of work"),
        "marital": ("Marital status", "single, married or divorced"),
        "education": ("Schooling", "highest level reached, in rising order"),
        "default": ("In default", "whether a credit is in default"),
        "housing": ("Home loan", "whether there is a loan on a home"),
        "loan": ("Personal loan", "whether there is a personal loan"),
        "contact": ("Channel", "mobile or fixed line used for the call"),
        "month": ("Call month", "calendar month of the last call"),
        "day_of_week": ("Call weekday", "weekday of the last call"),
        "duration": ("Call length", "known only once the call has ended; unfit for prediction"),
        "campaign": ("Calls so far", "calls made to this person in the running campaign"),
        "pdays": ("Days since last call", "days since an earlier campaign reached the person; 999 means never"),
        "previous": ("Earlier calls", "calls made before the running campaign"),
        "poutcome": ("Earlier outcome", "how the earlier campaign ended"),
        "emp_var_rate": ("Employment change", "quarterly change of employment"),
        "cons_price_index": ("Consumer prices", "monthly consumer price index"),
        "cons_conf_index": ("Consumer confidence", "monthly consumer confidence index"),
        "lending_rate3m": ("Three-month rate", "three-month lending rate between banks"),
        "nr_employed": ("Employed", "number of people employed, in thousands"),
        "subscribe": ("Subscribed", "whether the offer was taken up"),
    },
)

# Thresholds of the benefit scan.
SCAN_THRESHOLDS = (0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8)

# Limits used by the insights.
MIN_SAMPLE = 30
UNKNOWN_WARN_SHARE = 0.10
INSIGHT_COLUMNS = ("poutcome", "month", "contact", "job")
