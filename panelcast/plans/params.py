"""Run parameters of a quarterly panel forecast (a frozen dataclass)."""

from __future__ import annotations

from dataclasses import dataclass

from ..functions.calendar import quarter_of
from ..operators.features import OriginWindow, pickup_dates
from ..operators.models.ridge import AdditiveTerms


@dataclass(frozen=True)
class RunParams:
    """Defaults are the mapping of the reference run onto the driver tables:
    four origins three months apart from 2000-02-01, a four-quarter horizon,
    history from 1995-01-01 and a fixed ``as_of`` instead of today's date.
    """

    start_date: str = "1995-01-01"
    first_pickup: str = "2000-02-01"
    n_origins: int = 4
    step_months: int = 3
    interval: int = 4
    as_of: str = "2001-02-01"
    series: tuple[str, ...] | None = None
    mask_actuals: bool = True
    oil_leads: bool = True
    lookback_months: int = 12
    model_series: tuple[str, ...] | None = None        # series that get models (None: all)
    worldwide_features: tuple[str, ...] | None = None  # M7: own regressor list of Worldwide series
    forest_depth: int | None = None                    # M1: None takes it from the rows
    additive: AdditiveTerms | None = None              # M3: trend changes, Fourier season, penalties
    recency: bool = False                              # W5: fits weigh rows by their age

    @property
    def pickups(self):
        return pickup_dates(self.first_pickup, self.n_origins, self.step_months)

    @property
    def origins(self) -> list[str]:
        return [quarter_of(p) for p in self.pickups]

    @property
    def windows(self) -> list[OriginWindow]:
        return [OriginWindow.build(p, self.interval) for p in self.pickups]

    @property
    def stage2_windows(self) -> list[OriginWindow]:
        return [OriginWindow.stage2(p, self.interval) for p in self.pickups]
