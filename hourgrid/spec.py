"""Column names and parameters of a demand series."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# The published pipeline's parameters.
LAG_STEPS = (1, 24, 168)
ROLLING_STEPS = (3, 24)
IQR_MULTIPLIER = 3.0
LOWER_QUANTILE = 0.25
UPPER_QUANTILE = 0.75
TRAIN_END = "2024-01-02 00:00:00"
VALIDATION_END = "2024-03-15 00:00:00"
MISLABELLED = ({"station_complex_id": "502", "transit_mode": "subway"},)

STEP_SUFFIX = {"hour": "h", "day": "d"}


@dataclass(frozen=True)
class DemandSpec:
    """What identifies a series, how long its step is, and how it is cleaned and split.

    The defaults describe hourly taps per station; any other additive measure on a regular hourly or daily grid
    is described by changing the column names, `step`, `lags` and `windows`.
    """

    series_id: str = "station_complex_id"
    name: str = "station_complex"
    attributes: tuple[str, ...] = ("station_complex", "borough", "transit_mode")
    ts: str = "transit_timestamp"
    raw_measure: str = "ridership"
    target: str = "entries"
    second_measure: str = "transfers"
    step: str = "hour"
    lags: tuple[int, ...] = LAG_STEPS
    windows: tuple[int, ...] = ROLLING_STEPS
    iqr_multiplier: float = IQR_MULTIPLIER
    exclude: tuple[dict[str, str], ...] = MISLABELLED
    train_end: str = TRAIN_END
    validation_end: str = VALIDATION_END
    # Steps per window block: a series longer than this is spread over several tasks.
    block_steps: int = 4096
    categorical: tuple[str, ...] = field(default=("station_complex", "borough", "transit_mode"))

    def __post_init__(self) -> None:
        if self.step not in STEP_SUFFIX:
            raise ValueError(f"step must be one of {sorted(STEP_SUFFIX)}, got {self.step!r}")
        if not self.lags or min(self.lags) < 1 or (self.windows and min(self.windows) < 1):
            raise ValueError("lags and windows must be positive")
        # The rules are applied to sums, which are kept per station tuple.
        if not {k for rule in self.exclude for k in rule} <= set(self.station_keys):
            raise ValueError("exclusion rules can only name the series id and its attributes")

    @property
    def station_keys(self) -> list[str]:
        return [self.series_id, *self.attributes]

    @property
    def keys(self) -> list[str]:
        return [*self.station_keys, self.ts]

    @property
    def history(self) -> int:
        """Steps of look-back needed to compute every feature of one row."""
        return max(*self.lags, *self.windows, 1)

    @property
    def lag_columns(self) -> list[str]:
        return [self.lag_name(k) for k in self.lags]

    @property
    def rolling_columns(self) -> list[str]:
        return [self.rolling_name(w) for w in self.windows]

    @property
    def calendar_columns(self) -> list[str]:
        return ["hour_of_day", "day_of_week", "month", "is_weekend"]

    @property
    def numeric_features(self) -> list[str]:
        return [*self.lag_columns, *self.rolling_columns, *self.calendar_columns]

    @property
    def feature_columns(self) -> list[str]:
        return [*self.numeric_features, *self.categorical]

    def lag_name(self, k: int) -> str:
        return f"lag_{k}{STEP_SUFFIX[self.step]}"

    def rolling_name(self, w: int) -> str:
        return f"rolling_mean_{w}{STEP_SUFFIX[self.step]}"

    def with_(self, **changes: object) -> "DemandSpec":
        return replace(self, **changes)
