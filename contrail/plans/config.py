"""Pipeline parameters. Defaults are the flight data's names and the reference's values."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# --- fixed values that must equal the reference's (flight data layout) ---
FLIGHT_TARGET = "ArrDelay"
FLIGHT_NULL_TOKEN = "NA"
FLIGHT_FORBIDDEN = ("ArrTime", "ActualElapsedTime", "AirTime", "TaxiIn", "Diverted",
                    "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay",
                    "LateAircraftDelay")
FLIGHT_TIME_COLUMNS = ("DepTime", "CRSDepTime", "CRSArrTime")
FLIGHT_ENCODED = ("UniqueCarrier", "Origin", "Dest")
FLIGHT_CORRELATED_DROP = ("CRSElapsedTime", "CRSDepTime")
FLIGHT_TREND_BY = ("Year", "Month")
FLIGHT_PREDICTION = "Pred_ArrDelay"
SPARSE_THRESHOLD_PCT = 25.0
SPLIT_WEIGHTS = (0.8, 0.2)
SPLIT_SEED = 123
FOREST_TREES = 100
AIRPORT_KEY = "iata"
AIRPORT_ATTRS = {"lat": "Lat", "long": "Long"}
PLACE_ROLES = {"Origin": "Origin", "Dest": "Dest"}
# --- end of fixed values ---


@dataclass(frozen=True)
class PipelineConfig:
    target: str = FLIGHT_TARGET
    null_token: str = FLIGHT_NULL_TOKEN
    forbidden: tuple[str, ...] = FLIGHT_FORBIDDEN
    sparse_threshold_pct: float = SPARSE_THRESHOLD_PCT
    time_columns: tuple[str, ...] = FLIGHT_TIME_COLUMNS
    strict_times: bool = False
    # categorical pipeline: None -> detect by the letter rule; numeric: fixed list
    categorical: tuple[str, ...] | None = None
    exclude_categorical: tuple[str, ...] = ()
    correlated_drop: tuple[str, ...] = FLIGHT_CORRELATED_DROP
    auto_correlated: bool = False
    key_columns: tuple[str, ...] = ()          # ids kept out of features
    split_key: tuple[str, ...] | None = None   # hash split on these; None -> randomSplit
    split_weights: tuple[float, ...] = SPLIT_WEIGHTS
    seed: int = SPLIT_SEED
    fit_on: str = "train"                      # "all" reproduces the reference's leakage
    trend_by: tuple[str, ...] = FLIGHT_TREND_BY
    models: tuple[str, ...] = ("linear", "forest")
    forest_trees: int = FOREST_TREES
    prediction: str = FLIGHT_PREDICTION
    max_categories: int | None = None         # optional bound on indexed labels
    # numeric pipeline only
    roles: dict = field(default_factory=lambda: dict(PLACE_ROLES))
    dim_key: str = AIRPORT_KEY
    dim_attrs: dict = field(default_factory=lambda: dict(AIRPORT_ATTRS))
    coordinate_kind: str = "double"            # "int" reproduces the reference's truncation
    unique_dim_keys: str = "ignore"
    join_salt_buckets: int = 1                 # >1 salts hot keys when the dimension is not broadcast
    on_cast_loss: str = "raise"                # rows lost to cast NULLs: "raise" or "drop"
    materialize: bool = True

    def with_(self, **kw) -> "PipelineConfig":
        return replace(self, **kw)

    @classmethod
    def parity(cls, **kw) -> "PipelineConfig":
        """The reference's choices where ours differ: encoders and scaler fitted
        on all rows before the split, coordinates truncated to int,
        Bernoulli ``randomSplit``, the fixed encoded columns."""
        base = dict(fit_on="all", coordinate_kind="int", split_key=None,
                    categorical=FLIGHT_ENCODED)
        base.update(kw)
        return cls(**base)


# The driver's ``trips`` view in the roles of the flight columns.
TRIPS_CONFIG = PipelineConfig(
    target="delay",
    forbidden=(),
    time_columns=("dep_hhmm", "arr_hhmm"),
    correlated_drop=("elapsed",),
    key_columns=("row_key",),
    split_key=("row_key",),
    trend_by=("yr", "mo"),
    prediction="pred_delay",
    roles={"origin": "origin", "dest": "dest"},
    dim_key="n_name",
    dim_attrs={"n_nationkey": "_nationkey", "n_regionkey": "_regionkey"},
)
