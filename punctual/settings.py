"""Every knob in one immutable place; override with ``dataclasses.replace``."""

from __future__ import annotations

from dataclasses import dataclass

from punctual.schema import CATEGORICAL_FEATURES, LABEL, NUMERIC_FEATURES


@dataclass(frozen=True)
class Settings:
    # message feed
    servers: str = "localhost:9092"
    topic: str = "flight-data"
    trigger_interval: str = "5 seconds"

    # features
    categorical: tuple[str, ...] = CATEGORICAL_FEATURES
    numeric: tuple[str, ...] = NUMERIC_FEATURES
    label: str = LABEL
    # "onehot": one slot per category value; "index": one nominal slot per column;
    # "binned": the same with at most category_slots values
    encoding: str = "onehot"
    category_slots: int = 16

    # boosted trees
    trees: int = 100
    depth: int = 8
    step_size: float = 0.1
    seed: int = 42
    checkpoint_every: int = 10
    # share of the training rows that decides how many of the trees are kept;
    # 0 keeps all of them
    validation_percent: int = 0
    validation_tolerance: float = 0.0

    # train / test split
    split_key: str = "flight_id"
    train_percent: int = 80

    # reports
    min_flights: int = 500
    top_origins: int = 20
    histogram_bins: int = 50


DEFAULTS = Settings()
