"""Run settings: frozen dataclasses, loaded from YAML where a file is given."""

from __future__ import annotations

from dataclasses import dataclass, field, fields

#: Metres a second in one knot.
KNOT = 0.514444


@dataclass(frozen=True)
class Trajectory:
    max_time_gap_s: float = 60
    max_implied_kt: float = 250
    min_duration_s: float = 300
    min_alt_m: float = 152.4
    max_alt_m: float = 9144.0

    @property
    def max_implied_mps(self) -> float:
        return self.max_implied_kt * KNOT


@dataclass(frozen=True)
class Cleaning:
    max_speed_mps: float = 150.0
    max_accel_mps2: float = 10.0


@dataclass(frozen=True)
class Split:
    train_frac: float = 0.90
    seed: int = 42


@dataclass(frozen=True)
class Sequences:
    features: tuple[str, ...] = ("E_m", "N_m", "vE_mps", "vN_mps")
    sequence_length: int = 30
    stride: int = 5


@dataclass(frozen=True)
class Paths:
    archive_dir: str = "data/archive"
    aircraft_db_raw: str = "data/archive/aircraftDatabase.csv"
    out: str = "data/out"


@dataclass(frozen=True)
class Config:
    dates: tuple[str, ...] = ()
    trajectory: Trajectory = field(default_factory=Trajectory)
    cleaning: Cleaning = field(default_factory=Cleaning)
    split: Split = field(default_factory=Split)
    sequences: Sequences = field(default_factory=Sequences)
    paths: Paths = field(default_factory=Paths)


def _known(kind: type, values: dict) -> dict:
    names = {f.name for f in fields(kind)}
    if unknown := set(values) - names:
        raise ValueError(f"unknown settings for {kind.__name__}: {sorted(unknown)}")
    return {k: tuple(v) if isinstance(v, list) else v for k, v in values.items()}


def from_dict(raw: dict) -> Config:
    parts = {"trajectory": Trajectory, "cleaning": Cleaning, "split": Split, "sequences": Sequences, "paths": Paths}
    out: dict = {}
    for name, value in raw.items():
        if name == "dates":
            out[name] = tuple(str(d) for d in value)
        elif name in parts:
            out[name] = parts[name](**_known(parts[name], value or {}))
        else:
            raise ValueError(f"unknown section: {name}")
    return Config(**out)


def load(path: str) -> Config:
    """Reads the file at ``path`` on the driver."""
    import yaml

    with open(path, encoding="utf-8") as f:
        return from_dict(yaml.safe_load(f) or {})
