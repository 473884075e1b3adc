"""All thresholds of the engine, in one immutable record."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields, replace


# The defaults that published results depend on.
@dataclass(frozen=True)
class Params:
    cell_size_m: float = 25.0
    heading_bins: int = 8
    bbox: tuple[float, float, float, float] = (49.70, 49.95, 23.85, 24.20)  # lat from, to; lon from, to
    tz: str = "Europe/Kyiv"
    stop_radius_m: float = 40.0
    terminal_radius_m: float = 120.0
    stop_bucket_m: float = 100.0
    stale_max_s: int = 120
    speed_max_mps: float = 25.0
    min_samples: int = 5
    profile_min_samples: int = 3
    profile_min_hours: int = 6
    hist_bin_kmh: float = 1.0
    free_flow_q: float = 0.85
    rel_min_ff_kmh: float = 8.0
    rel_scale_low: float = 0.35
    rel_scale_high: float = 1.0
    scale_low_kmh: float = 5.0
    scale_high_kmh: float = 35.0
    spread_scale_low: float = 5.0
    spread_scale_high: float = 30.0
    depot_max_kmh: float = 4.0
    depot_min_samples: int = 300
    depot_min_hours: int = 10
    depot_min_dist_to_stop_m: float = 120.0
    depot_pad_m: float = 40.0
    depot_link_cells: int = 2
    stop_pass_radius_m: float = 60.0
    run_gap_max_s: int = 600
    seg_max_s: int = 1800
    seg_gap_max_s: int = 240
    seg_bin_s: float = 5.0
    seg_min_obs: int = 5
    shape_tolerance_m: float = 8.0
    stop_match_max_m: float = 120.0
    match_slack_m: float = 80.0
    candidate_limit: int = 6
    ride_near_m: float = 150.0
    ride_detour_max: float = 2.0
    ride_rows: int = 4

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None) -> Params:
        """Defaults overridden by environment variables of the same upper-case names; read on the driver only."""
        env = dict(os.environ) if env is None else env
        given = {}
        for f in fields(cls):
            name = "TZ_LOCAL" if f.name == "tz" else f.name.upper()
            if name in env and f.name != "bbox":
                given[f.name] = type(getattr(cls, f.name))(env[name])
        return replace(cls(), **given)


DEFAULTS = Params()
