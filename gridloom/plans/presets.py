"""Settings of the page pipeline. Presets are data and never change; what differs is given by name."""

from __future__ import annotations

from dataclasses import asdict, dataclass, replace


@dataclass(frozen=True)
class Settings:
    tile_width: int = 800
    tile_height: int = 650
    overlap_ratio: float = 0.05
    min_overlap: int = 80
    content_scale: float = 0.04
    content_padding: int = 200
    min_chars: int = 20
    max_duplicate: float = 0.30
    max_blocks: int = 32
    max_cells: int = 256
    call_budget: int = 48
    max_failures: int = 8
    max_failure_rate: float = 0.35
    identical_limit: int = 3
    identical_chars: int = 1_000
    success_share: float = 0.80
    retries: int = 1
    long_aspect: float = 0.12
    long_height: int = 12_000
    long_overlap: int = 400
    retry_height: int = 8_000
    retry_overlap: int = 300
    min_text_pixels: int = 10
    local_ocr: bool = False
    local_min_pixels: int = 100_000_000
    local_max_pixels: int = 0
    trigger_chars: int = 0
    trigger_density: float = 0.0
    local_workers: int = 4
    refine_saturated: bool = False
    byte_budget: int = 0
    long_local_text: bool = False
    placeholder: str = "<table></table>"
    on_error: str = "placeholder"

    def __post_init__(self):
        if self.on_error not in ("placeholder", "empty", "raise"):
            raise ValueError(f"unknown on_error {self.on_error}")
        if self.local_max_pixels and self.local_max_pixels < self.local_min_pixels:
            raise ValueError("local_max_pixels lies below local_min_pixels")


_M = 1_000_000
_V1 = Settings()
_V2 = replace(_V1, local_ocr=True)
_V4 = replace(_V2, tile_height=800, local_min_pixels=10 * _M, local_max_pixels=20 * _M, trigger_chars=1_000)
_V5 = replace(_V4, tile_width=1_500, content_scale=0.05, content_padding=150, local_min_pixels=20 * _M, local_max_pixels=40 * _M)
_V6 = replace(_V5, local_max_pixels=100 * _M, trigger_density=0.004, byte_budget=190_000, long_local_text=True)
_V7 = replace(_V6, local_min_pixels=10 * _M, trigger_chars=7_000, local_workers=8)
PRESETS = {"v1": _V1, "v2": _V2, "v3": replace(_V2, refine_saturated=True), "v4": _V4, "v5": _V5, "v6": _V6, "v7": _V7, "v8": replace(_V7, local_max_pixels=400 * _M)}


def settings(preset: str = "v1", **changes) -> Settings:
    if preset not in PRESETS:
        raise ValueError(f"unknown preset {preset}; there are {', '.join(PRESETS)}")
    return replace(PRESETS[preset], **changes)


def as_dict(s: Settings) -> dict:
    return asdict(s)
