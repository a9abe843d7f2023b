"""Settings of a document run: defaults, values from the environment, and the ranges that are checked before any plan."""

from __future__ import annotations

import dataclasses
import os
from collections.abc import Mapping
from dataclasses import dataclass

TRUE = frozenset({"1", "true", "yes", "on"})
PREFIX = "SCRIPTORIUM_"


@dataclass(frozen=True)
class Settings:
    """What a run may be told. Defaults are fixed values."""

    dpi: int = 250
    tile_count: int = 4
    tile_overlap: float = 0.15
    tile_cut_search: float = 0.25
    detector_weights: str = ""
    detector_cpu: bool = False
    detector_max_size: int = 768
    detector_threshold: float = 0.15
    line_pad_y: float = 0.30
    line_pad_x: float = 0.018
    line_model: str = ""
    line_batch_size: int = 4
    line_max_tokens: int = 256
    table_min_area_ratio: float = 0.05
    table_max_area_ratio: float = 0.65
    table_min_squareness: float = 0.25
    table_min_lines: int = 2
    table_candidate_overlap: float = 0.30
    table_line_overlap: float = 0.55
    table_crop_padding: float = 0.008
    vision_url: str = ""
    vision_model: str = ""
    vision_ttl: int = 86_400
    vision_timeout: float = 240.0
    vision_retries: int = 2
    vision_retry_delay: float = 1.0
    localization_max_tokens: int = 1200
    review_lines: bool = False
    review_limit: int = 24
    review_max_tokens: int = 512
    extraction_model: str = ""
    extraction_prompt: str = ""
    extraction_max_tokens: int = 8192
    extraction_timeout: float = 900.0

    @classmethod
    def from_environment(cls, env: Mapping[str, str] | None = None, prefix: str = PREFIX) -> Settings:
        """Settings with the values of the variables that are named by the prefix and a field in capitals. A flag is true
        for 1, true, yes and on, whatever their case; blanks around a value do not count; a number that is none is an
        error that names its variable."""
        env = os.environ if env is None else env
        given = {}
        for field in dataclasses.fields(cls):
            name = prefix + field.name.upper()
            if name not in env:
                continue
            text, kind = env[name].strip(), type(field.default)
            try:
                given[field.name] = text.lower() in TRUE if kind is bool else kind(text)
            except ValueError as e:
                raise ValueError(f"{name}: {e}") from e
        return cls(**given)

    def problems(self) -> list[str]:
        """The settings that are out of their range, each with the range; empty where all hold."""
        ranges = {
            "dpi": (self.dpi >= 72, "72 at least"),
            "tile_count": (self.tile_count >= 1, "1 at least"),
            "line_batch_size": (self.line_batch_size >= 1, "1 at least"),
            "tile_overlap": (0 <= self.tile_overlap < 0.45, "from 0 to below 0.45"),
            "tile_cut_search": (0 <= self.tile_cut_search < 0.45, "from 0 to below 0.45"),
            "table_min_area_ratio": (0 < self.table_min_area_ratio < self.table_max_area_ratio <= 1, "above 0 and below table_max_area_ratio, which is 1 at most"),
            "table_min_squareness": (0 < self.table_min_squareness <= 1, "above 0, 1 at most"),
            "table_min_lines": (self.table_min_lines >= 1, "1 at least"),
            "vision_ttl": (self.vision_ttl >= 1, "1 at least"),
            "vision_timeout": (self.vision_timeout > 0, "above 0"),
            "localization_max_tokens": (self.localization_max_tokens >= 64, "64 at least"),
            "review_max_tokens": (self.review_max_tokens >= 32, "32 at least"),
            "review_limit": (self.review_limit >= 1, "1 at least"),
            "table_candidate_overlap": (0 <= self.table_candidate_overlap <= 1, "from 0 to 1"),
            "table_line_overlap": (0 <= self.table_line_overlap <= 1, "from 0 to 1"),
            "table_crop_padding": (0 <= self.table_crop_padding < 0.25, "from 0 to below 0.25"),
            "vision_retries": (self.vision_retries >= 0, "0 at least"),
            "vision_retry_delay": (self.vision_retry_delay >= 0, "0 at least"),
            "extraction_max_tokens": (self.extraction_max_tokens >= 256, "256 at least"),
            "extraction_timeout": (self.extraction_timeout > 0, "above 0"),
        }
        return [f"{name}: {text}" for name, (ok, text) in ranges.items() if not ok]

    def checked(self) -> Settings:
        """The settings themselves, or an error that names all that are out of range."""
        if found := self.problems():
            raise ValueError("; ".join(found))
        return self
