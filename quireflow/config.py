"""Typed settings with the defaults of every stage, file loading and option overlays."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field, fields, is_dataclass, replace
from typing import Any

from quireflow.functions import plain_yaml


@dataclass(frozen=True)
class Render:
    target_width: int = 2048
    target_height: int = 2560
    min_dpi: int = 50
    max_dpi: int = 600
    default_dpi: int = 300
    image_format: str = "JPEG"
    image_quality: int = 95
    rescale_factor: float = 2.0
    max_pixels: int = 10_000_000


@dataclass(frozen=True)
class Judge:
    max_retries: int = 3
    timeout: int = 30
    temperature: float = 0.1
    max_output_tokens: int = 8192


@dataclass(frozen=True)
class Dewarp:
    enabled: bool = True
    confidence_threshold: float = 0.6
    num_grid_lines: int = 12
    threshold_coefficient: float = 0.03
    enable_strong_correction: bool = True
    crop_margin_px: int = 0


@dataclass(frozen=True)
class Orientation:
    enabled: bool = True
    use_llm: bool = True
    output_suffix: str = "_rot"
    output_format: str = ".jpg"
    jpeg_quality: int = 95


@dataclass(frozen=True)
class Tiling:
    num_splits: int = 5
    overlap_ratio: float = 0.1
    min_height_per_split: int = 100
    save_original: bool = True


@dataclass(frozen=True)
class Ocr:
    enabled: bool = True
    max_retries: int = 3
    timeout: int = 60
    temperature: float = 0.1
    max_output_tokens: int = 8192
    max_concurrent_groups: int = 3
    output_format: str = "both"
    encoding: str = "utf-8"
    include_metadata: bool = True
    include_individual_results: bool = True


@dataclass(frozen=True)
class Integration:
    include_separators: bool = True
    sort_files: bool = True
    encoding: str = "utf-8"
    result_dir: str = "result"
    create_metadata: bool = True


@dataclass(frozen=True)
class Steps:
    """Which optional stages run; rendering and tiling always do.  A stage that is off passes its rows on."""

    judge: bool = False
    rotate: bool = False
    split: bool = True
    recognize: bool = True
    integrate: bool = True


@dataclass(frozen=True)
class SuperResolution:
    enabled: bool = False


@dataclass(frozen=True)
class Settings:
    render: Render = field(default_factory=Render)
    judge: Judge = field(default_factory=Judge)
    dewarp: Dewarp = field(default_factory=Dewarp)
    orientation: Orientation = field(default_factory=Orientation)
    tiling: Tiling = field(default_factory=Tiling)
    ocr: Ocr = field(default_factory=Ocr)
    integration: Integration = field(default_factory=Integration)
    steps: Steps = field(default_factory=Steps)
    super_resolution: SuperResolution = field(default_factory=SuperResolution)
    #: Where True, known quirks of the original behaviour are reproduced instead of the documented intent.
    compat: bool = False


def overlay(base: Any, values: dict) -> Any:
    """A copy of a settings object with nested values laid over; unknown keys are an error."""
    known = {f.name for f in fields(base)}
    if unknown := set(values) - known:
        raise KeyError(f"unknown settings: {sorted(unknown)}")
    return replace(base, **{k: overlay(getattr(base, k), v) if is_dataclass(getattr(base, k)) and isinstance(v, dict) else v for k, v in values.items()})


def apply_options(settings: Settings, options: dict[str, bool] | None) -> Settings:
    """The three skip options, each honoured by the stage it names."""
    options = options or {}
    if options.get("skip_super_resolution"):
        settings = overlay(settings, {"super_resolution": {"enabled": False}})
    if options.get("skip_dewarping"):
        settings = overlay(settings, {"dewarp": {"enabled": False}})
    if options.get("skip_ocr"):
        settings = overlay(settings, {"ocr": {"enabled": False}, "steps": {"recognize": False}})
    return settings


def read_mapping(path: str) -> dict:
    """A settings or prompt file: JSON, or YAML as far as such files use it."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    return json.loads(text) if path.endswith(".json") else plain_yaml.loads(text) or {}


def load_settings(path: str | None = None, options: dict[str, bool] | None = None) -> Settings:
    return apply_options(overlay(Settings(), read_mapping(path)) if path else Settings(), options)


def load_prompts(settings_path: str, name: str = "prompts", root: str | None = None) -> dict[str, dict[str, str]]:
    """Prompts beside the settings file, else below ``root``/config; {} where there are none."""
    for folder in (os.path.dirname(os.path.abspath(settings_path)), os.path.join(root or os.getcwd(), "config")):
        for end in (".json", ".yaml"):
            if os.path.exists(path := os.path.join(folder, name + end)):
                return read_mapping(path)
    return {}


def full_prompt(prompt: dict[str, str]) -> str:
    """System and user parts with a blank line between."""
    return f"{prompt.get('system', '')}\n\n{prompt.get('user', '')}"


def load_env(path: str) -> dict[str, str]:
    """KEY=value lines into the environment where unset; returns what the file holds.  No file: nothing."""
    out: dict[str, str] = {}
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            for line in f:
                key, eq, value = line.strip().partition("=")
                if eq and key and not key.startswith("#"):
                    out[key.strip()] = value.strip().strip("'\"")
                    os.environ.setdefault(key.strip(), out[key.strip()])
    return out
