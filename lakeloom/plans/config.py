"""Settings of the linkage plans."""

from __future__ import annotations

import json
from dataclasses import dataclass, fields
from pathlib import Path


@dataclass
class Settings:
    dataset_dir: str = "dataset"
    output_dir: str = "output"
    model_dir: str = "models"
    random_seed: int = 42
    max_token_freq: int = 10
    anchor_cap: int = 100_000
    test_size: float = 0.2
    beta: float = 0.5


def read_settings(path: str) -> dict:
    """A JSON file, or YAML where that library is installed. A missing file is an error."""
    text = Path(path).read_text()
    if path.endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ImportError:  # flat `key: value` lines
        pairs = (line.split("#")[0].split(":", 1) for line in text.splitlines() if ":" in line.split("#")[0])
        return {k.strip(): json.loads(v.strip()) if v.strip()[:1] in '0123456789-"tfn' else v.strip() for k, v in pairs}
    return yaml.safe_load(text) or {}


def resolved(root: str, path: str) -> str:
    """A path of a settings file: relative ones are below root; absolute ones and those with a scheme stay."""
    return path if "://" in path or Path(path).is_absolute() else str(Path(root).resolve() / path)


class Manager:
    """The settings files of a folder: `default` at the top, each other one that exists under its own name."""

    def __init__(self, folder: str, parts: tuple[str, ...] = ("blocking", "features", "model")):
        self.values: dict = {}
        for name in ("default", *parts):
            found = [p for p in (Path(folder) / f"{name}{end}" for end in (".yaml", ".json")) if p.exists()]
            if found:
                read = read_settings(str(found[0]))
                self.values |= read if name == "default" else {name: read}

    def get(self, key: str, default: object = None) -> object:
        return self.values.get(key, default)


def load(*paths: str) -> Settings:
    """Defaults, then each file's values over those before; unknown keys are left alone."""
    known, values = {f.name for f in fields(Settings)}, {}
    for p in paths:
        values |= {k: v for k, v in read_settings(p).items() if k in known}
    return Settings(**values)
