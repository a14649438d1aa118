"""A ZIP of the code and results."""

from __future__ import annotations

import zipfile
from pathlib import Path

# fixed values
DOCUMENTS = ["docs/Documentation_template.md"]
LEFT_OUT = ["dataset", "logs", ".venv", ".git", "__pycache__", ".pytest_cache"]


def build_zip(root: str, target: str, results: dict[str, str], prefix: str = "code", left_out: list[str] = LEFT_OUT, documents: list[str] | None = None) -> list[str]:
    """Files under root below `prefix`, each result (name in the ZIP to path) that exists, and each document (a path under root) at the top; returns the names of missing results and documents."""
    base, out = Path(root).resolve(), Path(target).resolve()
    missing = []
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(base.rglob("*")):
            inner = p.relative_to(base)
            if p.is_file() and p.resolve() != out and not set(inner.parts) & set(left_out):
                z.write(p, f"{prefix}/{inner.as_posix()}")
        for name, path in results.items():
            found = Path(path)
            if found.is_dir():  # a result of several parts
                for part in sorted(found.glob("part-*")):
                    z.write(part, f"{name}/{part.name}")
            elif found.exists():
                z.write(found, name)
            else:
                missing.append(name)
        for name in documents or []:
            if (base / name).is_file():
                z.write(base / name, Path(name).name)
            else:
                missing.append(Path(name).name)
    return missing
