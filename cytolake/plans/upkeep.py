"""Housekeeping around runs: optional imports, guarded settings, outside commands, old artefacts."""

from __future__ import annotations

import importlib
import os
import shutil
import subprocess
import time
from collections.abc import Sequence
from pathlib import Path
from types import ModuleType


def soft_import(name: str) -> tuple[ModuleType | None, Exception | None]:
    """The module, or the error that kept it from being imported."""
    try:
        return importlib.import_module(name), None
    except Exception as e:  # a broken optional dependency is as good as none
        return None, e


def require_settings(settings: dict[str, str]) -> None:
    """Raises, naming them all, if environment variables do not have the wanted values."""
    wrong = {k: os.environ.get(k) for k, v in settings.items() if os.environ.get(k) != v}
    if wrong:
        raise RuntimeError("run with " + " ".join(f"{k}={settings[k]}" for k in sorted(wrong)))


def run_steps(steps: Sequence[tuple[str, list[str]]], timeout: float | None = None) -> list[dict]:
    """Runs commands one after the other; a failed one ends the run. name, returncode, seconds of each that ran."""
    out = []
    for name, command in steps:
        t = time.time()
        done = subprocess.run(command, check=False, timeout=timeout)
        out.append({"name": name, "returncode": done.returncode, "seconds": round(time.time() - t, 3)})
        if done.returncode:
            break
    return out


def retire(folder: str, keep_days: float = 7, everything: bool = False, now: float | None = None) -> list[str]:
    """Deletes the entries of a local folder that are older than keep_days (all of them if everything), and returns their names."""
    top, edge = Path(folder), (time.time() if now is None else now) - keep_days * 86_400
    gone = []
    for p in sorted(top.iterdir()) if top.is_dir() else []:
        if everything or p.stat().st_mtime < edge:
            shutil.rmtree(p) if p.is_dir() and not p.is_symlink() else p.unlink()
            gone.append(p.name)
    return gone
