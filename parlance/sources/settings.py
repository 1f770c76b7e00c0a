"""Settings from arguments, the environment and an env file, in that order."""

from __future__ import annotations

import os
from dataclasses import dataclass
from pathlib import Path

FILE, URL, KEY, MODEL, TIMEOUT = "PARLANCE_ENV_FILE", "OPENAI_BASE_URL", "OPENAI_API_KEY", "OPENAI_MODEL", "OPENAI_TIMEOUT_SECONDS"


@dataclass(frozen=True)
class Settings:
    base_url: str
    api_key: str
    model: str
    timeout_seconds: float = 30.0

    def __repr__(self) -> str:
        return f"Settings(base_url={self.base_url!r}, model={self.model!r}, timeout_seconds={self.timeout_seconds})"


def env_lines(text: str) -> dict[str, str]:
    """NAME=value lines; blank lines, # lines and lines without = are skipped; one pair of quotes around a value goes."""
    out = {}
    for line in map(str.strip, text.splitlines()):
        name, equals, value = line.partition("=")
        if line.startswith("#") or not equals or not name.strip():
            continue
        value = value.strip()
        if len(value) > 1 and value[0] == value[-1] and value[0] in "\"'":
            value = value[1:-1]
        out[name.strip()] = value
    return out


def load_env_file(path: str | None = None) -> None:
    """Sets what the environment does not have yet."""
    file = Path(path or os.environ.get(FILE) or ".env")
    if file.exists():
        for name, value in env_lines(file.read_text("utf-8")).items():
            os.environ.setdefault(name, value)


def get_settings(base_url: str | None = None, api_key: str | None = None, model: str | None = None, timeout_seconds: float | None = None) -> Settings:
    load_env_file()
    found = {}
    for field, name, given in (("base_url", URL, base_url), ("api_key", KEY, api_key), ("model", MODEL, model)):
        found[field] = given or os.environ.get(name, "")
        if not found[field]:
            raise ValueError(f"Missing setting: {name}")
    return Settings(**found, timeout_seconds=float(timeout_seconds if timeout_seconds is not None else os.environ.get(TIMEOUT, 30)))
