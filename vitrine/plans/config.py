"""Settings from the environment."""

from __future__ import annotations

import os
from dataclasses import dataclass

# --- fixed values: names and defaults ------------------------------------------------------------------------------
NETWORKS = {"kb": "Красное & Белое", "monetka": "Монетка", "maria_ra": "Мария-Ра"}
PREFIX = "STORE_PARSER_"
KB_URL, MONETKA_URL, MARIA_RA_URL, MARIA_RA_MAP_URL = "https://krasnoeibeloe.ru", "https://www.monetka.ru", "https://www.maria-ra.ru", "https://www.maria-ra.ru/o-kompanii/karta-seti/"
# ------------------------------------------------------------------------------------------------------------------


def _text(name: str, default: str) -> str:
    return (os.environ.get(PREFIX + name) or "").strip() or default


def _whole(name: str, default: int, least: int) -> int:
    """A whole number not below the least; anything else is the default."""
    try:
        v = int(_text(name, str(default)))
    except ValueError:
        return default
    return v if v >= least else default


def _seconds(name: str) -> float:
    """A number of seconds not below 0; anything else is none."""
    try:
        v = float(_text(name, "0"))
    except ValueError:
        return 0.0
    return v if 0 <= v < float("inf") else 0.0


@dataclass(frozen=True)
class Config:
    output: str
    snapshot: str | None
    log_file: str
    log_level: str
    timeout: int
    retries: int
    kb_url: str
    monetka_url: str
    maria_ra_url: str
    maria_ra_map_url: str
    landing: str | None = None  # folder of a run's responses: a run started again with it requests only what is missing
    pace: float = 0.0  # least seconds between two requests to a host


def load_env_file(path: str = ".env") -> None:
    """S19. NAME=value lines, those already set stay."""
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            for line in f:
                name, eq, value = line.strip().partition("=")
                if eq and not name.startswith("#"):
                    os.environ.setdefault(name.strip(), value.strip().strip("'\""))


def from_env() -> Config:
    """S18."""
    site = lambda n, d: _text(n, d).rstrip("/")
    return Config(
        _text("OUTPUT", "output/stores.xlsx"), _text("SNAPSHOT", "") or None, _text("LOG_FILE", "logs/parser.log"), _text("LOG_LEVEL", "INFO").upper(), _whole("TIMEOUT", 20, 1), _whole("RETRIES", 3, 0),
        site("KB_BASE_URL", KB_URL), site("MONETKA_BASE_URL", MONETKA_URL), site("MARIA_RA_BASE_URL", MARIA_RA_URL), site("MARIA_RA_MAP_URL", MARIA_RA_MAP_URL) + "/",
        _text("LANDING", "") or None, _seconds("PACE"),
    )
