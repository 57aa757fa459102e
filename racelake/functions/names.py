"""Column-name helpers (driver-side metadata only; no data is touched)."""

from __future__ import annotations

import re

_WHITESPACE_RUN = re.compile(r"\s+")


def to_snake_case(name: str) -> str:
    """Trim, casefold, and replace each run of whitespace with ``_``.

    Other characters are kept, so ``Event distance/length`` becomes
    ``event_distance/length``.
    """
    return _WHITESPACE_RUN.sub("_", name.strip().casefold())
