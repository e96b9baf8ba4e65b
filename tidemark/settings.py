"""Settings of a job from the environment and an optional ``.env`` file.

``TIDEMARK_ROOT``, ``TIDEMARK_STAGE`` and ``TIDEMARK_LOG`` describe the job.  A feed
``F`` has its own group ``TIDEMARK_FEED_<F>_<FIELD>``: ``MODE`` (which of its addresses is
used), ``URL_<MODE>`` for each address, and any other field as a credential.  Nothing is
cached: a changed environment shows in the next ``load``.  Credentials are masked in
``repr`` and never reach a plan.
"""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path

PREFIX, FEED = "TIDEMARK_", "FEED_"


class Secret(str):
    """A string whose representation hides its value."""

    def __repr__(self) -> str:
        return "Secret('***')" if self else "Secret('')"


@dataclass(frozen=True)
class FeedAccess:
    """Addresses of a feed by mode, the mode in use, and its credentials."""

    mode: str = ""
    urls: Mapping[str, str] = field(default_factory=dict)
    credentials: Mapping[str, Secret] = field(default_factory=dict)

    @property
    def url(self) -> str:
        if self.mode not in self.urls:
            raise ValueError(f"no address for mode {self.mode!r}; known: {sorted(self.urls)}")
        return self.urls[self.mode]


def read_env_file(path: str | Path) -> dict[str, str]:
    """``KEY=value`` lines of a ``.env`` file; blanks and comments are skipped."""
    found: dict[str, str] = {}
    path = Path(path)
    if not path.is_file():
        return found
    for line in path.read_text(encoding="utf-8").splitlines():
        name, sep, value = line.strip().removeprefix("export ").partition("=")
        if sep and not name.startswith("#"):
            found[name.strip()] = value.strip().strip("'\"")
    return found


def _feeds(values: Mapping[str, str], names: tuple[str, ...]) -> dict[str, FeedAccess]:
    out = {}
    for name in names:
        head = f"{FEED}{name.upper()}_"
        mine = {k.removeprefix(head).lower(): v for k, v in values.items() if k.startswith(head)}
        if mine:
            urls = {k.removeprefix("url_"): v for k, v in mine.items() if k.startswith("url_")}
            rest = {k: Secret(v) for k, v in mine.items() if k != "mode" and not k.startswith("url_")}
            out[name] = FeedAccess(mine.get("mode", next(iter(sorted(urls)), "")), urls, rest)
    return out


@dataclass(frozen=True)
class Settings:
    root: str = "lake"
    stage: str = "local"
    log: str = "info"
    feeds: Mapping[str, FeedAccess] = field(default_factory=dict)

    @classmethod
    def load(cls, env_file: str | Path = ".env", environ: Mapping[str, str] | None = None, feeds: tuple[str, ...] | None = None) -> Settings:
        """Environment over ``env_file`` over defaults; unknown keys are ignored."""
        if feeds is None:
            from tidemark.sources.feeds import FEEDS

            feeds = tuple(f.name for f in FEEDS)
        merged = read_env_file(env_file) | dict(os.environ if environ is None else environ)
        mine = {k.removeprefix(PREFIX): v for k, v in merged.items() if k.startswith(PREFIX)}
        plain = {k: mine[k.upper()] for k in ("root", "stage", "log") if k.upper() in mine}
        return cls(**plain, feeds=_feeds(mine, feeds))
