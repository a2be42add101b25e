"""Polling the feeds and landing their snapshots as JSON lines.

The HTTP session, the message decoder and the clock are parameters, so nothing here needs a network or a library of
its own; ``wire.decode`` reads the feeds' binary messages.
"""

from __future__ import annotations

import json
import logging
import os
import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from datetime import UTC, datetime
from pathlib import Path
from typing import Any, Protocol

log = logging.getLogger(__name__)
WAITS_S = (2, 4, 8)
TIMEOUT_S = 20.0


class Session(Protocol):
    def get(self, url: str, **options: Any) -> Any: ...


class Store(Protocol):
    """Where landed files are copied to."""

    def upload(self, path: str, content: Any, overwrite: bool = True) -> None: ...


class Refused(RuntimeError):
    """The server refuses the request; asking again won't help."""


@dataclass(frozen=True)
class Settings:
    """What to poll, how often, and where to land it."""

    api_key: str
    urls: dict[str, str]
    landing: Path
    interval_s: float = 30.0
    headers: dict[str, str] = field(default_factory=dict)

    @classmethod
    def from_environment(cls, env: dict[str, str] | None = None) -> Settings:
        """FEED_API_KEY, FEED_URL_<NAME>, LANDING_DIR and POLL_INTERVAL_S; the key and one address are needed."""
        env = dict(os.environ if env is None else env)
        urls = {k[9:].lower(): v for k, v in env.items() if k.startswith("FEED_URL_")}
        if not env.get("FEED_API_KEY") or not urls:
            raise ValueError("FEED_API_KEY and an address FEED_URL_<NAME> must be set")
        return cls(env["FEED_API_KEY"], urls, Path(env.get("LANDING_DIR", "landing")), float(env.get("POLL_INTERVAL_S", 30)))


def _worth_retrying(status: int) -> bool:
    return status == 429 or status >= 500


def fetch(session: Session, url: str, api_key: str, sleep: Callable[[float], None] = time.sleep, waits: Iterable[float] = WAITS_S) -> bytes:
    """The body of a snapshot. Network errors, 429 and 5xx are tried again after each wait; other errors are final."""
    waits = [*waits, None]
    for wait in waits:
        try:
            answer = session.get(url, headers={"api_key": api_key}, timeout=TIMEOUT_S)
            status = answer.status_code
            if status < 400:
                return answer.content
            if not _worth_retrying(status):
                raise Refused(f"{url}: status {status}")
            trouble: Exception = RuntimeError(f"{url}: status {status}")
        except OSError as error:  # what HTTP libraries' network errors derive from
            trouble = error
        if wait is None:
            raise trouble
        log.warning("%s; next try in %s s", trouble, wait)
        sleep(wait)
    raise AssertionError("unreachable")


def records(message: dict, feed: str, fetched_at: datetime) -> Iterator[dict]:
    """One record per entity of a decoded message, with what all of them share."""
    shared = {"feed": feed, "feed_header_ts": str(message["header"]["timestamp"]), "fetched_at": fetched_at.isoformat()}
    for entity in message.get("entity", []):
        yield shared | {"entity": entity}


def landing_file(root: Path, feed: str, header_ts: int) -> Path:
    """Named after the snapshot's own time, so one snapshot has one file."""
    day = datetime.fromtimestamp(header_ts, UTC).date().isoformat()
    return root / feed / f"ingest_date={day}" / f"{feed}_{header_ts}.jsonl"


def land(path: Path, rows: Iterable[dict]) -> int:
    """Writes the file whole: under a hidden name first, which readers skip."""
    path.parent.mkdir(parents=True, exist_ok=True)
    part, n = path.parent / f".{path.name}.part", 0
    try:
        with part.open("w", encoding="utf-8") as out:
            for row in rows:
                out.write(json.dumps(row, ensure_ascii=False, separators=(",", ":")) + "\n")
                n += 1
        os.replace(part, path)
    finally:
        part.unlink(missing_ok=True)
    return n


class Mirror:
    """Copies landed files to a store, under the same relative path."""

    def __init__(self, store: Store, root: Path, target: str) -> None:
        self.store, self.root, self.target = store, Path(root), target.rstrip("/")

    def place(self, path: Path) -> str:
        return f"{self.target}/{Path(path).relative_to(self.root).as_posix()}"

    def copy(self, path: Path) -> str:
        place = self.place(path)
        with Path(path).open("rb") as content:
            self.store.upload(place, content, overwrite=True)
        return place


def poll_once(
    session: Session, settings: Settings, decode: Callable[[bytes], dict], mirror: Mirror | None = None,
    now: Callable[[], datetime] = lambda: datetime.now(UTC), sleep: Callable[[float], None] = time.sleep,
) -> dict[str, int]:
    """Lands each feed's snapshot unless it is there already; a feed that fails doesn't stop the others.

    Returns records landed by feed: 0 for a snapshot that was there, -1 for a failure.
    """
    done = {}
    for feed, url in settings.urls.items():
        try:
            message = decode(fetch(session, url, settings.api_key, sleep))
            path = landing_file(settings.landing, feed, int(message["header"]["timestamp"]))
            done[feed] = 0 if path.exists() else land(path, records(message, feed, now()))
            if done[feed] and mirror:
                mirror.copy(path)
        except Exception:
            log.exception("feed %s failed", feed)
            done[feed] = -1
    return done


def poll(session: Session, settings: Settings, decode: Callable[[bytes], dict], times: int, **options: Any) -> dict[str, int]:
    """Polls at a fixed pace; returns records landed by feed. An error if nothing landed at all."""
    sleep = options.get("sleep", time.sleep)
    total, start = dict.fromkeys(settings.urls, 0), time.monotonic()
    for n in range(times):
        for feed, landed in poll_once(session, settings, decode, **options).items():
            total[feed] += max(0, landed)
        if n + 1 < times:
            sleep(max(0.0, start + (n + 1) * settings.interval_s - time.monotonic()))
    if not any(total.values()):
        raise RuntimeError("no poll landed a record")
    return total


def download(session: Session, url: str, api_key: str, folder: Path, version_of: Callable[[Path], str]) -> Path:
    """A static release, named by the version that it states; written under a temporary name first."""
    folder.mkdir(parents=True, exist_ok=True)
    part = folder / ".release.part"
    part.write_bytes(fetch(session, url, api_key))
    target = folder / f"{version_of(part)}.zip"
    os.replace(part, target)
    return target


def main(argv: list[str] | None = None) -> int:
    """Polls the feeds as the environment says."""
    import argparse

    from punctual.sources import wire
    from punctual.sources.web import WebSession

    p = argparse.ArgumentParser(description="Polls the feeds and lands their snapshots.")
    p.add_argument("--polls", type=int, default=1)
    p.add_argument("--json", action="store_true", help="the feeds answer in JSON, not in binary messages")
    args = p.parse_args(argv)
    done = poll(WebSession(), Settings.from_environment(), json.loads if args.json else wire.decode, args.polls)
    print(json.dumps(done))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
