"""A session over the standard library's HTTP client, in the shape that the sources ask for."""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Any
from urllib.error import HTTPError
from urllib.parse import urlencode
from urllib.request import Request, urlopen


@dataclass(frozen=True)
class Answer:
    status_code: int
    content: bytes

    def json(self) -> Any:
        return json.loads(self.content)

    def raise_for_status(self) -> None:
        if self.status_code >= 400:
            raise RuntimeError(f"status {self.status_code}")


class WebSession:
    """Error statuses are answers, network errors are raised (as OSError)."""

    def get(self, url: str, headers: dict | None = None, params: dict | None = None, timeout: float = 20.0) -> Answer:
        full = f"{url}?{urlencode(params)}" if params else url
        try:
            with urlopen(Request(full, headers=headers or {}), timeout=timeout) as got:
                return Answer(got.status, got.read())
        except HTTPError as error:
            return Answer(error.code, error.read())
