"""The model call as a distributed map with flow control.

A backend answers one prompt.  ``call_model`` runs it over a prompt table in
Arrow batches; retry, back-off, time limits, spacing and the circuit breaker
work inside each partition.  The overall call rate stays bounded because the
number of partitions is fixed and each spaces its calls by that many
intervals.  Errors are data: every prompt gives one row.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..sources.config import ApiConfig

ERROR_MOST = 500
RESULT = "task_id string, success boolean, content string, error string, attempts int, elapsed double"


class RateLimitError(RuntimeError):
    """The service asks for fewer calls."""


class TaskTimeoutError(RuntimeError):
    """A task ran out of its time."""


class BreakerOpenError(RuntimeError):
    """Too many failures in a row; no calls for a while."""


class Backend(Protocol):
    def complete(self, prompt: str, system: str | None) -> str: ...


@dataclass
class MockBackend:
    """Deterministic and offline: repeats the first line; fails on a marker."""

    fail_on: str = ""

    def complete(self, prompt: str, system: str | None) -> str:
        if self.fail_on and self.fail_on in prompt:
            raise RuntimeError("mock failure")
        return "answer: " + prompt.split("\n", 1)[0]


@dataclass
class HttpBackend:
    """Chat-completion endpoint over HTTP, with TLS checks on."""

    config: ApiConfig

    def complete(self, prompt: str, system: str | None) -> str:
        messages = [{"role": "system", "content": system}] if system else []
        body = {"model": self.config.model, "messages": [*messages, {"role": "user", "content": prompt}], "temperature": self.config.temperature, "max_tokens": self.config.max_tokens, "stream": False}
        request = urllib.request.Request(self.config.url, json.dumps(body).encode(), {"Authorization": f"Bearer {self.config.key}", "Content-Type": "application/json"})
        try:
            with urllib.request.urlopen(request, timeout=self.config.single_timeout) as answer:
                return read_answer(json.loads(answer.read()))
        except urllib.error.HTTPError as e:
            raise (RateLimitError if e.code == 429 else RuntimeError)(f"HTTP {e.code}") from e


def read_answer(answer: dict) -> str:
    """Text of a chat-completion answer; an error body or no choice raises."""
    if "error" in answer:
        message = str((answer["error"] or {}).get("message", answer["error"]) if isinstance(answer["error"], dict) else answer["error"])
        raise (RateLimitError if "rate" in message.lower() else RuntimeError)(message)
    if not answer.get("choices"):
        raise RuntimeError("the answer holds no choices")
    return answer["choices"][0]["message"]["content"].strip()


@dataclass
class Client:
    """Spacing, retries, back-off, task time limit and breaker around a backend."""

    backend: Backend
    config: ApiConfig
    interval: float
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    on_retry: Callable[[int, str, float], None] | None = None
    failures: int = 0
    open_until: float = -1.0
    last: float = field(default=float("-inf"))
    calls: int = 0
    failed_calls: int = 0

    def reset(self) -> None:
        self.failures, self.open_until = 0, -1.0

    def stats(self) -> dict:
        return {"total_calls": self.calls, "total_failures": self.failed_calls, "consecutive_failures": self.failures, "breaker_open": self.clock() < self.open_until}

    def _space(self) -> None:
        wait = self.last + self.interval - self.clock()
        if wait > 0:
            self.sleep(wait)
        self.last = self.clock()

    def call(self, prompt: str, system: str | None = None) -> dict:
        began = self.clock()
        if began < self.open_until:
            return {"success": False, "content": None, "error": "circuit breaker open", "attempts": 0, "elapsed": 0.0}
        self.calls += 1
        error, attempt = "", 0
        for attempt in range(1, self.config.max_retries + 1):
            try:
                if self.clock() - began > self.config.task_timeout:
                    raise TaskTimeoutError("task timeout")
                self._space()
                content = self.backend.complete(prompt, system)
                self.failures = 0
                return {"success": True, "content": content, "error": None, "attempts": attempt, "elapsed": self.clock() - began}
            except Exception as e:  # noqa: BLE001  an error is a result
                error = f"{type(e).__name__}: {e}"[:ERROR_MOST]
                if isinstance(e, TaskTimeoutError) or attempt == self.config.max_retries:
                    break
                wait = self.config.retry_base_delay * 2 ** (attempt - 1)
                if self.on_retry:
                    self.on_retry(attempt, error, wait)
                self.sleep(wait)
        self.failures += 1
        self.failed_calls += 1
        if self.failures >= self.config.max_consecutive_failures:
            self.open_until = self.clock() + self.config.open_seconds
        return {"success": False, "content": None, "error": error, "attempts": attempt, "elapsed": self.clock() - began}


def call_model(prompts: DataFrame, backend: Backend, config: ApiConfig, workers: int = 5, system: str | None = None, on_retry=None) -> DataFrame:
    """prompts (task_id, prompt) to RESULT rows; write the result down before using it twice.

    Rows are dealt out by id over ``workers`` partitions, each with spacing
    ``workers * api_interval``.  ``on_retry(attempt, error, wait)`` is called on
    the executor before each wait.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = Client(backend, config, config.api_interval * workers, on_retry=on_retry)
        for frame in frames:
            rows = [{"task_id": i, **client.call(p, system or None)} for i, p in zip(frame["task_id"], frame["prompt"], strict=True)]
            yield pd.DataFrame(rows, columns=["task_id", "success", "content", "error", "attempts", "elapsed"]).astype({"attempts": "int32"})

    return prompts.select("task_id", "prompt").repartition(workers, "task_id").mapInPandas(run, RESULT)


def to_status(results: DataFrame) -> DataFrame:
    """Adds status; messages are cut."""
    return results.withColumn("status", F.when(F.col("success"), "success").otherwise("failed")).withColumn("error", F.left("error", F.lit(ERROR_MOST)))
