"""Typed configuration and its validation.

Secrets are read from the environment where the configuration leaves them out.
"""

from __future__ import annotations

import base64
import json
import os
from dataclasses import dataclass, field
from typing import Any

DATA_SOURCES = ("toc", "list", "table", "json")
KEY_VARIABLE = "MODEL_API_KEY"


@dataclass(frozen=True)
class ApiConfig:
    url: str
    key: str
    model: str = ""
    max_tokens: int = 4096
    temperature: float = 0.01
    max_retries: int = 3
    retry_base_delay: float = 5.0
    single_timeout: float = 60.0
    task_timeout: float = 300.0
    api_interval: float = 2.0
    max_consecutive_failures: int = 5
    open_seconds: float = 60.0
    verify_tls: bool = True


@dataclass(frozen=True)
class RunConfig:
    name: str = "task"
    resume: bool = True
    retry_failed: bool = False
    max_workers: int = 5
    output_dir: str = ""
    progress_path: str = ""
    filename_pattern: str = ""
    title_prefix: str = ""
    system: str = ""
    template: str = ""
    chunk_size: int = 20_000
    notify: bool = True
    notify_tasks: int = 10
    notify_seconds: float = 300.0
    chat_id: str = ""
    app_id: str = ""


@dataclass(frozen=True)
class Config:
    api: ApiConfig
    run: RunConfig
    pdf_path: str = ""
    data_source: str = "json"
    data_path: str = ""
    page_ranges: dict[str, tuple[int, int]] = field(default_factory=dict)
    task_list: list[dict[str, Any]] = field(default_factory=list)


def parse(raw: dict, need_pdf: bool = False) -> Config:
    """Check the required keys and fill in the defaults; ValueError otherwise."""
    for section in ("api", "output"):
        if section not in raw:
            raise ValueError(f"config lacks the section {section!r}")
    api, inp, out, run, notify, prompt = (raw.get(k) or {} for k in ("api", "input", "output", "settings", "notify", "prompt"))
    key = api.get("key") or os.environ.get(KEY_VARIABLE, "")
    if not api.get("url"):
        raise ValueError("config lacks api.url")
    if not key:
        raise ValueError(f"config lacks api.key, and {KEY_VARIABLE} is not set")
    if need_pdf and not inp.get("pdf_path"):
        raise ValueError("config lacks input.pdf_path")
    source = inp.get("data_source", "json")
    if source not in DATA_SOURCES:
        raise ValueError(f"unknown input.data_source {source!r}")
    if out.get("format", "markdown") != "markdown":
        raise ValueError(f"unknown output.format {out['format']!r}")
    ranges = {}
    for group, pages in (inp.get("page_ranges") or {}).items():
        first, last = pages
        if first < 1:
            raise ValueError(f"page range of {group!r} starts before page 1")
        ranges[group] = (int(first), int(last))
    folder = out.get("dir", "")
    return Config(
        ApiConfig(
            api["url"], key, api.get("model", ""), int(api.get("max_tokens", 4096)), float(api.get("temperature", 0.01)), int(run.get("max_retries", 3)), float(run.get("retry_base_delay", 5.0)),
            float(run.get("single_timeout", 60)), float(run.get("task_timeout", 300)), float(run.get("api_interval", 2.0)), int(run.get("max_consecutive_failures", 5)),
        ),
        RunConfig(
            raw.get("name", "task"), bool(run.get("resume", True)), bool(run.get("retry_failed", False)), int(run.get("max_workers", 5)), folder, raw.get("progress_path") or (f"{folder}/_progress" if folder else ""),
            out.get("filename_pattern", ""), out.get("title_prefix", ""), prompt.get("system", ""), prompt.get("template", ""), int(prompt.get("chunk_size", 20_000)),
            bool(notify.get("enabled", True)), int(notify.get("interval_tasks", 10)), float(notify.get("interval_seconds", 300)), notify.get("chat_id", ""), notify.get("app_id", ""),
        ),
        inp.get("pdf_path", ""), source, inp.get("data_path", ""), ranges, list(inp.get("task_list") or []),
    )


def load(path: str, need_pdf: bool = False) -> Config:
    with open(path, encoding="utf-8") as f:
        return parse(json.load(f), need_pdf)


def to_base64(raw: dict) -> str:
    """A configuration as base64 of its JSON, without its secret."""
    plain = {**raw, "api": {k: v for k, v in (raw.get("api") or {}).items() if k != "key"}}
    return base64.b64encode(json.dumps(plain, ensure_ascii=False).encode()).decode()


def from_base64(text: str) -> dict:
    return json.loads(base64.b64decode(text).decode())
