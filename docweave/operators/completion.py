"""Completion backends and the operator that calls them.

A backend turns a prompt into a reply.  ``complete`` calls it once for every
row, in the partition where the row is: attempts with exponential waits, one
repair, dead letters in place of failures, a pause between calls.
"""

from __future__ import annotations

import json
import os
import time
import urllib.request
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class CompletionError(RuntimeError):
    """Any failure of a call; the only kind that is tried again."""


class Backend(Protocol):
    name: str
    model: str

    def open(self) -> Callable[[str, str, float, int], str]:
        """Called once in each partition; gives (system, prompt, temperature, max_tokens) -> reply."""


@dataclass(frozen=True)
class Rules:
    """Replies by a function of the prompt."""

    reply: Callable[[str], str]
    name: str = "rules"
    model: str = "none"

    def open(self) -> Callable[[str, str, float, int], str]:
        return lambda system, prompt, temperature, tokens: self.reply(prompt)


@dataclass(frozen=True)
class Http:
    """A chat-completions service.  kind: ``openrouter`` needs a key, ``ollama`` doesn't."""

    name: str
    model: str
    url: str
    key: str | None = None
    headers: dict[str, str] = field(default_factory=dict)
    timeout: float = 120.0

    def __post_init__(self):
        if self.name not in ("openrouter", "ollama"):
            raise ValueError(f"unknown completion backend: {self.name}")
        if not self.model or self.name == "openrouter" and not self.key:
            raise ValueError(f"{self.name} needs a model" + " and a key" * (self.name == "openrouter"))

    def open(self) -> Callable[[str, str, float, int], str]:
        def call(system: str, prompt: str, temperature: float, tokens: int) -> str:
            body = {"model": self.model, "temperature": temperature, "max_tokens": tokens, "messages": [{"role": "system", "content": system}, {"role": "user", "content": prompt}]}
            headers = {"Content-Type": "application/json", **self.headers} | ({"Authorization": f"Bearer {self.key}"} if self.key else {})
            with urllib.request.urlopen(urllib.request.Request(self.url, json.dumps(body).encode(), headers), timeout=self.timeout) as r:
                return json.load(r)["choices"][0]["message"]["content"]

        return call


def from_env(name: str, model: str = "", env: Mapping[str, str] | None = None) -> Http:
    """The service that a step's settings name; its address, key and default model come from variables (fixed values)."""
    env = os.environ if env is None else env
    value = lambda key, default="": env.get(key, default).partition("#")[0].strip()
    if name == "openrouter":
        headers = {k: v for k, v in (("HTTP-Referer", value("OPENROUTER_SITE_URL")), ("X-Title", value("OPENROUTER_APP_NAME"))) if v}
        return Http(name, model or value("OPENROUTER_MODEL"), f"{value('OPENROUTER_BASE_URL', 'https://openrouter.ai/api/v1')}/chat/completions", value("OPENROUTER_API_KEY"), headers)
    if name == "ollama":
        return Http(name, model or value("OLLAMA_MODEL"), f"{value('OLLAMA_OPENAI_BASE_URL', 'http://localhost:11434/v1')}/chat/completions")
    raise ValueError(f"unknown completion backend: {name}")


@dataclass(frozen=True)
class Recorded:
    """Replies that are kept in a table (prompt_sha256, reply); what isn't there fails."""

    replies: DataFrame
    name: str = "recorded"
    model: str = "none"

    def open(self) -> Callable[[str, str, float, int], str]:
        raise CompletionError("recorded replies are joined, see complete()")


def replayed(requests: DataFrame, recorded: DataFrame) -> DataFrame:
    """requests (..., prompt) with the recorded (prompt_sha256, reply); a join, so no service and no Python."""
    x = requests.withColumn("prompt_sha256", F.sha2(F.col("prompt").cast("binary"), 256)).join(recorded.select("prompt_sha256", "reply"), "prompt_sha256", "left").drop("prompt_sha256")
    return x.withColumn("error", F.when(F.col("reply").isNull(), "no recorded reply"))


def complete(
    requests: DataFrame, backend: Backend, system: str = "", temperature: float = 0.0, max_tokens: int = 900, attempts: int = 2, usable: Callable[[str], bool] | None = None,
    repair: Callable[[str, str], str] | None = None, repair_backend: Backend | None = None, pause: float = 0.0, wait: tuple[float, float] = (1.0, 20.0), parallelism: int = 0,
) -> DataFrame:
    """requests (..., prompt) with reply, error, repair_error, repaired.

    attempts counts all tries.  A reply that isn't usable is an error like any
    other.  When all tries fail, repair(prompt, error message) is asked once
    if given, of repair_backend if that is given too; what fails then keeps
    both errors and a null reply.  parallelism: calls at a time, if positive.
    """
    if isinstance(backend, Recorded):
        return replayed(requests, backend.replies).withColumn("repair_error", F.lit(None).cast("string")).withColumn("repaired", F.lit(False))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in requests.schema), "reply string", "error string", "repair_error string", "repaired boolean"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = backend.open()
        second = repair_backend.open() if repair_backend else first

        def once(call: Callable, prompt: str) -> str:
            try:
                reply = call(system, prompt, temperature, max_tokens)
            except Exception as e:
                raise CompletionError(str(e)) from e
            finally:
                if pause > 0:
                    time.sleep(pause)
            if usable and not usable(reply):
                raise CompletionError("the reply doesn't have the shape asked for")
            return reply

        def answer(prompt: str) -> tuple[str | None, str | None, str | None, bool]:
            error = ""
            for k in range(max(1, attempts)):
                if k:
                    time.sleep(min(wait[1], wait[0] * 2 ** (k - 1)))
                try:
                    return once(first, prompt), None, None, False
                except CompletionError as e:
                    error = str(e)
            if not repair:
                return None, error, None, False
            try:
                return once(second, repair(prompt, error)), None, None, True
            except CompletionError as e:
                return None, error, str(e), False

        for frame in frames:
            replies = [answer(p) for p in frame["prompt"]]
            yield frame.assign(**{c: pd.Series([r[k] for r in replies], index=frame.index, dtype=object) for k, c in enumerate(("reply", "error", "repair_error", "repaired"))})

    return (requests.repartition(parallelism) if parallelism > 0 else requests).mapInPandas(run, schema)
