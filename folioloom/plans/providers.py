"""Model providers: who answers a prompt, with retry, fallback chain and round robin.

A provider is an object with ``reply(request) -> str``; it may raise. Providers
are pickled to the executors, so they open connections in ``reply`` only.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol


@dataclass(frozen=True)
class Request:
    """One model call: which analysis of which book, the prompt, and the pictures as (mime, bytes)."""

    analysis: str
    book_id: str
    prompt: str
    images: tuple[tuple[str, bytes], ...] = ()
    temperature: float = 0.0


class Provider(Protocol):
    def reply(self, request: Request) -> str: ...


class ProviderError(RuntimeError):
    """A provider gave no answer."""


@dataclass(frozen=True)
class StubProvider:
    """Answers from a function of the request; deterministic, for tests and dry runs."""

    answer: Callable[[Request], str]

    def reply(self, request: Request) -> str:
        return self.answer(request)


@dataclass(frozen=True)
class ReplayProvider:
    """Answers from a mapping (analysis, book_id) -> reply, as recorded from earlier runs."""

    replies: dict = field(default_factory=dict)

    def reply(self, request: Request) -> str:
        try:
            return self.replies[request.analysis, request.book_id]
        except KeyError:
            raise ProviderError(f"no recorded reply for {request.analysis} of {request.book_id}") from None


@dataclass(frozen=True)
class HttpProvider:
    """Posts prompt and pictures as JSON to an address and returns the text under ``path`` of the JSON reply."""

    url: str
    model: str
    api_key: str | None = None
    path: tuple = ("choices", 0, "message", "content")
    timeout_s: float = 120.0

    def reply(self, request: Request) -> str:
        import base64
        import urllib.request

        parts: list[dict] = [{"type": "text", "text": request.prompt}]
        parts += [{"type": "image_url", "image_url": {"url": f"data:{mime};base64,{base64.b64encode(data).decode()}"}} for mime, data in request.images]
        body = {"model": self.model, "temperature": request.temperature, "messages": [{"role": "user", "content": parts}]}
        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {self.api_key}"} if self.api_key else {})
        call = urllib.request.Request(self.url, json.dumps(body).encode(), headers)
        with urllib.request.urlopen(call, timeout=self.timeout_s) as answer:
            found = json.load(answer)
        for step in self.path:
            found = found[step]
        return found


@dataclass(frozen=True)
class RetryPolicy:
    """Waits between tries: ``first_ms`` times ``factor`` to the power of the try, at most ``cap_ms``."""

    retries: int
    first_ms: float
    factor: float = 1.0
    cap_ms: float = 10_000

    def delays_ms(self) -> list[int]:
        return [int(min(self.cap_ms, self.first_ms * self.factor**k)) for k in range(self.retries)]


# -- fixed values: the two retry policies
CONSTANT = RetryPolicy(retries=3, first_ms=200)
EXPONENTIAL = RetryPolicy(retries=2, first_ms=300, factor=1.5, cap_ms=10_000)


@dataclass(frozen=True)
class Retrying:
    """Tries again after any error, with the policy's waits; the last error is raised."""

    inner: Provider
    policy: RetryPolicy
    sleep: Callable[[float], None] = time.sleep

    def reply(self, request: Request) -> str:
        for delay in self.policy.delays_ms():
            try:
                return self.inner.reply(request)
            except Exception:
                self.sleep(delay / 1000)
        return self.inner.reply(request)


@dataclass(frozen=True)
class FirstOf:
    """The answer of the first provider that gives one, in order."""

    chain: tuple[Provider, ...]

    def reply(self, request: Request) -> str:
        errors = []
        for one in self.chain:
            try:
                return one.reply(request)
            except Exception as error:
                errors.append(f"{type(error).__name__}: {error}")
        raise ProviderError("; ".join(errors) or "no providers")


@dataclass(frozen=True)
class RoundRobin:
    """Spreads books over providers by a hash of their id, so that a repeated task asks the same one."""

    members: tuple[Provider, ...]

    def reply(self, request: Request) -> str:
        return self.members[self.turn(request.book_id)].reply(request)

    def turn(self, book_id: str) -> int:
        """The place of the provider of a book: the first 32 bits of the md5 of its id, by the number of providers."""
        return int(hashlib.md5(book_id.encode(), usedforsecurity=False).hexdigest()[:8], 16) % len(self.members)


class Registry:
    """Providers by name; ``build`` makes one from a configuration."""

    def __init__(self):
        self._made: dict[str, Provider] = {}

    def add(self, name: str, provider: Provider) -> Provider:
        if name in self._made:
            raise ValueError(f"provider {name!r} is there already")
        self._made[name] = provider
        return provider

    def get(self, name: str) -> Provider:
        try:
            return self._made[name]
        except KeyError:
            raise ValueError(f"no provider {name!r}; there are {sorted(self._made)}") from None

    def build(self, name: str, spec: dict) -> Provider:
        """kind: http (url, model, ...), fallback (of), round_robin (of); ``retry`` is 'constant', 'exponential' or a policy."""
        spec = dict(spec)
        retry = spec.pop("retry", None)
        kind = spec.pop("kind")
        if kind == "http":
            made: Provider = HttpProvider(**spec)
        elif kind in ("fallback", "round_robin"):
            made = (FirstOf if kind == "fallback" else RoundRobin)(tuple(self.get(n) for n in spec["of"]))
        else:
            raise ValueError(f"unknown kind {kind!r}")
        if retry is not None:
            made = Retrying(made, {"constant": CONSTANT, "exponential": EXPONENTIAL}.get(retry, retry) if isinstance(retry, str) else retry)
        return self.add(name, made)
