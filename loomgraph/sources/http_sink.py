"""Sink over HTTP: pushes graph batches in order and chunk items as a job, with retries.

The transport is a function, so that tests and other stores can take its place. Batches go one after
the other: a later batch of a push must not be applied before an earlier one.
"""

from __future__ import annotations

import json
import random
import time
from collections.abc import Callable, Iterable, Sized
from dataclasses import dataclass, field
from email.utils import parsedate_to_datetime

from loomgraph.schema import JOB_TERMINAL

# Bounds of retries and polls, in seconds.
RETRIES, BACKOFF, MOST_BACKOFF, MOST_RETRY_AFTER, MOST_POLL = 4, 0.2, 10.0, 60.0, 1800.0


@dataclass
class Response:
    status: int
    body: bytes = b""
    headers: dict = field(default_factory=dict)


Transport = Callable[[str, str, bytes | None], Response]


def retry_after(value: str | None, now: float | None = None, fractions: bool = False) -> float | None:
    """Seconds of a Retry-After header, given in seconds or as a date; capped; null where it says nothing."""
    if not value:
        return None
    try:
        seconds = float(value) if fractions else float(int(value))
    except ValueError:
        try:
            seconds = parsedate_to_datetime(value).timestamp() - (time.time() if now is None else now)
        except (TypeError, ValueError):
            return None
    return min(max(seconds, 0.0), MOST_RETRY_AFTER)


def backoff(attempt: int) -> float:
    return min(BACKOFF * 2**attempt, MOST_BACKOFF)


def retry_reason(status: int | None) -> str | None:
    """Why a call is tried again; null where it is not."""
    if status is None:
        return "network"
    if status == 429:
        return "shed_429"
    if status == 503:
        return "shed_503"
    return "server_5xx" if status >= 500 else None


def urllib_transport(base: str, token: Callable[[], str] | None = None, timeout: float = 60.0) -> Transport:
    import urllib.error
    import urllib.request

    def send(method: str, path: str, body: bytes | None) -> Response:
        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {token()}"} if token else {})
        request = urllib.request.Request(base.rstrip("/") + path, data=body, method=method, headers=headers)
        try:
            with urllib.request.urlopen(request, timeout=timeout) as r:
                return Response(r.status, r.read(), dict(r.headers))
        except urllib.error.HTTPError as e:
            return Response(e.code, e.read(), dict(e.headers))

    return send


def client_credentials(token_url: str, client_id: str, secret: str, audience: str = "", timeout: float = 60.0, post: Callable[[str, bytes], bytes] | None = None, clock: Callable[[], float] = time.time) -> Callable[[], str]:
    """A function that gives a bearer token of the client-credentials grant, kept until shortly before it expires."""
    import urllib.parse
    import urllib.request

    def send(url: str, body: bytes) -> bytes:
        request = urllib.request.Request(url, data=body, headers={"Content-Type": "application/x-www-form-urlencoded"})
        with urllib.request.urlopen(request, timeout=timeout) as r:
            return r.read()

    form = {"grant_type": "client_credentials", "client_id": client_id, "client_secret": secret} | ({"audience": audience} if audience else {})
    held: dict = {"token": "", "until": 0.0}

    def token() -> str:
        if not held["token"] or clock() >= held["until"]:
            answer = json.loads((post or send)(token_url, urllib.parse.urlencode(form).encode()))
            held.update(token=answer["access_token"], until=clock() + max(0.0, float(answer.get("expires_in", 0)) - 10))
        return held["token"]

    return token


def compact(value):
    """A JSON value without nulls, empty texts, zeros, empty lists and maps in objects."""
    if isinstance(value, dict):
        return {k: c for k, v in value.items() if (c := compact(v)) not in (None, "", 0, [], {}) or isinstance(v, bool)}
    return [compact(v) for v in value] if isinstance(value, (list, tuple)) else value


class Sink:
    def __init__(self, send: Transport, sleep: Callable[[float], None] = time.sleep, poll: float = 2.0):
        self.send, self.sleep, self.poll = send, sleep, poll
        self.retries: dict[str, int] = {}

    def call(self, method: str, path: str, payload=None) -> Response:
        body = None if payload is None else json.dumps(payload, ensure_ascii=False).encode()
        for attempt in range(RETRIES + 1):
            try:
                r = self.send(method, path, body)
            except OSError:
                r = None
            why = retry_reason(None if r is None else r.status)
            if why is None or attempt == RETRIES:
                if r is None:
                    raise ConnectionError(f"{method} {path}: no answer")
                if why or r.status >= 400:
                    raise RuntimeError(f"{method} {path}: status {r.status}")
                return r
            self.retries[why] = self.retries.get(why, 0) + 1
            wait = retry_after(r.headers.get("Retry-After")) if r is not None else None
            self.sleep(backoff(attempt) if wait is None else wait)
        raise AssertionError

    def push_graph(self, batches: Iterable[dict], path: str = "/graph") -> dict:
        """Sends batches in order, one at a time as they come, and sums the answers; the first failure ends it and names its batch."""
        of = f"/{len(batches)}" if isinstance(batches, Sized) else ""
        total: dict[str, int] = {}
        for k, b in enumerate(batches):
            try:
                answer = json.loads(self.call("POST", path, b).body or b"{}")
            except (RuntimeError, ConnectionError) as e:
                raise RuntimeError(f"batch {k + 1}{of}: {e}") from e
            for name, n in answer.items():
                if isinstance(n, int) and not isinstance(n, bool):
                    total[name] = total.get(name, 0) + n
        return total

    def push_items(self, repo: str, reconcile: list[str], items: list[dict], path: str = "/items") -> dict | None:
        """Sends items and waits for the job; nothing to do is nothing sent. Anything but success is an error."""
        if not reconcile and not items:
            return None
        r = self.call("POST", path, {"repo": repo, "reconcile_files": reconcile, "items": items})
        job, waited = json.loads(r.body or b"{}"), 0.0
        while r.status == 202 and job.get("status") not in JOB_TERMINAL:
            if waited >= MOST_POLL:
                raise TimeoutError(f"job {job.get('id')} did not end")
            self.sleep(self.poll)
            waited += self.poll
            job = json.loads(self.call("GET", f"/jobs/{job['id']}").body)
        if job.get("status") != "succeeded":
            raise RuntimeError(f"job {job.get('id')}: {job.get('status')}")
        return job


def complete(send: Transport, prompt: str, path: str = "/chat/completions", sleep: Callable[[float], None] = time.sleep, model: str = "") -> str:
    """One model answer in JSON mode at temperature 0, with one further try."""
    payload = json.dumps({"model": model, "temperature": 0, "response_format": {"type": "json_object"}, "messages": [{"role": "user", "content": prompt}]}).encode()
    for attempt in range(2):
        try:
            r = send("POST", path, payload)
        except OSError:
            r = None
        if r is not None and r.status < 400:
            choices = json.loads(r.body).get("choices") or []
            if not choices:
                raise RuntimeError("no choices")
            return choices[0]["message"]["content"]
        if attempt or r is not None and retry_reason(r.status) is None:
            raise RuntimeError(f"model: {'no answer' if r is None else r.status}")
        wait = retry_after(r.headers.get("Retry-After"), fractions=True) if r is not None else None
        sleep(0.5 + random.uniform(0, 0.25) if wait is None else wait)
    raise AssertionError
