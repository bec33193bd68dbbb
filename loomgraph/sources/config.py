"""Options of a run from flags and environment; flags come first."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass


@dataclass(frozen=True)
class Options:
    repo_root: str = ""
    repo_name: str = ""
    since: str = ""
    full: bool = False
    cross_repo_prefix: str = ""
    scip_path: str = ""
    scip_repo: str = ""
    poll_seconds: float = 2.0
    http_seconds: float = 60.0
    base_url: str = ""
    token_url: str = ""
    client_id: str = ""
    client_secret: str = ""


def env_key(flag: str) -> str:
    return flag.upper().replace("-", "_")


def load(flags: Mapping[str, str], env: Mapping[str, str] | None = None) -> Options:
    """Flag over environment over default; the repository's name is that of its folder.

    An index needs the name of its repository; a token address needs a client and its secret.
    """
    source = os.environ if env is None else env
    get = lambda name, default="": flags.get(name) or source.get(env_key(name), default)
    scip, scip_repo = get("scip"), get("scip-repo")
    if scip and not scip_repo:
        raise ValueError("--scip needs --scip-repo")
    root = "" if scip else get("repo-root")
    if not scip and not root:
        raise ValueError("--repo-root is missing")
    if get("token-url") and not (get("client-id") and get("client-secret")):
        raise ValueError("a token address needs client-id and client-secret")
    return Options(
        repo_root=root, repo_name=get("repo-name") or os.path.basename(root.rstrip("/")), since=get("since"), full=get("full", "false").lower() == "true", cross_repo_prefix=get("cross-repo-prefix"),
        scip_path=scip, scip_repo=scip_repo, poll_seconds=float(get("poll-interval", "2")), http_seconds=float(get("http-timeout", "60")),
        base_url=get("base-url"), token_url=get("token-url"), client_id=get("client-id"), client_secret=get("client-secret"),
    )
