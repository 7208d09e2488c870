"""Small driver-side inputs: pool specs, endpoints, environment files, prompts, secrets' lookup."""

from __future__ import annotations

import os
import re
import tomllib
from dataclasses import dataclass, field
from pathlib import Path
from urllib.parse import urlsplit

from ..functions.contract import Prompt, build_prompt


class ConfigError(ValueError):
    """An input that is refused, with the reason."""


@dataclass(frozen=True)
class Group:
    """``select`` maps a column to the values it may have; ``size`` 0 takes every eligible row."""

    name: str
    table: str
    stratum: str
    select: dict[str, tuple[str, ...]] = field(default_factory=dict, hash=False)
    alloc: str = "proportional"


@dataclass(frozen=True)
class Spec:
    tables: dict[str, dict[str, str]]
    groups: tuple[Group, ...]
    sizes: dict[str, dict[str, int]]


def _values(name: str, column: str, value) -> tuple[str, ...]:
    values = (value,) if isinstance(value, str) else value
    if not isinstance(values, (list, tuple)) or not all(isinstance(v, str) for v in values):
        raise ConfigError(f"group {name}: select.{column} must be a text or a list of texts")
    return tuple(values)


def spec_of(raw: dict, root: str = "") -> Spec:
    """A spec from its TOML tables; paths that aren't absolute are taken from ``root``."""
    for section in ("tables", "groups", "sizes"):
        if not raw.get(section):
            raise ConfigError(f"the spec has no [{section}]")
    tables = {}
    for name, entry in raw["tables"].items():
        if "rows" not in entry:
            raise ConfigError(f"table {name} names no rows")
        tables[name] = {k: p if os.path.isabs(p) or "://" in p or not root else os.path.join(root, p) for k, p in entry.items()}
    groups = []
    for name, entry in raw["groups"].items():
        if entry.get("table") not in tables:
            raise ConfigError(f"group {name} names the table {entry.get('table')!r}, which the spec lacks")
        if entry.get("alloc", "proportional") not in ("proportional", "equal"):
            raise ConfigError(f"group {name}: alloc must be proportional or equal")
        select = {c: _values(name, c, v) for c, v in entry.get("select", {}).items()}
        groups.append(Group(name, entry["table"], entry.get("stratum", ""), select, entry.get("alloc", "proportional")))
    for pool, sizes in raw["sizes"].items():
        if unknown := set(sizes) - {g.name for g in groups}:
            raise ConfigError(f"pool {pool} sizes unknown groups: {', '.join(sorted(unknown))}")
    return Spec(tables, tuple(groups), raw["sizes"])


def load_spec(path: str, root: str = "") -> Spec:
    return spec_of(tomllib.loads(Path(path).read_text()), root)


def parse_sizes(text: str) -> dict[str, int]:
    """``kept=45,positive=13`` as a mapping."""
    sizes = {}
    for part in filter(None, (p.strip() for p in text.split(","))):
        name, _, number = part.partition("=")
        if not re.fullmatch(r"\d+", number.strip()):
            raise ConfigError(f"{part!r} is not group=number")
        sizes[name.strip()] = int(number)
    return sizes


def pool_sizes(spec: Spec, pool: str, override: str = "") -> dict[str, int]:
    if pool not in spec.sizes:
        raise ConfigError(f"the spec has no pool {pool!r}; it has {', '.join(spec.sizes)}")
    sizes = spec.sizes[pool] | parse_sizes(override)
    if unknown := set(sizes) - {g.name for g in spec.groups}:
        raise ConfigError(f"unknown groups: {', '.join(sorted(unknown))}")
    return sizes


def env_lines(text: str) -> dict[str, str]:
    """Variables of a dotenv text: ``export`` and quotes are allowed, # starts a comment line."""
    found = {}
    for line in text.splitlines():
        m = re.match(r"\s*(?:export\s+)?([A-Za-z_]\w*)\s*=\s*(.*?)\s*$", line)
        if m and not line.lstrip().startswith("#"):
            value = m[2]
            found[m[1]] = value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "\"'" else value
    return found


def read_env(path: str) -> dict[str, str]:
    return env_lines(Path(path).read_text()) if path and Path(path).exists() else {}


@dataclass(frozen=True)
class Endpoint:
    name: str
    model: str
    base_url: str = ""
    api_key: str = field(default="", repr=False)
    concurrency: int = 8
    min_concurrency: int = 1
    max_concurrency: int = 64
    chat_path: str = "chat/completions"
    models_path: str = "models"
    key_header: str = ""
    headers: dict = field(default_factory=dict, hash=False)
    extra: dict = field(default_factory=dict, hash=False)
    drop: tuple[str, ...] = ()


def endpoints_of(raw: dict, only: list[str] | None = None, env: dict[str, str] | None = None) -> list[Endpoint]:
    """The enabled endpoints of a TOML document; names in ``only`` must exist."""
    entries = raw.get("endpoint", raw.get("endpoints", []))
    names = [e.get("name", "") for e in entries]
    if only and (unknown := sorted(set(only) - set(names))):
        raise ConfigError(f"unknown endpoints: {', '.join(unknown)}")
    found = []
    for e in entries:
        if not e.get("enabled", True) or (only and e.get("name") not in only):
            continue
        if lacking := [k for k in ("name", "model") if not e.get(k)]:
            raise ConfigError(f"an endpoint lacks {', '.join(lacking)}")
        found.append(endpoint_of(e, dict(os.environ) | read_env(e.get("env_file", "")) | (env or {})))
    if not found:
        raise ConfigError("no endpoint is enabled")
    return found


def load_endpoints(path: str, only: list[str] | None = None) -> list[Endpoint]:
    return endpoints_of(tomllib.loads(Path(path).read_text()), only)


def endpoint_of(entry: dict, values: dict[str, str]) -> Endpoint:
    """One endpoint: URL and key stand in the entry, or in ``values`` under the names that it gives.

    An entry may give several names, of which the first that is set counts. A backend that answers by itself needs no URL; an entry that names one where none is set is refused.
    """
    url, key = (entry.get(k) or first_set(names_of(entry.get(n)), values) for k, n in (("base_url", "url_key"), ("api_key", "key_key")))
    if not url and entry.get("url_key"):
        raise ConfigError(f"endpoint {entry['name']}: {' or '.join(names_of(entry['url_key']))} is not set")
    known = {k: entry[k] for k in ("chat_path", "models_path", "key_header", "headers", "extra") if k in entry}
    known |= {k: int(entry[k]) for k in ("concurrency", "min_concurrency", "max_concurrency") if k in entry}
    return Endpoint(entry["name"], entry["model"], with_version(url), key, drop=tuple(entry.get("drop", ())), **known)


def names_of(names: str | list[str] | tuple[str, ...] | None) -> list[str]:
    return [names] if isinstance(names, str) else list(names or [])


def first_set(names: list[str], *stores) -> str:
    """The value of the first name that any store has, by names first and stores second; empty if none has.

    A store is a mapping, or a function from a name to its value or None, as secret stores are.
    """
    for name in names:
        for store in stores:
            if value := (store(name) if callable(store) else store.get(name)):
                return value
    return ""


def single_endpoint(model: str, url: str, api_key: str = "", headers: tuple[str, ...] = (), **options) -> Endpoint:
    """One endpoint from options, named after its host; headers are texts of the form Name: value."""
    if not model or not url:
        raise ConfigError("an endpoint needs a model and a URL")
    base = with_version(url)
    entry = {"name": urlsplit(base).netloc, "model": model, "base_url": url, "api_key": api_key, "headers": dict(header(h) for h in headers)}
    return endpoint_of(entry | options, {})


def with_version(url: str) -> str:
    """A host without a scheme gets https, one without a path /v1; a URL with a path stays."""
    if not url:
        return ""
    url = url if "://" in url else f"https://{url}"
    return url.rstrip("/") + "/v1" if re.fullmatch(r"[a-z]+://[^/?]+/?", url) else url.rstrip("/")


def join_url(base: str, path: str) -> str:
    """The path after the base's own path, with the base's query string last."""
    head, mark, query = base.partition("?")
    return f"{head.rstrip('/')}/{path.lstrip('/')}{mark}{query}"


def header(text: str) -> tuple[str, str]:
    name, colon, value = text.partition(":")
    if not colon or not name.strip():
        raise ConfigError(f"{text!r} is not Name: value")
    return name.strip(), value.strip()


def load_prompt(place: str, user: str | None = None) -> Prompt:
    """A prompt from ``system.md`` and ``user.md`` in a folder, or from two files of any name."""
    paths = {"system": Path(place), "user": Path(user)} if user else {n: Path(place) / f"{n}.md" for n in ("system", "user")}
    texts = {n: p.read_text() for n, p in paths.items() if p.exists()}
    if "user" not in texts or (user and "system" not in texts):
        raise ConfigError(f"there is no file {paths['user'] if 'user' not in texts else paths['system']}")
    return build_prompt(Path(place).stem if user else Path(place).name, texts.get("system", ""), texts["user"])
