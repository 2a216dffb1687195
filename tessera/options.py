"""Options of servers, users and tables: which exist where, and what they become in Spark."""

from __future__ import annotations

from collections.abc import Mapping

SERVER, USER, TABLE = "server", "user", "table"

#: Every option with the places it may stand.
OPTIONS: dict[str, frozenset[str]] = {
    "database": frozenset({SERVER}),
    "attach_catalogs": frozenset({SERVER}),
    "extensions": frozenset({SERVER}),
    "use_remote_estimate": frozenset({SERVER}),
    "s3_region": frozenset({SERVER}),
    "s3_endpoint": frozenset({SERVER}),
    "s3_endpoint_type": frozenset({SERVER}),
    "s3_use_ssl": frozenset({SERVER}),
    "s3_access_key_id": frozenset({SERVER, USER}),
    "s3_secret_access_key": frozenset({SERVER, USER}),
    "table": frozenset({TABLE}),
    "read_parquet": frozenset({TABLE}),
}

#: Hadoop settings that the object-store options set.
HADOOP = {
    "s3_region": "fs.s3a.endpoint.region",
    "s3_endpoint": "fs.s3a.endpoint",
    "s3_use_ssl": "fs.s3a.connection.ssl.enabled",
    "s3_access_key_id": "fs.s3a.access.key",
    "s3_secret_access_key": "fs.s3a.secret.key",
}

SECRETS = frozenset({"s3_access_key_id", "s3_secret_access_key"})


class OptionError(ValueError):
    pass


def validated(options: Mapping[str, str], place: str) -> dict[str, str]:
    """The options as strings; an unknown one, or one in the wrong place, is an error."""
    for name in options:
        if place not in OPTIONS.get(name, ()):
            raise OptionError(f"invalid option {name!r} for a {place}")
    return {k: str(v) for k, v in options.items()}


def truth(value: str | bool | None) -> bool:
    """Option text as a boolean."""
    text = str(value).strip().lower()
    if text in ("true", "on", "yes", "1"):
        return True
    if text in ("false", "off", "no", "0", "none", ""):
        return False
    raise OptionError(f"not a boolean: {value!r}")


def catalogs(text: str) -> list[tuple[str, str, dict[str, str]]]:
    """``name=uri;key value, name=uri`` as (name, uri, settings); ``key=value`` settings are read too."""
    found = []
    for entry in filter(None, (e.strip() for e in text.split(","))):
        head, *rest = (p.strip() for p in entry.split(";"))
        name, sep, uri = head.partition("=")
        if not sep or not name.strip() or not uri.strip():
            raise OptionError(f"a catalog is written name=uri, not {entry!r}")
        settings = {}
        for part in filter(None, rest):
            key, _, value = part.partition("=") if "=" in part else part.partition(" ")
            settings[key.strip().lower()] = value.strip()
        found.append((name.strip(), uri.strip(), settings))
    return found
