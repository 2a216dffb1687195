"""Quoting of names and values for SQL text, checks of user-given fragments, redaction of secrets."""

from __future__ import annotations

import re

_SIMPLE_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
_CONTROL = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")
_SECRET = re.compile(r"secret|key_id|access_key|token|password|credential", re.I)


class UnsafeSqlError(ValueError):
    """A fragment could end the statement it stands in, or hide part of it."""


def is_simple_name(name: str) -> bool:
    return bool(_SIMPLE_NAME.fullmatch(name or ""))


def quote_name(name: str) -> str:
    """One name as a Spark SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def quote_path(*parts: str) -> str:
    """A name of several parts, each quoted."""
    return ".".join(map(quote_name, parts))


def quote_text(value: str) -> str:
    """A string as a Spark SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def checked_fragment(text: str) -> str:
    """``text`` itself if it cannot chain statements, hold comments or control characters."""
    if not text or not text.strip():
        raise UnsafeSqlError("empty SQL fragment")
    if ";" in text or "--" in text or "/*" in text or "*/" in text or _CONTROL.search(text):
        raise UnsafeSqlError("a SQL fragment may not hold ';', comments or control characters")
    return text


def redacted(message: str) -> str:
    """An error message that is safe to show: none of it if it may hold a secret."""
    return "operation failed (details withheld: they may hold credentials)" if _SECRET.search(message or "") else message or "operation failed"
