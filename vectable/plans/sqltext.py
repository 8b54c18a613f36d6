"""Names and literals quoted for Spark SQL expressions."""

from __future__ import annotations


def quoted_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
