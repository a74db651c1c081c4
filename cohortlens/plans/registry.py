"""Named queries: a Spark callable and, where SQL can say it, an equivalent statement."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
# Statement and the shared expressions it needs; put together once all modules are loaded.
STATEMENTS: dict[str, tuple[str, tuple[str, ...]]] = {}

# Common table expressions shared by the SQL statements: name -> (needs, body).
CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, body: str, *needs: str) -> None:
    CTES[name] = (needs, body)


def statement(body: str, *needs: str) -> str:
    """Prefix a statement with the shared expressions it needs, in dependency order."""
    order: list[str] = []

    def visit(name: str) -> None:
        for other in CTES[name][0]:
            visit(other)
        if name not in order:
            order.append(name)

    for name in needs:
        visit(name)
    parts = [f"{name} AS ({CTES[name][1]})" for name in order]
    text = body.strip()
    if text.upper().startswith("WITH "):
        head, text = text[5:], ""
        return "WITH " + ", ".join([*parts, head])
    return ("WITH " + ", ".join(parts) + " " if parts else "") + text


def query(name: str, sql: str | None = None, *needs: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"Query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            STATEMENTS[name] = (sql, needs)
        return fn

    return register


def rounded(df: DataFrame, digits: int = 6, *columns: str) -> DataFrame:
    """Round double columns (all of them by default) so that summation order does not show."""
    names = columns or [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: F.round(F.col(c), digits) for c in names})


def text_id(prefix: str, number: Column, width: int) -> Column:
    """Prefix and number, padded to ``width`` digits; a longer number keeps all its digits."""
    digits = number.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0")))
