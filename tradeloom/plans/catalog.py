"""Registry of named queries with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def plain(rows: DataFrame) -> DataFrame:
    """Output types that every client reads alike: decimals as double, dates and times as text."""
    columns = []
    for field in rows.schema.fields:
        c, kind = F.col(f"`{field.name}`"), field.dataType.typeName()
        if kind == "decimal":
            c = c.cast("double")
        elif kind == "date":
            c = c.cast("string")
        elif kind in ("timestamp", "timestamp_ntz"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        columns.append(c.alias(field.name))
    return rows.select(*columns)


def query(name: str, sql: str | None = None, relations: str = "") -> Callable[[Query], Query]:
    """Register a query; ``relations`` names the common table expressions its SQL refers to."""

    def register(build: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: plain(build(spark, sf_dir))
        if sql is not None:
            SQL[name] = with_relations(relations, sql)
        return build

    return register


def with_relations(relations: str, sql: str) -> str:
    """Prefix ``sql`` with the named relations and all they build on."""
    from tradeloom.plans.relations import RELATIONS

    ordered: list[str] = []

    def add(name: str) -> None:
        needs, _ = RELATIONS[name]
        for n in needs.split():
            add(n)
        if name not in ordered:
            ordered.append(name)

    for name in relations.split():
        add(name)
    if not ordered:
        return sql.strip()
    parts = ",\n".join(f"{n} AS ({RELATIONS[n][1].strip()})" for n in ordered)
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {parts},\n{body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {parts},\n{body[5:]}"
    return f"WITH {parts}\n{body}"
