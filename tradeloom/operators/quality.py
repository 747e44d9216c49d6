"""Staged-row validation, quarantine, integrity checks and acceptance gates.

Rules are data: a name and the condition under which a row breaks it. Every check of a table is
evaluated in one pass over it.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions import (
    as_date,
    as_decimal,
    as_int,
    as_seconds,
    clean,
    computed_once,
    join_reasons,
    present,
    stripped,
)
from tradeloom.schemas import (
    EXPECTED_COUNTS,
    LOAD_ERROR_CODES,
    ORPHAN_ERROR_CODES,
    RETAIL_EVENTS_RAW,
)

Rules = Mapping[str, Column]


def _holds(condition: Column) -> Column:
    """The condition with null read as false."""
    return F.coalesce(condition, F.lit(False))


def _any(rules: Rules) -> Column:
    return reduce(lambda a, b: a | b, (_holds(c) for c in rules.values()))


def _not_above(number: Column, bound: int) -> Column:
    return number.isNull() | (number <= bound)


def _below(number: Column, bound: int) -> Column:
    return number.isNull() | (number < bound)


def clean_strings(rows: DataFrame) -> DataFrame:
    """Every string column without carriage returns and outer spaces, empty as null."""
    return rows.select(*[clean(c).alias(c) if t == "string" else F.col(c) for c, t in rows.dtypes])


def promotion_reference_broken(flag: Column, promotion: Column) -> Column:
    """A promoted sale names its promotion and an unpromoted one names none."""
    return ((flag == "Y") & promotion.isNull()) | ((flag == "N") & promotion.isNotNull())


def product_rules() -> Rules:
    return {
        "product_id": ~present("product_id"),
        "product_name": ~present("product_name"),
        "category": ~present("category"),
        "base_unit_price": _not_above(as_decimal("base_unit_price"), 0),
    }


def store_rules() -> Rules:
    return {c: ~present(c) for c in ("store_id", "store_city", "province", "store_region")}


def promotion_rules() -> Rules:
    start, end, rate = as_date("start_date"), as_date("end_date"), as_decimal("discount_rate", 6, 4)
    return {
        "promotion_id": ~present("promotion_id"),
        "product_id": ~present("product_id"),
        "promotion_name": ~present("promotion_name"),
        "start_date": start.isNull(),
        "end_date": end.isNull() | (end < start),
        "discount_rate": _not_above(rate, 0) | (rate > 1),
    }


def read_sale_lines(staged: DataFrame) -> DataFrame:
    """Cleaned text of every staged column, and next to it the values read from the text.

    Each value is read once per row; the rules and the load then look at plain columns.
    """
    cleaned = {c: clean(c) for c in RETAIL_EVENTS_RAW.fieldNames()}
    values = {
        "read_timestamp": as_seconds("event_timestamp"),
        "read_quantity": as_int("quantity"),
        "read_unit_price": as_decimal("unit_price"),
        "read_discount_amount": as_decimal("discount_amount"),
        "read_final_price": as_decimal("final_price"),
    }
    line = F.struct(*[c.alias(n) for n, c in {**cleaned, **values}.items()])
    return computed_once(staged, "line", line).select("line.*")


SMALLINT_MAX = 32767


def retail_event_rules() -> Rules:
    """Rules on the columns of ``read_sale_lines``. A required value that is missing breaks its rule."""
    quantity = F.col("read_quantity")
    return {
        "event_id": F.col("event_id").isNull(),
        "transaction_id": F.col("transaction_id").isNull(),
        "store_id": F.col("store_id").isNull(),
        "event_timestamp": F.col("read_timestamp").isNull(),
        "product_id": F.col("product_id").isNull(),
        "quantity": _not_above(quantity, 0) | (quantity > SMALLINT_MAX),
        "unit_price": _not_above(F.col("read_unit_price"), 0),
        "discount_amount": _below(F.col("read_discount_amount"), 0),
        "final_price": _below(F.col("read_final_price"), 0),
        "promotion_flag": ~_holds(F.col("promotion_flag").isin("Y", "N")),
        "loyalty_flag": ~_holds(F.col("loyalty_flag").isin("Y", "N")),
        "promotion_reference": promotion_reference_broken(
            F.col("promotion_flag"), F.col("promotion_id")
        ),
    }


# Text widths of the fixed-width target tables (fixed values), for the ``widths`` of a typed load.
TARGET_WIDTHS = {
    "product_name": 100,
    "category": 30,
    "store_city": 100,
    "province": 30,
    "store_region": 30,
    "promotion_name": 100,
    "payment_type": 20,
}


def _text(name: str, widths: Mapping[str, int] | None) -> Column:
    """Cleaned text, cut to the column's width when the load has widths; whole by default."""
    text = stripped(name)
    return F.substring(text, 1, widths[name]) if widths and name in widths else text


def typed_products(staged: DataFrame, widths: Mapping[str, int] | None = None) -> DataFrame:
    """Valid products with types."""
    return staged.filter(~_any(product_rules())).select(
        stripped("product_id").alias("product_id"),
        _text("product_name", widths).alias("product_name"),
        _text("category", widths).alias("category"),
        as_decimal("base_unit_price").alias("base_unit_price"),
    )


def typed_stores(staged: DataFrame, widths: Mapping[str, int] | None = None) -> DataFrame:
    """Valid stores."""
    return staged.filter(~_any(store_rules())).select(
        stripped("store_id").alias("store_id"),
        _text("store_city", widths).alias("store_city"),
        _text("province", widths).alias("province"),
        _text("store_region", widths).alias("store_region"),
    )


def typed_promotions(staged: DataFrame, widths: Mapping[str, int] | None = None) -> DataFrame:
    """Valid promotions with types."""
    return staged.filter(~_any(promotion_rules())).select(
        stripped("promotion_id").alias("promotion_id"),
        stripped("product_id").alias("product_id"),
        _text("promotion_name", widths).alias("promotion_name"),
        as_date("start_date").alias("start_date"),
        as_date("end_date").alias("end_date"),
        as_decimal("discount_rate", 6, 4).alias("discount_rate"),
    )


def typed_retail_events(staged: DataFrame, widths: Mapping[str, int] | None = None) -> DataFrame:
    """Valid sale lines with types."""
    typed = {
        "event_timestamp": F.col("read_timestamp"),
        "quantity": F.col("read_quantity").cast("smallint"),
        "unit_price": F.col("read_unit_price"),
        "discount_amount": F.col("read_discount_amount"),
        "final_price": F.col("read_final_price"),
    }
    typed |= {c: F.substring(c, 1, w) for c, w in (widths or {}).items()}
    lines = read_sale_lines(staged).filter(~_any(retail_event_rules()))
    return lines.select(*[typed.get(c, F.col(c)).alias(c) for c in RETAIL_EVENTS_RAW.fieldNames()])


# Staged table -> (reader of its rows, rules on what was read).
STAGED_RULES = {
    "Products": (lambda rows: rows, product_rules),
    "Stores": (lambda rows: rows, store_rules),
    "Promotions": (lambda rows: rows, promotion_rules),
    "RetailEvents": (read_sale_lines, retail_event_rules),
}


class LoadRejected(ValueError):
    """A load was stopped; ``code`` tells which check stopped it."""

    def __init__(self, code: int, message: str):
        super().__init__(f"{code}: {message}")
        self.code = code


def fail_fast_gate(staged: DataFrame, table: str) -> DataFrame:
    """Return the staged rows, or stop the load when any of them is invalid.

    The search ends at the first invalid row.
    """
    read, rules = STAGED_RULES[table]
    if not read(staged).filter(_any(rules())).isEmpty():
        raise LoadRejected(LOAD_ERROR_CODES[table], f"{table} has rows with invalid required values")
    return staged


def rule_violations(rows: DataFrame, rules: Rules) -> DataFrame:
    """Rows broken per rule, as (rule_name, violations), from one pass."""
    counted = rows.agg(*[F.count_if(_holds(c)).alias(n) for n, c in rules.items()])
    return counted.unpivot([], list(rules), "rule_name", "violations")


def quarantine_rules() -> list[tuple[Column, str]]:
    """Condition and text of each quarantine reason (fixed values).

    The quantity is read as INT here and as SMALLINT in the load, so 40000 is invalid there only.
    """
    return [
        (F.col("transaction_id").isNull(), "Missing transaction_id"),
        (F.col("read_timestamp").isNull(), "Invalid event_timestamp"),
        (_not_above(F.col("read_quantity"), 0), "Invalid quantity"),
        (_not_above(F.col("read_unit_price"), 0), "Invalid unit_price"),
        (_below(F.col("read_final_price"), 0), "Invalid final_price"),
    ]


QUARANTINE_FALLBACK = "Failed source-data validation"


def quarantine(lines: DataFrame) -> DataFrame:
    """Cleaned text of lines from ``read_sale_lines`` with the reasons for which they stay out, and when
    that was found."""
    reason = F.coalesce(
        F.nullif(join_reasons(quarantine_rules()), F.lit("")), F.lit(QUARANTINE_FALLBACK)
    )
    return lines.select(
        *RETAIL_EVENTS_RAW.fieldNames(),
        reason.alias("rejection_reason"),
        F.current_timestamp().alias("rejected_at"),
    )


def quarantine_reasons(staged: DataFrame) -> DataFrame:
    """Quarantine rows of a staged table: the invalid ones, with reasons."""
    return quarantine(read_sale_lines(staged).filter(_any(retail_event_rules())))


def check_constraint_rules() -> Rules:
    """Constraints on typed sale lines, as conditions that break them."""
    return {
        "quantity_positive": F.col("quantity") <= 0,
        "unit_price_positive": F.col("unit_price") <= 0,
        "discount_not_negative": F.col("discount_amount") < 0,
        "final_price_not_negative": F.col("final_price") < 0,
        "promotion_flag_domain": ~F.col("promotion_flag").isin("Y", "N"),
        "loyalty_flag_domain": ~F.col("loyalty_flag").isin("Y", "N"),
        "promotion_reference": promotion_reference_broken(
            F.col("promotion_flag"), F.col("promotion_id")
        ),
    }


def price_rules() -> Rules:
    return {"base_unit_price_positive": F.col("base_unit_price") <= 0}


def promotion_table_rules() -> Rules:
    return {
        "date_range": F.col("end_date") < F.col("start_date"),
        "discount_rate_range": (F.col("discount_rate") <= 0) | (F.col("discount_rate") > 1),
    }


def check_constraints(events: DataFrame) -> DataFrame:
    return rule_violations(events, check_constraint_rules())


def orphans(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Fact rows whose non-null ``key`` is unknown to the dimension.

    Spark broadcasts the dimension's keys by their measured size, and splits a hot key otherwise.
    """
    return facts.filter(F.col(key).isNotNull()).join(dimension.select(key), key, "left_anti")


def foreign_key_audit(
    facts: DataFrame, dimensions: Mapping[str, tuple[DataFrame, str]], table: str
) -> DataFrame:
    """Broken references per foreign key, as (table_name, column_name, violations).

    The fact table is read once: it is counted per combination of key column and value first, so
    each join sees one row per distinct value instead of one per fact.
    """
    columns = list(dimensions)
    counted = (
        facts.select(
            F.inline(
                F.array(
                    *[
                        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("key_value"))
                        for c in columns
                    ]
                )
            )
        )
        .filter("key_value is not null")
        .groupBy("column_name", "key_value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = reduce(
        DataFrame.unionByName,
        [
            dimension.select(
                F.lit(c).alias("column_name"),
                F.col(key).cast("string").alias("key_value"),
                F.lit(True).alias("known"),
            )
            for c, (dimension, key) in dimensions.items()
        ],
    ).dropDuplicates(["column_name", "key_value"])
    broken = (
        counted.join(known, ["column_name", "key_value"], "left")
        .groupBy("column_name")
        .agg(F.sum(F.when(F.col("known").isNull(), F.col("n")).otherwise(0)).alias("violations"))
    )
    # A key column without any value has no counted row, and an empty table has none at all.
    every = facts.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    return every.join(broken, "column_name", "left").select(
        F.lit(table).alias("table_name"),
        "column_name",
        F.coalesce("violations", F.lit(0)).cast("long").alias("violations"),
    )


def insert_missing_lookup(target: DataFrame, incoming: DataFrame, column: str) -> DataFrame:
    """Target values and the incoming ones it lacks, each once."""
    new = incoming.select(column).distinct().join(target.select(column), column, "left_anti")
    return target.select(column).unionByName(new)


def duplicate_key_check(rows: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("occurrences")).filter("occurrences > 1")


def table_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One (table_name, record_count) row per table."""
    return reduce(
        DataFrame.unionByName,
        [
            rows.agg(F.count(F.lit(1)).alias("record_count")).select(
                F.lit(name).alias("table_name"), "record_count"
            )
            for name, rows in tables.items()
        ],
    )


def expected_count_gate(
    counts: DataFrame, expected: Mapping[str, tuple[int, int]] = EXPECTED_COUNTS
) -> DataFrame:
    """Compare counts to expectations: (table_name, record_count, expected_count, code, passed)."""
    spark = counts.sparkSession
    wanted = spark.createDataFrame(
        [(n, int(c), code) for n, (c, code) in expected.items()],
        "table_name string, expected_count long, code int",
    )
    return wanted.join(counts, "table_name", "left").select(
        "table_name",
        F.coalesce("record_count", F.lit(0)).alias("record_count"),
        "expected_count",
        "code",
        F.coalesce(F.col("record_count") == F.col("expected_count"), F.lit(False)).alias("passed"),
    )


def require_expected_counts(counts: DataFrame, expected=EXPECTED_COUNTS) -> None:
    """Stop at the failed expectation with the lowest code."""
    failed = expected_count_gate(counts, expected).filter(~F.col("passed")).orderBy("code").first()
    if failed is not None:
        raise LoadRejected(
            failed["code"],
            f"{failed['table_name']} has {failed['record_count']} rows, "
            f"not {failed['expected_count']}",
        )


def require_no_orphans(facts: DataFrame, dimensions: Mapping[str, DataFrame]) -> None:
    """Stop when a product, store or promotion reference is unknown."""
    for key, code in ORPHAN_ERROR_CODES.items():
        if key in dimensions and not orphans(facts, dimensions[key], key).isEmpty():
            raise LoadRejected(code, f"sale lines with unknown {key}")


# --- Transactions of the batch models ---------------------------------------------------------

_REQUIRED = (
    "transaction_id product_type beneficiary_country currency amount issue_date goods_category "
    "amendment_count document_count processing_days discrepancy_flag delay_flag "
    "counterparty_relationship_years customer_risk_rating"
).split()
_NUMERIC = (
    "amount amendment_count document_count processing_days discrepancy_flag delay_flag "
    "counterparty_relationship_years"
).split()


def transaction_validation(rows: DataFrame) -> DataFrame:
    """Problems per check, as (check_name, problems): unreadable numbers and dates, repeated ids.

    One pass for the column checks, one aggregation by id for the repeats.
    """
    missing = sorted(set(_REQUIRED) - set(rows.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    checks = {
        **{c: F.col(c).cast("string").try_cast("double").isNull() for c in _NUMERIC},
        "issue_date": F.col("issue_date").cast("string").try_cast("date").isNull(),
    }
    counted = rows.agg(*[F.count_if(c).alias(n) for n, c in checks.items()])
    columns = counted.unpivot([], list(checks), "check_name", "problems")
    repeats = duplicate_key_check(rows, "transaction_id").agg(
        F.coalesce(F.sum("occurrences"), F.lit(0)).alias("problems")
    )
    return columns.unionByName(
        repeats.select(F.lit("duplicate_transaction_id").alias("check_name"), "problems")
    )


def require_valid_transactions(rows: DataFrame) -> DataFrame:
    """Return the rows, or raise with the checks that found problems."""
    failed = transaction_validation(rows).filter("problems > 0").collect()
    if failed:
        raise ValueError("invalid transactions: " + ", ".join(f"{r[0]}={r[1]}" for r in failed))
    if rows.isEmpty():
        raise ValueError("no transactions")
    return rows
