"""Cells that can't be read: set aside with a reason, instead of failing the load.

The strict way is the default everywhere. Here metrics stay text until each has been tried; what
can't be read is named, and the same pass gives good rows and bad ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchmill.functions.columns import any_positive
from searchmill.operators.reshape import first_rows
from searchmill.schemas import COUNT_METRICS, FACT_COLUMNS, HISTORY_SCHEMA, METRICS

REASON = "reason"
TEXTS = {m: f"{m}_text" for m in METRICS}
NUMBERS = {m: f"{m}_number" for m in METRICS}

# Columns of a quarantine table; a bad row's metrics and date are kept as they were found.
BAD_COLUMNS = ["dt", "query", "page_path", *METRICS, REASON, "source_file"]


def is_no(column: str, text: Column, read: Column, what: str) -> Column:
    """The reason if there is a text that could not be read; else null."""
    return F.when(
        text.isNotNull() & read.isNull(),
        F.concat(F.lit(f"{column}: '"), text, F.lit(f"' is {what}")),
    )


def listed(reasons: list[Column]) -> Column:
    """All reasons of a row in one text; null if there are none."""
    return F.nullif(F.concat_ws("; ", *reasons), F.lit(""))


def metric_reasons(text: dict[str, Column], number: dict[str, Column]) -> list[Column]:
    found = []
    for metric, cell in text.items():
        found.append(is_no(metric, cell, number[metric], "no number"))
        if metric in COUNT_METRICS:
            found.append(
                F.when(
                    number[metric].isNotNull() & number[metric].try_cast("int").isNull(),
                    F.concat(F.lit(f"{metric}: '"), cell, F.lit("' is beyond INT")),
                )
            )
    return found


def read_metric(metric: str, number: Column) -> Column:
    """A metric as its final type, 0 for an empty or unreadable cell."""
    kind = "int" if metric in COUNT_METRICS else "double"
    return F.coalesce(number.try_cast(kind), F.lit(0).cast(kind))


def with_numbers(day: Column) -> Column:
    """A day of text cells with its numbers beside them, null where there is none.

    Each cell is tried once, here: a text that is no number costs an exception.
    """
    texts = [day[m].alias(m) for m in METRICS]
    return F.struct(day["dt"].alias("dt"), *texts, *[day[m].try_cast("double").alias(NUMBERS[m]) for m in METRICS])


def sheet_rows_to_checked(rows: DataFrame) -> DataFrame:
    """Facts of packed sheet rows with text cells, and what is wrong with them.

    `rows` are (source_file, row_no, query, page_path, days, reason): a row with a reason can't be
    taken apart at all. The result has the facts' columns, `source_file`, the metrics as found
    (`demand_text`, ...) and `reason`, null for good rows. Rows without traffic are left out if
    they are good. The first row of a query and page counts, whether its cells are good or
    not; rows that can't be taken apart don't count.
    """
    nothing = F.lit(None).cast("string")
    empty_day = F.struct(
        F.lit(None).cast("date").alias("dt"),
        *[nothing.alias(m) for m in METRICS],
        *[nothing.cast("double").alias(n) for n in NUMBERS.values()],
    )
    packed = rows.withColumn(
        "days",
        F.when(F.col(REASON).isNotNull(), F.array(empty_day)).otherwise(
            # Days that can't be a fact nor be wrong go before the shuffle.
            F.filter(F.transform("days", with_numbers), _matters)
        ),
    )
    # Each row that can't be taken apart is the first of its own kind.
    own = F.when(F.col(REASON).isNotNull(), F.col("row_no"))
    first = first_rows(packed.withColumn("_own", own), extra=["_own"])
    flat = first.select("source_file", "query", "page_path", F.col(REASON).alias("_row"), F.inline("days"))
    texts = {m: F.col(m) for m in METRICS}
    numbers = {m: F.col(n) for m, n in NUMBERS.items()}
    checked = flat.select(
        "source_file",
        "dt",
        "query",
        "page_path",
        *[read_metric(m, numbers[m]).alias(m) for m in METRICS],
        *[F.col(m).alias(TEXTS[m]) for m in METRICS],
        F.coalesce(F.col("_row"), listed(metric_reasons(texts, numbers))).alias(REASON),
    )
    return checked.where(
        F.col(REASON).isNotNull() | any_positive(*[F.col(m) for m in COUNT_METRICS])
    )


def _matters(day: Column) -> Column:
    wrong = [day[m].isNotNull() & day[NUMBERS[m]].isNull() for m in METRICS]
    carries = [F.coalesce(F.abs(day[NUMBERS[m]]) >= 1, F.lit(False)) for m in COUNT_METRICS]
    return any_of([*wrong, *carries])


def any_of(conditions: list[Column]) -> Column:
    first, *rest = conditions
    for condition in rest:
        first = first | condition
    return first


def good_facts(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(REASON).isNull()).select("source_file", *FACT_COLUMNS)


def bad_facts(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(REASON).isNotNull()).select(
        F.col("dt").cast("string").alias("dt"),
        "query",
        "page_path",
        *[F.col(TEXTS[m]).alias(m) for m in METRICS],
        REASON,
        "source_file",
    )


def check_history(rows: DataFrame) -> DataFrame:
    """History rows of text columns, typed as far as they can be read, with `reason` (null for good
    rows) and the texts (`id_text`, ...). A `reason` that is there already is kept."""
    read, reasons = [], []
    for field in HISTORY_SCHEMA:
        name, text = field.name, F.col(field.name)
        kind = field.dataType.simpleString()
        if name == "dt":
            value = F.try_to_date(text, "yyyy-MM-dd")
            reasons.append(is_no(name, text, value, "no date"))
        else:
            value = text.try_cast(field.dataType)
            if kind != "string":
                reasons.append(is_no(name, text, value, f"no {kind.upper()}"))
        if name in ("id", "dt"):
            reasons.append(F.when(text.isNull(), F.lit(f"{name}: missing")))
        read.append(value.alias(name))
    before = [F.col(REASON)] if REASON in rows.columns else []
    return rows.select(
        *read,
        *[F.col(f.name).alias(f"{f.name}_text") for f in HISTORY_SCHEMA],
        F.coalesce(*before, listed(reasons)).alias(REASON),
        "source_file",
    )
