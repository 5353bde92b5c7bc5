"""Text expressions and the table functions built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def increment(column: str | Column) -> Column:
    """``value + 1`` on 64-bit integers; the largest value wraps to the smallest."""
    value = (F.col(column) if isinstance(column, str) else column).cast("long")
    top = F.lit(9223372036854775807)
    return F.when(value == top, F.lit(-9223372036854775808)).otherwise(F.try_add(value, F.lit(1)))


def prefix_values(column: str, prefix: str = "processed:") -> Column:
    """Puts ``prefix`` before each value."""
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def split_trimmed(text: Column, pattern: str) -> Column:
    """Splits on a regular expression and drops trailing empty parts.

    A text that never matches stays whole, so the empty text gives one empty
    part, while a text of separators only gives none.
    """
    parts = F.split(text, pattern, -1)
    used = F.array_max(F.transform(parts, lambda part, i: F.when(part != "", i + 1).otherwise(0)))
    return F.when(F.size(parts) == 1, parts).otherwise(F.slice(parts, F.lit(1), used))


def tokens(text: Column, separator: str = ",") -> Column:
    """Lower-cased non-empty parts of a text."""
    return F.filter(F.split(F.lower(text), separator, -1), lambda part: part != "")


def tokenize(df: DataFrame, column: str, separator: str = ",", output: str = "word") -> DataFrame:
    """One row per token; the other columns are repeated."""
    kept = [c for c in df.columns if c != column]
    return df.select(*kept, F.explode(tokens(F.col(column), separator)).alias(output))


def split_table(df: DataFrame, column: str, separator: str, output: str = "word") -> DataFrame:
    """Cross-applies a text with its parts; a null text gives one empty part.

    ``separator`` is a regular expression. A text without parts drops its row.
    """
    parts = F.coalesce(split_trimmed(F.col(column), separator), F.array(F.lit("")))
    return df.select("*", F.explode(parts).alias(output))


SPLIT_TABLE_SQL = """
CREATE OR REPLACE TEMPORARY FUNCTION split_table(str STRING, sep STRING)
RETURNS TABLE (word STRING)
RETURN SELECT explode(CASE
  WHEN str IS NULL THEN array('')
  WHEN size(split(str, sep, -1)) = 1 THEN split(str, sep, -1)
  ELSE slice(split(str, sep, -1), 1,
             array_max(transform(split(str, sep, -1), (p, i) -> if(p <> '', i + 1, 0))))
END) AS word
"""


def register_split_table(spark: SparkSession) -> None:
    """Makes ``LATERAL split_table(text, separator)`` callable from SQL.

    A SQL table function is inlined into the plan, so the rows stay in the JVM.
    """
    spark.sql(SPLIT_TABLE_SQL)


def record_to_json(topic: str, key: str, value: str, timestamp: str) -> Column:
    """``{topic, key, value, timestamp}`` as JSON text."""
    return F.to_json(
        F.struct(
            F.col(topic).alias("topic"),
            F.col(key).alias("key"),
            F.col(value).alias("value"),
            F.col(timestamp).alias("timestamp"),
        )
    )


def records_as_json(df: DataFrame, topic: str, key: str, value: str, timestamp: str) -> DataFrame:
    """The JSON form of every record that has a value."""
    return df.where(F.col(value).isNotNull()).select(
        record_to_json(topic, key, value, timestamp).alias("json")
    )


def build_index_requests(df: DataFrame, json: str, index: str, id_column: str | None = None) -> DataFrame:
    """One index request text per JSON line; a malformed line fails the job.

    Without ``id_column`` the index assigns the id, shown as ``null``.
    """
    shown = F.coalesce(F.col(id_column).cast("string"), F.lit("null")) if id_column else F.lit("null")
    checked = F.when(F.parse_json(json).isNotNull(), F.col(json))
    return df.select(
        "*",
        F.concat(F.lit(f"Index: {index}, ID: "), shown, F.lit(", Source: "), checked).alias("request"),
    )


def label_message(template: str, *columns: str) -> Column:
    """A formatted message (``printf`` style) from columns."""
    return F.format_string(template, *[F.col(c) for c in columns])


def project_constant(df: DataFrame, columns: list[str], name: str = "op", value: str = "c") -> DataFrame:
    """Some columns plus one constant."""
    return df.select(*columns, F.lit(value).alias(name))


def string_hash(text: Column) -> Column:
    """The 32-bit polynomial hash (base 31, wrapping) over UTF-16 units of a text.

    Characters beyond the basic plane count as their two surrogates.
    """
    codes = F.transform(F.split(text, "", -1), lambda c: F.ascii(c).cast("long"))
    units = F.flatten(
        F.transform(
            codes,
            lambda c: F.when(
                c >= 65536,
                F.array(
                    F.lit(55296) + F.shiftright(c - 65536, 10), F.lit(56320) + (c - 65536).bitwiseAND(1023)
                ),
            ).otherwise(F.array(c)),
        )
    )
    folded = F.aggregate(
        units, F.lit(0).cast("long"), lambda h, u: (h * 31 + u).bitwiseAND(4294967295)
    )
    return F.when(folded > 2147483647, folded - 4294967296).otherwise(folded).cast("int")
