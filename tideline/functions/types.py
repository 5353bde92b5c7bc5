"""Type names of change logs, target columns and documents; time normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Target column type per change-log type name.
TARGET_TYPES = {
    "BOOLEAN": "TINYINT(1)",
    "BOOL": "TINYINT(1)",
    "BIGINT": "BIGINT",
    "INT": "INT",
    "INTEGER": "INT",
    "TINYINT": "INT",
    "SMALLINT": "INT",
    "TEXT": "VARCHAR(1024)",
    "LONGTEXT": "VARCHAR(1024)",
    "TIMESTAMP": "TIMESTAMP(6)",
    "DATETIME": "DATETIME(6)",
    "DATE": "DATE",
    "TIME": "TIME",
    "DOUBLE": "DOUBLE",
    "FLOAT": "FLOAT",
    "BLOB": "BLOB",
    "BINARY": "BLOB",
    "VARBINARY": "BLOB",
}

# For other names, the first listed fragment the name contains decides.
TARGET_FRAGMENTS = (
    ("DOUBLE", "DOUBLE"),
    ("FLOAT", "FLOAT"),
    ("TIMESTAMP", "TIMESTAMP(6)"),
    ("DATETIME", "DATETIME(6)"),
    ("BLOB", "BLOB"),
    ("BINARY", "BLOB"),
)
TARGET_DEFAULT = "VARCHAR(1024)"

# Logical type per envelope field type; all others are STRING.
LOGICAL_TYPES = {
    "INT8": "TINYINT",
    "INT16": "SMALLINT",
    "INT32": "INT",
    "INT64": "BIGINT",
    "FLOAT32": "FLOAT",
    "FLOAT64": "DOUBLE",
    "BOOLEAN": "BOOLEAN",
    "BYTES": "BYTES",
    "STRING": "STRING",
}

# Logical type per document field type; all others are STRING.
DOCUMENT_TYPES = {
    "STRING": "STRING",
    "INT32": "INT",
    "INT64": "BIGINT",
    "DOUBLE": "DOUBLE",
    "BOOLEAN": "BOOLEAN",
    "DATE_TIME": "TIMESTAMP(3)",
    "OBJECT_ID": "STRING",
    "ARRAY": "STRING",
    "DOCUMENT": "STRING",
    "NULL": "NULL",
    "DECIMAL128": "DECIMAL(38,18)",
    "BINARY": "BYTES",
}


def _lookup(name: Column, table: dict[str, str], default: Column) -> Column:
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.coalesce(F.element_at(F.create_map(*pairs), name), default)


def target_type(name: Column) -> Column:
    """Change-log type name to target column type, upper and lower case alike.

    Character types keep their length or get 255, decimals keep their precision
    or get (10,2).
    """
    upper = F.upper(name)
    sized = F.contains(name, F.lit("("))
    default = F.lit(TARGET_DEFAULT)
    for fragment, target in reversed(TARGET_FRAGMENTS):
        default = F.when(F.contains(upper, F.lit(fragment)), F.lit(target)).otherwise(default)
    return (
        F.when(F.contains(upper, F.lit("CHAR")), F.when(sized, name).otherwise(F.concat(name, F.lit("(255)"))))
        .when(
            F.contains(upper, F.lit("DECIMAL")) | F.contains(upper, F.lit("NUMERIC")),
            F.when(sized, name).otherwise(F.lit("DECIMAL(10,2)")),
        )
        .otherwise(_lookup(upper, TARGET_TYPES, default))
    )


def logical_type(name: Column) -> Column:
    """Envelope field type to logical type."""
    return _lookup(F.upper(name), LOGICAL_TYPES, F.lit("STRING"))


def document_type(name: Column) -> Column:
    """Document field type to logical type."""
    return _lookup(F.upper(name), DOCUMENT_TYPES, F.lit("STRING"))


def map_types(registry: DataFrame, column: str = "type", target: str = "target") -> DataFrame:
    """Adds ``mapped_type`` to a registry; ``target`` is ``target``, ``logical`` or ``document``."""
    mapping = {"target": target_type, "logical": logical_type, "document": document_type}[target]
    return registry.withColumn("mapped_type", mapping(F.col(column)))


def spark_type(name: str) -> T.DataType:
    """The Spark type that stores a relational or logical type name.

    Types wider than any Spark type, such as decimals beyond 38 digits, become text.
    """
    upper = name.strip().upper()
    base = upper.split("(")[0].split()[0] if upper else ""
    unsigned = "UNSIGNED" in upper
    args = upper[upper.find("(") + 1 : upper.find(")")] if "(" in upper else ""
    if base in {"DECIMAL", "NUMERIC"}:
        numbers = [int(x) for x in args.split(",")] if args else [10, 2]
        precision, scale = (numbers + [0])[:2]
        return T.DecimalType(precision, scale) if precision <= 38 else T.StringType()
    if upper.replace(" ", "") == "TINYINT(1)" or base in {"BOOLEAN", "BOOL"}:
        return T.BooleanType()
    if unsigned and base == "BIGINT":
        return T.DecimalType(20, 0)
    wider = {"TINYINT": "SMALLINT", "SMALLINT": "INT", "MEDIUMINT": "INT", "INT": "BIGINT", "INTEGER": "BIGINT"}
    if unsigned:
        base = wider.get(base, base)
    simple = {
        "TINYINT": T.ByteType(),
        "SMALLINT": T.ShortType(),
        "MEDIUMINT": T.IntegerType(),
        "INT": T.IntegerType(),
        "INTEGER": T.IntegerType(),
        "YEAR": T.IntegerType(),
        "BIGINT": T.LongType(),
        "FLOAT": T.FloatType(),
        "DOUBLE": T.DoubleType(),
        "REAL": T.DoubleType(),
        "DATE": T.DateType(),
        "TIMESTAMP": T.TimestampType(),
        "DATETIME": T.TimestampType(),
        "BYTES": T.BinaryType(),
        "BIT": T.BinaryType(),
        "BINARY": T.BinaryType(),
        "VARBINARY": T.BinaryType(),
        "BLOB": T.BinaryType(),
        "GEOMETRY": T.BinaryType(),
    }
    return simple.get(base, T.StringType())


# Semantic names of envelope fields, with the column type and how values are encoded.
SEMANTIC_TYPES = {
    "io.debezium.time.Date": ("DATE", "days"),
    "io.debezium.time.Time": ("STRING", "millis_of_day"),
    "io.debezium.time.MicroTime": ("STRING", "micros_of_day"),
    "io.debezium.time.Timestamp": ("TIMESTAMP", "millis"),
    "io.debezium.time.MicroTimestamp": ("TIMESTAMP", "micros"),
    "io.debezium.time.NanoTimestamp": ("TIMESTAMP", "nanos"),
    "io.debezium.time.ZonedTimestamp": ("TIMESTAMP", "text"),
    "io.debezium.time.Year": ("INT", "text"),
    "org.apache.kafka.connect.data.Date": ("DATE", "days"),
    "org.apache.kafka.connect.data.Time": ("STRING", "millis_of_day"),
    "org.apache.kafka.connect.data.Timestamp": ("TIMESTAMP", "millis"),
    "org.apache.kafka.connect.data.Decimal": ("DECIMAL", "unscaled"),
}


def declared_column(kind: str | None, name: str | None, parameters: dict | None) -> tuple[str, str]:
    """Column type and encoding of a field that an envelope's schema declares."""
    if name in SEMANTIC_TYPES:
        target, encoding = SEMANTIC_TYPES[name]
        if target == "DECIMAL":
            scale = int((parameters or {}).get("scale", 0))
            precision = int((parameters or {}).get("connect.decimal.precision", 38))
            target = f"DECIMAL({min(38, max(precision, scale))},{scale})" if scale <= 38 else "STRING"
        return target, encoding
    return LOGICAL_TYPES.get((kind or "").upper(), "STRING"), "text"


def is_wider(new: T.DataType, old: T.DataType) -> bool:
    """Whether every value of type ``old`` has its place in ``new``, another type."""
    digits = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
    if new == old or isinstance(old, T.BinaryType):
        return False
    if isinstance(new, T.StringType):
        return True
    if type(old) in digits:
        if isinstance(new, T.DecimalType):
            return new.precision - new.scale >= digits[type(old)]
        return digits.get(type(new), 0) > digits[type(old)] or (isinstance(new, T.DoubleType) and digits[type(old)] <= 10)
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    return (type(old), type(new)) in {(T.FloatType, T.DoubleType), (T.DateType, T.TimestampType)}


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def decoded_text(text: Column, encoding: str, kind: T.DataType) -> Column:
    """A field's text with its encoding undone, as text that casts to ``kind``; what cannot be read gives null."""
    number = F.when(text.rlike(r"^-?\d{1,18}$"), text).try_cast("long")
    if encoding == "days":
        return F.coalesce(F.date_add(F.lit("1970-01-01").cast("date"), number.try_cast("int")).cast("string"), text)
    unit = {"millis": 1_000_000, "micros": 1_000, "nanos": 1}.get(encoding)
    if unit:
        whole = F.call_function("div", number - F.pmod(number, F.lit(1000)), F.lit(1000))
        micros = whole if unit < 1000 else number * (unit // 1000)
        return F.coalesce(F.timestamp_micros(micros).cast("string"), text)
    unit = {"millis_of_day": 1_000, "micros_of_day": 1}.get(encoding)
    if unit:
        at = F.timestamp_micros((number * unit).cast("long"))
        return F.coalesce(F.date_format(F.to_utc_timestamp(at, F.current_timezone()), "HH:mm:ss.SSSSSS"), text)
    if encoding == "unscaled" and isinstance(kind, T.DecimalType):
        # Base64 of a big-endian two's complement number; numbers as text or JSON numbers are taken as they are.
        def shown(value: Column) -> Column:
            digits = F.lpad(F.abs(value).cast("string"), 39, "0")
            cut = 39 - kind.scale
            point = F.concat(F.substring(digits, 1, cut), F.lit("."), F.substring(digits, cut + 1, 39))
            return F.concat(F.when(value < 0, "-").otherwise(""), point)

        def number_of(whole: Column) -> Column:
            high = F.conv(F.substring(whole, 1, 16), 16, -10).cast("decimal(38,0)")
            low = F.conv(F.substring(whole, 17, 16), 16, 10).cast("decimal(38,0)")
            return F.try_add(F.try_multiply(high, F.lit(str(2**64)).cast("decimal(20,0)")).cast("decimal(38,0)"), low)

        def filled(code: Column) -> Column:
            sign = F.when(F.substring(code, 1, 1) >= "8", "F").otherwise("0")
            return F.when(F.length(code) <= 32, F.lpad(code, 32, sign))

        plain = text.rlike(r"^-?\d+\.\d+$") | (F.length(text) % 4 != 0) | ~text.rlike(r"^[A-Za-z0-9+/]+={0,2}$")
        code = F.hex(F.unbase64(F.when(~plain, text)))
        return F.when(plain, text).otherwise(_let(_let(_let(code, filled), number_of), shown))
    return text


def normalize_time(text: Column) -> Column:
    """Reads ISO instants out of text: ``struct(ts, raw)``, one of them null.

    Only text that contains ``T`` and parses as an instant becomes a timestamp;
    everything else stays as it is.
    """
    instant = F.when(
        text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:\d{2})$"),
        F.try_to_timestamp(text),
    )
    return F.struct(instant.alias("ts"), F.when(instant.isNull(), text).alias("raw"))
