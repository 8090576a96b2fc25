"""Quarantine for malformed input (A3, D1): one pass, two sinks, the failing field named.

``check_lines`` and ``check_messages`` add a ``fault`` column (null for a good row) to the typed
rows; ``write_split`` writes good and bad rows in one job, into two partitions of one table, so
neither the source is read twice nor a row parsed again. ``read_accepted`` and
``read_quarantine`` prune to their partition.

Reasons, the first that holds:

* lines: ``columns`` (the token count differs from the schema; ``token`` is the count found),
  ``type`` (``field`` is the first column, in schema order, whose token does not have its type).
* messages: ``not_json`` (null, not JSON or not an object), ``missing`` (a required record is
  absent or null), ``type`` (a field present in the message does not have its type).

Blank lines are neither good nor bad, an empty token is a null, as in the strict reader.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowml.functions.messages import flatten_conn, rename_struct
from flowml.schema import CONN_LOG_DDL, RAW_FLOW_DDL, SCORING_COLUMNS, ddl_columns, ddl_to_struct
from flowml.sources.flows import BLANK_LINE, CORRUPT_COL, parse_csv_lines

FAULT = "fault"
ACCEPTED = "accepted"


def _fault(raw: Column, reason: Column, field: Column, token: Column) -> Column:
    """A fault where there is a reason, else null."""
    return F.when(reason.isNotNull(), F.struct(raw.alias("raw"), reason.alias("reason"),
                                               field.alias("field"), token.alias("token")))


def _first_wrong(pairs: list[tuple[str, Column, Column]]) -> Column:
    """(field, token) of the first pair whose text is there and whose typed value is not."""
    if not pairs:
        return F.lit(None).cast("struct<field:string,token:string>")
    wrong = [F.when(text.isNotNull() & typed.isNull(),
                    F.struct(F.lit(name).alias("field"), text.alias("token")))
             for name, text, typed in pairs]
    return F.coalesce(*wrong)


def check_lines(lines: DataFrame, ddl: str = RAW_FLOW_DDL, value_col: str = "value",
                sep: str = ",") -> DataFrame:
    """Typed columns of ``ddl`` and ``fault``. Only lines that fail are tokenised a second time."""
    struct = ddl_to_struct(ddl)
    names = ddl_columns(ddl)
    if FAULT in names or ACCEPTED in names:
        raise ValueError(f"columns {FAULT!r} and {ACCEPTED!r} are added by the check")
    lines = lines.filter(F.col(value_col).isNull() | ~F.col(value_col).rlike(BLANK_LINE))
    parsed = parse_csv_lines(lines, ddl, value_col, sep)
    line = F.col(CORRUPT_COL)
    texts = ", ".join(f"`{n}` string" for n in names) + f", {CORRUPT_COL} string"
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL, "sep": sep}
    parsed = parsed.withColumn("_text", F.when(line.isNotNull(), F.from_csv(line, texts, opts)))
    # Any text is a string: the all-string parse fails on nothing but the number of tokens.
    uneven = F.col("_text")[CORRUPT_COL].isNotNull()
    typed_fields = [f for f in struct.fields if not isinstance(f.dataType, T.StringType)]
    wrong = _first_wrong([(f.name, F.col("_text")[f.name], F.col(f"`{f.name}`")) for f in typed_fields])
    parsed = parsed.withColumn("_wrong", F.when(line.isNotNull() & ~uneven, wrong))
    outside = F.regexp_replace(line, r'"(?:[^"\\]|\\.)*"', "")
    found = F.size(F.split(outside, "\\Q" + sep + "\\E")).cast("string")
    reason = F.when(line.isNull(), None).when(uneven, "columns").otherwise("type")
    fault = _fault(line, reason, F.col("_wrong.field"),
                   F.when(uneven, found).otherwise(F.col("_wrong.token")))
    # A bad line has no typed values, not even those of its good tokens.
    return parsed.select(*[F.when(line.isNull(), F.col(f"`{n}`")).alias(n) for n in names], fault.alias(FAULT))


def _leaves(struct: T.StructType, text: Column, typed: Column, path: str = "") -> list:
    out = []
    for f in struct.fields:
        name = f"{path}.{f.name}" if path else f.name
        if isinstance(f.dataType, T.StructType):
            out += _leaves(f.dataType, text[f.name], typed[f.name], name)
        elif not isinstance(f.dataType, T.StringType):
            out.append((name, text[f.name], typed[f.name]))
    return out


def _as_text(struct: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, _as_text(f.dataType) if isinstance(f.dataType, T.StructType)
                                       else T.StringType()) for f in struct.fields])


def check_messages(messages: DataFrame, schema: str | T.StructType = CONN_LOG_DDL, value_col: str = "value",
                   required: list[str] | None = None, columns: list[str] | None = None,
                   passthrough: list[str] | None = None) -> DataFrame:
    """``passthrough`` columns, the flat connection columns and ``fault``.

    Stricter than :func:`parse_messages`: a message with one field of a wrong type is a fault,
    not a row with a null in it. Works on batch and streaming frames.
    """
    struct = ddl_to_struct(schema) if isinstance(schema, str) else schema
    keep = list(passthrough or [])
    cols = list(columns or SCORING_COLUMNS)
    raw = F.col(value_col).cast("string")
    opts = {"mode": "PERMISSIVE"}
    # The generator keeps both parses to one each a message, whatever is read of them below.
    both = F.inline(F.array(F.struct(F.from_json(raw, struct, opts).alias("_typed"),
                                     F.from_json(raw, _as_text(struct), opts).alias("_text"),
                                     F.get_json_object(raw, "$").alias("_json"))))
    read = messages.select(*keep, raw.alias("_raw"), both)
    typed, text = F.col("_typed"), F.col("_text")
    object_ = F.coalesce(F.ltrim("_json").startswith("{"), F.lit(False))
    need = required or [struct.fields[0].name]
    absent = F.coalesce(*[F.when(text[n].isNull(), F.lit(n)) for n in need])
    wrong = _first_wrong(_leaves(struct, text, typed))
    read = read.withColumns({"_absent": absent, "_wrong": wrong})
    reason = (F.when(~object_, "not_json").when(F.col("_absent").isNotNull(), "missing")
              .when(F.col("_wrong").isNotNull(), "type"))
    field = F.when(~object_, None).otherwise(F.coalesce("_absent", "_wrong.field"))
    token = F.when(object_ & F.col("_absent").isNull(), F.col("_wrong.token"))
    read = read.select(*keep, _fault(F.coalesce("_raw", F.lit("")), reason, field, token).alias(FAULT),
                       rename_struct(typed["conn"]).alias("conn"))
    flat = flatten_conn(read, "conn", cols, passthrough=[*keep, FAULT])
    return flat.select(*keep, *[F.when(F.col(FAULT).isNull(), F.col(c)).alias(c) for c in cols], FAULT)


def write_split(checked: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Good and bad rows in one job: two partitions of one Parquet table."""
    checked.withColumn(ACCEPTED, F.col(FAULT).isNull()).write.mode(mode).partitionBy(ACCEPTED).parquet(path)
    return path


def _read(spark: SparkSession, path: str, schema: T.StructType, accepted: bool) -> DataFrame:
    # A stated schema: either side may have no row and so no folder.
    full = T.StructType([*schema.fields, T.StructField(ACCEPTED, T.BooleanType())])
    return spark.read.schema(full).parquet(path).where(F.col(ACCEPTED) == F.lit(accepted)).drop(ACCEPTED)


def read_accepted(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The good rows of :func:`write_split`; ``schema`` is that of the checked frame."""
    return _read(spark, path, schema, True).drop(FAULT)


def read_quarantine(spark: SparkSession, path: str, schema: T.StructType,
                    keys: list[str] | None = None) -> DataFrame:
    """The bad rows: ``keys`` (columns that bad rows carry) with raw, reason, field, token."""
    return _read(spark, path, schema, False).select(*(keys or []), f"{FAULT}.*")
