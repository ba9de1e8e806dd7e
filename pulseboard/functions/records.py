"""JSON and CSV records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
VOID = "_void"
POLICIES = ("skip", "sentinel", "fail")


def computed_once(df: DataFrame, columns: dict[str, Column], keep: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """Select ``keep`` and the new ``columns``, each evaluated once per row.

    A later filter or expression on plain computed columns would be merged with
    their definition and evaluate it once more per use. Unnesting a list of one
    keeps costly parses in one place.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select(*keep, F.inline(F.array(row)))


def decode_json(
    df: DataFrame,
    schema: T.StructType,
    value: str = "value",
    policy: str = "skip",
    sentinel: dict[str, object] | None = None,
    timestamp_format: str | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """JSON text to typed columns.

    ``skip``: a missing or mistyped field is null, a line that is no record is dropped.
    ``sentinel``: such a line becomes the ``sentinel`` record.
    ``fail``: such a line, or a mistyped field, ends the job.
    ``keep`` names input columns to carry along.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    options = {"mode": "FAILFAST" if policy == "fail" else "PERMISSIVE"}
    if timestamp_format:
        options["timestampFormat"] = timestamp_format
    parsed = F.from_json(F.col(value), _nullable(schema), options)
    if policy == "fail":
        return df.select(*keep, parsed.alias("_r")).select(*keep, "_r.*")
    options["columnNameOfCorruptRecord"] = CORRUPT
    with_corrupt = T.StructType([*_nullable(schema).fields, T.StructField(CORRUPT, T.StringType())])
    # As in ``computed_once``: the line is parsed once, whatever is filtered later.
    no_text = F.coalesce(F.trim(value) == "", F.lit(True)).alias(VOID)
    decoded = df.select(*keep, no_text, F.inline(F.array(F.from_json(F.col(value), with_corrupt, options))))
    broken = broken_record(schema)
    if policy == "skip":
        return decoded.where(~broken).select(*keep, *schema.fieldNames())
    defaults = sentinel or {}
    return decoded.select(
        *keep,
        *[
            F.when(broken, F.lit(defaults.get(f.name)).cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name)
            for f in schema.fields
        ],
    )


RAW = "_raw"
REASON = "_reason"


def tagged_json(df: DataFrame, schema: T.StructType, value: str = "value", times: dict[str, str] | None = None) -> DataFrame:
    """All lines, read once: the fields, the line itself (``_raw``) and why it is refused (``_reason``, null if it is not).

    Reasons are ``no record``, ``field <name>`` (a value of another type) and ``time <name>`` (a text that ``times`` names and its
    format does not read; such a field becomes a timestamp).
    """
    fields = _nullable(schema)
    with_corrupt = T.StructType([*fields.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    no_text = F.coalesce(F.trim(value) == "", F.lit(True)).alias(VOID)
    read = df.select(F.col(value).alias(RAW), no_text, F.inline(F.array(F.from_json(F.col(value), with_corrupt, options))))
    stamps = {name: F.try_to_timestamp(F.col(name), F.lit(fmt)) for name, fmt in (times or {}).items()}
    # Only lines that are marked corrupt are looked into again.
    wrong = F.coalesce(*[F.when(F.col(f.name).isNull() & json_path(RAW, f"$.{f.name}").isNotNull(), F.lit(f"field {f.name}"))
                         for f in fields.fields], F.lit("no record"))
    late = F.coalesce(*[F.when(F.col(n).isNotNull() & t.isNull(), F.lit(f"time {n}")) for n, t in stamps.items()], F.lit(None).cast("string"))
    reason = F.when(F.col(VOID) | broken_record(schema), "no record").when(F.col(CORRUPT).isNotNull(), wrong).otherwise(late)
    columns = {f.name: stamps.get(f.name, F.col(f.name)) for f in fields.fields}
    return computed_once(read, {**columns, RAW: F.col(RAW), REASON: reason})


def broken_record(schema: T.StructType) -> Column:
    """True for a line that is no JSON object: empty, or marked corrupt and not readable as any object.

    A corrupt mark alone is not enough, a field of the wrong type sets it too. Only marked lines without one
    field set are read a second time.
    """
    empty = F.lit(True)
    for f in schema.fields:
        empty = empty & F.col(f.name).isNull()
    no_object = F.from_json(F.col(CORRUPT), T.MapType(T.StringType(), T.StringType())).isNull()
    return empty & (F.col(VOID) | F.when(empty & F.col(CORRUPT).isNotNull(), no_object).otherwise(False))


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def encode_json(*columns: Column | str) -> Column:
    """Columns as one JSON document."""
    return F.to_json(F.struct(*columns))


def json_path(value: Column | str, path: str) -> Column:
    return F.get_json_object(F.col(value) if isinstance(value, str) else value, path)


def csv_field(value: Column | str, position: int, data_type: str = "string") -> Column:
    """Field number ``position`` (from 1) of comma-separated text; null if absent or mistyped."""
    text = F.col(value) if isinstance(value, str) else value
    return F.try_element_at(F.split(text, ","), F.lit(position)).try_cast(data_type)
