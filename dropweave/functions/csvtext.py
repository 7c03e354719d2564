"""CSV text to columns and back, in one dialect: ``"`` quotes, and a doubled quote inside."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dropweave.functions.registry import RecordType

CORRUPT = "_corrupt_record"

# Spark escapes with a backslash unless told otherwise, and its writer trims spaces and
# writes "" for an empty string.
READ_OPTIONS = {"quote": '"', "escape": '"', "dateFormat": "yyyy-MM-dd"}
WRITE_OPTIONS = {
    **READ_OPTIONS, "nullValue": "", "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}
# Leaves line ends inside a quoted field as they are.
RECORD_OPTIONS = {**READ_OPTIONS, "multiLine": "true", "maxCharsPerColumn": "-1"}


def with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])


def parse_line(value: Column, record_type: RecordType) -> Column:
    """The line as a struct of typed fields plus ``_corrupt_record``.

    The latter holds the line when a field does not cast or the number of fields is wrong.
    """
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in with_corrupt(record_type.schema))
    options = {**RECORD_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return F.from_csv(value, ddl, options)


def format_line(*columns: Column | str) -> Column:
    """Columns as one CSV line, quoted only where needed; NULL and '' become nothing."""
    return F.to_csv(F.struct(*columns), WRITE_OPTIONS)


def record_type_of(value: Column) -> Column:
    return F.substring(value, 1, 2)


def field_at(value: Column, position: int) -> Column:
    """The raw text of one field of a CSV line, without parsing the whole line.

    A line too short for the field gives ''.  The pattern is used only when there is a quote
    in the fields up to this one.
    """
    before, upto = (F.substring_index(value, ",", n) for n in (position, position + 1))
    # Atomic, so that a comma inside quotes is never tried as a separator.
    field = r'(?:(?>"[^"]*(?:""[^"]*)*")[^,]*|(?!")[^,]*)'
    skip = f"(?:{field},)" + "{" + str(position) + "}"
    by_pattern = F.regexp_replace(F.regexp_extract(value, f"^{skip}({field})", 1), r'^"|"$', "")
    return (F.when(upto.contains('"'), by_pattern)
            .when(before == value, F.lit(""))
            .otherwise(F.substring_index(upto, ",", -1)))


def to_key(text: Column) -> Column:
    """Key text to BIGINT.  Decimals, junk and empty text give NULL, never an error."""
    return text.try_cast("bigint")


def file_stem(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def base_name(source_file: Column) -> Column:
    """The bare file name of a drop named by its path, or by ``archive!member``."""
    return F.element_at(F.split(source_file, "[/!]"), -1)


def drop_suffix(name: Column, suffix: str = ".yml") -> Column:
    """The name without a trailing ``suffix``."""
    return F.when(name.endswith(suffix), F.substring(name, F.lit(1), F.length(name) - len(suffix))).otherwise(name)


def split_name(source_file: Column, record_type: Column) -> Column:
    """``x.csv`` and ``x.csv.gz`` with type 24 give ``x_r24.csv``, ``x.gz`` and ``x`` give ``x_r24``."""
    plain = F.regexp_replace(source_file, r"(?i)\.gz$", "")
    suffix = F.regexp_extract(plain, r"(?i)(\.csv)$", 1)
    return F.concat(F.left(plain, F.length(plain) - F.length(suffix)), F.lit("_r"), record_type, suffix)


def part_name(chunk: Column) -> Column:
    return F.format_string("part-%04d.csv", chunk)


def merged_name(record_type: RecordType, prefix: str = "Records_") -> str:
    return f"{prefix}{record_type.name}.csv"


def header_line(record_type: RecordType) -> str:
    return ",".join(record_type.field_names)
