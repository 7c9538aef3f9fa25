"""Raw tap counts: delimited text in, compact Parquet out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.functions.timegrid import RAW_TIMESTAMP_FORMAT
from hourgrid.operators.clean import exclude_rows
from hourgrid.spec import DemandSpec

# The twelve columns of the raw file, in file order. Ids such as TRAM1 make the id a string.
RAW_FIELDS = (
    ("transit_timestamp", "timestamp_ntz"),
    ("transit_mode", "string"),
    ("station_complex_id", "string"),
    ("station_complex", "string"),
    ("borough", "string"),
    ("payment_method", "string"),
    ("fare_class_category", "string"),
    ("ridership", "bigint"),
    ("transfers", "bigint"),
    ("latitude", "double"),
    ("longitude", "double"),
    ("Georeference", "string"),
)
WRITTEN_TIMESTAMP_FORMAT = "MM/dd/yyyy hh:mm:ss a"
CORRUPT = "_corrupt"


def schema_by_header(spark: SparkSession, path: str, spec: DemandSpec = DemandSpec()) -> str:
    """Types by column name, in the order of the header. Only the header line is read; unknown columns stay text.

    Measures are read as text as well: `12.0` and `1,234` are numbers, which the reader's own parser would lose.
    """
    names = [(cell or "").strip() for cell in spark.read.option("header", False).csv(path).first()]
    missing = {*spec.keys, spec.raw_measure, spec.second_measure} - set(names)
    if missing:
        raise ValueError(f"{path} lacks the columns {sorted(missing)}")
    types = dict(RAW_FIELDS) | dict.fromkeys([spec.raw_measure, spec.second_measure], "string")
    return ", ".join(f"`{name}` {types.get(name, 'string')}" for name in names)


def parse_measure(text: Column) -> Column:
    """Whole number from text such as 12, 12.0 or 1,234; null where it is none."""
    plain = F.regexp_replace(F.trim(text), ",(?=[0-9]{3}(?:[^0-9]|$))", "")
    return F.round(plain.try_cast("decimal(38,6)")).cast("bigint")


def _scan(spark: SparkSession, path: str, keep_corrupt: bool, spec: DemandSpec) -> DataFrame:
    schema = schema_by_header(spark, path, spec)
    reader = (
        spark.read.option("header", True)
        .option("mode", "PERMISSIVE")
        # Every file's header is held against the first one's: columns in another order fail instead of being mixed.
        .option("enforceSchema", False)
        .option("timestampNTZFormat", RAW_TIMESTAMP_FORMAT)
    )
    if keep_corrupt:
        schema = f"{schema}, {CORRUPT} string"
        # A row is known to be short only if all its cells are looked at.
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False)
    return reader.schema(schema).csv(path)


def read_raw(
    spark: SparkSession, path: str, keep_corrupt: bool = False, spec: DemandSpec = DemandSpec()
) -> DataFrame:
    """Scan raw CSV with header and fixed types.

    No type is inferred, so the text is read once, and only the columns a query needs are parsed. Timestamps are
    parsed by the reader itself; a cell that does not parse becomes null, short rows are padded with nulls and surplus
    cells are ignored: `raw_losses` counts both. Files whose header differs from the first one's are refused. With
    `keep_corrupt` the text of such rows is kept in `_corrupt`, at the price of parsing every column.
    """
    scanned = _scan(spark, path, keep_corrupt, spec)
    return scanned.withColumns({m: parse_measure(F.col(m)) for m in (spec.raw_measure, spec.second_measure)})


def raw_losses(spark: SparkSession, path: str, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """One row: raw rows, rows with too few or too many cells or an unreadable time, and per measure missing and
    unreadable cells."""
    rows = _scan(spark, path, True, spec)
    counts = [
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(CORRUPT).isNotNull()).alias("n_damaged_rows"),
        F.count_if(F.col(spec.ts).isNull()).alias("n_without_time"),
    ]
    for m in (spec.raw_measure, spec.second_measure):
        lost = F.col(m).isNotNull() & parse_measure(F.col(m)).isNull()
        counts += [F.count_if(F.col(m).isNull()).alias(f"n_{m}_missing"), F.count_if(lost).alias(f"n_{m}_unreadable")]
    return rows.agg(*counts)


def write_raw_csv(raw: DataFrame, path: str) -> None:
    """Raw rows as text in the layout `read_raw` expects; columns the input lacks are left empty."""
    columns = [
        F.col(name) if name in raw.columns else F.lit(None).cast(kind).alias(name) for name, kind in RAW_FIELDS
    ]
    writer = raw.select(*columns).write.mode("overwrite").option("header", True)
    writer.option("timestampNTZFormat", WRITTEN_TIMESTAMP_FORMAT).csv(path)


def reduced_columns(raw: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """Known-bad rows out, and only the columns the sums need."""
    kept = exclude_rows(raw, spec.exclude)
    return kept.select(*spec.keys, spec.raw_measure, spec.second_measure)


def compact_raw(raw: DataFrame, path: str, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """Store the reduced columns as Parquet, so later runs read a few columns instead of all the text."""
    reduced_columns(raw, spec).write.mode("overwrite").parquet(path)
    return raw.sparkSession.read.parquet(path)
