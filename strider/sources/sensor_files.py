"""Raw sensor files: headerless whitespace-separated text, and CSV with header.

Layout: ``<base>/<day folder>/<Position>_<Kind>.txt`` (or ``.csv``).  The day folder
name becomes the ``date`` column.  Files are read by Spark's file sources, so each
file split is a task; nothing is read on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strider.schemas import KIND_ORDER, SCHEMAS, with_date

_PARENT_DIR = r"/([^/]+)/[^/]+$"


def date_from_path(path: Column | str = "_metadata.file_path") -> Column:
    """Name of the folder that holds the file."""
    path = F.col(path) if isinstance(path, str) else path
    return F.regexp_extract(path, _PARENT_DIR, 1)


def kind_from_name(name: Column | str = "_metadata.file_name") -> Column:
    """Sensor kind of a file name: first kind it contains, for ``.txt`` names only."""
    name = F.col(name) if isinstance(name, str) else name
    expr = None
    for kind in KIND_ORDER:
        cond = name.contains(kind)
        expr = F.when(cond, F.lit(kind)) if expr is None else expr.when(cond, F.lit(kind))
    return F.when(name.endswith(".txt"), expr)


def position_from_name(name: Column | str = "_metadata.file_name") -> Column:
    """Body position of a file name ``<Position>_<Kind>.txt``; null for files without one."""
    name = F.col(name) if isinstance(name, str) else name
    found = F.regexp_extract(name, r"^([^_]+)_(?:API|Motion|Label|Location)\b", 1)
    return F.when(found != "", found)


# Characters treated as blanks around and between fields.
BLANKS = " \t\r\n\f\u000b"


def parse_sensor_lines(lines: DataFrame, kind: str, value_col: str = "value",
                       mode: str = "strict") -> DataFrame:
    """Split whitespace-separated lines into the typed columns of ``kind``.

    Runs of spaces / tabs are one separator, leading and trailing blanks are ignored,
    blank lines are skipped, ``NaN`` text becomes NaN and unparsable fields null.
    A row with another number of fields than the kind has fails the job (``mode="strict"``);
    ``"permissive"`` pads short rows with nulls and keeps the leading fields of long ones.  Other
    columns of ``lines`` are carried along.  The line is split once (one regular
    expression); the field-count check sits in the same projection.
    """
    if mode not in ("strict", "permissive"):
        raise ValueError(f"mode must be 'strict' or 'permissive', not {mode!r}")
    schema = SCHEMAS[kind]
    n = len(schema.fields)
    text = F.btrim(F.col(value_col), F.lit(BLANKS))
    carried = [c for c in lines.columns if c != value_col]
    split = (lines.where(F.length(text) > 0)
             .select(*carried, F.split(text, r"\s+").alias("_f")))
    typed = [F.get(F.col("_f"), i).try_cast(f.dataType) for i, f in enumerate(schema.fields)]
    if mode == "strict":
        wrong = F.raise_error(F.concat(F.lit(f"{kind} row without {n} fields: "),
                                       F.array_join(F.col("_f"), " ")))
        typed[0] = F.when(F.size("_f") != n, wrong).otherwise(typed[0])
    return split.select(*carried, *[c.alias(f.name) for c, f in zip(typed, schema.fields)])


def read_sensor_text(spark: SparkSession, base: str, kind: str, mode: str = "strict",
                     stem: str | None = None) -> DataFrame:
    """All ``.txt`` files of ``kind`` under ``base`` (any depth) as one typed table + ``date``
    and ``position``.

    A glob on the kind prunes the listing; the first-match rule on the file name then
    keeps only files whose kind is exactly ``kind``.  Empty files add no rows.  With
    ``stem`` (e.g. ``Hips_Location``) only files of that name are read, one table per
    body position as the loader keeps them.
    """
    raw = (spark.read.format("text")
           .option("recursiveFileLookup", "true")
           .option("pathGlobFilter", f"{stem}.txt" if stem else f"*{kind}*.txt")
           .load(base))
    return typed_sensor_lines(raw, kind, mode)


def typed_sensor_lines(raw: DataFrame, kind: str, mode: str = "strict") -> DataFrame:
    """Text-source rows (``value`` + ``_metadata``) of ``kind`` files → typed rows + ``date`` and
    ``position`` (Hips, Bag, Hand, Torso …: rows of different positions share (date, Time)).

    Shared by the batch reader and the streaming ingest.
    """
    lines = (raw.where(kind_from_name() == kind)
             .select("value", date_from_path().alias("date"), position_from_name().alias("position")))
    return parse_sensor_lines(lines, kind, mode=mode)


def read_sensor_csv(spark: SparkSession, base: str, kind: str,
                    file_name: str | None = None) -> DataFrame:
    """CSV files with a header row, typed by the schema of ``kind``, plus ``date``.

    ``file_name`` picks one named file from every day folder (absent ones are skipped),
    e.g. ``Hips_Location.csv``; without it every ``*<kind>*.csv`` is read.
    """
    pattern = f"{base.rstrip('/')}/*/{file_name or f'*{kind}*.csv'}"
    df = (spark.read.schema(SCHEMAS[kind]).option("header", "true")
          .option("mode", "PERMISSIVE").csv(pattern))
    return df.withColumn("date", date_from_path())


def read_sensor_table(spark: SparkSession, path: str, kind: str, fmt: str = "parquet") -> DataFrame:
    """A day-partitioned sensor table written by the sinks, with its declared schema.

    The explicit schema keeps ``date`` a string (partition inference would turn
    ``010317`` into the number 10317) and lets filters on ``date`` prune folders.
    """
    return spark.read.format(fmt).schema(with_date(SCHEMAS[kind])).load(path)


def ingest_release(spark: SparkSession, base: str, target: str, mode: str = "strict",
                   write_mode: str = "overwrite") -> dict[str, str]:
    """Every kind of sensor file under ``base`` → one table per kind under ``target``, by day
    and body position; {kind: path} of the kinds that have files."""
    from strider.sources.sinks import write_table
    raw = (spark.read.format("text").option("recursiveFileLookup", "true")
           .option("pathGlobFilter", "*.txt").load(base))
    kinds = [r[0] for r in raw.select(kind_from_name().alias("k")).where("k is not null").distinct().collect()]
    out = {}
    for kind in [k for k in KIND_ORDER if k in kinds]:
        out[kind] = f"{target.rstrip('/')}/{kind}"
        keys = ("date", "position") if kind in ("API", "Motion", "Label", "Location") else ("date",)
        rows = read_sensor_text(spark, base, kind, mode)
        write_table(rows if "position" in keys else rows.drop("position"), out[kind], write_mode, keys)
    return out
