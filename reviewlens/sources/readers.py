"""Readers for review tables. Errors of the source are raised, never swallowed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from reviewlens.schema import RAW_SCHEMA
from reviewlens.sources.quoted_lines import record_texts


def read_parquet(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """A Parquet directory. With a schema no footer is opened for inference."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*([path] if isinstance(path, str) else path))


def read_raw_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str = RAW_SCHEMA,
    multiline: bool = True,
    null_value: str = "",
    corrupt: str | None = None,
    line_sep: str | None = None,
    split_quoted: bool = False,
) -> DataFrame:
    """A CSV export with a header and doubled quotes, every column as declared (text for raw reviews).

    Columns are found by the names in the header, whatever their order; a header that lacks a declared name, or
    has another one, is an error, and so is a file whose header differs from the first one's. A row with
    too few or too many values is an error too, unless ``corrupt`` names a column for it: then the row is kept
    with its text there, to be counted and left out by the cleaning job, and the column is null elsewhere.

    Quoted line breaks need ``multiline``, and Spark then reads a file in one task. ``split_quoted`` reads such files in
    byte ranges, by as many tasks as other text: the same rows, for three readings of the file, if quotes stand only
    around values and doubled within them, see ``quoted_lines``. Otherwise export in many files, or pass ``multiline=False``
    when no value holds a line break. With ``line_sep``, files whose rows end otherwise than in a plain line feed can
    be split even if values hold line feeds.
    """
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    options = {"header": True, "multiLine": multiline, "quote": '"', "escape": '"', "nullValue": null_value}
    if line_sep is not None:
        options["lineSep"] = line_sep
    header = spark.read.options(**options).csv(path).columns
    odd = sorted(set(header) ^ set(declared.names))
    if odd or len(header) != len(declared):
        raise ValueError(f"the header {header} differs from the declared columns {declared.names} in {odd}")
    fields = [declared[name] for name in header]
    if corrupt is not None:
        fields.append(T.StructField(corrupt, T.StringType()))
        options |= {"columnNameOfCorruptRecord": corrupt}
    # Without column pruning: else a row is only checked as far as its values are asked for.
    options |= {"mode": "FAILFAST" if corrupt is None else "PERMISSIVE", "enforceSchema": False, "columnPruning": False}
    if split_quoted:
        if not multiline or line_sep is not None:
            raise ValueError("split_quoted is for multiline files whose rows end in a line feed")
        rows = _split_rows(spark, path, header, T.StructType(fields), options)
    else:
        rows = spark.read.schema(T.StructType(fields)).options(**options).csv(path)
    return rows.select(*[f"`{name}`" for name in declared.names], *([f"`{corrupt}`"] if corrupt else []))


def _split_rows(
    spark: SparkSession, path: str | list[str], header: list[str], schema: T.StructType, options: dict
) -> DataFrame:
    """The rows of the files by :func:`quoted_lines.record_texts`; each file's first record has to be the header."""
    texts = {key: str(value).lower() if isinstance(value, bool) else value for key, value in options.items()}
    texts = {key: value for key, value in texts.items() if key not in ("header", "enforceSchema", "columnPruning")}
    text = F.regexp_replace("value", r"\r$", "")
    records = record_texts(spark, path).withColumn("value", text)
    names = F.split(F.regexp_replace("value", "^\ufeff", ""), ",")
    odd = F.col("first") & (F.transform(names, lambda n: F.replace(n, F.lit('"'), F.lit(""))) != F.array(*map(F.lit, header)))
    checked = F.when(odd, F.raise_error(F.concat(F.lit("the header differs in "), "file"))).otherwise(F.col("first"))
    rows = records.where(~checked).where(F.btrim("value") != "")
    ddl = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    return rows.select(F.from_csv("value", ddl, texts).alias("row")).select(*[F.col("row")[f.name].alias(f.name) for f in schema.fields])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def has_rows(df: DataFrame) -> bool:
    """Whether there is any row; stops at the first one instead of counting."""
    return not df.isEmpty()
