"""The cleaning job: raw table in, compact typed table and its audits out, from one scan of the raw data."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from reviewlens.functions.predicates import column, is_complete, is_missing, is_present
from reviewlens.operators.cleaning import convert_types, drop_report, null_audit
from reviewlens.operators.columns import drop_columns, require_columns
from reviewlens.schema import CLEAN_CASTS, UNUSED_COLUMNS, CastSpec
from reviewlens.sources.scratch import scratch_path
from reviewlens.sources.sinks import YEAR_COLUMN, cluster_reviews, files_for, with_review_year, write_parquet


@dataclass(frozen=True)
class CleaningReport:
    """What a cleaning run found, per column where it says so.

    ``missing_before`` counts missing values after the casts, ``lost_in_cast`` those of them that were there
    before, and ``corrupt_rows`` the rows whose number of values was wrong. ``missing_after`` is counted behind the
    row test, in the rows as they are written: it is not zero where the test let a missing value through, as for columns
    that were not ``required``.
    """

    rows_before: int
    rows_after: int
    missing_before: dict[str, int]
    lost_in_cast: dict[str, int] = field(default_factory=dict)
    corrupt_rows: int = 0
    missing_after: dict[str, int] = field(default_factory=dict)

    @property
    def rows_dropped(self) -> int:
        return self.rows_before - self.rows_after


def _with_counts(
    raw: DataFrame,
    casts: CastSpec,
    unused: Iterable[str],
    allow_fractional: bool,
    corrupt: str | None,
    required: Iterable[str] | None,
) -> tuple[DataFrame, DataFrame, Column, list[Column]]:
    """The typed table with the raw values beside it, the typed table alone, its row test, and the audits."""
    if corrupt is not None:
        require_columns(raw, [corrupt])
    kept = drop_columns(raw, [*unused, *([corrupt] if corrupt else [])])
    typed = convert_types(kept, casts, allow_fractional)
    fields, cast = typed.schema.fields, [f for f in kept.schema.fields if f.name in casts.target_types()]
    # One projection: the typed columns, and what the casts started from under names of its own.
    before = {f"__raw_{i}": f for i, f in enumerate(cast)}
    wide = raw.withColumns({name: column(f.name) for name, f in before.items()})
    wide = convert_types(wide, casts, allow_fractional)
    sound = column(corrupt).isNull() if corrupt else F.lit(True)
    names = None if required is None else set(required)
    require_columns(typed, names or ())
    complete = is_complete([f for f in fields if names is None or f.name in names]) & sound
    audits = [
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(complete).alias("rows_after"),
        F.count_if(~sound).alias("corrupt_rows"),
    ]
    audits += [F.count_if(is_missing(f)).alias(f"missing_{i}") for i, f in enumerate(fields)]
    for name, f in before.items():
        there = is_present(type(f)(name, f.dataType))
        audits.append(F.count_if(there & column(f.name).isNull()).alias(f"lost{name}"))
    return wide, typed, complete, audits


def clean_to_parquet(
    raw: DataFrame,
    path: str,
    casts: CastSpec = CLEAN_CASTS,
    unused: Iterable[str] = UNUSED_COLUMNS,
    files: int | None = None,
    clustered: bool = False,
    max_rows_per_file: int | None = None,
    allow_fractional: bool = True,
    by_year: str | None = None,
    corrupt: str | None = None,
    required: Iterable[str] | None = None,
    quarantine: str | None = None,
) -> CleaningReport:
    """Clean ``raw`` into ``path``; the raw data is read once.

    By default the job is one map-only stage, and the audits are observed while it writes. ``files``,
    ``clustered`` and ``by_year`` move rows: the typed table is then written to the scratch folder first, with
    the audits, and laid out from there. Without ``files`` a clustered table gets one for about each 128 MB.

    ``by_year`` names a clock by whose year the output is partitioned, in a column ``review_year``. ``corrupt``
    names the column in which the reader left rows with a wrong number of values; they are counted and left out.
    With ``quarantine``, a folder, their texts are written there, by a second reading that is left out if there are none.
    ``allow_fractional=False`` makes ``12.0`` malformed, and so drops its row. ``required`` names the columns that a row
    must have; by default all of them.

    After an observed write Spark cannot send a model to tasks that was fitted in the same session;
    save and load it first, see ``sentiment.ml_scorer``.
    """
    unused = list(unused)
    if quarantine is not None and corrupt is None:
        raise ValueError("quarantine needs the column that holds corrupt rows")
    wide, typed, complete, audits = _with_counts(raw, casts, unused, allow_fractional, corrupt, required)
    observation, written = Observation("cleaning"), Observation("cleaned")
    after = [F.count_if(is_missing(f)).alias(f"after_{i}") for i, f in enumerate(typed.schema.fields)]
    kept = wide.observe(observation, *audits).where(complete).select(*[column(c) for c in typed.columns])
    kept = kept.observe(written, *after)
    if files is None and not clustered and by_year is None:
        write_parquet(kept, path, max_rows_per_file=max_rows_per_file)
    else:
        spark, stage = raw.sparkSession, scratch_path(raw.sparkSession, "typed")
        write_parquet(kept, stage)
        rows = spark.read.schema(typed.schema).parquet(stage)
        files = files or (files_for(spark, stage) if clustered else None)
        rows = cluster_reviews(rows, files) if clustered else rows
        partitions = []
        if by_year is not None:
            rows, partitions = with_review_year(rows, by_year), [YEAR_COLUMN]
        write_parquet(
            rows, path, files=None if clustered else files, max_rows_per_file=max_rows_per_file, partition_by=partitions
        )
    found = observation.get
    if quarantine is not None and found["corrupt_rows"]:
        _write_corrupt(raw, corrupt, quarantine)
    names = [f.name for f in typed.schema.fields]
    cast = [c for c in names if c in casts.target_types()]
    return CleaningReport(
        found["rows_before"],
        found["rows_after"],
        {c: found[f"missing_{i}"] for i, c in enumerate(names)},
        {c: found[f"lost__raw_{i}"] for i, c in enumerate(cast)},
        found["corrupt_rows"],
        {c: written.get[f"after_{i}"] for i, c in enumerate(names)},
    )


def _write_corrupt(raw: DataFrame, corrupt: str, path: str) -> None:
    text = column(corrupt)
    # Spark reads no CSV for the corrupt text alone, so the row takes part in a way that changes nothing.
    others = [F.length(F.coalesce(column(c).cast("string"), F.lit(""))) for c in raw.columns if c != corrupt][:1]
    kept = raw.where(text.isNotNull() & ((others[0] if others else F.lit(0)) >= 0))
    kept.select(text.alias("value")).write.mode("overwrite").text(path)


def check_cleaned(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Null audit and drop report of a written table; all missing counts must be 0."""
    cleaned = spark.read.parquet(path)
    return null_audit(cleaned), drop_report(cleaned)
