"""Q02–Q09 — contract checks, referential checks, status and analyst queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outcomelake.functions import sum_micros
from outcomelake.operators.positions import score_c
from outcomelake.schemas import ColumnRule, Contract, contract, has_contract

REPORT_SCHEMA = (
    "source string, check string, status string, severity string, column string, code string, count long"
)
_TYPE_NAMES = {
    T.StringType: "String", T.LongType: "Int64", T.IntegerType: "Int32", T.DoubleType: "Float64",
    T.FloatType: "Float32", T.BooleanType: "Boolean",
}


@dataclass(frozen=True)
class Violation:
    code: str
    column: str
    count: int | None = None

    @property
    def message(self) -> str:
        return f"{self.column}: {self.code}" + ("" if self.count is None else f" ({self.count} rows)")


class DataContractError(ValueError):
    def __init__(self, violations: list[Violation]) -> None:
        self.violations = violations
        super().__init__("; ".join(v.message for v in violations))


def type_name(data_type: T.DataType) -> str:
    return _TYPE_NAMES.get(type(data_type), data_type.simpleString())


def schema_violations(df: DataFrame, rules: Contract) -> list[Violation]:
    """Missing columns and wrong types, from the schema alone."""
    found = []
    for rule in rules.columns:
        if rule.name not in df.columns:
            if rule.required:
                found.append(Violation("missing_column", rule.name))
        elif type_name(df.schema[rule.name].dataType) not in rule.types:
            found.append(Violation("wrong_type", rule.name))
    return found


def _value_rules(rule: ColumnRule) -> list[tuple[str, Column]]:
    """(code, condition of a bad value); bounds and allowed values ignore nulls."""
    c = F.col(rule.name)
    out: list[tuple[str, Column]] = []
    if not rule.nullable:
        out.append(("null", c.isNull()))
    if rule.minimum is not None:
        out.append(("min", c < rule.minimum))
    if rule.exclusive_min is not None:
        out.append(("exclusive_min", c <= rule.exclusive_min))
    if rule.maximum is not None:
        out.append(("max", c > rule.maximum))
    if rule.allowed:
        out.append(("allowed", ~c.isin(*rule.allowed)))
    return out


def value_counts(df: DataFrame, rules: Contract) -> DataFrame:
    """Q02 — (column, code, count) for every value rule, all counted in a single pass."""
    broken = {v.column for v in schema_violations(df, rules)}
    tests = [
        (rule.name, code, bad)
        for rule in rules.columns
        if rule.name in df.columns and rule.name not in broken
        for code, bad in _value_rules(rule)
    ]
    counts = df.agg(*[F.count_if(bad).alias(f"c{i}") for i, (_, _, bad) in enumerate(tests)])
    rows = F.array(*[
        F.struct(F.lit(name).alias("column"), F.lit(code).alias("code"), F.col(f"c{i}").alias("count"))
        for i, (name, code, _) in enumerate(tests)
    ])
    return counts.select(F.inline(rows))


def duplicate_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """Q04 — how many rows share their key with another row: two equal rows count 2."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("count"))


def validate_frame(df: DataFrame, rules: Contract) -> list[Violation]:
    """Q02 — every violation of a contract; one pass for the values and one per unique key."""
    found = schema_violations(df, rules)
    found += [
        Violation("min" if r.code == "exclusive_min" else r.code, r.column, r["count"])
        for r in value_counts(df, rules).where("count > 0").collect()
    ]
    for keys in rules.unique:
        if all(k in df.columns for k in keys):
            n = duplicate_count(df, list(keys)).first()[0]
            if n:
                found.append(Violation("duplicate", ",".join(keys), n))
    return found


def assert_valid(df: DataFrame, source: str) -> None:
    found = validate_frame(df, contract(source))
    if found:
        raise DataContractError(found)


def unknown_references(df: DataFrame, column: str, known: DataFrame, known_column: str) -> DataFrame:
    """Q05 — distinct values of ``column`` that ``known`` lacks."""
    values = df.select(F.col(column).alias("value")).where(F.col("value").isNotNull()).distinct()
    return values.join(known.select(F.col(known_column).alias("value")).distinct(), "value", "left_anti")


def reference_summary(unknown: DataFrame, samples: int = 5) -> DataFrame:
    """Q05 — how many values are unknown, and the first few in order."""
    first = unknown.orderBy("value").limit(samples).agg(F.array_sort(F.collect_list("value")).alias("s"))
    return unknown.agg(F.count(F.lit(1)).alias("unknown_count")).withColumn("samples", first.scalar())


def _row(spark: SparkSession, source: str, check: str, ok: bool, column: str | None, code: str | None,
         severity: str = "error") -> DataFrame:
    status = "ok" if ok else severity
    row = (source, check, status, "info" if ok else severity, column, code, None)
    return spark.createDataFrame([row], REPORT_SCHEMA)


def _counted(df: DataFrame, source: str, check: str, column: Column, code: Column | str) -> DataFrame:
    bad = F.col("count") > 0
    return df.select(
        F.lit(source).alias("source"), F.lit(check).alias("check"),
        F.when(bad, "error").otherwise("ok").alias("status"),
        F.when(bad, "error").otherwise("info").alias("severity"),
        column.alias("column"), (F.lit(code) if isinstance(code, str) else code).alias("code"),
        F.col("count").cast("long").alias("count"),
    )


def validate_source(
    source: str,
    df: DataFrame | None,
    full: bool = False,
    markets: DataFrame | None = None,
) -> DataFrame:
    """Q03 — the checks of one source as rows: presence, schema, values, with ``full`` keys and references."""
    if df is None:
        raise ValueError("use missing_source for a source without files")
    spark = df.sparkSession
    if not has_contract(source):
        return _row(spark, source, "contract", False, None, "no_contract", severity="warning")
    rules = contract(source)
    broken = schema_violations(df, rules)
    parts = [_row(spark, source, "contract_schema", False, v.column, v.code) for v in broken]
    if not broken:
        parts.append(_row(spark, source, "contract_schema", True, None, None))
    parts.append(_counted(value_counts(df, rules), source, "contract_values", F.col("column"), F.col("code")))
    if full:
        for keys in rules.unique:
            if all(k in df.columns for k in keys):
                parts.append(_counted(duplicate_count(df, list(keys)), source, "unique_keys",
                                      F.lit(",".join(keys)), "duplicate"))
        references = {"trades": ("market_id", "id"), "order_filled_v2": ("asset", "asset")}
        if source in references and markets is not None:
            column, target = references[source]
            known = markets
            if target == "asset":
                known = markets.select(F.explode(F.array("token1", "token2")).alias("asset"))
            lost = unknown_references(df, column, known, target).agg(F.count(F.lit(1)).alias("count"))
            parts.append(_counted(lost, source, "references", F.lit(column), "unknown"))
    return reduce(DataFrame.unionByName, parts)


def missing_source(spark: SparkSession, source: str) -> DataFrame:
    return _row(spark, source, "source_presence", False, None, "no_files", severity="warning")


def validate_store(
    frames: dict[str, DataFrame | None], spark: SparkSession, full: bool = False,
    markets: DataFrame | None = None,
) -> DataFrame:
    """Q03 — the report of several sources; None stands for a source without files."""
    return reduce(
        DataFrame.unionByName,
        [
            missing_source(spark, s) if df is None else validate_source(s, df, full, markets)
            for s, df in frames.items()
        ],
    )


def validate_lake(lake, sources: list[str] | None = None, full: bool = False) -> DataFrame:
    """Q03 — the report of a lake's sources, by default of all that have files.

    Beside the checks of ``validate_source`` it tells rows, files and the range of times from the manifest, how
    many files have columns other than the contract's, and how many tasks could not read, or hold another number
    of rows than was written; values are those of the files that can be read.  ``full`` reads every column
    of every file, and adds unique keys and references; without it these are reported as skipped.
    """
    spark, parts = lake.spark, []
    markets = lake.scan_markets() if full else None
    for source in sources if sources is not None else lake.sources():
        kinds = lake.file_columns(source)
        if not kinds:
            parts.append(missing_source(spark, source))
            continue
        parts.append(_statistics(lake, source))
        outcomes = lake.read_outcomes(source, every_column=full).groupBy("problem").agg(F.count(F.lit(1)).alias("count"))
        codes = spark.createDataFrame([("unreadable",), ("row_count",)], "problem string")
        counts = codes.join(outcomes, "problem", "left").select("problem", F.coalesce("count", F.lit(0)).alias("count"))
        parts.append(_counted(counts, source, "file_read", F.lit(None).cast("string"), F.col("problem")))
        if has_contract(source):
            drifted = [
                (source, "file_schema", "warning", "warning", v.column, v.code, n)
                for columns, n in kinds for v in schema_violations(spark.createDataFrame([], columns), contract(source))
            ]
            if drifted:
                parts.append(spark.createDataFrame(drifted, REPORT_SCHEMA).groupBy(
                    "source", "check", "status", "severity", "column", "code").agg(F.sum("count").alias("count")))
        known = markets if markets is not None and not markets.isEmpty() else None
        parts.append(validate_source(source, lake.scan_readable(source), full, known))
        if not full:
            parts.append(spark.createDataFrame([(source, "full_checks", "skipped", "info", None, None, None)], REPORT_SCHEMA))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], REPORT_SCHEMA)


def _statistics(lake, source: str) -> DataFrame:
    """Rows, files and the range of times of a source, one row each, from the manifest."""
    told = lake.month_totals(source).agg(
        F.sum("rows").alias("rows"), F.sum("files").alias("files"), F.min("min_timestamp").alias("min_timestamp"),
        F.max("max_timestamp").alias("max_timestamp"),
    )
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("long").alias("count")) for c in ("rows", "files", "min_timestamp", "max_timestamp")])
    return told.select(F.inline(cells)).select(
        F.lit(source).alias("source"), F.lit("source_stats").alias("check"), F.lit("ok").alias("status"), F.lit("info").alias("severity"),
        "column", F.lit(None).cast("string").alias("code"), "count",
    )


def report_status(report: DataFrame) -> DataFrame:
    """Q03 — one status per source: error over warning over ok."""
    worst = F.when(F.bool_or(F.col("severity") == "error"), "error").when(
        F.bool_or(F.col("severity") == "warning"), "warning"
    ).otherwise("ok")
    return report.groupBy("source").agg(worst.alias("status"))


def ingest_status(raw: DataFrame, trades: DataFrame) -> DataFrame:
    """Q06 — raw rows, distinct and duplicate ids, and the derived second-generation trades."""
    ts = "block_timestamp" if "block_timestamp" in raw.columns else "timestamp"
    # Counting per id first keeps the distinct count a plain two-step aggregate.
    per_id = raw.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.max(ts).alias("t"))
    left = per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("raw_rows"),
        F.count(F.lit(1)).alias("raw_unique_ids"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("raw_duplicate_ids"),
        F.max("t").alias("raw_max_timestamp"),
    )
    derived = trades.where(F.col("orderfilled_id").cast("string").startswith("v2:")).agg(
        F.struct(
            F.count(F.lit(1)).alias("rows"), F.max("timestamp").alias("latest")
        ).alias("d")
    )
    return left.withColumn("_d", derived.scalar()).select(
        *left.columns, F.col("_d.rows").alias("trades_rows"), F.col("_d.latest").alias("trades_max_timestamp")
    )


def market_volume(trades: DataFrame) -> DataFrame:
    """Q07 — fills and volume per market and side."""
    return trades.groupBy("market_id", "nonusdc_side").agg(
        F.count(F.lit(1)).alias("n_trades"), sum_micros("usd_amount").alias("usd_volume")
    )


def top_players(stats: DataFrame, by: str, n: int = 20) -> DataFrame:
    """Q08 — the n best players by a column, player breaking ties, as a top-k."""
    return stats.orderBy(F.desc_nulls_last(by), "player").limit(n)


def top_half_by_bets(stats: DataFrame) -> DataFrame:
    """Q08 — players whose number of bets is at least the median."""
    return stats.where(F.col("n_bets") >= stats.agg(F.median("n_bets")).scalar())


def bet_distribution(stats: DataFrame) -> DataFrame:
    """Q08 — players per number of bets, and the overall mean on every row."""
    mean = stats.agg(F.avg("n_bets")).scalar()
    return (
        stats.groupBy("n_bets").agg(F.count(F.lit(1)).alias("players")).withColumn("mean_n_bets", mean)
    )


def analyst_queries(stats: DataFrame, n: int = 20) -> dict[str, DataFrame]:
    """Q08 — the six questions over player statistics."""
    ranked: dict[str, Callable[[DataFrame], DataFrame]] = {
        "total_won": lambda s: top_players(s, "total_won_usd", n),
        "n_won": lambda s: top_players(s, "n_won", n),
        "win_rate": lambda s: top_players(s, "win_rate", n),
        "score": lambda s: top_players(s.withColumn("score_c", score_c(F.col)), "score_c", n),
    }
    half = top_half_by_bets(stats)
    return {
        **{name: q(stats) for name, q in ranked.items()},
        "bet_distribution": bet_distribution(stats),
        **{f"top_half_{name}": q(half) for name, q in ranked.items()},
    }


def fingerprint(df: DataFrame) -> DataFrame:
    """Q09 — row count and a hash of the content that ignores row and column order.

    The hash of a row is the first 60 bits of an md5 digest over its values as text, in order of
    column names; doubles go in as nine significant decimal places.
    """
    def text(name: str, kind: str):
        value = F.format_string("%.9f", F.col(name).cast("double")) if kind in ("double", "float") else F.col(name).cast("string")
        return F.coalesce(value, F.lit("null"))

    row = F.concat_ws("|", *[text(c, t) for c, t in sorted(df.dtypes, key=lambda c: c[0].lower())])
    part = F.conv(F.substring(F.md5(row.cast("binary")), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(part), F.lit(0)).cast("string").alias("content_hash"),
    )
