"""L06–L10 — landing CSV exports, fill JSON lines, raw event logs and market metadata."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outcomelake.functions import epoch_from_iso
from outcomelake.operators.fills import dedupe, mark_taker_orders
from outcomelake.session import shared_folder

LEGACY_CSV = (
    "timestamp long, maker string, makerAssetId string, makerAmountFilled long, "
    "taker string, takerAssetId string, takerAmountFilled long, transactionHash string"
)

# The fields every fill event must carry.
REQUIRED_FIELDS = (
    "id", "block_number", "block_timestamp", "transaction_hash", "user_id", "asset", "amount_usdc",
    "amount_shares", "price", "side", "order_hash", "counterparty_id", "order_type", "fee", "builder",
)
OPTIONAL_FIELDS = ("exchange", "log_index", "metadata")
# The keys under which an envelope may hold its list of events.
ENVELOPE_KEYS = ("data", "events", "rows", "records")


def load_csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """L06 — a tolerant CSV read with an integral ``timestamp``, one row per ``id``.

    Without a schema every column is text.  A missing timestamp falls back to a
    numeric ``createdAt``, else 0; the first row of an id in file order stays.
    """
    reader = spark.read.option("header", "true").option("mode", "PERMISSIVE")
    raw = (reader.schema(schema) if schema else reader).csv(path)
    # Spark reads a file's splits in order of their offset, rows inside in order.
    place = [F.col("_metadata.file_path"), F.col("_metadata.file_block_start")]
    rows = raw.select(
        "*", place[0].alias("_file"), place[1].alias("_start"), F.monotonically_increasing_id().alias("_line")
    )
    source = "timestamp" if "timestamp" in raw.columns else "createdAt" if "createdAt" in raw.columns else None
    stamp = F.lit(0).cast("long")
    if source:
        stamp = F.coalesce(F.col(source).cast("string").try_cast("long"), stamp)
    rows = rows.withColumn("timestamp", stamp)
    if "id" in raw.columns:
        rows = dedupe(rows, ["id"], ["_file", "_start", "_line"], keep="first")
    return rows.drop("_file", "_start", "_line")


def number_rows(rows: DataFrame, staging: str) -> DataFrame:
    """Gap-free positions in file order for a frame with ``_file``, ``_start`` and ``_line``.

    The rows are written once, because positions come from two passes that must
    see the same splits.  Only one row per input split is numbered in one place:
    a table as long as the driver's own list of splits.
    """
    rows.write.mode("overwrite").parquet(staging)
    staged = rows.sparkSession.read.parquet(staging)
    before = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    splits = staged.groupBy("_file", "_start").agg(F.count(F.lit(1)).alias("_n"), F.min("_line").alias("_l0"))
    offsets = splits.select(
        "_file", "_start", "_l0", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")
    )
    return (
        staged.join(offsets, ["_file", "_start"])
        .withColumn("row_idx", F.col("_off") + F.col("_line") - F.col("_l0"))
        .drop("_file", "_start", "_line", "_l0", "_off")
    )


def load_fills_csv_with_row_ids(
    spark: SparkSession, path: str, limit: int | None = None, staging: str | None = None
) -> DataFrame:
    """L07 — a typed legacy export with ids ``legacy:<row>`` in file order.

    Spark reads plain, gzip, bzip2 and zstd files; there is no codec for xz.
    """
    raw = spark.read.schema(LEGACY_CSV).option("header", "true").csv(path).select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_line"),
    )
    numbered = number_rows(raw, staging or shared_folder(spark, "legacy-csv"))
    if limit is not None:
        numbered = numbered.where(F.col("row_idx") < limit)
    return numbered.withColumn("timestamp", F.coalesce("timestamp", F.lit(0))).select(
        F.concat(F.lit("legacy:"), "row_idx").alias("id"),
        *[c for c in numbered.columns if c != "row_idx"],
    )


def parse_fill_events(lines: DataFrame, order: list[str]) -> DataFrame:
    """L08 — JSON lines (column ``value``) to fills, the last row per id by ``order`` and place.

    A line is an event, an array of events, or an object holding the array under
    an envelope key.  A line that is no JSON object or array, an event without a
    required field, and a malformed number fail the job.
    """
    text = F.trim("value")
    # As text: nested JSON read into a string column keeps its JSON form.
    names = (*REQUIRED_FIELDS, *OPTIONAL_FIELDS)
    fields = T.StructType([T.StructField(f, T.StringType()) for f in names])
    # An object is parsed once, as an event and as an envelope alike.
    whole = F.from_json(text, T.StructType([*fields, *[T.StructField(k, T.StringType()) for k in ENVELOPE_KEYS]]))
    listed = [F.when(F.col(f"_whole.{k}").startswith("["), F.col(f"_whole.{k}")) for k in ENVELOPE_KEYS]
    array_text = F.when(text.startswith("["), text).otherwise(F.coalesce(*listed))
    known = text.startswith("[") | text.startswith("{")
    malformed = F.raise_error(F.lit("malformed list of events"))
    events = (
        lines.withColumn("_whole", F.when(text.startswith("{"), whole))
        .withColumn("_array", F.when(known & (F.length(text) > 0), array_text))
        .withColumn("_parsed", F.from_json("_array", T.ArrayType(fields)))
        .withColumn(
            "_list",
            # Blank lines hold no event; tested here because filters may be reordered.
            F.when(F.length(text) == 0, F.array().cast(T.ArrayType(fields)))
            .when(~known, F.raise_error(F.lit("neither a JSON object nor a list of objects")))
            .when(F.col("_array").isNotNull(), F.coalesce("_parsed", malformed))
            .otherwise(F.array(F.struct(*[F.col(f"_whole.{f}").alias(f) for f in names]))),
        )
        # An outer explode: for an inner one Spark filters empty lists first, and parses every line again for that.
        .select(*order, F.posexplode_outer("_list").alias("_pos", "e")).where("_pos IS NOT NULL")
    )
    absent = [F.when(F.col(f"e.{f}").isNull(), F.lit(f)) for f in REQUIRED_FIELDS]
    lacks = F.concat_ws(", ", *absent)
    checked = F.when(
        F.length(lacks) > 0, F.raise_error(F.concat(F.lit("missing fields: "), lacks))
    ).otherwise(F.col("e.id"))
    long = {f: F.col(f"e.{f}").cast("long") for f in ("block_number", "block_timestamp", "log_index")}
    double = {f: F.col(f"e.{f}").cast("double") for f in ("amount_usdc", "amount_shares", "price", "fee")}

    def text_of(f: str) -> Column:
        return F.col(f"e.{f}").alias(f)

    rows = events.select(
        *order, "_pos", checked.alias("id"), text_of("exchange"), long["log_index"].alias("log_index"),
        long["block_timestamp"].alias("timestamp"), long["block_number"].alias("block_number"),
        long["block_timestamp"].alias("block_timestamp"), text_of("transaction_hash"), text_of("user_id"),
        text_of("asset"), *[double[f].alias(f) for f in ("amount_usdc", "amount_shares", "price")],
        F.upper("e.side").alias("side"), text_of("order_hash"), text_of("counterparty_id"),
        F.lower("e.order_type").alias("order_type"), double["fee"].alias("fee"), text_of("builder"),
        text_of("metadata"),
    )
    return dedupe(rows, ["id"], [*order, "_pos"], keep="last").drop(*order, "_pos")


def import_fill_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """L08 — fills of JSONL files; later files and lines win over earlier ones."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_line"),
    )
    return parse_fill_events(lines, ["_file", "_start", "_line"])


def uint256_text(word: Column) -> Column:
    """64 hex digits to decimal text, in column expressions; no Spark type holds 256 bits.

    The word is eight digits to base 2^32.  Each stands for that digit times a power of 2^32, whose digits
    to base 10^8 are constants; the sums per decimal place fit 64 bits and are carried upwards.
    Other than 64 hex digits fail the job.
    """
    parts = [F.conv(F.substring(word, 57 - 8 * i, 8), 16, 10).cast("long") for i in range(8)]
    base, places = 10 ** 8, 10

    def text(p: Column) -> Column:
        sums = [
            reduce(lambda a, b: a + b, [p[i] * F.lit(2 ** (32 * i) // base ** j % base) for i in range(8) if 2 ** (32 * i) >= base ** j], F.lit(0).cast("long"))
            for j in range(places)
        ]
        # One step per place, each reading the step before once.
        return F.aggregate(
            F.array(*sums), F.struct(F.lit("").alias("text"), F.lit(0).cast("long").alias("carry")),
            lambda acc, s: F.struct(
                F.concat(F.lpad(((s + acc["carry"]) % base).cast("string"), 8, "0"), acc["text"]).alias("text"),
                F.call_function("div", s + acc["carry"], F.lit(base)).alias("carry"),
            ),
            lambda acc: acc["text"],
        )

    # Bound by a lambda, so that the parts are read from the word once.
    digits = F.transform(F.array(F.array(*parts)), text)[0]
    return F.when(F.regexp_like(word, F.lit("^[0-9a-fA-F]{64}$")), F.regexp_replace(digits, "^0+(?=[0-9])", "")).when(
        word.isNotNull(), F.raise_error(F.concat(F.lit("no 256-bit word: "), word)))


def _bare(text: Column) -> Column:
    """Hex digits without their 0x."""
    marked = F.startswith(text, F.lit("0x")) | F.startswith(text, F.lit("0X"))
    return F.when(marked, F.substr(text, F.lit(3))).otherwise(text)


def hex_long(text: Column) -> Column:
    """A hex quantity such as a block number, with or without 0x."""
    return F.conv(_bare(text), 16, 10).cast("long")


def _word(number: int) -> Column:
    """A 32-byte word of ``_body``; of bytes a slice is a copy, of text it counts all characters before."""
    return F.substring("_body", 32 * number + 1, 32)


def _word_amount(number: int) -> Column:
    """A word that holds an amount in 1e-6 units, as a double.

    Real amounts fit the last 64 bits; wider ones are summed from four parts.  A lambda does that, so it
    adds little to the generated code, which the JVM compiles only while its methods are short.
    """
    at = 32 * number + 1
    part = lambda start: F.conv(F.hex(F.substr(F.col("_body"), start, F.lit(8))), 16, 10).cast("double")
    wide = F.aggregate(
        F.array(*[F.lit(at + 8 * i) for i in range(4)]), F.lit(0.0), lambda total, start: total * F.lit(float(2 ** 64)) + part(start))
    small = F.substring("_body", at, 24) == F.unhex(F.lit("0" * 48))
    return F.when(small, part(F.lit(at + 24))).otherwise(wide) / 1e6


def _word_text(number: int) -> Column:
    """A word as decimal text: below 2^120 by two parts and one decimal product, else as ``uint256_text`` does."""
    at = 32 * number + 1
    part = lambda start: F.conv(F.hex(F.substring("_body", start, 8)), 16, 10)
    # The upper part is below 2^56 here, so the product has at most 38 digits.
    upper = part(at + 16).cast("decimal(17,0)") * F.lit(Decimal(2 ** 64)).cast("decimal(20,0)")
    narrow = F.substring("_body", at, 17) == F.unhex(F.lit("0" * 34))
    return F.when(narrow, (upper + part(at + 24).cast("decimal(20,0)")).cast("string")).otherwise(uint256_text(F.hex(_word(number))))


def _address(topic: Column) -> Column:
    return F.concat(F.lit("0x"), F.lower(F.right(topic, F.lit(40))))


def decode_order_events(logs: DataFrame, matches: DataFrame, blocks: DataFrame) -> DataFrame:
    """L09 — raw event logs to fills.

    ``logs`` carry address, blockNumber, transactionHash, logIndex, topics and
    data (seven 32-byte words); ``matches`` transactionHash and topics;
    ``blocks`` block_number and block_timestamp.  A log with too few topics or
    words, or with other than hex digits in them, fails the job.
    """
    body = _bare(F.col("data"))
    digits = F.substring(body, 1, 7 * 64)
    words = F.unhex(digits)
    broken = (F.size("topics") < 4) | (F.octet_length(digits) < 7 * 64) | (words.isNull() & F.col("data").isNotNull())
    data = F.when(broken, F.raise_error(F.lit("event log lacks topics or data words"))).otherwise(words)
    buys = F.col("_side") == F.unhex(F.lit("0" * 64))
    decoded = (
        logs.withColumn("_body", data)
        .withColumn("_side", _word(0))
        .withColumn("_maker", _word_amount(2))
        .withColumn("_taker", _word_amount(3))
        .select(
            F.lower("transactionHash").alias("transaction_hash"),
            hex_long(F.col("logIndex")).alias("log_index"),
            hex_long(F.col("blockNumber")).alias("block_number"),
            F.lower("address").alias("exchange"),
            _address(F.get("topics", F.lit(2))).alias("user_id"),
            _word_text(1).alias("asset"),
            F.when(buys, F.col("_maker")).otherwise(F.col("_taker")).alias("amount_usdc"),
            F.when(buys, F.col("_taker")).otherwise(F.col("_maker")).alias("amount_shares"),
            F.when(buys, "BUY").otherwise("SELL").alias("side"),
            F.lower(F.get("topics", F.lit(1))).alias("order_hash"),
            _address(F.get("topics", F.lit(3))).alias("counterparty_id"),
            _word_amount(4).alias("fee"),
            F.concat(F.lit("0x"), F.lower(F.hex(_word(5)))).alias("builder"),
            F.concat(F.lit("0x"), F.lower(F.hex(_word(6)))).alias("metadata"),
        )
    )
    matched = matches.select(
        F.lower("transactionHash").alias("transaction_hash"),
        F.lower(F.get("topics", F.lit(1))).alias("order_hash"),
    )
    price = F.when(F.col("amount_shares") > 0, F.try_divide("amount_usdc", "amount_shares")).otherwise(0.0)
    return (
        mark_taker_orders(decoded, matched)
        .join(blocks.select("block_number", "block_timestamp"), "block_number")
        .withColumn("id", F.concat_ws(":", "transaction_hash", "log_index"))
        .withColumn("price", price)
        .withColumn("timestamp", F.col("block_timestamp"))
    )


RAW_MARKET = T.StructType(
    [
        *[T.StructField(c, T.StringType()) for c in (
            "id", "question", "title", "outcomes", "clobTokenIds", "category", "createdAt", "closedTime",
            "outcomePrices", "slug", "conditionId", "volume", "resolutionSource", "umaResolutionStatus")],
        *[T.StructField(c, T.BooleanType()) for c in ("negRiskAugmented", "negRiskOther", "closed")],
        T.StructField("events", T.ArrayType(T.StructType(
            [T.StructField("ticker", T.StringType()), T.StructField("category", T.StringType())]))),
    ]
)


def flatten_market_metadata(raw: DataFrame) -> DataFrame:
    """L10 — metadata objects (JSON text in ``value``) to market rows.

    Lists given as JSON text or as lists are both accepted.  Objects that do not
    parse or have fewer than two tokens are dropped.
    """
    m = raw.select(F.from_json("value", RAW_MARKET).alias("m")).select("m.*")
    outcomes = F.from_json("outcomes", "array<string>")
    tokens = F.from_json("clobTokenIds", "array<string>")
    event = F.get("events", F.lit(0))

    def text(c: Column | str, default: str = "") -> Column:
        return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(default))

    filled = F.nullif(F.col("category"), F.lit(""))
    return (
        m.withColumns({"_tokens": tokens, "_outcomes": outcomes})
        .where(F.size("_tokens") >= 2)
        .select(
            text("createdAt").alias("createdAt"), text("id").alias("id"),
            F.coalesce(F.nullif("question", F.lit("")), F.nullif("title", F.lit("")), F.lit("")).alias("question"),
            text(F.get("_outcomes", F.lit(0))).alias("answer1"),
            text(F.get("_outcomes", F.lit(1))).alias("answer2"),
            (F.coalesce("negRiskAugmented", F.lit(False)) | F.coalesce("negRiskOther", F.lit(False)))
            .alias("neg_risk"),
            text("slug").alias("market_slug"),
            F.get("_tokens", F.lit(0)).alias("token1"), F.get("_tokens", F.lit(1)).alias("token2"),
            text("conditionId").alias("condition_id"), text("volume").alias("volume"),
            text(event.getField("ticker")).alias("ticker"), text("closedTime").alias("closedTime"),
            F.coalesce(epoch_from_iso("createdAt"), F.lit(0)).alias("timestamp"),
            F.coalesce(filled, event.getField("category"), F.lit("")).alias("category"),
            F.coalesce(F.nullif("outcomePrices", F.lit("")), F.lit("[]")).alias("outcomePrices"),
            F.coalesce("closed", F.lit(False)).alias("closed"),
            text("resolutionSource").alias("resolutionSource"),
            text("umaResolutionStatus").alias("umaResolutionStatus"),
        )
    )
