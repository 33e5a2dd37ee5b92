"""Data contracts: column types, required and null rules, bounds, allowed values, unique keys."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

SPARK_TYPES = {
    "String": T.StringType(),
    "Int64": T.LongType(),
    "Int32": T.IntegerType(),
    "Float64": T.DoubleType(),
    "Float32": T.FloatType(),
    "Boolean": T.BooleanType(),
}


@dataclass(frozen=True)
class ColumnRule:
    name: str
    types: tuple[str, ...]
    required: bool = True
    nullable: bool = False
    minimum: float | None = None
    exclusive_min: float | None = None
    maximum: float | None = None
    allowed: tuple[str, ...] = ()

    @property
    def spark_type(self) -> T.DataType:
        return SPARK_TYPES[self.types[0]]


@dataclass(frozen=True)
class Contract:
    source: str
    columns: tuple[ColumnRule, ...]
    unique: tuple[tuple[str, ...], ...] = field(default=())

    def struct(self, optional: bool = True) -> T.StructType:
        """The contract as a read schema, so additive columns surface as nulls."""
        return T.StructType(
            [T.StructField(c.name, c.spark_type, True) for c in self.columns if c.required or optional]
        )


def _text(*names: str, **rule) -> list[ColumnRule]:
    return [ColumnRule(n, ("String",), **rule) for n in names]


def _long(*names: str, minimum: float | None = None, **rule) -> list[ColumnRule]:
    return [ColumnRule(n, ("Int64",), minimum=minimum, **rule) for n in names]


def _double(*names: str, **rule) -> list[ColumnRule]:
    return [ColumnRule(n, ("Float64",), **rule) for n in names]


_SIDES = ("BUY", "SELL")
_TOKENS = ("token1", "token2")


def _market_columns(observed: bool) -> tuple[ColumnRule, ...]:
    columns = [
        *_text("id", "createdAt", "question", "answer1", "answer2"),
        ColumnRule("neg_risk", ("Boolean",)),
        *_text("market_slug", "token1", "token2", "condition_id"),
        ColumnRule("volume", ("String", "Int64", "Float64")),
        *_text("ticker", "closedTime"),
        *_long("timestamp", minimum=0),
        *_text("category"),
        *_text("outcomePrices", required=False),
        ColumnRule("closed", ("Boolean",), required=False),
        *_text("resolutionSource", "umaResolutionStatus", required=False),
    ]
    if observed:
        columns += _long("observed_at", minimum=0, required=False)
    return tuple(columns)


# The table contracts of the lake.
CONTRACTS: dict[str, Contract] = {
    "orderfilled": Contract(
        "orderFilled",
        (
            *_text("id"),
            *_long("timestamp", minimum=1),
            *_text("maker", "makerAssetId"),
            ColumnRule("makerAmountFilled", ("String", "Int64")),
            *_text("taker", "takerAssetId"),
            ColumnRule("takerAmountFilled", ("String", "Int64")),
            *_text("transactionHash"),
        ),
        (("id",),),
    ),
    "order_filled_v2": Contract(
        "order_filled_v2",
        (
            *_text("id"),
            *_text("exchange", required=False),
            *_long("log_index", minimum=0, required=False),
            *_long("timestamp", "block_number", "block_timestamp", minimum=1),
            *_text("transaction_hash", "user_id", "asset"),
            *_double("amount_usdc", "amount_shares", exclusive_min=0),
            *_double("price", minimum=0, maximum=1),
            *_text("side", allowed=_SIDES),
            *_text("order_hash", "counterparty_id"),
            *_text("order_type", allowed=("maker", "taker")),
            *_double("fee", minimum=0),
            *_text("builder"),
            *_text("metadata", required=False),
        ),
        (("id",),),
    ),
    "markets": Contract("markets", _market_columns(observed=True), (("id",),)),
    "markets_current": Contract("markets_current", _market_columns(observed=False), (("id",),)),
    "market_assets": Contract(
        "market_assets",
        (
            *_text("asset", "market_id"),
            *_text("token_side", allowed=_TOKENS),
            *_long("timestamp", minimum=0),
        ),
        (("asset",),),
    ),
    "market_outcomes": Contract(
        "market_outcomes",
        (
            *_text("market_id"),
            *_text("winner_token", allowed=_TOKENS),
            *_long("resolved_at", "observed_at", minimum=1),
            *_text("resolution_source", "resolution_status"),
            *_long("timestamp", minimum=1),
        ),
        (("market_id",),),
    ),
    "trades": Contract(
        "trades",
        (
            *_long("timestamp", minimum=1),
            *_text("market_id", "maker", "taker"),
            *_text("nonusdc_side", allowed=_TOKENS),
            *_text("maker_direction", "taker_direction", allowed=_SIDES),
            *_double("price", minimum=0, maximum=1),
            *_double("usd_amount", "token_amount", exclusive_min=0),
            *_text("transactionHash", "orderfilled_id"),
        ),
        (("orderfilled_id",),),
    ),
}

# Other names under which a source may be addressed.
ALIASES = {
    "orderFilled": "orderfilled",
    "order_filled": "orderfilled",
    "orderFilledV2": "order_filled_v2",
    "missing_markets": "markets",
    "market_refreshes": "markets",
}


def contract(source: str) -> Contract:
    """Q01 — the contract of a source, by name or alias."""
    key = ALIASES.get(source, source if source in CONTRACTS else source.lower())
    if key not in CONTRACTS:
        raise KeyError(f"no contract for source {source!r}")
    return CONTRACTS[key]


def has_contract(source: str) -> bool:
    try:
        contract(source)
    except KeyError:
        return False
    return True
