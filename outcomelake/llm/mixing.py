"""Operator 4: mix sources to target weights by Poisson replication, with DataFrame functions only.

Every document is repeated a Poisson number of times whose mean is the repetition
rate of its source.  The number comes from a hash of the document, by inverting the
distribution function, so a lost task repeats it exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcomelake.llm.common import materialize

#: A Poisson number of a higher rate is the sum of several of at most this rate.
PIECE_RATE = 16.0
#: Counts at which a distribution function of that rate has reached 1 in double precision.
TABLE = 90


def uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) from 52 bits of an md5 digest; the same in every engine."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint").cast("double") / F.lit(float(1 << 52))


def repetition_rates(
    docs: DataFrame, weights: DataFrame | None = None, temperature: float = 0.5, total: float | None = None,
    source: str = "source",
) -> DataFrame:
    """Per source: rows, target weight and the mean number of repetitions that leads to the target.

    Weights are those of ``weights`` (source, weight; one row each), sources without one get 0;
    without ``weights`` they are rows to the power ``temperature``.  ``total`` rows are
    expected in all, by default as many as there are.  Rows of null source are a source.
    """
    counts = docs.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("n_rows"))
    if weights is None:
        weighted = counts.withColumn("weight", F.pow(F.col("n_rows").cast("double"), F.lit(temperature)))
    else:
        given = weights.select(F.col("source").alias("given"), "weight")
        weighted = counts.join(given, F.col("source").eqNullSafe(F.col("given")), "left") \
            .select("source", "n_rows", F.greatest(F.lit(0.0), F.coalesce(F.col("weight").cast("double"), F.lit(0.0))).alias("weight"))
    stored = materialize(weighted, "source-weights")
    # Sorted by source, doubles add up in the same order at every run; integers would not need it.
    sums = stored.agg(
        F.sum("n_rows").alias("rows"), F.sum(F.round(F.col("weight") * 1e6).cast("decimal(38,0)")).alias("weights"),
    ).first()
    scale = 0.0 if not sums["weights"] else (total if total is not None else float(sums["rows"])) / (float(sums["weights"]) / 1e6)
    rate = F.lit(scale) * F.col("weight") / F.col("n_rows")
    pieces = F.greatest(F.lit(1), F.ceil(rate / PIECE_RATE).cast("int"))
    return stored.withColumn("rate", rate).withColumn("pieces", pieces)


def _distribution(rate: Column) -> Column:
    """P(N <= k) for k = 0, 1, ... as an array: each term is the last one times rate / k."""
    first = F.exp(-rate)
    start = F.struct(first.alias("term"), F.array(first).alias("below"))

    def add(acc: Column, k: Column) -> Column:
        term = acc["term"] * rate / k
        return F.struct(
            term.alias("term"),
            F.concat(acc["below"], F.array(F.element_at(acc["below"], -1) + term)).alias("below"),
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(TABLE)), start, add, lambda acc: acc["below"])


def mix_sources(
    docs: DataFrame, weights: DataFrame | None = None, temperature: float = 0.5, total: float | None = None,
    seed: int = 42, source: str = "source", doc_id: str = "doc_id", copy: str = "copy_no",
) -> DataFrame:
    """Every document as often as drawn, numbered from 1 in ``copy``, shuffled over all partitions.

    The draw depends on seed and id: repeated rows are drawn alike, null ids as empty
    text.  Text is only moved in the final shuffle; the rates are a written table, so
    Spark broadcasts them only while their size on disk allows, else it joins by
    shuffle and splits a hot source.  Other columns pass; a column named ``copy`` is replaced.
    """
    own = [c for c in docs.columns if c.lower() != copy.lower()]
    rates = repetition_rates(docs, weights, temperature, total, source)
    tables = materialize(rates.select(
        F.col("source").alias("__source"), F.col("pieces").alias("__pieces"), _distribution(F.col("rate") / F.col("pieces")).alias("__below"),
    ), "repetition-tables")
    drawn = lambda j: F.size(F.filter("__below", lambda p: p <= uniform(seed, F.col(doc_id), j)))
    number = F.aggregate(F.sequence(F.lit(1), F.col("__pieces")), F.lit(0), lambda n, j: n + drawn(j))
    copies = (
        docs.select(*own).join(tables, F.col(source).eqNullSafe(F.col("__source")))
        .withColumn("__n", number).where("__n > 0")
        .select(*own, F.explode(F.sequence(F.lit(1), F.col("__n"))).alias(copy))
        .withColumn("__key", uniform(seed + 1, F.col(doc_id), F.col(copy)))
    )
    # A rebalance by a random key deals rows out evenly, and Spark may split what is too large.
    return copies.hint("rebalance", "__key").sortWithinPartitions("__key", copy).drop("__key")


ORACLE_SQL = """
WITH RECURSIVE counts AS (
    SELECT source, count(*) AS n_rows FROM documents GROUP BY source
), scaled AS (
    SELECT source, n_rows, pow(n_rows::DOUBLE, 0.5) AS weight,
           (SELECT sum(n_rows)::DOUBLE / (sum(round(pow(n_rows::DOUBLE, 0.5) * 1e6)::HUGEINT)::DOUBLE / 1e6) FROM counts) AS scale
    FROM counts
), rates AS (
    SELECT source, scale * weight / n_rows AS rate, greatest(1, ceil(scale * weight / n_rows / 16.0)::INT) AS pieces FROM scaled
), steps AS (
    SELECT source, pieces, rate / pieces AS part, 0 AS k, exp(-rate / pieces) AS term, exp(-rate / pieces) AS below FROM rates
    UNION ALL
    SELECT source, pieces, part, k + 1, term * part / (k + 1), below + term * part / (k + 1) FROM steps WHERE k < 90
), pieces AS (
    SELECT d.doc_id, d.source, j,
           ('0x' || substr(md5('42:' || d.doc_id || ':' || j), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS u
    FROM documents d JOIN rates r ON r.source IS NOT DISTINCT FROM d.source, LATERAL (SELECT unnest(range(1, r.pieces + 1)) AS j)
), drawn AS (
    SELECT p.doc_id, count(*) FILTER (WHERE s.below <= p.u) AS n
    FROM pieces p JOIN steps s ON s.source IS NOT DISTINCT FROM p.source GROUP BY p.doc_id
)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, c.copy_no::INT AS copy_no
FROM documents d JOIN drawn USING (doc_id), LATERAL (SELECT unnest(range(1, n + 1)) AS copy_no) c
"""
