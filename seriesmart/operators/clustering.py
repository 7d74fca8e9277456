"""A Z-order code: rows that agree in any one of several columns stand in few runs of its order."""

from pyspark.sql import Column, DataFrame, Window, functions as F

BITS = 10  # of each column


def rank_codes(df: DataFrame, column: str, within: str, code: str, bits: int = BITS) -> DataFrame:
    """``within, column, code``: the share of rows of ``within`` that stand before each value, in ``bits`` bits.

    Values get room by their rows, so where a third of all rows has one value, the others still
    differ in the first bits. Rows are counted before any shuffle; only one ``within``'s distinct values,
    a dimension, meet in a task.
    """
    counts = df.groupBy(within, column).agg(F.count("*").alias("_rows"))
    own = Window.partitionBy(within)
    before = F.coalesce(F.sum("_rows").over(own.orderBy(column).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    share = F.expr(f"_before * {1 << bits} div _total").cast("bigint")
    placed = counts.select(within, column, before.alias("_before"), F.sum("_rows").over(own).alias("_total"))
    return placed.select(within, column, share.alias(code))


def interleaved(codes: list[Column], bits: int = BITS) -> Column:
    """The bits of several whole numbers in turn, the highest ones first."""
    n, out = len(codes), F.lit(0).cast("bigint")
    for bit in range(bits):
        for at, code in enumerate(codes):
            one = F.shiftright(code, bit).bitwiseAND(F.lit(1)).cast("bigint")
            out = out.bitwiseOR(F.shiftleft(one, bit * n + n - 1 - at))
    return out


def with_z_order(df: DataFrame, columns: list[str], within: str, name: str = "_z") -> DataFrame:
    """Adds the Z-order code of ``columns`` inside each value of ``within``; a null is a value like others.

    Each column's values are counted by a scan of that column and ``within`` alone.
    """
    if not 0 < len(columns) * BITS < 63:
        raise ValueError(f"one to six columns can be clustered, not {columns}")
    coded, codes = df, []
    for at, column in enumerate(columns):
        key, own, code = f"_key{at}", f"_within{at}", f"_code{at}"
        ranks = rank_codes(df, column, within, code).withColumnsRenamed({column: key, within: own})
        same = F.col(column).eqNullSafe(F.col(key)) & F.col(within).eqNullSafe(F.col(own))
        coded = coded.join(ranks, same).drop(key, own)
        codes.append(code)
    return coded.withColumn(name, interleaved([F.col(code) for code in codes])).drop(*codes)
