"""Means of doubles that do not depend on the order or the grouping of the rows.

Adding doubles rounds at every step, so a sum differs with the number of shuffle partitions.
Whole numbers add up exactly in any order.  So each value is turned into whole numbers first:

* A value below ``PLAIN`` whose shortest decimal form has at most 18 places, as nearly all
  measured values have, is added up as that decimal.
* Any other finite value is a whole multiple of a power of two, and is added up as that
  multiple, with others of like size: those from 16 ** c up to 16 ** (c + 1).
* Infinities and NaN are added up as they are, which no order changes.

Both sums combine before the shuffle.  A group ends with one row for each kind of sum; these are
put together from the largest power down, carrying the rounding error of each addition along.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.text import as_column

#: Decimals hold 20 digits before the point, so 10 ** 11 values below this add up.
PLAIN = 1e9
_DECIMAL, _WHOLE = "decimal(38,18)", "decimal(38,0)"
#: Bits of a class of sizes, and bits that a value has below the first of its class.
_CLASS_BITS, _BELOW = 4, 53


def _power(exponent: Column) -> Column:
    """Two to a whole ``exponent``, exactly."""
    return F.pow(F.lit(2.0), exponent)


def _scaled(value: Column, exponent: Column) -> Column:
    """``value * 2 ** exponent``, in two steps, as the power alone may be too large for a double."""
    half = F.floor(exponent / 2)
    return value * _power(half) * _power(exponent - half)


def _class_of(value: Column) -> Column:
    """c for values from 16 ** c up to 16 ** (c + 1); the logarithm may be off next to a border."""
    size = F.abs(value)
    guess = F.floor(F.log2(size) / _CLASS_BITS)
    low = _scaled(size, -_CLASS_BITS * guess)  # 1 up to 16 when the guess is right
    return F.when(low < 1, guess - 1).when(low >= 2**_CLASS_BITS, guess + 1).otherwise(guess)


def _plain_part(value: Column) -> Column:
    """The value as a decimal if that is the same number, else NULL."""
    decimal = F.when(F.abs(value) < PLAIN, value).cast(_DECIMAL)
    return F.when(decimal.cast("double") == value, decimal)


def _is_special(value: Column) -> Column:
    return F.isnan(value) | (F.abs(value) == float("inf"))


def _is_odd(value: Column) -> Column:
    return value.isNotNull() & _plain_part(value).isNull()


def exact_means(
    df: DataFrame,
    keys: Sequence[str],
    means: Mapping[str, str],
    counts: Mapping[str, str],
    plain: bool | None = None,
) -> DataFrame:
    """Per group the means (output to input column, as doubles) and counts (output to column or ``*``).

    NULL values are left out of a mean; a mean of nothing is NULL.

    Columns without any other value than plain ones need one shuffle and no further entries.
    Whole numbers are so by their type; doubles are looked at first, which reads these columns
    and stops at the first odd value.  ``plain`` says so beforehand; it changes the plan only.
    """
    if plain is None and all(isinstance(df.schema[s].dataType, T.IntegralType) for s in means.values()):
        totals = {name: F.sum(as_column(s).cast("decimal(20,0)")).cast("double") for name, s in means.items()}
        return df.groupBy(*(as_column(k) for k in keys)).agg(
            *(F.count("*" if s == "*" else as_column(s)).alias(name) for name, s in counts.items()),
            *(F.try_divide(total, F.count(as_column(means[name]))).alias(name) for name, total in totals.items()),
        )
    names = [f"_k{i}" for i in range(len(keys))]
    values = [f"_v{i}" for i in range(len(means))]
    counted = {f"_c{i}": source for i, source in enumerate(counts.values())}
    rows = df.select(
        *(as_column(k).alias(n) for k, n in zip(keys, names)),
        *(as_column(s).cast("double").alias(v) for s, v in zip(means.values(), values)),
        *(F.lit(1).alias(c) if s == "*" else as_column(s).isNotNull().cast("int").alias(c) for c, s in counted.items()),
    )

    if plain is None:
        odd_rows = reduce(Column.__or__, (_is_odd(F.col(v)) for v in values))
        plain = rows.where(odd_rows).isEmpty()
    if plain:
        sums = rows.groupBy(*names).agg(
            *(F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(name) for c, name in zip(counted, counts)),
            *(
                F.try_divide(F.sum(_plain_part(F.col(v))).cast("double"), F.count(v)).alias(name)
                for v, name in zip(values, means)
            ),
        )
        return sums.withColumnsRenamed(dict(zip(names, keys)))

    # Each row gives one entry with its decimals and counts, and one for each odd value.
    def odd(i: int, v: str) -> Column:
        value = F.col(v)
        kind = F.when(_is_special(value), F.lit(None).cast("bigint")).otherwise(_class_of(value))
        whole = F.when(~_is_special(value), _scaled(value, _BELOW - _CLASS_BITS * kind).cast("bigint").cast("decimal(19,0)"))
        entry = F.struct(
            F.lit(i).alias("of"), kind.alias("kind"), whole.alias("whole"), F.when(_is_special(value), value).alias("special")
        )
        return F.when(_is_odd(value), entry)

    plain_row = F.struct(
        F.lit(-1).alias("of"), F.lit(None).cast("bigint").alias("kind"),
        F.lit(None).cast("decimal(19,0)").alias("whole"), F.lit(None).cast("double").alias("special"),
    )
    entries = F.array_compact(F.array(plain_row, *(odd(i, v) for i, v in enumerate(values))))
    spread = rows.withColumn("_e", F.explode(entries)).select("*", "_e.*").drop("_e")
    is_plain = F.col("of") == -1
    sums = spread.groupBy(*names, "of", "kind").agg(
        F.sum(F.col("whole").cast("decimal(28,0)")).alias("whole"),
        F.sum("special").alias("special"),
        *(F.sum(F.when(is_plain, _plain_part(F.col(v)))).alias(f"{v}_sum") for v in values),
        *(F.count(F.when(is_plain, F.col(v))).alias(f"{v}_n") for v in values),
        *(F.sum(F.when(is_plain, F.col(c))).alias(c) for c in counted),
    )
    parts = sums.groupBy(*names).agg(
        F.collect_list(F.when(~is_plain, F.struct("of", "kind", "whole", "special"))).alias("_odd"),
        *(F.max(f"{v}_sum").alias(f"{v}_sum") for v in values),
        *(F.max(f"{v}_n").alias(f"{v}_n") for v in values),
        *(F.max(c).alias(c) for c in counted),
    )
    return parts.select(
        *(F.col(n).alias(k) for k, n in zip(keys, names)),
        *(F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(name) for c, name in zip(counted, counts)),
        *(_mean(i, v).alias(name) for i, (v, name) in enumerate(zip(values, means))),
    )


def _mean(i: int, v: str) -> Column:
    """The mean from the decimal sum and the sums of odd values of each class, largest first."""
    mine = F.filter("_odd", lambda x: x["of"] == i)
    special = F.filter(mine, lambda x: x["special"].isNotNull())
    ordered = F.array_sort(
        F.filter(mine, lambda x: x["whole"].isNotNull()),
        lambda x, y: F.when(x["kind"] > y["kind"], -1).otherwise(1),
    )
    # A whole number of many digits, as two that doubles hold exactly.
    halves = F.flatten(
        F.transform(
            ordered,
            lambda x: F.array(
                _scaled((x["whole"] - _low(x["whole"])).cast("double"), x["kind"] * _CLASS_BITS - _BELOW),
                _scaled(_low(x["whole"]).cast("double"), x["kind"] * _CLASS_BITS - _BELOW),
            ),
        )
    )
    plain = F.coalesce(F.col(f"{v}_sum"), F.lit(0)).cast(_DECIMAL)
    start = F.struct(plain.cast("double").alias("sum"), F.lit(0.0).alias("rest"))
    total = F.aggregate(
        halves, start, _added, lambda x: F.when(F.abs(x["sum"]) == float("inf"), x["sum"]).otherwise(x["sum"] + x["rest"])
    )
    total = F.when(F.size(ordered) == 0, plain.cast("double")).otherwise(total)
    total = F.when(F.size(special) > 0, special[0]["special"]).otherwise(total)
    return F.when(F.col(f"{v}_n") > 0, total / F.col(f"{v}_n"))


def _low(whole: Column) -> Column:
    """The last 40 bits; what is left has few enough digits for a double, zeros aside."""
    return F.pmod(whole, F.lit(2**40).cast(_WHOLE))


def _added(state: Column, value: Column) -> Column:
    """``state`` with ``value`` added and the exact rounding error of that addition kept."""
    total = state["sum"] + value
    back = total - state["sum"]
    error = (state["sum"] - (total - back)) + (value - back)
    return F.struct(total.alias("sum"), (state["rest"] + error).alias("rest"))
