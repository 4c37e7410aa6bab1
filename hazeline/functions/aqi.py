"""Air-quality index scoring as native column expressions."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.schemas import BREAKPOINTS, CATEGORIES, GUIDELINES, POLLUTANTS


def interpolate_index(value: Column, low, high, index_low, index_high) -> Column:
    """Linear interpolation inside one bracket, rounded half to even."""
    slope = (index_high - index_low) / (high - low)
    return F.rint(F.lit(slope) * (value - F.lit(float(low))) + F.lit(float(index_low)))


def sub_index(pollutant: str, value: Column | None = None, mode: str = "closed") -> Column:
    """Index of one pollutant; NULL stays NULL, NaN and gap values overflow.

    ``mode="contiguous"`` first truncates to the precision the brackets are
    published with, which closes the gaps between them.
    """
    table = BREAKPOINTS[pollutant]
    value = F.col(pollutant) if value is None else value
    amount = value.cast("double")
    for divisor in table["divisors"]:
        amount = amount / F.lit(divisor)
    if mode == "contiguous":
        per_unit = round(1 / table["step"])
        amount = F.floor(F.round(amount * per_unit, 6)).cast("double") / F.lit(float(per_unit))
    elif mode != "closed":
        raise ValueError(f"unknown mode {mode!r}")
    score = F.when(value.isNull(), F.lit(None).cast("double"))
    for low, high, index_low, index_high in table["brackets"]:
        inside = amount.between(F.lit(float(low)), F.lit(float(high)))
        score = score.when(inside, interpolate_index(amount, low, high, index_low, index_high))
    return score.otherwise(F.lit(float(table["overflow"]))).cast("int")


def composite_index(columns=POLLUTANTS, mode: str = "closed") -> Column:
    """Highest sub-index of the pollutants present, 0 when there is none."""
    scores = [sub_index(name, mode=mode) for name in columns]
    best = F.greatest(*scores) if len(scores) > 1 else scores[0] if scores else F.lit(None)
    return F.coalesce(best, F.lit(0)).cast("int")


def with_aqi(df: DataFrame, mode: str = "closed") -> DataFrame:
    """Replace any vendor index by the computed one."""
    present = [name for name in POLLUTANTS if name in df.columns]
    return df.withColumn("aqi", composite_index(present, mode))


def display_value(value: Column) -> Column:
    """Integer part, never below 0; NULL counts as 0."""
    return F.greatest(F.lit(0), F.coalesce(value, F.lit(0)).cast("int"))


_PARTS = {"category": 1, "color": 2, "tint": 3, "icon": 4, "message": 5}


def category(value: Column, part: str = "category") -> Column:
    """One attribute of the health category an index value falls in."""
    shown, at = display_value(value), _PARTS[part]
    ladder = reduce(
        lambda chain, row: chain.when(shown <= row[0], F.lit(row[at])), CATEGORIES[1:],
        F.when(shown <= CATEGORIES[0][0], F.lit(CATEGORIES[0][at])),
    )
    return ladder.otherwise(F.lit(CATEGORIES[-1][at]))


def with_category(df: DataFrame, value: str = "aqi", parts=tuple(_PARTS)) -> DataFrame:
    return df.withColumns({part: category(F.col(value), part) for part in parts})


def guideline_percent(df: DataFrame, co_in_milligrams: bool = True, keys=("city", "timestamp")) -> DataFrame:
    """Long table of each pollutant as a percentage of its guideline, at most 100.

    The CO guideline is per milligram while the column holds micrograms, so it is
    converted; ``co_in_milligrams=False`` compares the raw number.
    """
    def amount(name):
        value = F.coalesce(F.col(name), F.lit(0.0))
        return value / 1000.0 if name == "co" and co_in_milligrams else value

    entries = [
        F.struct(F.lit(name).alias("pollutant"), amount(name).alias("amount"), F.lit(limit).alias("guideline"))
        for name, limit in GUIDELINES.items()
    ]
    percent = F.least(F.col("amount") / F.col("guideline") * 100.0, F.lit(100.0))
    return (
        df.select(*keys, F.inline(F.array(*entries)))
        .withColumn("percent", percent)
        .withColumn("over_80", F.col("percent") >= 80.0)
    )


def clamp_index(value: Column) -> Column:
    """Keep a prediction inside [0, 500]; NULL stays NULL."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(0.0)), F.lit(500.0)))
