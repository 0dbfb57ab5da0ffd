"""Exact sums of amounts, whatever the order in which they are added.

Whole and decimal amounts add exactly as they are. A floating amount is cut into limbs: whole numbers of 24 bits that count
multiples of a power of two each. Limbs are added as whole numbers, in groups, running totals and shifts alike, and
only a finished total is carried and rounded to a floating number. Rounding never decreases as totals grow, so a total
found from part of the rows and the same total found from all of them fall on the same side of a limit."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

LIMB = 24  # bits
SPARE = 2  # limbs above the largest amount: room for 2 ** 39 rows and more
_MASK = (1 << LIMB) - 1


@dataclass(frozen=True)
class Adder:
    """How an amount is added: ``names`` are the columns of its sums, lowest limb first. ``low`` is the power of 2 ** 24
    that the lowest limb counts, None where one column holds the amount as it is."""

    names: tuple[str, ...]
    low: int | None = None

    def terms(self, amount: Column) -> list[Column]:
        """What a row adds to each sum; null where the amount is."""
        if self.low is None:
            return [amount]
        x = amount.cast("double")
        size = F.abs(x)

        def limb(power: int) -> Column:
            # both factors are powers of two, and so is the modulus: nothing is rounded
            scale = F.lit(2.0 ** (-power * LIMB // 2))
            q = size * scale * scale
            whole = F.when(q < F.lit(2.0**77), F.floor(q % F.lit(2.0**LIMB))).otherwise(F.lit(0).cast("long"))
            return F.when(x.isNotNull(), F.when(x < 0, -whole).otherwise(whole))

        return [limb(self.low + k) for k in range(len(self.names))]

    def sums(self, amount: Column, empty: bool = False) -> list[Column]:
        """Aggregates under ``names``; with ``empty`` a sum of no amounts is 0, else null."""
        made = [F.sum(t) for t in self.terms(amount)]
        return [(F.coalesce(s, F.lit(0)) if empty else s).alias(n) for s, n in zip(made, self.names)]

    def run(self, df: DataFrame, window: WindowSpec, prefix: str = "_run") -> DataFrame:
        """The sums over a window, in columns named with a prefix."""
        return df.withColumns({prefix + n: F.sum(n).over(window) for n in self.names})

    def columns(self, prefix: str = "_run") -> list[Column]:
        return [F.col(prefix + n) for n in self.names]

    def value(self, sums: Sequence[Column]) -> Column:
        """A total from its sums: as it is, or rounded to a double."""
        if self.low is None:
            return sums[0]
        start = F.struct(F.lit(0).cast("long").alias("carry"), F.array().cast("array<bigint>").alias("done"))

        def carried(state: Column, x: Column) -> Column:
            t = x + state["carry"]
            done = F.concat(state["done"], F.array(t.bitwiseAND(F.lit(_MASK).cast("long"))))
            return F.struct(F.shiftright(t, LIMB).alias("carry"), done.alias("done"))

        whole = F.aggregate(F.array(*sums), start, carried, lambda s: F.concat(F.array(s["carry"]), F.reverse(s["done"])))
        powers = [self.low + k for k in range(len(self.names), -1, -1)]
        # the topmost limb holds only a sign: 0 or -1
        scales = F.array(*[F.lit(2.0 ** min(p * LIMB // 2, 1000)) for p in powers])
        parts = F.zip_with(whole, scales, lambda x, s: F.struct(x.alias("x"), s.alias("s")))
        # with the sign joined to the limb below it no part is far larger than the total
        top = F.get(whole, F.lit(0)) * F.lit(1 << LIMB) + F.get(whole, F.lit(1))
        joined = F.concat(
            F.array(F.struct(top.alias("x"), F.get(scales, F.lit(1)).alias("s"))),
            F.slice(parts, 3, len(self.names) + 1),
        )
        total = F.aggregate(joined, F.lit(0.0), lambda a, p: a + p["x"].cast("double") * p["s"] * p["s"])
        return F.when(sums[0].isNotNull(), total)


ROWS = Adder(("_rows",))


def adder(df: DataFrame, amount: Column, name: str = "_amount") -> Adder:
    """How to add ``amount``. Floating ones need a pass for their smallest and largest size, which say how many limbs it
    takes: five or six for seconds, some 90 for everything a double can hold. Infinite amounts and NaN are refused."""
    kind = df.select(amount.alias("a")).schema["a"].dataType
    if not isinstance(kind, (T.FloatType, T.DoubleType)):
        return Adder((name,))
    x = amount.cast("double")
    size = F.abs(x)
    found = df.agg(
        F.min(F.when(size > 0, size)).alias("least"),
        F.max(size).alias("most"),
        F.bool_or(F.isnan(x) | (size == F.lit(math.inf))).alias("endless"),
    ).first()
    if found["endless"]:
        raise ValueError("amounts must be finite numbers")
    if not found["least"]:
        return Adder((f"{name}0",), 0)
    lowest = max(math.frexp(found["least"])[1] - 53, -1074) // LIMB
    highest = (math.frexp(found["most"])[1] - 1) // LIMB + SPARE
    return Adder(tuple(f"{name}{k}" for k in range(highest - lowest + 1)), lowest)


def running(partition: Sequence[str], order: Sequence[Column], inclusive: bool = True) -> WindowSpec:
    """Rows from the first one on, up to the current one or the one before it."""
    window = Window.partitionBy(*partition).orderBy(*order)
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
