"""Sums of doubles that depend neither on the order of rows nor on the size of their terms.

A term adds up in fixed-width values, and the sum is rounded to a double once:

- near terms, below 2**53 in size, as decimals of twelve places;
- far terms, whole numbers all, as the bits of their size: FAR_LIMBS numbers of LIMB_BITS bits
  with the term's sign, each of which is summed as a decimal;
- odd terms, NaN and infinite ones, as doubles; they add up in any order.

Far terms are rare. A table sums them apart and joins them, if it has any; a
stream has one aggregate and keeps the limbs in its state. Decimals leave room for 10**10
terms of the largest size per sum, and a total beyond the largest double is infinite.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

TERM, TOTAL = "decimal(28,12)", "decimal(38,12)"
NEAR = 2.0**53
LIMB_BITS, FAR_LIMBS = 60, 18
_INFINITY = float("inf")
_LIMB, _WIDE = "decimal(28,0)", "decimal(38,0)"


def is_far(value: Column) -> Column:
    """Finite and beyond the near terms, as bounds on the column that a reader can skip row groups by."""
    return ((value >= NEAR) & (value < _INFINITY)) | ((value <= -NEAR) & (value > -_INFINITY))


def near_term(value: Column) -> Column:
    """The number as a term of an exact sum: 0 for a far one, null where it is null or not finite."""
    size = F.abs(value)
    return F.when(size < NEAR, value.cast(TERM)).when(size < _INFINITY, F.lit(0).cast(TERM))


def odd_term(value: Column) -> Column:
    """The number where it is NaN or infinite, else null."""
    return F.when(~(F.abs(value) < _INFINITY), value)


def far_limb(value: Column, place: int) -> Column:
    """Bits place * LIMB_BITS to (place + 1) * LIMB_BITS of a far term, with its sign; null for others.

    Remainders and quotients by powers of two are exact, and a part of 60 bits fits a BIGINT.
    """
    size = F.abs(value)
    rest = size if place == FAR_LIMBS - 1 else size % (2.0 ** (LIMB_BITS * (place + 1)))
    part = F.floor(rest / (2.0 ** (LIMB_BITS * place)))
    return F.when(is_far(value), F.when(value < 0, -part).otherwise(part).cast(_LIMB))


def far_sums(value: Column) -> list[Column]:
    return [F.sum(far_limb(value, place)) for place in range(FAR_LIMBS)]


def far_array(limbs: list[Column]) -> Column:
    """Sums of limbs as an array; null if there was no far term."""
    return F.when(limbs[0].isNotNull(), F.array(*[limb.cast(_WIDE) for limb in limbs]))


def total(near: Column, odd: Column, far: Column | None = None) -> Column:
    """The sum that its parts make, as a double; far is an array of limbs or null."""
    plain = near.cast("double")
    if far is not None:
        plain = F.when(far.isNotNull(), _rounded(F.coalesce(near, F.lit(0)).cast(TOTAL), far)).otherwise(plain)
    return F.coalesce(odd, plain)


def near_sum(value: Column) -> Column:
    return F.sum(near_term(value)).cast(TOTAL)


def odd_sum(value: Column) -> Column:
    return F.sum(odd_term(value))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _whole(number: int) -> Column:
    return F.lit(str(number)).cast(_WIDE)


def _carried(limbs: Column) -> Column:
    """Limbs as they are after carrying: `digits`, all within 0 and 2**60, and what goes beyond as `carry`."""
    base = _whole(1 << LIMB_BITS)

    def step(state: Column, limb: Column) -> Column:
        def split(number: Column) -> Column:
            digit = F.pmod(number, base).cast(_WIDE)
            carry = F.call_function("div", (number - digit).cast(_WIDE), base).cast(_WIDE)
            return F.struct(carry.alias("carry"), F.concat(state["digits"], F.array(digit)).alias("digits"))

        return _let((limb + state["carry"]).cast(_WIDE), split)

    none = F.array().cast(f"array<{_WIDE}>")
    return F.aggregate(limbs, F.struct(_whole(0).alias("carry"), none.alias("digits")), step)


def _rounded(near: Column, far: Column) -> Column:
    """near + the number that far holds, rounded once.

    The size of the sum is written in base 2**60. Its two highest digits have more bits than
    a double, so what is below them counts as one bit more, which tells ties from what is above them.
    """

    def signed(sign: Column) -> Column:
        def own(number: Column) -> Column:  # a product with the sign would lose decimal places
            return F.when(sign < 0, -number).otherwise(number)

        def carried(value: Column) -> Column:
            first = (own(far[0]) + F.floor(value)).cast(_WIDE)
            rest = F.transform(F.slice(far, 2, FAR_LIMBS - 1), lambda limb: own(limb).cast(_WIDE))
            below = F.pmod(value, F.lit(1).cast("decimal(1,0)")).cast("decimal(13,12)")
            return F.struct(sign.alias("sign"), below.alias("below"), _carried(F.concat(F.array(first), rest)).alias("high"))

        return _let(own(near).cast(TOTAL), carried)

    def top(state: Column, digit: Column) -> Column:
        def made(value: Column, taken: Column, low: Column, more: Column) -> Column:
            return F.struct(value.cast(_WIDE).alias("value"), taken.alias("taken"), low.alias("low"), more.alias("more"))

        value, taken, low, more = (state[name] for name in ("value", "taken", "low", "more"))
        two = made(value * _whole(1 << LIMB_BITS) + digit, F.lit(2), low - 1, more)
        leading = F.when(digit == 0, made(value, taken, low - 1, more)).otherwise(made(digit, F.lit(1), low - 1, more))
        return F.when(taken == 0, leading).when(taken == 1, two).otherwise(made(value, taken, low, more | (digit != 0)))

    def as_double(number: Column) -> Column:
        digits = F.reverse(F.concat(number["high"]["digits"], F.array(number["high"]["carry"])))
        start = F.struct(_whole(0).alias("value"), F.lit(0).alias("taken"), F.lit(FAR_LIMBS + 1).alias("low"), F.lit(False).alias("more"))

        def scaled(head: Column) -> Column:
            more = F.when(head["more"] | (number["below"] > 0), 1).otherwise(0)
            odd = (head["value"] * 2 + more).cast(_WIDE).cast("double") * F.pow(F.lit(2.0), head["low"] * LIMB_BITS - 1)
            small = (head["low"] == 0) & (head["value"] < _whole(10**25))
            # 25 and 12 places are what a sum of decimals keeps
            exact = (F.when(small, head["value"]).cast("decimal(25,0)") + number["below"]).cast(TOTAL).cast("double")
            return F.when(small, exact).otherwise(odd) * number["sign"]

        return _let(F.aggregate(digits, start, top), scaled)

    both = F.transform(F.array(F.lit(1), F.lit(-1)), signed)
    return _let(F.filter(both, lambda number: number["high"]["carry"] >= 0)[0], as_double)
