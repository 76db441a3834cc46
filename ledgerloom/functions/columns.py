"""Column expressions with the source database's rules for NULL, text and rounding.

Every helper returns a plain Column built from Spark functions, so it stays in code generation
and can be pushed into scans where Spark allows it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_FORMAT = "dd/MM/yyyy"

# Digit groups of the two tax-id layouts and the mask each one is written with.
COMPANY_ID = (14, "([0-9]{2})([0-9]{3})([0-9]{3})([0-9]{4})([0-9]{2})", "$1.$2.$3/$4-$5")
PERSON_ID = (11, "([0-9]{3})([0-9]{3})([0-9]{3})([0-9]{2})", "$1.$2.$3-$4")


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def joined_text(*parts: Column | str) -> Column:
    """Concatenate, a NULL part counting as empty text. Pass separators as F.lit()."""
    return F.concat(*[F.coalesce(_col(p).cast("string"), F.lit("")) for p in parts])


def with_sign_of(quantity: Column | str, value: Column | str) -> Column:
    """|value| with the sign of quantity; a NULL quantity counts as positive."""
    size = F.abs(_col(value))
    return F.when(_col(quantity) < 0, -size).otherwise(size)


def negate_unless(flag: Column | str, wanted: str, value: Column | str) -> Column:
    """value when flag equals wanted, else its negative. A NULL flag negates."""
    return F.when(_col(flag) == wanted, _col(value)).otherwise(-_col(value))


def money(value: Column | str) -> Column:
    """Two decimals, half up."""
    return _col(value).cast("decimal(16,2)")


def ratio(value: Column | str, by: Column | str) -> Column:
    """Double quotient, NULL when the divisor is zero or NULL."""
    return _col(value).cast("double") / F.nullif(_col(by).cast("double"), F.lit(0.0))


def exact_ratio(value: Column | str, by: Column | str) -> Column:
    """Decimal quotient, NULL when the divisor is zero or NULL.

    The dividend is brought to decimal(26,8) first: a wider one would make Spark cut the
    quotient to six places, and rounding that to cents afterwards would round twice.
    """
    by = _col(by)
    return _col(value).cast("decimal(26,8)") / F.when(by != 0, by)


def to_other_currency(value: Column | str, rate: Column | str) -> Column:
    """value over rate as a double; a missing rate counts as 1, a zero rate gives NULL."""
    return ratio(value, F.coalesce(_col(rate), F.lit(1)))


def margin_percent(price: Column | str, cost: Column | str) -> Column:
    """(price - cost) / price in percent with two decimals; 0 when the price is 0 or NULL."""
    price, cost = _col(price), _col(cost)
    percent = (price - cost) * 100 / F.when(price != 0, price)
    return money(F.when(price != 0, percent).otherwise(F.lit(0)))


def open_balance(
    own_flow: Column, ordered: Column | str, lost: Column | str, returned: Column | str,
    sent: Column | str, delivered: Column | str,
) -> Column:
    """What is still to deliver.

    Orders with their own delivery flow subtract `sent` as it is, so a missing row leaves the
    balance NULL; all others subtract returned and delivered quantities, NULL counting as 0.
    """
    rest = _col(ordered) - _col(lost)
    zero = F.lit(0)
    return F.when(own_flow, rest - _col(sent)).otherwise(
        rest - F.coalesce(_col(returned), zero) - F.coalesce(_col(delivered), zero)
    )


def code_label(code: Column | str, labels: Mapping[str, str]) -> Column:
    """Label of a code; NULL for a code that is not listed."""
    code = _col(code)
    chain = None
    for key, label in labels.items():
        chain = F.when(code == key, label) if chain is None else chain.when(code == key, label)
    return chain


def tax_id_mask(kind: Column | str, number: Column | str) -> Column:
    """Company ('J') or person ('F') tax id, zero-padded, cut to length and punctuated."""
    kind, number = _col(kind), _col(number)

    def masked(layout: tuple[int, str, str]) -> Column:
        width, groups, mask = layout
        return F.regexp_replace(F.lpad(number, width, "0"), groups, mask)

    return F.when(kind == "J", masked(COMPANY_ID)).when(kind == "F", masked(PERSON_ID))


def blank_as_null(value: Column | str) -> Column:
    """Empty text is NULL."""
    return F.nullif(_col(value), F.lit(""))


def nan_as_null(value: Column | str) -> Column:
    """Text form of a value, the text 'nan' being NULL; 'None' stays text, NULL stays NULL."""
    return F.nullif(_col(value).cast("string"), F.lit("nan"))


def capped_text(value: Column | str, width: int = 4000) -> Column:
    """First `width` characters (a cast to varchar(n) does not cut in Spark)."""
    return F.left(_col(value), F.lit(width))


def to_number(value: Column | str) -> Column:
    """Double, NULL when the text is no number."""
    return _col(value).try_cast("double")


def to_integer(value: Column | str) -> Column:
    """Long, so '3.0' and '3' both parse; NULL when it is no number or too large.

    The whole part of a plain number is taken from its text, as a double would change it from 17
    digits on. Only other notations ('1e3') go through double.
    """
    text = _col(value).cast("string")
    plain = r"^\s*([+-]?[0-9]+)(\.[0-9]*)?\s*$"
    whole = F.regexp_extract(text, plain, 1).try_cast("bigint")
    return F.when(text.rlike(plain), whole).otherwise(to_number(value).try_cast("bigint"))


def parsed_day(value: Column | str, pattern: str = DAY_FORMAT) -> Column:
    return F.to_date(_col(value), pattern)


def day_text(value: Column | str, pattern: str = DAY_FORMAT) -> Column:
    return F.date_format(_col(value), pattern)


def last_or_open(value: Column | str) -> Column:
    """Latest value of a group, NULL as soon as one row has none (an aggregate)."""
    value = _col(value)
    return F.when(F.count(F.lit(1)) == F.count(value), F.max(value))
