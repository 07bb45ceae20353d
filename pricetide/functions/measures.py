"""Numeric columns of searches and update passes."""

from pyspark.sql import functions as F


def rate(amount, time):
    """Amount per unit of time, 0 where no time has passed."""
    return F.coalesce(F.try_divide(amount.cast("double"), time.cast("double")), F.lit(0.0))


def milliseconds(seconds):
    return seconds * 1000


def range_width(low, high):
    """Width of a price range, 0 where a bound is absent."""
    return F.coalesce(high - low, F.lit(0.0))


def clamp_range(low, high, smallest, largest):
    """Bounds moved into the table's range; an empty range becomes [high - 1, high]."""
    low = F.greatest(low, smallest)
    high = F.least(high, largest)
    return F.when(low >= high, high - 1).otherwise(low), high


def capped_hits(total, cap=10_000):
    """Hit count as a counter that stops at `cap` shows it."""
    return F.least(total, F.lit(cap))


def correlation(x, y):
    """Pearson correlation as an aggregate; NULL for constant or single-row input."""
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def correlation_label(c):
    size = F.abs(c)
    return (
        F.when(size > 0.7, "Strong correlation")
        .when(size > 0.5, "Moderate correlation")
        .when(size > 0.3, "Weak correlation")
        .otherwise("No significant correlation")
    )


def impact_percent(during, without):
    return F.try_divide(during - without, without) * 100


def fixed(column, places=2):
    """A number as text with a fixed number of decimals."""
    return F.format_string(f"%.{places}f", column.cast("double"))


def signed_percent(column):
    return F.format_string("%+.1f%%", column.cast("double"))


def search_label(search_type, query_type, low, high, terms):
    """One-line description of a search, by its query type."""
    bounds = F.format_string("$%.2f - $%.2f", low.cast("double"), high.cast("double"))
    words = F.concat(F.lit("'"), terms, F.lit("'"))
    tail = (
        F.when(query_type == "price_range", bounds)
        .when(query_type == "text_search", words)
        .when(query_type == "combined", F.concat_ws(" + ", words, bounds))
        .otherwise("unknown")
    )
    return F.concat_ws(": ", search_type, tail)


def times_power(value, exponent):
    """`value` times two to the `exponent`, in two steps, as the power may be out of range alone."""
    half = F.floor(exponent / 2)
    return value * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), exponent - half)


def order_bins(value, per_unit):
    """Whole numbers that grow with `value`, about `per_unit` to each factor e.

    Equal values share a bin and bins keep the order of the values, so counts per
    bin locate a rank without sorting the values themselves. Never NULL, so that a join
    on bins adds no filter that would keep Spark from sharing a shuffle.
    """
    value = value.cast("double")
    bin = F.when(F.isnan(value), F.lit((1 << 63) - 1)).otherwise(
        F.floor(F.signum(value) * F.log1p(F.abs(value)) * per_unit)
    )
    return F.coalesce(bin, F.lit(0).cast("long"))


def order_bits(value):
    """The bits of a double as a whole number that keeps the order of the values.

    Different values have different numbers; both zeros have 0, what is no number comes
    last, NULL counts as 0. Shifted to the right the numbers are bins, each of which the
    next bits split evenly in kind: so many bits, so many bins, whatever the values are.
    """
    value = value.cast("double")
    size = F.abs(value)
    # the exponent, at least that of the smallest normal number, put right where the logarithm is rounded
    guess = F.greatest(F.floor(F.log2(size)), F.lit(-1022))
    scaled = times_power(size, -guess)
    over, under = scaled >= 2, (scaled < 1) & (guess > -1022)
    exponent = guess + F.when(over, 1).when(under, -1).otherwise(0)
    scaled = scaled * F.when(over, 0.5).when(under, 2.0).otherwise(1.0)
    bits = (exponent + 1022) * F.lit(1 << 52) + (scaled * F.lit(2.0**52)).cast("long")
    bits = F.when(size == float("inf"), F.lit(2047 << 52)).when(size == 0, F.lit(0).cast("long")).otherwise(bits)
    signed = F.when(value < 0, -bits).otherwise(bits)
    return F.coalesce(F.when(F.isnan(value), F.lit((1 << 63) - 1)).otherwise(signed), F.lit(0).cast("long"))
