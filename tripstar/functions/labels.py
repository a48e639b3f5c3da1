"""Labels and threshold bands shown next to the figures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Full day names by their three-letter form.
DAY_NAMES = {
    "Sun": "Sunday",
    "Mon": "Monday",
    "Tue": "Tuesday",
    "Wed": "Wednesday",
    "Thu": "Thursday",
    "Fri": "Friday",
    "Sat": "Saturday",
}
# Month abbreviations in calendar order.
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
# Words that decide the class of a service category.
PREMIUM_WORDS = ["premium", "luxury", "executive"]
STANDARD_WORDS = ["standard", "regular", "normal"]


def _lookup(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def full_day_name(day: Column) -> Column:
    """Long form of an abbreviated day; other texts pass through."""
    return F.coalesce(F.try_element_at(_lookup(DAY_NAMES), day), day)


def month_number(name: Column) -> Column:
    """1..12 from a month name, long or short; 0 if it is none."""
    return F.array_position(F.array(*map(F.lit, MONTHS)), F.substring(name, 1, 3)).cast("int")


def arrow(start: Column, end: Column) -> Column:
    return F.concat(start, F.lit(" → "), end)


def period_label(year: Column, month_name: Column) -> Column:
    return F.concat(year.cast("string"), F.lit(" - "), month_name)


def short_month_label(month_name: Column, year: Column) -> Column:
    return F.concat(F.substring(month_name, 1, 3), F.lit(" "), year.cast("string"))


def three_bands(value: Column, high: float, middle: float, names: tuple[str, str, str]) -> Column:
    """First name at or above ``high``, second at or above ``middle``, else third."""
    return (
        F.when(value >= high, names[0]).when(value >= middle, names[1]).otherwise(names[2])
    )


def demand_band(intensity: Column) -> Column:
    return three_bands(intensity, 80, 50, ("Peak Hours", "High Demand", "Low Demand"))


def traffic_band(trips: Column) -> Column:
    return three_bands(trips, 10000, 5000, ("High Traffic", "Medium Traffic", "Low Traffic"))


def cashless_band(percentage: Column) -> Column:
    return three_bands(percentage, 80, 50, ("High Digital", "Mixed Payment", "Cash Heavy"))


def growth_sign(value: Column) -> Column:
    return (
        F.when(value > 0, "Growth").when(value < 0, "Decline").when(value == 0, "Stable")
        .otherwise("No Data")
    )


def rank_label(rank: Column) -> Column:
    return (
        F.when(rank == 1, "gold").when(rank == 2, "silver").when(rank == 3, "bronze")
        .otherwise(F.concat(F.lit("#"), rank.cast("string")))
    )


def service_class(category: Column) -> Column:
    text = F.lower(category)
    return (
        F.when(text.rlike("|".join(PREMIUM_WORDS)), "premium-service")
        .when(text.rlike("|".join(STANDARD_WORDS)), "standard-service")
        .otherwise("economy-service")
    )


def day_period(hour: Column) -> Column:
    """Coarse part of the day used by the slot analysis."""
    return (
        F.when(hour.between(5, 11), "Morning (5-12)")
        .when(hour.between(12, 16), "Afternoon (12-17)")
        .when(hour.between(17, 21), "Evening (17-22)")
        .otherwise("Night (22-5)")
    )
