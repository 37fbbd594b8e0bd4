"""Ordered rules that sort mixed records into classes."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

CLASS = "data_source_type"
UNKNOWN = "unknown"


@dataclass(frozen=True)
class Rule:
    """A record has the label when every required expression is present and every forbidden one is null."""

    label: str
    required: tuple[str, ...]
    forbidden: tuple[str, ...] = ()

    def condition(self) -> Column:
        tests = [F.expr(e).isNotNull() for e in self.required] + [F.expr(e).isNull() for e in self.forbidden]
        result = tests[0]
        for t in tests[1:]:
            result = result & t
        return result


# The record types and the fields that tell them apart.
STRICT = (
    Rule("booking_hotel", ("hotelId", "facilities", "type"), ("reviewTitle",)),
    Rule("booking_review", ("hotelId", "hotelRatingScores", "reviewTitle")),
    Rule("tripadvisor_hotel", ("locationId", "amenities", "latitude"), ("text",)),
    Rule("tripadvisor_review", ("locationId", "text", "publishedDate")),
    Rule("geospatial_attraction", ("categoryName", "additionalInfo", "placeId")),
)

# As above, but it also knows hotels that carry their key in `id`, untitled reviews, places
# without extra information, and the placeholders a scraper leaves for failed pages.
CORRECTED = (
    Rule("scrape_error", ("error",)),
    Rule("booking_hotel", ("hotelId", "facilities", "type"), ("reviewTitle",)),
    Rule("booking_review", ("hotelId", "hotelRatingScores", "id")),
    Rule("tripadvisor_hotel", ("coalesce(locationId, id)", "amenities", "latitude"), ("text", "reviewTitle")),
    Rule("tripadvisor_review", ("locationId", "text", "publishedDate")),
    Rule("geospatial_attraction", ("categoryName", "placeId")),
)


def classify(df: DataFrame, rules=CORRECTED, column: str = CLASS, default: str = UNKNOWN) -> DataFrame:
    """Add the label of the first rule that matches."""
    label = F
    for rule in rules:
        label = label.when(rule.condition(), F.lit(rule.label))
    return df.withColumn(column, label.otherwise(F.lit(default)))


def of_class(df: DataFrame, label: str, column: str = CLASS) -> DataFrame:
    """Rows of one class; an empty frame with the same columns when there are none."""
    return df.filter(F.col(column) == label)


def class_counts(df: DataFrame, column: str = CLASS, name: str = "records") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name))


def quarantine(df: DataFrame, labels=(UNKNOWN, "scrape_error"), column: str = CLASS) -> DataFrame:
    """Records no table takes, kept for inspection."""
    return df.filter(F.col(column).isin(*labels))
