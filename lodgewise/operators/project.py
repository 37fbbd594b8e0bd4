"""Flat typed tables, one per record class."""

from pyspark.sql import Column, DataFrame, functions as F

from lodgewise.functions.casts import address_part, size_or_zero, to_bool, to_date, to_double, to_int
from lodgewise.operators.classify import of_class

# The platform names.
BOOKING, TRIPADVISOR, MAPS = "booking.com", "tripadvisor.com", "google_maps"


def load_time(as_of=None) -> Column:
    """The given load time, so that a rerun agrees; the current time without one."""
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def _tagged(df: DataFrame, columns: list[Column], platform: str, as_of, extra=()) -> DataFrame:
    return df.select(*columns, F.lit(platform).alias("platform"), load_time(as_of).alias("processed_at"), *extra)


def booking_hotels(df: DataFrame, as_of=None, extra=()) -> DataFrame:
    c = F.col
    columns = [
        c("row_id").alias("source_row_id"),
        c("hotelId").alias("booking_hotel_id"),
        c("name").alias("hotel_name"),
        c("type").alias("accommodation_type"),
        c("description"),
        to_int("stars").alias("stars"),
        c("price"),
        c("currency"),
        to_double("rating").alias("rating"),
        to_int("reviews").alias("reviews"),
        to_double("location.lat").alias("latitude"),
        to_double("location.lng").alias("longitude"),
        F.coalesce(address_part("full"), c("address")).alias("full_address"),
        F.coalesce(c("street"), address_part("street")).alias("street_address"),
        F.coalesce(c("countryCode"), address_part("country")).alias("country"),
        F.coalesce(c("state"), address_part("region")).alias("region"),
        F.coalesce(c("postalCode"), address_part("postalCode")).alias("postal_code"),
        c("breakfast"),
        c("checkIn").alias("check_in_time"),
        c("checkOut").alias("check_out_time"),
        c("url").alias("booking_url"),
        c("facilities"),
    ]
    return _tagged(of_class(df, "booking_hotel"), columns, BOOKING, as_of, extra)


def booking_reviews(df: DataFrame, as_of=None, extra=()) -> DataFrame:
    c = F.col
    columns = [
        c("row_id").alias("source_row_id"),
        c("id").alias("review_id"),
        c("hotelId").alias("booking_hotel_id"),
        to_double("rating").alias("rating"),
        c("reviewTitle").alias("review_title"),
        c("likedText").alias("liked_text"),
        c("dislikedText").alias("disliked_text"),
        c("travelerType").alias("traveler_type"),
        c("userLocation").alias("user_location"),
        c("userName").alias("user_name"),
        to_int("numberOfNights").alias("number_of_nights"),
        c("roomInfo").alias("room_info"),
        to_int("helpfulVotes").alias("helpful_votes"),
        c("reviewLanguage").alias("review_language"),
        to_date("checkInDate").alias("check_in_date"),
        to_date("checkOutDate").alias("check_out_date"),
        to_date("reviewDate").alias("review_date"),
        c("hotelRatingScores").alias("category_ratings"),
    ]
    return _tagged(of_class(df, "booking_review"), columns, BOOKING, as_of, extra)


def tripadvisor_hotels(df: DataFrame, as_of=None, extra=()) -> DataFrame:
    c = F.col
    columns = [
        c("row_id").alias("source_row_id"),
        F.coalesce(c("locationId"), c("id")).alias("tripadvisor_location_id"),
        c("name").alias("hotel_name"),
        c("category").alias("accommodation_type"),
        c("description"),
        to_double("rating").alias("rating"),
        to_int("numberOfReviews").alias("reviews_count"),
        c("hotelClass").alias("hotel_class"),
        to_double("latitude").alias("latitude"),
        to_double("longitude").alias("longitude"),
        c("address").alias("full_address"),
        F.coalesce(c("street"), c("addressObj.street1")).alias("street_address"),
        F.coalesce(c("city"), c("addressObj.city")).alias("city"),
        F.coalesce(c("state"), c("addressObj.state")).alias("state"),
        F.coalesce(c("countryCode"), c("addressObj.country")).alias("country"),
        F.coalesce(c("postalCode"), c("addressObj.postalcode")).alias("postal_code"),
        c("phone"),
        c("email"),
        c("website"),
        to_int("rankingPosition").alias("ranking_position"),
        to_int("rankingDenominator").alias("ranking_denominator"),
        c("priceLevel").alias("price_level"),
        c("priceRange").alias("price_range"),
        to_int("photoCount").alias("photo_count"),
        c("amenities"),
    ]
    return _tagged(of_class(df, "tripadvisor_hotel"), columns, TRIPADVISOR, as_of, extra)


def tripadvisor_reviews(df: DataFrame, as_of=None, extra=()) -> DataFrame:
    c = F.col
    columns = [
        c("row_id").alias("source_row_id"),
        c("id").alias("review_id"),
        c("locationId").alias("tripadvisor_location_id"),
        to_double("rating").alias("rating"),
        c("title").alias("review_title"),
        c("text").alias("review_text"),
        c("lang").alias("review_language"),
        c("tripType").alias("trip_type"),
        c("user.name").alias("user_name"),
        c("user.userLocation.name").alias("user_location"),
        to_int("user.contributions.totalContributions").alias("user_total_contributions"),
        to_date("publishedDate").alias("published_date"),
        c("travelDate").alias("travel_date"),
        size_or_zero("photos").alias("photos_count"),
    ]
    return _tagged(of_class(df, "tripadvisor_review"), columns, TRIPADVISOR, as_of, extra)


def geospatial_attractions(df: DataFrame, as_of=None, extra=()) -> DataFrame:
    c = F.col
    columns = [
        c("row_id").alias("source_row_id"),
        c("placeId").alias("place_id"),
        c("title").alias("attraction_name"),
        c("categoryName").alias("category_name"),
        to_double("totalScore").alias("rating"),
        to_int("reviewsCount").alias("reviews_count"),
        to_int("imagesCount").alias("images_count"),
        F.coalesce(to_double("latitude"), to_double("location.lat")).alias("latitude"),
        F.coalesce(to_double("longitude"), to_double("location.lng")).alias("longitude"),
        c("address").alias("full_address"),
        c("neighborhood"),
        c("city"),
        c("state"),
        c("postalCode").alias("postal_code"),
        c("phone"),
        c("phoneUnformatted").alias("phone_unformatted"),
        to_bool("permanentlyClosed").alias("permanently_closed"),
        to_bool("temporarilyClosed").alias("temporarily_closed"),
        c("additionalInfo"),
        c("openingHours").alias("opening_hours"),
        c("categories"),
    ]
    return _tagged(of_class(df, "geospatial_attraction"), columns, MAPS, as_of, extra)


PROJECTIONS = {
    "booking_hotels": booking_hotels,
    "booking_reviews": booking_reviews,
    "tripadvisor_hotels": tripadvisor_hotels,
    "tripadvisor_reviews": tripadvisor_reviews,
    "geospatial_attractions": geospatial_attractions,
}


def project_columns(df: DataFrame, spec: dict[str, tuple[str, str]], platform: str | None = None) -> DataFrame:
    """Select, rename and leniently cast: `spec` maps an output name to (input expression, type)."""
    casts = {"int": to_int, "double": to_double, "boolean": to_bool, "date": to_date}

    def one(name: str, expression: str, kind: str) -> Column:
        value = F.expr(expression)
        return (casts[kind](value) if kind in casts else value.try_cast(kind)).alias(name)

    columns = [one(name, *source) for name, source in spec.items()]
    return df.select(*columns, *([F.lit(platform).alias("platform")] if platform else []))
