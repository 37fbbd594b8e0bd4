"""Record schemas: the raw feed struct and the output contracts."""

import functools

from pyspark.sql import types as T

# Field names and types of the scraped feeds, one superset struct for all of them.
RAW_DDL = """
hotelId bigint, name string, type string, description string, stars int, price string, currency string,
rating double, reviews int, breakfast string, checkIn string, checkOut string,
location struct<lat:string,lng:string>,
address string,
facilities array<struct<name:string,overview:string,facilities:array<struct<name:string,additionalInfo:array<string>>>>>,
url string, timeOfScrapeISO string,
id string, likedText string, dislikedText string, reviewTitle string, travelerType string, userLocation string, userName string,
checkInDate string, checkOutDate string, reviewDate string, roomInfo string, numberOfNights int, reviewLanguage string,
stayRoomId bigint, helpfulVotes int, totalCategoryReviews int,
hotelRatingScores array<struct<name:string,codeName:string,score:double>>,
error string, errorDescription string, input string, reviewsCategoryData struct<hotelId:bigint,totalCategoryReviews:int>,
locationId string, category string, subcategories array<string>, locationString string, photoCount int, rankingPosition int,
rankingDenominator string, numberOfReviews int, hotelClass string, amenities array<string>, priceLevel string, priceRange string,
phone string, email string, website string, latitude double, longitude double, numberOfRooms int, localName string,
addressObj struct<street1:string,street2:string,city:string,state:string,country:string,postalcode:string>,
title string, text string, lang string, tripType string, publishedDate string, travelDate string, photos array<string>,
user struct<userId:string,name:string,contributions:struct<totalContributions:int,helpfulVotes:int>,
            userLocation:struct<shortName:string,name:string,id:string>>,
placeInfo struct<id:string,name:string,rating:double,numberOfReviews:int,latitude:double,longitude:double>,
placeId string, categoryName string, categories array<string>, totalScore double, reviewsCount int, imagesCount int,
neighborhood string, street string, city string, state string, postalCode string, countryCode string, phoneUnformatted string,
permanentlyClosed boolean, temporarilyClosed boolean, openingHours array<struct<day:string,hours:string>>,
additionalInfo map<string,array<map<string,boolean>>>, scrapedAt string, searchString string
"""

CORRUPT = "_corrupt_record"


@functools.cache
def _raw_fields() -> tuple[T.StructField, ...]:
    return tuple(T.StructType.fromDDL(RAW_DDL).fields)


def raw_schema(keep_corrupt: bool = True) -> T.StructType:
    corrupt = [T.StructField(CORRUPT, T.StringType())] if keep_corrupt else []
    return T.StructType([*_raw_fields(), *corrupt])


# The required fields of each source.
REQUIRED = {
    "booking_hotel": ["name", "type", "stars", "location", "address", "facilities", "hotelId"],
    "booking_review": ["rating", "reviewTitle", "travelerType", "hotelRatingScores", "hotelId"],
    "tripadvisor_hotel": ["name", "type", "category", "rating", "latitude", "longitude", "amenities"],
    "tripadvisor_review": ["rating", "text", "title", "locationId", "publishedDate"],
    "geospatial_attraction": ["title", "categoryName", "location", "totalScore", "reviewsCount"],
}

# The JSON text found in the `address` field of one platform's hotels.
ADDRESS_DDL = "full string, postalCode string, street string, country string, region string"

# The documented model table, (column, type) in documented order.
FEATURE_COLUMNS = [
    ("price_idr", "double"), ("log_price", "double"),
    ("hotel_id", "string"), ("hotel_name_clean", "string"), ("platform_source", "string"),
    ("latitude", "double"), ("longitude", "double"),
    ("distance_to_city_center", "double"), ("distance_to_malioboro", "double"), ("distance_to_airport", "double"),
    ("distance_to_nearest_attraction", "double"),
    ("attraction_density_1km", "int"), ("attraction_density_2km", "int"), ("attraction_density_5km", "int"),
    ("restaurant_density_1km", "int"),
    ("accommodation_type", "string"), ("stars", "double"), ("hotel_class", "int"),
    ("has_wifi", "boolean"), ("has_breakfast", "boolean"), ("has_parking", "boolean"), ("has_ac", "boolean"),
    ("has_pool", "boolean"), ("has_gym", "boolean"), ("has_spa", "boolean"), ("has_restaurant", "boolean"),
    ("has_room_service", "boolean"), ("has_24h_reception", "boolean"), ("facilities_score", "double"),
    ("overall_rating", "double"), ("rating_staff", "double"), ("rating_cleanliness", "double"),
    ("rating_facilities", "double"), ("rating_location", "double"), ("rating_comfort", "double"),
    ("rating_value_for_money", "double"), ("total_reviews", "int"), ("recent_reviews", "int"),
    ("review_sentiment_score", "double"), ("review_consistency", "double"),
    ("competitors_within_500m", "int"), ("price_rank_in_area", "double"), ("rating_rank_in_area", "double"),
    ("is_weekend", "boolean"), ("month", "int"), ("quarter", "int"), ("is_peak_season", "boolean"),
    ("days_to_holiday", "int"),
    ("market_segment", "string"), ("target_traveler_type", "string"), ("booking_platform_count", "int"),
    ("price_per_facility", "double"), ("popularity_score", "double"), ("accessibility_score", "double"),
    ("experience_score", "double"), ("value_score", "double"),
    ("price_variance_platforms", "double"), ("platform_preference_score", "double"),
    ("cross_platform_availability", "boolean"),
    ("data_collection_date", "timestamp"), ("data_freshness_score", "double"),
    ("data_completeness_score", "double"), ("last_updated", "timestamp"),
]
