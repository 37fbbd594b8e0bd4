import json
import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from lodgewise.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    folder = pathlib.Path("/root/testdata/sf0.001")
    if not folder.exists():
        pytest.skip("no driver tables")
    return str(folder)


FACILITIES = [
    {"name": "Umum", "overview": None, "facilities": [{"name": "AC", "additionalInfo": []}]},
    {"name": "Internet", "overview": "Wi-Fi tersedia", "facilities": []},
]
CODES = ["hotel_staff", "hotel_services", "hotel_clean", "hotel_comfort", "hotel_value", "hotel_location"]
HOTEL = {
    "hotelId": 1, "type": "hotel", "name": "Hotel Melati", "stars": 3, "rating": None, "facilities": FACILITIES,
    "location": {"lat": "-7.8000", "lng": "110.3700"}, "price": "Rp 300.000",
    "address": {"full": "Jl. A", "street": "Jl. A", "country": "Indonesia", "region": "Jawa", "postalCode": "55000"},
    "timeOfScrapeISO": "2025-05-01T00:00:00.000Z",
}
REVIEW = {
    "id": "r1", "hotelId": 1, "reviewTitle": "Baik", "rating": 10, "reviewDate": "2025-03-21T17:02:11.000Z",
    "checkInDate": "2025-03-18", "checkOutDate": "2025-03-19", "numberOfNights": 1, "travelerType": "Solo traveler",
    "likedText": "Lokasi bagus", "hotelRatingScores": [{"name": c, "codeName": c, "score": 6.5} for c in CODES],
}
OTHER_HOTEL = {
    "id": "90", "name": "Melati Hotel", "category": "hotel", "amenities": ["AC", "Wi-Fi Gratis", "Kolam Renang"],
    "latitude": -7.8003, "longitude": 110.3701, "rating": 4.0, "hotelClass": "3.0", "rankingDenominator": "410",
    "priceRange": "Rp 240.000 - Rp 460.000", "address": "Jl. B", "photos": ["x"],
}
OTHER_REVIEW = {
    "id": "t1", "locationId": "90", "text": "bagus", "publishedDate": "2025-05-23", "travelDate": "2025-02", "rating": 5,
    "photos": [], "user": {"name": "N", "userLocation": None}, "tripType": "FAMILY",
}
PLACE = {
    "placeId": "p1", "title": "Kopi", "categoryName": "Coffee shop", "location": {"lat": -7.8010, "lng": 110.3870},
    "totalScore": 4.1, "reviewsCount": 230, "address": "Gg. X",
    "additionalInfo": {"Accessibility": [{"Wheelchair accessible seating": False}], "Parking": [{"Free parking lot": True}, None]},
    "openingHours": [{"day": "Monday", "hours": "9 AM to 5 PM"}],
}


def without(record, *fields):
    return {k: v for k, v in record.items() if k not in fields}


# (record, class by the strict rules, class by the corrected rules)
CASES = [
    (HOTEL, "booking_hotel", "booking_hotel"),
    (REVIEW, "booking_review", "booking_review"),
    ({**REVIEW, "id": "r2", "reviewTitle": None}, "unknown", "booking_review"),
    (OTHER_HOTEL, "unknown", "tripadvisor_hotel"),
    ({**without(OTHER_HOTEL, "id"), "locationId": "91", "latitude": 1.0}, "tripadvisor_hotel", "tripadvisor_hotel"),
    (OTHER_REVIEW, "tripadvisor_review", "tripadvisor_review"),
    (PLACE, "geospatial_attraction", "geospatial_attraction"),
    ({**without(PLACE, "additionalInfo"), "placeId": "p2"}, "unknown", "geospatial_attraction"),
    ({"error": "no_reviews_found", "reviewsCategoryData": {"hotelId": 5501}}, "unknown", "scrape_error"),
    ({**HOTEL, "hotelId": 2, "location": None}, "booking_hotel", "booking_hotel"),
    ({"placeId": "p3", "location": {"lat": -6.2, "lng": 106.8}}, "unknown", "unknown"),
    ({**HOTEL, "timeOfScrapeISO": "2025-05-09T00:00:00.000Z", "stars": 4}, "booking_hotel", "booking_hotel"),
]


@pytest.fixture(scope="session")
def feed_dir(tmp_path_factory):
    folder = tmp_path_factory.mktemp("feed")
    (folder / "mixed - full.json").write_text(json.dumps([c[0] for c in CASES], indent=1))
    (folder / "empty.json").write_text("[]")
    (folder / "junk.tmp").write_text("not json")
    (folder / "run.log").write_text("not json")
    return str(folder)


@pytest.fixture(scope="session")
def raw(spark, feed_dir):
    from lodgewise.sources.feeds import read_feed

    return read_feed(spark, feed_dir)


@pytest.fixture(scope="session")
def classified(raw):
    from lodgewise.operators.classify import classify

    return classify(raw)
