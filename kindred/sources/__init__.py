from kindred.sources.files import personal_ratings, read_personal, read_ratings
from kindred.sources.sales import item_titles, personal_from_parts, ratings_from_sales, train_test
from kindred.sources.sinks import write_json
from kindred.sources.staging import stage
from kindred.sources.checks import expect_count

__all__ = [
    "expect_count", "item_titles", "personal_from_parts", "personal_ratings", "ratings_from_sales",
    "read_personal", "read_ratings", "stage", "train_test", "write_json",
]
