"""Every query by name. Each takes a star, an object with a method per table."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame

from cinelake.operators.catalog import build_catalog
from cinelake.operators.matrix import build_matrix
from cinelake.operators.recommend import wide_lists
from cinelake.operators.segmentation import segment_users
from cinelake.plans import datasets, marts, recommendations, reports
from cinelake.sources.sinks import export_datasets

Build = Callable[[Any], DataFrame]

QUERIES: dict[str, Build] = {
    "inactive_subscribers": lambda s: reports.inactive_subscribers(s.customer(), s.activity()),
    "content_profitability": lambda s: reports.content_profitability(s.content_event(), s.content()),
    "views_by_country_category": lambda s: reports.views_by_country_category(
        s.event(), s.customer(), s.geography(), s.content_category(), s.category()
    ),
    "top_customer_providers": lambda s: reports.top_customer_providers(s.event(), s.customer(), s.provider()),
    "income_by_city": lambda s: reports.income_by_city(s.payment(), s.customer(), s.geography()),
    "streaming_mart": lambda s: marts.streaming_mart(
        s.event(), s.customer(), s.geography(), s.content(), s.provider()
    ),
    "payment_mart": lambda s: marts.payment_mart(
        s.payment(), s.customer(), s.geography(), s.provider(), s.plan()
    ),
    "subscription_mart": lambda s: marts.subscription_mart(
        s.subscription(), s.customer(), s.provider(), s.plan()
    ),
    "availability_mart": lambda s: marts.availability_mart(s.availability(), s.content(), s.provider()),
}

_FINISH = {
    "inactive_subscribers": datasets.inactive_subscribers,
    "content_profitability": datasets.content_profitability,
    "views_by_country_category": datasets.views_by_country_category,
    "top_customer_providers": datasets.top_customer_providers,
    "income_by_city": datasets.income_by_city,
    "streaming_mart": datasets.mart,
    "payment_mart": datasets.mart,
    "subscription_mart": datasets.mart,
    "availability_mart": datasets.mart,
}


def dataset(name: str, star: Any) -> DataFrame:
    return _FINISH[name](QUERIES[name](star))


def _recommendations(lists: Callable) -> Build:
    def build(star: Any) -> DataFrame:
        matrix, documents = build_matrix(star.viewing()), star.catalog_documents()
        return wide_lists(lists(matrix, documents), build_catalog(documents).drop("Texto"))

    return build


MODELS: dict[str, Build] = {
    "user_segments": lambda s: segment_users(s.viewing()),
    "user_user_recommendations": _recommendations(lambda matrix, _: recommendations.user_user(matrix)),
    "item_item_recommendations": _recommendations(lambda matrix, _: recommendations.item_item(matrix)),
    "text_recommendations": _recommendations(recommendations.by_text),
    "method_comparison": lambda s: recommendations.compare(build_matrix(s.viewing()), s.catalog_documents()),
}


def generate_datasets(star: Any, out_dir: str) -> DataFrame:
    """Build and write every dataset; the report tells which ones failed."""
    jobs = {name: (lambda name=name: dataset(name, star)) for name in QUERIES}
    return export_datasets(star.spark, jobs, out_dir)
