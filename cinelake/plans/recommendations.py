"""The three recommenders from events to lists, and their comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cinelake.operators import recommend, tfidf
from cinelake.operators.catalog import align_catalog, build_catalog
from cinelake.operators.matrix import Matrix
from cinelake.operators.metrics import compare_methods, list_metrics
from cinelake.operators.similarity import item_pairs, text_pairs
from cinelake.session import materialize

# Names of the methods in the comparison.
USER_USER = "Usuario-Usuario"
ITEM_ITEM = "Item-Item"
TEXT = "Contenido-Tokenizacion"


def user_user(matrix: Matrix) -> DataFrame:
    neighbours = recommend.positive_users(matrix)
    return recommend.top_lists(recommend.score_by_users(matrix, neighbours), matrix)


def item_item(matrix: Matrix) -> DataFrame:
    return recommend.top_lists(recommend.score_by_items(matrix, item_pairs(matrix)), matrix)


def aligned_texts(matrix: Matrix, documents: DataFrame) -> DataFrame:
    return align_catalog(matrix.cells, build_catalog(documents))


def text_weights(texts: DataFrame, key: str, text: str, rows: int) -> tuple[DataFrame, int]:
    """TF-IDF weights of all texts, and an upper bound of their number.

    The words feed both the choice of terms and their counts, and these both the vocabulary
    and the weights, so they are stored.
    """
    counts = tfidf.frequent_term_counts(materialize(tfidf.tokens_of(texts, key, text), "tokens"))
    return tfidf.weights(counts, tfidf.vocabulary(counts), rows), counts.count()


def text_similarity(matrix: Matrix, texts: DataFrame) -> DataFrame:
    weighted, size = text_weights(texts, "Content_Key", "Texto", matrix.items)
    return text_pairs(weighted, matrix.items, size)


def by_text(matrix: Matrix, documents: DataFrame) -> DataFrame:
    pairs = text_similarity(matrix, aligned_texts(matrix, documents))
    return recommend.top_lists(recommend.score_by_items(matrix, pairs), matrix)


def compare(matrix: Matrix, documents: DataFrame) -> DataFrame:
    lists = {
        USER_USER: user_user(matrix),
        ITEM_ITEM: item_item(matrix),
        TEXT: by_text(matrix, documents),
    }
    return compare_methods({name: list_metrics(df, matrix) for name, df in lists.items()})
