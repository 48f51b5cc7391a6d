"""Composed operators: append-mode ingestion (U02) and train/evaluate."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators import cleaning as C
from shelfwise.operators import dedup as D
from shelfwise.operators import joins as J


def append_ingest(existing_books: DataFrame, existing_ratings: DataFrame, incoming_books: DataFrame,
                  incoming_ratings: DataFrame, key: str = "book_id", id_cols=("book_id",),
                  language: str = "eng") -> tuple[DataFrame, DataFrame]:
    """P17 re-key incoming -> U01 union (existing first) -> D01 first per (title, authors)
    -> P11 language -> J02 ratings of kept books -> D02 last per (user, book)."""
    inc_books = C.rekey(incoming_books, existing_books, list(id_cols), key)
    inc_ratings = C.rekey(incoming_ratings, existing_books, [key], key)
    books = D.append_union(existing_books, inc_books, key)
    books = D.keep_first(books, ["title", "authors"], ["_seq"])
    books = C.overwrite_constant(books.drop("_seq"), "language_code", language)
    ratings = D.append_union(existing_ratings, inc_ratings, "_pos")
    ratings = J.referential_filter(ratings, books, key)
    ratings = D.keep_last(ratings, ["user_id", key], ["_seq"], ["rating"])
    return books, ratings
