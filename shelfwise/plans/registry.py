"""Registry of named queries over the driver tables and their DuckDB SQL twins."""
from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with an optional oracle SQL."""
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---- shared SQL building blocks (DuckDB dialect) -------------------------------------------
IR_SQL = """ir AS (
  SELECT o.o_custkey AS user_id, l.l_partkey AS book_id,
         CAST(floor((l.l_quantity - 1) / 10) + 1 AS INTEGER) AS rating,
         l.l_orderkey, l.l_linenumber, l.l_quantity, l.l_extendedprice
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

INTER_SQL = IR_SQL + """,
interactions AS (
  SELECT user_id, book_id, rating FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, book_id
      ORDER BY l_orderkey DESC, l_linenumber DESC, l_quantity DESC, l_extendedprice DESC) AS rn
    FROM ir) t WHERE rn = 1)"""

BOOKS_SQL = """books AS (
  SELECT p_partkey AS book_id, p_name AS title, p_brand AS authors, p_type AS category,
         p_size AS size, p_retailprice AS price FROM part)"""


def cosine_sql(src: str, row: str, col: str, left: str, right: str, name: str = "sims") -> str:
    """All co-occurring pairs with cosine, both directions (brute-force self-join: oracle only)."""
    return f"""{name}_pairs AS (
  SELECT a.{col} AS {left}, b.{col} AS {right}, CAST(SUM(a.rating * b.rating) AS BIGINT) AS dot
  FROM {src} a JOIN {src} b ON a.{row} = b.{row} AND a.{col} <> b.{col}
  GROUP BY 1, 2),
{name}_norms AS (SELECT {col}, CAST(SUM(rating * rating) AS BIGINT) AS n2 FROM {src} GROUP BY 1),
{name} AS (
  SELECT p.{left}, p.{right}, p.dot, p.dot / (sqrt(na.n2) * sqrt(nb.n2)) AS sim,
         CAST(floor(p.dot / (sqrt(na.n2) * sqrt(nb.n2)) * 1000000000) AS BIGINT) AS nano
  FROM {name}_pairs p JOIN {name}_norms na ON p.{left} = na.{col} JOIN {name}_norms nb ON p.{right} = nb.{col})"""


def topk_sql(src: str, part: str, order: str, k: int, name: str) -> str:
    return f"""{name} AS (
  SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY {part} ORDER BY {order}) AS INTEGER) AS rank
                 FROM {src}) t WHERE rank <= {k})"""

DIRTY_BOOKS_SQL = """dirty_books AS (
  SELECT
    CASE WHEN p_partkey % 23 = 0 THEN 'x1' WHEN p_partkey % 29 = 0 THEN NULL ELSE CAST(p_partkey AS VARCHAR) END AS book_id,
    CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 31 = 0 THEN 'Unknown Title' ELSE p_name END AS title,
    CASE WHEN p_partkey % 13 = 0 THEN NULL WHEN p_partkey % 31 = 0 THEN 'Unknown' ELSE p_brand END AS authors,
    CASE WHEN p_partkey % 11 = 0 THEN 'n/a' WHEN p_partkey % 7 = 0 THEN NULL ELSE CAST(p_retailprice AS VARCHAR) END AS average_rating,
    CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE CAST(p_size AS VARCHAR) END AS ratings_count,
    CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE '978' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') END AS isbn,
    CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE 'eng' END AS language_code,
    CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE p_name END AS original_title,
    CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE 'http://img/' || CAST(p_partkey AS VARCHAR) END AS image_url
  FROM part)"""

DIRTY_RATINGS_SQL = """dirty_ratings AS (
  SELECT
    CASE WHEN (l.l_orderkey * 8 + l.l_linenumber) % 41 = 0 THEN 'abc' ELSE CAST(l.l_partkey AS VARCHAR) END AS book_id,
    CASE WHEN (l.l_orderkey * 8 + l.l_linenumber) % 37 = 0 THEN NULL ELSE CAST(o.o_custkey AS VARCHAR) END AS user_id,
    CASE WHEN (l.l_orderkey * 8 + l.l_linenumber) % 19 = 0 THEN '9'
         WHEN (l.l_orderkey * 8 + l.l_linenumber) % 43 = 0 THEN '0'
         WHEN (l.l_orderkey * 8 + l.l_linenumber) % 47 = 0 THEN ' 4 '
         ELSE CAST(CAST(floor((l.l_quantity - 1) / 10) + 1 AS INTEGER) AS VARCHAR) END AS rating
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


def td(x: str) -> str:
    """SQL twin of ``try_double``."""
    return f"TRY_CAST(trim({x}) AS DOUBLE)"

REQUESTS_SQL = """requests AS (
  SELECT c_custkey AS request_id, CASE WHEN c_custkey % 2 = 0 THEN 'user' ELSE 'book' END AS kind,
    CASE WHEN c_custkey % 11 = 0 THEN 'abc' WHEN c_custkey % 13 = 0 THEN '-1' WHEN c_custkey % 17 = 0 THEN '99999'
         WHEN c_custkey % 19 = 0 THEN '0' ELSE CAST(c_custkey % 600 AS VARCHAR) END AS id_text,
    CASE WHEN c_custkey % 7 = 0 THEN '100' WHEN c_custkey % 9 = 0 THEN '0' WHEN c_custkey % 8 = 0 THEN '-1'
         WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_custkey % 20 + 1 AS VARCHAR) END AS num_text,
    CASE WHEN c_custkey % 10 = 3 THEN '3' WHEN c_custkey % 23 = 0 THEN 'x' ELSE NULL END AS n_text
  FROM customer)"""

VALID_SQL = REQUESTS_SQL + """,
valid AS (
  SELECT request_id, kind, TRY_CAST(trim(id_text) AS BIGINT) AS target_id,
    CAST(coalesce(TRY_CAST(trim(n_text) AS BIGINT), TRY_CAST(trim(num_text) AS BIGINT), 5) AS INTEGER) AS count,
    CAST(CASE
      WHEN id_text IS NULL OR TRY_CAST(trim(id_text) AS BIGINT) IS NULL
        OR (num_text IS NOT NULL AND TRY_CAST(trim(num_text) AS BIGINT) IS NULL)
        OR (n_text IS NOT NULL AND TRY_CAST(trim(n_text) AS BIGINT) IS NULL)
        OR TRY_CAST(trim(num_text) AS BIGINT) NOT BETWEEN 1 AND 20
        OR TRY_CAST(trim(n_text) AS BIGINT) NOT BETWEEN 1 AND 20 THEN 422
      WHEN kind = 'user' AND TRY_CAST(trim(id_text) AS BIGINT) NOT BETWEEN 1 AND 500 THEN 404
      WHEN kind = 'book' AND TRY_CAST(trim(id_text) AS BIGINT) NOT BETWEEN 1 AND 10000 THEN 404
      ELSE 200 END AS INTEGER) AS status
  FROM requests)"""

SPLIT_SQL = INTER_SQL + """,
sp AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY md5(concat_ws('|', '42', CAST(user_id AS VARCHAR),
         CAST(book_id AS VARCHAR))), user_id, book_id) - 1 < (SELECT COUNT(*) FROM interactions) * 4 // 5
         THEN 'train' ELSE 'test' END AS split FROM interactions),
train AS (SELECT user_id, book_id, rating FROM sp WHERE split = 'train'),
test AS (SELECT user_id, book_id, rating FROM sp WHERE split = 'test')"""


def recs_sql(src: str, k: int, n: int, name: str, users: str | None = None, sims: str = "sims") -> str:
    """Top-n item-item recommendations from ``src`` with k scoring neighbours (oracle only)."""
    flt = f"AND i.user_id IN (SELECT user_id FROM {users})" if users else ""
    return f"""{cosine_sql(src, 'user_id', 'book_id', 'book_id', 'other_id', sims)},
{topk_sql(sims, 'book_id', 'nano DESC, other_id', k, name + '_nb')},
{name}_cand AS (
  SELECT i.user_id, n.other_id AS book_id, CAST(SUM(n.nano * i.rating) AS BIGINT) AS score_nano
  FROM {src} i JOIN {name}_nb n ON i.book_id = n.book_id
  WHERE NOT EXISTS (SELECT 1 FROM {src} r WHERE r.user_id = i.user_id AND r.book_id = n.other_id) {flt}
  GROUP BY 1, 2),
{topk_sql(name + '_cand', 'user_id', 'score_nano DESC, book_id', n, name)}"""
