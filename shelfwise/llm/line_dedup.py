"""Line dedup: lines that spread over many sites are boilerplate and leave the texts.

Method: every non-blank line (trimmed, split at line feeds) is keyed by its hash and site. One HyperLogLog sketch of the sites
per line hash is merged by aggregation. A line whose estimate is clear of ``min_sites`` by more than ``band`` is
decided by the sketch; lines nearer to it get an exact distinct count. Boilerplate lines are then removed from all
texts. Only a text whose non-blank lines are all boilerplate stays whole: it may be a copy, and copies are for near-duplicate
operators. With a number for ``max_share`` every text that would lose more than that share of its non-blank lines stays whole.

Cases: null text stays null, blank lines always stay; a null site is no site; repeated rows count once, since
sites are counted; equal texts are treated alike; an empty table gives an empty result; extra columns pass through.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.tables import free_name

SALTS = 16  # parts of a frequent line
WHITE = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    return F.unhex(F.md5(F.btrim(line, F.lit(WHITE))))


def _filled(line: Column) -> Column:
    return F.btrim(line, F.lit(WHITE)) != ""


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _keys(text: Column) -> Column:
    return F.transform(F.filter(_lines(text), _filled), line_key)


def _salted(lines: DataFrame, by: str, chosen: DataFrame, how: str) -> DataFrame:
    """``lines`` joined to the few ``chosen`` lines; a line that stands in very many texts is split by ``by``."""
    few = chosen.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return lines.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")).join(few, ["line", "salt"], how).drop("salt")


def boilerplate(docs: DataFrame, site: str = "source", min_sites: int = 8, band: float = 0.25, lg_k: int = 10) -> DataFrame:
    """(line, sites): hashes of the lines on at least ``min_sites`` distinct sites."""
    lines = docs.select(F.explode(F.array_distinct(_keys(F.col("text")))).alias("line"), F.col(site).cast("string").alias("site"),
                        F.xxhash64("text").alias("of"))
    spread = lines.groupBy("line").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", lg_k)).alias("estimate"))
    spread = spread.filter(F.col("estimate") >= (1 - band) * min_sites)
    clear = F.col("estimate") > (1 + band) * min_sites
    sure = spread.filter(clear).select("line", F.col("estimate").alias("sites"))
    near = _salted(lines, "of", spread.filter(~clear).select("line"), "left_semi")
    exact = near.groupBy("line").agg(F.count_distinct("site").alias("sites")).filter(F.col("sites") >= min_sites)
    return sure.unionByName(exact)


def remove_boilerplate(docs: DataFrame, site: str = "source", min_sites: int = 8, band: float = 0.25,
                       max_share: float | None = None) -> tuple[DataFrame, str]:
    """``docs`` with the shortened text and one struct column (its name is returned): n_lines and n_removed."""
    key, gone, out = (free_name(docs, n) for n in ("text_key", "gone_lines", "line_dedup"))
    text = F.col("text")
    marked = docs.select(F.md5(text).alias("t"), _keys(text).alias("lines")).select("t", F.explode("lines").alias("line"))
    bad = boilerplate(docs, site, min_sites, band).select("line")
    # one row per text: its boilerplate hashes; equal texts meet in map-side combined sets
    losses = (_salted(marked, "t", bad, "inner").groupBy("t").agg(F.collect_set("line").alias("gone"))
              .select(F.col("t").alias(key), F.col("gone").alias(gone)))
    joined = docs.withColumn(key, F.md5(text)).join(losses, key, "left")
    lost = lambda line: F.coalesce(F.array_contains(F.col(gone), line_key(line)), F.lit(False)) & _filled(line)
    n_lines = F.coalesce(F.size(F.filter(_lines(text), _filled)), F.lit(0))
    n_gone = F.when(F.col(gone).isNull(), F.lit(0)).otherwise(F.size(F.filter(_lines(text), lost)))
    counted = joined.withColumn(out, F.struct(n_lines.cast("long").alias("n_lines"), n_gone.cast("long").alias("n_cross_site")))
    few = F.col(out)["n_cross_site"] < F.col(out)["n_lines"] if max_share is None else F.col(out)["n_cross_site"] <= max_share * F.col(out)["n_lines"]
    cut = (F.col(out)["n_cross_site"] > 0) & few
    short = F.when(cut, F.array_join(F.filter(_lines(text), lambda x: ~lost(x)), "\n")).otherwise(text)
    done = counted.withColumn("text", short).withColumn(out, F.struct(
        F.col(out)["n_lines"].alias("n_lines"), F.col(out)["n_cross_site"].alias("n_cross_site"),
        F.when(cut, F.col(out)["n_cross_site"]).otherwise(F.lit(0)).cast("long").alias("n_removed")))
    return done.select(*docs.columns, out), out


def deduplicated(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` with its own columns, boilerplate lines gone from the texts."""
    return remove_boilerplate(docs, **parameters)[0].select(*docs.columns)


#: DuckDB: the same with exact distinct counts for every line
ORACLE = r"""
WITH split AS (
  SELECT doc_id, text, source, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents WHERE text IS NOT NULL),
filled AS (SELECT *, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS core FROM split),
bad AS (SELECT core FROM filled WHERE core <> '' GROUP BY core HAVING count(DISTINCT source) >= 8),
marked AS (SELECT f.*, f.core <> '' AS worded, b.core IS NOT NULL AS cross_site
           FROM filled f LEFT JOIN bad b ON f.core = b.core AND f.core <> ''),
per AS (SELECT doc_id, text, count(*) FILTER (worded) AS n_lines, count(*) FILTER (cross_site) AS n_cross_site,
               string_agg(line, chr(10) ORDER BY pos) FILTER (NOT cross_site) AS short
        FROM marked GROUP BY doc_id, text)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_cross_site, 0) AS BIGINT) AS n_cross_site,
       CAST(CASE WHEN n_cross_site < n_lines THEN n_cross_site ELSE 0 END AS BIGINT) AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL WHEN n_cross_site > 0 AND n_cross_site < n_lines
            THEN md5(coalesce(short, '')) ELSE md5(d.text) END AS kept_md5
FROM documents d LEFT JOIN per p ON d.doc_id = p.doc_id AND d.text = p.text"""
