"""URL filters by a Bloom filter cascade: exact rule membership without joins, in DataFrame expressions only.

Rules are (verdict, host, path): a rule fits its host and all subdomains if the URL's path starts with the rule's
path; the longest rule wins. Host: after the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased. Path: from
there up to ``? #`` or the end. A null URL or one without ``://`` has neither.

Method: a rule's key is host and path joined. A URL asks for the keys of its host suffixes and path prefixes, of the
label counts and path lengths that rules have. Level 0 of a cascade is a Bloom filter of the listed keys; level 1
holds those keys of the corpus's whole key universe that pass level 0 without being listed, level 2 the listed
keys that pass level 1, and so on until a level has no false positives. A key is listed if the number of levels it
passes in a row is odd. So look-ups in the corpus are exact. Allowed and blocked keys have a cascade each.

The filters are literals of the plan. Level 0 follows the rule list, the other levels also the corpus's keys; each is checked
against ``max_bits`` before it is built, and if one is larger the list is looked up by an equi-join of the keys instead.

Cases: null and malformed URLs have empty host and path and fit no rule; repeated rules count once, of two
verdicts for one key the later stands; without rules every verdict is the default; repeated rows and extra
columns pass through; an empty table gives an empty result.
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.tables import free_name, written

BITS_PER_KEY = 12
HASHES = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def asked_keys(host: Column, path: Column, labels: Sequence[int], lengths: Sequence[int]) -> Column:
    """Keys of the host's suffixes of so many labels with the path's prefixes of so many characters."""
    parts = F.split(host, r"\.", -1)
    keys = [F.when((F.size(parts) >= n) & (F.char_length(path) >= m) & (host != ""),
                   F.concat(F.array_join(F.slice(parts, -n, n), "."), F.substring(path, 1, m)))
            for n in labels for m in lengths]
    return F.array_compact(F.array(*keys)) if keys else F.array().cast("array<string>")


def _slots(key: Column, level: int, bits: int) -> list[Column]:
    h = F.xxhash64(key, F.lit(level))
    low, high = h.bitwiseAND(F.lit(0x7FFFFFFF)), F.shiftrightunsigned(h, 33)
    return [F.pmod(low + F.lit(i) * high, F.lit(bits).cast("long")) for i in range(HASHES)]


class Level:
    """One Bloom filter, built by Spark from a column ``key`` and kept as 32-bit words."""

    def __init__(self, keys: DataFrame, count: int, number: int):
        self.number, self.bits = number, max(64, -(-BITS_PER_KEY * count // 32) * 32)
        slots = keys.select(F.explode(F.array(*_slots(F.col("key"), number, self.bits))).alias("slot"))
        words = slots.groupBy(F.floor(F.col("slot") / 32).cast("long").alias("word")).agg(
            F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("slot") % 32).cast("int"))).alias("bits")).collect()
        by_word = {r.word: r.bits for r in words}
        self.words = [by_word.get(i, 0) for i in range(self.bits // 32)]

    def has(self, key: Column) -> Column:
        words = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<long>")  # folded to one literal

        def bit(slot):
            return F.call_function("shiftright", F.get(words, F.floor(slot / 32).cast("int")), (slot % 32).cast("int")).bitwiseAND(F.lit(1)) == 1
        return reduce(lambda a, b: a & b, [bit(s) for s in _slots(key, self.number, self.bits)])


class Cascade:
    """Levels that tell listed keys from all other keys of the universe."""

    def __init__(self, listed: DataFrame, universe: DataFrame, max_levels: int = 32, max_bits: int = 1 << 23):
        self.levels: list[Level] = []
        self.fits = True  # False: a level is larger than max_bits, and the cascade is of no use
        inside, outside = listed.select("key"), universe.join(listed, "key", "left_anti")
        count = inside.count()
        while count and len(self.levels) < max_levels:
            if BITS_PER_KEY * count > max_bits:
                self.fits = False
                return
            level = Level(inside, count, len(self.levels))
            self.levels.append(level)
            # the other side's keys that pass are what the next level must hold
            passed = written(outside.filter(level.has(F.col("key"))), "cascade-keys")
            inside, outside, count = passed, inside, passed.count()
        if count:
            raise RuntimeError("the cascade did not end: a Bloom filter level passes everything")

    def lists(self, key: Column) -> Column:
        out = F.lit(False)
        for i, level in reversed(list(enumerate(self.levels))):
            out = F.when(level.has(key), out if i + 1 < len(self.levels) else F.lit(i % 2 == 0)).otherwise(F.lit(i % 2 == 1))
        return out


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]], default: str = "allow",
          max_bits: int = 1 << 23) -> tuple[DataFrame, str]:
    """``pages`` with one struct column (its name is returned): host, path, rule and verdict."""
    if bad := [r for r in rules if r[0] not in ("allow", "block") or not r[1]]:
        raise ValueError(f"rules need a verdict (allow or block) and a host: {bad[:3]}")
    verdicts = {host + path: verdict for verdict, host, path in rules}
    labels = sorted({host.count(".") + 1 for _, host, _ in rules})
    lengths = sorted({len(path) for _, _, path in rules})
    keys, out = free_name(pages, "asked_keys"), free_name(pages, "url_verdict")
    url = F.col("url")
    asked = asked_keys(url_host(url), url_path(url), labels, lengths)
    spark = pages.sparkSession
    listed = spark.createDataFrame([(k, v) for k, v in sorted(verdicts.items())], "key string, verdict string")
    if BITS_PER_KEY * len(verdicts) > max_bits:
        return _by_join(pages, asked, listed, default, out)
    universe = written(pages.select(F.explode(F.array_distinct(asked)).alias("key")).distinct(), "url-keys")
    best = []
    for verdict in ("allow", "block"):
        cascade = Cascade(listed.filter(F.col("verdict") == verdict), universe, max_bits=max_bits)
        if not cascade.fits:
            return _by_join(pages, asked, listed, default, out)
        best.append(_named(F.filter(F.col(keys), cascade.lists), verdict))
    longest = F.array_max(F.concat(*best))
    judged = pages.withColumn(keys, asked).withColumn(out, longest)
    return judged.withColumn(out, _answer(F.col(out), default)).drop(keys), out


def _named(rules: Column, verdict: str) -> Column:
    return F.transform(rules, lambda k: F.struct(F.char_length(k).alias("size"), k.alias("rule"), F.lit(verdict).alias("verdict")))


def _answer(longest: Column, default: str) -> Column:
    url = F.col("url")
    return F.struct(url_host(url).alias("host"), url_path(url).alias("path"), longest["rule"].alias("rule"),
                    F.coalesce(longest["verdict"], F.lit(default)).alias("verdict"))


def _by_join(pages: DataFrame, asked: Column, listed: DataFrame, default: str, out: str) -> tuple[DataFrame, str]:
    """The same for lists too large for a literal: one row per distinct URL and key meets the list by key."""
    found = (pages.select("url").distinct().select("url", F.explode(asked).alias("key")).join(listed, "key").groupBy("url")
             .agg(F.max(F.struct(F.char_length("key").alias("size"), F.col("key").alias("rule"), "verdict")).alias(out)))
    return pages.join(found, "url", "left").withColumn(out, _answer(F.col(out), default)).select(*pages.columns, out), out


RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))

#: DuckDB: every rule tried on every URL
ORACLE = r"""
WITH parts AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
rules(verdict, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
                         ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fits AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC) AS n FROM (
  SELECT parts.*, CASE WHEN (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) THEN h || p END AS rule_text,
         h, p, rules.verdict AS rule_verdict FROM parts, rules) t WHERE rule_text IS NOT NULL)
SELECT parts.page_id, parts.host, parts.path, f.rule_text AS rule, coalesce(f.rule_verdict, 'allow') AS verdict
FROM parts LEFT JOIN fits f ON f.page_id = parts.page_id AND f.n = 1"""
