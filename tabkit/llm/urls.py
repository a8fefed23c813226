"""URL filter: a blocked Bloom filter of the listed URLs in front of an exact hash join. DataFrame functions only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.llm.rows import packed, unpacked
from tabkit.session import settle, sized_join, sized_like

BITS_PER_KEY = 16
WORDS = 4  # a block is 4 x 64 bits; a key sets two bits in each word


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #``, A-Z lower-cased; empty for null or where there is no ``://``."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 1)
    return F.coalesce(F.translate(found, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; empty for null or where there is no ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 2), F.lit(""))


def _place(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).alias("_block")


def _masks(key: Column) -> list[Column]:
    """Two bits in each word of the block, from a second hash of the key."""
    bits = F.xxhash64(F.lit("bits"), key)
    one = [F.expr("1L")] * (2 * WORDS)
    at = [F.shiftrightunsigned(bits, 7 * i).bitwiseAND(63).cast("int") for i in range(2 * WORDS)]
    put = [F.call_function("shiftleft", o, a) for o, a in zip(one, at)]
    return [put[2 * w].bitwiseOR(put[2 * w + 1]) for w in range(WORDS)]


def blocked_bloom(keys: DataFrame, key: str, rows: int) -> tuple[DataFrame, int]:
    """The filter as one row per non-empty block, and its number of blocks, which follows the number of keys."""
    blocks = 1
    while blocks * 64 * WORDS < rows * BITS_PER_KEY:
        blocks *= 2
    masked = keys.select(_place(F.col(key), blocks), *[m.alias(f"_w{i}") for i, m in enumerate(_masks(F.col(key)))])
    return masked.groupBy("_block").agg(*[F.bit_or(f"_w{i}").alias(f"_w{i}") for i in range(WORDS)]), blocks


def possible_hits(keys: DataFrame, key: str, bloom: DataFrame, blocks: int) -> DataFrame:
    """The rows whose key the filter may hold: no listed key is lost, a few others stay."""
    masks = _masks(F.col(key))
    probed = sized_join(keys.withColumn("_block", _place(F.col(key), blocks)), bloom, "_block", "inner")
    for i, m in enumerate(masks):
        probed = probed.filter(F.col(f"_w{i}").bitwiseAND(m) == m)
    return probed.drop("_block", *[f"_w{i}" for i in range(WORDS)])


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host, path, rule, verdict`` by the longest listed URL that covers each page's.

    ``rules`` lists canonical URLs as ``host, path, verdict``: an entry covers its host, all subdomains, and the paths
    that start with its path. Every URL is looked up under all its parent domains and all path lengths that the list
    holds: first in the filter, then, for the possible hits, in the list itself. The longest rule (``host || path``)
    wins; of two equally long ones that with the longer host. An entry given twice with unlike verdicts blocks.

    Null URLs and such without ``://`` have empty host and path and match nothing. Nulls in ``rules.host`` or ``path`` count
    as empty text, entries with an empty host are ignored, and an empty list gives every page ``default``. Repeated
    pages give repeated rows. Columns of ``pages`` named like a result are replaced. The work is done per distinct
    host and path, so that a common host or address is one row before it meets the list.
    """
    listed = (
        rules.select(F.coalesce("host", F.lit("")).alias("_host"), F.coalesce("path", F.lit("")).alias("_path"), F.col("verdict").alias("_verdict"))
        .filter("_host <> ''")
        .groupBy("_host", "_path").agg(F.max("_verdict").alias("_verdict"))
        .withColumn("_key", F.concat("_host", "_path"))
    )
    listed = settle(listed)
    sizes = listed.agg(F.count(F.lit(1)).alias("n"), F.collect_set(F.length("_path")).alias("lengths")).first()
    own = F.col("doc")[url]
    asked = packed(pages).select("doc", host_of(own).alias("host"), path_of(own).alias("path"))
    if not sizes["n"]:
        return unpacked(asked, pages.columns, {"host": "host", "path": "path", "rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    bloom, blocks = blocked_bloom(listed, "_key", sizes["n"])
    bloom = settle(bloom)
    labels = F.split(F.col("host"), r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    lengths = F.array(*[F.lit(n) for n in sorted(sizes["lengths"])])
    keys = (
        asked.filter("host <> ''").select("host", "path").distinct()
        .select("host", "path", F.explode(parents).alias("_parent"))
        .select("host", "path", "_parent", F.explode(F.filter(lengths, lambda n: n <= F.length("path"))).alias("_n"))
        .select("host", "path", F.concat("_parent", F.expr("left(path, _n)")).alias("_key"))
    )
    hits = possible_hits(keys, "_key", bloom, blocks)
    found = sized_join(hits, sized_like(listed.select("_key", "_host", "_verdict"), listed), "_key", "inner")
    best = found.groupBy(F.col("host").alias("_h"), F.col("path").alias("_p")).agg(
        F.max(F.struct(F.length("_key"), F.length("_host"), "_key", "_verdict")).alias("_best")
    )
    joined = asked.join(best, (F.col("host") == F.col("_h")) & (F.col("path") == F.col("_p")), "left")
    verdict = F.coalesce("_best._verdict", F.lit(default))
    return unpacked(joined, pages.columns, {"host": "host", "path": "path", "rule": "_best._key", "verdict": verdict})
