"""URL rules by Bloom filter cascades, in DataFrame functions only.

The keys a URL can match (every parent domain of its host with every path prefix of a rule's
length) make up the corpus's complete key universe. A cascade's first filter encodes the listed
keys, the second the universe's false positives of the first, the third the listed keys that pass
the second, and so on until a level has no false positive left. For keys of that universe a cascade
is then exact, and rows are judged without a join. A filter's size follows the list's, not the
corpus's: the first level's error rate is chosen so that about as many keys pass it by mistake as
are listed.
"""

from __future__ import annotations

import math
import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.session import settle

#: Bytes of filters that every task holds. A longer list is refused, never cut.
FILTER_BYTES = 256 << 20


def with_host_path(df: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host`` and ``path``; both are empty for a null URL and one without ``://``."""
    at = F.locate("://", F.col(url))
    rest = F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(F.col("_rest"), r"^[^/?#]*", 0)
    tail = F.substring(F.col("_rest"), F.length("host") + 1, F.length("_rest"))
    return (
        df.withColumn("_rest", F.coalesce(rest, F.lit("")))
        .withColumn("host", host)
        .withColumn("path", F.regexp_extract(tail, r"^[^?#]*", 0))
        .withColumn("host", F.translate("host", string.ascii_uppercase, string.ascii_lowercase))
        .drop("_rest")
    )


def rule_keys(host: Column, path: Column, lengths: Sequence[int]) -> Column:
    """Every key a URL can match: parent domains with the path prefixes of the given lengths."""
    labels = F.split(host, r"\.", -1)
    parents = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    fits = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(path))
    prefixes = F.transform(fits, lambda n: F.substring(path, F.lit(1), n))
    keys = F.transform(parents, lambda p: F.transform(prefixes, lambda q: F.concat(p, q)))
    return F.when(host != "", F.flatten(keys)).otherwise(F.array().cast("array<string>"))


class Level:
    """One Bloom filter: a settled one-row table of its words."""

    def __init__(self, keys: DataFrame, count: int, rate: float, number: int):
        bits = max(64, math.ceil(count * math.log(1 / rate) / math.log(2) ** 2))
        self.words = -(-bits // 64)
        if self.words * 8 > FILTER_BYTES:
            raise ValueError(f"a filter of {count} keys takes {self.words * 8} bytes")
        self.hashes = max(1, min(30, round(self.words * 64 / count * math.log(2))))
        self.number = number
        spark = keys.sparkSession
        place = F.explode(F.array(*self._places(F.col("key")))).alias("place")
        mine = keys.select(place).select(
            F.shiftright("place", 6).alias("word"),
            F.expr("shiftleft(1L, cast(place & 63 as int))").alias("bits"),
        )
        none = spark.range(self.words).select(F.col("id").alias("word"), F.lit(0).alias("bits"))
        words = mine.unionByName(none).groupBy("word").agg(F.bit_or("bits").alias("bits"))
        row = words.agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("all"))
        self.table = settle(row.select(F.col("all.bits").alias("bits")), "bloom")

    def _places(self, key: Column) -> list[Column]:
        """Double hashing: as many places as the filter has hashes."""
        one = F.xxhash64(key, F.lit(2 * self.number))
        two = F.xxhash64(key, F.lit(2 * self.number + 1))
        size = F.lit(self.words * 64).cast("bigint")
        return [F.pmod(F.pmod(one, size) + F.pmod(two, size) * i, size) for i in range(self.hashes)]

    def has(self, key: Column, bits: Column) -> Column:
        tests = [
            F.get(bits, F.shiftright(place, 6).cast("int")).bitwiseAND(
                F.call_function(
                    "shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(F.lit(63)).cast("int")
                )
            )
            != 0
            for place in self._places(key)
        ]
        found = tests[0]
        for test in tests[1:]:
            found = found & test
        return found


class Cascade:
    """Exact membership in ``listed`` for the keys of ``universe``, both of one column ``key``."""

    def __init__(self, listed: DataFrame, universe: DataFrame, universe_count: int, name: str):
        self.name, self.levels = name, []
        listed = settle(listed.select("key").distinct(), "listed")
        count = listed.count()
        if not count:
            return
        rate = min(0.5, count * math.sqrt(0.5) / max(universe_count, 1))
        self.levels.append(Level(listed, count, rate, 0))
        passed = self._passing(universe)
        wrong = (
            passed.withColumn("_listed", F.lit(0))
            .unionByName(listed.withColumn("_listed", F.lit(1)))
            .groupBy("key")
            .agg(F.max("_listed").alias("_listed"))
            .where("_listed = 0")
            .select("key")
        )
        inside, outside = listed, settle(wrong, "wrong")
        while (count := outside.count()) > 0:
            self.levels.append(Level(outside, count, 0.5, len(self.levels)))
            last = self.levels[-1]
            passing = inside.select("key", last.table.scalar().alias("_bits"))
            inside, outside = (
                outside,
                settle(passing.where(last.has(F.col("key"), F.col("_bits"))).select("key"), "next"),
            )

    def _passing(self, keys: DataFrame) -> DataFrame:
        with_bits = self.with_filters(keys.select("key"))
        return with_bits.where(self.levels[0].has(F.col("key"), F.col(self._column(0)))).select(
            "key"
        )

    def _column(self, level: int) -> str:
        return f"_{self.name}_{level}"

    def with_filters(self, df: DataFrame) -> DataFrame:
        """Each level's words as a column: one value that every task holds once."""
        own = [x.table.scalar().alias(self._column(i)) for i, x in enumerate(self.levels)]
        return df.select("*", *own)

    def contains(self, key: Column) -> Column:
        """On a frame ``with_filters``: whether the key is listed."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            here = self.levels[i].has(key, F.col(self._column(i)))
            answer = F.when(here, answer).otherwise(F.lit(i % 2 == 1))
        return answer


def rules_frame(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """``verdict, host, path`` of a short list of rules as a frame."""
    rows = [
        F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path"))
        for v, h, p in rules
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    otherwise: str = "allow",
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page, by the longest rule that fits.

    ``rules`` has ``verdict`` (allow or block), ``host`` and ``path``; a null host or path is empty
    and a rule without a host fits nothing. A rule fits its host and all subdomains if the URL's
    path starts with the rule's. Of rules of one length the one of the longer host wins, and block
    wins over allow of the same rule. ``rule`` is null and the verdict ``otherwise`` (not listed)
    where none fits. Rows are kept as they are, repeated ones and null ids too.
    """
    pages = with_host_path(
        pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("_url")), "_url"
    ).drop("_url")
    rules = settle(
        rules.select(
            "verdict",
            F.length(F.coalesce("path", F.lit(""))).alias("size"),
            F.concat(F.col("host"), F.coalesce("path", F.lit(""))).alias("key"),
        ).where("host != ''"),
        "rules",
    )
    lengths = [row["size"] for row in rules.select("size").distinct().orderBy("size").collect()]
    if not lengths:
        none = F.lit(None).cast("string").alias("rule")
        return pages.select("*", none, F.lit(otherwise).alias("verdict"))
    keys = rule_keys(F.col("host"), F.col("path"), lengths)
    places = pages.select("host", F.substring("path", 1, max(max(lengths), 1)).alias("path"))
    universe = settle(
        places.distinct().select(F.explode(keys).alias("key")).distinct(), "universe"
    )
    count = universe.count()
    block = Cascade(rules.where("verdict = 'block'"), universe, count, "block")
    allow = Cascade(rules.where("verdict = 'allow'"), universe, count, "allow")
    judged = allow.with_filters(block.with_filters(pages.withColumn("_keys", keys)))
    listed = F.filter("_keys", lambda key: block.contains(key) | allow.contains(key))
    ranked = F.transform(
        listed,
        lambda key: F.struct(
            F.length(key).alias("size"),
            F.length(F.substring_index(key, "/", 1)).alias("host"),
            key.alias("key"),
        ),
    )
    rule = F.array_max(ranked)["key"]
    verdict = (
        F.when(F.col("rule").isNull(), F.lit(otherwise))
        .when(block.contains(F.col("rule")), F.lit("block"))
        .otherwise(F.lit("allow"))
    )
    return judged.withColumn("rule", rule).select(
        "page_id", "host", "path", "rule", verdict.alias("verdict")
    )
