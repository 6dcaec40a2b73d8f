"""URL filter: a blocked Bloom filter of listed canonical URLs before an exact hash join.

A rule lists a host and the beginning of a path; it fits its host and all subdomains where the URL's path begins so.
The candidates of a URL are the ends of its host with the beginnings of its path. Each looks up one block of the
filter (512 bits, one bit to test in each of its eight words); what passes is joined with the rules, which removes
false positives. Only built-in functions are used.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.llm.arrow import quoted

#: Bits of the filter for each rule; with eight bits set for each, about one candidate in 2,000 passes wrongly.
BITS_PER_RULE = 16
#: The filter goes to all tasks where its blocks take up to this many bytes.
BROADCAST_BYTES = 8 << 20

_WORDS = range(8)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host(url: Column) -> Column:
    """Up to the first ``/``, ``?`` or ``#`` after the first ``://``, with A-Z in lower case."""
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), _UPPER, _LOWER)


def path(url: Column) -> Column:
    """From the end of the host up to ``?`` or ``#``."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _bits(key: Column) -> list[Column]:
    """The bit of each word of a block that ``key`` sets: six bits of its hash choose each."""
    hashed = F.xxhash64(key)
    return [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(hashed, 6 * i).bitwiseAND(63).cast("int")) for i in _WORDS]


def bloom_filter(rules: DataFrame, blocks: int) -> DataFrame:
    """Blocks that hold rules (``host``, ``path``): ``block`` and the words ``w0`` to ``w7``."""
    keyed = rules.select(F.xxhash64("host", "path").alias("key")).select(F.pmod("key", F.lit(blocks)).alias("block"), *[b.alias(f"w{i}") for i, b in zip(_WORDS, _bits(F.col("key")), strict=True)])
    return keyed.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in _WORDS])


def judge(pages: DataFrame, rules: DataFrame, carried: list[str], url: str = "url", unlisted: str = "allow", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``carried``, ``host``, ``path``, ``rule`` and ``verdict`` for each row of ``pages``.

    ``rules``: ``host`` in lower case, ``path``, ``verdict`` (allow or block). Of the rules that fit a URL the longest
    wins (host and path together, then host); of the same rule with both verdicts, block. Where none fits the rule is
    null and the verdict ``unlisted``. A null URL, or one without ``://``, has an empty host and path and fits no rule
    but one with an empty host. Rules with a null fit nothing. Repeated rows each get their verdict; without rules all
    are unlisted, and an empty table gives no rows.
    """
    listed = rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL").select("host", "path", "verdict")
    counted = listed.agg(F.count("*").alias("n"), F.array_sort(F.collect_set(F.length("path"))).alias("lengths")).first()
    blocks = max(1, -(-counted["n"] * BITS_PER_RULE // 512))
    filled = bloom_filter(listed, blocks)
    filled = F.broadcast(filled) if blocks * 72 <= broadcast_bytes else filled

    row = F.struct(F.lit(True).alias("_"), *[quoted(c).alias(f"c{i}") for i, c in enumerate(carried)])
    parts = F.coalesce(quoted(url).cast("string"), F.lit(""))
    given = pages.select(F.monotonically_increasing_id().alias("id"), row.alias("row"), host(parts).alias("host"), path(parts).alias("path"))
    labels = F.split("host", r"\.", -1)
    lengths = F.lit(counted["lengths"] or []).cast("array<int>")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.length(F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    paths = F.filter(lengths, lambda n: n <= F.length("path"))
    candidates = F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.struct(h.alias("h"), p.alias("p")))))
    # one more without a key, so that every page is kept
    none = F.array(F.struct(F.lit(None).cast("int").alias("h"), F.lit(None).cast("int").alias("p")))
    tried = given.withColumn("try", F.explode(F.concat(none, candidates))).select("id", "row", "host", "path", F.col("try.h").alias("h"), F.col("try.p").alias("p"))
    # a page's last row has its own key, as all of them would meet in one task otherwise
    tried = tried.withColumn("try_host", F.expr("CASE WHEN h IS NULL THEN concat('?', id) ELSE right(host, h) END")).withColumn("try_path", F.expr("CASE WHEN h IS NOT NULL THEN left(path, p) ELSE '' END"))
    tried = tried.withColumn("key", F.xxhash64("try_host", "try_path")).withColumn("block", F.pmod("key", F.lit(blocks)))
    passed = [F.col(f"w{i}").bitwiseAND(bit) != 0 for i, bit in zip(_WORDS, _bits(F.col("key")), strict=True)]
    found = tried.join(filled, "block", "left")
    test = passed[0]
    for more in passed[1:]:
        test = test & more
    hits = found.where(F.col("h").isNull() | test).select("id", "row", "host", "path", "h", "p", "try_host", "try_path")
    exact = listed.select(F.col("host").alias("try_host"), F.col("path").alias("try_path"), (F.col("verdict") == "block").cast("long").alias("blocks"))
    joined = hits.join(exact, ["try_host", "try_path"], "left")
    # total length, host's length and verdict in one number
    rank = (F.col("h") + F.col("p")).cast("long") * (1 << 32) + F.col("h").cast("long") * 2 + F.col("blocks")
    best = joined.groupBy("id", "row", "host", "path").agg(F.max(rank).alias("best"))
    h, total = F.expr("CAST(best % 4294967296 div 2 AS INT)"), F.expr("CAST(best div 4294967296 AS INT)")
    best = best.withColumn("h", h).withColumn("p", total - h)
    return best.select(
        *[F.col(f"row.c{i}").alias(c) for i, c in enumerate(carried)],
        "host",
        "path",
        F.expr("CASE WHEN best IS NOT NULL THEN concat(right(host, h), left(path, p)) END").alias("rule"),
        F.when(F.col("best").isNull(), unlisted).when(F.col("best") % 2 == 1, "block").otherwise("allow").alias("verdict"),
    )
