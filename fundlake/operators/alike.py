"""Which texts are alike: a similarity join by the matching-blocks ratio, without a test of every pair.

A ratio above r bounds what two texts must have in common: their lengths differ
by a factor of (2 - r) / r at most, and of their tokens (``likeness.tokens``)
they share ``needed`` or more. With tokens in one order for all texts, rare ones
first, the first shared token then stands early in both (a prefix of n - needed
+ 1 and m - needed + 1 tokens). So a text is posted under each of its tokens and
its length, and asks for each of its own tokens and each length that a partner
may have, as far as the prefix for that length goes. Where two texts meet, their
first shared token decides, so a pair comes out once; the number of tokens that
they share is tested before the ratio is computed.

Both prefixes depend on the partner's length, not on the shortest one possible,
which keeps frequent tokens out of most of them.

Edge cases: null and empty texts take part in no pair. Repeated texts count once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.functions.likeness import needed, ratio, tokens


def candidates(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """(a, b) of all pairs whose ratio can be above least; left: (a), right: (b), lower case. Needs 0 < least < 1."""
    far = (2 - least) / least
    a = left.select("a").where(F.length("a") > 0).distinct().withColumn("n", F.length("a")).withColumn("ta", tokens(F.col("a")))
    b = right.select("b").where(F.length("b") > 0).distinct().withColumn("m", F.length("b")).withColumn("tb", tokens(F.col("b")))
    partners = F.sequence(F.ceil(F.col("n") / far - 1e-9).cast("int"), F.floor(F.col("n") * far + 1e-9).cast("int"))
    lengths = b.select("m").distinct()
    asked = a.select("a", "n", "ta", F.explode(partners).alias("m")).join(lengths, "m")
    asked = asked.select("a", "n", "m", "ta", F.posexplode("ta").alias("at", "token")).where(F.col("at") <= F.col("n") - needed(F.col("n"), F.col("m"), least))
    posted = b.select("b", "m", "tb", F.posexplode("tb").alias("to", "token"))
    common = F.array_intersect("ta", "tb")
    enough = needed(F.col("n"), F.col("m"), least)
    met = asked.join(posted, ["token", "m"]).where(F.col("to") <= F.col("m") - enough)
    return met.where((F.get(common, 0) == F.col("token")) & (F.size(common) >= enough)).select("a", "b")


def alike(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """(a, b, score) of all pairs with a ratio above least."""
    return candidates(left, right, least).withColumn("score", ratio(F.col("a"), F.col("b"))).where(F.col("score") > least)
