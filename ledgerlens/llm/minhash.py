"""Document fingerprints by one-permutation MinHash: DataFrame functions only.

Each word shingle is hashed once: low bits of the hash choose one of BINS bins, the rest is its value, and a bin keeps
its least value.  An empty bin copies the first non-empty bin of its own fixed probe sequence (optimal densification),
the same in every document.  Of each bin the LOW_BITS low bits are stored.  Two fingerprints agree in a bin with
probability J + (1 - J) / 2^LOW_BITS for texts with likeness J, which `likeness` inverts.

Step columns are kept apart so that a step is computed once per row; they are dropped at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.llm.ordered import range_bounds, range_of

BINS = 128
BIN_BITS = 7
LOW_BITS = 8
PROBES = 8
SHINGLE = 5


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def fingerprints(df: DataFrame, text: str = "text", out: str = "sketch", shingle: int = SHINGLE) -> DataFrame:
    """`df` with `out`, array<smallint> of BINS stored values; an empty array for a text without words (or NULL).

    Words end at white space and count in lower case; a text of fewer words than a shingle is one shingle.
    """
    kept = [c for c in df.columns if c.lower() != out.lower()]
    step = df.select(*[F.col(_quoted(c)) for c in kept], F.filter(
        F.split(F.lower(F.coalesce(F.col(_quoted(text)), F.lit(""))), r"\s+"), lambda w: w != "").alias("__w"))
    n, at = F.size("__w"), lambda i, d: F.get(F.col("__w"), i + d)
    step = step.withColumn("__h", F.when(n == 0, F.expr("array()").cast("array<bigint>"))
                           .when(n <= shingle, F.array(F.xxhash64(F.array_join("__w", " "))))
                           .otherwise(F.transform(F.sequence(F.lit(0), F.greatest(n - shingle, F.lit(0))),
                                                  lambda i: F.xxhash64(*[at(i, d) for d in range(shingle)]))))
    # bin in the high bits and value in the low ones, so that sorting puts the least value of each bin first
    step = step.withColumn("__s", F.sort_array(F.transform("__h", lambda h: F.shiftleft(h.bitwiseAND(BINS - 1), 56)
                                                           .bitwiseOR(F.shiftrightunsigned(h, 8)))))
    step = step.withColumn("__m", F.filter("__s", lambda x, i: (i == 0) | (
        F.shiftright(x, 56) != F.shiftright(F.get(F.col("__s"), i - 1), 56))))
    step = step.withColumn("__b", F.transform("__m", lambda x: F.shiftright(x, 56)))
    step = step.withColumn("__d", F.when(F.size("__m") == BINS, F.col("__m")).when(F.size("__m") == 0, F.col("__m"))
                           .otherwise(F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), _filled)))
    low = (1 << LOW_BITS) - 1
    return step.select(*[F.col(_quoted(c)) for c in kept],
                       F.transform("__d", lambda x: x.bitwiseAND(low).cast("smallint")).alias(out))


def _filled(b: Column) -> Column:
    """Least value of bin `b`; of an empty bin, that of the first non-empty bin in its probe sequence.

    The sequence is PROBES hashed bins and then all bins by a hash of the pair, so it always ends.
    """
    own = F.array_position(F.col("__b"), b.cast("bigint"))
    probed = F.get(F.filter(F.transform(F.sequence(F.lit(0), F.lit(PROBES - 1)), lambda t: F.array_position(
        F.col("__b"), F.pmod(F.xxhash64(b, t), F.lit(BINS)))), lambda p: p > 0), F.lit(0))
    rest = F.array_min(F.transform("__m", lambda x: F.struct(
        F.xxhash64(b, F.shiftright(x, 56)).alias("order"), x.alias("x"))))["x"]
    place = F.when(own > 0, own).otherwise(probed)
    return F.coalesce(F.get(F.col("__m"), (place - 1).cast("int")), rest)


def packed(sketch: Column) -> Column:
    """The stored values as lower-case hexadecimal, LOW_BITS a bin; empty for an empty fingerprint."""
    digits = LOW_BITS // 4
    return F.lower(F.array_join(F.transform(sketch, lambda x: F.lpad(F.hex(x.cast("bigint")), digits, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles, 0 to 1, corrected for low bits that agree by chance.

    Two empty fingerprints are alike (1), an empty and another one are not (0).
    """
    chance = 1.0 / (1 << LOW_BITS)
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)) / F.lit(float(BINS))
    share = F.greatest(F.lit(0.0), (same - chance) / (1 - chance))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(share)


def with_next(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, range, guest): rows in ranges of the key, each followed in its range by its next row.

    Next is descending key order, and the greatest key follows the least.  The first row of each range is also put as
    a guest behind the last row of the range before it, so a window over (range, guest, key descending) sees every
    neighbour and no window spans the table.  Equal keys are in order of their text; a NULL key is last.
    """
    rows = df.select(F.col(key).cast("long").alias(key), F.coalesce(F.col(text), F.lit("")).alias(text))
    bounds = range_bounds(rows, key)
    rows = rows.withColumn("range", range_of(F.col(key), bounds).cast("int"))
    # One small row per range: its first key, and the nearest range above that has rows.
    firsts = rows.groupBy("range").agg(F.max(key).alias("first")).collect()  # at most MOST_RANGES rows
    used = sorted((r["range"] for r in firsts))
    above = dict(zip(used, [*used[1:], *used[:1]]))  # the last range, at the greatest keys, comes first of all
    if not firsts:
        return rows.withColumn("guest", F.lit(False))
    host = df.sparkSession.createDataFrame([(r["range"], r["first"], above[r["range"]]) for r in firsts],
                                           f"range int, `{key}` long, host int")
    spec = F.broadcast(host)
    candidates = rows.join(spec, (rows["range"] == spec["range"]) & rows[key].eqNullSafe(spec[key])).select(
        rows["range"], rows[key], rows[text], "host")
    guests = (candidates.groupBy("range", key, "host").agg(F.min(text).alias(text))
              .select(key, text, F.col("host").alias("range"), F.lit(True).alias("guest")))
    return rows.withColumn("guest", F.lit(False)).unionByName(guests)


def edited_text(text: Column, following: Column) -> Column:
    """`text` with its last half replaced by as many characters of `following`, or all of them."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substr(text, F.lit(1), F.char_length(text) - half), F.substr(following, F.lit(1), half))
