"""Join semantics of hardware tables: fallback keys, first-match rules, tiers, ranges, prefixes, proximity.

All are declarative. Small rule sets given as Python values become expressions,
so a large table is neither shuffled nor joined for them. Where rules are a
table, Catalyst picks the join by its size; nothing is broadcast by hand.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def equi(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """JOI-01, JOI-14, JOI-15, JOI-22, TRE-08: a plain equality join."""
    return left.join(right, list(on), how)


def left_with_default(left: DataFrame, right: DataFrame, on: Sequence[str], defaults: Mapping[str, object]) -> DataFrame:
    """Left join whose missing values take defaults (JOI-15)."""
    out = left.join(right, list(on), "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def resolve(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join that fails on a row without a partner (JOI-14)."""
    out = left.join(right.withColumn("__found", F.lit(True)), list(on), "left")
    return out.filter(F.when(F.col("__found").isNull(), F.raise_error(F.concat_ws(" ", F.lit("unresolved:"), *[F.col(c).cast("string") for c in on])).cast("boolean")).otherwise(True)).drop("__found")


def fallback(left: DataFrame, right: DataFrame, candidates: Sequence[Column], right_key: str, row_key: Sequence[str], how: str = "left") -> DataFrame:
    """Join by the first of several candidate keys that the right side has (JOI-02).

    ``right_key`` is unique on the right, ``row_key`` on the left. Adds ``tier``, the number of
    the candidate that matched. One join, and one map-side combined aggregation.
    """
    keys = F.array(*[F.struct(F.lit(i).alias("tier"), c.alias("key")) for i, c in enumerate(candidates)])
    tried = left.select(*row_key, F.explode(keys).alias("k")).select(*row_key, "k.*")
    best = tried.join(right.select(F.col(right_key).alias("key")), "key").groupBy(*row_key).agg(F.min(F.struct("tier", "key")).alias("best"))
    out = left.join(best, list(row_key), how)
    return out.join(right, F.col("best.key") == F.col(right_key), "left").withColumn("tier", F.col("best.tier")).drop("best")


def first_match(value: Column, rules: Sequence[tuple[str, object]], default: object = None) -> Column:
    """Value of the first rule (pattern, value) that matches (JOI-06), as an expression."""
    out = F.lit(default)
    for pattern, result in reversed(rules):
        out = F.when(value.rlike(pattern), F.lit(result)).otherwise(out)
    return out


def first_match_rules(df: DataFrame, rules: DataFrame, row_key: Sequence[str], conditions: Sequence[str], priority: str = "priority", value: str = "value") -> DataFrame:
    """The same where rules are rows: ``rules`` has, for each condition, an array of allowed values or null for any.

    Rules that state the same conditions are found by one equality join on
    those conditions: a row is looked up once for each set of conditions that
    occurs among the rules (2 to the number of conditions at most). The rules
    that state nothing come down to one, which needs no join. A null never
    meets a stated condition.
    """
    bit = {c: 1 << i for i, c in enumerate(conditions)}
    stated = reduce(lambda a, b: a + b, [F.when(F.col(c).isNotNull(), b).otherwise(0) for c, b in bit.items()])
    flat = rules.withColumn("__mask", stated)
    for c in conditions:
        flat = flat.withColumn(c, F.explode(F.coalesce(F.col(c), F.array(F.lit(None)))))
    best = F.min_by(F.struct(F.col(priority).alias("p"), F.col(value).alias("v")), F.col(priority)).alias("__rule")
    keys = flat.groupBy("__mask", *conditions).agg(best)
    masks = sorted(r[0] for r in keys.select("__mask").distinct().collect())
    rest = keys.filter("__mask = 0").select("__rule.p", "__rule.v").first()
    kind = keys.schema["__rule"].dataType
    anyway = F.lit(None).cast(kind) if rest is None else F.struct(F.lit(rest["p"]).alias("p"), F.lit(rest["v"]).alias("v")).cast(kind)
    tries = [F.when(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in conditions if bit[c] & m]), m) for m in masks if m]
    if not tries:
        return df.withColumn(value, anyway["v"])
    tried = df.select(*row_key, *[F.col(c).alias(f"__{c}") for c in conditions], F.explode(F.array_compact(F.array(*tries))).alias("__mask"))
    tried = tried.withColumns({f"__{c}": F.when(F.col("__mask").bitwiseAND(b) != 0, F.col(f"__{c}")) for c, b in bit.items()})
    lookup = keys.filter("__mask <> 0").withColumnRenamed("__mask", "__m")
    same = reduce(lambda a, b: a & b, [F.col(f"__{c}").eqNullSafe(lookup[c]) for c in conditions], F.col("__mask") == F.col("__m"))
    found = tried.join(lookup.drop(*set(row_key) - set(conditions)), same).groupBy(*[tried[k] for k in row_key]).agg(F.min_by("__rule", "__rule.p").alias("__rule"))
    first = F.when(F.col("__rule.p") <= anyway["p"], F.col("__rule.v")).otherwise(anyway["v"]) if rest is not None else F.col("__rule.v")
    return df.join(found, list(row_key), "left").withColumn(value, F.when(F.col("__rule").isNull(), anyway["v"]).otherwise(first)).drop("__rule")


def literal_prefix(pattern: Column | str) -> Column:
    """What each match of a pattern starts with, as far as the pattern spells it out; empty for alternatives."""
    p = F.col(pattern) if isinstance(pattern, str) else pattern
    return F.when(F.contains(p, F.lit("|")), F.lit("")).otherwise(F.regexp_extract(p, r"^[A-Za-z0-9_ #]*(?![?*+{])", 0))


def pattern_join(values: DataFrame, patterns: DataFrame, column: str, pattern: str) -> DataFrame:
    """Values that start with a match of a pattern: an equality join on the pattern's literal prefix, then the pattern. Only patterns that start with no literal are tried on every value."""
    held = patterns.filter(F.col(pattern).isNotNull()).withColumn("__literal", literal_prefix(pattern))
    fits = F.expr(f"{column} rlike concat('^(?:', {pattern}, ')')")
    lengths = sorted(r[0] for r in held.select(F.length("__literal")).distinct().collect())
    out = prefix_join(values, held.filter("__literal <> ''"), column, "__literal").filter(fits)
    if lengths[:1] == [0]:
        out = out.unionByName(values.join(held.filter("__literal = ''"), fits).select(*out.columns))
    return out.drop("__literal")


def matches_any(df: DataFrame, column: str, patterns: DataFrame, pattern: str = "pattern") -> DataFrame:
    """Rows whose value starts with a match of some pattern (FLT-08, JOI-03, JOI-04). Each distinct value is tried once."""
    tried = pattern_join(df.select(F.col(column).alias("__value")).distinct(), patterns.select(F.col(pattern).alias("__pattern")).distinct(), "__value", "__pattern")
    return df.join(tried.select(F.col("__value").alias(column)).distinct(), column, "left_semi")


def matches_one_of(df: DataFrame, column: str, patterns: Sequence[str]) -> DataFrame:
    """The same for patterns at hand: one alternation, no join."""
    return df.filter(F.col(column).rlike("^(?:" + "|".join(f"(?:{p})" for p in patterns) + ")")) if patterns else df.limit(0)


def claim(column: str, patterns: Sequence[str]) -> Column:
    """The most specific pattern that matches claims the value: longest first, then the one that sorts first (JOI-05, FLT-09). The empty pattern takes the rest."""
    ordered = sorted(set(patterns), key=lambda p: (-len(p), p))
    return first_match(F.col(column), [(f"^(?:{p})" if p else "", p) for p in ordered])


def claim_rows(df: DataFrame, column: str, files: DataFrame, row_key: Sequence[str], pattern: str = "pattern", name: str = "file") -> DataFrame:
    """The same where the patterns are rows: of the files whose pattern matches, the one with the longest pattern, fewest wildcards, first name."""
    rank = F.struct(-F.length(pattern), F.length(F.regexp_replace(pattern, r"[^.x]", "")), F.col(name))
    hit = pattern_join(df, files, column, pattern)
    return hit.groupBy(*row_key).agg(F.min_by(F.col(name), rank).alias(name))


def cascade(left: DataFrame, right: DataFrame, tiers: Sequence[Column], row_key: Sequence[str], condition: Column | None = None) -> DataFrame:
    """Pairs of the first tier that has any for the left row; all pairs of that tier (JOI-07).

    Each tier is a condition on columns of both sides, which must not share
    names. Where ``condition`` holds an equality, it is a hash join; without
    one every type is tried on every row, so the right side must be small.
    """
    tier = F.lit(None).cast("int")
    for i, t in reversed(list(enumerate(tiers))):
        tier = F.when(t, F.lit(i)).otherwise(tier)
    any_tier = reduce(lambda a, b: a | b, tiers)
    pairs = left.join(right, any_tier if condition is None else condition & any_tier).withColumn("tier", tier)
    # the pairs are made once: a window over one row's partners, not a join with their minimum
    best = F.min("tier").over(Window.partitionBy(*row_key))
    return pairs.withColumn("__best", best).filter("tier = __best").drop("__best")


def unambiguous(df: DataFrame, row_key: Sequence[str], rank: Column) -> DataFrame:
    """Rows of the best rank, where there is exactly one (JOI-08): ties are dropped."""
    best = df.withColumn("__rank", rank)
    top = best.groupBy(*row_key).agg(F.min("__rank").alias("__rank"))
    alone = best.join(top, [*row_key, "__rank"]).groupBy(*row_key, "__rank").agg(F.count("*").alias("__n")).filter("__n = 1").drop("__n")
    return best.join(alone, [*row_key, "__rank"], "left_semi").drop("__rank")


def range_join(points: DataFrame, intervals: DataFrame, value: Column, low: Column, high: Column, width: float, on: Sequence[str] = ()) -> DataFrame:
    """Points inside intervals, ends included (JOI-09, JOI-10, JOI-11).

    Numbers are cut into bins of ``width``, best of the order of an interval's
    length: a point is in one bin, an interval is copied to each bin it
    touches, so it is an equality join on the bin and ``on``, with no row lost
    and none found twice.
    """
    p = points.withColumn("__bin", F.floor(value / width))
    i = intervals.filter(low <= high).withColumn("__bin", F.explode(F.sequence(F.floor(low / width), F.floor(high / width))))
    return p.join(i, ["__bin", *on]).filter((value >= low) & (value <= high)).drop("__bin")


def prefix_join(left: DataFrame, right: DataFrame, text: str, prefix: str) -> DataFrame:
    """Rows whose text starts with a prefix (JOI-13, JOI-16, TXT-17): an equality join on prefixes of the lengths that occur."""
    lengths = [r[0] for r in right.select(F.length(prefix).alias("n")).filter("n is not null").distinct().orderBy("n").collect()]
    if not lengths:
        return left.join(right, F.lit(False))
    tried = F.array_compact(F.array(*[F.when(F.length(text) >= n, F.left(F.col(text), F.lit(n))) for n in lengths]))
    return left.withColumn("__p", F.explode(tried)).join(right, F.col("__p") == F.col(prefix)).drop("__p")


def contains_join(left: DataFrame, right: DataFrame, text: str, part: str) -> DataFrame:
    """Rows whose text contains the part (JOI-18). No key can serve it: a nested loop over the smaller side."""
    return left.join(right, F.contains(F.col(text), F.col(part)))


def next_within(partition: Sequence[str], order: Sequence[str], wanted: Column, value: Column, reach: int = 5) -> Column:
    """Value of the first wanted row among the next ``reach`` rows, null if none (JOI-12)."""
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(1, reach)
    return F.first(F.when(wanted, value), ignorenulls=True).over(w)


def nearest_define(names: DataFrame, defines: DataFrame, on: str, key: Column, define: Column, row_key: Sequence[str]) -> DataFrame:
    """Exact define, else the smallest that isn't below the key, in text order (JOI-20)."""
    pairs = names.join(defines, on).filter(define >= key)
    return pairs.groupBy(*row_key).agg(F.min(define).alias("define"))


def offset_lookup(left: DataFrame, offsets: DataFrame, name: str, pattern: str, row_key: Sequence[str], base: str = "address") -> DataFrame:
    """The first offset whose pattern the name matches, added to the base; none adds nothing (JOI-19). ``offsets``: ord, pattern, offset."""
    hit = left.join(offsets, F.expr(f"{name} rlike {pattern}")).groupBy(*row_key).agg(F.min_by("offset", "ord").alias("__offset"))
    return left.join(hit, list(row_key), "left").withColumn(base, F.col(base) + F.coalesce("__offset", F.lit(0))).drop("__offset")


def alias_lookup(keys: DataFrame, rules: DataFrame, key: str, alias: str) -> DataFrame:
    """Rules looked up by key, where a rule may only name the key it is an alias of (JOI-21): one self-join, not a chain."""
    full = rules.filter(F.col(alias).isNull()).drop(alias)
    by_alias = rules.filter(F.col(alias).isNotNull()).select(key, F.col(alias).alias("__of"))
    aliased = by_alias.join(full.withColumnRenamed(key, "__of"), "__of").drop("__of")
    return keys.join(full.unionByName(aliased), key)


def children_of(df: DataFrame, path: str, ancestors: DataFrame, ancestor_path: str) -> DataFrame:
    """Rows below an ancestor, by materialised path (JOI-16)."""
    return prefix_join(df, ancestors.withColumn(ancestor_path, F.concat(F.rtrim(F.col(ancestor_path), F.lit("/")), F.lit("/"))), path, ancestor_path)
