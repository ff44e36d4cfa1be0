"""Entity names found inside free text through a table of aliases.

Names come with prefixes, suffixes and notes around them ("the former Republic of X (Y)").  Both
sides become lists of tokens (lower-cased runs of letters and digits), and an alias matches where
its tokens stand in the text one after another.  The alias table is indexed once as the first
two levels of a trie: a first token, and the lengths of the aliases that start with it.  Every
distinct text is joined to it on its tokens, so only runs that some alias could fill are built;
these meet the aliases on the whole run.  Of several matches the longest wins, by tokens, then
by characters; then the leftmost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import join_null_safe


def name_tokens(c) -> Column:
    """The lower-cased runs of letters and digits of a text; null for null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def contained_alias_join(
    df: DataFrame, name_col: str, aliases: DataFrame, alias_col: str, code_col: str, out: str, matched: str | None = None
) -> DataFrame:
    """Add ``out``, the code of the longest alias inside ``name_col`` (null without one), and,
    if named, ``matched``, the alias' tokens joined by blanks.

    Each distinct text is matched once, however often it occurs.  Aliases of the same tokens must
    carry one code, as in ``alias_join``; aliases without a token match nothing.
    """
    table = (
        aliases.select(name_tokens(alias_col).alias("__tokens"), F.col(code_col).alias("__code"))
        .where(F.size("__tokens") > 0)
        .groupBy("__tokens")
        .agg(F.min("__code").alias("__lo"), F.max("__code").alias("__hi"))
        .select(
            F.array_join("__tokens", " ").alias("__run"),
            F.size("__tokens").alias("__n"),
            F.col("__tokens")[0].alias("__head"),
            F.when(F.col("__lo").eqNullSafe(F.col("__hi")), F.col("__lo"))
            .otherwise(F.raise_error(F.concat(F.lit("alias with more than one code: "), F.array_join("__tokens", " "))))
            .alias("__code"),
        )
    )
    heads = table.groupBy("__head").agg(F.collect_set("__n").alias("__lengths"))
    texts = df.select(F.col(name_col).alias("__text")).where(F.col(name_col).isNotNull()).distinct()
    words = texts.select("__text", name_tokens("__text").alias("__tokens"))
    starts = words.select("*", F.posexplode("__tokens").alias("__pos", "__token"))
    runs = (
        starts.join(heads, F.col("__token") == F.col("__head"))
        .select("__text", "__pos", "__tokens", F.explode("__lengths").alias("__n"))
        .where(F.col("__pos") + F.col("__n") <= F.size("__tokens"))
        .select("__text", "__pos", F.array_join(F.slice("__tokens", F.col("__pos") + 1, F.col("__n")), " ").alias("__run"))
    )
    rank = F.struct(F.col("__n"), F.length("__run").alias("chars"), (-F.col("__pos")).alias("left"), F.col("__run"), F.col("__code"))
    found = runs.join(table.select("__run", "__n", "__code"), "__run").groupBy("__text").agg(F.max(rank).alias("__best"))
    kept = [F.col("__best.__code").alias(out)] + ([F.col("__best.__run").alias(matched)] if matched else [])
    codes = found.select(F.col("__text").alias(name_col), *kept)
    return join_null_safe(df, codes, [name_col], "left")
