"""Join of texts with the keywords that they contain, through an inverted index of trigrams.

A keyword can only be inside a text that has all its trigrams; one with a trigram that no text has meets nothing
at all. The others are looked up at the places of a text that show a keyword's first trigram: the stretch of the
keyword's length there must be the keyword, which an equality join decides. So a text is asked for a few stretches,
however many keywords share a trigram, and every pair that the join makes is a hit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farthing.operators.spread import block_join
from farthing.sources.scratch import stored

GRAM = 3
#: Keywords per key that are tried on every text of the key: about as many tests as a text has trigrams.
FEW = 64
#: Keywords that a join may gather on the driver to send them to all tasks.
GATHERED = 100_000


def grams(text: Column) -> Column:
    """The distinct trigrams of a text; a look-ahead finds the one at every place."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit("(?s)(?=(.{%d}))" % GRAM), F.lit(1)))


def rarest_grams(texts: DataFrame, words: DataFrame, on: Sequence[str], text: str, word: str) -> DataFrame:
    """(key, word, gram, texts): the trigram of every word that the fewest texts of its key have.

    ``words`` are distinct and three letters long at least. A word with a trigram without a text is left out.
    """
    asked = words.select(*on, word, F.explode(grams(F.col(word))).alias("_gram"))
    listed = texts.select(*on, F.explode(grams(F.col(text))).alias("_gram"))
    counts = listed.groupBy(*on, "_gram").agg(F.count(F.lit(1)).alias("_texts"))
    return (
        asked.join(counts, [*on, "_gram"], "left")
        .groupBy(*on, word)
        .agg(F.min(F.struct("_texts", "_gram")).alias("_best"), F.count_if(F.col("_texts").isNull()).alias("_missing"))
        .where("_missing = 0")
        .select(*on, word, F.col("_best._gram").alias("_gram"), F.col("_best._texts").alias("_texts"))
    )


def containing(texts: DataFrame, words: DataFrame, on: Sequence[str], text: str, word: str, spread_by: str, few: int = FEW) -> DataFrame:
    """Rows of ``texts`` x rows of ``words`` of the same key where the text contains the word.

    ``on`` names the key columns of both sides; other columns must differ in name. Words may repeat. Keys of up to
    ``few`` different words, and words shorter than a trigram, are tried on every text of their key; all others go
    through the index. Nulls match nothing. ``spread_by`` is a column of ``texts`` that tells its rows apart.
    Both tables are read more than once; the words and their trigrams are written down in between.
    """
    on = list(on)
    told = stored(words.where(F.col(word).isNotNull()), "words")
    sizes = told.groupBy(*on).agg(F.count_distinct(F.when(F.length(word) >= GRAM, F.col(word))).alias("_long"))
    most = sizes.agg(F.max("_long")).first()[0] or 0
    usable = texts.where(F.col(text).isNotNull())
    hit = F.contains(F.col(text), F.col(word))
    if most <= few:
        return block_join(usable, told, on, spread_by, word).where(hit)
    marked = told.join(sizes, on).withColumn("_plain", (F.length(word) < GRAM) | (F.col("_long") <= few)).drop("_long")
    found = block_join(usable, marked.where("_plain").drop("_plain"), on, spread_by, word).where(hit)
    looked_up = marked.where("not _plain").drop("_plain")
    large = usable.join(looked_up.select(*on).distinct(), on, "left_semi").where(F.length(text) >= GRAM)
    rare = stored(rarest_grams(large, looked_up.select(*on, word).distinct(), on, text, word).select(*on, word), "grams")
    counts = looked_up.groupBy(*on, word).agg(F.count(F.lit(1)).alias("_right"))
    total, often = counts.agg(F.count(F.lit(1)), F.max("_right")).first()
    named = _not_gathered(looked_up.join(_not_gathered(rare, total), [*on, word], "left_semi"), total)
    asked = stretches(large, rare, on, text, word)
    if often == 1:
        return found.unionByName(asked.join(named, [*on, word]))
    pairs = asked.groupBy(*on, word).agg(F.count(F.lit(1)).alias("_left")).join(_not_gathered(counts, total), [*on, word])
    return found.unionByName(block_join(asked, named, [*on, word], spread_by, word, pairs))


def _not_gathered(words: DataFrame, count: int) -> DataFrame:
    """Many keywords are shuffled, however small their file is."""
    return words.hint("merge") if count > GATHERED else words


def stretches(texts: DataFrame, words: DataFrame, on: Sequence[str], text: str, word: str) -> DataFrame:
    """``texts`` once per stretch, under the name ``word``, that starts like a word of its key and is as long as that word.

    A stretch that comes twice in a text counts at its first place, so no row is repeated.
    """
    on = list(on)
    shapes = stored(words.select(*on, F.substring(word, 1, GRAM).alias("_gram"), F.length(word).alias("_len")).distinct(), "shapes")
    places = F.explode(F.sequence(F.lit(1), F.length(text) - (GRAM - 1))).alias("_at")
    opened = texts.select("*", places).withColumn("_gram", F.substring(F.col(text), F.col("_at"), F.lit(GRAM)))
    met = opened.join(shapes, [*on, "_gram"]).where(F.col("_at") + F.col("_len") - 1 <= F.length(text))
    cut = met.withColumn(word, F.substring(F.col(text), F.col("_at"), F.col("_len")))
    return cut.where(F.position(F.col(word), F.col(text)) == F.col("_at")).select(*texts.columns, word)
