"""Spelling variants: words one edit apart, found by asymmetric q-chunks.

Of two words the longer one (of equally long ones either) is cut into two disjoint chunks of half
its length; the other contributes all its positional grams of that length. One edit leaves one of
the two chunks whole, and moves it by one place at most, so every pair that is one edit apart
shares a chunk and a gram within shift one. Pairs that meet this way are verified.

A chunk that many words share would bring together more pairs than are near. Such chunks are joined by
what surrounds them too: the rest of both words is at most one edit apart, so both have the
rest, or the rest without one character, in common.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlake.llm.common import stored

# What a run of letters is, which runs lose a character, and which words count.
LETTERS = r"[A-Za-zÀ-ÿ]+"
DROPPED = 199
MIN_CHARS, MIN_COUNT, FORM_TIMES = 6, 5, 5
#: A chunk with more words than this on its side is joined by its surroundings too.
HOT_WORDS = 128
#: Of longer words only those grams are made whose position is within one of a chunk's: others
#: join nothing, and all grams of a very long word would be its length squared.
LONG_CHARS = 64

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def without(word: Column, start: Column, length: Column | int) -> Column:
    """A word without ``length`` characters from the 0-based ``start`` on."""
    end = start + length
    return F.concat(F.substring(word, F.lit(1), start), F.substring(
        word, end + 1, F.length(word)))


def words_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``word`` of each run of letters in whole texts, with a character less where its hash says."""
    runs = docs.select(
        F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("of"),
        F.explode(F.regexp_extract_all(f"`{text}`", F.lit(LETTERS), F.lit(0))).alias("run"))
    lower = runs.select("of", F.translate("run", _UPPER, _LOWER).alias("run")).filter(
        F.length("run") >= MIN_CHARS)
    hashed = lower.select("run", F.crc32(F.concat("of", F.lit(":"), "run")).alias("h"))
    place = F.pmod("h", F.length("run")).cast("int")
    return hashed.select(F.when(
        F.col("h") % DROPPED == 0, without(F.col("run"), place, 1)).otherwise(F.col("run")).alias(
            "word"))


def count_words(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n`` of all words that are long and frequent enough."""
    return words_of(docs, key, text).filter(F.length("word") >= MIN_CHARS).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MIN_COUNT)


def chunks(words: DataFrame) -> DataFrame:
    """``long, at, chunk, word``: two disjoint chunks of each word, each half its length."""
    half = F.floor(F.length("word") / 2).cast("int")
    return words.select(
        F.length("word").alias("long"), "word",
        F.explode(F.array(F.lit(0), half)).alias("at")).withColumn(
            "chunk", F.substring("word", F.col("at") + 1, F.floor(F.col("long") / 2).cast("int")))


def grams(words: DataFrame) -> DataFrame:
    """``long, at, chunk, word``: all positional grams that a word of its length, or one more, seeks."""
    sizes = words.select("word", F.explode(F.array(
        F.length("word"), F.length("word") + 1)).alias("long"))
    half = F.floor(F.col("long") / 2).cast("int")
    last = F.length("word") - half
    near = F.filter(
        F.array(F.lit(0), F.lit(1), half - 1, half, half + 1), lambda at: at <= last)
    places = F.when(F.length("word") > LONG_CHARS, near).otherwise(F.sequence(F.lit(0), last))
    return sizes.withColumn("at", F.explode(places)).withColumn(
        "chunk", F.substring("word", F.col("at") + 1, half))


def _rests(rows: DataFrame) -> DataFrame:
    """Each row with ``rest``: what surrounds its chunk, whole and without one character each."""
    rest = without(F.col("word"), F.col("at"), F.length("chunk"))
    whole = rows.withColumn("whole", rest)
    shorter = F.transform(
        F.sequence(F.lit(0), F.length("whole") - 1), lambda i: without(F.col("whole"), i, 1))
    return whole.withColumn("rest", F.explode(F.array_distinct(F.concat(
        F.array("whole"), shorter)))).drop("whole")


def near_pairs(words: DataFrame, hot_words: int = HOT_WORDS) -> DataFrame:
    """``a, b``: every pair of distinct words of at least two characters one edit apart, once."""
    cut, other = chunks(words), grams(words)
    hot = stored(cut.groupBy("long", "chunk").agg(F.count(F.lit(1)).alias("words")).filter(
        F.col("words") > hot_words).select("long", "chunk"), "hot-chunks")
    keys = ["long", "chunk"]

    def met(by: list[str], sides: tuple[DataFrame, DataFrame]) -> DataFrame:
        left, right = (
            side.select(*by, F.col("at").alias(f"{name}_at"), F.col("word").alias(name))
            for side, name in zip(sides, ("a", "b")))
        # words of one length meet in both roles; the smaller gives the chunk
        once = (F.length("a") > F.length("b")) | (F.col("a") < F.col("b"))
        # by merging: Spark takes a side for no larger than before its words were exploded
        return left.join(right.hint("merge"), by).filter(
            (F.abs(F.col("a_at") - F.col("b_at")) <= 1) & once
            & (F.levenshtein("a", "b", 1) == 1)).select("a", "b")

    cold = met(keys, (cut.join(hot, keys, "left_anti"), other.join(hot, keys, "left_anti")))
    crowded = met([*keys, "rest"], tuple(
        _rests(side.join(hot, keys, "left_semi")) for side in (cut, other)))
    return cold.unionByName(crowded).distinct()


def chain_rounds(largest: int) -> int:
    """Doublings that follow every chain of forms to its end.

    Each form has FORM_TIMES the count of its word at least and the first word MIN_COUNT, so a
    chain is no longer than a logarithm of the largest count.
    """
    steps = int(math.log(max(largest, MIN_COUNT) / MIN_COUNT, FORM_TIMES) + 1e-9)
    return max(0, math.ceil(math.log2(steps))) if steps else 0


def spelling_forms(
    docs: DataFrame, key: str = "doc_id", text: str = "text", hot_words: int = HOT_WORDS,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of all whole texts.

    A word's form is its most frequent near word (ties: the smallest in code-point order), if that
    has FORM_TIMES its count at least; its root is the end of the chain of forms, or itself.

    Tables that grow with the words are joined by merging and never sent to the driver.

    Null and empty texts have no words. A null key counts as the empty string before the colon of
    the hashed name. Repeated rows count as often as they occur. Texts of any length are read
    whole, and words of any length take part. Other columns are not read, whatever their names. An empty table returns nothing.
    """
    words = stored(count_words(docs, key, text), "words")
    pairs = near_pairs(words.select("word"), hot_words)
    counted = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near")))).alias("pair")).select("pair.*")
    best = both.join(counted.hint("merge"), "near").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    enough = -F.col("best.less") >= FORM_TIMES * F.col("n")
    linked = stored(words.join(best.hint("merge"), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"),
        F.when(enough, -F.col("best.less")).alias("form_n")), "forms")

    roots = linked.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    largest = words.agg(F.max("n")).first()[0] or 0
    for _ in range(chain_rounds(largest)):
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = stored(roots.join(further.hint("merge"), "root", "left").select(
            "word", F.coalesce("next", "root").alias("root")), "roots")
    return linked.join(roots.hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


_ACCENTED = "".join(chr(c) for c in range(0xC0, 0x100))
# as many signs that no word holds: the twin's edit distance counts bytes
_SIGNS = "".join(chr(c) for c in range(0x21, 0x61) if chr(c) != "'") + "~"
#: CRC-32 is computed in SQL from its polynomial; near words meet in a common one-deletion form.
SPELLING_SQL = f"""
WITH RECURSIVE bits(i, k, c) AS (
  SELECT i, 0, i::BIGINT FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
  FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
runs AS (SELECT coalesce(doc_id::VARCHAR, '') AS d, translate(
    unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{_UPPER}', '{_LOWER}') AS run
  FROM documents),
kept AS (SELECT d || ':' || run AS name, run, count(*) AS m FROM runs
  WHERE length(run) >= {MIN_CHARS} GROUP BY ALL),
hashed AS (SELECT run, m, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(
    range(1, 1 + octet_length(encode(name))::BIGINT),
    lambda i: ('0x' || hex(encode(name)[i:i]))::BIGINT)),
    lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) AS h FROM kept, crc),
made AS (SELECT m, CASE WHEN h % {DROPPED} = 0 THEN run[:h % length(run)]
    || run[h % length(run) + 2:] ELSE run END AS word FROM hashed),
w AS (SELECT word, sum(m)::BIGINT AS n FROM made WHERE length(word) >= {MIN_CHARS}
  GROUP BY word HAVING sum(m) >= {MIN_COUNT}),
v AS (SELECT DISTINCT word, unnest(list_concat([word], list_transform(
    range(1, length(word) + 1), lambda i: word[:i - 1] || word[i + 1:]))) AS form FROM w),
near AS (SELECT DISTINCT a.word, b.word AS other FROM v a JOIN v b USING (form)
  WHERE a.word <> b.word AND levenshtein(translate(a.word, '{_ACCENTED}', '{_SIGNS}'),
    translate(b.word, '{_ACCENTED}', '{_SIGNS}')) = 1),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, encode(other)) AS other,
    max(n) AS other_n FROM near JOIN (SELECT word AS other, n FROM w) USING (other) GROUP BY word),
f AS (SELECT word, n, coalesce(n_near, 0) AS n_near,
    CASE WHEN other_n >= {FORM_TIMES} * n THEN other END AS form,
    CASE WHEN other_n >= {FORM_TIMES} * n THEN other_n END AS form_n
  FROM w LEFT JOIN best USING (word)),
up(word, top, further) AS (
  SELECT word, word, form FROM f
  UNION ALL SELECT up.word, f.word, f.form FROM up JOIN f ON f.word = up.further)
SELECT f.word, form, top AS root, n, n_near, form_n
FROM f JOIN up ON up.word = f.word AND up.further IS NULL
"""
