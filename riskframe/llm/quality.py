"""Operator 9, quality rules: character-class and common-word histograms against language references.

Native: DataFrame functions only. One pass over the texts takes the measures and both histograms of every text
and writes them to the shared folder. From that table come, per language, the summed histograms of all texts of at
least the minimum length (the references: one row per language) and then every text's Jensen-Shannon distances to them.
Texts below the minimum length are judged by the base rules only.

The common-word histogram has one bin for each set of languages that share a word, so words of one language never stand
in for another's, and a last bin for all other words. A text without any common word lies at a distance from a reference
that follows from that reference alone; the limit for words is ``WORD_SHARE`` of it. A reference with less than ``MIN_COMMON``
common words (a language that the lists don't know) has no limit for words and judges texts of its own language only. Both limits have
to hold for one and the same reference.

The references of the ``MAX_LANGS`` languages with most texts are part of the plan. Those of all other languages stay a
table: texts that the first ones do not settle are compared with their own language's by an equi-join, and what is
still open with all of them, in blocks of about ``MAX_LANGS`` languages.

Cases: null and empty texts have no words and fail; null languages take no part in the references; an empty table
gives no references and no rows; repeated rows are judged one by one; texts of any length are measured whole; other input
columns are kept as they are (the operator's own columns carry the prefix it is given).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import stored, unused

# Frequent function words of four languages (general knowledge).
COMMON_WORDS = {
    "en": "the of and to in that is was for on with as by this are it".split(),
    "fr": "le la les de des du et en un une que qui dans pour par est".split(),
    "de": "der die das und in den von zu mit ist im auf für ein dem als".split(),
    "es": "el la los las de del y en un una que por con para se es".split(),
}
WORDS = sorted({w for ws in COMMON_WORDS.values() for w in ws})


def _bins() -> list[list[str]]:
    """The common words by the set of languages that list them."""
    sets: dict[str, list[str]] = {}
    for w in WORDS:
        sets.setdefault("+".join(lang for lang, ws in COMMON_WORDS.items() if w in ws), []).append(w)
    return [sets[k] for k in sorted(sets)]


BINS = _bins()
#: Character classes of the histogram; before them comes white space, after them the rest (mostly small letters).
CLASSES = ("\\p{Lu}", "0-9", "#*$%&|<>", ".,;:!?'\"()-")
MIN_CHARS, MIN_WORDS = 200, 40
MAX_CLASS_DISTANCE = 0.34
#: Limit of the word distance, as a share of the distance of a text without common words; least share of common words in a reference for that.
WORD_SHARE, MIN_COMMON = 0.85, 0.05
#: References held in the plan, and languages in a block of the others.
MAX_LANGS = 64
WINDOW = 5


def _measures(df: DataFrame, text: str, p: str) -> DataFrame:
    """Add the base measures under the prefix ``p``: words, windows and counts."""
    t = F.coalesce(F.col(text), F.lit(""))
    df = _words(df, t, p)
    df = df.withColumns({
        f"{p}n_words": F.size(f"{p}w").cast("long"),
        f"{p}word_chars": F.length(F.array_join(f"{p}w", "")).cast("long"),
        f"{p}n_symbols": _count(f"{p}t", CLASSES[2]).cast("long"),
        f"{p}lines": F.expr(f"filter(split({p}t, '\\n'), x -> x rlike '[^\\\\x20\\\\x09-\\\\x0D]')"),
        f"{p}g": F.expr(f"""CASE WHEN size({p}w) > {WINDOW} THEN transform(sequence(0, size({p}w) - {WINDOW}),
            i -> xxhash64({', '.join(f'{p}w[i + {k}]' for k in range(WINDOW))})) ELSE array() END"""),
    })
    df = df.withColumn(f"{p}s", F.expr(f"""CASE WHEN size(array_distinct({p}g)) < size({p}g)
        THEN array_sort(transform({p}g, (h, i) -> struct(h, i))) ELSE array() END"""))
    df = df.withColumn(f"{p}at", F.expr(f"""array_sort(transform(filter({p}s, (x, j) ->
        (j > 0 AND {p}s[j - 1].h = x.h) OR (j + 1 < size({p}s) AND {p}s[j + 1].h = x.h)), x -> x.i))"""))
    df = df.withColumns({
        f"{p}n_dup_lines": F.expr(f"CAST(size({p}lines) - size(array_distinct({p}lines)) AS BIGINT)"),
        f"{p}n_repeat_words": F.expr(f"""CAST(aggregate({p}at, struct(-{WINDOW} AS last, 0 AS n),
            (a, x) -> struct(x AS last, a.n + least({WINDOW}, x - a.last) AS n), a -> a.n) AS BIGINT)"""),
    }).drop(f"{p}s", f"{p}at", f"{p}g", f"{p}lines")
    return df.withColumn(f"{p}base_failed", F.expr(f"{p}n_words < 10 OR 100 * {p}n_repeat_words > 20 * {p}n_words"))


def _words(df: DataFrame, text: Column, p: str) -> DataFrame:
    """Add ``{p}t`` (the text) and ``{p}w`` (its words)."""
    df = df.withColumn(f"{p}t", text).withColumn(f"{p}w", F.trim(f"{p}t", F.lit(" \t\n\x0b\x0c\r")))
    return df.withColumn(f"{p}w", F.when(F.col(f"{p}w") != "", F.split(f"{p}w", "[\\x20\\x09-\\x0D]+")).otherwise(
        F.array().cast("array<string>")))


def _count(text: str, chars: str) -> Column:
    """How many characters of a class a text has (the runs of all others are cut out)."""
    return F.length(F.regexp_replace(text, f"[^{chars}]+", ""))


def _histograms(df: DataFrame, p: str) -> DataFrame:
    """Add ``{p}cc`` and ``{p}cw``: counts of the character classes and of the common words, each with the rest last."""
    df = df.withColumns({
        f"{p}c": F.array((F.length(f"{p}t") - F.length(F.array_join(f"{p}w", ""))).cast("double"),
                         *[_count(f"{p}t", c).cast("double") for c in CLASSES]),
        f"{p}f": F.expr(f"filter({p}w, x -> x IN ({', '.join(repr(w) for w in WORDS)}))"),
    })
    counts = [F.expr(f"size(filter({p}f, x -> x IN ({', '.join(map(repr, ws))})))") for ws in BINS]
    return df.withColumns({
        f"{p}cc": F.concat(f"{p}c", F.array(F.expr(f"length({p}t) - aggregate({p}c, 0D, (s, x) -> s + x)"))),
        f"{p}cw": F.array(*[c.cast("double") for c in counts], F.expr(f"CAST(size({p}w) - size({p}f) AS DOUBLE)")),
    }).drop(f"{p}c", f"{p}f")


def references(measured: DataFrame, lang: str, p: str) -> DataFrame:
    """Per language (l), the number of texts of at least the minimum lengths and their summed histograms."""
    d = measured.where(F.col(lang).isNotNull() & (F.col(f"{p}chars") >= MIN_CHARS) & (F.col(f"{p}n_words") >= MIN_WORDS))
    n, m = len(CLASSES) + 2, len(BINS) + 1
    sums = d.groupBy(F.col(lang).alias("l")).agg(
        F.count(F.lit(1)).alias("texts"), *[F.sum(F.col(f"{p}cc")[i]).alias(f"c{i}") for i in range(n)],
        *[F.sum(F.col(f"{p}cw")[i]).alias(f"w{i}") for i in range(m)])
    return sums.select("l", "texts", F.array(*[f"c{i}" for i in range(n)]).alias("classes"), F.array(*[f"w{i}" for i in range(m)]).alias("words"))


def js_distance(counts: str, reference: list[float] | Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of a count array to a reference of the same length (counts, or a column of shares)."""
    if isinstance(reference, Column):
        q = reference
    else:
        total = sum(reference) or 1.0
        q = F.array(*[F.lit(x / total) for x in reference])
    p = F.expr(f"transform({counts}, x -> x / aggregate({counts}, 0D, (s, y) -> s + y))")
    parts = F.zip_with(p, q, lambda a, b: F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)
                       + F.when(b > 0, b * F.log2(2 * b / (a + b))).otherwise(0.0))
    return F.sqrt(F.greatest(F.aggregate(parts, F.lit(0.0), lambda s, x: s + x) / 2, F.lit(0.0)))


def word_limit(rest: float | Column) -> float | Column:
    """The limit of the word distance to a reference in which ``rest`` is the share of words that are not common.

    The distance of a text without common words has a closed form; a float gives a float (null: no limit), a column a column.
    """
    if isinstance(rest, Column):
        half = (F.log2(2 / (1 + rest)) + rest * F.log2(2 * rest / (1 + rest)) + (1 - rest)) / 2
        return F.when((rest > 0) & (rest <= 1 - MIN_COMMON), F.sqrt(F.greatest(half, F.lit(0.0))) * WORD_SHARE)
    if not 0 < rest <= 1 - MIN_COMMON:
        return None
    return math.sqrt(max((math.log2(2 / (1 + rest)) + rest * math.log2(2 * rest / (1 + rest)) + (1 - rest)) / 2, 0)) * WORD_SHARE


def _off(p: dict[str, str], own: Column, lang: Column, classes, words, limit) -> Column:
    """How far a text is off a reference: the larger of both distances, each as a share of its limit; null if the reference does not judge it."""
    dc = F.when(F.col(p["chars"]) >= MIN_CHARS, js_distance(p["cc"], classes) / MAX_CLASS_DISTANCE)
    dw = F.when(F.col(p["n_words"]) >= MIN_WORDS, js_distance(p["cw"], words) / limit)
    both = F.coalesce(F.greatest(dc, dw), F.lit(0.0))
    return F.when(limit.isNotNull(), both).when(own == lang, F.coalesce(dc, F.lit(0.0)))


def _with_others(d: DataFrame, others: DataFrame, lang: str, p: str) -> DataFrame:
    """``d`` with ``far`` of the texts that are not yet settled taken to the references of ``others`` too."""
    share = lambda c: F.expr(f"transform({c}, x -> x / greatest(aggregate({c}, 0D, (s, y) -> s + y), 1D))")
    others = others.select("l", share("classes").alias("classes"), share("words").alias("words"))
    others = stored(others.withColumn("limit", word_limit(F.element_at("words", -1))), "quality-others")
    d = stored(d.withColumn(f"{p}row", F.monotonically_increasing_id()), "quality-rows")
    names = {c: c for c in ("chars", "n_words", "cc", "cw")}
    still = "far IS NULL OR far > 1"
    left = (d.where(~F.col(f"{p}base_failed")).select(F.col(f"{p}row").alias("row"), F.col(lang).alias("own"), F.col(f"{p}far").alias("far"),
            *[F.col(p + c).alias(c) for c in names]).where(still))
    off = _off(names, F.col("own"), F.col("l"), F.col("classes"), F.col("words"), F.col("limit"))
    own = stored(left.join(others, F.col("own") == F.col("l"), "left").withColumn("far", F.least("far", F.when(F.col("l").isNotNull(), off)))
                 .select("row", "own", "far", *names), "quality-own")
    blocks = -(-others.count() // MAX_LANGS)
    block = others.groupBy(F.pmod(F.xxhash64("l"), F.lit(blocks)).alias("block")).agg(
        F.collect_list(F.struct("l", "classes", "words", "limit")).alias("refs"))
    least = F.array_min(F.transform("refs", lambda r: _off(names, F.col("own"), r["l"], r["classes"], r["words"], r["limit"])))
    rest = (own.where(still).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(block, "block")
            .select("row", F.least("far", least).alias("far")))
    best = own.select("row", "far").unionByName(rest).groupBy("row").agg(F.min("far").alias("far"))
    best = best.select(F.col("row").alias(f"{p}row"), F.col("far").alias(f"{p}far2"))
    return d.join(best, f"{p}row", "left").withColumn(f"{p}far", F.coalesce(f"{p}far2", f"{p}far")).drop(f"{p}row", f"{p}far2")


def judge(df: DataFrame, text: str = "text", lang: str = "lang", prefix: str = "__q_", drop_text: bool = False) -> DataFrame:
    """The input plus, under ``prefix``: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, far, kept.

    A text is kept when the base rules pass and, from the minimum lengths on, both histograms are within their limits of
    some language's reference: ``far`` is how far off the nearest reference is, 1 at the limit (of those the text was
    compared with; null where none judges it, and then only the base rules decide).
    """
    p = prefix
    d = _histograms(_measures(df, text, p), p).withColumn(f"{p}chars", F.length(f"{p}t"))
    d = stored(d.drop(f"{p}t", f"{p}w", *[text] * drop_text), "quality")
    every = references(d, lang, p)
    first = every.orderBy(F.desc("texts"), "l").limit(MAX_LANGS + 1).collect()
    refs, more = first[:MAX_LANGS], first[MAX_LANGS:]
    names = {c: p + c for c in ("chars", "n_words", "cc", "cw")}
    own = F.col(lang)
    offs = [_off(names, own, F.lit(r["l"]), r["classes"], r["words"], F.lit(word_limit(r["words"][-1] / (sum(r["words"]) or 1.0))).cast("double"))
            for r in refs]
    d = d.withColumn(f"{p}far", F.least(*offs, F.lit(None).cast("double")) if offs else F.lit(None).cast("double"))
    if more:
        d = _with_others(d, every.where(~F.col("l").isin([r["l"] for r in refs])), lang, p)
    good = F.coalesce(F.col(f"{p}far") <= 1, F.lit(True))
    return d.withColumn(f"{p}kept", ~F.col(f"{p}base_failed") & good).drop(f"{p}cc", f"{p}cw", f"{p}chars")


def keep_good(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows that the rules keep, with the input's columns."""
    p = unused(df, "__q_")
    return judge(df, text, lang, p).where(f"{p}kept").select(*[F.col(f"`{c}`") for c in df.columns])


def op9(documents: DataFrame) -> DataFrame:
    """The digest of the contract: one row per document."""
    p = "__q_"
    d = documents.select("doc_id", F.col("text"), "lang")
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judge(d, prefix=p, drop_text=True).select("doc_id", *[F.col(p + c).alias(c) for c in cols])
