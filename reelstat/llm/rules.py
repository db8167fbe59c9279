"""Quality rules whose thresholds follow the data.

Each document is measured in place with built-in functions. For every language and source a mergeable quantile sketch is
kept of each measure; sketches of small groups give way to those of the language, and of small languages to
the one of all documents, which are merged from the same sketches. A document is rejected where a measure
lies beyond its group's upper (or lower) fence: the median moved outward by half the distance of the quartiles and
``REACH`` times that distance, where the quartile nearer to the median tells the distance, as junk on one side moves the
other. A measure that hardly varies in a group gets a least distance instead, so that clean documents in a uniform group
do not fall. A gap of the upper quantiles of symbols draws their fence in, down to half the reach.

No group is judged more mildly than its language, nor, in the measures that mean the same in every language, than all
documents: a source that is mostly junk does not set its own limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reelstat.llm.common import free_name, stored, table

SPACE = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
# Size parameter of the sketches; the error of a rank is about 1/400.
SKETCH_K = 1024
# Documents below which a group's quantiles come from the next wider group.
LEAST_GROUP = 200
REACH = 4.0
# Measure: (has a lower fence, has an upper fence, least distance of the quartiles).
MEASURES = {
    "symbols_per_word": (False, True, 0.05),
    "repeated_lines": (False, True, 0.1),
    "repeated_words": (False, True, 0.1),
    "word_length": (True, True, 1.0),
}
# Measures that depend on the language.
OF_LANGUAGE = {"word_length"}
# Measures whose gaps are looked for, and the upper ranks between which. Shares of few lines have gaps of themselves.
GAPS = {"symbols_per_word"}
UPPER_RANKS = (0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.925, 0.95, 0.97, 0.98, 0.99, 0.995)


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE_RUN), lambda w: w != "")


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def measured(documents: DataFrame, name: str) -> DataFrame:
    """The given rows with a struct column ``name`` of counts and measures of the whole text. Null texts are empty.

    Repeated three-word windows are found by sorting the hashes of all windows of the text with their places, and their
    words by running over the places in order, so long texts cost little more than a sort.
    """
    step = {k: f"{name}_{k}" for k in ("text", "words", "lines", "windows", "again")}
    kept = [F.col(f"`{c}`") for c in documents.columns]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACE, "")) > 0)
    split = documents.select(
        *kept, text.alias(step["text"]), _words(text).alias(step["words"]), lines.alias(step["lines"])
    )
    words = F.col(step["words"])
    places = F.when(F.size(words) >= 3, F.sequence(F.lit(2), F.size(words) - 1)).otherwise(F.array().cast("array<int>"))
    window = lambda i: F.struct(F.xxhash64(F.get(words, i - 2), F.get(words, i - 1), F.get(words, i)).alias("h"), i.alias("p"))
    sorted_windows = split.withColumn(step["windows"], F.sort_array(F.transform(places, window)))
    windows = F.col(step["windows"])
    twice = lambda w, i: (F.get(windows, i - 1)["h"] == w["h"]) | (F.get(windows, i + 1)["h"] == w["h"])
    again = F.sort_array(F.transform(F.filter(windows, lambda w, i: F.coalesce(twice(w, i), F.lit(False))), lambda w: w["p"]))
    found = sorted_windows.withColumn(step["again"], again)
    covered = F.aggregate(
        F.col(step["again"]),
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda s, p: F.struct((p + 1).alias("end"), (s["n"] + p + 1 - F.greatest(s["end"], p - 2)).alias("n")),
        lambda s: s["n"],
    )
    plain = F.col(step["text"])
    line_list = F.col(step["lines"])
    n_words, n_lines = F.size(words).cast("long"), F.size(line_list).cast("long")
    word_chars = F.length(F.translate(plain, SPACE, "")).cast("long")
    n_symbols = (F.length(plain) - F.length(F.translate(plain, SYMBOLS, ""))).cast("long")
    n_dup_lines = (F.size(line_list) - F.size(F.array_distinct(line_list))).cast("long")
    counted = found.select(
        *kept,
        F.struct(
            n_words.alias("n_words"),
            n_lines.alias("n_lines"),
            word_chars.alias("word_chars"),
            n_symbols.alias("n_symbols"),
            n_dup_lines.alias("n_dup_lines"),
            covered.cast("long").alias("n_repeat_words"),
        ).alias(name),
    )
    c = F.col(name)
    failed = (c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])
    measures = {
        "symbols_per_word": _share(c["n_symbols"], c["n_words"]),
        "repeated_lines": _share(c["n_dup_lines"], c["n_lines"]),
        "repeated_words": _share(c["n_repeat_words"], c["n_words"]),
        "word_length": _share(c["word_chars"], c["n_words"]),
    }
    for key, value in {**measures, "base_failed": failed}.items():
        counted = counted.withColumn(name, F.col(name).withField(key, value))
    return counted


def _limits(sketch: Column, key: str) -> Column:
    """Struct of the lower and upper fence that one sketch gives."""
    least = MEASURES[key][2]
    at = lambda q: F.kll_sketch_get_quantile_double(sketch, F.lit(q))
    low, middle, high = at(0.25), at(0.5), at(0.75)
    half = F.least(high - middle, middle - low)
    reach = half + REACH * F.greatest(2 * half, F.lit(least))
    upper = F.array(*map(at, UPPER_RANKS))
    steps = F.zip_with(upper, F.slice(upper, 2, len(UPPER_RANKS) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    gap = F.get(F.filter(steps, lambda s: s["b"] - s["a"] >= 2 * least), F.lit(0))
    drawn_in = F.when(gap.isNotNull(), F.greatest((gap["a"] + gap["b"]) / 2, middle + reach / 2))
    if key not in GAPS:
        drawn_in = F.lit(None).cast("double")
    # Nulls do not count in least and greatest.
    return F.struct((middle - reach).alias("low"), F.least(middle + reach, drawn_in).alias("high"))


def thresholds(documents: DataFrame, name: str) -> DataFrame:
    """Fences per (lang, source) from mergeable sketches, as (fence_lang, fence_source, fences).

    Only documents with words count. Each sketch is built on the map side and merged.
    """
    sketch = lambda key: F.kll_sketch_agg_double(F.col(name)[key], F.lit(SKETCH_K)).alias(key)
    groups = stored(
        documents.filter(F.col(name)["n_words"] > 0)
        .groupBy(F.col("lang").alias("fence_lang"), F.col("source").alias("fence_source"))
        .agg(F.count("*").alias("n"), *map(sketch, MEASURES)),
        "rule-sketches",
    )
    merge = lambda key, to: F.kll_merge_agg_double(F.col(key)).alias(to)
    langs = groups.groupBy(F.col("fence_lang").alias("of_lang")).agg(
        F.sum("n").alias("lang_n"), *[merge(k, f"lang_{k}") for k in MEASURES]
    )
    everything = groups.agg(*[merge(k, f"all_{k}") for k in MEASURES])
    joined = groups.join(langs, groups.fence_lang.eqNullSafe(langs.of_lang)).crossJoin(F.broadcast(everything))

    def fences(key: str) -> Column:
        below, above, _ = MEASURES[key]
        levels = {"n": key, "lang_n": f"lang_{key}", "all": f"all_{key}"}
        limits = {n: _limits(F.col(c), key) for n, c in levels.items()}
        wide = lambda n: F.lit(True) if n == "all" else F.col(n) >= LEAST_GROUP

        def strictest(side: str) -> Column:
            # The limits of the narrowest level with enough documents, bounded by those of the wider ones.
            own = F.when(wide("n"), limits["n"][side]).when(wide("lang_n"), limits["lang_n"][side])
            bounds = [own, F.when(wide("lang_n"), limits["lang_n"][side])]
            every = limits["all"][side]
            bounds.append(F.when(~wide("n") & ~wide("lang_n"), every) if key in OF_LANGUAGE else every)
            return (F.greatest if side == "low" else F.least)(*bounds)

        return F.struct(
            (strictest("low") if below else F.lit(float("-inf"))).alias("low"),
            (strictest("high") if above else F.lit(float("inf"))).alias("high"),
        ).alias(key)

    return joined.select("fence_lang", "fence_source", F.struct(*map(fences, MEASURES)).alias("fences"))


def judged(documents: DataFrame, name: str) -> DataFrame:
    """Measured rows with ``kept`` in the struct ``name``; the rows must be stored, as they are read twice.

    Rows that fail the fixed base rules (few words, mostly repeated words) are not kept. Texts without words fail them.
    """
    fences = stored(thresholds(documents, name), "rule-fences").select(
        F.col("fence_lang").alias(f"{name}_lang"), F.col("fence_source").alias(f"{name}_source"), F.col("fences").alias(f"{name}_fences")
    )
    same = documents["lang"].eqNullSafe(F.col(f"{name}_lang")) & documents["source"].eqNullSafe(F.col(f"{name}_source"))
    limits, own = F.col(f"{name}_fences"), F.col(name)
    inside = ~own["base_failed"]
    for key in MEASURES:
        inside &= F.coalesce(own[key].between(limits[key]["low"], limits[key]["high"]), F.lit(False))
    joined = documents.join(fences, same, "left").withColumn(name, own.withField("kept", inside))
    return joined.select(*[F.col(f"`{c}`") for c in documents.columns])


def quality_rules(documents: DataFrame) -> tuple[DataFrame, str]:
    """All rows with a struct column of counts, measures, base_failed and kept, and that column's name.

    Needs text, lang and source. Every column is kept as it is, repeated rows too; null languages and sources are groups.
    An empty table gives no rows.
    """
    name = free_name(documents.columns, "rules")
    return judged(stored(measured(documents, name), "rule-measures"), name), name


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of every document and whether the rules keep it."""
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    counted = measured(documents, "rules").drop("text")
    rows = judged(stored(counted, "rule-measures"), "rules")
    return rows.select(
        "doc_id",
        *[F.col(f"rules.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        "rules.base_failed",
        "rules.kept",
        *[F.col(f"rules.{c}").alias(c) for c in MEASURES],
    )


def stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pipeline stage: the documents that the rules keep."""
    rows, name = quality_rules(docs)
    return rows.filter(F.col(name)["kept"]).drop(name)
