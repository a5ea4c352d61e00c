"""Quality rules by distribution divergence, in DataFrame functions only.

A document's character classes and its use of common words are compared with those of its language by the
Jensen-Shannon distance (base 2, so 0 to 1). The references are means over all documents of a language that are long
enough, each counting the same. A document too short for a histogram isn't judged by it.

Common words are compared twice: their histogram as a whole, and the share of all of them against all other words, under a
limit that narrows with the number of words, as rare words each weigh next to nothing in the histogram.

Nulls: a null text is an empty one; a null language has no reference, so divergence never rejects; a null doc_id gets its row.
Empty texts have no words and fail the base rules. Repeated rows each get their own verdict, a distance that ties with its limit
keeps the text, very long texts are measured whole, and an empty table gives no rows. Extra columns of the input are left
alone by `filter_documents` and ignored by `measure`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from volcohort.llm.storage import stage
from volcohort.llm.text import boxed, text_of, unboxed, with_windows, words

# Function words of the languages with a word reference.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on", "are", "this", "or", "at"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist", "im", "dem", "nicht", "ein", "eine", "als", "auch"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par", "plus", "pas", "au", "sur"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por", "un", "para", "con", "no", "una", "su", "al", "es"],
}

#: Production parameters. Distances above these reject; texts below the lengths aren't judged.
MAX_CLASS_DISTANCE = 0.25
MAX_WORD_DISTANCE = 0.45
#: A text with fewer common words than its reference goes if the distance of the two shares is above the first value
#: and the second over the root of its words, the noise of a sample.
MAX_SHARE_DISTANCE = 0.1
SHARE_NOISE = 1.2
MIN_BYTES = 200
MIN_WORDS = 40
#: Upper-case, digit and mark characters, further bytes of characters past ASCII, and all other bytes.
CLASSES = 5
#: Documents that a reference needs.
MIN_REFERENCE = 20
#: Languages whose references are sent to every executor; beyond it the references are joined by shuffle.
BROADCAST_LANGS = 4096


def _base(df: DataFrame) -> DataFrame:
    """Counts that need no window over words."""
    t = F.col("_t")
    out = df.withColumn("_t", text_of()).withColumn("_w", words(t)).withColumn("n_words", F.size("_w").cast("long"))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = out.withColumn("_lines", lines)
    return out.withColumns({
        "word_chars": F.length(F.array_join("_w", "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.regexp_replace(t, r"[#*$%&|<>]+", ""))).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
    }).drop("_lines")


def _repeats(df: DataFrame) -> DataFrame:
    """n_repeat_words: words inside 8-word windows that occur twice or more in the text."""
    out = with_windows(df, "_w", 8, "_h")
    out = out.withColumn(
        "_s",
        F.when(
            F.size(F.array_distinct("_h")) < F.size("_h"),
            F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    same = lambda x, j: (x["h"] == F.get("_s", j - 1)["h"]) | (x["h"] == F.get("_s", j + 1)["h"])
    out = out.withColumn("_p", F.sort_array(F.transform(F.filter("_s", same), lambda x: x["i"])))
    gaps = F.transform("_p", lambda p, j: F.least(F.lit(8), F.coalesce(F.get("_p", j + 1) - p, F.lit(8))))
    total = F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)
    return out.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long"))).drop("_h", "_s", "_p")


def _histograms(df: DataFrame) -> DataFrame:
    """_classes: shares of character classes; _common: shares of the language's common words and of all others."""
    t = F.col("_t")
    less = lambda pattern: (F.length(t) - F.length(F.regexp_replace(t, pattern, ""))).cast("double")
    out = df.withColumns({
        "_n": F.octet_length(t).cast("double"), "_upper": less("[A-Z]+"), "_digit": less("[0-9]+"),
        "_marks": less(r"[!-/:-@\[-`{-~]+"), "_far": (F.octet_length(t) - F.length(t)).cast("double"),
    })
    parts = [F.col(c) for c in ("_upper", "_digit", "_marks", "_far")]
    rest = F.col("_n") - sum(parts[1:], parts[0])
    out = out.withColumn("_classes", F.when(F.col("_n") >= MIN_BYTES, F.transform(F.array(*parts, rest), lambda x: x / F.col("_n"))))
    every = sorted({w for ws in COMMON_WORDS.values() for w in ws})
    listed = F.create_map(*[F.lit(x) for k, v in COMMON_WORDS.items() for x in (k, v)])
    out = out.withColumns({"_list": listed[F.coalesce("lang", F.lit(""))], "_a": F.array_remove(F.split(F.lower(t), r"[^\p{L}]+"), "")})
    out = out.withColumns({"_na": F.size("_a").cast("double"), "_c": F.filter("_a", lambda w: w.isin(every))})
    counts = F.transform("_list", lambda r: (F.size("_c") - F.size(F.array_remove("_c", r))).cast("double"))
    out = out.withColumn("_k", F.when((F.col("_na") >= MIN_WORDS) & F.col("_list").isNotNull(), counts))
    used = F.aggregate("_k", F.lit(0.0), lambda a, x: a + x)
    out = out.withColumn("_common", F.transform(F.concat("_k", F.array(F.col("_na") - used)), lambda x: x / F.col("_na")))
    return out.drop("_n", "_upper", "_digit", "_marks", "_far", "_list", "_a", "_c", "_k")


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms of the same length; null if one is."""
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    terms = F.zip_with(p, q, lambda x, y: part(x, (x + y) / 2) + part(y, (x + y) / 2))
    total = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    return F.when(total.isNotNull(), F.sqrt(F.greatest(F.lit(0.0), total / 2)))


def references(docs: DataFrame) -> DataFrame:
    """(ref_lang, ref_classes, ref_common) over all documents: one partial aggregate, as many rows as languages."""
    h = _histograms(docs.select("text", "lang").withColumn("_t", text_of())).select("lang", "_classes", "_common")
    n_common = max(len(v) for v in COMMON_WORDS.values()) + 1
    mean = lambda col, i: F.avg(F.get(F.col(col), F.lit(i)))
    found = h.where("lang is not null").groupBy("lang").agg(
        *[mean("_classes", i).alias(f"c{i}") for i in range(CLASSES)], *[mean("_common", i).alias(f"w{i}") for i in range(n_common)],
        F.count("_classes").alias("nc"), F.count("_common").alias("nw"),
    )
    return found.select(
        F.col("lang").alias("ref_lang"),
        F.when(F.col("nc") >= MIN_REFERENCE, F.array(*[f"c{i}" for i in range(CLASSES)])).alias("ref_classes"),
        F.when(F.col("nw") >= MIN_REFERENCE, F.array(*[f"w{i}" for i in range(n_common)])).alias("ref_common"),
    )


def _few_common() -> Column:
    """Whether a text holds too few common words: their share against all others, as rare words each weigh next to nothing."""
    rest, ref = F.element_at("_common", -1), F.element_at("ref_common", -1)
    far = distance(F.array(1 - rest, rest), F.array(1 - ref, ref)) > MAX_SHARE_DISTANCE + SHARE_NOISE / F.sqrt("_na")
    return F.coalesce((rest > ref) & far, F.lit(False))


def apply_rules(docs: DataFrame) -> DataFrame:
    """`docs` (text, lang and any other columns) with the counts, the distances, base_failed and kept."""
    ref = stage(references(docs), "quality-references")
    ref = F.broadcast(ref) if ref.limit(BROADCAST_LANGS + 1).count() <= BROADCAST_LANGS else ref
    out = _repeats(_base(docs)).drop("_w")
    out = _histograms(out).join(ref, F.col("lang") == F.col("ref_lang"), "left")
    out = out.withColumns({
        "class_distance": distance(F.col("_classes"), F.col("ref_classes")),
        "word_distance": distance(F.col("_common"), F.col("ref_common")),
        "base_failed": (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")),
    })
    far = (F.coalesce("class_distance", F.lit(0.0)) > MAX_CLASS_DISTANCE) | (F.coalesce("word_distance", F.lit(0.0)) > MAX_WORD_DISTANCE)
    far = far | _few_common()
    # A generator between: a filter on `kept` would else be pushed down with every expression copied into it, many times over.
    return out.withColumn("kept", F.explode(F.array(~F.col("base_failed") & ~far))).drop("_t", "_classes", "_common", "_na", "ref_lang", "ref_classes", "ref_common")


def measure(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, counts, distances and verdicts."""
    out = apply_rules(docs.select("doc_id", "text", "lang"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "word_distance")


def filter_documents(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with the columns they came with."""
    return unboxed(apply_rules(boxed(docs, "text", "lang")).where("kept"), docs)
