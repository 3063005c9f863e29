"""Quality rules: divergence of a document's histograms from its language's.

A document is counted into a histogram of character classes and one of common
words.  The same counts, summed over the documents of a language that pass the
base rules, are the language's reference; it is summed a second time over the
documents that the first reference keeps, so that bad documents do not bend it.
Where the first keeps less than half of a language's texts, bad documents have
bent it too far, and the second is summed over the nearer half instead.  Equal
texts together weigh at most one in ``HEAVY`` parts of a reference's counts.
A document is kept if both Jensen-Shannon distances to its reference stay under
their limits; a histogram of too few characters or words is not judged.  A
limit has a part that shrinks with the root of the histogram's size, as the
distance of a random sample does.

A language, or the lack of one, has a reference if ``LEAST_TEXTS`` different
texts of it pass the base rules.  Documents of other languages are held against
the references of all languages that have one, and kept if one of them keeps
them; if no language has a reference, all documents share one.
Null and empty texts have no words and fail the base rules.  Repeated rows are
judged one by one; further columns are ignored.  Windows of three words and
equal texts are told by 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common

# Rules every document has to pass.
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
SYMBOLS = "[#*$%&|<>]"

#: Character classes; a last class takes all other characters.
CLASSES = {
    "lower": "a-z",
    "blank": r"\x20\x09-\x0D",
    "upper": "A-Z",
    "digit": "0-9",
    "stop": r".,;:!?()\-",
    "symbol": "#*$%&|<>",
    "wide": r"\x{80}-\x{10FFFF}",
}

# Frequent function words of four languages.
COMMON_WORDS = {
    "en": "the of and to in a is that it was for on are with as be by this from have".split(),
    "fr": "le la les de des et un une du en que qui est dans pour au sur par il ne".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al".split(),
}
WORDS = sorted({word for words in COMMON_WORDS.values() for word in words})
# Common words count in lower case, capitalized and in upper case.
SPELLINGS = sorted({form for word in WORDS for form in (word, word.capitalize(), word.upper())})

#: Limits of the two distances (0 to 1): a constant part, and one that is divided by the root of the count.
#: Histograms of fewer characters or words are not judged.
CHAR_LIMIT = 0.14
CHAR_NOISE = 3.0
WORD_LIMIT = 0.18
WORD_NOISE = 1.6
ROUNDS = 2
LEAST_CHARS = 200
LEAST_JUDGED_WORDS = 50
#: Different texts that a reference rests on at least, and the part of it that equal texts make up at most.
LEAST_TEXTS = 10
HEAVY = 10
#: Steps of the distance, in parts of its limit, in which the nearer half of a language is sought.
STEPS = 100


def repeated_words(words: Column, windows: Column) -> Column:
    """Words in windows that occur twice or more; ``windows`` holds a hash per start."""
    last = F.size(windows) - 1
    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeats(pair, k, ordered):
        before = (k > 0) & (F.get(ordered, k - 1)["h"] == pair["h"])
        after = (k < last) & (F.get(ordered, k + 1)["h"] == pair["h"])
        return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

    # One lambda binds the sorted pairs, so that they are sorted once.
    starts = F.get(
        F.transform(
            F.array(pairs),
            lambda ordered: F.sort_array(
                F.transform(F.filter(ordered, lambda pair, k: repeats(pair, k, ordered)), lambda pair: pair["i"])
            ),
        ),
        F.lit(0),
    )
    state = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("at"))
    covered = F.aggregate(
        starts,
        state,
        lambda s, i: F.struct((s["n"] + F.least(F.lit(3), i - s["at"])).alias("n"), i.alias("at")),
        lambda s: s["n"],
    )
    distinct = F.size(F.array_distinct(windows)) == F.size(windows)
    return F.when(distinct, F.lit(0)).otherwise(covered)


def with_features(rows: DataFrame, text: Column) -> DataFrame:
    """``rows`` with counts and histograms of ``text`` (names start with ``_``)."""
    cut = F.btrim("_text", F.lit(common.BLANKS))
    split = F.when(F.length(F.col("_cut")) > 0, F.split("_cut", f"{common.BLANK}+")).otherwise(
        F.array().cast("array<string>")
    )
    # The two large classes are cut out first, which leaves a short text to count the others in.
    without = lambda name, inside: F.regexp_replace(F.col(name), f"[{inside}]+", "")
    left = lambda inside: F.length(F.regexp_replace(F.col("_marks"), f"[^{inside}]+", ""))
    lines = F.filter(F.split("_text", "\n"), lambda line: line.rlike(common.WORD))
    word = lambda i: F.get(F.col("_words"), i)
    windows = F.when(
        F.size("_words") >= 3,
        F.transform(F.sequence(F.lit(0), F.size("_words") - 3), lambda i: F.xxhash64(word(i), word(i + 1), word(i + 2))),
    ).otherwise(F.array().cast("array<bigint>"))
    lowered = F.transform(F.filter("_words", lambda w: w.isin(SPELLINGS)), F.lower)
    # Common words as one text, each between commas, in which a word is counted by leaving it out.
    joined = F.concat(F.lit(","), F.array_join("_common", ",,"), F.lit(","))
    times = lambda w: (
        F.length("_joined") - F.length(F.replace(F.col("_joined"), F.lit(f",{w},"), F.lit("")))
    ) / F.lit(len(w) + 2)
    rest = lambda total, parts: F.concat(
        parts, F.array(total - F.aggregate(parts, F.lit(0).cast("long"), lambda s, x: s + x))
    )
    kinds = F.array(
        (F.col("_n_chars") - F.length("_solid")).cast("long"),
        (F.length("_solid") - F.length("_marks")).cast("long"),
        *[left(inside).cast("long") for name, inside in CLASSES.items() if name not in ("lower", "blank")],
    )
    return (
        rows.withColumn("_text", F.coalesce(text, F.lit("")))
        .withColumn("_cut", cut)
        .withColumn("_lines", lines)
        .withColumn("_words", split)
        .withColumn("_windows", windows)
        .withColumn("_common", lowered)
        .withColumn("_joined", joined)
        .withColumn("_solid", without("_text", CLASSES["lower"]))
        .withColumn("_marks", without("_solid", CLASSES["blank"]))
        .withColumn("_n_chars", F.length("_text").cast("long"))
        .withColumn("_kinds", kinds)
        .withColumn("_times", F.array(*[times(w).cast("long") for w in WORDS]))
        .withColumn("_n_words", F.size("_words").cast("long"))
        .withColumn("_n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .withColumn("_n_repeat_words", repeated_words(F.col("_words"), F.col("_windows")).cast("long"))
        .drop("_text", "_cut", "_lines", "_words", "_windows", "_common", "_joined", "_solid", "_marks")
        .withColumn("_char_counts", rest(F.col("_n_chars"), F.col("_kinds")))
        .withColumn("_word_counts", rest(F.col("_n_words"), F.col("_times")))
        .withColumn("_word_chars", F.col("_n_chars") - F.get("_kinds", F.lit(list(CLASSES).index("blank"))))
        .withColumn("_n_symbols", F.get("_kinds", F.lit(list(CLASSES).index("symbol"))))
        .withColumn(
            "_base_failed",
            (F.col("_n_words") < LEAST_WORDS)
            | (100 * F.col("_n_repeat_words") > MOST_REPEATED_PERCENT * F.col("_n_words")),
        )
        .drop("_kinds", "_times")
    )


def distance(counts: Column, total: Column, reference: Column, reference_total: Column) -> Column:
    """Jensen-Shannon distance of two histograms with as many counts and known totals; null if one is empty."""
    summed = lambda c: F.aggregate(c, F.lit(0).cast("double"), lambda s, x: s + x)
    share = lambda c, n: F.transform(c, lambda x: x / n)

    def part(pair):
        p, q = pair["p"], pair["q"]
        side = lambda x: F.when(x > 0, x * F.log2(2 * x / (p + q))).otherwise(F.lit(0.0))
        return (side(p) + side(q)) / 2

    pairs = F.zip_with(share(counts, total), share(reference, reference_total), lambda p, q: F.struct(p.alias("p"), q.alias("q")))
    return F.sqrt(F.greatest(F.lit(0.0), summed(F.transform(pairs, part))))


def references(chosen: DataFrame) -> DataFrame:
    """Summed histograms of ``chosen`` as struct ``reference`` for each ``_of``."""
    texts = chosen.filter("_of is not null").groupBy("_of", "_key")
    texts = common.stored(texts.agg(F.sum("_n_chars").alias("chars"), F.sum("_n_words").alias("words")), "quality-texts")
    totals = texts.groupBy(F.col("_of").alias("in")).agg(F.sum("chars").alias("c"), F.sum("words").alias("w"))
    # What equal texts have beyond their part is scaled down, as a whole.
    part = lambda total, own: F.least(F.lit(1.0), F.col(total) / (HEAVY * F.col(own)))
    heavy = (
        texts.join(totals, F.col("_of") == F.col("in"))
        .filter(((HEAVY * F.col("chars")) > F.col("c")) | ((HEAVY * F.col("words")) > F.col("w")))
        .select("in", F.col("_key").alias("heavy"), part("c", "chars").alias("char_part"), part("w", "words").alias("word_part"))
    )
    heavy = common.stored(heavy, "quality-heavy")
    summed = lambda name, n: F.array(*[F.sum(F.get(name, F.lit(i))) for i in range(n)])
    scaled = lambda name, part: F.transform(
        name, lambda n: F.when(F.col(part).isNull(), n).otherwise(F.floor(n * F.col(part)))
    )
    total = lambda name: F.aggregate(name, F.lit(0).cast("long"), lambda s, n: s + n)
    sides = {"chars": len(CLASSES) + 1, "words": len(WORDS) + 1}
    return (
        chosen.filter("_of is not null")
        .join(heavy, (F.col("_of") == F.col("in")) & (F.col("_key") == F.col("heavy")), "left")
        .groupBy("_of", "heavy", "char_part", "word_part")
        .agg(summed("_char_counts", sides["chars"]).alias("chars"), summed("_word_counts", sides["words"]).alias("words"))
        .withColumns({"chars": scaled("chars", "char_part"), "words": scaled("words", "word_part")})
        .groupBy("_of")
        .agg(*[summed(name, n).alias(name) for name, n in sides.items()])
        .select(
            F.col("_of").alias("of"),
            F.struct("chars", "words", total("chars").alias("n_chars"), total("words").alias("n_words")).alias("reference"),
        )
    )


def nearer_half(judged: DataFrame, good: Column) -> DataFrame:
    """``half``, the step of the median text, for each reference ``of`` that keeps less than half of its texts."""
    texts = (
        judged.filter(~F.col("_base_failed") & F.col("_of").isNotNull())
        .groupBy("_of", "_key")
        .agg(F.min("_step").alias("step"), F.max(good.cast("int")).alias("good"))
    )
    steps = texts.groupBy("_of", "step").agg(F.count("*").alias("n"), F.sum("good").alias("good"))
    every, so_far = Window.partitionBy("_of"), Window.partitionBy("_of").orderBy("step")
    return (
        steps.select("_of", "step", *[F.sum(c).over(every).alias(f"all_{c}") for c in ("n", "good")], F.sum("n").over(so_far).alias("n"))
        .filter("2 * all_good < all_n and 2 * n >= all_n")
        .groupBy(F.col("_of").alias("at"))
        .agg(F.min("step").alias("half"))
    )


def judge(
    documents: DataFrame,
    char_limit: float = CHAR_LIMIT,
    char_noise: float = CHAR_NOISE,
    word_limit: float = WORD_LIMIT,
    word_noise: float = WORD_NOISE,
    least_chars: int = LEAST_CHARS,
    least_words: int = LEAST_JUDGED_WORDS,
    keep: list[str] = ("doc_id",),
) -> DataFrame:
    """The columns ``keep`` of every document as struct ``row``, counts, distances and verdict."""
    rows = documents.select(
        F.struct(*[F.col(f"`{name}`") for name in keep]).alias("row"),
        F.col("lang").cast("string").alias("lang"),
        F.col("text").cast("string").alias("text"),
        F.xxhash64(F.col("text").cast("string")).alias("_key"),
    )
    features = common.stored(with_features(rows, F.col("text")).drop("text"), "quality-features", compression="zstd")
    texts = features.filter(~F.col("_base_failed")).groupBy("lang", "_key").agg(F.lit(1))
    known = texts.groupBy(F.col("lang").alias("known")).agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_TEXTS)
    place = F.row_number().over(Window.orderBy(F.desc("n"), "known"))
    known = common.stored(known.select("known", place.alias("_of")), "quality-languages")
    if known.isEmpty():
        features = features.withColumn("_of", F.lit(1))
    else:
        features = features.join(known, F.col("lang").eqNullSafe(F.col("known")), "left").drop("known")

    char_most = F.lit(char_limit) + F.try_divide(F.lit(char_noise), F.sqrt("_n_chars"))
    word_most = F.lit(word_limit) + F.try_divide(F.lit(word_noise), F.sqrt("_n_words"))
    none = F.lit(0.0)

    def against(reference):
        chars = distance(F.col("_char_counts"), F.col("_n_chars"), reference["chars"], reference["n_chars"])
        words = distance(F.col("_word_counts"), F.col("_n_words"), reference["words"], reference["n_words"])
        return F.struct(
            F.when(F.col("_n_chars") >= least_chars, chars).alias("char_distance"),
            F.when(F.col("_n_words") >= least_words, words).alias("word_distance"),
        )

    # Of several references the one whose limits are kept best.
    over = lambda d: F.greatest(
        F.coalesce(d["char_distance"] / char_most, none), F.coalesce(d["word_distance"] / word_most, none)
    )
    least = lambda ds: F.array_min(F.transform(ds, lambda d: F.struct(over(d).alias("over"), d.alias("d"))))["d"]
    far = (F.col("char_distance") > char_most) | (F.col("word_distance") > word_most)
    good = ~F.col("_base_failed") & ~F.coalesce(far, F.lit(False))
    judged, passing = features, ~F.col("_base_failed")
    for turn in range(ROUNDS):
        found = common.stored(references(judged.filter(passing)), "quality-references")
        others = found.agg(F.sort_array(F.collect_list("reference")).alias("others"))
        held = features.join(found, F.col("_of") == F.col("of"), "left").join(others, F.col("_of").isNull(), "left")
        judged = (
            held.withColumn(
                "_near",
                F.when(F.col("of").isNotNull(), against(F.col("reference"))).otherwise(least(F.transform("others", against))),
            )
            .withColumn("char_distance", F.col("_near.char_distance"))
            .withColumn("word_distance", F.col("_near.word_distance"))
            .drop("of", "reference", "others", "_near")
        )
        if turn < ROUNDS - 1:
            step = F.floor(F.least(F.lit(1e6), over({c: F.col(c) for c in ("char_distance", "word_distance")})) * STEPS)
            # What is kept of a document is read from its features again; only counts and steps are stored here.
            judged = common.stored(judged.withColumn("_step", step).drop("row"), "quality-judged")
            half = common.stored(nearer_half(judged, good), "quality-halves")
            judged = judged.join(half, F.col("_of") == F.col("at"), "left")
            passing = ~F.col("_base_failed") & F.when(F.col("half").isNull(), good).otherwise(F.col("_step") <= F.col("half"))
    return judged.select(
        "row",
        F.col("_n_words").alias("n_words"),
        F.col("_word_chars").alias("word_chars"),
        F.col("_n_symbols").alias("n_symbols"),
        F.col("_n_dup_lines").alias("n_dup_lines"),
        F.col("_n_repeat_words").alias("n_repeat_words"),
        F.col("_base_failed").alias("base_failed"),
        "char_distance",
        "word_distance",
        good.alias("kept"),
    )


def keep_good(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` that the rules keep."""
    return judge(documents, keep=documents.columns).filter("kept").select("row.*")
