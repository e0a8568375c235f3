"""Quality rules by distribution divergence, in built-in expressions only.

A text is described by two histograms: of its character classes, and of how often
the common words of its language stand in it. Both are compared with those of all
texts of the language by Jensen-Shannon distance. Texts with few words, and word
histograms with few common words, are not judged by it: a short text is far from
every reference by chance.

Everything about a text is computed within its row; one small table of reference
histograms, a row per known language, is all that meets the rows again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramledger.llm.text import stored, without_rows

WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20  # per cent of the words
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\f\r"

# Guards and limits of the divergence rules; distances are between 0 and 1.
JUDGED_WORDS = 50  # least words for a judgement by character classes
JUDGED_COMMON = 20  # least common words for one by the word histogram
CLASS_LIMIT = 0.35
COMMON_LIMIT = 0.60

# Character classes, as runs of characters to strip for counting; the rest is "other".
CLASSES = {
    "lower": "[^a-z]+", "upper": "[^A-Z]+", "digit": "[^0-9]+", "space": "[^ \\t\\n\\x0B\\f\\r]+",
    "stop": "[^.,;:!?]+", "symbol": "[^#*$%&|<>]+", "beyond": "[\\x00-\\x7F]+",
}

# Common words of the languages there are references for.
COMMON = {
    "de": "auf das der des die ein eine für ist mit nicht sich und von zu",
    "en": "a and are as be by for from in is it of on or that the this to was with",
    "es": "al con de del el en es la las lo los no para por que se su un una y",
    "fr": "au avec dans de des du en est et la le les par pas pour que qui sur un une",
}


MOST_COMMON = max(len(words.split()) for words in COMMON.values())


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    """Runs of anything but ASCII white space."""
    inner = F.btrim(text, F.lit(SPACES))
    return F.when(F.length(inner) > 0, F.split(inner, "[ \\t\\n\\x0B\\f\\r]+")).otherwise(F.array().cast("array<string>"))


def repeated_words(words: Column) -> Column:
    """How many words are in a window of WINDOW words that stands twice or more."""
    starts = F.sequence(F.lit(0), F.size(words) - WINDOW)

    def positions(hashes: Column) -> Column:
        """Where windows that stand elsewhere too begin, in order: equal hashes are neighbours once sorted."""
        paired = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return bound(paired, lambda p: F.array_sort(F.filter(
            F.transform(p, lambda x, i: F.when(
                (F.get(p, i - 1)["h"] == x["h"]) | (F.get(p, i + 1)["h"] == x["h"]), x["i"])),
            lambda x: x.isNotNull())))

    def covered(at: Column) -> Column:
        return F.aggregate(
            F.transform(at, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - x, F.lit(WINDOW)))),
            F.lit(0).cast("bigint"), lambda total, n: total + n)

    def count(hashes: Column) -> Column:
        twice = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(twice, bound(positions(hashes), covered)).otherwise(F.lit(0).cast("bigint"))

    # Words are hashed first: a window is then hashed from numbers.
    def windows(numbers: Column) -> Column:
        return F.transform(starts, lambda i: F.xxhash64(*(F.get(numbers, i + k) for k in range(WINDOW))))

    hashed = bound(F.transform(words, lambda w: F.xxhash64(w)), windows)
    return F.when(F.size(words) >= WINDOW, bound(hashed, count)).otherwise(F.lit(0).cast("bigint"))


def duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0)
    return bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint")


def common_places(words: Column, listed: list[str]) -> Column:
    """Which of the listed words, from 1, stand in a text, in its order."""
    common = F.array(*(F.lit(w) for w in listed))
    return F.filter(F.transform(words, lambda w: F.array_position(common, F.lower(w)).cast("int")), lambda p: p > 0)


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def described(docs: DataFrame, doc_id: str, text: str, lang: str) -> DataFrame:
    """The counts of every text, a row per row of docs."""
    t = F.col("text")
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).cast("string").alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    known = F.when(F.col("lang").isin(*COMMON), F.col("lang"))
    docs = docs.select("doc_id", known.alias("lang"), "text", words_of(t).alias("words"))
    places = F.lit(None).cast("array<int>")
    for name, listed in COMMON.items():
        places = F.when(F.col("lang") == name, common_places(F.col("words"), listed.split())).otherwise(places)
    docs = docs.select(
        "doc_id", "lang", F.size("words").cast("bigint").alias("n_words"),
        F.length(without(t, SPACES)).cast("bigint").alias("word_chars"),
        (F.length(t) - F.length(without(t, SYMBOLS))).cast("bigint").alias("n_symbols"),
        duplicate_lines(t).alias("n_dup_lines"), repeated_words(F.col("words")).alias("n_repeat_words"),
        F.length(t).cast("bigint").alias("chars"),
        F.array(*(F.length(F.regexp_replace(t, pattern, "")).cast("bigint") for pattern in CLASSES.values())).alias("classes"),
        # A letter for every common word: how often each stands is then a difference of lengths.
        F.array_join(F.transform(places, lambda p: F.char(p + 64)), "").alias("common"),
    )
    counts = F.array(*(
        (F.length("common") - F.length(F.replace("common", F.lit(chr(65 + k)), F.lit("")))).cast("bigint") for k in range(MOST_COMMON)
    ))
    classes = F.col("classes")
    rest = F.col("chars") - F.aggregate(classes, F.lit(0).cast("bigint"), lambda total, n: total + n)
    return docs.withColumns({"classes": F.concat(classes, F.array(rest)), "common": counts}).drop("chars")


def references(rows: DataFrame) -> DataFrame:
    """The histograms of all texts of each known language; as many rows as COMMON has languages."""

    def sums(column: str, n: int) -> Column:
        return F.array(*(F.sum(F.get(column, F.lit(k))) for k in range(n)))

    return rows.where(F.col("lang").isNotNull()).groupBy("lang").agg(
        sums("classes", len(CLASSES) + 1).alias("all_classes"), sums("common", MOST_COMMON).alias("all_common"))


def total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("bigint"), lambda t, n: t + n)


def distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of two histograms, with logarithms to base 2: 0 to 1."""

    def shares(histogram: Column) -> Column:
        return bound(F.greatest(total(histogram), F.lit(1)), lambda n: F.transform(histogram, lambda x: x / n))

    def part(p: Column, q: Column) -> Column:
        return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0)

    parts = F.zip_with(shares(counts), shares(reference), lambda p, q: part(p, q) + part(q, p))
    return F.sqrt(F.greatest(F.aggregate(parts, F.lit(0.0), lambda t, x: t + x) / 2, F.lit(0.0)))


def judge(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept and the two distances.

    base_failed: fewer than 10 words, or more than a fifth of them in repeated windows.
    kept: not base_failed, and near enough to its language. Distances are null where
    they are not judged: under JUDGED_WORDS words or JUDGED_COMMON common words, and
    for a null or unknown lang; such texts are kept unless base_failed.

    A null text is an empty one. Repeated rows count as often as they stand, and a
    null doc_id stays null. An empty table gives no rows. Other columns are not read.
    """
    rows = stored(described(docs, doc_id, text, lang), "quality")
    # A row for each language of COMMON at most: that is the bound for sending them to all tasks.
    known = F.broadcast(references(rows).withColumnRenamed("lang", "r_lang"))
    rows = rows.join(known, rows.lang == known.r_lang, "left")
    long_enough = (F.col("n_words") >= JUDGED_WORDS) & F.col("r_lang").isNotNull()
    rows = rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))).alias("base_failed"),
        F.when(long_enough, distance(F.col("classes"), F.col("all_classes"))).alias("class_distance"),
        F.when(long_enough & (total(F.col("common")) >= JUDGED_COMMON), distance(F.col("common"), F.col("all_common"))).alias("common_distance"),
    )
    near = (F.coalesce("class_distance", F.lit(0.0)) <= CLASS_LIMIT) & (F.coalesce("common_distance", F.lit(0.0)) <= COMMON_LIMIT)
    return rows.withColumn("kept", ~F.col("base_failed") & near)


def keep_good(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """docs without the rows judge() does not keep. Rows that share a doc_id, or have none, are judged each for itself."""
    key = F.xxhash64(F.col(text), F.col(lang))
    rows = docs.select(F.struct(F.col(doc_id).alias("id"), key.alias("key")).alias("row"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    bad = judge(rows, doc_id="row", text="text", lang="lang").where("NOT kept").select("doc_id.id", "doc_id.key")
    return without_rows(docs, bad, F.col(doc_id), key)


def oracle_sql(table: str = "documents") -> str:
    """DuckDB SQL for judge() without the distances."""
    space = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    lists = " ".join(f"WHEN '{lang}' THEN [{', '.join(repr(w) for w in words.split())}]" for lang, words in COMMON.items())
    classes = ", ".join(f"length(regexp_replace(t, '{pattern}', '', 'g'))" for pattern in CLASSES.values())
    common = ", ".join(f"len(list_filter(c, lambda x: x = {k}))" for k in range(1, MOST_COMMON + 1))

    def js(own: str, every: str) -> str:
        def share(h: str) -> str:
            return f"list_transform({h}, lambda x: x / greatest(list_sum({h}), 1))"

        def part(p: str, q: str) -> str:
            return f"CASE WHEN {p} > 0 THEN {p} * log2(2 * {p} / ({p} + {q})) ELSE 0 END"

        return (f"sqrt(greatest(list_sum(list_transform(list_zip({share(own)}, {share(every)}), "
                f"lambda z: {part('z[1]', 'z[2]')} + {part('z[2]', 'z[1]')})) / 2, 0))")

    sums = {c: ", ".join(f"sum({c}[{k}])" for k in range(1, n + 1)) for c, n in (("classes", len(CLASSES) + 1), ("common", MOST_COMMON))}
    return f"""
        WITH d AS (SELECT doc_id, lang, COALESCE(text, '') AS t FROM {table}),
        w AS (SELECT doc_id, t, CASE WHEN lang IN ({', '.join(repr(x) for x in COMMON)}) THEN lang END AS lang,
            regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w,
            list_filter(string_split(t, chr(10)), lambda x: length(trim(x, {space})) > 0) AS lines FROM d),
        grams AS (SELECT doc_id, p, array_to_string(w[p : p + {WINDOW - 1}], ' ') AS g
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW} + 2)) AS p FROM w WHERE len(w) >= {WINDOW})),
        twice AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
        repeated AS (SELECT doc_id, count(DISTINCT x) AS n FROM (SELECT doc_id, unnest(range(p, p + {WINDOW})) AS x FROM twice) GROUP BY doc_id),
        h AS (SELECT *, list_filter(list_transform(w, lambda x: list_position(CASE lang {lists} END, lower(x))), lambda x: x > 0) AS c,
            [{classes}] AS cls FROM w),
        counted AS (SELECT *, list_append(cls, length(t) - list_sum(cls)) AS classes, [{common}] AS common FROM h),
        reference AS (SELECT lang, [{sums['classes']}] AS all_classes, [{sums['common']}] AS all_common
            FROM counted WHERE lang IS NOT NULL GROUP BY lang),
        judged AS (SELECT c.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
            (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
            (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, COALESCE(n, 0)::BIGINT AS n_repeat_words,
            len(w) < {LEAST_WORDS} OR 100 * COALESCE(n, 0) > {MOST_REPEATED} * len(w) AS base_failed,
            CASE WHEN len(w) >= {JUDGED_WORDS} AND r.lang IS NOT NULL THEN {js('classes', 'all_classes')} END AS class_distance,
            CASE WHEN len(w) >= {JUDGED_WORDS} AND r.lang IS NOT NULL AND list_sum(common) >= {JUDGED_COMMON}
                THEN {js('common', 'all_common')} END AS common_distance
            FROM counted c LEFT JOIN reference r ON r.lang = c.lang LEFT JOIN repeated ON repeated.doc_id = c.doc_id)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
            NOT base_failed AND COALESCE(class_distance, 0) <= {CLASS_LIMIT} AND COALESCE(common_distance, 0) <= {COMMON_LIMIT} AS kept
        FROM judged"""
