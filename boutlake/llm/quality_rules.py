"""Quality rules: counts within a text, and its distance from its language's usual text.

References are pooled over all documents of a language: shares of six character classes, and of its
commonest words made of letters. A document's distance from each is the Jensen-Shannon distance (root of the
divergence in bits, 0 to 1). How far is too far follows from the language's own documents: beyond the upper
quartile of their distances by so many times the spread between the quartiles (``CHARACTER_SPREADS``,
``WORD_SPREADS``). Quartiles are those of all texts that are judged, each different text once, in steps of a
thousandth; those of all languages together count as ``pooled`` more texts of each, so that a language of few
texts is judged too. The word limit is also at most ``own_share`` of the distance that a text with none of its
language's common words has. Texts too short to say are not judged: ``guard`` words at least.

DataFrame functions throughout, and two passes over the texts: one counts words and classes of each language,
combined in each task before they are shuffled; the other counts within each text and measures. Quartiles and
verdicts are taken from the measures, which hold no text. Every language has a reference of its own (some
seventy numbers), joined by lang; the planner chooses how.

A null text has no words, like an empty one; a null language is one language, the same as an empty name; very
long texts are read whole; doc_id may be null and of any type; repeated rows each get a result; extra columns
are left out, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boutlake.llm.common import GAP, materialize

SPAN = 8
LEAST_WORDS = 20
REPEAT_PERCENT = 30
COMMON = 32
GUARD = 50
#: Spreads beyond the upper quartile at which a text is too far from its language, and the least that a spread counts as.
CHARACTER_SPREADS = 6
CHARACTER_SPREAD = 0.02
WORD_SPREADS = 2
WORD_SPREAD = 0.05
#: Texts of all languages together that count beside a language's own.
POOLED = 20
#: Steps of a distance for its quartiles.
STEPS = 1000
#: Part of the word distance of a text with none of its language's common words.
OWN_SHARE = 0.9
_HAS_WORD = r"[^\x20\x09-\x0D]"
_LETTERS = r"^\p{L}+$"
CLASSES = ("lower", "upper", "digit", "gap", "mark", "other")


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def with_classes(docs: DataFrame) -> DataFrame:
    """docs (text) with n_lower … n_other: code points of each class, and n_symbols. Each step takes a class out of what is left."""
    left = {"lower": "[a-z]+", "upper": "[A-Z]+", "digit": "[0-9]+", "gap": GAP, "mark": r"[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+"}
    rows, before = docs.withColumn("_t", _text()), "_t"
    for name, pattern in left.items():
        rows = rows.withColumn(f"_{name}", F.regexp_replace(before, pattern, ""))
        before = f"_{name}"
    steps = ["_t", *(f"_{x}" for x in left)]
    counts = {f"n_{x}": (F.length(a) - F.length(b)).cast("long") for x, a, b in zip(left, steps, steps[1:], strict=False)}
    symbols = F.length("_gap") - F.length(F.translate(F.col("_gap"), "#*$%&|<>", ""))
    return rows.withColumns(counts | {"n_other": F.length("_mark").cast("long"), "n_symbols": symbols.cast("long")}).drop(*steps)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, GAP), "")


def language_references(docs: DataFrame, common: int = COMMON) -> DataFrame:
    """lang, classes (share of each), common (words), usual (share of each common word, then of all others); a row for every lang.

    Words and classes are counted together: each document adds an empty word, which carries its classes.
    """
    rows = with_classes(docs.select(F.coalesce(F.col("lang"), F.lit("")).alias("lang"), "text")).withColumn("words", words_of(_text()))
    each = rows.select("lang", F.size("words").cast("long").alias("n_words"), *(f"n_{c}" for c in CLASSES), F.explode(F.concat(F.array(F.lit("")), F.col("words"))).alias("word"))
    whole = F.col("word") == ""
    counts = each.groupBy("lang", "word").agg(F.count("*").alias("n"), *(F.sum(F.when(whole, F.col(f"n_{c}"))).alias(c) for c in CLASSES), F.sum(F.when(whole, F.col("n_words"))).alias("words"))
    top = counts.where(whole | F.col("word").rlike(_LETTERS)).withColumn("whole", whole)
    top = top.withColumn("r", F.row_number().over(Window.partitionBy("lang", "whole").orderBy(F.col("n").desc(), "word"))).where(F.col("r") <= common)
    refs = top.groupBy("lang").agg(*(F.sum(c).alias(c) for c in (*CLASSES, "words")), F.array_sort(F.collect_list(F.when(~F.col("whole"), F.struct("r", "word", "n")))).alias("top"))
    chars = sum((F.col(c) for c in CLASSES[1:]), F.col(CLASSES[0]))
    shares = F.transform("top", lambda x: x["n"] / F.greatest("words", F.lit(1)))
    return refs.select(
        "lang", F.array(*(F.col(c) / F.greatest(chars, F.lit(1)) for c in CLASSES)).alias("classes"), F.transform("top", lambda x: x["word"]).alias("common"),
        F.concat(shares, F.array(F.lit(1.0) - F.aggregate(shares, F.lit(0.0), lambda s, x: s + x))).alias("usual"),
    )


def js_distance(p: Column, q: Column) -> Column:
    """Root of the Jensen-Shannon divergence in bits of two distributions given as arrays."""
    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(a / ((a + b) / 2))).otherwise(F.lit(0.0))

    terms = F.zip_with(p, q, lambda a, b: (part(a, b) + part(b, a)) / 2)
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)))


def repeated_words(words: Column, hashes: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more; each adds what the next does not cover."""
    n = F.size(hashes)
    placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    def twice(x: Column, i: Column, rows: Column) -> Column:
        before = F.get(rows, i - 1)["h"] == x["h"]
        after = F.get(rows, i + 1)["h"] == x["h"]
        return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

    # Inside one-element transforms, so that the sorted rows are made once.
    places = F.get(F.transform(F.array(placed), lambda rows: F.sort_array(F.transform(F.filter(rows, lambda x, i: twice(x, i, rows)), lambda x: x["i"]))), 0)
    covered = F.get(F.transform(F.array(places), lambda at: F.aggregate(at, F.struct(F.lit(0).alias("sum"), F.lit(-SPAN).alias("end")), lambda s, p: F.struct(
        (s["sum"] + p + SPAN - F.greatest(p, s["end"])).alias("sum"), (p + SPAN).alias("end")))["sum"]), 0)
    return F.when(F.coalesce(n > F.size(F.array_distinct(hashes)), F.lit(False)), covered).otherwise(F.lit(0))


def measured(docs: DataFrame, refs: DataFrame) -> DataFrame:
    """lang, doc_id, text_key, the counts, base_failed, character_distance, word_distance, none_distance of each row of docs.

    none_distance is the word distance of a text with none of its language's common words.
    """
    rows = with_classes(docs.select("doc_id", "text", F.coalesce(F.col("lang"), F.lit("")).alias("lang")))
    rows = rows.join(refs.select("lang", F.struct("classes", "common", "usual").alias("_r")), "lang", "left")
    lines = F.filter(F.split(_text(), "\n", -1), lambda x: x.rlike(_HAS_WORD))
    rows = rows.withColumn("_words", words_of(_text())).withColumn("_lines", lines)
    rows = rows.withColumn("_h", F.transform("_words", lambda w: F.xxhash64(w)))
    # Words are hashed once, and taken inside one-element transforms, so that no hash is made again for each window.
    windows = F.get(F.transform(F.array("_h"), lambda h: F.transform(F.sequence(F.lit(1), F.size(h) - (SPAN - 1)), lambda i: F.xxhash64(F.slice(h, i, SPAN)))), 0)
    # No word longer than the longest common one is looked up among them.
    longest = F.coalesce(F.array_max(F.transform("_r.common", lambda c: F.length(c))), F.lit(0))
    usual = F.get(F.transform(F.array(longest), lambda most: F.filter("_words", lambda w: (F.length(w) <= most) & F.array_contains(F.col("_r.common"), w))), 0)
    rows = rows.withColumn("_hashes", F.when(F.size("_words") >= SPAN, windows)).withColumn("_usual", usual)
    n = F.size("_words").cast("long")
    held = F.transform("_r.common", lambda c: (F.size("_usual") - F.size(F.array_remove("_usual", c))) / F.greatest(n, F.lit(1)))
    rows = rows.select(
        "lang", "doc_id", F.xxhash64("text").alias("text_key"), n.alias("n_words"), (F.length(_text()) - F.col("n_gap")).cast("long").alias("word_chars"), "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"), repeated_words(F.col("_words"), F.col("_hashes")).cast("long").alias("n_repeat_words"),
        "_r", F.array(*(F.col(f"n_{c}") / F.greatest(F.length(_text()), F.lit(1)) for c in CLASSES)).alias("_classes"),
        F.concat(held, F.array((n - F.size("_usual")) / F.greatest(n, F.lit(1)))).alias("_shares"),
    )
    none = F.concat(F.transform("_r.common", lambda c: F.lit(0.0)), F.array(F.lit(1.0)))
    return rows.withColumns({
        "base_failed": (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")),
        "character_distance": js_distance(F.col("_classes"), F.col("_r.classes")), "word_distance": js_distance(F.col("_shares"), F.col("_r.usual")), "none_distance": js_distance(none, F.col("_r.usual")),
    }).drop("_r", "_classes", "_shares")


def _quartiles(steps: DataFrame, by: list[str]) -> DataFrame:
    """steps (by, step, n) → by, texts, q1, q3: the steps' upper ends that a quarter and three quarters of the texts do not exceed."""
    whole = Window.partitionBy(*by)
    rows = steps.withColumns({"upto": F.sum("n").over(whole.orderBy("step")), "texts": F.sum("n").over(whole)})
    quartile = lambda k: (F.min(F.when(4 * F.col("upto") >= k * F.col("texts"), F.col("step"))) + 1) / F.lit(float(STEPS))
    return rows.groupBy(*by).agg(quartile(1).alias("q1"), quartile(3).alias("q3"), F.max("texts").alias("texts"))


def distance_quartiles(judged: DataFrame, column: str, pooled: int = POOLED) -> DataFrame:
    """judged (lang, text_key, column) → lang, q1, q3: quartiles of each language's distances, each different text once.

    Those of all languages together count as ``pooled`` more texts of each, so a language of few texts is judged much like the
    others and one of many by itself. Distances are counted in steps, so a language has at most STEPS + 1 rows whatever its documents.
    """
    step = F.floor(F.col(column) * STEPS).cast("long")
    steps = judged.select("lang", "text_key", step.alias("step")).distinct().groupBy("lang", "step").agg(F.count("*").alias("n"))
    every = steps.groupBy("step").agg(F.sum("n").alias("n")).withColumn("all", F.lit(0))
    pool = _quartiles(every, ["all"]).select(F.col("q1").alias("p1"), F.col("q3").alias("p3"))
    # One row.
    found = _quartiles(steps, ["lang"]).join(F.broadcast(pool), F.lit(True), "left")
    return found.select("lang", *(((F.col("texts") * F.col(q) + pooled * F.col(p)) / (F.col("texts") + pooled)).alias(q) for q, p in (("q1", "p1"), ("q3", "p3"))))


def judge_quality(
    docs: DataFrame, guard: int = GUARD, character_spreads: float = CHARACTER_SPREADS, word_spreads: float = WORD_SPREADS, pooled: int = POOLED, own_share: float = OWN_SHARE,
) -> DataFrame:
    """For each row of docs: doc_id, the counts, base_failed, both distances, far_characters, far_words, kept.

    A language's word limit is at most own_share of the distance which a text with none of its common words
    has, but one spread beyond the upper quartile at least.
    """
    # Written, so that the planner knows their size: it broadcasts few and deals out many by lang.
    refs = materialize(language_references(docs), "language-references")
    rows = materialize(measured(docs, refs), "measures")
    judged = (F.col("n_words") >= guard) & ~F.col("base_failed")
    spread = lambda least: F.greatest(F.col("q3") - F.col("q1"), F.lit(least))
    characters = distance_quartiles(rows.where(judged), "character_distance", pooled).select("lang", (F.col("q3") + character_spreads * spread(CHARACTER_SPREAD)).alias("character_limit"))
    words = distance_quartiles(rows.where(judged), "word_distance", pooled).select("lang", (F.col("q3") + word_spreads * spread(WORD_SPREAD)).alias("word_limit"), (F.col("q3") + spread(WORD_SPREAD)).alias("word_floor"))
    rows = rows.join(materialize(characters.join(words, "lang"), "distance-limits"), "lang", "left")
    word_limit = F.least("word_limit", F.greatest(own_share * F.col("none_distance"), F.col("word_floor")))
    rows = rows.withColumns({
        "far_characters": F.coalesce((F.col("n_words") >= guard) & (F.col("character_distance") > F.col("character_limit")), F.lit(False)),
        "far_words": F.coalesce((F.col("n_words") >= guard) & (F.col("word_distance") > word_limit), F.lit(False)),
    })
    return rows.withColumn("kept", ~(F.col("base_failed") | F.col("far_characters") | F.col("far_words"))).drop("lang", "text_key", "none_distance", "character_limit", "word_limit", "word_floor")


RESULT = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_quality_rules(documents: DataFrame) -> DataFrame:
    """Counts and verdict of every document, by the limits that OP5_SQL states; nulls, short texts and repeats as in the module."""
    return judge_quality(documents).select(*RESULT)


_STEPS = (("[a-z]+", "t", "a"), ("[A-Z]+", "a", "b"), ("[0-9]+", "b", "c"), (r"[\x20\x09-\x0D]+", "c", "e"), (r"[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+", "e", "f"))
_PART = "CASE WHEN {a} > 0 THEN {a} * log2({a} / (({a} + {b}) / 2)) ELSE 0 END"


def _distance_sql(p: str, q: str) -> str:
    terms = f"({_PART.format(a='z[1]', b='z[2]')} + {_PART.format(a='z[2]', b='z[1]')}) / 2"
    return f"sqrt(greatest(0, list_sum(list_transform(list_zip({p}, {q}), lambda z: {terms}))))"


def _quartile_sql(column: str, name: str) -> str:
    """CTEs that end in name (lang, q1, q3): quartiles of a distance for each language, those of all as POOLED more texts."""
    def both(rows: str) -> str:
        of = lambda k: f"(min(step) FILTER (WHERE 4 * upto >= {k} * texts) + 1) / {STEPS}.0::DOUBLE"
        return f"SELECT lang, {of(1)} AS q1, {of(3)} AS q3, max(texts) AS texts FROM (SELECT lang, step, CAST(sum(n) OVER (PARTITION BY lang ORDER BY step) AS BIGINT) AS upto, CAST(sum(n) OVER (PARTITION BY lang) AS BIGINT) AS texts FROM {rows}) GROUP BY lang"

    return f"""{name}0 AS (SELECT lang, step, count(*) AS n FROM (SELECT DISTINCT lang, t, CAST(floor({column} * {STEPS}) AS BIGINT) AS step FROM z WHERE n_words >= {GUARD} AND NOT base_failed) GROUP BY ALL),
{name}1 AS ({both(f"(SELECT '' AS lang, step, CAST(sum(n) AS BIGINT) AS n FROM {name}0 GROUP BY step)")}), {name}2 AS ({both(f"{name}0")}),
{name} AS (SELECT b.lang, (b.texts * b.q1 + {POOLED} * a.q1) / (b.texts + {POOLED}) AS q1, (b.texts * b.q3 + {POOLED} * a.q3) / (b.texts + {POOLED}) AS q3 FROM {name}2 b, {name}1 a)"""


OP5_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
{", ".join(f"s{i} AS (SELECT *, regexp_replace({x}, '{p}', '', 'g') AS {y} FROM {'d' if not i else f's{i - 1}'})" for i, (p, x, y) in enumerate(_STEPS))},
q AS (SELECT row, doc_id, lang, t, w, length(t) - length(a) AS k1, length(a) - length(b) AS k2, length(b) - length(c) AS k3, length(c) - length(e) AS k4, length(e) - length(f) AS k5, length(f) AS k6,
  length(t) AS n, length(e) - length(translate(e, '#*$%&|<>', '')) AS n_symbols FROM s4),
r AS (SELECT lang, [{", ".join(f"sum(k{i})::DOUBLE / greatest(sum(n), 1)" for i in range(1, 7))}] AS classes, sum(len(w))::DOUBLE AS words FROM q GROUP BY lang),
v AS (SELECT lang, word, count(*) AS m, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) AS place FROM (SELECT lang, unnest(w) AS word FROM q) WHERE regexp_matches(word, '^\\p{{L}}+$') GROUP BY lang, word),
u AS (SELECT r.lang, classes, list(word ORDER BY place) FILTER (WHERE word IS NOT NULL) AS common, coalesce(list(m / greatest(words, 1) ORDER BY place) FILTER (WHERE word IS NOT NULL), []) AS shares
  FROM r LEFT JOIN v ON v.lang = r.lang AND place <= {COMMON} GROUP BY r.lang, classes),
x AS (SELECT row, i, count(*) OVER (PARTITION BY row, g) AS many FROM (SELECT row, i, array_to_string(w[i:i + {SPAN - 1}], ' ') AS g FROM (SELECT row, w, unnest(range(1, len(w) - {SPAN - 2})) AS i FROM q WHERE len(w) >= {SPAN}))),
y AS (SELECT row, count(DISTINCT j) AS n_repeat_words FROM (SELECT row, i + unnest(range({SPAN})) AS j FROM x WHERE many > 1) GROUP BY row),
o AS (SELECT q.*, coalesce(n_repeat_words, 0) AS n_repeat_words, len(w) AS n_words, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines,
  [{", ".join(f"k{i}::DOUBLE / greatest(n, 1)" for i in range(1, 7))}] AS own, classes, common, shares, list_transform(coalesce(common, []), lambda c: len(list_filter(w, lambda x: x = c))::DOUBLE / greatest(len(w), 1)) AS held
  FROM q JOIN u USING (lang) LEFT JOIN y USING (row)),
z AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed, {_distance_sql("own", "classes")} AS cd,
  {_distance_sql("list_append(held, 1 - coalesce(list_sum(held), 0))", "list_append(shares, 1 - coalesce(list_sum(shares), 0))")} AS wd,
  {_distance_sql("list_append(list_transform(coalesce(common, []), lambda c: 0.0::DOUBLE), 1.0::DOUBLE)", "list_append(shares, 1 - coalesce(list_sum(shares), 0))")} AS nd FROM o),
{_quartile_sql("cd", "cl")},
{_quartile_sql("wd", "wl")}
SELECT doc_id, n_words, CAST(n - k4 AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(n_words >= {GUARD} AND (cd > cl.q3 + {CHARACTER_SPREADS} * greatest(cl.q3 - cl.q1, {CHARACTER_SPREAD}::DOUBLE)
  OR wd > least(wl.q3 + {WORD_SPREADS} * greatest(wl.q3 - wl.q1, {WORD_SPREAD}::DOUBLE), greatest({OWN_SHARE}::DOUBLE * nd, wl.q3 + greatest(wl.q3 - wl.q1, {WORD_SPREAD}::DOUBLE)))), false) AS kept FROM z LEFT JOIN cl USING (lang) LEFT JOIN wl USING (lang)
"""
