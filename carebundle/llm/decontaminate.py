"""Benchmark decontamination by template windows and consistent slots; built-in functions only.

Numbers, units and names (capitalised words, wherever they stand) become typed placeholders, so a question with other
values has the template of the original.  Windows of eight words of all texts meet those of the benchmark in a hash join:
each by its words in lower case, so neither case nor punctuation matters, and by its template.  A template with fewer
literal words than placeholders is too general and not used.  Benchmark windows also have the templates that a text with
other capital letters has.  Matches on
neighbouring diagonals (shifts between text and item), as words put in or left out make them, count together; if they
cover enough words of an item they are a candidate, and a candidate counts if the slots inside its matches are
consistent: equal values in the item are equal values in the text.  A candidate most of which stands in the text word for
word counts in any case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carebundle.llm.common import hash_filter, may_hold, null_safe, quoted, stored

WINDOW = 8
MIN_COVERAGE = 0.5
# From this share of an item's words inside windows equal word for word, the slots need not be consistent.
MIN_LITERAL = 0.7
# Items with fewer words match whole texts only.
MIN_WORDS = 3
# Words and signs of units, in lower case.
UNITS = (
    "% $ € £ mm cm m km inch inches foot feet yard yards mile miles mg g kg ton tons ounce ounces pound pounds ml l liter"
    " liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year"
    " years cent cents dollar dollars euro euros percent degree degrees mph kmh watt watts volt volts"
)
NAME, NUMBER, UNIT = "<name>", "<number>", "<unit>"
_NAME_MARK = "\x01"
_NAME_AT = r"(?<![\p{L}\p{N}])(?=\p{Lu}\p{Ll})"
# Inside a sentence, where a capital letter shows a name.
_SURE_NAME_AT = r"(?<=[\p{L}\p{N},;:]\s)(?=\p{Lu}\p{Ll})"
_TOKEN = rf"{_NAME_MARK}?[\p{{L}}\p{{N}}]+(?:[.,]\p{{N}}+)*|[%$€£]"


def tokens(text: Column, name_at: str = _NAME_AT) -> Column:
    """The words, numbers and unit signs of a text; names carry a mark in front."""
    clean = F.replace(F.coalesce(text, F.lit("")), F.lit(_NAME_MARK), F.lit(""))
    return F.regexp_extract_all(F.regexp_replace(clean, name_at, _NAME_MARK), F.lit(_TOKEN), F.lit(0))


def _unmarked(token: Column) -> Column:
    """A token without its mark, which only stands in front; ``translate`` would look up each letter."""
    return F.ltrim(token, F.lit(_NAME_MARK))


def literal(token: Column) -> Column:
    return F.lower(_unmarked(token))


def template(token: Column, word: Column | None = None) -> Column:
    """The placeholder of a token, or its lower case, which may be given."""
    word = F.lower(token) if word is None else word
    return (
        F.when(token.startswith(_NAME_MARK), NAME)
        .when((token >= "0") & (token < ":"), NUMBER)
        .when(word.isin(UNITS.split()), UNIT)
        .otherwise(word)
    )


def _is_slot(word: Column) -> Column:
    return word.startswith("<")


def codes(words: Column) -> Column:
    """A hash of each word: windows then hash eight numbers and not eight texts."""
    return F.transform(words, lambda word: F.xxhash64(word))


def _starts(words: Column, size: int) -> Column:
    """Where the windows of a size begin, from 1."""
    count = F.size(words) - size + 1
    return F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))


def _plain_hashes(numbers: Column, size: int) -> Column:
    """The hashes of all windows of a size, from the codes of the words."""
    return F.transform(_starts(numbers, size), lambda i: F.xxhash64(F.lit(size), F.slice(numbers, i, size)))


def window_hashes(words: Column, templates: Column, size: int) -> Column:
    """The hashes of all windows of a size: of templates where at least half of the window is literal.  For the short texts
    of a benchmark: the codes of a window are made where it is."""

    def mixed(i: Column) -> Column:
        own = F.slice(templates, i, size)
        general = F.size(F.filter(own, _is_slot)) * 2 > size
        return F.xxhash64(F.lit(size), codes(F.when(general, F.slice(words, i, size)).otherwise(own)))

    return F.transform(_starts(words, size), mixed)


def text_hashes(word_codes: Column, template_codes: Column, slots: Column, size: int) -> Column:
    """Arrays of the one or two hashes of each window: of its words and, in a text with slots, of its template.  Templates that
    are too general meet nothing, as the benchmark has none."""
    both = F.zip_with(
        _plain_hashes(word_codes, size), _plain_hashes(template_codes, size), lambda x, y: F.when(x == y, F.array(x)).otherwise(F.array(x, y))
    )
    alone = F.transform(_plain_hashes(word_codes, size), lambda x: F.array(x))
    return F.when(slots, both).otherwise(alone)


def _covered(starts: Column, size: Column) -> Column:
    """The positions inside windows that start at some positions."""
    return F.array_distinct(F.flatten(F.transform(starts, lambda at: F.sequence(at, at + size - 1))))


def _bands(diagonal: Column, width: Column) -> Column:
    """Two bands of a width that hold a diagonal: diagonals up to half a width apart share one of them."""
    return F.array(F.floor(diagonal / width) * 2, F.floor((diagonal + F.floor(width / 2)) / width) * 2 + 1)


def _with_words(frame: DataFrame, text: str) -> DataFrame:
    return (
        frame.withColumn("tokens", tokens(F.col(text)))
        .withColumn("words", F.transform("tokens", literal))
        .withColumn("templates", F.zip_with("tokens", "words", template))
    )


def benchmark_windows(benchmark: DataFrame, id_column: str, text_column: str, window: int) -> DataFrame:
    """The windows of the items: hash, size, item_id, item_at (position from 0), n_words, literal (by its words), tokens and names (words that are
    names for sure).  Of items with the same words the smallest id stands for all; shorter items have one window of all
    their words.  A window has the hash of its words and those of its templates with all capitalised words as names, with
    the sure names only, and without names."""
    items = benchmark.select(quoted(id_column).alias("item_id"), quoted(text_column).alias("text"))
    items = _with_words(items.where("text is not null"), "text").where(F.size("words") >= MIN_WORDS)
    marked = F.filter(tokens(F.col("text"), _SURE_NAME_AT), lambda token: token.startswith(_NAME_MARK))
    items = items.withColumn("names", F.array_sort(F.array_distinct(F.transform(marked, literal))))
    items = items.groupBy("words", "templates", "tokens", "names").agg(F.min("item_id").alias("item_id"))
    unnamed = lambda token: template(_unmarked(token))
    sure = lambda token: F.when(F.array_contains("names", literal(token)), NAME).otherwise(unnamed(token))
    items = items.withColumn("sure", F.transform("tokens", sure)).withColumn("unnamed", F.transform("tokens", unnamed))
    sized = items.withColumn("size", F.least(F.size("words"), F.lit(window)))
    hashes = F.lit(None)
    for size in range(MIN_WORDS, window + 1):
        # Those of general templates are those of the words.
        kinds = [window_hashes(F.col("words"), F.col(kind), size) for kind in ("words", "templates", "sure", "unnamed")]
        each = F.transform(F.arrays_zip(*(kind.alias(f"k{n}") for n, kind in enumerate(kinds))), lambda k: F.array_distinct(F.array(*(k[f"k{n}"] for n in range(4)))))
        hashes = F.when(F.col("size") == size, each).otherwise(hashes)
    sized = sized.select("item_id", "size", "tokens", "names", F.size("words").alias("n_words"), F.posexplode(hashes).alias("item_at", "hashes"))
    sized = sized.withColumn("hash", F.explode("hashes")).withColumn("literal", F.col("hash") == F.get("hashes", F.lit(0)))
    return sized.drop("hashes")


def short_items(benchmark: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(words, item_id) of the items that are too short for windows; of items with the same words the smallest id."""
    items = benchmark.select(quoted(id_column).alias("item_id"), quoted(text_column).alias("text"))
    items = _with_words(items.where("text is not null"), "text").where(F.size("words").between(1, MIN_WORDS - 1))
    return items.groupBy("words").agg(F.min("item_id").alias("item_id"))


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    min_coverage: float = MIN_COVERAGE,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """One row per row: doc_id, text_hash, contaminated, item_id (of the best covered item, the smallest of equals), coverage (share
    of the item's words inside windows found in one region of the text, 0 if none) and changed_slots (distinct item values
    that the text has replaced).

    Windows count together if their diagonals are at most half an item apart, so as many words may be put in; copies of an
    item that stand one after the other stay apart.  A part of an item is found from ``min_coverage`` of its words on
    (rounded down), but only in unbroken runs of ``window`` words.

    Items of one or two words match texts that consist of these words.  Null and empty texts are clean; null and empty items
    match nothing; an empty benchmark leaves all clean.
    Repeated rows give repeated rows, an empty table an empty one; other columns are not looked at.  Rows with the same id
    and text share their result, and of rows with the same id and different texts each has its own.
    """
    rows = documents.select(quoted(id_column).alias("doc_id"), quoted(text_column).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    items = stored(benchmark_windows(benchmark, item_column, item_text_column, window), "benchmark-windows")
    sizes = [row["size"] for row in items.select("size").distinct().collect()]  # at most `window` numbers
    wanted = stored(items.select("hash").distinct(), "benchmark-hashes")
    texts = _with_words(rows, "text")
    coded = texts.select(
        "doc_id", "text_hash", F.exists("templates", _is_slot).alias("slots"), codes(F.col("words")).alias("word_codes"), codes(F.col("templates")).alias("template_codes")
    )
    found = None
    for size in sorted(sizes) or [window]:
        hashes = text_hashes(F.col("word_codes"), F.col("template_codes"), F.col("slots"), size)
        at = coded.select("doc_id", "text_hash", F.posexplode(hashes).alias("at", "hashes"))
        at = at.select("doc_id", "text_hash", "at", F.explode("hashes").alias("hash"))
        hits = at.join(wanted, "hash", "left_semi")
        found = hits if found is None else found.unionByName(hits)
    # A hash holds the size of its window, so hits of one size never meet items of another.
    places = items.select("hash", "item_id", "item_at", "size", "n_words", "literal")
    matches = found.join(places, "hash").withColumn("diagonal", F.col("at") - F.col("item_at"))
    key = ["doc_id", "text_hash"]
    runs = matches.groupBy(*key, "item_id", "size", "n_words", "diagonal").agg(
        F.collect_set("item_at").alias("starts"), F.collect_set(F.when(F.col("literal"), F.col("item_at"))).alias("literal_starts")
    )
    # A band holds at most as many diagonals as the item has words; the longest runs come first.
    run = F.struct((-F.size("starts")).alias("rank"), "diagonal", "starts", "literal_starts")
    regions = runs.withColumn("band", F.explode(_bands(F.col("diagonal"), F.col("n_words"))))
    regions = regions.groupBy(*key, "item_id", "size", "n_words", "band").agg(F.sort_array(F.collect_list(run)).alias("runs"))
    n_covered = F.size(_covered(F.flatten(F.col("runs.starts")), F.col("size")))
    n_literal = F.size(_covered(F.flatten(F.col("runs.literal_starts")), F.col("size")))
    covered = regions.withColumn("coverage", n_covered / F.col("n_words")).withColumn("verbatim", n_literal / F.col("n_words"))
    candidates = stored(covered.where(n_covered >= F.floor(F.col("n_words") * min_coverage)), "contamination-candidates")
    suspects = stored(candidates.select(*key).distinct(), "contamination-suspects")
    # Only rows whose id a suspect may have are shuffled with their texts.
    bits = hash_filter(suspects.select(F.xxhash64("doc_id").alias("hash")), "hash")
    maybe = rows.where(may_hold(bits, F.xxhash64("doc_id")))
    again = _with_words(maybe.join(suspects, null_safe(maybe, suspects, key), "left_semi").dropDuplicates(key), "text")
    own = again.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), F.col("tokens").alias("found"))
    asked = items.groupBy("item_id").agg(F.first("tokens").alias("tokens"), F.first("names").alias("names"))
    both = candidates.join(asked, "item_id").join(own, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")))

    def matched(at: Column) -> Column:
        """The shift of the longest run that covers a position of the item."""
        inside = lambda start: (start <= at) & (at < start + F.col("size"))
        return F.get(F.filter("runs", lambda run: F.exists(run["starts"], inside)), 0)["diagonal"]

    def longer(slot: Column, side: int) -> Column:
        """Whether the text's value goes on where the item's does not, so its words cannot be compared one by one."""
        kinds = [template(F.get(name, at + side)) for name, at in (("found", slot["at"] + slot["shift"]), ("tokens", slot["at"]))]
        return kinds[0].eqNullSafe(slot["kind"]) & ~kinds[1].eqNullSafe(slot["kind"])

    slots = F.filter(
        F.transform("tokens", lambda token, i: F.struct(i.alias("at"), literal(token).alias("item"), template(token).alias("kind"), matched(i).alias("shift"))),
        lambda slot: _is_slot(slot["kind"]) & slot["shift"].isNotNull(),
    )
    pairs = F.transform(
        slots,
        lambda s: F.struct(
            s["item"].alias("item"), literal(F.get("found", s["at"] + s["shift"])).alias("text"), (longer(s, -1) | longer(s, 1)).alias("longer"),
            # The first word of a sentence need not be a name.
            ((s["kind"] != NAME) | F.array_contains("names", s["item"])).alias("sure"),
        ),
    )
    pairs = F.array_distinct(pairs)
    judged = both.select(*key, "item_id", "coverage", "verbatim", pairs.alias("pairs"))
    compared = F.filter("pairs", lambda p: p["sure"] & ~p["longer"])
    changed = F.filter("pairs", lambda p: p["item"] != p["text"])
    consistent = F.size(compared) == F.size(F.array_distinct(F.transform(compared, lambda p: p["item"])))
    judged = judged.where(consistent | (F.col("verbatim") >= MIN_LITERAL))
    judged = judged.withColumn("changed_slots", F.size(F.array_distinct(F.transform(changed, lambda p: p["item"]))).cast("bigint"))
    judged = judged.select(*key, "item_id", "coverage", "changed_slots")
    short = stored(short_items(benchmark, item_column, item_text_column), "short-items")
    if not short.isEmpty():
        whole = texts.where(F.size("words").between(1, MIN_WORDS - 1)).select(*key, "words").join(short, "words")
        judged = judged.unionByName(whole.select(*key, "item_id", F.lit(1.0).alias("coverage"), F.lit(0).cast("bigint").alias("changed_slots")))
    best = judged.groupBy(*key).agg(
        F.min(F.struct((-F.col("coverage")).alias("c"), "changed_slots", "item_id")).alias("best")
    )
    best = stored(best, "contaminated")
    thin = rows.select("doc_id", "text_hash")
    verdict = thin.join(best.withColumnsRenamed({"doc_id": "d", "text_hash": "h"}), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")), "left")
    return verdict.select(
        "doc_id",
        "text_hash",
        F.col("best").isNotNull().alias("contaminated"),
        F.col("best.item_id").alias("item_id"),
        F.coalesce(-F.col("best.c"), F.lit(0.0)).alias("coverage"),
        F.coalesce("best.changed_slots", F.lit(0).cast("bigint")).alias("changed_slots"),
    )
