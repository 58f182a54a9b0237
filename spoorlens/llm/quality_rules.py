"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document. The ledger keeps the measurements and one
bit per failed rule. A policy is a versioned set of bits: a document is kept if it
fails none of them. Changing a policy, or asking what a rule alone removes, needs only
the bits and not the texts. DataFrame functions only.

Null and empty texts have no words and fail ``few_words``. Repeated rows are judged one
by one, and further columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from spoorlens.llm.common import WORD, text_of, words_of

WINDOW = 5

# Rule name, and what fails it; the place in this list is the bit. Counts are compared
# as integers, so that no result hangs on a rounded division.
RULES: list[tuple[str, Column | str]] = [
    ("few_words", "n_words < 10"),
    ("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "100 * n_symbols > 30 * n_words"),
    ("repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
    ("capitals", "100 * n_capitals > 60 * word_chars"),
]
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}


def _mask(*names: str) -> int:
    return sum(BIT[n] for n in names)


BASE = _mask("few_words", "repeated_words")
POLICIES: dict[str, int] = {
    "base": BASE,
    "v1": BASE | _mask("symbols", "repeated_lines"),
    "v2": _mask(*BIT),
}
MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals",
]


def _windows(hashes: str) -> Column:
    """One hash per window of five words."""
    n = F.greatest(F.size(hashes) - (WINDOW - 1), F.lit(0))
    shifted = F.arrays_zip(*[F.slice(hashes, i + 1, n).alias(str(i)) for i in range(WINDOW)])
    return F.transform(shifted, lambda w: F.xxhash64(*[w[str(i)] for i in range(WINDOW)]))


def _placed(windows: str) -> Column:
    """Windows with their places, sorted; null where no window repeats."""
    pairs = F.transform(windows, lambda w, p: F.struct(w.alias("w"), p.alias("p")))
    return F.when(F.size(windows) > F.size(F.array_distinct(windows)), F.array_sort(pairs))


def _places(placed: str) -> Column:
    """Places of the windows that equal a neighbour in sorted order, ascending."""
    gap = F.array(F.lit(None).cast("struct<w:bigint,p:int>"))
    pairs = F.zip_with(
        F.concat(gap, placed), F.concat(placed, gap),
        lambda a, b: F.when(a["w"] == b["w"], F.array(a["p"], b["p"])),
    )
    return F.array_sort(F.array_distinct(F.flatten(F.filter(pairs, lambda x: x.isNotNull()))))


def _covered(places: str) -> Column:
    """Words in repeated windows: five for each place, less what the next covers again."""
    steps = F.zip_with(
        places, F.slice(places, 2, F.greatest(F.size(places), F.lit(1))),
        lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)),
    )
    return F.coalesce(F.aggregate(steps, F.lit(0), lambda s, x: s + x), F.lit(0)).cast("long")


def ledger(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Measurements and failure bits of every document, with the columns in ``keep``.

    One narrow pass over the texts. Windows are hashed to 64 bits within a document;
    the place of repeats is worked out only for documents that have any.
    """
    kept = [F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]
    names = [f"k{i}" for i in range(len(keep))]
    has_word = WORD.rstrip("+")
    split = docs.select(*kept, text_of(text).alias("t")).select(
        *names, "t", words_of(F.col("t")).alias("words"),
        F.filter(F.split("t", "\n", -1), lambda line: line.rlike(has_word)).alias("lines"),
    )
    measured = split.select(
        *names,
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.regexp_count("t", F.lit("[A-Z]")).cast("long").alias("n_capitals"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    others = [c for c in MEASURES if c != "n_repeat_words"]
    windowed = measured.select(*names, *others, _windows("hashes").alias("windows"))
    counted = (
        windowed.withColumn("placed", _placed("windows")).drop("windows")
        .withColumn("places", _places("placed")).drop("placed")
        .withColumn("n_repeat_words", _covered("places"))
    )
    bits = [F.when(F.expr(rule) if isinstance(rule, str) else rule, F.lit(1 << i)).otherwise(0)
            for i, (_, rule) in enumerate(RULES)]
    failed = bits[0]
    for b in bits[1:]:
        failed = failed.bitwiseOR(b)
    return counted.select(
        *[F.col(n).alias(c) for n, c in zip(names, keep)], *MEASURES, failed.cast("int").alias("failed_bits"),
    )


def fails(bits: Column | str, policy: str) -> Column:
    """Whether a document fails a rule of the policy."""
    col = F.col(bits) if isinstance(bits, str) else bits
    return col.bitwiseAND(F.lit(POLICIES[policy])) != 0


def apply_policy(rows: DataFrame, policy: str = "v2") -> DataFrame:
    """The ledger with the verdict of a policy and its version."""
    return rows.withColumns({"policy": F.lit(policy), "kept": ~fails("failed_bits", policy)})


def ablations(rows: DataFrame, policy: str = "v2") -> DataFrame:
    """For each rule of a policy: documents that fail it, that only it removes, and the
    documents kept with and without it.

    The ledger is first counted by its bits, at most 2 ** rules rows; rules see only those.
    """
    mask = POLICIES[policy]
    counts = rows.groupBy(F.col("failed_bits").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(bit).alias("bit")) for name, bit in BIT.items() if bit & mask])
    each = counts.withColumn("r", F.explode(rules)).select("bits", "n", "r.rule", "r.bit")
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    return each.groupBy("rule").agg(
        F.max("bit").alias("bit"),
        total(hit).alias("failed"),
        total(F.col("bits") == F.col("bit")).alias("removed_by_it_alone"),
        total(F.col("bits") == 0).alias("kept"),
        total((F.col("bits") == 0) | (F.col("bits") == F.col("bit"))).alias("kept_without_it"),
    )
