"""Operator 4: quality rules under weak supervision.

Each rule looks at a few counts of a text and votes good (1), bad (-1) or abstains (0). How reliable a rule is, for
good and for bad documents, is not given: expectation-maximisation estimates it from how the rules agree over the
whole corpus, and a document is kept if the posterior probability of being good is `THRESHOLD` or more. Documents that
fail a base rule are not kept in any case.

Everything on rows is DataFrame functions. Estimation needs only how many documents have which combination of votes,
at most 3 to the power of the number of rules.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estratos.llm.common import read, written

THRESHOLD = 0.5
ROUNDS = 50
#: Bounds for the rate of bad votes on bad and on good documents.
BAD_RATE, GOOD_RATE = (0.1, 0.99), (0.002, 0.05)
SYMBOLS = "#*$%&|<>"
_BLANKS = " \t\n\x0b\f\r"
_SPLIT = "[ \\t\\n\\x0B\\f\\r]+"
#: Positions in the lower bits of a packed number; the upper 36 bits are of the hash of a window.
_BITS = 28
_MASK = (1 << _BITS) - 1


def _neighbour(values: str, at: Column, step: int) -> Column:
    return F.get(F.col(values), at + step)


def measures(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id` and the counts of each text: n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_upper
    and n_exclamations.

    Words are runs of anything but the six ASCII blanks. `n_repeat_words` are the words in windows of three words that
    occur at least twice in the text. A null text counts as an empty one.
    """
    full = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(F.col(id_column).alias("doc_id"), full.alias("text"))
    base = base.select("doc_id", "text", F.filter(F.split("text", _SPLIT, -1), lambda w: w != "").alias("words"))
    base = base.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    window = F.transform(
        "hashes",
        lambda h, i: F.shiftleft(F.xxhash64(h, _neighbour("hashes", i, 1), _neighbour("hashes", i, 2)), _BITS).bitwiseOR(i.cast("long")),
    )
    # Equal windows stand side by side once sorted; a shared hash prefix only makes a candidate.
    base = base.withColumn("sorted", F.sort_array(F.slice(window, 1, F.greatest(F.size("words") - 2, F.lit(0)))))

    def same(x: Column, y: Column) -> Column:
        return F.coalesce(F.shiftright(x.bitwiseXOR(y), _BITS) == 0, F.lit(False))

    beside = F.filter(
        "sorted",
        lambda x, i: same(x, _neighbour("sorted", i, 1)) | F.when(i > 0, same(x, _neighbour("sorted", i, -1))).otherwise(False),
    )
    base = base.withColumn("maybe", beside)
    spelled = F.transform(
        "maybe",
        lambda x: F.struct(
            F.concat_ws(" ", F.slice("words", x.bitwiseAND(F.lit(_MASK)).cast("int") + 1, 3)).alias("w"),
            x.bitwiseAND(F.lit(_MASK)).alias("i"),
        ),
    )
    base = base.withColumn("spelled", F.when(F.size("maybe") > 0, F.sort_array(spelled)))

    def equal(x: Column, i: Column, step: int) -> Column:
        return F.coalesce(x["w"] == _neighbour("spelled", i, step)["w"], F.lit(False))

    repeated = F.filter(
        "spelled", lambda x, i: equal(x, i, 1) | F.when(i > 0, equal(x, i, -1)).otherwise(False)
    )
    base = base.withColumn("repeats", F.sort_array(F.transform(repeated, lambda x: x["i"])))
    covered = F.aggregate(
        F.transform("repeats", lambda x, i: F.least(F.lit(3).cast("long"), _neighbour("repeats", i, 1) - x)),
        F.lit(0).cast("long"), lambda total, x: total + x,
    )
    lines = F.filter(F.split("text", "\n", -1), lambda line: F.length(F.translate(line, _BLANKS, "")) > 0)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    chars = F.length("text")
    return base.withColumn("lines", lines).select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", _BLANKS, "")).cast("long").alias("word_chars"),
        (chars - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"),
        (chars - F.length(F.translate("text", upper, ""))).cast("long").alias("n_upper"),
        (chars - F.length(F.translate("text", "!", ""))).cast("long").alias("n_exclamations"),
    )


def votes() -> list[Column]:
    """The rules, each a vote of 1, -1 or 0 on the measures. Ratios are multiplied out, so nothing is divided by zero."""
    words, chars = F.col("n_words"), F.col("word_chars")

    def rule(good: Column, bad: Column) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0)

    symbols, upper, calls = F.col("n_symbols"), F.col("n_upper"), F.col("n_exclamations")
    repeats, lines = F.col("n_repeat_words"), F.col("n_dup_lines")
    return [
        rule(50 * symbols <= words, 10 * symbols > words),
        rule(symbols == 0, 50 * symbols > chars),
        rule(10 * upper <= chars, 10 * upper > 3 * chars),
        rule(50 * calls <= words, 5 * calls > words),
        rule(10 * repeats <= words, 10 * repeats > 3 * words),
        rule(lines == 0, 5 * lines > F.col("n_lines")),
        rule((chars >= 3 * words) & (chars <= 9 * words), (2 * chars < 5 * words) | (chars > 14 * words)),
    ]


def estimate(patterns: list[tuple[tuple[int, ...], int]]) -> tuple[float, list[tuple[float, float]]]:
    """The log odds of a good document, and for each rule what a good and what a bad vote add to them.

    `patterns` are combinations of votes with their numbers of documents. A bad vote is taken to be better than chance:
    its rate on bad documents stays above that on good ones, within `BAD_RATE` and `GOOD_RATE`. So a rule that never
    votes, or a corpus of one kind, gives finite weights, and the two classes cannot change places.
    """
    rules = len(patterns[0][0]) if patterns else 0
    prior, hits, misses = 0.8, [0.4] * rules, [0.02] * rules  # bad votes on bad and on good documents

    def weights() -> tuple[float, list[tuple[float, float]]]:
        each = [(math.log((1 - m) / (1 - h)), math.log(m / h)) for h, m in zip(hits, misses, strict=True)]
        return math.log(prior / (1 - prior)), each

    for _ in range(ROUNDS if patterns else 0):
        start, each = weights()
        good_mass = mass = 0.0
        tally = [[1.0, 2.0, 1.0, 2.0] for _ in range(rules)]  # bad votes and votes, on bad and on good documents
        for pattern, count in patterns:
            odds = start + sum(w[0] if v > 0 else w[1] for w, v in zip(each, pattern, strict=True) if v)
            good = 1 / (1 + math.exp(-max(-40.0, min(40.0, odds))))
            good_mass, mass = good_mass + good * count, mass + count
            for own, v in zip(tally, pattern, strict=True):
                if v:
                    own[0] += (v < 0) * (1 - good) * count
                    own[1] += (1 - good) * count
                    own[2] += (v < 0) * good * count
                    own[3] += good * count
        prior = min(0.99, max(0.01, good_mass / mass))
        hits = [min(BAD_RATE[1], max(BAD_RATE[0], t[0] / t[1])) for t in tally]
        misses = [min(GOOD_RATE[1], max(GOOD_RATE[0], t[2] / t[3])) for t in tally]
    return weights()


def judge(docs: DataFrame, threshold: float = THRESHOLD, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The measures of each row, `votes`, `base_failed`, `probability` and `kept`; an empty table gives no rows.

    A row fails the base rules with fewer than 50 words, or with more than half of its words in repeated windows.
    """
    measured = written(measures(docs, id_column, text), "measures").withColumn("votes", F.array(*votes()))
    counted = measured.groupBy("votes").count().collect()
    start, each = estimate(sorted((tuple(r["votes"]), r["count"]) for r in counted))
    odds = F.lit(start)
    for i, (good, bad) in enumerate(each):
        vote = F.get(F.col("votes"), F.lit(i))
        odds = odds + F.when(vote > 0, F.lit(good)).when(vote < 0, F.lit(bad)).otherwise(F.lit(0.0))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = measured.withColumn("base_failed", failed).withColumn("probability", 1 / (1 + F.exp(-odds)))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("probability") >= threshold))


def op4_weak_supervision(spark, sf_dir: str) -> DataFrame:
    """Counts and verdict of every whole document."""
    return judge(read(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "probability"
    )
