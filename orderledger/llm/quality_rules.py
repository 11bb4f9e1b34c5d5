"""Quality by weak supervision, with DataFrame functions only.

Rules vote for (1) or against (-1) a document or abstain (0). Expectation maximisation takes the
true quality as hidden and estimates, for each rule, how often documents of either kind get each
of its votes, and the share of good documents. The posterior probability of quality decides, in
place of a filter that every rule must pass.

The estimate needs the votes only: documents are counted by vote pattern, of which there are at
most 3 to the power of the number of rules however many documents there are, and each round is
one aggregate over that table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderledger.llm.common import words_of, written

WINDOW = 8
ROUNDS = 15
VOTES = (-1, 0, 1)
#: Before the first round: the share of good documents, and P(vote | good or bad). Rules seldom
#: vote against a good document, and a bad one has few faults, so most rules pass it.
START_SHARE = 0.9
START_GIVEN = {1: {-1: 0.02, 0: 0.58, 1: 0.4}, 0: {-1: 0.3, 0: 0.4, 1: 0.3}}
#: Counted for each vote beforehand, so that no probability becomes 0.
PRIOR_VOTES = 1.0

#: Frequent function words of the four languages of the documents (fixed values).
FUNCTION_WORDS = [
    "the", "of", "and", "to", "in", "is", "that", "for", "with", "be",
    "der", "die", "und", "das", "ist", "nicht", "mit", "zu", "den", "ein",
    "le", "la", "les", "des", "et", "est", "que", "pour", "dans", "une",
    "el", "los", "que", "y", "en", "es", "por", "con", "una", "para",
]


def _vote(against: Column, support: Column) -> Column:
    """-1 where `against` holds, else 1 where `support` does, else 0."""
    return F.when(against, -1).when(support, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """The votes of each rule, from the columns of `measured`."""
    words = F.greatest("n_words", F.lit(1))
    chars = F.greatest("word_chars", F.lit(1))
    lines = F.greatest("n_lines", F.lit(1))
    mean_length = F.col("word_chars") / words
    symbols = F.col("n_symbols") / words
    twice = F.col("n_dup_lines") / lines
    repeats = F.col("n_repeat_words") / words
    distinct = F.col("n_distinct_words") / words
    letters = 1 - F.col("n_marks") / chars
    sentences = F.col("n_sentences") / words
    capitals = F.col("n_capitals") / chars
    long = F.col("n_words") >= 30
    never = F.lit(False)
    return {
        "length": _vote(F.col("n_words") < 20, F.col("n_words") >= 50),
        "function_words": _vote(
            long & (F.col("n_function_words") < 2), F.col("n_function_words") >= 3
        ),
        "sentences": _vote(
            long & ((sentences > 0.5) | (sentences < 0.005)), sentences.between(0.02, 0.3)
        ),
        "word_length": _vote((mean_length < 2.5) | (mean_length > 14), never),
        "symbols": _vote(symbols > 0.15, never),
        "line_repeats": _vote((F.col("n_lines") >= 4) & (twice > 0.3), never),
        "word_repeats": _vote(repeats > 0.3, never),
        "vocabulary": _vote((F.col("n_words") >= 100) & (distinct < 0.15), never),
        "letters": _vote(letters < 0.7, never),
        "capitals": _vote(long & (capitals > 0.25), never),
    }


def _joined(hashes: str, width: int) -> Column:
    """The hash of each window and the one `width` words on."""
    later = F.slice(hashes, F.lit(width + 1), F.size(hashes))
    pairs = F.zip_with(
        F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - width, F.lit(0))),
        later,
        lambda a, b: F.xxhash64(a, b),
    )
    return pairs


def _repeat_words(pairs: Column) -> Column:
    """Words covered by the windows of `pairs`, sorted (hash, start), with an equal neighbour.

    Each window adds the words that the ones before it don't cover.
    """
    twins = F.zip_with(
        pairs,
        F.slice(pairs, F.lit(2), F.size(pairs)),
        lambda a, b: F.when(a["hash"] == b["hash"], F.array(a["start"], b["start"])),
    )
    starts = F.sort_array(
        F.array_distinct(F.flatten(F.filter(twins, lambda twin: twin.isNotNull())))
    )
    covered = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("words"), F.lit(-WINDOW).alias("last")),
        lambda acc, start: F.struct(
            (acc["words"] + F.least(start - acc["last"], F.lit(WINDOW))).alias("words"),
            start.alias("last"),
        ),
    )
    return covered["words"]


def measured(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What the rules look at, a row for each row; a NULL text has no words.

    Windows are compared by a 64-bit hash; only texts with two equal hashes sort theirs.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    has_word = "[^\\x20\\x09-\\x0D]"
    split = df.select(F.col(id_col).alias(id_col), F.col(text_col).alias("text")).select(
        id_col,
        "text",
        words_of(F.col("text")).alias("words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(has_word)).alias("lines"),
    )
    hashed = split.withColumn("hashes", F.transform("words", lambda word: F.xxhash64(word)))
    for width in (1, 2, 4):  # of windows of 1, 2 and 4 words, two make one twice as wide
        hashed = hashed.withColumn("hashes", _joined("hashes", width))
    pairs = F.transform(
        "hashes", lambda value, at: F.struct(value.alias("hash"), at.alias("start"))
    )
    twice = F.size(F.array_distinct("hashes")) < F.size("hashes")
    paired = hashed.withColumn("pairs", F.when(twice, F.sort_array(pairs)))
    long = {
        "n_words": F.size("words"),
        "word_chars": F.aggregate("words", F.lit(0), lambda n, word: n + F.length(word)),
        "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": F.when(F.col("pairs").isNull(), 0).otherwise(
            _repeat_words(F.col("pairs"))
        ),
        "n_lines": F.size("lines"),
        "n_distinct_words": F.size(F.array_distinct("words")),
        "n_marks": F.regexp_count(text, F.lit("[^\\p{L}\\x20\\x09-\\x0D]")),
        "n_function_words": F.size(
            F.array_intersect("words", F.array(*map(F.lit, sorted(set(FUNCTION_WORDS)))))
        ),
        "n_sentences": F.regexp_count(text, F.lit("[.!?](?=\\s|$)")),
        "n_capitals": F.regexp_count(text, F.lit("\\p{Lu}")),
    }
    return paired.select(id_col, *(c.cast("bigint").alias(name) for name, c in long.items()))


def _ordered(good: dict, all_good: float, bad: dict, all_bad: float) -> dict:
    """P(vote | kind) from expected counts, where no rule may be worse than chance.

    Where votes against come more often for good documents, or votes for them for bad ones, both
    kinds share one probability: else the two kinds could turn into any two clusters of votes.
    """
    given = {1: {}, 0: {}}
    for vote in (-1, 1):
        p_good = (good[vote] + PRIOR_VOTES) / (all_good + len(VOTES) * PRIOR_VOTES)
        p_bad = (bad[vote] + PRIOR_VOTES) / (all_bad + len(VOTES) * PRIOR_VOTES)
        if (p_good - p_bad) * vote < 0:
            p_good = p_bad = (good[vote] + bad[vote] + 2 * PRIOR_VOTES) / (
                all_good + all_bad + 2 * len(VOTES) * PRIOR_VOTES
            )
        given[1][vote], given[0][vote] = p_good, p_bad
    for kind in given.values():
        kind[0] = max(1e-9, 1 - kind[-1] - kind[1])
    return given


class LabelModel:
    """P(vote | quality) of each rule and P(quality)."""

    def __init__(self, rules: int):
        self.share = START_SHARE
        self.given = [START_GIVEN] * rules

    def posterior(self, votes: Column) -> Column:
        """P(good | votes): the log odds of all votes summed up."""
        weights = [
            math.log(given[1][vote] / given[0][vote]) for given in self.given for vote in VOTES
        ]
        table = F.array(*map(F.lit, weights))
        start = F.lit(math.log(self.share / (1 - self.share)))
        odds = F.aggregate(_cells(votes), start, lambda sum, cell: sum + F.get(table, cell))
        return 1 / (1 + F.exp(-odds))

    def fit(self, patterns: DataFrame, rounds: int = ROUNDS) -> LabelModel:
        """EM over the table of vote patterns (votes, n); an empty one changes nothing."""
        for _ in range(rounds):
            good = F.col("n") * F.col("p")
            counts = (
                patterns.withColumn("p", self.posterior(F.col("votes")))
                .select("n", "p", F.explode(_cells(F.col("votes"))).alias("cell"))
                .groupBy("cell")
                .agg(F.sum(good).alias("good"), F.sum(F.col("n") - good).alias("bad"))
                .collect()  # three rows for each rule
            )
            if not counts:
                return self
            good = {row.cell: row.good for row in counts}
            bad = {row.cell: row.bad for row in counts}
            all_good = sum(good.get(cell, 0.0) for cell in range(len(VOTES)))
            all_bad = sum(bad.get(cell, 0.0) for cell in range(len(VOTES)))
            self.share = min(0.999, max(0.001, all_good / (all_good + all_bad)))
            self.given = [
                _ordered(
                    {vote: good.get(_cell(rule, vote), 0.0) for vote in VOTES},
                    all_good,
                    {vote: bad.get(_cell(rule, vote), 0.0) for vote in VOTES},
                    all_bad,
                )
                for rule in range(len(self.given))
            ]
        return self


def _cell(rule, vote):
    """The place of a rule's vote in a row of all votes of all rules."""
    return rule * len(VOTES) + vote + 1


def _cells(votes: Column) -> Column:
    return F.transform(votes, lambda vote, rule: _cell(rule, vote))


def quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, what was measured, base_failed, `votes`, `p_quality` and `kept`, for every row.

    base_failed: fewer than 20 words, or over 30 % of them in repeated windows; such documents
    are not kept, and others if their posterior is at least one half. A NULL or empty text has 0
    words and fails. Repeated rows and NULL ids are rows like others; other columns are left out.
    The measures are written to a table once, which both the counts of patterns and the result
    read. An empty table gives an empty table.
    """
    votes = F.array(*(vote.cast("int") for vote in rules().values()))
    table = written(measured(df, id_col, text_col).withColumn("votes", votes), "quality")
    patterns = written(table.groupBy("votes").agg(F.count("*").alias("n")), "vote_patterns")
    model = LabelModel(len(rules())).fit(patterns)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return (
        table.withColumn("base_failed", failed)
        .withColumn("p_quality", model.posterior(F.col("votes")))
        .withColumn("kept", ~F.col("base_failed") & (F.col("p_quality") >= 0.5))
    )
