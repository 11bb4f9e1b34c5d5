"""Phrase collocations by mergeable Misra-Gries summaries and an exact second pass.

Everything is per language. Texts are cut at punctuation and line ends into pieces, pieces into
words; an n-gram is n words in a row within a piece.

1. First pass, for n from 1 to the longest phrase: each task adds up the n-grams of its texts by a
   64-bit name; names are dealt to hash partitions, and each partition keeps a Misra-Gries summary.
   A summary that holds more names than its capacity gives up the same amount of every count. The
   capacity exceeds mass / threshold, so that what has been given up stays below the threshold and
   every frequent n-gram survives; if it should not, the capacity grows.
   Of n-grams beyond words only those go to the summaries whose n-1 first and last words survived:
   others cannot be frequent.
2. Second pass: n-grams whose names survived are counted by their words, exactly.
3. Scores of the cuts from the exact counts, in decimals; phrases inside equally frequent longer ones
   go; each language's first phrases by score.

The texts are cut into words twice, for each pass: the first one leaves a table of their hashes, which
all lengths of n-grams read. What survived is told to the tasks by a filter of FILTER_BITS bits, whose size does not grow: a name
that it lets through by chance costs a count and no more. All shuffles are of counts that have been
added up before, so a frequent word is a row for each task.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderledger.llm.common import text_groups, written

#: Words of the longest phrase, occurrences of a frequent one, and phrases of each language.
MOST_WORDS, LEAST, TOP = 5, 100, 2000
#: A phrase goes if a longer one around it has this share of its occurrences.
PERCENT = 100
FILTER_BITS = 1 << 26
#: Counters of a summary at first, names that a task adds up at once, and words that it remembers.
CAPACITY, BUFFER, VOCABULARY = 1 << 18, 1 << 20, 1 << 19
#: Characters of the texts that a task cuts into words at once, and words that it names at once.
GROUP_CHARS, GROUP_WORDS = 500_000, 100_000
#: No part of a phrase that is joined by hash has more than 1 / HOT of the rows.
HOT = 1000

UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
#: Where pieces end; all of these become the first one, which no word can hold then.
STOPS = b".,;:!?\n\x0b\x0c\r"
LETTERS = bytes.maketrans(UPPER + STOPS + b"\t", LOWER + b"." * len(STOPS) + b" ")
STOP_PATTERN = re.compile("[.,;:!?\n\x0b\x0c\r]")
UNKNOWN = "und"
_MIX = np.random.default_rng(29).integers(0, 2**63, 4, dtype=np.uint64) * np.uint64(2)
_MIX += np.uint64(1)


def cut_words(text: str) -> bytes:
    """A text in lower case (A-Z only): words between blanks, and "." between pieces."""
    return text.encode().translate(LETTERS).replace(b".", b" . ")


def _text_parts(text: str) -> Iterator[str]:
    """A long text cut at ends of pieces."""
    begin = 0
    while len(text) - begin > GROUP_CHARS:
        stop = STOP_PATTERN.search(text, begin + GROUP_CHARS)
        if not stop:
            break
        yield text[begin : stop.end()]
        begin = stop.end()
    yield text[begin:]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * _MIX[2]
    return x ^ (x >> np.uint64(29))


class Words(dict):
    """Numbers of the words that a task has met; 0 is where a piece ends, 1 where a text does."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.hashes = [0, 0]
        self.update({b".": 0, b"..": 1})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.hashes)
        self.hashes.append(xxhash.xxh3_64_intdigest(word) >> 32 | 1)
        return number


class Texts:
    """Some texts cut into words: the words, their numbers and hashes, and where each text ends."""

    def __init__(self, words: Words, texts: list[str]):
        if len(words) > VOCABULARY:
            words.clear()
        parts = (b"".join(map(cut_words, _text_parts(text))) for text in texts)
        # No word has a stop in it, so two are free to stand for the end of a text.
        self.words = (b" .. ".join(parts) + b" ..").split()
        self.ids = np.fromiter(map(words.__getitem__, self.words), np.int64, len(self.words))
        self.hashes = np.array(words.hashes, np.uint32)[self.ids]
        self.ends = np.flatnonzero(self.ids == 1) + 1


class Grams:
    """The n-grams of some texts: their names, and where an n-gram may begin.

    The hash of a word is never 0; 0 is where a piece ends, and the last one of a text. Hashes have 32
    bits, so that their table stays small: equal names of unlike n-grams only add to what survives.
    """

    def __init__(self, languages: list[str], hashes: np.ndarray, ends: np.ndarray):
        self.languages = sorted(set(languages))
        place = {language: k for k, language in enumerate(self.languages)}
        lengths = np.diff(ends, prepend=0)
        self.language = np.repeat(np.array([place[x] for x in languages], np.int64), lengths)
        self.hashes = hashes.astype(np.uint64)
        salts = [xxhash.xxh3_64_intdigest(language.encode()) for language in self.languages]
        self.salt = np.array(salts, np.uint64)[self.language]
        here = np.arange(len(hashes))
        stops = np.where(hashes == 0, here, len(hashes))
        #: Words from here to the end of the piece.
        self.run = np.minimum.accumulate(stops[::-1])[::-1] - here

    def names(self) -> Iterator[np.ndarray]:
        """For n = 1, 2, ...: the names of the n-grams that begin at each place."""
        name = _mixed(self.hashes * _MIX[0] + self.salt)
        yield name
        for n in range(1, MOST_WORDS):
            after = np.zeros_like(self.hashes)
            after[: max(0, len(after) - n)] = self.hashes[n:]
            name = _mixed(name * _MIX[1] + after * _MIX[3])
            yield name


def _cutter(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = Words()
    for languages, texts in text_groups(batches, GROUP_CHARS):
        cut = Texts(words, texts)
        own = np.split(cut.hashes, cut.ends[:-1])
        yield pa.RecordBatch.from_arrays(
            [languages, pa.array([hashes.tobytes() for hashes in own], pa.binary())],
            names=["language", "hashes"],
        )


def hashed_words(texts: DataFrame) -> DataFrame:
    """language and the packed hashes of the words of each text, written."""
    cut = texts.mapInArrow(_cutter, "language string, hashes binary")
    return written(cut, "words", compression="zstd")


def _grams(batches: Iterable[pa.RecordBatch]) -> Iterator[Grams]:
    """The n-grams of some GROUP_WORDS words at once."""
    for batch in batches:
        languages, column = batch.column("language").to_pylist(), batch.column("hashes")
        begin, parts, size = 0, [], 0
        for at in range(batch.num_rows):
            parts.append(np.frombuffer(column[at].as_buffer(), np.uint32))
            size += len(parts[-1])
            if size >= GROUP_WORDS or at + 1 == batch.num_rows:
                ends = np.cumsum(list(map(len, parts)))
                yield Grams(languages[begin : at + 1], np.concatenate(parts), ends)
                begin, parts, size = at + 1, [], 0


def filter_places(name: Column) -> Column:
    """The two bits of a name in the filter."""
    bits = FILTER_BITS.bit_length() - 1
    low = F.shiftrightunsigned(name, 12).bitwiseAND(F.lit(FILTER_BITS - 1))
    return F.array(F.shiftrightunsigned(name, 64 - bits), low)


class Filter:
    """Bits of the names that survived."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def holds(self, names: np.ndarray) -> np.ndarray:
        bits = FILTER_BITS.bit_length() - 1
        high = names >> np.uint64(64 - bits)
        low = (names >> np.uint64(12)) & np.uint64(FILTER_BITS - 1)
        return (self._bit(high) & self._bit(low)).astype(bool)

    def _bit(self, place: np.ndarray) -> np.ndarray:
        return (self.bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1)


def _filter_of(survivors: DataFrame) -> Filter:
    """At most FILTER_BITS / 64 words of bits come to the driver, however many names there are."""
    place = F.explode(filter_places(F.col("name"))).alias("place")
    words = (
        survivors.select(place)
        .groupBy(F.shiftright("place", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, int(place & 63))")).alias("bits"))
        .toArrow()
    )
    bits = np.zeros(FILTER_BITS // 64, np.uint64)
    bits[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return Filter(bits)


class Summary:
    """A Misra-Gries summary: names, the counts that are left of them, and what each may have lost.

    A name's true count is at least its count here and at most that plus `lost`; a name that is
    not here has at most `lost`, which stays below the threshold.
    """

    def __init__(self, threshold: int = LEAST, capacity: int = CAPACITY):
        self.threshold, self.capacity = threshold, capacity
        self.names, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)
        self.lost = self.mass = 0

    def add(self, names: np.ndarray, counts: np.ndarray) -> None:
        """Counts of names, each name any number of times."""
        self.mass += int(counts.sum())
        names = np.concatenate([self.names, names])
        order = np.argsort(names, kind="stable")
        names = names[order]
        first = np.flatnonzero(np.r_[True, names[1:] != names[:-1]]) if len(names) else []
        counts = np.concatenate([self.counts, counts])[order]
        self.counts = np.add.reduceat(counts, first) if len(names) else counts
        self.names = names[first] if len(names) else names
        self.capacity = max(self.capacity, self.mass // self.threshold + 1)
        while len(self.names) > self.capacity:
            self._shrink()

    def _shrink(self) -> None:
        """All give up as much as leaves no more names than the capacity."""
        given = int(np.partition(self.counts, -self.capacity - 1)[-self.capacity - 1])
        if self.lost + given >= self.threshold:
            self.capacity *= 2
            return
        self.lost += given
        left = self.counts > given
        self.names, self.counts = self.names[left], self.counts[left] - given

    def merge(self, other: Summary) -> None:
        """The summary of both streams."""
        self.lost += other.lost
        self.mass += other.mass - int(other.counts.sum())
        self.add(other.names, other.counts)

    def frequent(self) -> np.ndarray:
        """All names that may reach the threshold."""
        return self.names[self.counts + self.lost >= self.threshold]


def _summarizer(threshold: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary, waiting, size = Summary(threshold), [], 0

        def take_in() -> None:
            summary.add(*(np.concatenate(parts) for parts in zip(*waiting)))

        for batch in batches:
            waiting.append((batch.column("name").to_numpy(), batch.column("n").to_numpy()))
            size += batch.num_rows
            if size >= max(BUFFER, summary.capacity):
                take_in()
                waiting, size = [], 0
        if waiting:
            take_in()
        yield pa.RecordBatch.from_arrays([pa.array(summary.frequent())], names=["name"])

    return run


def _name_counter(n: int, shorter) -> Callable:
    """Names and counts of n-grams; `shorter`: the filter of the n-1-grams that survived."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met, size = [], 0

        def added_up() -> pa.RecordBatch:
            names, counts = np.unique(np.concatenate(met), return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(names.view(np.int64)), pa.array(counts.astype(np.int64))],
                names=["name", "n"],
            )

        for grams in _grams(batches):
            names = list(zip(range(n), grams.names()))
            begins = grams.run >= n
            if n > 1:
                alive = shorter.value.holds(names[-2][1])
                begins &= alive
                begins[:-1] &= alive[1:]
            met.append(names[-1][1][begins])
            size += len(met[-1])
            if size >= BUFFER:
                yield added_up()
                met, size = [], 0
        if size:
            yield added_up()

    return run


def survivors(words: DataFrame, n: int, shorter, threshold: int) -> DataFrame:
    """The names of all n-grams that may be frequent; `words` are hashed ones."""
    names = words.mapInArrow(_name_counter(n, shorter), "name bigint, n bigint")
    return written(
        names.repartition("name").mapInArrow(_summarizer(threshold), "name bigint"), "survivors"
    )


COUNTS = "language string, words int, phrase string, n bigint"


def _phrase_counter(known) -> Callable:
    """Counts of the phrases whose names survived; words 0 is all words of a language."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_met = Words()
        for languages, texts in text_groups(batches, GROUP_CHARS):
            cut = Texts(words_met, texts)
            grams = Grams(languages.to_pylist(), cut.hashes, cut.ends)
            totals = np.bincount(grams.language[grams.run >= 1], minlength=len(grams.languages))
            rows = [[language, 0, "", int(n)] for language, n in zip(grams.languages, totals) if n]
            # Equal numbers for equal phrases: of the phrase without its last word, and of that word.
            number, alive = grams.language, np.ones(len(cut.ids), bool)
            width = int(cut.ids.max(initial=0)) + 1
            for n, names in enumerate(grams.names(), 1):
                before, alive = alive, (grams.run >= n) & alive
                if n > 1:
                    alive[:-1] &= before[1:]
                at = np.flatnonzero(alive)
                at = at[known.value.holds(names[at])]
                if not len(at):
                    break
                keys = number[at] * width + cut.ids[at + n - 1]
                _, first, same, counts = np.unique(
                    keys, return_index=True, return_inverse=True, return_counts=True
                )
                alive = np.zeros(len(cut.ids), bool)
                alive[at] = True
                number = np.zeros(len(cut.ids), np.int64)
                number[at] = same
                for place, count in zip(at[first].tolist(), counts.tolist()):
                    phrase = b" ".join(cut.words[place : place + n]).decode()
                    rows.append([grams.languages[grams.language[place]], n, phrase, count])
            language, words, phrase, count = zip(*rows) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(language, pa.string()),
                    pa.array(words, pa.int32()),
                    pa.array(phrase, pa.string()),
                    pa.array(count, pa.int64()),
                ],
                names=["language", "words", "phrase", "n"],
            )

    return run


def frequent_phrases(
    texts: DataFrame, threshold: int = LEAST, most_words: int = MOST_WORDS
) -> DataFrame:
    """language, words, phrase, n: exact counts of all frequent phrases, and of all words (0)."""
    spark, shorter, all_bits = texts.sparkSession, None, None
    words = hashed_words(texts)
    for n in range(1, most_words + 1):
        found = _filter_of(survivors(words, n, shorter, threshold))
        if not found.bits.any():
            break
        all_bits = found.bits if all_bits is None else all_bits | found.bits
        shorter = spark.sparkContext.broadcast(found)
    if all_bits is None:
        all_bits = np.zeros(FILTER_BITS // 64, np.uint64)
    known = spark.sparkContext.broadcast(Filter(all_bits))
    counted = texts.mapInArrow(_phrase_counter(known), COUNTS)
    return written(
        counted.groupBy("language", "words", "phrase")
        .agg(F.sum("n").alias("n"))
        .filter((F.col("words") == 0) | (F.col("n") >= threshold)),
        "phrases",
    )


def _with_counts(parts: DataFrame, counts: DataFrame) -> DataFrame:
    """Adds `f`, the count of `part`; parts that many rows have are joined by broadcast.

    There are at most HOT of these.
    """
    met = written(parts.groupBy("language", "part").agg(F.count("*").alias("rows")), "part_rows")
    share = met.agg(F.sum("rows")).first()[0] or 0
    own = counts.select("language", F.col("phrase").alias("part"), F.col("n").alias("f"))
    hot = met.filter(F.col("rows") * HOT > share).select("language", "part")
    hot = F.broadcast(hot.join(own, ["language", "part"]))
    cold = parts.join(hot, ["language", "part"], "left_anti").join(own, ["language", "part"])
    return parts.join(hot, ["language", "part"]).unionByName(cold)


def scored_phrases(counts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """language, phrase, a, l, r, n, score of the phrases that no longer one stands for."""
    phrases = counts.filter("words > 1").select(
        "language", "phrase", "words", F.col("n").alias("a")
    )
    listed = phrases.withColumn("list", F.split("phrase", " "))
    cuts = listed.withColumn("k", F.explode(F.expr("sequence(1, words - 1)")))
    part = "array_join(slice(list, {}, {}), ' ')"
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.expr(part.format("1", "k")).alias("part")),
        F.struct(F.lit(1).alias("side"), F.expr(part.format("k + 1", "words")).alias("part")),
    )
    parts = cuts.select("language", "phrase", "a", "k", F.inline(sides))
    sides = (
        _with_counts(written(parts, "phrase_parts"), counts)
        .groupBy("language", "phrase", "a", "k")
        .agg(
            F.max(F.when(F.col("side") == 0, F.col("f"))).alias("l"),
            F.max(F.when(F.col("side") == 1, F.col("f"))).alias("r"),
        )
    )
    totals = counts.filter("words = 0").select("language", "n")
    exact = (
        "CAST(1000 AS DECIMAL(4,0)) * (CAST(a AS DECIMAL(15,0)) * CAST(n AS DECIMAL(18,0))) "
        "div (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0)))"
    )
    worst = (
        sides.join(totals, "language")
        .withColumn("score", F.expr(exact))
        .groupBy("language", "phrase")
        .agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("cut"))
        .select("language", "phrase", "cut.*")
    )
    inner = (
        "flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1), "
        "i -> array_join(slice(list, i, m), ' '))))"
    )
    around = (
        listed.filter("words > 2")
        .select("language", F.explode(F.expr(inner)).alias("phrase"), "a")
        .groupBy("language", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    stands = F.coalesce(100 * F.col("longer") >= percent * F.col("a"), F.lit(False))
    return (
        worst.join(around, ["language", "phrase"], "left")
        .filter(~stands)
        .select("language", "phrase", "a", "l", "r", "n", "score")
    )


def collocations(
    df: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    top: int = TOP,
    threshold: int = LEAST,
    percent: int = PERCENT,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's first `top` phrases.

    Phrases of 2 to 5 words that occur `threshold` times or more, by score, occurrences (both
    descending) and phrase. A NULL language counts as "und", a NULL text as empty. Every row counts,
    repeated ones too; other columns are left out; an empty table gives an empty table.
    """
    texts = df.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("language"),
        F.col(text_col).alias("text"),
    )
    scored = scored_phrases(frequent_phrases(texts, threshold), percent)
    order = Window.partitionBy("language").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        scored.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= top)
        .select(
            F.col("language").alias("lang"),
            F.col("rank").cast("bigint").alias("rank"),
            "phrase",
            "a",
            "l",
            "r",
            "n",
            "score",
        )
    )
