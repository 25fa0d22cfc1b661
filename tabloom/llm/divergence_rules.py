"""Quality rules: counts of words and lines, and distance from the statistics of real languages.

The distribution rule compares two histograms of a document with those of each reference language
by Jensen-Shannon distance (the root of the divergence in bits, 0 to 1): the classes of its
characters, and its share of each of the language's most common words, all others together being
one more bin. The language that fits best counts; the declared one plays no part. A histogram
of too few items says nothing, so each has a least size below which it is not compared.

All of it is a projection: no shuffle, and a document is judged by itself.

Defined results: a null text is empty. An empty text has no words, fails the base rules and is
not kept. A text of any length is read whole. Columns of the table are left as they are.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import WHITE, let, text_of, words_of

# The most frequent words of each language, the most frequent first.
COMMON_WORDS = {
    "en": "the of and to a in is that it for was on with as by be this are at from".split(),
    "de": "der die und in den von zu das mit sich des auf für ist dem im nicht ein eine als".split(),
    "fr": "de la le et les des en un du une que pour est dans qui par sur pas au avec".split(),
    "es": "de la que el en y los se las del un por con no una su para al es lo".split(),
}

_LISTED = sorted({word for listed in COMMON_WORDS.values() for word in listed})
#: Characters from here on stand for the words, one for each: from "!" to "~" there are 94.
_FIRST_CODE = 33

# Shares of lower-case letters, capitals, digits, punctuation and other characters in prose.
CHARACTER_SHARES = {"lower": 0.93, "upper": 0.03, "digit": 0.01, "punctuation": 0.025, "other": 0.005}

_PUNCTUATION = r".,;:!?'\"()\-"
_EDGES = ".,;:!?'\"()"
_CLASSES = {"lower": r"[^\p{Ll}]+", "upper": r"[^\p{Lu}]+", "digit": "[^0-9]+", "punctuation": f"[^{_PUNCTUATION}]+"}


class Limits(NamedTuple):
    """Distances up to which a document passes, and the least sizes from which they are taken.

    A document also fails if both distances exceed the share ``jointly`` of their limits.
    """

    characters: float = 0.24
    words: float = 0.345
    jointly: float = 0.8
    least_characters: int = 200
    least_words: int = 50


def zipf(rank: int) -> float:
    """The share of the word of this rank (from 1) in running text."""
    return 0.065 / rank


def _js_distance(pairs: list[tuple[Column, float]]) -> Column:
    """Of the shares in the document from those in the reference."""

    def term(p: Column, q: float) -> Column:
        whole = p + F.lit(q)
        of_p = F.when(p > 0, p * F.log2(2 * p / whole)).otherwise(0.0)
        return (of_p + F.lit(q) * F.log2(F.lit(2 * q) / whole)) / 2

    divergence = reduce(Column.__add__, (term(p, q) for p, q in pairs))
    return F.sqrt(F.greatest(divergence, F.lit(0.0)))


def _windows(words: Column) -> Column:
    """The hash of every three words that follow one another."""
    return F.transform(
        F.sequence(F.lit(1), F.size(words) - 2),
        lambda i: F.xxhash64(F.element_at(words, i), F.element_at(words, i + 1), F.element_at(words, i + 2)),
    )


def _repeated_words(words: Column) -> Column:
    """The words in windows of three found twice or more.

    A text whose windows all differ has none. Otherwise, sorted by hash, equal windows are
    neighbours; the places of repeated ones are walked in order, each adding the words that the
    last did not reach.
    """

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        equal = lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))
        repeated = let(
            placed, lambda all_: F.filter(all_, lambda w, k: equal(w, F.get(all_, k - 1)) | equal(w, F.get(all_, k + 1)))
        )
        return let(
            F.sort_array(F.transform(repeated, lambda w: w["i"])),
            lambda places: F.aggregate(
                F.transform(places, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(places, k + 1) - p, F.lit(3)))),
                F.lit(0),
                lambda total, n: total + n,
            ),
        )

    differ = lambda hashes: F.size(F.array_distinct(hashes)) == F.size(hashes)
    return F.when(F.size(words) < 3, F.lit(0)).otherwise(
        let(_windows(words), lambda hashes: F.when(differ(hashes), F.lit(0)).otherwise(covered(hashes)))
    )


def _counts(text: Column, words: Column) -> Column:
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(WHITE)) != "")
    whole = {
        "n_words": F.size(words),
        "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")),
        "n_dup_lines": let(lines, lambda found: F.size(found) - F.size(F.array_distinct(found))),
        "n_repeat_words": _repeated_words(words),
    } | {name: F.length(F.regexp_replace(text, others, "")) for name, others in _CLASSES.items()}
    return F.struct(*(n.cast("bigint").alias(name) for name, n in whole.items()), _listed(words).alias("listed"))


def _listed(words: Column) -> Column:
    """The common words of the text, one character for each, which is counted by leaving it out."""
    short = F.filter(words, lambda w: F.length(F.btrim(w, F.lit(_EDGES))) <= max(map(len, _LISTED)))
    bare = F.transform(short, lambda w: F.lower(F.btrim(w, F.lit(_EDGES))))
    place = lambda w: F.find_in_set(w, F.lit(",".join(_LISTED)))
    codes = F.transform(F.filter(bare, lambda w: w.isin(_LISTED)), lambda w: F.char(place(w) + F.lit(_FIRST_CODE - 1)))
    return F.array_join(codes, "")


def _distances(counts: Column) -> Column:
    size = F.greatest(counts["n_words"], F.lit(1)).cast("double")
    held = F.greatest(counts["word_chars"], F.lit(1)).cast("double")

    def share(place: int) -> Column:
        without = F.replace(counts["listed"], F.lit(chr(_FIRST_CODE + place)), F.lit(""))
        return (F.length(counts["listed"]) - F.length(without)) / size

    def to_language(listed: list[str], shares: Column) -> Column:
        p = [shares[_LISTED.index(w)] for w in listed]
        rest = F.lit(1.0) - reduce(Column.__add__, p)
        pairs = [(share, zipf(r + 1)) for r, share in enumerate(p)]
        return _js_distance([*pairs, (F.greatest(rest, F.lit(0.0)), 1 - sum(q for _, q in pairs))])

    def nearest(shares: Column) -> Column:
        return F.least(*(to_language(listed, shares) for listed in COMMON_WORDS.values()))

    classes = {n: counts[n] / held for n in _CLASSES}
    other = F.lit(1.0) - reduce(Column.__add__, classes.values())
    pairs = [(classes[n], q) for n, q in CHARACTER_SHARES.items() if n != "other"]
    pairs.append((F.greatest(other, F.lit(0.0)), CHARACTER_SHARES["other"]))
    return F.struct(
        _js_distance(pairs).alias("characters"),
        let(F.array(*map(share, range(len(_LISTED)))), nearest).alias("words"),
    )


def _verdict(c: Column, d: Column, limits: Limits) -> Column:
    base_failed = (c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])

    def beyond(part: float) -> tuple[Column, Column]:
        return (
            (c["word_chars"] >= limits.least_characters) & (d["characters"] > part * limits.characters),
            (c["n_words"] >= limits.least_words) & (d["words"] > part * limits.words),
        )

    (by_characters, by_words), (near_characters, near_words) = beyond(1.0), beyond(limits.jointly)
    far = by_characters | by_words | (near_characters & near_words)
    return F.struct(
        *(c[n].alias(n) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        base_failed.alias("base_failed"),
        d["characters"].alias("character_distance"),
        d["words"].alias("word_distance"),
        (~base_failed & ~far).alias("kept"),
    )


def quality_of(text: Column | str, limits: Limits = Limits()) -> Column:
    """The struct of counts, base_failed, the two distances and kept, as one expression."""

    def judge(content: Column, words: Column) -> Column:
        return let(_counts(content, words), lambda c: let(_distances(c), lambda d: _verdict(c, d, limits)))

    return let(text_of(text), lambda content: let(words_of(content), lambda words: judge(content, words)))


def assess(documents: DataFrame, out: str = "quality", text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """Add the struct ``out`` of ``quality_of``."""
    return documents.withColumn(out, quality_of(text, limits))


def passing(documents: DataFrame, text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """The documents that pass, all columns as they were."""
    return documents.where(quality_of(text, limits)["kept"])
