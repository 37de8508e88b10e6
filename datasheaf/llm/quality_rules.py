"""Quality rules by weak supervision.

Each rule votes good (1), bad (-1) or abstains (0). Expectation-maximisation
estimates, without labels, how often each rule gives each vote on good and on
bad documents; a document is judged by its posterior probability of being good.
No rule decides alone: others can outvote it, as far as they are accurate.

Everything a document needs is computed in DataFrame expressions, without a
shuffle. EM reads the counts of the distinct vote patterns: at most 3 to the
power of the number of rules, whatever the size of the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from datasheaf.llm._common import SPACE, let, staged

GOOD, ABSTAIN, BAD = 1, 0, -1
VOTES = (GOOD, ABSTAIN, BAD)

#: All but the characters that count as symbols, and the beginning of a word up to its first symbol.
SYMBOLS = r"[^#*$%&|<>]+"
START, END = r"(?<![^\x20\x09-\x0D])", r"(?![^\x20\x09-\x0D])"
SYMBOL_WORD = START + r"[^\x20\x09-\x0D#*$%&|<>]*+[#*$%&|<>]"
#: A word without letter or digit, and one that ends a clause.
BARE_WORD, ENDED_WORD = START + r"[^\p{L}\p{N}\x20\x09-\x0D]++" + END, r"[.,;:!?]" + END
#: Words that connected text is full of, in English, German, French and Spanish.
FUNCTION_WORDS = (
    "a an and are as at be by for from had has have he in is it of on or that the this to was were with you "
    "das dem den der die ein eine für im ist mit nicht sich und von zu "
    "dans des du elle en est et la le les ne par pas pour que qui sur un une "
    "al como con del el es las lo los más no para por se su"
).split()
FUNCTION_WORD = "(?i)" + START + "(?:" + "|".join(FUNCTION_WORDS) + ")" + END
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def _line_count(lines: Column) -> Column:
    kept = F.filter(lines, lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    return let(kept, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def _repeated(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more.

    A document whose window hashes all differ has none. Otherwise the windows
    themselves are sorted, neighbours compared, and the positions of repeated
    ones merged: n log n for any text, and no hash decides.
    """
    starts = F.sequence(F.lit(0), F.size(words) - 3)
    hashes = F.transform(starts, lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2]))

    def exact() -> Column:
        windows = F.array_sort(F.transform(starts, lambda i: F.struct(F.concat_ws(" ", words[i], words[i + 1], words[i + 2]).alias("w"), i.alias("i"))))

        def among(s: Column) -> Column:
            twice = F.filter(s, lambda x, j: ((j > 0) & (F.get(s, j - 1)["w"] == x["w"])) | ((j < F.size(s) - 1) & (F.get(s, j + 1)["w"] == x["w"])))
            at = F.array_sort(F.transform(twice, lambda x: x["i"]))
            start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
            covered = F.aggregate(at, start, lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")))
            return covered["n"]

        return let(windows, among)

    some = let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(F.size(words) < 4, 0).when(some, exact()).otherwise(0)


def figures(text: Column) -> Column:
    """A struct of the figures of each whole text, all long. A null text has no words; lines are split at ``\\n``."""

    def of(t: Column) -> Column:
        words = F.filter(F.split(t, SPACE), lambda w: w != "")
        return let(
            words,
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                F.length(F.regexp_replace(t, SYMBOLS, "")).cast("long").alias("n_symbols"),
                _line_count(F.split(t, "\n")).cast("long").alias("n_dup_lines"),
                _repeated(w).cast("long").alias("n_repeat_words"),
                F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
                F.length(F.regexp_replace(t, "[^A-Z]+", "")).cast("long").alias("n_capitals"),
                F.size(F.split(t, "\n")).cast("long").alias("n_lines"),
                F.regexp_count(t, F.lit(SYMBOL_WORD)).cast("long").alias("n_symbol_words"),
                F.regexp_count(t, F.lit(BARE_WORD)).cast("long").alias("n_bare_words"),
                F.regexp_count(t, F.lit(FUNCTION_WORD)).cast("long").alias("n_function_words"),
                F.regexp_count(t, F.lit(ENDED_WORD)).cast("long").alias("n_ended_words"),
            ),
        )

    return let(F.coalesce(text, F.lit("")), of)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _vote(bad: Column, good: Column) -> Column:
    return F.when(F.col("n_words") == 0, F.lit(ABSTAIN)).when(bad, F.lit(BAD)).when(good, F.lit(GOOD)).otherwise(F.lit(ABSTAIN))


def _share(part: Column, whole: Column, bad: float, good: float) -> Column:
    """Bad where a part is larger than ``bad`` of the whole, good where it is ``good`` at most."""
    return _vote(part > bad * whole, part <= good * whole)


def default_rules() -> dict[str, Column]:
    """Rules that overlap: junk of one kind shows in several figures, so that they can tell each other's accuracy."""
    words, chars, ended = F.col("n_words"), F.col("word_chars"), F.col("n_ended_words")
    return {
        "length": _vote(words < MIN_WORDS / 2, words >= 2 * MIN_WORDS),
        "word_length": _vote((chars < 3 * words) | (chars > 10 * words), (chars > 4 * words) & (chars < 7 * words)),
        "symbols": _share(F.col("n_symbols"), chars, 0.05, 0.01),
        "symbol_words": _share(F.col("n_symbol_words"), words, 0.1, 0.02),
        "bare_words": _share(F.col("n_bare_words"), words, 0.1, 0.02),
        "function_words": _vote(50 * F.col("n_function_words") < words, 16 * F.col("n_function_words") >= words),
        "ended_words": _vote((33 * ended < words) | (2 * ended > words), (16 * ended >= words) & (3 * ended <= words)),
        "repeated_lines": _share(F.col("n_dup_lines"), F.col("n_lines"), 0.4, 0.1),
        "repeated_words": _share(F.col("n_repeat_words"), words, 0.45, 0.1),
        "variety": _vote((words >= MIN_WORDS) & (10 * F.col("n_distinct") < words), 4 * F.col("n_distinct") >= words),
        "capitals": _share(F.col("n_capitals"), chars, 0.3, 0.1),
    }


@dataclass(frozen=True)
class VoteModel:
    """share: prior probability of good. odds[rule][vote]: log of P(vote | good, it votes) / P(vote | bad, it votes)."""

    share: float
    odds: Mapping[str, Mapping[int, float]] = field(default_factory=dict)

    def probability(self) -> Column:
        """Posterior probability of good, from the vote columns."""
        total = F.lit(math.log(self.share / (1 - self.share)))
        for rule, by_vote in self.odds.items():
            vote = F.col(f"vote_{rule}")
            total = total + F.when(vote == GOOD, by_vote[GOOD]).when(vote == BAD, by_vote[BAD]).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def fit_votes(counts: Sequence[tuple[tuple[int, ...], int]], rules: Sequence[str], rounds: int = 200, smooth: float = 1.0) -> VoteModel:
    """EM over (votes, number of documents) of the distinct patterns.

    A document starts out as good as the share of good ones among its votes.
    Then, in turn: how often is each rule right about the documents that it
    votes on, given how good they are; and how good are they, given how often
    each rule is right. A rule is held to be right no less often than a coin, so
    the two classes can't change places. Abstaining says nothing. ``smooth``
    pseudo votes of each kind keep probabilities inside (0, 1); an empty corpus
    gives a model without odds.
    """
    good = [(smooth + votes.count(GOOD)) / (2 * smooth + len(votes) - votes.count(ABSTAIN)) for votes, _ in counts]
    share, odds = 0.5, {r: dict.fromkeys(VOTES, 0.0) for r in rules}
    for _ in range(rounds):
        all_good = smooth + sum(n * p for (_, n), p in zip(counts, good, strict=True))
        all_bad = smooth + sum(n * (1 - p) for (_, n), p in zip(counts, good, strict=True))
        share = all_good / (all_good + all_bad)
        for j, rule in enumerate(rules):
            seen = {(c, v): smooth for c in (GOOD, BAD) for v in (GOOD, BAD)}
            for (votes, n), p in zip(counts, good, strict=True):
                if votes[j] != ABSTAIN:
                    seen[GOOD, votes[j]] += n * p
                    seen[BAD, votes[j]] += n * (1 - p)
            right = {c: seen[c, c] / (seen[c, GOOD] + seen[c, BAD]) for c in (GOOD, BAD)}
            odds[rule] = {
                GOOD: max(0.0, math.log(right[GOOD]) - math.log(1 - right[BAD])),
                ABSTAIN: 0.0,
                BAD: min(0.0, math.log(1 - right[GOOD]) - math.log(right[BAD])),
            }
        before, good = good, []
        for votes, _ in counts:
            total = math.log(share / (1 - share)) + sum(odds[r][v] for r, v in zip(rules, votes, strict=True))
            good.append(1 / (1 + math.exp(-max(-500.0, min(500.0, total)))))
        if all(abs(a - b) < 1e-9 for a, b in zip(before, good, strict=True)):
            break
    return VoteModel(share, odds)


def judged(docs: DataFrame, keep: Mapping[str, Column], rules: Mapping[str, Column] | None = None, min_probability: float = 0.5, text_col: str = "text") -> DataFrame:
    """The ``keep`` columns, under names that don't clash with the figures', then figures, votes, quality_prob, base_failed, kept.

    The figures are computed once: what the votes are counted from is written to
    the shared folder and read again.
    """
    rules = dict(rules or default_rules())
    votes = [f"vote_{r}" for r in rules]
    rows = docs.select(*[c.alias(n) for n, c in keep.items()], figures(F.col(text_col)).alias("figures__"))
    voted = staged(rows.select(*keep, "figures__.*").withColumns({f"vote_{r}": c.cast("int") for r, c in rules.items()}), "votes")
    counts = sorted((tuple(r[v] for v in votes), r["n"]) for r in voted.groupBy(*votes).agg(F.count("*").alias("n")).collect())
    model = fit_votes(counts, list(rules))
    return (
        voted.withColumn("quality_prob", model.probability())
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality_prob") >= min_probability))
    )


def judge_quality(docs: DataFrame, rules: Mapping[str, Column] | None = None, min_probability: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, the figures, the votes, quality_prob, base_failed, kept.

    kept is false if the base rules fail, else true where the posterior
    probability of good is at least ``min_probability``. Null and empty texts
    have no words and fail the base. Null ids and repeated rows are judged like
    any other row; other columns aren't read. An empty table gives no rows.
    """
    return judged(docs, {"doc_id": F.col(id_col)}, rules, min_probability, text_col)


def good_documents(docs: DataFrame, rules: Mapping[str, Column] | None = None, min_probability: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that judge_quality keeps, with all their columns, whatever their names."""
    keep = {f"column__{i}": docs[c] for i, c in enumerate(docs.columns)}
    found = judged(docs, keep, rules, min_probability, text_col).filter("kept")
    return found.select(*[F.col(n).alias(c) for n, c in zip(keep, docs.columns, strict=True)])
