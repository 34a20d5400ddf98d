"""Quality rules as weak supervision: rules vote or abstain, and expectation-maximisation weighs them.

Each rule looks at one measure of a document and votes bad, good, or not at all. The accuracy of every rule is
estimated from the votes on all documents, without labels, and a document is kept by its posterior probability
instead of by passing every rule.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthlake.llm import common

# The characters that count as symbols, and the base conditions.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

BAD, GOOD, ABSTAIN = 0, 1, 2


@dataclass(frozen=True)
class Rule:
    """Bad from ``bad`` on, good up to ``good`` (if there is one), no vote between.

    ``measure`` is SQL over the measures of a row. A rule for one kind of fault has no good votes: that a text lacks
    this fault says little about it.
    """

    name: str
    measure: str
    bad: float
    good: float | None = None


RULES = (
    Rule("plain_words", "1 - n_plain / n_words", bad=0.4, good=0.1),
    Rule("capitals", "n_capitals / word_chars", bad=0.3, good=0.1),
    Rule("symbols", "n_symbols / n_words", bad=0.1),
    Rule("symbol_characters", "n_symbols / word_chars", bad=0.03),
    Rule("shouting", "n_marks / n_words", bad=0.2),
    Rule("repeated_words", "n_repeat_words / n_words", bad=0.4),
    Rule("repeated_lines", "n_dup_lines / n_lines", bad=0.4),
    Rule("digits", "n_digits / word_chars", bad=0.2),
)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_plain", "n_capitals", "n_marks", "n_digits")


def _flag(characters: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters)] = True
    return out


_SYMBOL, _MARK = _flag(SYMBOLS), _flag(b"!?")
_UPPER, _DIGIT = _flag(bytes(range(65, 91))), _flag(bytes(range(48, 58)))
_LATER_BYTE = _flag(bytes(range(128, 192)))
_LETTER = _flag(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))
_STOP = _flag(b".,;:")


def _sums(flag: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flag)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: whether it occurs twice or more, and whether an equal one came before."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    again, twice = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    again[order[1:]] = same
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    return twice, again


def measure_texts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """MEASURES of every text. Capitals are ASCII ones or C3 80 to C3 9E, the Latin-1 capitals in UTF-8."""
    n = len(offsets) - 1
    starts, ends, owner = common.words_of(data, offsets)
    salt = common.mix(np.arange(n, dtype=np.uint64))
    bytes_hashed = common.Hasher(common.SYMBOLS[data])
    words = common.word_hashes(data, starts, ends)
    out = {"n_words": np.bincount(owner, minlength=n)}
    letter = ~common.SEPARATORS[data]
    out["word_chars"] = _sums(letter & ~_LATER_BYTE[data], offsets)
    out["n_symbols"] = _sums(_SYMBOL[data], offsets)
    out["n_marks"] = _sums(_MARK[data], offsets)
    out["n_digits"] = _sums(_DIGIT[data], offsets)
    capital = _UPPER[data]
    if len(data) > 1:
        capital[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    out["n_capitals"] = _sums(capital, offsets)
    # Plain words: letters, and one stop at most, at the end.
    odd = np.concatenate([[0], np.cumsum(~_LETTER[data], dtype=np.int32)])
    strange = odd[ends] - odd[starts]
    plain = (strange == 0) | ((strange == 1) & _STOP[data[ends - 1]] & (ends - starts > 1)) if len(starts) else np.zeros(0, bool)
    out["n_plain"] = np.bincount(owner[plain], minlength=n)

    # Lines with a word: each line begins behind a line feed or where its text begins.
    feeds = np.flatnonzero(data == 0x0A)
    begin = np.union1d(feeds + 1, offsets[:-1])
    begin = begin[begin < len(data)]
    word_in = np.unique(np.searchsorted(begin, starts, side="right") - 1)
    line_owner = np.searchsorted(offsets, begin[word_in], side="right") - 1
    stop = np.searchsorted(feeds, begin[word_in])
    line_end = np.minimum(np.append(feeds, len(data))[stop], offsets[line_owner + 1])
    lines = bytes_hashed.ranges(begin[word_in], line_end) ^ salt[line_owner]
    out["n_lines"] = np.bincount(line_owner, minlength=n)
    out["n_dup_lines"] = np.bincount(line_owner[_repeats(lines)[1]], minlength=n)

    at = np.flatnonzero(owner[2:] == owner[:-2]) if len(owner) > 2 else np.zeros(0, np.int64)
    threes = common.Hasher(words).ranges(at, at + 3) ^ salt[owner[at]]
    found = at[_repeats(threes)[0]]
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[found + k] = True
    out["n_repeat_words"] = np.bincount(owner[covered], minlength=n)
    return out


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and MEASURES for every row; null and empty texts have zeros, equal rows are measured each for itself."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = measure_texts(*common.buffer_of(batch.column("text")))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(found[m].astype(np.int64)) for m in MEASURES)], ["doc_id", *MEASURES])

    rows = docs.select(F.col("doc_id"), common.text_of(docs).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return common.mapped(rows, run, ", ".join([f"doc_id {kind}", *(f"{m} long" for m in MEASURES)]))


def votes(rules: tuple[Rule, ...] = RULES) -> F.Column:
    """One letter per rule; a measure without a value abstains."""
    one = [
        F.when(F.try_divide(F.lit(1), F.col("n_words")).isNull(), str(ABSTAIN))
        .when(F.expr(r.measure) >= r.bad, str(BAD))
        .when(F.expr(r.measure) <= F.lit(r.good), str(GOOD))
        .otherwise(str(ABSTAIN))
        for r in rules
    ]
    return F.concat(*one)


def base_failed() -> F.Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


@dataclass
class Weighing:
    """What expectation-maximisation found: the share of good documents, P(vote | class) per rule, and posteriors."""

    prior: float
    table: np.ndarray  # rule, class, vote
    posterior: dict[str, float]


def starting_table(rule: Rule) -> np.ndarray:
    """P(vote | class) to start from: a bad vote is rare among good documents, no rule finds every bad one."""
    good = (0.1, 0.6) if rule.good is not None else (0.001, 0.001)
    return np.array([[0.3, good[0], 0.7 - good[0]], [0.01, good[1], 0.99 - good[1]]])


def weigh(patterns: list[str], counts: np.ndarray, rules: tuple[Rule, ...] = RULES, rounds: int = 200) -> Weighing:
    """Votes per class of independent rules, from how often each pattern of votes occurs.

    The starting table names the two classes; a few virtual votes in its proportions keep rules that hardly ever
    vote from extremes.
    """
    start = np.array([starting_table(r) for r in rules])
    if not patterns:
        return Weighing(0.5, start, {})
    seen = np.array([[int(v) for v in p] for p in patterns])
    weight = np.asarray(counts, float)
    tables, prior, posterior = start.copy(), 0.8, np.zeros(len(seen))
    for _ in range(rounds):
        like = np.stack([sum(np.log(tables[r, c, seen[:, r]]) for r in range(len(rules))) for c in (BAD, GOOD)])
        odds = like[GOOD] - like[BAD] + np.log(prior / (1 - prior))
        new = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        done = np.abs(new - posterior).max() < 1e-9
        posterior = new
        if done:
            break
        prior = float(np.clip((weight @ posterior + 8) / (weight.sum() + 10), 1e-3, 1 - 1e-3))
        for c, share in ((BAD, 1 - posterior), (GOOD, posterior)):
            for r in range(len(rules)):
                found = np.bincount(seen[:, r], weight * share, 3) + 10 * start[r, c]
                tables[r, c] = found / found.sum()
    return Weighing(prior, tables, dict(zip(patterns, posterior.tolist(), strict=True)))


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, threshold: float = 0.5) -> DataFrame:
    """Measures, votes, posterior, base_failed and kept for every row.

    The driver sees each pattern of votes with its count, at most 3 ** rules rows however many documents there are.
    Documents that fail the base conditions are not kept, but their votes count. No rows give no rows.
    """
    spark = docs.sparkSession
    voted = common.materialise(measure(docs).withColumn("votes", votes(rules)).withColumn("base_failed", base_failed()), "votes")
    found = voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()
    weighing = weigh([r["votes"] for r in found], np.array([r["n"] for r in found]), rules)
    posterior = spark.createDataFrame(list(weighing.posterior.items()), "votes string, posterior double")
    judged = voted.join(F.broadcast(posterior), "votes")
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))
