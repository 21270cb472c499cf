"""Toxicity of texts whose words may be disguised: noisy-channel restoration, then a lexical score.

A disguised stretch (letters mixed with look-alike digits and signs, letters spaced out one by one, letters
repeated) becomes a lattice: each character offers itself, what it may stand for, or nothing (a
separator, a repeat). Every such stretch of a text is decoded. Viterbi decoding finds the reading with the best sum of the channel's log
probabilities and those of a character trigram model. The model is counted over the words of all
documents, so it grows with the corpus; only its fixed-size table reaches the driver.

The restored text's words and word beginnings (4 to 6 letters) are scored by weights learned from labelled
rows: features much more frequent in toxic rows than chance allows, weighted by their log odds. A
logistic regression over the largest weight, their sum and their number gives the score. Rows used for
learning are bounded by ``most``; near copies among them (same smallest hash of three words) count once.

Edge cases: null and empty texts score as texts without any weighted word; null ids and labels are left out of learning;
without usable labels the score is a smoothed prior; repeated rows are scored one by one; an empty
table gives an empty result; further columns are kept.

Scale: two passes over the texts, one to count trigrams (a table per task leaves it) and one to score;
texts are never shuffled but for the bounded sample. What a task keeps leaves its Python worker with it.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import lean, let, small_batches, stored, words_of
from kerbside.llm.labels import remainder, training_rows

# What a sign may stand for, and what may separate letters.
LOOKALIKES = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i",
              "+": "t", "|": "il", "€": "e", "(": "c", "*": "aeiou", "#": "aeiou"}
SEPARATORS = " .-_*~·,'"
PARTS, HELD_OUT = 5, 0

LETTER = r"[^\W\d_]"
SIGN = "[" + re.escape("".join(LOOKALIKES)) + "]"
ONE = f"(?:{LETTER}|{SIGN})"
SEPARATOR = r"[ .\-_*~·,']"
#: In a text: letters or signs spaced one by one. In a token: a run of letters and signs; letters or signs with separators after
#: each; a letter three times or more.
SPACED = re.compile(rf"(?<!\w){ONE}(?:{SEPARATOR}{{1,3}}{ONE}(?!\w)){{2,}}")
WIDE = re.compile(f"{SEPARATOR}{{3,}}")
RUN = re.compile(f"{ONE}+")
DOTTED = re.compile(rf"{ONE}(?:[.\-_*~·,']{{1,3}}{ONE}){{2,}}")
REPEATED = re.compile(rf"({LETTER})\1\1")
TWICE = re.compile(rf"({SIGN})\1")
WORDS = re.compile(rf"{LETTER}+")
EDGES = ".,;:!?\"'()[]{}<>"
#: Signs that may also be punctuation around a stretch.
POINTS = "".join(c for c in LOOKALIKES if not c.isalnum())
#: Readings that a task keeps, and features that it counts before it passes them on.
KNOWN, COUNTED = 300_000, 200_000
#: Channel log probabilities: a letter as it is, a sign for a letter, a separator or repeat left out, a sign as it is.
PLAIN, STANDS, DROPPED, LITERAL = -0.1, -1.0, -0.7, -6.0
LOG = [0.0, *np.log(np.arange(1, 6)).tolist()]

#: Character classes of the model: 0 for anything else and word ends, then a-z, then U+00DF to U+00FF, then the letters of other
#: scripts by their place modulo 32, which keeps the letters of one alphabet apart.
N_CLASSES = 92


def class_of(char: str) -> int:
    code = ord(char)
    if 97 <= code <= 122:
        return code - 96
    if 0xDF <= code <= 0xFF:
        return code - 0xDF + 27
    return 60 + code % 32 if code > 0xFF and char.isalpha() else 0


@cache
def _class_table() -> np.ndarray:
    return np.array([class_of(chr(code)) for code in range(0x110000)], np.uint8)


class Classes(dict):
    """The class of a character, kept once it is known."""

    def __missing__(self, char: str) -> int:
        self[char] = value = class_of(char)
        return value


CLASSES = Classes()


class Rows(dict):
    """The last axis of a table by the place before it, as lists, made when first asked for."""

    def __init__(self, table: np.ndarray) -> None:
        self.table = table

    def __missing__(self, at: int) -> list[float]:
        self[at] = row = self.table[at].tolist()
        return row


def as_lists(model: np.ndarray | list) -> list:
    """The table as lists, which single look-ups read several times as fast; only rows that are used become lists."""
    return [Rows(plane) for plane in model] if isinstance(model, np.ndarray) else model


def trigram_model(docs: DataFrame) -> np.ndarray:
    """Log probability of a class after the two before it, from all words of all documents."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, totals = _class_table(), np.zeros(N_CLASSES ** 3, np.int64)
        for batch in batches:
            text = "  ".join(t for t in batch["text"] if t).lower()
            c = table[np.frombuffer(f"  {text}  ".encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.int64)
            codes = (c[:-2] * N_CLASSES + c[1:-1]) * N_CLASSES + c[2:]
            totals += np.bincount(codes[(c[1:-1] > 0) | (c[2:] > 0)], minlength=N_CLASSES ** 3)
        seen = np.flatnonzero(totals)
        yield pd.DataFrame({"code": seen, "n": totals[seen]})

    counts = np.full(N_CLASSES ** 3, 0.05)
    rows = docs.select("text").mapInPandas(lean(count), "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    for r in rows.collect():  # at most N_CLASSES ** 3 rows
        counts[r.code] += r.n
    counts = counts.reshape((N_CLASSES,) * 3)
    return np.log(counts / counts.sum(2, keepdims=True)).astype(np.float32)


def decoded(stretch: str, model: np.ndarray | list, squeeze: bool = True) -> str:
    """The best reading of a disguised stretch; ``model`` as ``trigram_model`` gives it. Without ``squeeze`` a sign that is
    repeated stands for as many letters."""
    lower, model = stretch.lower(), as_lists(model)
    best: dict[tuple[str, str], tuple[float, tuple]] = {(" ", " "): (0.0, ())}  # readings as (reading before, character)
    for i, char in enumerate(lower):
        if char.isalpha():
            options = ((char, CLASSES[char], PLAIN),)
        elif (meant := LOOKALIKES.get(char)):
            options = tuple((x, CLASSES[x], STANDS - LOG[len(meant)]) for x in meant)
        else:
            options = ((char, CLASSES[char], LITERAL),)
        separator = char in SEPARATORS
        repeats = i > 0 and char == lower[i - 1] and (squeeze or char.isalpha())
        then: dict[tuple[str, str], tuple[float, tuple]] = {}
        for state, (score, text) in best.items():
            a, b = state
            row = model[CLASSES[a]][CLASSES[b]]
            for x, kind, p in options:
                value = score + p + row[kind]
                if (known := then.get((b, x))) is None or value > known[0]:
                    then[b, x] = (value, (text, x))
            if separator or repeats or (b != " " and char == b):
                value = score + DROPPED
                if (known := then.get(state)) is None or value > known[0]:
                    then[state] = (value, text)
        best = then
    ended = {s: v + model[CLASSES[s[0]]][CLASSES[s[1]]][0] for s, (v, _) in best.items()}
    most = max(ended.values())

    def text_of(reading: tuple) -> str:
        chars = []
        while reading:
            reading, char = reading
            chars.append(char)
        return "".join(reversed(chars))

    return max(text_of(best[s][1]) for s, v in ended.items() if v == most)


def stretches(token: str) -> set[str]:
    """The stretches of a lower-case token that look disguised, with and without what may be punctuation or a neighbour's letter."""
    found = set()
    for match in DOTTED.finditer(token):
        stretch = match.group()
        # the words around may touch the first and the last letter
        first = re.search(ONE, stretch[1:]).start() + 1 if re.match(r"\w", token[match.start() - 1:match.start()]) else 0
        last = re.search(f"{SEPARATOR}+.$", stretch, re.S).start() if re.match(r"\w", token[match.end():match.end() + 1]) else len(stretch)
        found |= {stretch, stretch[first:], stretch[:last], stretch[first:last]}
    for match in RUN.finditer(token):
        if not (stretch := match.group()).isalpha():
            found |= {stretch, stretch.lstrip(POINTS), stretch.rstrip(POINTS), stretch.strip(POINTS)}
    found = {x for x in found if not x.isalpha() and any(c.isalpha() for c in x)}
    return found | {x for x in WORDS.findall(token) if REPEATED.search(x)}


def readings(token: str, model: np.ndarray) -> tuple[str, ...]:
    """The words of a lower-case token as written and, where it looks disguised, as restored."""
    core = token.strip(EDGES)
    if core.isalpha() and token in (core, core + ".", core + ","):
        return (core, *WORDS.findall(decoded(core, model))) if REPEATED.search(core) else (core,)
    words = WORDS.findall(core)
    if not words:
        return ()
    found = stretches(token) | ({core} if REPEATED.search(core) else set())
    ways = [(x, squeeze) for x in found for squeeze in ((True, False) if TWICE.search(x) else (True,))]
    return tuple({*words, *(w for x, squeeze in ways for w in WORDS.findall(decoded(x, model, squeeze)))})


def spaced_out(match: str, model: np.ndarray) -> set[str]:
    """The words that letters spaced one by one may spell."""
    words: set[str] = set()
    for part in {match, *WIDE.split(match)}:
        letters = [x for x in re.split(f"{SEPARATOR}+", part) if x]
        first = next((i for i, x in enumerate(letters) if x.isalpha()), None)
        if first is None or len(letters) < 2:
            continue
        for skip in {*range(3), *range(first, first + 3)}:  # signs and one-letter words of the sentence may stand before
            words.update(WORDS.findall(decoded(" ".join(letters[skip:]), model)))
        if "*" in part:  # a sign for a letter, or a separator
            words.update(WORDS.findall(decoded(part, model)))
    return words


def found_in(text: str | None, model: np.ndarray | list, known: dict[str, tuple], pick: Callable[[Iterable[str]], tuple]) -> set:
    """What ``pick`` takes from the distinct words of a text as written and as restored; ``known`` keeps it by token and is emptied
    when large."""
    lower = (text or "").lower()
    found: set = set()
    if len(known) > KNOWN:
        known.clear()
    for token in set(lower.split()):
        if (own := known.get(token)) is None:
            own = known[token] = pick(readings(token, model))
        if own:
            found.update(own)
    for match in SPACED.finditer(lower):
        found.update(pick(spaced_out(match.group(), model)))
    return found


def words_in(text: str | None, model: np.ndarray | list, known: dict[str, tuple]) -> set[str]:
    """The distinct words of a text as written and as restored."""
    return found_in(text, as_lists(model), known, tuple)


def features_of(word: str) -> list[str]:
    """A word and its beginnings."""
    return [word, *(word[:k] + "*" for k in (4, 5, 6) if len(word) > k)]


def features_in(words: Iterable[str]) -> tuple[str, ...]:
    return tuple({f for w in words for f in features_of(w)})


@dataclass
class Toxicity:
    """What the scorer needs: the character model, weights by feature, coefficients of the regression."""

    model: np.ndarray
    weights: dict[str, float]
    coefficients: np.ndarray

    def weighted(self, words: Iterable[str]) -> tuple[str, ...]:
        return tuple(f for f in features_in(words) if f in self.weights)

    def inputs(self, text: str | None, known: dict[str, tuple[str, ...]]) -> list[float]:
        self.model = as_lists(self.model)  # of this task's copy
        found = [self.weights[f] for f in found_in(text, self.model, known, self.weighted)]
        return [1.0, max(found, default=0.0), float(np.log1p(math.fsum(found))), float(np.log1p(len(found)))]


def learn(docs: DataFrame, labels: DataFrame, most: int = 20_000, features: int = 20_000) -> Toxicity:
    """Fit on the bounded sample; ``features`` bounds the weights kept, the most certain ones."""
    small_batches(docs.sparkSession)
    model = trigram_model(docs)
    rows = training_rows(docs, labels, "toxic", PARTS, HELD_OUT, most)
    smallest = let(words_of(F.col("text")), lambda w: F.array_min(F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(w) - 3, F.lit(0))), lambda i: F.xxhash64(F.slice(w, i + 1, 3)))))
    sample = stored(rows.withColumn("_family", smallest).dropDuplicates(["_family", "label"]).drop("_family"), "toxic-sample")
    totals = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    prior = (toxic + 1) / (toxic + clean + 12)
    if not toxic or not clean:
        return Toxicity(model, {}, np.array([np.log(prior / (1 - prior)), 0, 0, 0]))

    def passed_on(seen: tuple[Counter, Counter]) -> pd.DataFrame:
        names = list(seen[0] | seen[1])
        out = pd.DataFrame({"feature": pd.Series(names, dtype=object), "toxic": [seen[1][f] for f in names], "clean": [seen[0][f] for f in names]})
        for counter in seen:
            counter.clear()
        return out

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, tuple[str, ...]] = {}
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        lists = as_lists(model)
        for batch in batches:
            for text, label in zip(batch["text"], batch["label"]):
                seen[int(label > 0)].update(found_in(text, lists, known, features_in))
            if sum(map(len, seen)) > COUNTED:
                yield passed_on(seen)
        yield passed_on(seen)

    counted = (
        sample.repartition(64).mapInPandas(lean(count), "feature string, toxic long, clean long")
        .groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )
    share = F.col("toxic") / (F.col("toxic") + F.col("clean"))
    surprise = (F.col("toxic") + F.col("clean")) * (
        share * F.log(share / prior) + F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - prior))).otherwise(0.0))
    odds = F.log(((F.col("toxic") - F.sqrt("toxic") / 2 + 0.5) / toxic) / ((F.col("clean") + 0.5) / clean))
    # the surprise that chance brings among so many features, and a little more
    kept = (
        counted.filter("toxic >= 3").withColumn("share", share).filter(F.col("share") > prior)
        .withColumn("surprise", surprise).filter(F.col("surprise") > 8.0).withColumn("weight", odds).filter("weight > 1.0")
        .orderBy(F.desc("surprise"), "feature").limit(features).select("feature", "weight").collect()
    )
    fitted = Toxicity(model, {r.feature: float(r.weight) for r in kept}, np.zeros(4))

    def inputs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, tuple[str, ...]] = {}
        for batch in batches:
            x = np.array([fitted.inputs(t, known) for t in batch["text"]]).reshape(-1, 4)
            yield pd.DataFrame({"a": x[:, 1], "b": x[:, 2], "c": x[:, 3], "label": (batch["label"] > 0).astype("int32")})

    table = sample.mapInPandas(lean(inputs), "a double, b double, c double, label int").toPandas()  # bounded by ``most``
    x = np.c_[np.ones(len(table)), table[["a", "b", "c"]].to_numpy()]
    fitted.coefficients = logistic(x, table["label"].to_numpy(float))
    return fitted


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5, steps: int = 40) -> np.ndarray:
    """Newton's method with a ridge on all but the constant."""
    beta, penalty = np.zeros(x.shape[1]), np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ beta)
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    return beta


def scored(docs: DataFrame, fitted: Toxicity) -> DataFrame:
    """``docs`` with ``score`` between 0 and 1."""
    small_batches(docs.sparkSession)
    docs = docs.drop("score")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", score double"

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, tuple[str, ...]] = {}
        for batch in batches:
            x = np.array([fitted.inputs(t, known) for t in batch["text"]]).reshape(-1, 4)
            yield batch.assign(score=1 / (1 + np.exp(-np.clip(x @ fitted.coefficients, -30, 30))))

    return docs.mapInPandas(lean(score), schema)


def toxicity(docs: DataFrame, labels: DataFrame, most: int = 20_000) -> DataFrame:
    """``docs`` with held_out, score and predicted, which replace columns of these names."""
    return scored(docs, learn(docs, labels, most)).withColumns({
        "held_out": remainder(F.col("doc_id"), PARTS) == HELD_OUT, "predicted": (F.col("score") >= 0.5).cast("int")})
