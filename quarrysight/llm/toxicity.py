"""Toxicity: noisy-channel deobfuscation, then a learned score of the restored text.

1. A character trigram model is counted over the texts of all documents.
2. A token that may be disguised becomes a lattice: leetspeak symbols stand for
   letters, marks inside words for letters or nothing, runs of a letter for one
   or two, and letters spaced out for one word or several. Viterbi decoding under
   the character model restores the likeliest letters.
3. Words are weighed on labelled documents: the share of toxic ones among those
   with the word, shrunk to that of the words with the same beginning (six, five,
   four letters), shrunk in turn to the base rate. Beginnings count each word
   once, so that one frequent word does not speak for its relatives.
4. A logistic regression on the labelled documents weighs what a text shows: the
   shares of its three worst words, plain or restored, how many words are
   more toxic than not, and of how many. In its fit a document's own label is taken out of the
   shares.

Bounds: at most about MAX_LABELLED labelled rows (by hash of doc_id) are learned
from, which bounds the lexicon; the character model has 64 classes, so at most
64^3 counts. Both go to every task. Counts and scores cover all documents; texts
are never cut.

Defined cases: null text is empty; a text without a known word or beginning has
the regression's score of no evidence; a doc_id with several label rows is toxic if one is; labels that
are null or of absent documents are not used; without labels every score is BASE;
labelled texts with the same set of words and as many distinct tokens weigh once
per label, all others each; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty, worker_keeps, written
from .word_codes import blocks

MAX_LABELLED = 200_000   # labelled rows learned from, about
BASE = 0.02              # share of a word without any evidence
FLOOR = 0.3              # weaker words and beginnings are left out of the lexicon
PREFIXES = (4, 5, 6)
WEIGHT = 5.0             # prior weight of the level above
WORST = 3                # words that a score looks at
HINGES = (1.0, 2.5, 4.0)  # log odds where the worst word's weight may change
CACHE = 200_000          # tokens a worker keeps, twice at most
SLICE = 128              # documents handled at once
COUNTED = 1 << 19        # bytes of text whose characters are counted at once, or one text

# fixed values: the alphabet, and what symbols may stand for
LETTERS = "abcdefghijklmnopqrstuvwxyzàâäáãåæçéèêëíìîïñóòôöõøœúùûüýÿß"
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "¡": "i"}
HIDING = "*#%.-_~^'`·"        # inside a word: nothing, or for the first three any vowel
MASKS, VOWELS = "*#%", "aeiou"
LEET_COST, HIDE_COST, MASK_COST, BREAK_COST = 0.7, 0.3, 1.5, 1.0

CLASSES = 64
OTHER = CLASSES - 1
_CLASS = {c: i + 1 for i, c in enumerate(LETTERS)}
_TABLE = np.zeros(0x251, np.int32)
for _i in range(0x251):
    _c = chr(_i)
    _TABLE[_i] = _CLASS.get(_c, OTHER if _c.isalpha() else 0)
_TABLE[0x250] = OTHER

_WORD = re.compile(r"[^\W\d_]+")
_RUN = re.compile(r"([^\W\d_])\1\1")
_LEET = "".join(map(re.escape, LEET))
_HIDE = "".join(map(re.escape, HIDING))
_DISGUISED = re.compile(rf"(?:(?<![^\W\d_])[{_LEET}]+|[^\W\d_][{_LEET}{_HIDE}]+)[^\W\d_]|[^\W\d_][0-9@$|+€]")
_SPACED = re.compile(r"(?<!\S)\S(?:[ \t]\S(?!\S)){2,}")
_EDGE = ".,;:?\"'()[]{}<>«»“”‘’`*_~-"


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """Counts of (class, class, class) over all texts; a word's first letter
    follows two boundaries. Spark adds up a short table per task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES ** 3, np.int64)
        for batch in batches:
            for piece in blocks(batch, 0, COUNTED):
                text = "\n".join(["", *piece.column(0).to_pylist(), ""]).lower()
                points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
                c = _TABLE[np.minimum(points, 0x250)]
                b = np.concatenate([[0], c[:-1]])
                a = np.where(b == 0, 0, np.concatenate([[0, 0], c[:-2]]))
                code = ((a * CLASSES + b) * CLASSES + c)[(b > 0) | (c > 0)]
                total += np.bincount(code, minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.record_batch({"code": pa.array(some, pa.int32()), "n": pa.array(total[some], pa.int64())})

    rows = (docs.select(text_or_empty("text").alias("text")).mapInArrow(count, "code int, n long")
            .groupBy("code").agg(F.sum("n").alias("n")).toPandas())   # CLASSES^3 rows at most
    out = np.zeros(CLASSES ** 3)
    out[rows["code"].to_numpy(np.int64)] = rows["n"].to_numpy(float)
    return out.reshape(CLASSES, CLASSES, CLASSES)


def character_model(counts: np.ndarray) -> np.ndarray:
    """log P(c | a, b), interpolated with the orders below."""
    pairs, singles = counts.sum(axis=0), counts.sum(axis=(0, 1))
    p1 = (singles + 1) / (singles.sum() + CLASSES)
    p2 = (pairs + 2 * p1) / (pairs.sum(axis=1, keepdims=True) + 2)
    p3 = (counts + 2 * p2) / (counts.sum(axis=2, keepdims=True) + 2)
    return np.log(0.75 * p3 + 0.2 * p2 + 0.05 * p1).astype(np.float32)


def _class(letter: str) -> int:
    return _CLASS.get(letter, OTHER) if letter != " " else 0


def decode(lattice: list[list[tuple[str, float]]], model: np.ndarray) -> str:
    """Likeliest letters of a lattice: each step offers strings at a cost."""
    paths: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
    for options in [*lattice, [(" ", 0.0)]]:
        after: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (score, text) in paths.items():
            for letters, cost in options:
                p, q, value, kept = a, b, score - cost, letters
                for letter in letters:
                    c = _class(letter)
                    if c == 0 and q == 0:      # no empty words
                        kept = ""
                        break
                    value += float(model[p, q, c])
                    p, q = (q, c) if c else (0, 0)
                if (p, q) not in after or value > after[p, q][0]:
                    after[p, q] = (value, text + kept)
        paths = after
    return max(paths.values())[1].strip()


def _symbols(text: str, spaced: bool) -> list[list[tuple[str, float]]]:
    lattice: list[list[tuple[str, float]]] = []
    for ch, run in groupby(text):
        n = len(list(run))
        if ch.isalpha():
            step = [(ch, 0.0)] if n == 1 else [(ch, 0.0), (ch * 2, 0.0)] if n > 2 or spaced else [(ch * 2, 0.0)]
        elif ch in LEET:
            step = [(x * k, LEET_COST) for x in LEET[ch] for k in ((1,) if n == 1 else (1, 2))]
        elif ch in MASKS:
            step = [("", HIDE_COST), *[(v, MASK_COST) for v in VOWELS]]
        elif ch in HIDING:
            step = [("", HIDE_COST), (" ", 0.0)] if spaced else [("", HIDE_COST)]
        else:
            step = [(" ", 0.0)]
        if spaced and lattice:
            lattice.append([("", 0.0), (" ", BREAK_COST)])
        lattice.append(step)
    return lattice


def restore_token(token: str, model: np.ndarray) -> list[str]:
    """Words that a lower-case token may hide; none if nothing in it is odd."""
    core = token.strip(_EDGE).rstrip("!")
    if not (_DISGUISED.search(core) or _RUN.search(core)):
        return []
    return decode(_symbols(core, False), model).split()


def restore_spaced(text: str, model: np.ndarray) -> list[list[str]]:
    """For each stretch of single characters, the words they spell."""
    return [decode(_symbols("".join(m.group().split()), True), model).split() for m in _SPACED.finditer(text)]


def deobfuscate(text: str, model: np.ndarray) -> str:
    """The text in lower case, disguised stretches restored."""
    low = _SPACED.sub(lambda m: decode(_symbols("".join(m.group().split()), True), model), text.lower())
    return " ".join(" ".join(restore_token(t, model)) or t for t in low.split(" "))


def _words(text: str, model: np.ndarray) -> set[str]:
    low = text.lower()
    out = set(_WORD.findall(low))
    for token in set(low.split()):
        out.update(restore_token(token, model))
    for words in restore_spaced(low, model):
        out.update(words)
    return out


def learn(docs: DataFrame, labels: DataFrame, model: np.ndarray) -> tuple[dict[str, float], np.ndarray]:
    """The lexicon and the regression's weights. The lexicon has toxic shares of words, and of beginnings (with a ``*``), from ``labels``
    (doc_id, toxic); those over FLOOR, and known words under such a beginning."""
    spark = docs.sparkSession
    lm = spark.sparkContext.broadcast(model)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in (batch.slice(i, SLICE) for i in range(0, batch.num_rows, SLICE)):
                texts = piece.column(2).to_pylist()
                yield pa.record_batch({
                    "doc_id": piece.column(0), "toxic": piece.column(1),
                    "size": pa.array([len(set(t.lower().split())) for t in texts], pa.int64()),
                    "words": pa.array([sorted(_words(t, lm.value)) for t in texts], pa.list_(pa.string()))})

    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = MAX_LABELLED / max(1, known.count())
    if share < 1:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    known = known.select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
    read = (
        docs.select(F.col("doc_id").cast("long"), text_or_empty("text").alias("text"))
        .join(F.broadcast(known), F.col("doc_id") == F.col("_id"))     # MAX_LABELLED rows of two numbers
        .select("doc_id", "toxic", "text").mapInArrow(words, "doc_id long, toxic int, size long, words array<string>"))
    # rows that are equal in all that is learned from them weigh once
    once = read.select("toxic", "words", "size").distinct()
    one = written(once.select(F.monotonically_increasing_id().alias("id"), "toxic", "words", "size"), "labelled")
    n, t = one.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    base = (t + 1) / (n + 2)
    counts = written(
        one.select("toxic", F.explode("words").alias("word")).groupBy("word")
        .agg(F.count("*").alias("n"), F.sum("toxic").alias("t")), "words")

    above = None
    for size in PREFIXES:
        level = (
            counts.where(F.length("word") > size)
            .groupBy(F.substring("word", 1, size).alias(f"p{size}"))
            .agg(F.count("*").alias("m"), F.sum(F.col("t") / F.col("n")).alias("s")))
        if above is None:
            level = level.withColumn("up", F.lit(base))
        else:
            short = size - 1
            level = level.withColumn("_up", F.substring(f"p{size}", 1, short)).join(
                above.select(F.col(f"p{short}").alias("_up"), F.col("p").alias("up")), "_up").drop("_up")
        above = written(level.select(f"p{size}", ((F.col("s") + WEIGHT * F.col("up")) / (F.col("m") + WEIGHT)).alias("p")),
                        "prefixes")
        level = above
        counts = counts.join(level.select(F.col(f"p{size}").alias(f"_p{size}"), F.col("p").alias(f"v{size}")),
                             (F.substring("word", 1, size) == F.col(f"_p{size}")) & (F.length("word") > size), "left"
                             ).drop(f"_p{size}")
        strong = level.where(F.col("p") >= FLOOR).select(F.concat(f"p{size}", F.lit("*")).alias("word"), "p")
        prefixes = strong if size == PREFIXES[0] else prefixes.unionByName(strong)
    up = F.coalesce(*[F.col(f"v{s}") for s in reversed(PREFIXES)], F.lit(base))
    share = (F.col("t") + WEIGHT * up) / (F.col("n") + WEIGHT)
    strong = written(counts.select("word", "n", "t", up.alias("up"), share.alias("p")).where(
        (F.col("p") >= FLOOR) | (F.col("up") >= FLOOR)), "lexicon")
    # the labelled sample is bounded, and so is what has a share over FLOOR in it
    shares = {r["word"]: float(r["p"]) for r in strong.select("word", "p").unionByName(prefixes).toLocalIterator()}

    # what labelled documents show when their own label is left out
    rest = (F.col("t") - F.col("toxic") + WEIGHT * F.col("up")) / (F.col("n") - 1 + WEIGHT)
    evidence = (
        one.select("id", "toxic", F.explode("words").alias("_word"))
        .join(F.broadcast(strong.select("word", "n", "t", "up")), F.col("_word") == F.col("word"))
        .select("id", rest.alias("p")).groupBy("id").agg(
            F.slice(F.sort_array(F.collect_list("p"), asc=False), 1, WORST).alias("worst"),
            F.sum((F.col("p") >= 0.5).cast("int")).alias("strong")))
    rows = one.select("id", "toxic", "size").join(evidence, "id", "left").select(
        "toxic", "size", "worst", "strong").toPandas()
    found = np.array([features(list(w) if w is not None else [], 0 if np.isnan(k) else int(k), size)
                      for w, k, size in zip(rows["worst"], rows["strong"].astype(float), rows["size"])])
    return shares, fit(found, rows["toxic"].to_numpy(float)) if len(rows) else no_model()


def features(shares: list[float], strong: int, size: int) -> list[float]:
    """What a text shows, of its words' shares: a constant, log odds of the
    worst, how far the very worst is past each of HINGES, the number of
    strong ones and that of distinct tokens."""
    worst = np.clip(sorted(shares, reverse=True)[:WORST] + [BASE] * WORST, 0.005, 0.998)[:WORST]
    odds = np.log(worst / (1 - worst))
    return [1.0, *odds, *np.maximum(0.0, odds[0] - np.array(HINGES)), np.log1p(strong), np.log1p(size)]


def no_model() -> np.ndarray:
    return np.array([np.log(BASE / (1 - BASE)), *[0.0] * (WORST + len(HINGES) + 2)])


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25) -> np.ndarray:
    """Logistic regression by Newton's method; the constant is not shrunk."""
    w = np.zeros(x.shape[1])
    shrink = ridge * np.eye(len(w))
    shrink[0, 0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gain = x.T @ (y - p) - shrink @ w
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + shrink, gain)
    return w


class Scorer:
    """Scores texts; keeps the tokens it has met."""

    def __init__(self, model: np.ndarray, shares: dict[str, float], weights: np.ndarray) -> None:
        self.model, self.shares, self.weights = model, shares, weights
        # by token, the words in it that have a share over BASE
        self.known: dict[str, tuple[str, ...]] = {}
        self.older: dict[str, tuple[str, ...]] = {}

    def word(self, word: str) -> float:
        got = self.shares.get(word)
        for size in reversed(PREFIXES):
            if got is not None:
                return got
            if len(word) > size:
                got = self.shares.get(word[:size] + "*")
        return BASE if got is None else got

    def telling(self, words: list[str]) -> tuple[str, ...]:
        return tuple(w for w in words if self.word(w) > BASE)

    def score(self, words: set[str], size: int) -> float:
        shares = [self.word(w) for w in words]
        at = float(np.dot(features(shares, sum(s >= 0.5 for s in shares), size), self.weights))
        return 1 / (1 + float(np.exp(-np.clip(at, -30, 30))))

    def scores(self, texts: list[str]) -> list[float]:
        if len(self.known) > CACHE:
            self.known, self.older = {}, self.known
        known, older, out = self.known, self.older, []
        for text in texts:
            low = text.lower()
            tokens = set(low.split())
            for t in tokens.difference(known):
                known[t] = older[t] if t in older else self.telling([*_WORD.findall(t), *restore_token(t, self.model)])
            words = set().union(*map(known.__getitem__, tokens))
            for spelled in restore_spaced(low, self.model):
                words.update(self.telling(spelled))
            out.append(self.score(words, len(tokens)))
        return out


def _scoring(docs: DataFrame, labels: DataFrame) -> Callable[[list[str]], list[float]]:
    """What scores texts in tasks, learned from ``docs`` and ``labels``."""
    sc = docs.sparkSession.sparkContext
    model = character_model(trigram_counts(docs))
    both = sc.broadcast((model, *learn(docs, labels, model)))
    number = both._jbroadcast.id()

    def scores(texts: list[str]) -> list[float]:
        return worker_keeps(("scorer", number), lambda: Scorer(*both.value)).scores(texts)

    return scores


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, score, predicted) per row of ``docs`` (doc_id, text), learned
    from ``labels`` (doc_id, toxic). Scores use the text alone."""
    scores = _scoring(docs, labels)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in (batch.slice(i, SLICE) for i in range(0, batch.num_rows, SLICE)):
                got = scores(piece.column(1).to_pylist())
                yield pa.record_batch({"doc_id": piece.column(0), "score": pa.array(got, pa.float64()),
                                       "predicted": pa.array([int(s >= 0.5) for s in got], pa.int32())})

    return docs.select(F.col("doc_id").cast("long"), text_or_empty("text").alias("text")).mapInArrow(
        score, "doc_id long, score double, predicted int")


def not_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose own score does not reject them."""
    scores = _scoring(docs, labels)
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in (batch.slice(i, SLICE) for i in range(0, batch.num_rows, SLICE)):
                got = scores([t or "" for t in piece.column(at).to_pylist()])
                yield piece.filter(pa.array([not s >= 0.5 for s in got], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
